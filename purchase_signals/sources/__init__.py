from .json_array import read_json_array
from .json_text import parse_json_lines, read_json_document, read_json_lines
from .lake import extract_to_lake
from .reviews import (
    conform,
    finished_runs,
    misfit_counts,
    misfit_rows,
    read_all_runs,
    read_latest_run,
    read_reviews,
)

__all__ = [
    "conform",
    "extract_to_lake",
    "finished_runs",
    "misfit_counts",
    "misfit_rows",
    "parse_json_lines",
    "read_all_runs",
    "read_json_array",
    "read_json_document",
    "read_json_lines",
    "read_latest_run",
    "read_reviews",
]
