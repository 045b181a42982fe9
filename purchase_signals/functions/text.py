"""Text expressions, all built-in and code-generated."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a line.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
# Characters shown to the scorer, and the stamp of a run folder.
MAX_CHARS = 500
RUN_STAMP_FORMAT = "yyyyMMdd_HHmmss"


def is_missing(text: Column) -> Column:
    """Null or empty. A text of blanks is not missing."""
    return F.coalesce(text, F.lit("")) == ""


def present(text: Column) -> Column:
    """``text``, or null where it is missing."""
    return F.when(text != "", text)


def clean_text(text: Column) -> Column:
    """Put a backslash before each double quote and turn newlines into blanks."""
    escaped = F.replace(text, F.lit('"'), F.lit('\\"'))
    return F.replace(escaped, F.lit("\n"), F.lit(" "))


def truncate_text(text: Column, n: int = MAX_CHARS) -> Column:
    """The first ``n`` characters."""
    return F.substring(text, 1, n)


def model_input(text: Column, n: int | None = None) -> Column:
    """The cleaned text, whole or its first ``n`` characters for a model with a limit.

    Cleaning never shortens a text, so these come from the first ``n`` raw
    characters. Cutting first gives the same value without copying long texts.
    """
    if n is None:
        return clean_text(text)
    return truncate_text(clean_text(truncate_text(text, n)), n)


def clean_json_line(line: Column) -> Column:
    """Strip white space at both ends, then one trailing comma."""
    bare = F.btrim(line, F.lit(WHITESPACE))
    return F.when(F.endswith(bare, F.lit(",")), F.left(bare, F.length(bare) - 1)).otherwise(bare)


def run_stamp(ts: Column) -> Column:
    """A timestamp the way run folders are named."""
    return F.date_format(ts, RUN_STAMP_FORMAT)
