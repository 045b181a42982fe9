from .sentiment import (
    DEFAULT_NEGATIVE,
    DEFAULT_POSITIVE,
    count_words,
    fill_missing,
    is_scored,
    lexicon_scorer,
    parse_score_response,
    polarity,
    sentiment_struct,
)
from .text import (
    clean_json_line,
    clean_text,
    is_missing,
    model_input,
    present,
    run_stamp,
    truncate_text,
)

__all__ = [
    "DEFAULT_NEGATIVE",
    "DEFAULT_POSITIVE",
    "clean_json_line",
    "clean_text",
    "count_words",
    "fill_missing",
    "is_missing",
    "is_scored",
    "lexicon_scorer",
    "model_input",
    "parse_score_response",
    "polarity",
    "present",
    "run_stamp",
    "sentiment_struct",
    "truncate_text",
]
