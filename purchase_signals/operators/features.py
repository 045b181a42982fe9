"""Choosing, flattening and filling columns, and the label."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sentiment import is_scored
from ..schema import (
    NEGATIVE_SCORE,
    NUMERIC_COLUMNS,
    POSITIVE_SCORE,
    PREPARED_COLUMNS,
    SENTIMENT,
    VOTE,
)


def select_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The columns preparation works on, after those named in ``keep``."""
    return df.select(*keep, *[c for c in PREPARED_COLUMNS if c not in keep])


def flatten_sentiment(df: DataFrame, with_scored: bool = False) -> DataFrame:
    """Both sentiment scores as columns in place of the struct.

    ``with_scored`` adds the flag that ``game_aggregates(on_unscored="exclude")``
    needs.
    """
    struct = F.col(SENTIMENT)
    added = {c: struct[c] for c in (POSITIVE_SCORE, NEGATIVE_SCORE)}
    if with_scored:
        added["scored"] = is_scored(struct)
    return df.withColumns(added).drop(SENTIMENT)


def fill_numeric(df: DataFrame, cols: Sequence[str] = tuple(NUMERIC_COLUMNS)) -> DataFrame:
    """Zero for null and NaN in ``cols``."""
    return df.na.fill(0, list(cols))


def purchase_label(purchase: Column) -> Column:
    """1 or 0 from the purchase flag; null and what is no number count as 0."""
    return F.coalesce(purchase.try_cast("int"), F.lit(0))


def vote_flags(vote: Column) -> tuple[Column, Column]:
    """(is up-vote, is down-vote) as 0/1. A null vote is neither."""
    up = F.when(vote, 1).otherwise(0)
    down = F.when(~vote, 1).otherwise(0)
    return up, down


def vote_split(df: DataFrame, vote: str = VOTE) -> tuple[DataFrame, DataFrame]:
    """Up-voted rows and down-voted rows; rows without a vote are in neither."""
    return df.where(F.col(vote) == F.lit(True)), df.where(F.col(vote) == F.lit(False))


def feature_columns(df: DataFrame, label: str = "label") -> list[str]:
    """All columns but the label."""
    return [c for c in df.columns if c != label]
