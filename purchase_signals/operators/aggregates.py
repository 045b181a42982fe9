"""One row per game: sentiment averages and vote counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import AGGREGATE_COLUMNS, GAME, NEGATIVE_SCORE, POSITIVE_SCORE, VOTE
from .features import vote_flags

# Totals behind the averages, which leave-one-out features are derived from.
SUM_COLUMNS = ["sum_positive_score", "sum_negative_score", "scored_reviews"]


def ratio(total, n):
    """``total / n``, and 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(total, n), F.lit(0.0))


def game_aggregates(
    df: DataFrame, on_unscored: str = "zero", with_sums: bool = False, game: str = GAME
) -> DataFrame:
    """Average scores, reviews and votes of each game in one aggregation.

    ``on_unscored="zero"`` lets rows without a model answer count as zeros in the
    averages; ``"exclude"`` leaves them out there, which needs the ``scored`` flag
    of ``flatten_sentiment``. Null games form a group of their own.

    All five are sums and counts, so each task sends at most one row per game
    through the shuffle and a game with very many reviews costs no more than others.
    """
    if on_unscored not in ("zero", "exclude"):
        raise ValueError(f"on_unscored: {on_unscored}")
    counts = F.col("scored") if on_unscored == "exclude" else F.lit(True)

    def total(score):
        value = F.coalesce(F.nanvl(F.col(score).cast("double"), F.lit(0.0)), F.lit(0.0))
        return F.sum(F.when(counts, value).otherwise(0.0))

    up, down = vote_flags(F.col(VOTE))
    sums = df.groupBy(game).agg(
        total(POSITIVE_SCORE).alias("sum_positive_score"),
        total(NEGATIVE_SCORE).alias("sum_negative_score"),
        F.count_if(counts).alias("scored_reviews"),
        F.count(F.lit(1)).alias("total_reviews"),
        F.sum(up).alias("total_positive_reviews"),
        F.sum(down).alias("total_negative_reviews"),
    )
    averages = {
        f"avg_{s}": ratio(F.col(f"sum_{s}"), F.col("scored_reviews"))
        for s in (POSITIVE_SCORE, NEGATIVE_SCORE)
    }
    extra = SUM_COLUMNS if with_sums else []
    return sums.withColumns(averages).select(game, *AGGREGATE_COLUMNS, *extra)
