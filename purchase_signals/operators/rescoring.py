"""Scoring again with an earlier run at hand: only new, changed and failed reviews are asked."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ERROR, SENTIMENT, SENTIMENT_TYPE, TEXT
from ..shared import materialise

# Whether the scorer was asked for a row of the result.
ASKED = "_asked"


def _same_key(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    right = right.withColumnRenamed(key, "_right_key")
    joined = left.join(right, left[key].eqNullSafe(right["_right_key"]), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("_right_key")


def score_again(
    reviews: DataFrame,
    previous: DataFrame,
    key: str,
    ask: Callable[[DataFrame], DataFrame],
    text_col: str = TEXT,
) -> DataFrame:
    """``reviews`` scored, with the answers of ``previous`` where these still hold.

    ``previous`` are scored reviews, ``ask`` scores a frame. An answer is taken over if the
    review's text is the same and the answer is not ERROR; the other columns are always
    those of ``reviews``. Reviews that are gone are left out. ``key`` must be unique; rows
    without one are asked each time. The result has the flag ``_asked``, too.

    What differs is found on keys and row digests alone. Rows that do not differ come from
    ``previous`` as they are, and whole rows are read by the keys that do: as long as these
    are few, they are broadcast and no text is shuffled.
    """
    columns = reviews.columns
    absent = {c: F.lit(None).cast(reviews.schema[c].dataType) for c in columns if c not in previous.columns}
    previous = previous.withColumns(absent).select(*columns, SENTIMENT)
    failed = F.coalesce(F.col(f"{SENTIMENT}.label") == ERROR, F.lit(True))
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    now = reviews.select(key, digest.alias("_row"))
    was = previous.select(
        F.col(key).alias("_was_key"), digest.alias("_was_row"), failed.alias("_failed")
    )
    both = now.join(was, now[key] == was["_was_key"], "full_outer").select(
        F.coalesce(key, "_was_key").alias(key),
        F.col("_row").isNotNull().alias("_now"),
        F.col("_was_row").isNotNull().alias("_was"),
        F.coalesce((F.col("_row") == F.col("_was_row")) & ~F.col("_failed"), F.lit(False)).alias("_holds"),
    )
    both = materialise(both.where(~F.col("_holds")), "reviews_that_differ")
    twice = both.where(f"`{key}` is not null and _now").groupBy(key).count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"{key} repeats")
    # Rows of previous runs with these keys are gone, changed or failed.
    outdated = both.where("_was").select(key).distinct()
    kept = _same_key(previous, outdated, key, "left_anti")
    fresh = _same_key(reviews, both.where("_now").select(key).distinct(), key, "left_semi")
    # The texts of some are the same, only other columns changed.
    answers = _same_key(previous.where(~failed), outdated, key, "left_semi").select(
        F.col(key).alias("_answered"), F.xxhash64(text_col).alias("_text"), SENTIMENT
    )
    same = (F.col(key) == F.col("_answered")) & (F.xxhash64(text_col) == F.col("_text"))
    fresh = fresh.join(answers, same, "left").select(*columns, SENTIMENT)
    asked = ask(fresh.where(F.col(SENTIMENT).isNull()).drop(SENTIMENT))
    parts = [
        (kept, False),
        (fresh.where(F.col(SENTIMENT).isNotNull()), False),
        (asked, True),
    ]
    parts = [
        part.select(*columns, F.col(SENTIMENT).cast(SENTIMENT_TYPE), F.lit(flag).alias(ASKED))
        for part, flag in parts
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
