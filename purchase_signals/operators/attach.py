"""Joining per-game rows back to the reviews."""

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import AGGREGATE_COLUMNS, GAME, NEGATIVE_SCORE, POSITIVE_SCORE, VOTE
from ..shared import materialise
from .aggregates import SUM_COLUMNS, ratio
from .features import vote_flags

BROADCAST_BYTES = 64 << 20
# A key with more than one in this many rows is joined in several parts, or in as many rows as
# there are shuffle partitions, if these are more. There are fewer such keys than
# that number, whatever the data.
HOT_SHARE = 1000
# Column of per-game tables that tells how many rows a key has.
SIZE = "total_reviews"


def _table_bytes(df: DataFrame, key: str) -> int:
    """Size of a table of a key, numbers and feature vectors, counted from its rows.

    A vector holds five scaled values and at most one slot of a one-hot encoding.
    """
    vectors = sum(isinstance(f.dataType, VectorUDT) for f in df.schema)
    width = 32 + 8 * len(df.columns) + 160 * vectors
    keys = F.sum(F.octet_length(F.col(key).cast("string")))
    n, text = df.agg(F.count(F.lit(1)), F.coalesce(keys, F.lit(0))).first()
    return n * width + text


def attach_by_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: str = GAME,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: int | None = None,
    written: bool = False,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Left join of ``rows`` with a table of one row per ``key``, null-safe; ``rows`` are read once.

    ``per_key`` is written out, unless it is ``written`` already, and measured. If it
    is small, the join broadcasts it and ``rows`` are not shuffled. If not, both are
    shuffled by key and part: the keys that hold more than one in ``hot_share`` of the rows are
    dealt to as many parts as average partitions they would fill, and only the rows of
    ``per_key`` with these keys are copied to each of their parts.

    How many rows a key has is taken from ``sizes`` (``key``, ``total_reviews``), or from ``per_key``
    if it has that column; else it is counted, which reads the key column of ``rows`` once more.
    """
    per_key = per_key if written else materialise(per_key, "per_key")
    added = [c for c in per_key.columns if c != key]

    def join(left, right, how="left"):
        right = right.withColumnRenamed(key, "_joined_key")
        return left.join(right, F.col(key).eqNullSafe(F.col("_joined_key")), how).drop("_joined_key")

    if _table_bytes(per_key, key) <= broadcast_bytes:
        return join(rows, F.broadcast(per_key))

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if hot_share is None:
        hot_share = max(HOT_SHARE, partitions)
    if sizes is None and SIZE in per_key.columns:
        sizes = per_key
    if sizes is None:
        counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias(SIZE))
        sizes = materialise(counted, "key_counts")
    sizes = sizes.select(key, F.col(SIZE).alias("_n"))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = sizes.where(F.col("_n") * hot_share > total)
    parts = F.ceil(F.col("_n") * partitions / F.lit(max(1, total))).cast("int")
    # Fewer than hot_share rows.
    hot = F.broadcast(materialise(hot.select(key, parts.alias("_parts")), "hot_keys"))
    # A task's rows of one key go to one part: the same one, should the task run again.
    part = F.pmod(F.xxhash64(F.spark_partition_id()), F.coalesce("_parts", F.lit(1)))
    dealt = join(rows, hot).withColumn("_part", part.cast("int")).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    copied = join(per_key, hot).withColumn("_joined_part", copies).drop("_parts")
    copied = copied.withColumnRenamed(key, "_joined_key")
    alike = F.col(key).eqNullSafe(F.col("_joined_key")) & (F.col("_part") == F.col("_joined_part"))
    return dealt.join(copied, alike, "left").select(*rows.columns, *added)


def review_features(df: DataFrame, aggs: DataFrame, **join_options) -> DataFrame:
    """Each review with the aggregates of its game."""
    return attach_by_key(df, aggs, **join_options)


def leave_one_out(df: DataFrame, on_unscored: str = "zero", aggregated=None) -> DataFrame:
    """Turn attached aggregates into those of the game's other reviews.

    ``aggregated``, a condition, tells which rows went into the aggregates (default: all);
    only those are taken off, new ones have all of their game's reviews as others. A game
    without aggregates counts 0. The averages of a game without other reviews are 0. Needs the columns of
    ``game_aggregates(with_sums=True)``, made with the same ``on_unscored``.
    """
    inside = F.col("total_reviews").isNotNull() & (F.lit(True) if aggregated is None else aggregated)
    own = inside & (F.col("scored") if on_unscored == "exclude" else F.lit(True))
    up, down = (F.when(inside, flag).otherwise(0) for flag in vote_flags(F.col(VOTE)))
    others = F.coalesce("scored_reviews", F.lit(0)) - F.when(own, 1).otherwise(0)

    def count(name):
        return F.coalesce(name, F.lit(0).cast("long"))

    def average(score):
        value = F.coalesce(F.nanvl(F.col(score).cast("double"), F.lit(0.0)), F.lit(0.0))
        rest = F.col(f"sum_{score}") - F.when(own, value).otherwise(0.0)
        # Without others the difference is rounding noise, if anything.
        return F.when(others > 0, ratio(rest, others)).otherwise(0.0)

    return df.withColumns(
        {
            "avg_positive_score": average(POSITIVE_SCORE),
            "avg_negative_score": average(NEGATIVE_SCORE),
            "total_reviews": count("total_reviews") - inside.cast("int"),
            "total_positive_reviews": count("total_positive_reviews") - up,
            "total_negative_reviews": count("total_negative_reviews") - down,
        }
    ).drop(*SUM_COLUMNS)


def review_features_loo(
    df: DataFrame, aggs: DataFrame, on_unscored: str = "zero", aggregated=None, **join_options
) -> DataFrame:
    """Each review with the aggregates of its game's other reviews.

    ``aggs`` comes from ``game_aggregates(with_sums=True)``. Own values are taken
    off the sums row by row, so there is no window over a game.
    """
    missing = [c for c in [*AGGREGATE_COLUMNS, *SUM_COLUMNS] if c not in aggs.columns]
    if missing:
        raise ValueError(f"aggregates lack {missing}")
    return leave_one_out(attach_by_key(df, aggs, **join_options), on_unscored, aggregated)
