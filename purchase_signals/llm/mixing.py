"""Mixing sources to target weights along a curriculum.

Each source has a weight schedule over the training time 0..1, here linear. Its
integral is the source's weight and sets its target of words; no source is taken more
than ``most`` times. A source's documents stand in the order of a hash; the words
before a document are its offset in the stream, and a stream that is taken several
times repeats. A document's training position is the time at which the integrated
schedule asks for its offset, and documents are sorted by ranges of it.

Offsets are sums over (source, bucket of the hash) plus a running sum inside a
bucket, so that a source with a third of all rows is spread over 4096 parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialise
from .frames import numbered


def targets(sources: DataFrame, most: float) -> DataFrame:
    """``target`` of each row of ``sources (source_size, weight)``, the excess shared again.

    The level is raised until no source is above ``most`` times its size: each turn is
    one aggregate of which only two sums come back, and there is one turn for each
    time that further sources fill up.
    """
    full = F.col("source_size") * most
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, before = 0.0, None
    while level != before:
        before = level
        filled = full < F.col("weight") * level
        sums = sources.agg(
            F.sum(F.when(filled, full)).alias("full"),
            F.sum(F.when(~filled, F.col("weight"))).alias("weight"),
        ).first()
        if not sums["weight"]:
            break
        level = (total - (sums["full"] or 0)) / sums["weight"]
    return sources.withColumn("target", F.least(full, F.col("weight") * level).cast("double"))


def moment(share: Column, start: Column, end: Column) -> Column:
    """When a linear schedule from ``start`` to ``end`` has asked for ``share`` of its integral."""
    slope, area = end - start, (start + end) / 2
    root = F.sqrt(start * start + 2 * slope * area * share)
    return F.when(slope == 0, share).otherwise((root - start) / slope)


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    drift: tuple[float, ...] = (-0.5, 0.0, 0.5),
    most: float = 3.0,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, position, positions`` of each document.

    ``size`` counts words; sources in the order of their code points, null last,
    weigh ``weights`` by turns, and their schedules run from ``1 - drift`` to ``1 + drift``
    times that. All documents are taken ``floor(target / source_size)`` times and
    those first in the stream once more, up to the target. ``position`` is that of the
    first copy, null if there is none; ``positions`` has one for each copy. A null text has size 0. Rows that repeat an
    id are ordered by size and else alike; a null id is an id. Other columns are
    passed over.
    """
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    sized = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.coalesce(F.col(source), F.lit("")).alias("source"),
            F.col(source).isNull().alias("unnamed"),
            F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
            key.alias("key"),
        ).withColumn("bucket", F.substring("key", 1, 3)),
        "sizes",
    )
    buckets = materialise(
        sized.groupBy("unnamed", "source", "bucket").agg(F.sum("size").alias("bucket_size")), "buckets"
    )
    sources = buckets.groupBy("unnamed", "source").agg(F.sum("bucket_size").alias("source_size"))
    place = (F.col("position") % len(weights) + 1).cast("int")
    sources = numbered(sources, ["unnamed", "source"], "sources").select(
        "unnamed",
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), place).alias("weight"),
        F.element_at(F.array(*map(F.lit, drift)), place).alias("drift"),
    )
    sources = targets(materialise(sources, "sources"), most)
    earlier = Window.partitionBy("unnamed", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))).join(
        sources, ["unnamed", "source"]
    )
    inside = (
        Window.partitionBy("unnamed", "source", "bucket")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts, ["unnamed", "source", "bucket"]
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio)
    offset = F.col("start") + F.col("inside")
    extra = offset + F.col("size") / 2 < (ratio - whole) * F.col("source_size")
    copies = (whole + extra.cast("long")).cast("long")

    def position(turn: Column) -> Column:
        words = offset + turn * F.col("source_size")
        share = F.when(F.col("target") > 0, F.least(words / F.col("target"), F.lit(1.0))).otherwise(0.0)
        return moment(share, 1 - F.col("drift"), 1 + F.col("drift"))

    turns = F.filter(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1), lambda t: t < copies)
    return rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).alias("taken"),
        copies.alias("copies"),
        F.when(copies > 0, position(F.lit(0))).alias("position"),
        F.transform(turns, position).alias("positions"),
    )


def joined_in_training_order(docs: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """``docs`` joined by ``key`` with ``taken (key, position)``, sorted by ranges of the position.

    Ranges are found on the narrow side and written with it, so that whole rows are
    shuffled by the join and once to their range, and never read to draw bounds.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("position").asc_nulls_last(), F.col(key).asc_nulls_last()]
    ranged = taken.repartitionByRange(parts, *order)
    ranged = materialise(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    joined = docs.join(ranged, key).repartitionById(parts, F.col("_range"))
    return joined.sortWithinPartitions(*order).drop("_range")


def in_training_order(mixed: DataFrame) -> DataFrame:
    """``mixed`` sorted by ranges of its position, rows that are not taken last."""
    order = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)
