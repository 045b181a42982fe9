"""Small DataFrame helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import materialise

PIECE = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, 0 for null.

    Collapsing each word to one letter and counting those is cheaper than
    collecting the words.
    """
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.size(F.filter(F.split(spaced, " ", -1), lambda w: w != "")), F.lit(0)).cast(
        "long"
    )


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``position``: its place (0, 1, ...) in the order of ``order``.

    The rows are dealt into ranges, each range is numbered by itself, and only one
    row per range (the number of shuffle partitions bounds them) is summed up in
    one place. ``df`` should be narrow: it is written once and shuffled twice.
    """
    ranged = materialise(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.withColumn("_place", place)
        .join(F.broadcast(starts), "_range")
        .withColumn("position", F.col("_start") + F.col("_place") - 1)
        .drop("_range", "_place", "_start")
    )


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` of a function that takes one record batch and gives one.

    Batches are cut so that their texts have about ``PIECE`` bytes, which bounds what
    the function holds at a time, but for a single longer text.
    """

    def batches(found):
        for batch in found:
            for piece in pieces(batch):
                yield function(piece)

    return df.mapInArrow(batches, schema)


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            sizes += np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    number = np.cumsum(sizes) // PIECE
    starts = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(number) else []
    for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(start, end - start)
