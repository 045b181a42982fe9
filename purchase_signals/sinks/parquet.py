"""Writers. Paths are arguments and may point to any Hadoop file system."""

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import in_train, sample_exact
from ..shared import folders, move_folder, write_text

# Folder names of the two halves of a split.
TRAIN_FOLDER, VALIDATION_FOLDER = "train_set", "val_set"


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy"
) -> str:
    """Write Parquet and return the path."""
    df.write.mode(mode).option("compression", compression).parquet(path)
    return path


def run_path(root: str, prefix: str, ts: datetime | None = None) -> str:
    """``root/prefix_yyyyMMdd_HHmmss``, for now (UTC) unless ``ts`` is given."""
    ts = ts or datetime.now(timezone.utc)
    return f"{root.rstrip('/')}/{prefix}_{ts:%Y%m%d_%H%M%S}"


def new_run_path(spark: SparkSession, root: str, prefix: str) -> str:
    """``run_path`` for now, or for the first second after it that has no run yet."""
    ts = datetime.now(timezone.utc)
    taken = set(folders(spark, root))
    while run_path(root, prefix, ts).rsplit("/", 1)[1] in taken:
        ts += timedelta(seconds=1)
    return run_path(root, prefix, ts)


def write_train_val(
    df: DataFrame,
    out: str,
    key: str | Column = "review_id",
    columns: tuple[str, ...] = ("features", "label"),
    train_pct: int = 80,
) -> tuple[str, str]:
    """Split by a hash of ``key`` and write both halves of ``columns``, in one write.

    What makes up the rows, scans and joins, runs once. The halves are parts of one table,
    which are then moved to the places where readers look for them.
    """
    spark, columns = df.sparkSession, list(columns)
    folder = F.when(in_train(key, train_pct), F.lit(TRAIN_FOLDER)).otherwise(VALIDATION_FOLDER)
    rows = df.select(*columns, folder.alias("_half"))
    staged = f"{out}/_halves-{uuid.uuid4().hex}"
    rows.write.option("compression", "snappy").partitionBy("_half").parquet(staged)
    for name in (TRAIN_FOLDER, VALIDATION_FOLDER):
        if not move_folder(spark, f"{staged}/_half={name}", f"{out}/{name}"):
            write_parquet(rows.select(*columns).limit(0), f"{out}/{name}")
        write_text(spark, f"{out}/{name}/_SUCCESS", "")
    move_folder(spark, staged, None)
    return f"{out}/{TRAIN_FOLDER}", f"{out}/{VALIDATION_FOLDER}"


def append_load(df: DataFrame, path: str, fmt: str = "parquet", options: dict | None = None) -> int:
    """Append ``df`` with an ``uploaded_at`` timestamp; return how many rows went in.

    Running it again appends again. Rows are counted while they are written.
    """
    inserted = Observation(f"append-{uuid.uuid4().hex}")
    stamped = df.withColumn("uploaded_at", F.current_timestamp())
    counted = stamped.observe(inserted, F.count(F.lit(1)).alias("inserted"))
    counted.write.format(fmt).options(**(options or {})).mode("append").save(path)
    return inserted.get["inserted"]


def write_sample(
    df: DataFrame, key: str, path: str, n: int = 200, seed: int = 42, drop_key: bool = False
) -> str:
    """Write ``min(n, rows)`` sampled rows as one Parquet file."""
    sample = sample_exact(df, key, n, seed)
    sample = sample.drop(key) if drop_key else sample
    return write_parquet(sample.coalesce(1), path)
