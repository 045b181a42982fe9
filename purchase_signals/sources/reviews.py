"""Parquet readers for reviews and for timestamped scoring runs."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import REVIEW_SCHEMA, STRAY_INDEX

# Fixed value: a run folder ends in _yyyyMMdd_HHmmss.
RUN_STAMP = r"_(\d{8}_\d{6})$"


def conform(df: DataFrame, schema=REVIEW_SCHEMA) -> DataFrame:
    """Give the known columns their declared types and drop the stray index.

    Columns outside ``schema`` are kept as they are, missing ones come as nulls.
    """
    declared = {f.name: f.dataType for f in schema}
    kept = [
        F.col(f"`{f.name}`").try_cast(declared[f.name]).alias(f.name)
        if f.name in declared and f.dataType != declared[f.name]
        else F.col(f"`{f.name}`")
        for f in df.schema
        if f.name != STRAY_INDEX
    ]
    absent = [
        F.lit(None).cast(t).alias(name) for name, t in declared.items() if name not in df.columns
    ]
    return df.select(*kept, *absent)


def misfits(df: DataFrame, schema=REVIEW_SCHEMA) -> dict[str, Column]:
    """For each known column of another type than declared: whether a row's value does not fit.

    These are the values that ``conform`` turns into nulls.
    """
    declared = {f.name: f.dataType for f in schema}
    return {
        f.name: F.col(f"`{f.name}`").isNotNull()
        & F.col(f"`{f.name}`").try_cast(declared[f.name]).isNull()
        for f in df.schema
        if f.name in declared and f.dataType != declared[f.name]
    }


def misfit_rows(df: DataFrame, schema=REVIEW_SCHEMA) -> DataFrame:
    """The rows with values that do not fit, as they are, and ``misfits``: the columns' names."""
    found = [F.when(wrong, F.lit(name)) for name, wrong in misfits(df, schema).items()]
    if not found:
        return df.select("*", F.array().cast("array<string>").alias("misfits")).limit(0)
    return df.withColumn("misfits", F.array_compact(F.array(*found))).where(F.size("misfits") > 0)


def misfit_counts(spark: SparkSession, path) -> dict[str, int]:
    """How many values of each known column are not of its type, where there are any.

    Files whose columns have the declared types are not read; of others those columns are.
    """
    rows = spark.read.option("mergeSchema", True).parquet(path)
    wrong = misfits(rows)
    if not wrong:
        return {}
    counts = rows.agg(*[F.count_if(c).alias(name) for name, c in wrong.items()]).first()
    return {name: n for name, n in counts.asDict().items() if n}


def read_reviews(spark: SparkSession, path, schema=None) -> DataFrame:
    """Read review Parquet. With ``schema`` only those columns are scanned.

    Without it a column that only some files have is there, null for the others, and known columns get
    their declared types. Values that do not fit these come as null; ``misfit_counts`` tells how many,
    ``misfit_rows`` sets them apart.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return conform(spark.read.option("mergeSchema", True).parquet(path))


def runs_with(spark: SparkSession, root: str, marks: Sequence[str] = ("_SUCCESS",)):
    """(stamp, path) of runs that hold one of the files ``marks``, newest first, looked at one by one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    runs = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        path = status.getPath()
        stamp = re.search(RUN_STAMP, path.getName())
        if status.isDirectory() and stamp:
            runs.append((stamp.group(1), path.toString(), path))
    for stamp, name, path in sorted(runs, key=lambda run: run[:2], reverse=True):
        if any(fs.exists(hadoop.Path(path, mark)) for mark in marks):
            yield stamp, name


def finished_runs(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(stamp, path) of each run folder below ``root`` that was written to its end.

    Goes through the Hadoop file system, so object stores work too. Only folder
    names travel to the driver.
    """
    return sorted(runs_with(spark, root))


def read_all_runs(spark: SparkSession, root: str) -> DataFrame:
    """Every finished run below ``root``, told apart by the ``run_ts`` column.

    A column that only some runs have is null in the others.
    """
    paths = [path for _, path in finished_runs(spark, root)]
    if not paths:
        raise FileNotFoundError(f"no finished run under {root}")
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d{8}_\d{6})/[^/]*$", 1)
    frame = spark.read.option("mergeSchema", True).parquet(*paths)
    return frame.select("*", folder.alias("run_ts"))


def read_latest_run(spark: SparkSession, root: str) -> DataFrame:
    """The newest finished run below ``root``; no other folder is opened."""
    for _, path in runs_with(spark, root):
        return spark.read.parquet(path)
    raise FileNotFoundError(f"no finished run under {root}")
