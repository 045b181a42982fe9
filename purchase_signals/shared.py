"""Tables written to the folder all executors share.

Intermediate results that a later step reads more than once are written there as
Parquet: the lineage ends at a file, a lost executor costs nothing, and Catalyst
sees the real size of the table.
"""

import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; local sessions may go without."""
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="purchase_signals-")
    spark.conf.set(_SETTING, root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call returns."""
    return f"{shared_root(spark)}/purchase_signals/{name}-{uuid.uuid4().hex}"


# What ``materialise`` has written, by application.
_intermediate: dict[str, list[str]] = {}


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    The table stays until ``remove_intermediates``: results of this library read from it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    _intermediate.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_intermediates(spark: SparkSession) -> int:
    """Remove all tables that this application has materialised; returns how many there were.

    For the end of a job, when its results are written elsewhere.
    """
    paths = _intermediate.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_folder(spark, path)
    return len(paths)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))


def _file(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    file = hadoop.Path(path)
    return hadoop, file, file.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file at once: readers find all of it, what was there before, or nothing."""
    hadoop, file, fs = _file(spark, path)
    new = hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(new)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(file):
        fs.delete(file, False)
    if not fs.rename(new, file):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    _, file, fs = _file(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove one file, if it is there."""
    _, file, fs = _file(spark, path)
    fs.delete(file, False)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove what this library has written to the shared folder."""
    if "/purchase_signals/" not in path:
        raise ValueError(f"not below the shared folder: {path}")
    _, folder, fs = _file(spark, path)
    fs.delete(folder, True)


def move_folder(spark: SparkSession, path: str, to: str | None) -> bool:
    """Put the folder ``path`` in the place of ``to``, or away if there is no such place.

    False, and ``to`` removed, if ``path`` is not there.
    """
    hadoop, folder, fs = _file(spark, path)
    if to is not None:
        target = hadoop.Path(to)
        fs.delete(target, True)
    if not fs.exists(folder):
        return False
    if not (fs.delete(folder, True) if to is None else fs.rename(folder, target)):
        raise OSError(f"cannot move {path}")
    return True


def listing(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and times of all files at or below ``path``."""
    _, folder, fs = _file(spark, path)
    files = fs.listFiles(folder, True)
    found = []
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none if it is not there."""
    _, folder, fs = _file(spark, path)
    if not fs.exists(folder):
        return []
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
