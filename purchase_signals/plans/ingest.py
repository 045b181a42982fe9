"""Small jobs around raw JSON files: a sample for a first look, and a full load."""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_json_line
from ..operators.quality import first_valid_rows, record_count
from ..operators.sampling import sample_equal_rows
from ..schema import REVIEW_SCHEMA
from ..shared import materialise, remove_folder, shared_path
from ..sinks.parquet import append_load, write_parquet
from ..sources.json_array import read_json_array
from ..sources.json_text import read_json_document, read_json_lines
from ..sources.json_variant import (
    DOCUMENT,
    LINE as CLEANED,
    inferred_schema,
    parsed_lines,
    typed_fields,
    variant_lines,
)

LINE = "_line_number"
REJECTED, UPLOADED = "rejected", "uploaded_at"


def lines_in_file_order(spark: SparkSession, path) -> DataFrame:
    """Text lines with a key that sorts them the way they stand in their files."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return spark.read.text(path).select("value", place.alias(LINE))


def sample_json(
    spark: SparkSession,
    path,
    out: str,
    first: int | None = 1000,
    n: int = 200,
    seed: int = 42,
    schema=REVIEW_SCHEMA,
) -> str:
    """Sample ``n`` of the ``first`` valid rows of JSON lines into one Parquet file.

    ``first=None`` samples from all valid rows. The columns are those of ``schema``, then all further
    fields that the rows sampled from have, typed by the rule of ``load_lines``. The draw follows from what the lines
    hold and how often: it does not change with how files are split among tasks.
    """
    lines = lines_in_file_order(spark, path)
    lines = lines.select(LINE, clean_json_line(F.col("value")).alias(CLEANED))
    parsed = parsed_lines(lines.where(~F.col(CLEANED).isin("", "[", "]")))
    valid = parsed.where(F.col(DOCUMENT).isNotNull())
    if first is not None:
        valid = first_valid_rows(valid.select(LINE, CLEANED), LINE, first)
        valid = parsed_lines(materialise(valid.select(CLEANED), "first_lines"))
    declared = _as_struct(schema or T.StructType([]))
    further = [f for f in inferred_schema(valid)[0] if f.name not in declared.names]
    fields = T.StructType([*declared, *further])
    drawn = sample_equal_rows(valid.select(CLEANED), CLEANED, n, seed)
    values, _ = typed_fields(fields)
    rows = parsed_lines(drawn).select(*[v.alias(name) for name, v in values.items()])
    return write_parquet(rows.coalesce(1), out)


def _as_struct(schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def load_lines(
    spark: SparkSession,
    path,
    target: str,
    schema=None,
    fmt: str = "parquet",
    options: dict | None = None,
) -> dict:
    """Append the JSON lines at ``path`` to ``target``, good and bad ones in one write.

    Returns ``inserted`` and ``rejected``, which together are all lines but blanks and brackets,
    ``conflicts`` and ``misfits``. Lines that are no JSON object are rejected. Without ``schema``
    all fields of all documents are kept; those that come in several types are text and named
    in ``conflicts``. With one, ``misfits`` counts per field the values that are not of its type
    and come as null.

    Lines are parsed once, and once more to infer a schema. Files are split among tasks.
    A Parquet target is parted by ``rejected``: ``read_loaded`` reads the documents and
    ``read_rejected`` the bad ``line``. Other formats get the documents only; then the single
    write goes to the shared folder, documents are appended from there, and rejected lines stay in
    the Parquet folder that ``rejected_lines`` of the result names.
    """
    parsed = variant_lines(spark, path)
    fields, conflicts = inferred_schema(parsed) if schema is None else (_as_struct(schema), [])
    clash = sorted({f.lower() for f in fields.names} & {CLEANED, REJECTED, UPLOADED})
    if clash:
        raise ValueError(f"the documents have fields named {clash}")
    values, misfits = typed_fields(fields)
    bad = F.col(DOCUMENT).isNull()
    counts = Observation(f"load-{uuid.uuid4().hex}")
    counted = parsed.observe(
        counts,
        F.count_if(~bad).alias("inserted"),
        F.count_if(bad).alias("rejected"),
        *[F.count_if(m).alias(f"misfit {i}") for i, m in enumerate(misfits.values())],
    )
    rows = counted.select(
        *[v.alias(name) for name, v in values.items()],
        F.current_timestamp().alias(UPLOADED),
        F.when(bad, F.col(CLEANED)).alias(CLEANED),
        bad.alias(REJECTED),
    )
    direct = fmt == "parquet"
    written = target if direct else shared_path(spark, "loaded")
    own = options or {} if direct else {}
    rows.write.options(**own).mode("append").partitionBy(REJECTED).parquet(written)
    found = counts.get
    result = {
        "inserted": found["inserted"],
        "rejected": found["rejected"],
        "conflicts": conflicts,
        "misfits": {
            name: found[f"misfit {i}"] for i, name in enumerate(misfits) if found[f"misfit {i}"]
        },
    }
    if not direct:
        schema = T.StructType([*fields, T.StructField(UPLOADED, T.TimestampType())])
        if found["inserted"]:
            documents = spark.read.schema(schema).parquet(f"{written}/{REJECTED}=false")
            documents.write.format(fmt).options(**(options or {})).mode("append").save(target)
            remove_folder(spark, f"{written}/{REJECTED}=false")
        if found["rejected"]:
            result["rejected_lines"] = f"{written}/{REJECTED}=true"
    return result


def read_loaded(spark: SparkSession, target: str) -> DataFrame:
    """The documents of a Parquet table that ``load_lines`` appended to, of all loads."""
    table = spark.read.option("mergeSchema", True).parquet(target)
    return table.where(F.col(REJECTED) == "false").drop(REJECTED, CLEANED)


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    """``line`` and ``uploaded_at`` of the lines that were rejected."""
    table = spark.read.parquet(target)
    return table.where(F.col(REJECTED) == "true").select(CLEANED, UPLOADED)


def load_json(
    spark: SparkSession,
    path,
    target: str,
    schema=None,
    lines: bool = False,
    fmt: str = "parquet",
    options: dict | None = None,
) -> int | dict:
    """Append the documents of JSON files to ``target``.

    Without ``lines`` each file is one strict JSON value, which raises where it is malformed; returns
    how many documents went in. Arrays larger than a partition are split among tasks. With it, files hold an object per line and are split among tasks;
    returns all that ``load_lines`` does. Without ``schema`` all fields of all documents are kept.
    """
    if lines:
        return load_lines(spark, path, target, schema, fmt, options)
    rows = _strict_documents(spark, path, schema)
    return append_load(rows, target, fmt, options)


def _strict_documents(spark: SparkSession, path, schema=None) -> DataFrame:
    """Files that one task should read are read whole; if one is larger, all are arrays and split."""
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if largest > to_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")):
        return read_json_array(spark, path, schema)
    return read_json_document(spark, path, schema)


def preview_lines(spark: SparkSession, path, n: int = 5) -> dict:
    """The first ``n`` documents of JSON lines as they stand, and how many there are and are not."""
    lines = lines_in_file_order(spark, path)
    lines = lines.select(LINE, clean_json_line(F.col("value")).alias(CLEANED))
    parsed = parsed_lines(lines.where(~F.col(CLEANED).isin("", "[", "]")))
    bad = F.col(DOCUMENT).isNull()
    counts = parsed.agg(F.count_if(~bad).alias("documents"), F.count_if(bad).alias("rejected"))
    first = first_valid_rows(parsed.where(~bad).select(LINE, CLEANED), LINE, n)
    return {**counts.first().asDict(), "first": [r[CLEANED] for r in first.collect()]}


def rejected_lines(spark: SparkSession, path, out: str, schema=REVIEW_SCHEMA) -> int:
    """Write the lines that do not parse to ``out``; return how many there are."""
    _, bad = read_json_lines(spark, path, schema)
    bad.write.mode("overwrite").text(out)
    return record_count(spark.read.text(out)).first()["records"]
