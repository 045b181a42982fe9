"""JSON readers: a splittable line reader and a strict whole-file reader."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_json_line
from ..schema import REVIEW_SCHEMA

_STRICT = {"allowSingleQuotes": "false"}


def _as_struct(schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def parse_json_lines(
    lines: DataFrame, schema=REVIEW_SCHEMA, column: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Split the lines of a JSON array file into parsed rows and rejected lines.

    Expected is one object per line, each with an optional trailing comma, between
    bracket lines. Blank and bracket lines are dropped. A line is good if it is
    exactly one JSON object; a field whose type does not fit comes as null. Any
    further columns of ``lines`` are carried along in both results.

    Both results are lazy over the same scan.
    """
    fields = _as_struct(schema)
    carried = [c for c in lines.columns if c != column]
    text = clean_json_line(F.col(column))
    candidates = lines.select(*carried, text.alias("_line")).where(
        ~F.col("_line").isin("", "[", "]")
    )
    # JSON parsing stops at the end of the first value and ignores what follows.
    # Inside an array with a closing null, anything but a single whole value
    # changes the number of elements or breaks the array.
    wrapped = F.concat(F.lit("["), F.col("_line"), F.lit(",null]"))
    items = F.from_json(wrapped, T.ArrayType(fields), _STRICT)
    # Nothing or one parsed line; the array of one lets a line be parsed once.
    objects = F.filter(
        F.array(items), lambda i: (F.array_size(i) == 2) & F.get(i, F.lit(0)).isNotNull()
    )
    row = F.get("_items", F.lit(0))
    good = candidates.select(*carried, F.explode(objects).alias("_items")).select(
        *carried, *[row.getField(f.name).alias(f.name) for f in fields]
    )
    bad = candidates.where(F.array_size(objects) == 0).select(*carried, F.col("_line").alias("line"))
    return good, bad


def read_json_lines(
    spark: SparkSession, path, schema=REVIEW_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """``parse_json_lines`` over text files; large files are split among tasks."""
    return parse_json_lines(spark.read.text(path), schema)


def read_json_document(spark: SparkSession, path, schema=None) -> DataFrame:
    """Strict reader for files that hold one JSON value, an array or an object.

    Array elements become rows; malformed input raises. One file is one task, so
    many small files are fine and one big array belongs to ``read_json_lines``.
    """
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
