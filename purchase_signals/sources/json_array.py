"""JSON array files that many tasks read, however their lines are laid out.

Files are split by bytes and read up to each closing brace. Whether a range of a file
begins inside a string, and how deep, depends on all that stands before it. A
first pass sums each range up, for both cases: what it adds to the quotes and to the
depth. Running sums over these few rows say how each range begins. The second
pass knows this and cuts the ranges into whole objects; only what crosses from one range to
the next is shuffled and put together.
"""

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import materialise
from .json_variant import DOCUMENT, inferred_schema

_STRING = re.compile(r'"(?:[^"\\]+|\\.)*+"', re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]+|\\.)*+"', re.DOTALL)
_ESCAPED = re.compile(r"\\.", re.DOTALL)
_RANGE = ["file", "block"]
# Failures are those of the whole read: nothing is passed over.
_STRICT = {"mode": "FAILFAST", "allowSingleQuotes": "false"}


def _step(text: str, inside: bool) -> tuple[int, bool]:
    """What ``text`` adds to the depth, and whether a string is open at its end."""
    if inside:
        end = _STRING_END.match(text)
        if end is None:
            return 0, True
        text = text[end.end() :]
    if '"' in text:
        text = _STRING.sub("", text)
        opened = text.find('"')
        inside = opened >= 0
        text = text[:opened] if inside else text
    else:
        inside = False
    return text.count("{") + text.count("[") - text.count("]"), inside


def _by_range(batches):
    """``(file, block, texts)`` of batches in which ranges follow one another."""
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        texts = batch.column("value").to_pylist()
        first = 0
        for i in range(1, len(texts) + 1):
            if i == len(texts) or files[i] != files[first] or blocks[i] != blocks[first]:
                yield files[first], blocks[first], first, texts[first:i], batch
                first = i


def _summaries(batches):
    """One row per range: whether it holds an odd number of quotes and so ends in the other state;
    for a start outside (0) and inside (1) a string, the change of depth and the least depth after a
    closing brace. Backslashes stand in strings only, so quotes after one do not count."""
    held: dict = {}
    for file, block, _, texts, _ in _by_range(batches):
        found = held.setdefault((file, block), [0, [False, 0, None], [True, 0, None]])
        found[0] += sum(_ESCAPED.sub("", text).count('"') for text in texts)
        for case in found[1:]:
            inside, depth, least = case
            for text in texts:
                change, inside = _step(text, inside)
                depth += change
                if not inside:
                    depth -= 1
                    least = depth if least is None else min(least, depth)
            case[:] = inside, depth, least
    rows = [
        {
            "file": file, "block": block, "flips": quotes % 2 == 1,
            "depth_0": outside[1], "least_0": outside[2], "depth_1": within[1], "least_1": within[2],
        }
        for (file, block), (quotes, outside, within) in held.items()
    ]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, _SUMMARY)


_SUMMARY = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("flips", pa.bool_())]
    + [(name, pa.int64()) for name in ("depth_0", "least_0", "depth_1", "least_1")]
)


def _cut(batches):
    """Objects that lie in one range (``part`` null), and what is before and after them."""
    state = None
    out: list[dict] = []

    def emit(part):
        file, block, _, _, group, texts = state
        out.append(
            {"file": file, "block": block, "part": part, "group": group, "text": "".join(texts)}
        )
        texts.clear()

    for file, block, at, texts, batch in _by_range(batches):
        if state is None or state[:2] != [file, block]:
            if state is not None:
                emit(1)
            starts = [batch.column(c)[at].as_py() for c in ("inside", "depth", "ends_before")]
            state = [file, block, *starts, []]
            ended = False
        for text in texts:
            change, state[2] = _step(text, state[2])
            state[3] += change
            state[5].append(text)
            if not state[2]:
                state[3] -= 1
            state[5].append("}")
            if not state[2] and state[3] == 1:
                emit(None if ended else 0)
                state[4] += not ended
                ended = True
        if len(out) > 1000:
            yield pa.RecordBatch.from_pylist(out, _CUT)
            out = []
    if state is not None:
        emit(1)
        yield pa.RecordBatch.from_pylist(out, _CUT)


_CUT = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("group", pa.int64()), ("text", pa.string())]
)


def array_objects(spark: SparkSession, path) -> DataFrame:
    """``text`` of each object of the JSON arrays in the files at ``path``; raises where one is malformed."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    chunks = spark.read.option("lineSep", "}").text(path).select(*place, "value")
    summed = chunks.mapInArrow(
        _summaries,
        "file string, block long, flips boolean, depth_0 long, least_0 long, depth_1 long, least_1 long",
    )
    # One row per range of a file.
    ranges = materialise(summed, "ranges")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0))
    ranges = ranges.withColumn("inside", flips % 2 == 1)
    change = F.when(F.col("inside"), F.col("depth_1")).otherwise(F.col("depth_0"))
    least = F.when(F.col("inside"), F.col("least_1")).otherwise(F.col("least_0"))
    ranges = ranges.withColumns({"change": change, "least": least})
    depth = F.coalesce(F.sum("change").over(before), F.lit(0))
    ranges = ranges.withColumn("depth", depth)
    ends = F.coalesce((F.col("depth") + F.col("least") <= 1).cast("int"), F.lit(0))
    ranges = ranges.withColumn("ends", ends)
    ends_before = F.coalesce(F.sum("ends").over(before), F.lit(0))
    ranges = ranges.select(*_RANGE, "inside", "depth", ends_before.alias("ends_before"))
    # A few numbers for each range of maxPartitionBytes.
    placed = chunks.join(F.broadcast(materialise(ranges, "range_starts")), _RANGE)
    return _whole(placed.mapInArrow(_cut, "file string, block long, part int, group long, text string"))


def _whole(cut: DataFrame) -> DataFrame:
    cut = materialise(cut, "array_parts")
    inner = cut.where("part is null").select(F.col("text"), F.lit(False).alias("first"), F.lit(False).alias("last"))
    crossing = cut.where("part is not null").groupBy("file", "group").agg(
        F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("_p")
    )
    ends = crossing.groupBy("file").agg(F.max("group").alias("_last"))
    crossing = crossing.join(ends, "file").select(
        F.array_join("_p.text", "").alias("text"),
        (F.col("group") == 0).alias("first"),
        (F.col("group") == F.col("_last")).alias("last"),
    )
    # The end of the file comes with a brace that it does not have.
    text = F.when(F.col("last"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    parts = inner.unionByName(crossing).withColumn("text", text)
    rest = F.regexp_replace("text", F.concat(F.lit(r"^\s*"), F.when(F.col("first"), r"\[").otherwise(","), F.lit(r"\s*")), F.lit(""))
    is_object = F.startswith(rest, F.lit("{")) & (rest != F.col("text"))
    is_end = F.when(F.col("first"), F.rlike("text", F.lit(r"^\s*\[\s*\]\s*$"))).otherwise(
        F.rlike("text", F.lit(r"^\s*\]\s*$"))
    )
    fine = F.when(F.col("last"), is_end).otherwise(is_object)
    wrong = F.concat(F.lit("not an array of objects near: "), F.left("text", F.lit(80)))
    inside = F.when(fine, ~F.col("last")).otherwise(F.raise_error(wrong).cast("boolean"))
    return parts.where(inside).select(rest.alias("text"))


def read_json_array(spark: SparkSession, path, schema=None) -> DataFrame:
    """The objects of JSON array files as rows; files are split among tasks, malformed ones raise.

    Elements must be objects. Without ``schema`` all their fields are kept, by the rule of
    ``json_variant.inferred_schema``; with one, values that do not fit it raise.
    """
    objects = array_objects(spark, path)
    if schema is None:
        objects = materialise(objects, "array_objects")
        parsed = objects.withColumn(DOCUMENT, F.parse_json("text"))
        schema, _ = inferred_schema(parsed)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    row = F.explode(F.array(F.from_json("text", fields, _STRICT)))
    return objects.select(row.alias("_row")).select(*[F.col("_row").getField(f.name).alias(f.name) for f in fields])
