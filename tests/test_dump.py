"""The partitioned document source and sink, and the jobs through it."""

import datetime
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from purchase_signals.__main__ import main
from purchase_signals.sinks.parquet import append_load
from purchase_signals.sources import dump, extract_to_lake
from purchase_signals.sources.dump import register
from purchase_signals.plans import load_lines

SCHEMA = "a long, s string, d double, t timestamp, o struct<x: int, l: array<string>>, m decimal(10,2)"


@pytest.fixture
def rows(spark):
    register(spark)
    return spark.range(0, 500, numPartitions=4).selectExpr(
        "if(id % 7 = 0, null, id) AS a", "concat('é\\n\"', id) AS s", "id / 3 AS d",
        "timestamp_seconds(id) AS t", "named_struct('x', int(id), 'l', array('p', null)) AS o",
        "cast(id / 4 AS decimal(10,2)) AS m",
    )


def told(df):
    return sorted(map(str, df.collect()))


def test_what_is_written_is_read(spark, rows, tmp_path):
    path = str(tmp_path / "dump")
    rows.write.format("document_dump").mode("append").save(path)
    read = spark.read.format("document_dump").schema(SCHEMA)
    assert told(read.load(path)) == told(rows)
    # Ranges of some bytes: each line belongs to the range it begins in.
    for size in ("397", "3000"):
        got = read.option("range_bytes", size).load(path).select(*rows.columns)
        assert told(got) == told(rows)
        assert got.rdd.getNumPartitions() > 15
    rows.limit(3).write.format("document_dump").mode("append").save(path)
    assert read.load(path).count() == 503
    rows.limit(2).write.format("document_dump").mode("overwrite").save(path)
    assert read.load(path).count() == 2
    assert spark.read.format("document_dump").load(path).columns == ["a", "s", "d", "t", "o", "m"]


def test_files_without_a_commit_are_not_read(spark, rows, tmp_path):
    path = tmp_path / "dump"

    def fail(batches):
        for batch in batches:
            if batch.num_rows and batch.column(0)[-1].as_py() == 499:
                raise ValueError("lost")
            yield batch

    broken = rows.select("a").mapInArrow(fail, "a long")
    with pytest.raises(Exception, match="lost"):
        broken.write.format("document_dump").mode("append").save(str(path))
    read = spark.read.format("document_dump").schema("a long")
    assert read.load(str(path)).count() == 0
    (path / "data").mkdir(parents=True, exist_ok=True)
    (path / "data" / "stray.jsonl").write_text('{"a": 1}\n')
    rows.select("a").write.format("document_dump").mode("append").save(str(path))
    assert read.load(str(path)).count() == 500
    commits = list((path / "commits").iterdir())
    assert len(commits) == 1 and sum(f[2] for f in json.loads(commits[0].read_text())["files"]) == 500


def test_load_and_extract(spark, rows, tmp_path):
    path, lake = str(tmp_path / "dump"), str(tmp_path / "lake")
    assert append_load(rows.select("a", "s"), path, "document_dump") == 500
    assert append_load(rows.select("a", "s").limit(0), path, "document_dump") == 0
    extract_to_lake(spark, "document_dump", {"path": path, "range_bytes": "4000"}, lake, schema="a long, s string, uploaded_at timestamp")
    got = spark.read.parquet(lake)
    assert told(got.select("a", "s")) == told(rows.select("a", "s"))
    assert got.where("uploaded_at is null").count() == 0
    now = datetime.datetime.now()
    assert abs((got.agg(F.max("uploaded_at")).first()[0] - now).total_seconds()) < 24 * 3600


def test_lines_into_the_store_and_steps(spark, rows, tmp_path):
    source, out = str(tmp_path / "in.json"), str(tmp_path / "dump")
    (tmp_path / "in.json").write_text('[\n{"a":1,"s":"x"},\n{bad,\n{"a":2}\n]\n')
    result = load_lines(spark, source, out, fmt="document_dump")
    assert (result["inserted"], result["rejected"]) == (2, 1)
    assert main(["load", "--input", source, "--output", out, "--lines", "--format", "document_dump"])["inserted"] == 2
    done = main(
        ["extract", "--format", "document_dump", "--option", f"path={out}", "--schema", "a long, s string",
         "--output", str(tmp_path / "lake")]
    )
    assert sorted(map(str, spark.read.parquet(done["extracted"]).collect())) == [
        "Row(a=1, s='x')", "Row(a=1, s='x')", "Row(a=2, s=None)", "Row(a=2, s=None)",
    ]


def test_many_ranges_are_dealt_to_a_bounded_number_of_tasks(spark, rows, tmp_path):
    path = str(tmp_path / "dump")
    rows.write.format("document_dump").mode("append").save(path)
    # Some 75,000 ranges.
    read = spark.read.format("document_dump").schema(SCHEMA).option("range_bytes", "1").load(path)
    assert read.rdd.getNumPartitions() <= dump.TASKS + 4
    assert told(read) == told(rows)


def test_tasks_of_many_ranges_cover_each_byte_once():
    ranges = [dump.Range(f"f{i % 3}", j, j + 7) for i in range(3) for j in range(0, 7 * 700, 7)]
    tasks = dump._dealt(ranges)
    assert 500 < len(tasks) <= dump.TASKS
    for file in ("f0", "f1", "f2"):
        held = sorted((r.start, r.end) for t in tasks for r in t.ranges if r.file == file)
        assert [start for start, _ in held] == [0, *[end for _, end in held[:-1]]] and held[-1][1] == 4900
    # Tasks hold no more than a default range, however many that makes.
    large = dump._dealt([dump.Range("f", j << 20, (j + 1) << 20) for j in range(65_000)])
    assert {sum(r.end - r.start for r in t.ranges) for t in large[:-1]} <= {dump.RANGE_BYTES, 65 << 20}


def test_documents_are_written_as_json_dumps_has_them():
    values = pa.table({
        "f": pa.array([None, 1e300, -0.0, 3.0], pa.float64()), "s %": pa.array([None, 'é"\\\x01', "", "%s"]),
        "t": pa.array([None, 0, 1, 86400_000_000], pa.timestamp("us", "UTC")),
        "o": pa.array([None, {"x": None, "l": None}, {"x": 1, "l": ["a, b", None]}, {"x": 2, "l": []}],
                      pa.struct([("x", pa.int32()), ("l", pa.list_(pa.string()))])),
        "m": pa.array([None, [("k", 1)], [], [("k", None)]], pa.map_(pa.string(), pa.int64())),
    }).to_batches()[0]
    for batch in (values, values.slice(1, 2), values.slice(2, 0)):
        plain = [json.dumps(d, ensure_ascii=False, default=dump._written_value) for d in batch.to_pylist()]
        assert dump._lines_of(batch).decode().splitlines() == plain
