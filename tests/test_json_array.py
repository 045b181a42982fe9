"""Array files that many tasks read: equal to reading them whole, malformed ones raise."""

import json
import random

import pytest
from pyspark.sql import functions as F

from purchase_signals.plans import load_json
from purchase_signals.sources import read_json_array, read_json_document
from purchase_signals.sources.json_array import array_objects

SCHEMA = "a long, s string, o struct<b: string, l: array<struct<x: long>>>"


def documents(n, seed=1):
    draw = random.Random(seed)
    odd = ['}', '{', '"', '\\', '}]', '[{', '\\"}', 'é}\n', '', '\t', '],{"a":1}', '\\\\']
    made = []
    for i in range(n):
        text = "".join(draw.choices(odd, k=draw.randrange(6)))
        items = [{"x": j} for j in range(draw.randrange(4))]
        made.append({"a": i, "s": text * draw.choice([1, 1, 40]), "o": {"b": text, "l": items}})
    return made


def laid_out(rows, layout):
    if layout == "one line":
        return json.dumps(rows)
    if layout == "indented":
        return json.dumps(rows, indent=2, ensure_ascii=False)
    if layout == "a line each":
        return "[\n" + ",\n".join(json.dumps(r) for r in rows) + "\n]\n"
    return " [ " + " , ".join(json.dumps(r, separators=(" ,", " : ")) for r in rows) + " ] "


@pytest.fixture
def split(spark):
    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield at
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def told(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("layout", ["one line", "indented", "a line each", "blanks"])
def test_equal_to_reading_files_whole(spark, tmp_path, split, layout):
    for n, name in ((100, "a.json"), (1, "b.json"), (0, "c.json"), (37, "d.json")):
        (tmp_path / name).write_text(laid_out(documents(n, n), layout), encoding="utf-8")
    want = told(read_json_document(spark, str(tmp_path), SCHEMA))
    assert len(want) == 138
    for size in (3000, 1 << 27):
        split(size)
        assert told(read_json_array(spark, str(tmp_path), SCHEMA)) == want
    split(3000)
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 5
    wide = read_json_array(spark, str(tmp_path))
    assert told(wide.select("a", "s", F.struct("o.b", "o.l").alias("o"))) == want


def test_objects_longer_than_a_range(spark, tmp_path, split):
    rows = [{"a": i, "s": "} ] \" \\ {" * 400} for i in range(3)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    split(1000)
    got = [json.loads(r["text"]) for r in array_objects(spark, str(tmp_path)).collect()]
    assert sorted(got, key=lambda r: r["a"]) == rows


# One test for all: each takes several jobs.
MALFORMED = [
    '[{"a":1}', '[{"a":1},', '[{"a":1},]', '[{"a":1} {"a":2}]', '[,{"a":1}]', '{"a":1}]', '[{"a":1}]]', "[", "x",
    '[{"a":1}] x', '[{"a":1},5]', "[5]", '[{"a":1}],[{"a":2}]', '[{"a":[1}]', '[{"a":1]}', '[{"a":"x}]', "[{'a':1}]",
    '[{"a":1},,{"a":2}]', '[[{"a":1}]]', '[{"a":01}]', '[{"a"}]', '[{"s":"\\}"}]',
]


def test_malformed_files_raise(spark, tmp_path, split):
    split(16)
    for i, text in enumerate(MALFORMED):
        (tmp_path / f"bad{i}.json").write_text(text)
        with pytest.raises(Exception):  # noqa: B017
            print(text, read_json_array(spark, str(tmp_path / f"bad{i}.json"), SCHEMA).collect())


def test_loading_an_array(spark, tmp_path, split):
    (tmp_path / "a.json").write_text(laid_out(documents(300), "one line"))
    split(2000)
    assert load_json(spark, str(tmp_path / "a.json"), str(tmp_path / "t")) == 300
    got = spark.read.parquet(str(tmp_path / "t"))
    assert got.agg(F.sum("a")).first()[0] == sum(range(300))
