import json

import pytest

from purchase_signals.__main__ import main
from purchase_signals.operators import first_valid_rows
from purchase_signals.plans import load_json, sample_json
from purchase_signals.plans.ingest import LINE, lines_in_file_order
from purchase_signals.schema import REVIEW_SCHEMA
from purchase_signals.sources import parse_json_lines


@pytest.fixture
def raw(tmp_path):
    """An array file whose every tenth line is damaged."""
    lines = ["["]
    for i in range(3000):
        document = json.dumps({"game": f"g{i % 3}", "review": "r", "comment_count": i})
        lines.append("{oops," if i % 10 == 0 else document + ",")
    path = tmp_path / "raw.json"
    path.write_text("\n".join([*lines, "]"]) + "\n")
    return str(path)


VALID = [i for i in range(3000) if i % 10]


def numbers(df):
    return sorted(r["comment_count"] for r in df.collect())


def test_first_rows_follow_the_file_even_when_it_is_split(spark, raw):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = lines_in_file_order(spark, raw)
        assert lines.rdd.getNumPartitions() > 3
        good, _ = parse_json_lines(lines, REVIEW_SCHEMA)
        assert numbers(first_valid_rows(good, LINE, 1000)) == VALID[:1000]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sample_json(spark, raw, tmp_path):
    out = str(tmp_path / "sample")
    got = spark.read.parquet(sample_json(spark, raw, out))
    assert got.columns == REVIEW_SCHEMA.names
    rows = numbers(got)
    assert len(set(rows)) == 200 and set(rows) <= set(VALID[:1000])
    everything = numbers(spark.read.parquet(sample_json(spark, raw, out, first=None, n=5000)))
    assert everything == VALID


def test_load_json_documents(spark, tmp_path):
    source, target = tmp_path / "doc.json", str(tmp_path / "table")
    source.write_text('[{"a": 1},\n{"a": 2}]')
    assert load_json(spark, str(source), target) == 2
    source.write_text('{"a": 3}')
    assert load_json(spark, str(source), target) == 1
    df = spark.read.parquet(target)
    assert sorted(r["a"] for r in df.collect()) == [1, 2, 3]
    assert df.where("uploaded_at IS NULL").count() == 0


def test_command_line(spark, raw, tmp_path):
    out = str(tmp_path)
    sample = main(["sample", "--input", raw, "--output", f"{out}/sample", "--rows", "7"])
    assert spark.read.parquet(sample["sample"]).count() == 7
    loaded = main(
        ["load", "--input", raw, "--output", f"{out}/t", "--lines", "--rejected", f"{out}/bad"]
    )
    assert loaded == {"inserted": 2700, "rejected": 300}
