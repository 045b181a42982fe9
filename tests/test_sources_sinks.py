from datetime import datetime

import pytest
from pyspark.sql import functions as F

from purchase_signals.operators import sentiment_label_counts
from purchase_signals.schema import REVIEW_SCHEMA
from purchase_signals.sinks import (
    append_load,
    run_path,
    write_parquet,
    write_sample,
    write_train_val,
)
from purchase_signals.sources import (
    extract_to_lake,
    finished_runs,
    parse_json_lines,
    read_all_runs,
    read_json_document,
    read_json_lines,
    read_latest_run,
    read_reviews,
)

LINES = [
    ("[", None),
    ('{"a":1,"s":"x"},', (1, "x")),
    ("   ", None),
    ("{bad},", "{bad}"),
    ("5,", "5"),
    ('{"a":2,"s":null}', (2, None)),
    ('{"a":"q","s":"kept"}', (None, "kept")),
    ('{"a":1} trailing', '{"a":1} trailing'),
    ('{"a":1},{"a":2}', '{"a":1},{"a":2}'),
    ('{"a":1}{"a":2}', '{"a":1}{"a":2}'),
    ('{"a":1}] x}', '{"a":1}] x}'),
    ("{'a':1}", "{'a':1}"),
    ("null", "null"),
    ('[{"a":3}]', '[{"a":3}]'),
    ('{"a":1,', '{"a":1'),
    ("{}", (None, None)),
    ('{"other":{"deep":[1,2]}}', (None, None)),
    ("]", None),
]


def test_json_lines_are_split_into_good_and_bad(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(LINES)], "n int, value string")
    good, bad = parse_json_lines(df, "a bigint, s string")
    expected = {i: e for i, (_, e) in enumerate(LINES)}
    assert {r["n"]: (r["a"], r["s"]) for r in good.collect()} == {
        i: e for i, e in expected.items() if isinstance(e, tuple)
    }
    assert {r["n"]: r["line"] for r in bad.collect()} == {
        i: e for i, e in expected.items() if isinstance(e, str)
    }


def test_json_lines_from_a_file(spark, tmp_path):
    path = tmp_path / "reviews.json"
    path.write_text('[\n{"game":"g","review":"r","voted_up":true},\n\n{oops,\n]\n')
    good, bad = read_json_lines(spark, str(path))
    assert good.schema == REVIEW_SCHEMA
    assert [(r["game"], r["voted_up"]) for r in good.collect()] == [("g", True)]
    assert [r["line"] for r in bad.collect()] == ["{oops"]


def test_json_document(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"a": 1},\n {"a": 2}]')
    (tmp_path / "single.json").write_text('{"a":\n 3}')
    (tmp_path / "broken.json").write_text('[{"a": 1}, {"a"')
    read = lambda name: read_json_document(spark, str(tmp_path / name), "a bigint")
    assert sorted(r["a"] for r in read("list.json").collect()) == [1, 2]
    assert [r["a"] for r in read("single.json").collect()] == [3]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read("broken.json").collect()


def test_reader_conforms_types_and_drops_the_stray_index(spark, tmp_path):
    path = str(tmp_path / "reviews")
    spark.createDataFrame(
        [("g", "text", 7, "oops", 0)],
        "game string, review string, comment_count int, author_num_reviews string, "
        "__index_level_0__ bigint",
    ).withColumn("extra", F.lit(1)).write.parquet(path)
    df = read_reviews(spark, path)
    types = dict(df.dtypes)
    assert types["comment_count"] == types["author_num_reviews"] == "bigint"
    assert types["voted_up"] == "boolean" and types["extra"] == "int"
    assert "__index_level_0__" not in df.columns
    row = df.first()
    assert (row["comment_count"], row["author_num_reviews"], row["voted_up"]) == (7, None, None)
    assert read_reviews(spark, path, "game string").columns == ["game"]


def test_latest_run_is_the_newest_finished_one(spark, tmp_path):
    root = str(tmp_path)
    for day, prefix in ((1, "zz"), (2, "run"), (3, "run")):
        path = run_path(root, prefix, datetime(2024, 5, day, 1, 2, 3))
        spark.range(day, day + 1).write.parquet(path)
        if day == 3:
            for marker in (tmp_path / path.rsplit("/", 1)[1]).glob("*_SUCCESS*"):
                marker.unlink()
    spark.range(99).write.parquet(f"{root}/no_run")
    (tmp_path / "run_20990101_000000").write_text("a file, not a folder")
    assert [stamp for stamp, _ in finished_runs(spark, root)] == [
        "20240501_010203",
        "20240502_010203",
    ]
    assert [r["id"] for r in read_latest_run(spark, root).collect()] == [2]
    assert sorted((r["id"], r["run_ts"]) for r in read_all_runs(spark, root).collect()) == [
        (1, "20240501_010203"),
        (2, "20240502_010203"),
    ]


def test_no_finished_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_latest_run(spark, str(tmp_path))


def test_extract_to_lake(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"a": 1}\n{"a": 2}\n')
    out = str(tmp_path / "lake")
    for _ in range(2):
        extract_to_lake(spark, "json", {"path": str(tmp_path / "in.json")}, out)
    assert spark.read.parquet(out).count() == 2


def test_append_load_counts_and_repeats(spark, tmp_path):
    path = str(tmp_path / "collection")
    assert append_load(spark.range(10).repartition(3), path) == 10
    assert append_load(spark.range(5), path) == 5
    df = spark.read.parquet(path)
    assert df.count() == 15 and df.where("uploaded_at IS NULL").count() == 0
    assert append_load(spark.range(0), str(tmp_path / "empty")) == 0


def test_write_parquet_is_snappy_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (3, 2):
        write_parquet(spark.range(n), path)
    assert spark.read.parquet(path).count() == 2
    assert list((tmp_path / "out").glob("*.snappy.parquet"))


def test_write_sample_makes_one_file(spark, tmp_path):
    path = write_sample(spark.range(1000).repartition(7), "id", str(tmp_path / "s"), n=20)
    assert len(list((tmp_path / "s").glob("*.parquet"))) == 1
    assert spark.read.parquet(path).count() == 20


def test_train_and_validation_folders(spark, tmp_path):
    df = spark.range(500).select("id", F.lit(1).alias("features"), F.lit(0).alias("label"))
    train, val = write_train_val(df, str(tmp_path), "id")
    assert train.endswith("/train_set") and val.endswith("/val_set")
    n, m = (spark.read.parquet(p).count() for p in (train, val))
    assert n + m == 500 and 350 < n < 450
    assert spark.read.parquet(train).columns == ["features", "label"]


def test_label_counts_include_errors(spark):
    df = spark.createDataFrame([(("ERROR",),), (("ERROR",),), (("POSITIVE",),)], "s struct<label:string>")
    got = {r["label"]: r["reviews"] for r in sentiment_label_counts(df, "s").collect()}
    assert got == {"ERROR": 2, "POSITIVE": 1}
