import pytest
from pyspark.sql import functions as F

from purchase_signals.operators import (
    first_valid_rows,
    preview,
    record_count,
    sample_equal_rows,
    sample_exact,
    smallest_rows,
    split_by_key,
    split_random,
)


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("n", [0, 1, 20, 1000, 5000])
def test_sample_size(spark, n):
    df = spark.range(1000).repartition(9)
    got = ids(sample_exact(df, "id", n))
    assert len(got) == len(set(got)) == min(n, 1000)


def test_sample_does_not_depend_on_layout_but_on_the_seed(spark):
    df = spark.range(1000)
    first = ids(sample_exact(df, "id", 50))
    assert ids(sample_exact(df.repartition(13), "id", 50)) == first
    assert ids(sample_exact(df.orderBy(F.desc("id")).coalesce(1), "id", 50)) == first
    assert ids(sample_exact(df, "id", 50, seed=7)) != first


def test_sample_of_rows_without_keys_is_whole(spark):
    df = spark.range(100).withColumn("key", F.when(F.col("id") % 3 > 0, F.col("id")))
    assert len(ids(sample_exact(df, "key", 100))) == 100
    assert len(ids(sample_exact(df, "key", 60))) == 60


def test_sample_with_one_key_on_most_rows(spark):
    df = spark.range(1000).withColumn("key", F.when(F.col("id") < 700, 1).otherwise(F.col("id")))
    for n in (10, 500, 999):
        assert len(ids(sample_exact(df, "key", n))) == n


def test_first_rows_put_missing_keys_last(spark):
    df = spark.range(30).select(
        "id", F.when(F.col("id") < 10, F.col("id")).alias("key"), F.lit("x").alias("other")
    )
    assert ids(first_valid_rows(df, "key", 5)) == list(range(5))
    got = first_valid_rows(df, "key", 12)
    assert got.columns == ["id", "key", "other"]
    assert set(range(10)) <= set(ids(got)) and got.count() == 12
    assert len(ids(first_valid_rows(df, "key", 100))) == 30


def test_preview_and_count(spark):
    df = spark.range(50).repartition(5)
    assert [r["id"] for r in preview(df, "id").collect()] == [0, 1, 2, 3, 4]
    assert record_count(df).first()["records"] == 50


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(2000)
    train, val = (ids(half) for half in split_by_key(df, "id"))
    assert sorted(train + val) == list(range(2000))
    assert 0.75 < len(train) / 2000 < 0.85
    assert ids(split_by_key(df.repartition(11), "id")[0]) == train
    assert not ids(split_by_key(df, "id", 0)[0]) and not ids(split_by_key(df, "id", 100)[1])


def test_split_keeps_rows_without_keys(spark):
    df = spark.range(10).withColumn("key", F.lit(None).cast("string"))
    train, val = split_by_key(df, "key")
    assert train.count() + val.count() == 10


def test_random_split_is_complete(spark):
    train, val = (ids(half) for half in split_random(spark.range(1000).repartition(4)))
    assert sorted(train + val) == list(range(1000))
    assert 0.7 < len(train) / 1000 < 0.9


@pytest.mark.parametrize("n", [1, 3, 777, 30_000, 99_999, 100_000])
def test_the_nth_value_is_counted_out(spark, n):
    """Many partitions, a value on a third of the rows, nulls: the n-th is exact."""
    value = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 1000 == 1, None)
    rows = spark.range(0, 100_000, numPartitions=60).withColumn("v", value.otherwise(F.hash("id")))
    ordered = sorted((r["v"] is None, r["v"] or 0, r["id"]) for r in rows.collect())
    spark.conf.set("spark.sql.shuffle.partitions", "2000000")
    try:
        got = smallest_rows(rows, F.col("v"), "id", n).coalesce(1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [(r["v"] is None, r["v"] or 0, r["id"]) for r in got.collect()] == ordered[:n]


def test_ties_and_few_rows_when_counting(spark):
    rows = spark.createDataFrame([(1, "a")] * 50_000 + [(0, "z"), (2, "b")], "v int, k string")
    rows = rows.repartition(30)
    spark.conf.set("spark.sql.shuffle.partitions", "2000000")
    try:
        for n, want in ((1, {(0, "z"): 1}), (40_000, {(0, "z"): 1, (1, "a"): 39_999}), (10**6, {(0, "z"): 1, (1, "a"): 50_000, (2, "b"): 1})):
            got = smallest_rows(rows, F.col("v"), "k", n).coalesce(8)
            counts = {(r["v"], r["k"]): 0 for r in got.collect()}
            for r in got.collect():
                counts[r["v"], r["k"]] += 1
            assert counts == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_no_task_merges_more_than_it_may(spark):
    """With n = 100,000 of many partitions, no plan limits rows in one task."""
    rows = spark.range(0, 400_000, numPartitions=50).withColumn("v", F.hash("id"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = smallest_rows(rows, F.col("v"), "id", 100_000)
        plan = got._jdf.queryExecution().executedPlan().toString()
        ids_got = sorted(r["id"] for r in got.select("id").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "TakeOrdered" not in plan
    want = sorted((r["v"], r["id"]) for r in rows.collect())[:100_000]
    assert ids_got == sorted(i for _, i in want)


def test_equal_rows_are_sampled_apart(spark, monkeypatch):
    from purchase_signals.operators import sampling

    monkeypatch.setattr(sampling, "_COPIES", 100)
    texts = spark.createDataFrame([("hot",)] * 1000 + [(f"t{i}",) for i in range(1000)] + [(None,)], "x string")
    got = [r["x"] for r in sample_equal_rows(texts, "x", 400).collect()]
    assert len(got) == 400 and 150 < got.count("hot") < 250 and len(set(got)) == 401 - got.count("hot")
    again = [r["x"] for r in sample_equal_rows(texts.repartition(17), "x", 400).collect()]
    assert sorted(again) == sorted(got)
    assert sorted(r["x"] for r in sample_equal_rows(texts, "x", 5000).collect()).count("hot") == 1000
