import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from purchase_signals.operators import (
    attach_by_key,
    feature_columns,
    fill_numeric,
    fit_features,
    flatten_sentiment,
    game_aggregates,
    game_index,
    purchase_label,
    review_features,
    review_features_loo,
    select_columns,
    training_frame,
    vote_split,
)
from purchase_signals.plans.inputs import reviews_fact
from purchase_signals.schema import AGGREGATE_COLUMNS, PREPARED_COLUMNS

FLAT = (
    "review_id int, game string, positive_score float, negative_score float, "
    "voted_up boolean, steam_purchase boolean, scored boolean"
)
NAN = float("nan")
ROWS = [
    (1, "a", 0.75, 0.25, True, True, True),
    (2, "a", 0.25, 0.75, False, None, True),
    (3, "a", 0.0, 0.0, None, False, False),
    (4, None, 0.5, 0.5, True, True, True),
    (5, None, 1.0, 0.0, None, True, True),
    (6, "nulls", None, None, False, False, False),
    (7, "nan", NAN, NAN, True, False, True),
    (8, "nan", 0.5, 0.5, True, True, True),
]


@pytest.fixture
def flat(spark):
    return spark.createDataFrame(ROWS, FLAT)


def by_game(df):
    return {r["game"]: tuple(r[c] for c in AGGREGATE_COLUMNS) for r in df.collect()}


def random_rows(spark, n=3000, games=40, hot=1 / 3, seed=5):
    """Reviews of which one game holds a third, and the null game some."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        game = "hot" if rng.random() < hot else rng.choice([None, *[f"g{k}" for k in range(games)]])
        p = rng.randrange(5) / 4
        flags = rng.choice([True, False, None]), rng.choice([True, False, None])
        rows.append((i, game, p, 1 - p, *flags, True))
    return rows, spark.createDataFrame(rows, FLAT)


def test_aggregates_with_nulls_nan_and_a_null_game(flat):
    assert by_game(game_aggregates(flat)) == {
        "a": (1 / 3, 1 / 3, 3, 1, 1),
        None: (0.75, 0.25, 2, 1, 0),
        "nulls": (0.0, 0.0, 1, 0, 1),
        "nan": (0.25, 0.25, 2, 2, 0),
    }


def test_aggregates_equal_those_of_the_filled_frame(flat):
    filled = flat.na.fill(0, ["positive_score", "negative_score"])
    assert by_game(game_aggregates(filled)) == by_game(game_aggregates(flat))


def test_aggregates_without_unscored_rows(flat):
    got = by_game(game_aggregates(flat, on_unscored="exclude"))
    assert got["a"] == (0.5, 0.5, 3, 1, 1)
    assert got["nulls"] == (0.0, 0.0, 1, 0, 1)
    with pytest.raises(ValueError):
        game_aggregates(flat, on_unscored="drop")


def test_select_flatten_and_fill(spark):
    sentiment = "struct<label:string,score:float,positive_score:float,negative_score:float>"
    numbers = [c for c in PREPARED_COLUMNS if c.startswith("author") or c == "comment_count"]
    ddl = ", ".join(
        [f"{c} bigint" for c in numbers]
        + ["game string, language string, steam_purchase boolean, voted_up boolean"]
        + [f"sentiment_analysis {sentiment}", "other int"]
    )
    empty = [None] * len(numbers)
    rows = [
        (*empty, "g", None, None, None, ("POSITIVE", 0.75, 0.75, 0.25), 1),
        (*empty, "g", None, None, None, ("ERROR", 0.0, 0.0, 0.0), 1),
        (*empty, "g", None, None, None, ("NEUTRAL", 0.0, 0.0, 0.0), 1),
        (*empty, "g", None, None, None, ("NEUTRAL", 0.5, 0.5, 0.5), 1),
        (*empty, "g", None, None, None, None, 1),
    ]
    df = select_columns(spark.createDataFrame(rows, ddl).coalesce(1))
    assert df.columns == PREPARED_COLUMNS
    out = fill_numeric(flatten_sentiment(df, with_scored=True)).collect()
    assert [r["scored"] for r in out] == [True, False, False, True, False]
    assert [r["positive_score"] for r in out] == [0.75, 0, 0, 0.5, 0]
    assert all(r[c] == 0 for r in out for c in numbers)
    assert all(r["language"] is None and r["voted_up"] is None for r in out)


def test_purchase_label(spark):
    flags = spark.createDataFrame([(True,), (False,), (None,)], "x boolean").coalesce(1)
    assert [r[0] for r in flags.select(purchase_label(F.col("x"))).collect()] == [1, 0, 0]
    texts = spark.createDataFrame([("1",), ("yes",), (None,)], "x string").coalesce(1)
    assert [r[0] for r in texts.select(purchase_label(F.col("x"))).collect()] == [1, 0, 0]


def test_vote_split_and_feature_columns(flat):
    up, down = vote_split(flat)
    ids = [sorted(r["review_id"] for r in half.collect()) for half in (up, down)]
    assert ids == [[1, 4, 7, 8], [2, 6]]
    assert "steam_purchase" not in feature_columns(flat, "steam_purchase")
    assert len(feature_columns(flat, "steam_purchase")) == 6


@pytest.mark.parametrize("broadcast_bytes, hot_share", [(1 << 20, None), (0, None), (0, 10), (0, 1), (0, 10**9)])
def test_attach_gives_the_same_on_every_path(spark, broadcast_bytes, hot_share):
    rows, df = random_rows(spark)
    # A game that rows have and the table lacks, and the other way round.
    table = {None: 1, "hot": 2, "extra": 3, **{f"g{k}": 10 + k for k in range(1, 40)}}
    per_game = spark.createDataFrame(list(table.items()), "game string, v int")
    out = attach_by_key(df, per_game, broadcast_bytes=broadcast_bytes, hot_share=hot_share)
    assert out.columns == [*df.columns, "v"]
    got = {r["review_id"]: r["v"] for r in out.collect()}
    assert out.count() == len(rows)
    assert got == {r[0]: table.get(r[1]) for r in rows}


def test_attach_keeps_a_hot_game_that_the_table_lacks(spark):
    rows, df = random_rows(spark)
    per_game = spark.createDataFrame([("g1", 1)], "game string, v int")
    out = attach_by_key(df, per_game, broadcast_bytes=0, hot_share=10)
    assert out.count() == len(rows)
    assert {r["game"] for r in out.where("v = 1").select("game").distinct().collect()} == {"g1"}


def test_attach_of_empty_frames(spark):
    _, df = random_rows(spark, n=10)
    per_game = spark.createDataFrame([("hot", 1)], "game string, v int")
    for limit in (0, 1 << 20):
        assert attach_by_key(df.limit(0), per_game, broadcast_bytes=limit).count() == 0
        none = attach_by_key(df, per_game.limit(0), broadcast_bytes=limit)
        assert none.where("v IS NULL").count() == 10


def test_reviews_are_not_shuffled_when_aggregates_are_small(spark):
    rows = reviews_fact(spark, "/root/testdata/sf0.001").drop("steam_purchase")
    out = review_features(rows, game_aggregates(rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def brute_loo(rows, exclude=False):
    out = {}
    for r in rows:
        others = [o for o in rows if o[1] == r[1] and o[0] != r[0]]
        counted = [o for o in others if o[6]] if exclude else others

        def mean(i):
            values = [0 if o[i] is None or math.isnan(o[i]) else o[i] for o in counted]
            return round(sum(values) / len(values), 6) if values else 0.0

        ups = sum(o[4] is True for o in others)
        downs = sum(o[4] is False for o in others)
        out[r[0]] = (mean(2), mean(3), len(others), ups, downs)
    return out


def loo_rows(df):
    return {
        r["review_id"]: (
            round(r["avg_positive_score"], 6),
            round(r["avg_negative_score"], 6),
            r["total_reviews"],
            r["total_positive_reviews"],
            r["total_negative_reviews"],
        )
        for r in df.collect()
    }


@pytest.mark.parametrize("on_unscored", ["zero", "exclude"])
def test_leave_one_out_equals_brute_force(flat, on_unscored):
    aggs = game_aggregates(flat, on_unscored, with_sums=True)
    got = loo_rows(review_features_loo(flat, aggs, on_unscored))
    assert got == brute_loo(ROWS, on_unscored == "exclude")


def test_leave_one_out_with_a_hot_game(spark):
    rows, df = random_rows(spark, n=400)
    aggs = game_aggregates(df, with_sums=True)
    out = review_features_loo(df, aggs, broadcast_bytes=0, hot_share=10)
    assert loo_rows(out) == brute_loo(rows)


def test_leave_one_out_needs_sums(flat):
    with pytest.raises(ValueError, match="sum_positive_score"):
        review_features_loo(flat, game_aggregates(flat))


def test_game_index_equals_string_indexer(spark):
    _, df = random_rows(spark, n=500)
    named = df.where("game IS NOT NULL").select("game")
    indexed = StringIndexer(inputCol="game", outputCol="i").fit(named).transform(named)
    expected = {r["game"]: int(r["i"]) for r in indexed.distinct().collect()}
    got = game_index(df)
    assert {r["game"]: r["game_index"] for r in got.collect()} == expected
    assert got.count() == len(expected)


def reference_vectors(aggs):
    """The usual stages: everything assembled, then scaled together."""
    stages = [
        StringIndexer(inputCol="game", outputCol="index", handleInvalid="keep"),
        OneHotEncoder(inputCol="index", outputCol="one_hot"),
        VectorAssembler(inputCols=[*AGGREGATE_COLUMNS, "one_hot"], outputCol="raw"),
        MinMaxScaler(inputCol="raw", outputCol="all_scaled"),
    ]
    rows = Pipeline(stages=stages).fit(aggs).transform(aggs).collect()
    return {r["game"]: [round(v, 12) for v in r["all_scaled"].toArray()] for r in rows}


def own_vectors(model):
    rows = model.encode_games().collect()
    return {r["game"]: [round(v, 12) for v in r["features"].toArray()] for r in rows}


def test_vectors_equal_scaling_everything_together(spark, flat):
    _, df = random_rows(spark, n=300)
    for frame in (df, flat, flat.where("game = 'a' OR game IS NULL")):
        aggs = game_aggregates(frame)
        assert own_vectors(fit_features(aggs)) == reference_vectors(aggs)


def test_vectors_of_a_single_game(flat):
    aggs = game_aggregates(flat.where("game = 'a'"))
    assert own_vectors(fit_features(aggs)) == reference_vectors(aggs) == {"a": [0.5] * 6}


def test_vectors_of_only_a_null_game(flat):
    model = fit_features(game_aggregates(flat.where("game IS NULL")))
    assert own_vectors(model) == {None: [0.5] * 5}


def test_vectors_without_one_hot(flat):
    model = fit_features(game_aggregates(flat), one_hot=False)
    assert {len(v) for v in own_vectors(model).values()} == {5}


def test_training_frame_by_review(spark, flat):
    model = fit_features(game_aggregates(flat))
    frame = training_frame(flat, model, keep=["review_id", "game"])
    assert frame.schema["features"].metadata == {}
    rows = frame.collect()
    vectors = own_vectors(model)
    assert {r["review_id"]: r["label"] for r in rows} == {
        r[0]: int(r[5] or 0) for r in ROWS
    }
    for r in rows:
        assert [round(v, 12) for v in r["features"].toArray()] == vectors[r["game"]]


def test_unseen_games_get_the_vector_of_no_game(spark, flat):
    model = fit_features(game_aggregates(flat))
    new = spark.createDataFrame([(9, "new", 0.5, 0.5, True, None, True)], FLAT)
    features = training_frame(new, model).first()["features"].toArray()
    assert list(features[5:]) == [0.0] * 3


def test_training_frame_by_game(flat):
    model = fit_features(game_aggregates(flat))
    labels = [r["label"] for r in training_frame(flat, model, grain="game").collect()]
    assert sorted(labels) == [0, 0, 1, 1]
    with pytest.raises(ValueError):
        training_frame(flat, model, grain="author")


def test_weighted_frame_holds_every_review(spark):
    _, df = random_rows(spark, n=500)
    model = fit_features(game_aggregates(df, with_sums=True))
    for others in (False, True):
        plain = training_frame(df, model, others_only=others)
        weighted = training_frame(df, model, others_only=others, weighted=True)
        expected = {
            (str(r["features"]), r["label"]): r["count"]
            for r in plain.groupBy("features", "label").count().collect()
        }
        got = {(str(r["features"]), r["label"]): r["weight"] for r in weighted.collect()}
        assert got == expected


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_reviews_are_read_once_on_both_sides_of_the_size_switch(spark, tmp_path, broadcast_bytes):
    """Plans hold one scan of the reviews; a hot game's rows go to many parts."""
    random_rows(spark, hot=0.6)[1].write.parquet(str(tmp_path / "reviews"))
    df = spark.read.parquet(str(tmp_path / "reviews"))
    aggs = game_aggregates(df, with_sums=True)
    model = fit_features(aggs)
    join = {"broadcast_bytes": broadcast_bytes, "hot_share": 10}
    for frame in (
        review_features_loo(df, aggs, **join),
        training_frame(df, model, others_only=True, **join),
        training_frame(df, model, **join),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and "steam_purchase" in line]
        assert len(scans) == 1
        assert frame.count() == df.count()


def test_a_hot_game_is_dealt_to_several_parts(spark):
    df = spark.range(0, 8000, numPartitions=16).selectExpr("id AS review_id", "if(id % 2 = 0, 'hot', concat('g', id)) AS game")
    per_game = df.groupBy("game").agg(F.count("*").alias("total_reviews"))
    # Parts are those of a cluster whose shuffle partitions stay apart.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach_by_key(df, per_game, broadcast_bytes=0, hot_share=10)
        tasks = joined.where("game = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1 and joined.where("total_reviews = 4000").count() == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_both_halves_come_from_one_pass(spark, tmp_path):
    from purchase_signals.sinks.parquet import write_train_val

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(3000).selectExpr("id AS review_id", "cast(id % 2 AS int) AS label").mapInArrow(
        count, "review_id long, label int"
    )
    for share, sizes in ((80, None), (100, (3000, 0)), (0, (0, 3000))):
        before = seen.value
        paths = write_train_val(rows, str(tmp_path / "out"), "review_id", ("review_id", "label"), share)
        got = [spark.read.parquet(p) for p in paths]
        counts = tuple(df.count() for df in got)
        assert sum(counts) == 3000 and (sizes is None or counts == sizes)
        assert all(df.columns == ["review_id", "label"] for df in got)
        if sizes is None:
            assert seen.value - before == 3000
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["train_set", "val_set"]
