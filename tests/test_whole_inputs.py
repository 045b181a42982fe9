"""Nothing is lost on the way in, and odd rows and replies get what is documented."""

import json

import pytest
from pyspark.sql import functions as F

from purchase_signals.functions import lexicon_scorer, parse_score_response
from purchase_signals.operators import game_aggregates, review_features_loo, score_reviews_batch
from purchase_signals.__main__ import main
from purchase_signals.sources import read_all_runs


def test_load_lines_keeps_all_fields_and_the_bad_lines(spark, tmp_path):
    lines = ["["]
    for i in range(300):
        document = json.dumps({"game": "g", "review_id": i, **({"extra": "e"} if i == 299 else {})})
        lines.append("{oops," if i % 10 == 0 else document + ",")
    (tmp_path / "raw.json").write_text("\n".join([*lines, "]"]))
    target = str(tmp_path / "table")
    told = main(["load", "--input", str(tmp_path / "raw.json"), "--output", target, "--lines"])
    assert told == {"inserted": 270, "rejected": 30}
    loaded = spark.read.parquet(target)
    assert {"game", "review_id", "extra"} <= set(loaded.columns)
    assert loaded.where("extra = 'e'").count() == 1
    assert spark.read.text(target + "_rejected").count() == 30


def test_all_runs_keep_the_columns_of_each(spark, tmp_path):
    for stamp, column in (("20240101_000000", "old"), ("20240102_000000", "new")):
        rows = spark.createDataFrame([(1, column)], f"id int, {column} string")
        rows.write.parquet(str(tmp_path / f"run_{stamp}"))
    found = read_all_runs(spark, str(tmp_path))
    assert {"id", "old", "new", "run_ts"} == set(found.columns) and found.count() == 2


def test_scorer_reads_the_whole_text(spark):
    df = spark.createDataFrame([("x " * 5000 + "good",)], "t string")
    label = lambda **options: df.select(
        lexicon_scorer(F.col("t"), ["good"], ["x"], **options)["label"]
    ).first()[0]
    assert label() == "NEGATIVE"
    df = spark.createDataFrame([("y " * 5000 + "x x",)], "t string")
    assert (label(), label(max_chars=500)) == ("NEGATIVE", "POSITIVE")


SCHEMA = "game string, positive_score double, negative_score double, voted_up boolean"


def test_new_reviews_keep_all_others(spark):
    fitted = spark.createDataFrame([("a", 0.8, 0.2, True)], SCHEMA)
    aggs = game_aggregates(fitted, with_sums=True)
    new = spark.createDataFrame([("a", 0.1, 0.9, False), ("b", 0.1, 0.9, False)], SCHEMA)
    found = review_features_loo(new, aggs, aggregated=F.lit(False)).orderBy("game").collect()
    known, unknown = found
    assert (known.total_reviews, known.total_positive_reviews, known.total_negative_reviews) == (1, 1, 0)
    assert known.avg_positive_score == pytest.approx(0.8)
    assert (unknown.total_reviews, unknown.total_negative_reviews, unknown.avg_positive_score) == (0, 0, 0)


@pytest.mark.parametrize(
    ("reply", "label"),
    [
        ('[{"label": "POSITIVE", "score": 0.9}, "tail"]', "POSITIVE"),
        ('[{"label": "POSITIVE", "score": 0.9}] junk', "ERROR"),
        ('[{"label": null, "score": 0.9}]', "NEUTRAL"),
        ('["x"]', "ERROR"),
    ],
)
def test_odd_replies(spark, reply, label):
    df = spark.createDataFrame([(reply,)], "r string")
    assert df.select(parse_score_response(F.col("r"))["label"]).first()[0] == label


def test_batch_model_with_odd_labels_and_no_client(spark, tmp_path):
    rows = spark.createDataFrame([(i, "boom" if i == 77 else "t") for i in range(200)], "id int, review string")
    rows = rows.coalesce(1)
    calls = tmp_path / "calls"

    def model():
        def client(texts):
            with calls.open("a") as file:
                file.write("x")
            if "boom" in texts:
                raise ValueError
            return [{"label": 1, "score": 0.5} if i % 2 else {"label": "POSITIVE", "score": 1} for i in range(len(texts))]

        return client

    labels = score_reviews_batch(rows, model).groupBy("sentiment_analysis.label").count().collect()
    told = {r.label: r["count"] for r in labels}
    assert set(told) == {"POSITIVE", "ERROR"} and sum(told.values()) == 200
    assert len(calls.read_text()) <= 20
    builds = tmp_path / "builds"

    def dead():
        with builds.open("a") as file:
            file.write("x")
        raise OSError

    lost = score_reviews_batch(rows, dead).where("sentiment_analysis.label = 'ERROR'").count()
    assert lost == 200 and len(builds.read_text()) == 2
