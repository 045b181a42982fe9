import json
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from purchase_signals.__main__ import main
from purchase_signals.operators import auc_binned, auc_exact
from purchase_signals.plans import (
    batch_predict,
    collapse_examples,
    evaluate,
    predictions,
    run,
    save_model,
    train_gbt,
)
from purchase_signals.plans.inputs import reviews, benchmark_scorer
from purchase_signals.plans.preparation import prepare, score_run
from purchase_signals.shared import materialise, shared_path, shared_root
from purchase_signals.sources import read_latest_run

SF_DIR = "/root/testdata/sf0.001"


def brute_auc(pairs):
    positive = [s for s, y in pairs if y]
    negative = [s for s, y in pairs if not y]
    wins = sum((p > n) + (p == n) / 2 for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


def scores(spark, pairs):
    return spark.createDataFrame(pairs, "score double, label int")


@pytest.fixture
def random_pairs():
    rng = random.Random(11)
    return [(rng.randrange(60) / 60, int(rng.random() < 0.4)) for _ in range(800)]


def test_auc_equals_brute_force(spark, random_pairs):
    got = auc_exact(scores(spark, random_pairs).repartition(5), "score").first()["auc"]
    assert got == pytest.approx(brute_auc(random_pairs), abs=1e-12)


def test_auc_with_most_rows_at_one_score(spark, random_pairs):
    pairs = random_pairs + [(0.5, i % 2) for i in range(3000)]
    got = auc_exact(scores(spark, pairs), "score").first()["auc"]
    assert got == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_leaves_out_rows_without_score_or_label(spark):
    pairs = [(0.1, 0), (0.9, 1), (None, 1), (0.0, None)]
    assert auc_exact(scores(spark, pairs), "score").first()["auc"] == 1.0


def test_auc_of_one_class_is_null(spark):
    assert auc_exact(scores(spark, [(0.1, 1), (0.2, 1)]), "score").first()["auc"] is None
    assert auc_exact(scores(spark, []), "score").first()["auc"] is None


def test_weights_stand_for_copies(spark, random_pairs):
    df = scores(spark, random_pairs)
    counted = df.groupBy("score", "label").agg(F.count("*").alias("n"))
    got = auc_exact(counted, "score", weight="n").first()["auc"]
    assert got == pytest.approx(brute_auc(random_pairs), abs=1e-12)


def test_exact_and_unbinned_area_agree(spark, random_pairs):
    df = scores(spark, random_pairs).withColumnRenamed("score", "rawPrediction")
    area = auc_binned(df, num_bins=0)
    assert area == pytest.approx(brute_auc(random_pairs), abs=1e-6)


@pytest.fixture(scope="module")
def examples(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(900):
        a, b = rng.randrange(6), rng.randrange(4)
        label = int(rng.random() < (0.8 if a > b else 0.2))
        rows.append((Vectors.dense(a / 6, b / 4), label))
    return spark.createDataFrame(rows, ["features", "label"]).select(
        "features", F.col("label").cast("int")
    )


def test_collapsing_keeps_every_example(examples):
    collapsed = collapse_examples(examples)
    assert collapsed.count() <= 48
    assert collapsed.agg(F.sum("weight")).first()[0] == 900
    twice = collapse_examples(collapsed.unionByName(collapsed))
    assert twice.count() == collapsed.count()
    assert twice.agg(F.sum("weight")).first()[0] == 1800


def test_weighted_fit_equals_a_fit_on_all_rows(examples):
    plain = Pipeline(stages=[GBTClassifier(maxIter=5, seed=42)]).fit(examples)
    ours = train_gbt(examples, max_iter=5)
    margins = [
        {str(r["features"]): r["margin"] for r in predictions(m, examples).collect()}
        for m in (plain, ours)
    ]
    assert margins[0].keys() == margins[1].keys()
    for key, margin in margins[0].items():
        assert margins[1][key] == pytest.approx(margin, abs=1e-9)


def test_plain_columns_are_assembled(examples):
    from pyspark.ml.functions import vector_to_array

    v = vector_to_array("features")
    flat = examples.select(v[0].alias("x"), v[1].alias("y"), "label")
    model = train_gbt(flat, max_iter=3)
    same = train_gbt(examples, max_iter=3)
    areas = [evaluate(m, df)["auc"] for m, df in ((model, flat), (same, examples))]
    assert areas[0] == pytest.approx(areas[1], abs=1e-12)
    assert 0.6 < areas[0] <= 1


def test_saved_model_predicts_the_same(spark, examples, tmp_path):
    model = train_gbt(examples, max_iter=3)
    path = save_model(model, str(tmp_path / "model"))
    save_model(model, path)
    key = lambda r: (str(r["features"]), r["label"], r["prediction"], r["margin"])
    before = sorted(map(key, predictions(model, examples).collect()))
    assert sorted(map(key, batch_predict(examples, path).collect())) == before


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source") / "reviews")
    reviews(spark, SF_DIR).write.parquet(path)
    return path


def check_report(spark, report):
    rows = [spark.read.parquet(report[p]) for p in ("train", "validation")]
    assert sum(df.count() for df in rows) == 200
    assert all(df.columns == ["features", "label"] for df in rows)
    assert report["auc"] is None or 0 <= report["auc"] <= 1
    counts = spark.read.parquet(report["label_counts"]).agg(F.sum("reviews")).first()[0]
    assert counts == 200
    again = batch_predict(rows[1], report["model"])
    assert again.where("prediction NOT IN (0, 1)").count() == 0


@pytest.mark.parametrize(
    "options",
    [
        {"key": "review_id"},
        {"others_only": True, "on_unscored": "exclude", "one_hot": False, "partitions": 3},
    ],
)
def test_whole_job(spark, source, tmp_path, options):
    report = run(spark, source, str(tmp_path), benchmark_scorer, max_iter=2, **options)
    check_report(spark, report)


def test_command_line(spark, source, tmp_path, capsys):
    out = str(tmp_path)
    words = tmp_path / "words.txt"
    words.write_text("the and is")
    score = ["score", "--input", source, "--output", f"{out}/scored", "--positive", str(words)]
    assert main(score)["scored"].startswith(f"{out}/scored/")
    halves = main(["prepare", "--input", f"{out}/scored", "--output", f"{out}/prepared"])
    paths = ["--train", halves["train"], "--validation", halves["validation"]]
    result = main(["train", *paths, "--model_output", f"{out}/model", "--max-iter", "2"])
    assert set(result) == {"auc", "auc_binned", "model"}
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == result
    report = main(["run", "--input", source, "--output", f"{out}/all", "--max-iter", "1"])
    check_report(spark, report)


def test_split_of_a_review_does_not_depend_on_the_run(spark, source, tmp_path):
    root = str(tmp_path / "scored")
    score_run(spark, source, root, benchmark_scorer)
    scored = read_latest_run(spark, root)
    counts = []
    for i, df in enumerate((scored, scored.repartition(7))):
        train, _ = prepare(df, str(tmp_path / f"out{i}"), key="review_id")
        counts.append(spark.read.parquet(train).count())
    assert counts[0] == counts[1]


def test_shared_folder_comes_from_the_session(spark):
    root = shared_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    a, b = shared_path(spark, "t"), shared_path(spark, "t")
    assert a != b and a.startswith(root)
    written = materialise(spark.range(5), "t")
    assert written.count() == 5
    assert "FileScan" in written._jdf.queryExecution().executedPlan().toString()


class FakeSession:
    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})()
        settings = {}
        get = lambda _, key, default=None: settings.get(key, default)
        put = lambda _, key, value: settings.__setitem__(key, value)
        self.conf = type("Conf", (), {"get": get, "set": put})()


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert shared_root(local) == shared_root(local)
