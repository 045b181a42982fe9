"""The purchase model on disk and over raw reviews."""

import json

import pytest
from pyspark.sql import functions as F

from purchase_signals.operators import (
    fit_features,
    game_aggregates,
    split_by_key,
    training_frame,
)
from purchase_signals.plans import training
from purchase_signals.plans.inputs import benchmark_scorer, reviews, reviews_fact
from purchase_signals.plans.model import (
    PREDICTED,
    PurchaseModel,
    is_purchase_model,
    load_features,
    load_purchase_model,
    predict,
    save_features,
    save_purchase_model,
    scored_columns,
)
from purchase_signals.shared import folders, read_text, write_text

SF_DIR = "/root/testdata/sf0.001"


def fitted(rows, game_as="category", others_only=False, on_unscored="zero", rounds=3):
    features = fit_features(game_aggregates(rows, on_unscored, with_sums=True), game_as=game_as)
    examples = training_frame(
        rows, features, others_only=others_only, on_unscored=on_unscored, weighted=True
    )
    trees = training.train_gbt(examples, rounds)
    return PurchaseModel(features, trees, others_only, on_unscored)


def margins(df, digits=9):
    return sorted((r["review_id"], r["label"], r["prediction"], round(r["margin"], digits)) for r in df.collect())


@pytest.fixture(scope="module")
def fact(spark):
    return reviews_fact(spark, SF_DIR).cache()


@pytest.mark.parametrize("game_as", ["category", "one_hot", "none"])
@pytest.mark.parametrize("others_only", [False, True])
def test_loaded_models_predict_raw_reviews_as_the_session_does(spark, fact, tmp_path, game_as, others_only):
    train, validation = split_by_key(fact, "review_id")
    model = fitted(train, game_as, others_only)
    frame = training_frame(validation, model.features, ["review_id"], others_only=others_only)
    here = training.predictions(model.trees, frame)
    path = str(tmp_path / "model")
    save_purchase_model(model, path)
    inside = {"aggregated": F.lit(True)} if others_only else {}
    again = training.batch_predict(validation, path, ["review_id"], **inside)
    assert again.columns == ["review_id", "label", *PREDICTED]
    assert margins(again) == margins(here)
    assert again.where("probability between 0 and 1").count() == validation.count()
    # Features encoded elsewhere go to the trees alone.
    assert margins(training.batch_predict(frame, path)) == margins(here)


def test_versions(spark, fact, tmp_path):
    path = str(tmp_path / "model")
    assert not is_purchase_model(spark, path)
    with pytest.raises(FileNotFoundError):
        load_purchase_model(spark, path)
    first = fitted(fact, rounds=1)
    assert save_purchase_model(first, path).endswith("/v1")
    second = fitted(fact, "one_hot", rounds=2)
    assert save_purchase_model(second, path).endswith("/v2")
    loaded = load_purchase_model(spark, path)
    assert loaded.features.game_as == "one_hot"
    assert loaded.features.n_games == second.features.n_games
    assert loaded.trees.stages[-1].getNumTrees == 2
    assert load_purchase_model(spark, path, version=1).trees.stages[-1].getNumTrees == 1
    # A version that was not saved to its end is passed over and its number not used again.
    third = tmp_path / "model" / "v3"
    third.mkdir()
    assert load_purchase_model(spark, path).features.game_as == "one_hot"
    assert save_purchase_model(first, path).endswith("/v4")
    manifest = tmp_path / "model" / "v4" / "manifest.json"
    write_text(spark, str(manifest), json.dumps(json.loads(manifest.read_text()) | {"format": 99}))
    with pytest.raises(ValueError, match="format 99"):
        load_purchase_model(spark, path)


def test_features_alone(spark, fact, tmp_path):
    features = fit_features(game_aggregates(fact, with_sums=True))
    save_features(features, str(tmp_path / "f"), others_only=True, on_unscored="exclude")
    loaded = load_purchase_model(spark, str(tmp_path / "f"))
    assert loaded.trees is None and loaded.others_only and loaded.on_unscored == "exclude"
    with pytest.raises(ValueError, match="no trees"):
        predict(loaded, fact)
    again = load_features(spark, str(tmp_path / "f"))
    key = lambda r: str(r["game"])
    before = sorted(features.encode_games().select("game", "features").collect(), key=key)
    assert sorted(again.encode_games().select("game", "features").collect(), key=key) == before


def test_new_reviews_need_a_game_only(spark, fact):
    model = fitted(fact)
    known = fact.where("game is not null").first()["game"]
    rows = [(1, known), (2, "a game nobody has seen"), (3, None), (4, known), (4, known)]
    got = predict(model, spark.createDataFrame(rows, "review_id int, game string"), ["review_id"])
    assert got.columns == ["review_id", *PREDICTED]
    found = {r["review_id"]: r["margin"] for r in got.collect()}
    assert got.count() == 5 and found[1] == found[4] and found[2] == found[3]
    others = fitted(fact, others_only=True)
    found = predict(others, spark.createDataFrame(rows, "review_id int, game string"), ["review_id"])
    assert found.count() == 5 and found.where("margin is null").count() == 0


def test_only_reviews_among_the_aggregates_are_left_out(spark, fact):
    """A new review sees all of its game; one of the aggregated sees the others."""
    model = fitted(fact, "none", others_only=True, rounds=5)
    rows = fact.select("review_id", "game", "voted_up", "positive_score", "negative_score")
    new = predict(model, rows, ["review_id", "game"])
    # Without its own part, every review of a game has the same features.
    assert new.select("game", "margin").distinct().count() == rows.select("game").distinct().count()
    inside = training_frame(fact, model.features, ["review_id"], others_only=True)
    want = training.predictions(model.trees, inside)
    got = predict(model, fact, ["review_id"], aggregated=F.lit(True))
    assert margins(got) == margins(want)


def test_texts_are_scored_where_the_model_looks_at_scores(spark, tmp_path):
    rows = reviews(spark, SF_DIR)
    flat = scored_columns(rows, benchmark_scorer, "exclude")
    model = fitted(flat, others_only=True, on_unscored="exclude")
    path = str(tmp_path / "model")
    save_purchase_model(model, path)
    frame = training_frame(flat, model.features, ["review_id"], others_only=True, on_unscored="exclude")
    got = training.batch_predict(
        rows, path, ["review_id"], scorer=benchmark_scorer, aggregated=F.lit(True)
    )
    assert margins(got) == margins(training.predictions(model.trees, frame))
    plan = predict(fitted(flat), rows, ["review_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "review#" not in plan.replace("review_id", "")


def test_examples_do_not_grow_as_wide_as_there_are_games(spark):
    """20,000 games as one category: six values each, and games told apart by it."""
    rows = spark.range(40_000).selectExpr(
        "id AS review_id", "concat('g', id % 20000) AS game", "id % 3 = 0 AS voted_up",
        "0.5f AS positive_score", "0.5f AS negative_score", "id % 20000 % 2 = 0 AS steam_purchase",
    )
    model = fitted(rows, rounds=1)
    vectors = model.features.encode_games().select("features")
    assert vectors.first()[0].size == 6
    got = predict(model, rows, ["review_id"])
    assert got.where("label <> prediction").count() == 0


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "a" / "file.json")
    assert read_text(spark, path) is None and folders(spark, str(tmp_path / "a")) == []
    write_text(spark, path, "é 1")
    write_text(spark, path, "é 2")
    assert read_text(spark, path) == "é 2"
    (tmp_path / "a" / "b").mkdir()
    assert folders(spark, str(tmp_path / "a")) == ["b"]


def test_intermediate_tables_are_removed(spark, tmp_path):
    from purchase_signals.shared import materialise, remove_intermediates, remove_folder

    remove_intermediates(spark)
    made = [materialise(spark.range(3), "t") for _ in range(2)]
    paths = [df.inputFiles()[0].rsplit("/", 1)[0] for df in made]
    assert remove_intermediates(spark) == 2 and remove_intermediates(spark) == 0
    assert all(read_text(spark, f"{p}/_SUCCESS") is None for p in paths)
    with pytest.raises(ValueError, match="shared folder"):
        remove_folder(spark, str(tmp_path))
