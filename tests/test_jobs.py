"""Scoring with a model of one's own, taking over answers, and jobs that go on where they ended."""

import json

import pytest
from pyspark.sql import functions as F

from purchase_signals.__main__ import main
from purchase_signals.operators.rescoring import ASKED, score_again
from purchase_signals.plans import jobs, preparation
from purchase_signals.plans.inputs import benchmark_scorer, reviews
from purchase_signals.plans.preparation import TooManyErrors, latest_scored, score_run
from purchase_signals.schema import SENTIMENT
from purchase_signals.shared import write_text
from purchase_signals.sources import finished_runs, read_latest_run

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "review_id long, game string, review string, comment_count long"
ROWS = [(1, "a", "fine", 1), (2, "a", "bad one", 2), (3, "b", "bad two", 3), (4, None, None, 4), (5, "b", "", 5)]


def clients():
    """Made within a function, so that they travel to the tasks as they are."""

    def make_picky():
        # Has no answer for texts with 'bad'.
        return lambda texts: [None if "bad" in t else {"label": "POSITIVE", "score": 0.75} for t in texts]

    def make_second():
        return lambda texts: [{"label": "NEGATIVE", "score": 0.5} for _ in texts]

    def make_none():
        raise RuntimeError("no model")

    return make_picky, make_second, make_none


make_picky, make_second, make_none = clients()


def answers(df):
    return {r["review_id"]: (r[SENTIMENT]["label"], r[SENTIMENT]["score"]) for r in df.collect()}


@pytest.fixture
def source(spark, tmp_path):
    def write(rows, name="source", schema=SCHEMA):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)
        return path

    return write


def test_a_second_run_asks_for_what_is_new_changed_or_failed(spark, source, tmp_path):
    root, first, second = str(tmp_path / "runs"), {}, {}
    score_run(spark, source(ROWS), root, make_client=make_picky, report=first)
    assert first == {"rows": 5, "asked": 5, "errors": 2}
    changed = [
        (1, "renamed", "fine", 9),  # the text is the same: its answer stays
        (2, "a", "bad one", 2),  # failed before
        (4, None, None, 4), (5, "b", "now a text", 5), (6, "c", "new", 6),  # 3 is gone
    ]
    path = score_run(
        spark, source(changed), root, make_client=make_second, key="review_id", resume=True, report=second
    )
    got = spark.read.parquet(path)
    assert second == {"rows": 5, "asked": 3, "errors": 0}
    assert answers(got) == {
        1: ("POSITIVE", 0.75), 2: ("NEGATIVE", 0.5), 4: ("NEUTRAL", 0.0), 5: ("NEGATIVE", 0.5), 6: ("NEGATIVE", 0.5),
    }
    assert got.where("review_id = 1").first()["game"] == "renamed"
    assert ASKED not in got.columns
    third = {}
    score_run(spark, source(changed), root, make_client=make_none, key="review_id", resume=True, report=third)
    assert third == {"rows": 5, "asked": 0, "errors": 0}


def test_rows_without_a_key_and_other_columns(spark, source, tmp_path):
    root, report = str(tmp_path / "runs"), {}
    rows = [(None, "a", "fine", 1), (None, "a", "fine", 1), (7, "a", "fine", 1)]
    score_run(spark, source(rows), root, make_client=make_picky)
    wider = source([(*r, "en") for r in rows], schema=SCHEMA + ", extra string")
    path = score_run(spark, wider, root, make_client=make_second, key="review_id", resume=True, report=report)
    got = spark.read.parquet(path)
    assert report == {"rows": 3, "asked": 2, "errors": 0}
    assert got.where("extra = 'en'").count() == 3
    labels = sorted((str(r["review_id"]), r[SENTIMENT]["label"]) for r in got.collect())
    assert labels == [("7", "POSITIVE"), ("None", "NEGATIVE"), ("None", "NEGATIVE")]


def test_a_key_that_repeats_is_refused(spark, source, tmp_path):
    root = str(tmp_path / "runs")
    score_run(spark, source(ROWS), root, make_client=make_picky)
    twice = source([(9, "a", "x", 1), (9, "a", "y", 1)])
    with pytest.raises(ValueError, match="review_id repeats"):
        score_run(spark, twice, root, make_client=make_second, key="review_id", resume=True)
    with pytest.raises(ValueError, match="needs a key"):
        score_run(spark, twice, root, resume=True)


def test_empty_tables(spark, source, tmp_path):
    root, report = str(tmp_path / "runs"), {}
    score_run(spark, source([]), root, make_client=make_picky, max_error_share=0.0, report=report)
    assert report == {"rows": 0, "asked": 0, "errors": 0}
    score_run(spark, source(ROWS), root, make_client=make_picky, key="review_id", resume=True, report=report)
    assert report == {"rows": 5, "asked": 5, "errors": 2}
    score_run(spark, source([]), root, make_client=make_picky, key="review_id", resume=True, report=report)
    assert report == {"rows": 0, "asked": 0, "errors": 0}


def test_texts_stay_where_they_are_when_little_differs(spark):
    """Whole rows are joined to broadcast keys: no exchange carries a text."""
    rows = spark.range(5000).selectExpr("id AS review_id", "concat('text ', id) AS review")
    before = preparation.score_reviews(rows, benchmark_scorer)
    changed = rows.withColumn("review", F.expr("if(review_id < 9, 'other', review)"))
    got = score_again(changed, before, "review_id", lambda df: preparation.score_reviews(df, benchmark_scorer))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert got.where(ASKED).count() == 9 and got.count() == 5000


def test_too_many_errors_end_the_step_and_the_next_run_takes_over(spark, source, tmp_path):
    root, report = str(tmp_path / "runs"), {}
    path = source(ROWS)
    with pytest.raises(TooManyErrors) as raised:
        score_run(spark, path, root, make_client=make_picky, max_error_share=0.3)
    assert (raised.value.errors, raised.value.rows) == (2, 5)
    assert finished_runs(spark, root) == []
    assert latest_scored(spark, root).rstrip("/").endswith(raised.value.path.rsplit("/", 1)[1])
    score_run(
        spark, path, root, make_client=make_second, key="review_id", resume=True,
        max_error_share=0.0, report=report,
    )
    assert report == {"rows": 5, "asked": 2, "errors": 0}
    assert answers(read_latest_run(spark, root))[1] == ("POSITIVE", 0.75)
    score_run(spark, path, root, make_client=make_picky, max_error_share=0.4)


def test_values_that_do_not_fit_are_counted_and_set_apart(spark, source, tmp_path):
    from purchase_signals.sources import misfit_rows, read_reviews

    rows = [(1, "a", "fine", "many", "yes"), (2, "b", "x", "3", "no"), (3, "c", "y", None, "perhaps"), (4, "d", "z", "1.5", None)]
    path = source(rows, schema="review_id long, game string, review string, comment_count string, voted_up string")
    report = {}
    score_run(spark, path, str(tmp_path / "runs"), make_client=make_second, report=report)
    assert report == {"rows": 4, "asked": 4, "errors": 0, "misfits": {"comment_count": 2, "voted_up": 1}}
    again = {}
    score_run(spark, path, str(tmp_path / "runs"), make_client=make_none, key="review_id", resume=True, report=again)
    assert again["asked"] == 0 and again["misfits"] == report["misfits"]
    apart = misfit_rows(spark.read.parquet(path)).orderBy("review_id").collect()
    assert [(r["review_id"], r["misfits"]) for r in apart] == [(1, ["comment_count"]), (3, ["voted_up"]), (4, ["comment_count"])]
    assert misfit_rows(read_reviews(spark, path)).count() == 0


def test_runs_of_one_second_do_not_collide(spark, source, tmp_path):
    root, path = str(tmp_path / "runs"), source(ROWS[:1])
    assert len({score_run(spark, path, root) for _ in range(3)}) == 3


@pytest.fixture
def all_reviews(spark, tmp_path):
    path = str(tmp_path / "reviews")
    reviews(spark, SF_DIR).write.parquet(path)
    return path


OPTIONS = {"max_iter": 1, "key": "review_id", "game_as": "category"}


def test_a_job_goes_on_with_the_first_step_not_done(spark, all_reviews, tmp_path, monkeypatch):
    out = str(tmp_path / "job")

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "train_gbt", broken)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.run(spark, all_reviews, out, benchmark_scorer, **OPTIONS)
    assert len(finished_runs(spark, f"{out}/scored")) == 1
    report = jobs.run(spark, all_reviews, out, benchmark_scorer, **OPTIONS)
    assert report["steps_reused"] == ["score", "prepare"]
    assert len(finished_runs(spark, f"{out}/scored")) == 1
    predicted = spark.read.parquet(report["predictions"])
    assert predicted.agg(F.sum("weight")).first()[0] == spark.read.parquet(report["validation"]).count()
    # Settings or inputs that change are noticed by the steps they concern.
    manifest = json.loads((tmp_path / "job" / "job.json").read_text())
    assert manifest["finished"] and list(manifest["steps"]) == ["score", "prepare", "train", "evaluate"]
    write_text(spark, f"{out}/job.json", json.dumps(manifest | {"finished": False}))
    report = jobs.run(spark, all_reviews, out, benchmark_scorer, **(OPTIONS | {"max_iter": 2}))
    assert report["steps_reused"] == ["score", "prepare"]
    write_text(spark, f"{out}/job.json", json.dumps(manifest | {"finished": False}))
    report = jobs.run(spark, all_reviews, out, **OPTIONS)
    assert report["steps_reused"] == []
    # A finished job starts anew.
    report = jobs.run(spark, all_reviews, out, **OPTIONS)
    assert report["steps_reused"] == [] and len(finished_runs(spark, f"{out}/scored")) == 3


def test_a_job_with_too_many_errors_asks_again_for_these(spark, source, tmp_path):
    rows = [(i, f"g{i % 3}", "bad" if i % 4 == 0 else "fine", i, i % 3 == 0) for i in range(40)]
    path = source(
        [(*r, True) for r in rows], schema=SCHEMA + ", steam_purchase boolean, voted_up boolean"
    )
    out = str(tmp_path / "job")
    with pytest.raises(TooManyErrors):
        jobs.run(spark, path, out, make_client=make_picky, max_error_share=0.1, **OPTIONS)
    report = jobs.run(spark, path, out, make_client=make_second, max_error_share=0.1, **OPTIONS)
    assert (report["rows"], report["asked"], report["errors"]) == (40, 10, 0)


def test_command_line(spark, all_reviews, tmp_path, monkeypatch):
    (tmp_path / "own_model.py").write_text(
        "def make():\n    return lambda texts: [{'label': 'POSITIVE', 'score': 0.9}] * len(texts)\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "own_model.py"))
    out = str(tmp_path)
    score = ["score", "--input", all_reviews, "--output", f"{out}/scored", "--client", "own_model:make"]
    result = main([*score, "--max-error-share", "0"])
    assert (result["rows"], result["asked"], result["errors"]) == (200, 200, 0)
    again = main([*score, "--resume", "--key", "review_id"])
    assert (again["rows"], again["asked"]) == (200, 0)
    halves = main(["prepare", "--input", f"{out}/scored", "--output", f"{out}/p", "--key", "review_id", "--game-as", "category"])
    trained = main(
        ["train", "--train", halves["train"], "--validation", halves["validation"], "--max-iter", "1",
         "--features", halves["features"], "--model_output", f"{out}/model"]
    )
    predicted = main(["predict", "--input", all_reviews, "--model", trained["model"], "--output", f"{out}/new", "--key", "review_id"])
    rows = spark.read.parquet(predicted["predictions"])
    assert rows.count() == 200 and rows.columns == ["review_id", "label", "prediction", "margin", "probability"]
    with pytest.raises(ValueError, match="module:function"):
        main(["score", "--input", all_reviews, "--output", f"{out}/x", "--client", "own_model"])
