import pytest
from pyspark.sql import functions as F

from purchase_signals.functions import polarity
from purchase_signals.operators import (
    score_reviews,
    score_reviews_batch,
    sentiment_label_counts,
)
from purchase_signals.schema import SENTIMENT, SENTIMENT_TYPE

ROWS = [(1, "fine"), (2, "boom"), (3, None), (4, ""), (5, "odd"), (6, "short of a label")]


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(ROWS, "id int, review string").coalesce(1)


def scored(df):
    return {
        r["id"]: (r["s"]["label"], *[round(v, 6) for v in r["s"][1:]])
        for r in df.select("id", F.col(SENTIMENT).alias("s")).collect()
    }


def client_factory():
    # Functions made inside a function reach the workers without this module.
    def make_client():
        def client(texts):
            answers = {
                "fine": {"label": "POSITIVE", "score": 0.75},
                "odd": "not an object",
                "short of a label": {"score": 0.75},
            }
            if "boom" in texts:
                raise RuntimeError("boom")
            assert "" not in texts and None not in texts
            return [answers[t] for t in texts]

        return client

    return make_client


make_client = client_factory()


def test_failing_texts_become_errors_and_spare_the_rest_of_their_batch(reviews):
    result = score_reviews_batch(reviews, make_client)
    assert result.schema[SENTIMENT].dataType == SENTIMENT_TYPE
    assert scored(result) == {
        1: ("POSITIVE", 0.75, 0.75, 0.25),
        2: ("ERROR", 0, 0, 0),
        3: ("NEUTRAL", 0, 0, 0),
        4: ("NEUTRAL", 0, 0, 0),
        5: ("ERROR", 0, 0, 0),
        6: ("NEUTRAL", 0.75, 0.25, 0.25),
    }


def test_client_that_cannot_be_made_gives_errors(reviews):
    def broken():
        raise OSError("no route")

    labels = {k: v[0] for k, v in scored(score_reviews_batch(reviews, broken)).items()}
    expected = {1: "ERROR", 2: "ERROR", 3: "NEUTRAL", 4: "NEUTRAL", 5: "ERROR", 6: "ERROR"}
    assert labels == expected


def test_client_is_made_once_per_task(spark):
    def make():
        state = {"calls": 0}

        def client(texts):
            state["calls"] += 1
            return [{"label": "POSITIVE", "score": float(state["calls"])} for _ in texts]

        return client

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(95).select("id", F.lit("x").alias("review")).coalesce(1)
        scores = {v[1] for v in scored(score_reviews_batch(df, make)).values()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert scores == {float(i) for i in range(1, 11)}


def test_only_the_text_goes_to_python(reviews):
    wide = reviews.withColumn("payload", F.lit("p"))
    plan = score_reviews_batch(wide, make_client)._jdf.queryExecution().executedPlan().toString()
    call = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    assert "payload" not in call.split("]")[0]


def test_too_few_replies_are_errors(reviews):
    def make():
        return lambda texts: []

    assert scored(score_reviews_batch(reviews, make))[1][0] == "ERROR"


def test_column_scorer_never_decides_on_missing_text(reviews):
    def scorer(text):
        return polarity(F.when(text.isNotNull(), F.lit("NEGATIVE")), F.length(text) / 20)

    got = scored(score_reviews(reviews, scorer, partitions=3))
    assert got[1] == ("NEGATIVE", 0.2, 0.8, 0.2)
    assert got[3] == got[4] == ("NEUTRAL", 0, 0, 0)


def test_default_scorer_runs_without_python(reviews):
    plan = score_reviews(reviews)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_positive_and_negative_add_up_unless_unscored(spark):
    from purchase_signals.plans.inputs import reviews as benchmark_reviews
    from purchase_signals.plans.inputs import benchmark_scorer

    df = score_reviews(benchmark_reviews(spark, "/root/testdata/sf0.001"), benchmark_scorer)
    total = F.col(f"{SENTIMENT}.positive_score") + F.col(f"{SENTIMENT}.negative_score")
    neutral = F.col(f"{SENTIMENT}.label") == "NEUTRAL"
    assert df.where(~neutral & (F.abs(total - 1) > 1e-6)).count() == 0
    assert df.where(neutral & (total != 0)).count() == 0
    assert df.where(neutral).count() > 0


def test_label_counts(reviews):
    counts = sentiment_label_counts(score_reviews_batch(reviews, make_client))
    assert {r["label"]: r["reviews"] for r in counts.collect()} == {
        "POSITIVE": 1,
        "ERROR": 2,
        "NEUTRAL": 3,
    }


def test_patterns_sets_and_dictionaries_count_alike(spark, monkeypatch):
    """Short lists, long lists and tables of words: the same rows, odd texts included."""
    import random
    import string

    from purchase_signals.functions import sentiment
    from purchase_signals.operators import score_reviews_by_dictionary

    draw = random.Random(4)
    words = ["good", "goo", "od", "bad", "a", "İ", "und", "GOOD", "bad's", "x1good", "good-bad", "été"]
    texts = [(i, " ".join(draw.choices(words, k=draw.randrange(9))) + draw.choice(["", ".", "\n", " \t"])) for i in range(300)]
    texts += [(300, None), (301, ""), (302, " "), (303, "good" * 5), (304, "good " * 5000), (304, "good " * 5000), (None, "bad")]
    df = spark.createDataFrame(texts, "review_id long, review string").withColumn("_up", F.lit(1))
    positive, negative = ["Good", "a", "both", "not a word"], ["bad", "od", "both"]
    scorer = lambda c: sentiment.lexicon_scorer(c, positive, negative)
    told = lambda d: sorted(map(str, d.select("review_id", "review", "sentiment_analysis").collect()))
    by_pattern = told(score_reviews(df, scorer))
    monkeypatch.setattr(sentiment, "PATTERN_WORDS", 0)
    by_set = told(score_reviews(df, scorer))
    listed = spark.createDataFrame(
        [(w, True) for w in positive] + [(w, False) for w in negative] + [("BAD", False), (None, True)],
        "word string, positive boolean",
    )
    assert by_pattern == by_set == told(score_reviews_by_dictionary(df.drop("_up"), listed))
    hot = score_reviews_by_dictionary(df.drop("_up"), listed, broadcast_bytes=0, hot_share=5)
    assert told(hot) == by_pattern
    # Many thousand words.
    letters = string.ascii_lowercase
    many = [a + b + c for a in letters for b in letters for c in letters]
    by_set = told(score_reviews(df, lambda c: sentiment.lexicon_scorer(c, many, ["bad"])))
    listed = spark.createDataFrame([(w, True) for w in many] + [("bad", False)], "word string, positive boolean")
    assert told(score_reviews_by_dictionary(df.drop("_up"), listed)) == by_set
    nothing = spark.createDataFrame([], "word string, positive boolean")
    assert told(score_reviews_by_dictionary(df.drop("_up"), nothing)) == told(score_reviews(df, lambda c: sentiment.lexicon_scorer(c, [], [])))
