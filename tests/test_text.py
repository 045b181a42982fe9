import random

import pytest
from pyspark.sql import functions as F

from purchase_signals.functions import (
    clean_json_line,
    clean_text,
    count_words,
    is_missing,
    lexicon_scorer,
    model_input,
    parse_score_response,
    polarity,
    truncate_text,
)


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def column(df):
    return [r[0] for r in df.collect()]


def fields(row):
    return row["label"], *[round(row[f], 6) for f in ("score", "positive_score", "negative_score")]


def test_clean_text_escapes_quotes_and_newlines(spark):
    df = texts(spark, ['say "hi"\nnow', "plain", "", None])
    assert column(df.select(clean_text(F.col("t")))) == ['say \\"hi\\" now', "plain", "", None]


def test_truncation_counts_characters_after_escaping(spark):
    text = "x" * 499 + '"' + "y" * 10
    got = column(texts(spark, [text]).select(truncate_text(clean_text(F.col("t")))))
    assert got == ["x" * 499 + "\\"]


def test_model_input_equals_cleaning_the_whole_text(spark):
    rng = random.Random(7)
    alphabet = 'ab"\n é😀'
    values = ["".join(rng.choices(alphabet, k=rng.randrange(0, 1200))) for _ in range(200)]
    values += ['"' * 500, '"' * 501, "x" * 499 + '"', "x" * 500 + '"', "x" * 498 + '""', None]
    df = texts(spark, values)
    t = F.col("t")
    rows = df.select(model_input(t, 500).alias("a"), truncate_text(clean_text(t)).alias("b"))
    whole = df.select(model_input(t).alias("a"), clean_text(t).alias("b"))
    assert whole.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    assert rows.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_missing_is_null_or_empty_but_not_blank(spark):
    df = texts(spark, [None, "", " ", "a"])
    assert column(df.select(is_missing(F.col("t")))) == [True, True, False, False]


@pytest.mark.parametrize(
    "line, expected",
    [
        ('  {"a":1},\t', '{"a":1}'),
        ('{"a":1},,', '{"a":1},'),
        ("　\x85\xa0{}\x1c", "{}"),
        (" , ", ""),
        ("[", "["),
        ("", ""),
    ],
)
def test_clean_json_line(spark, line, expected):
    assert column(texts(spark, [line]).select(clean_json_line(F.col("t")))) == [expected]


def test_polarity_of_an_unknown_label_is_the_rest_on_both_sides(spark):
    df = spark.createDataFrame(
        [("POSITIVE", 0.9), ("NEGATIVE", 0.9), ("MIXED", 0.9)], "l string, s double"
    )
    got = [fields(r[0]) for r in df.select(polarity(F.col("l"), F.col("s"))).collect()]
    assert got == [
        ("POSITIVE", 0.9, 0.9, 0.1),
        ("NEGATIVE", 0.9, 0.1, 0.9),
        ("MIXED", 0.9, 0.1, 0.1),
    ]


@pytest.mark.parametrize(
    "reply, expected",
    [
        ('[{"label":"POSITIVE","score":0.75}]', ("POSITIVE", 0.75, 0.75, 0.25)),
        ('[{"label":"NEGATIVE","score":"0.75"}]', ("NEGATIVE", 0.75, 0.25, 0.75)),
        ('[{"score":0.75}]', ("NEUTRAL", 0.75, 0.25, 0.25)),
        ('[{"label":"POSITIVE"}]', ("POSITIVE", 0.5, 0.5, 0.5)),
        ('[{"label":"POSITIVE","score":null}]', ("ERROR", 0, 0, 0)),
        ('[{"label":"POSITIVE","score":"high"}]', ("ERROR", 0, 0, 0)),
        ('  [{"label":"POSITIVE","score":1}]', ("POSITIVE", 1, 1, 0)),
        ("[]", ("ERROR", 0, 0, 0)),
        ('{"label":"POSITIVE","score":0.75}', ("ERROR", 0, 0, 0)),
        ('["POSITIVE"]', ("ERROR", 0, 0, 0)),
        ("[5]", ("ERROR", 0, 0, 0)),
        ("oops", ("ERROR", 0, 0, 0)),
        ("", ("ERROR", 0, 0, 0)),
        (None, ("ERROR", 0, 0, 0)),
    ],
)
def test_parse_score_response(spark, reply, expected):
    row = texts(spark, [reply]).select(parse_score_response(F.col("t"))).first()[0]
    assert fields(row) == expected


def brute_count(text, words):
    import re

    return sum(w in words for w in re.split("[^a-z]+", text.lower()))


def test_word_counts_equal_brute_force_for_short_and_long_lists(spark):
    rng = random.Random(3)
    vocabulary = ["good", "bad", "go", "goodly", "x2good", "Good", "un-good", "éclat", "b4d"]
    values = [
        " ".join(rng.choices(vocabulary, k=rng.randrange(0, 40))) + rng.choice(["", ".", "\n"])
        for _ in range(100)
    ]
    short = ["good", "go"], ["bad", "good"]
    long = (
        ["good", "go", *[f"{a}{b}q" for a in "abcdefghij" for b in "abcdefghij"]],
        ["bad", "don't", "b4d"],
    )
    for positive, negative in (short, long):
        counts = count_words(F.col("t"), positive, negative)
        rows = texts(spark, values).select("t", counts.alias("c")).collect()
        allowed = [[w for w in ws if w.isalpha()] for ws in (positive, negative)]
        for r in rows:
            expected = tuple(brute_count(r["t"], set(ws)) for ws in allowed)
            assert (r["c"]["positive"], r["c"]["negative"]) == expected


def test_lexicon_scorer(spark):
    df = texts(spark, ["good good bad", "bad", "no listed word", "   ", "", None])
    scored = lexicon_scorer(F.col("t"), ["good"], ["bad"])
    got = [fields(r[0]) for r in df.select(scored).collect()]
    assert got == [
        ("POSITIVE", 0.6, 0.6, 0.4),
        ("NEGATIVE", round(2 / 3, 6), round(1 / 3, 6), round(2 / 3, 6)),
        ("POSITIVE", 0.5, 0.5, 0.5),
        ("POSITIVE", 0.5, 0.5, 0.5),
        ("NEUTRAL", 0, 0, 0),
        ("NEUTRAL", 0, 0, 0),
    ]


def test_lexicon_scorer_without_words(spark):
    row = texts(spark, ["anything"]).select(lexicon_scorer(F.col("t"), [], [])).first()[0]
    assert fields(row) == ("POSITIVE", 0.5, 0.5, 0.5)
