"""Sentiment as a struct of label, score, positive_score and negative_score."""

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (
    ERROR,
    NEGATIVE,
    NEGATIVE_SCORE,
    NEUTRAL,
    POSITIVE,
    POSITIVE_SCORE,
    SENTIMENT_TYPE,
)
from .text import model_input, present

# A small English word list so that the default scorer works out of the box. It
# stands in for a trained model and does not claim that model's quality.
DEFAULT_POSITIVE = (
    "amazing awesome beautiful best brilliant enjoy enjoyable excellent fantastic fun "
    "good great incredible love loved masterpiece nice perfect recommend wonderful"
).split()
DEFAULT_NEGATIVE = (
    "annoying awful bad boring broken bug bugs crash crashes disappointing garbage "
    "hate horrible poor refund terrible trash unplayable waste worst"
).split()


def sentiment_struct(label: Column, score: Column, positive: Column, negative: Column) -> Column:
    values = (label, score, positive, negative)
    return F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, SENTIMENT_TYPE)])


def polarity(label: Column, score: Column) -> Column:
    """Both scores from a label and its score.

    A label that is neither POSITIVE nor NEGATIVE gets ``1 - score`` on both sides.
    """
    rest = F.lit(1.0) - score
    return sentiment_struct(
        label,
        score,
        F.when(label == POSITIVE, score).otherwise(rest),
        F.when(label == NEGATIVE, score).otherwise(rest),
    )


def fill_missing(sentiment: Column) -> Column:
    """NEUTRAL and zeros for the fields of ``sentiment`` that are null."""
    zero = F.lit(0.0).cast("float")
    return F.struct(
        F.coalesce(sentiment["label"], F.lit(NEUTRAL)).alias("label"),
        *[
            F.coalesce(sentiment[f], zero).alias(f)
            for f in ("score", POSITIVE_SCORE, NEGATIVE_SCORE)
        ],
    )


def bind(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with ``value`` computed once, however often ``build`` uses it.

    Written out in place, a costly value would be planned again at each use, and run
    again at those under a condition.
    """
    return F.get(F.transform(F.array(value), build), F.lit(0))


def _listed(words: Iterable[str]) -> list[str]:
    """The words that a run of the letters a-z can be equal to."""
    return sorted({w.lower() for w in words if re.fullmatch("[a-z]+", w.lower())})


# Lists of at most so many words are looked for by one pattern; with more, every word of a
# text is looked up.
PATTERN_WORDS = 100


def words_of(text: Column) -> Column:
    """The runs of the letters a-z in the lower-cased text; empty texts hold one empty word."""
    return F.split(F.lower(text), "[^a-z]+")


def count_words(text: Column, positive: Iterable[str], negative: Iterable[str]) -> Column:
    """Struct of ``positive`` and ``negative``: how many words of ``text`` each list holds.

    Words are runs of the letters a-z in the lower-cased text. The words found in
    either list are picked out first, in one pass whatever the length of the lists: by a
    pattern that matches just these, or for long lists by looking up each word in a
    set. For more words than a plan should carry there is ``score_reviews_by_dictionary``.
    """
    positive, negative = _listed(positive), _listed(negative)
    listed = sorted({*positive, *negative})
    if 0 < len(listed) <= PATTERN_WORDS:
        pattern = f"(?<![a-z])(?:{'|'.join(listed)})(?![a-z])"
        found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    else:
        found = F.filter(words_of(text), lambda w: w.isin(listed))

    def count(words, listed):
        return F.array_size(F.filter(words, lambda w: w.isin(listed)))

    return bind(
        found,
        lambda words: F.struct(
            count(words, positive).alias("positive"), count(words, negative).alias("negative")
        ),
    )


def share_sentiment(positive: Column, negative: Column) -> Column:
    """Sentiment from how many positive and negative words a text holds; null counts: missing text."""
    share = (positive + 1) / (positive + negative + 2)
    rest = F.lit(1.0) - share
    label = F.when(share >= 0.5, F.lit(POSITIVE)).when(share < 0.5, F.lit(NEGATIVE))
    return fill_missing(sentiment_struct(label, F.greatest(share, rest), share, rest))


def lexicon_scorer(
    text: Column,
    positive: Iterable[str] = DEFAULT_POSITIVE,
    negative: Iterable[str] = DEFAULT_NEGATIVE,
    max_chars: int | None = None,
) -> Column:
    """Score a text by the share of positive among all listed words.

    Missing text is NEUTRAL with zeros.
    """
    counts = count_words(model_input(present(text), max_chars), positive, negative)

    return bind(counts, lambda counts: share_sentiment(counts["positive"], counts["negative"]))


def parse_score_response(response: Column) -> Column:
    """Read the JSON reply of a scoring service.

    A reply is a non-empty list whose first item is an object; other items may be
    anything. A missing or null label means NEUTRAL, a missing score 0.5. All else, such as
    text after the list, is an ERROR with zeros.
    """
    # An object in place of the list would be read as a list of one. Parsing ignores
    # what follows a value; a closing null brings it to light.
    strict = {"allowSingleQuotes": "false"}
    a_list = F.when(F.startswith(F.ltrim(response), F.lit("[")), response)
    whole = F.from_json(F.concat(F.lit("["), a_list, F.lit(",null]")), "array<array<string>>", strict)
    first = F.when(F.array_size(whole) == 2, F.get(F.get(whole, F.lit(0)), F.lit(0)))
    first = F.when(F.startswith(F.ltrim(first), F.lit("{")), first)
    items = F.from_json(F.concat(F.lit("["), first, F.lit("]")), "array<map<string,string>>", strict)

    def read(first):
        by_default = F.when(~F.map_contains_key(first, "score"), F.lit("0.5"))
        score = F.coalesce(first["score"], by_default).try_cast("double")
        label = F.coalesce(first["label"], F.lit(NEUTRAL))
        label = F.when(score.isNull(), F.lit(ERROR)).otherwise(label)
        return fill_missing(polarity(label, score))

    return bind(F.get(items, F.lit(0)), read)


def is_scored(sentiment: Column) -> Column:
    """False where a row holds no model answer: no struct, ERROR, or missing text."""
    label, score = sentiment["label"], sentiment["score"]
    empty = (label == NEUTRAL) & (score == 0)
    return sentiment.isNotNull() & F.coalesce(~((label == ERROR) | empty), F.lit(True))
