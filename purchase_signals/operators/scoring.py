"""Scoring the text column of a frame."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sentiment import fill_missing, lexicon_scorer, share_sentiment, words_of
from ..functions.text import model_input, present
from ..schema import SENTIMENT, SENTIMENT_TYPE, TEXT
from ..shared import materialise
from .attach import attach_by_key

Scorer = Callable[[Column], Column]
# Takes a list of texts, returns one reply per text: {"label": ..., "score": ...}.
Client = Callable[[list[str]], list]


def score_reviews(
    df: DataFrame,
    scorer: Scorer = lexicon_scorer,
    text_col: str = TEXT,
    partitions: int | None = None,
) -> DataFrame:
    """Add the sentiment struct with a scorer made of built-in expressions.

    ``partitions`` spreads the rows before they are scored; leave it out when the
    input files already split into enough tasks. ``scorer`` is given null for missing
    text; fields it leaves null become NEUTRAL and zeros.
    """
    rows = df.repartition(partitions) if partitions else df
    scored = rows.withColumn(SENTIMENT, scorer(present(F.col(text_col))))
    return scored.withColumn(SENTIMENT, fill_missing(F.col(SENTIMENT)))


def score_reviews_by_dictionary(
    df: DataFrame, dictionary: DataFrame, text_col: str = TEXT, **join_options
) -> DataFrame:
    """Add the sentiment struct by a dictionary that is a table: ``word`` and ``positive``, a boolean.

    Gives what ``lexicon_scorer`` gives for the same lists, however long. Texts are taken apart
    into words, which are counted per row before they are shuffled; the dictionary is joined to these
    counts, and two sums per row come back. A word that very many texts hold is joined in
    parts, see ``attach_by_key``. Words are compared in lower case; those that are not
    letters a-z alone are never found, ones listed on both sides count on both.
    """
    word = F.lower("word")
    listed = dictionary.where(F.rlike(word, F.lit("^[a-z]+$"))).groupBy(word.alias("_word")).agg(
        F.max(F.col("positive").cast("int")).alias("_up"),
        F.max((~F.col("positive")).cast("int")).alias("_down"),
    )
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    text = present(F.col(text_col))
    words = rows.select("_row", F.explode(words_of(model_input(text, None))).alias("_word"))
    words = words.where("_word <> ''").groupBy("_row", "_word").agg(F.count(F.lit(1)).alias("_n"))
    found = attach_by_key(words, listed, "_word", **join_options).where("_up is not null")
    counts = found.groupBy("_row").agg(
        F.sum(F.col("_n") * F.col("_up")).alias("_up"), F.sum(F.col("_n") * F.col("_down")).alias("_down")
    )
    counts = materialise(counts, "word_counts")
    scored = rows.join(counts, "_row", "left")
    known = [F.when(text.isNotNull(), F.coalesce(c, F.lit(0).cast("long"))) for c in ("_up", "_down")]
    return scored.select(*df.columns, share_sentiment(*known).alias(SENTIMENT))


def score_reviews_batch(
    df: DataFrame,
    make_client: Callable[[], Client],
    text_col: str = TEXT,
    partitions: int | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """Add the sentiment struct with a model of the caller's own.

    ``make_client`` runs once per task and its client gets a list of cleaned texts
    per Arrow batch (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows at most),
    whole or their first ``max_chars``. Only those texts go to Python; the other columns
    stay in the JVM. When a batch fails it is halved until what fails is a single text,
    which becomes ERROR, as does a reply whose label is not text. A client that cannot be
    made is tried once more; then all rows of the task are ERROR.

    Write the result before using it more than once: each use calls the model.
    """

    @F.pandas_udf(SENTIMENT_TYPE)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import numpy as np
        import pandas as pd

        client, tries = None, 0

        def ask(texts):
            nonlocal client, tries
            if client is None:
                if tries == 2:
                    raise RuntimeError("the client cannot be made")
                tries += 1
                client = make_client()
            replies = list(client(texts))
            if len(replies) != len(texts):
                raise ValueError("one reply per text expected")
            return replies

        def by_halves(texts):
            try:
                return ask(texts)
            except Exception:
                if len(texts) == 1 or client is None and tries == 2:
                    return [None] * len(texts)
            middle = len(texts) // 2
            return by_halves(texts[:middle]) + by_halves(texts[middle:])

        def read(reply):
            try:
                label, score = reply.get("label", "NEUTRAL"), float(reply.get("score", 0.5))
                return (label, score) if isinstance(label, str) else ("ERROR", None)
            except (AttributeError, TypeError, ValueError):
                return "ERROR", None

        for batch in batches:
            present = (batch.notna() & (batch != "")).to_numpy(dtype=bool)
            texts = batch[present].tolist()
            replies = by_halves(texts) if texts else []
            answers = [read(reply) for reply in replies]
            label = np.full(len(batch), "NEUTRAL", dtype=object)
            label[present] = [a[0] for a in answers]
            value = np.zeros(len(batch))
            value[present] = [np.nan if a[1] is None else a[1] for a in answers]
            # Rows without an answer hold zeros throughout.
            answered = present.copy()
            answered[present] = [a[1] is not None for a in answers]
            rest = 1.0 - value
            columns = {
                "label": label,
                "score": value,
                "positive_score": np.where(label == "POSITIVE", value, rest),
                "negative_score": np.where(label == "NEGATIVE", value, rest),
            }
            for name in ("score", "positive_score", "negative_score"):
                columns[name] = np.where(answered, columns[name], 0.0).astype("float32")
            yield pd.DataFrame(columns)

    rows = df.repartition(partitions) if partitions else df
    # A model call is costly and may differ from call to call: never repeat it to
    # save a projection.
    score = score.asNondeterministic()
    return rows.withColumn(SENTIMENT, score(model_input(F.col(text_col), max_chars)))
