"""From reviews to scored runs, and from scored reviews to training data."""

import importlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.sentiment import lexicon_scorer
from ..operators.aggregates import game_aggregates
from ..operators.encoding import fit_features, training_frame
from ..operators.features import fill_numeric, flatten_sentiment, select_columns
from ..operators.rescoring import ASKED, score_again
from ..operators.scoring import score_reviews, score_reviews_batch
from ..schema import ERROR, SENTIMENT
from ..shared import remove, write_text
from ..sinks.parquet import new_run_path, write_parquet, write_train_val
from ..sources.reviews import misfit_counts, read_reviews, runs_with
from .model import save_features

RUN_PREFIX = "reviews_sentiment"
FEATURES_FOLDER = "features"


# Marks a run of which too many reviews came back as ERROR: not for readers, but the next
# run takes over its other answers.
TOO_MANY_ERRORS = "_TOO_MANY_ERRORS"


class TooManyErrors(RuntimeError):
    """More reviews than allowed could not be scored; ``path`` holds the run."""

    def __init__(self, path: str, errors: int, rows: int):
        super().__init__(f"{errors} of {rows} reviews could not be scored, see {path}")
        self.path, self.errors, self.rows = path, errors, rows


def imported(name: str) -> Callable:
    """The function that ``module:function`` names."""
    module, _, function = name.partition(":")
    if not function:
        raise ValueError(f"not module:function: {name}")
    return getattr(importlib.import_module(module), function)


def latest_scored(spark: SparkSession, root: str) -> str | None:
    """The newest run below ``root`` whose answers can be taken over."""
    marks = ("_SUCCESS", TOO_MANY_ERRORS)
    for _, path in runs_with(spark, root, marks):
        return path
    return None


def score_run(
    spark: SparkSession,
    source: str,
    root: str,
    scorer: Callable = lexicon_scorer,
    partitions: int | None = None,
    make_client: Callable | None = None,
    max_chars: int | None = None,
    key: str | None = None,
    resume: bool = False,
    max_error_share: float | None = None,
    report: dict | None = None,
) -> str:
    """Score the reviews at ``source`` into a new run folder below ``root``.

    ``make_client`` takes the place of ``scorer``: it makes a model of the caller's own, see
    ``score_reviews_batch``. ``resume`` takes over what the newest run below ``root`` knows, by
    ``key``, and asks for new, changed and failed reviews only.

    Rows and failures are counted while they are written. If more than ``max_error_share`` of the rows
    are ERROR, the run is marked so that no reader takes it for a finished one, and
    TooManyErrors is raised; ``resume`` goes on from there. ``report`` is given ``rows``, ``asked`` and
    ``errors``, and ``misfits``: how many values of known columns were not of their type and came as null.
    """
    if resume and key is None:
        raise ValueError("resume needs a key")

    def ask(rows):
        if make_client is None:
            return score_reviews(rows, scorer, partitions=partitions)
        return score_reviews_batch(rows, make_client, partitions=partitions, max_chars=max_chars)

    reviews = read_reviews(spark, source)
    previous = latest_scored(spark, root) if resume else None
    if previous is None:
        scored = ask(reviews).withColumn(ASKED, F.lit(True))
    else:
        scored = score_again(reviews, spark.read.parquet(previous), key, ask)
    counts = Observation(f"scored-{uuid.uuid4().hex}")
    failed = F.col(f"{SENTIMENT}.label") == ERROR
    counted = scored.observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(ASKED).alias("asked"),
        F.count_if(failed).alias("errors"),
    )
    path = write_parquet(counted.drop(ASKED), new_run_path(spark, root, RUN_PREFIX))
    found = counts.get
    if report is not None:
        wrong = misfit_counts(spark, source)
        report |= found | ({"misfits": wrong} if wrong else {})
    if max_error_share is not None and found["errors"] > max_error_share * found["rows"]:
        write_text(spark, f"{path}/{TOO_MANY_ERRORS}", "")
        remove(spark, f"{path}/_SUCCESS")
        raise TooManyErrors(path, found["errors"], found["rows"])
    return path


def prepare(
    scored: DataFrame,
    out: str,
    key: str | None = None,
    one_hot: bool = True,
    others_only: bool = False,
    on_unscored: str = "zero",
    train_pct: int = 80,
    game_as: str | None = None,
) -> tuple[str, str]:
    """Write the training and the validation set of scored reviews, and the fitted features.

    ``key`` is the column that decides a review's side; without one, a hash of
    the review's prepared columns does. The features go to ``out/features``, from where
    ``model.load_purchase_model`` reads them.
    """
    keep = [key] if key else []
    flat = flatten_sentiment(select_columns(scored, keep), on_unscored == "exclude")
    flat = fill_numeric(flat)
    if key is None:
        key = "_split_key"
        flat = flat.withColumn(key, F.xxhash64(*flat.columns))
    aggregates = game_aggregates(flat, on_unscored, with_sums=True)
    model = fit_features(aggregates, one_hot, game_as)
    save_features(
        model, f"{out}/{FEATURES_FOLDER}", others_only=others_only, on_unscored=on_unscored
    )
    frame = training_frame(
        flat, model, keep=[key], others_only=others_only, on_unscored=on_unscored
    )
    return write_train_val(frame, out, key, train_pct=train_pct)
