"""The whole job in one session, which can be taken up where it ended."""

import hashlib
import json
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import SparkSession

from ..functions.sentiment import lexicon_scorer
from ..operators.quality import sentiment_label_counts
from ..shared import listing, read_text, write_text
from ..sinks.parquet import write_parquet
from .model import load_purchase_model, save_purchase_model
from .preparation import FEATURES_FOLDER, prepare, score_run
from .training import evaluate, train_gbt

MANIFEST = "job.json"


class Manifest:
    """Which steps of the job below ``out`` are done, from what, and what they gave.

    It is written after each step. A step whose settings and inputs are those it was done
    with is not done again while the job is unfinished; a finished job starts anew.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.path = spark, f"{out}/{MANIFEST}"
        held = json.loads(read_text(spark, self.path) or "{}")
        self.taken_up = bool(held) and not held["finished"]
        self.steps = held["steps"] if self.taken_up else {}
        self.reused: list[str] = []

    def _write(self, finished: bool) -> None:
        write_text(
            self.spark, self.path, json.dumps({"finished": finished, "steps": self.steps}, indent=1)
        )

    def step(self, name: str, made_from: list, do: Callable[[], dict]) -> dict:
        """The results of ``do``, from the manifest if they were made from the same."""
        digest = hashlib.sha256(json.dumps(made_from, sort_keys=True).encode()).hexdigest()
        held = self.steps.get(name)
        if held and held["made_from"] == digest:
            self.reused.append(name)
            return held["result"]
        if held is None and not self.steps:
            self._write(finished=False)
        result = do()
        # Later steps were made from what has just been replaced.
        self.steps[name] = {"made_from": digest, "result": result}
        self._write(finished=False)
        return result

    def finish(self) -> None:
        self._write(finished=True)


def _code(function: Callable | None) -> str:
    return hashlib.sha256(cloudpickle.dumps(function)).hexdigest()


def run(
    spark: SparkSession,
    source: str,
    out: str,
    scorer: Callable = lexicon_scorer,
    max_iter: int = 50,
    key: str | None = None,
    one_hot: bool = True,
    others_only: bool = False,
    on_unscored: str = "zero",
    partitions: int | None = None,
    game_as: str | None = None,
    make_client: Callable | None = None,
    max_chars: int | None = None,
    max_error_share: float | None = None,
    take_over: bool = False,
) -> dict:
    """Score, prepare, train and report. Returns paths, counts and areas.

    Each step writes its result below ``out`` and the next one reads it from there. What is
    done is noted in ``out/job.json``: a job that ended before its last step goes on with
    the first step that is not done, or whose settings or inputs have changed since; ``steps_reused`` of the
    report names the others. A finished job starts anew.

    ``make_client``, ``max_chars`` and ``max_error_share`` are those of ``score_run``. With a ``key``, a scoring
    step that ended with too many errors takes over the answers it had; ``take_over`` also
    does so for those of finished runs below ``out``.
    """
    out = out.rstrip("/")
    job = Manifest(spark, out)

    def score():
        counts: dict = {}
        path = score_run(
            spark, source, f"{out}/scored", scorer, partitions,
            make_client=make_client, max_chars=max_chars, key=key,
            resume=key is not None and (take_over or job.taken_up),
            max_error_share=max_error_share, report=counts,
        )
        return {"scored": path, **counts}

    asked = [_code(scorer), _code(make_client), max_chars]
    scored = job.step("score", [source, listing(spark, source), *asked], score)

    def prepared():
        frame = spark.read.parquet(scored["scored"])
        train, validation = prepare(
            frame, f"{out}/prepared", key, one_hot, others_only, on_unscored, game_as=game_as
        )
        labels = write_parquet(sentiment_label_counts(frame), f"{out}/label_counts")
        features = f"{out}/prepared/{FEATURES_FOLDER}"
        return {"train": train, "validation": validation, "features": features, "label_counts": labels}

    made_from = [scored["scored"], key, one_hot, others_only, on_unscored, game_as]
    halves = job.step("prepare", made_from, prepared)

    def trained():
        trees = train_gbt(spark.read.parquet(halves["train"]), max_iter)
        model = load_purchase_model(spark, halves["features"]).with_trees(trees)
        return {"model": save_purchase_model(model, f"{out}/models")}

    made_from = [job.steps["prepare"]["made_from"], halves["train"], max_iter]
    model = job.step("train", made_from, trained)

    def evaluated():
        trees = load_purchase_model(spark, model["model"]).trees
        validation = spark.read.parquet(halves["validation"])
        predicted = f"{out}/predictions"
        return evaluate(trees, validation, out=predicted) | {"predictions": predicted}

    areas = job.step("evaluate", [model["model"], halves["validation"]], evaluated)
    job.finish()
    return {**scored, **halves, **model, **areas, "steps_reused": job.reused}
