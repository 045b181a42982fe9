"""The purchase model as a whole: fitted features and trees, on disk and over new reviews.

A model folder holds one folder per saved version, ``v1``, ``v2`` and so on. Each has the
per-game table as Parquet, the feature stages, the trees, and a manifest that is written
last: a version without one was not saved to its end and is passed over.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sentiment import lexicon_scorer
from ..operators.attach import attach_by_key
from ..operators.encoding import FEATURES, FeatureModel, review_vectors
from ..operators.features import fill_numeric, flatten_sentiment, purchase_label
from ..operators.scoring import score_reviews
from ..schema import (
    GAME,
    NEGATIVE_SCORE,
    POSITIVE_SCORE,
    PURCHASE,
    REVIEW_SCHEMA,
    SENTIMENT,
    TEXT,
    VOTE,
)
from ..shared import folders, read_text, write_text

# Changes when older code could not read what is saved.
FORMAT = 1
PER_GAME, STAGES, TREES, MANIFEST = "per_game", "stages", "trees", "manifest.json"
PREDICTED = ["prediction", "margin", "probability"]


@dataclass
class PurchaseModel:
    """Fitted features, the trees trained on them (None before), and how both were made."""

    features: FeatureModel
    trees: PipelineModel | None = None
    others_only: bool = False
    on_unscored: str = "zero"

    def with_trees(self, trees: PipelineModel) -> PurchaseModel:
        return replace(self, trees=trees)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the version folders, finished or not."""
    found = (re.fullmatch(r"v(\d+)", name) for name in folders(spark, path))
    return sorted(int(m.group(1)) for m in found if m)


def is_purchase_model(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a version that was saved to its end, or holds one."""
    path = path.rstrip("/")
    return bool(read_text(spark, f"{path}/{MANIFEST}")) or any(
        read_text(spark, f"{path}/v{v}/{MANIFEST}") for v in reversed(_versions(spark, path))
    )


def save_purchase_model(model: PurchaseModel, path: str) -> str:
    """Save ``model`` as the newest version below ``path``; return that version's folder."""
    features, path = model.features, path.rstrip("/")
    spark = features.per_game.sparkSession
    folder = f"{path}/v{max(_versions(spark, path), default=0) + 1}"
    features.per_game.write.parquet(f"{folder}/{PER_GAME}")
    features.stages.write().save(f"{folder}/{STAGES}")
    if model.trees is not None:
        model.trees.write().save(f"{folder}/{TREES}")
    manifest = {
        "format": FORMAT,
        "n_games": features.n_games,
        "game_as": features.game_as,
        "per_game_schema": json.loads(features.per_game.schema.json()),
        "trees": model.trees is not None,
        "others_only": model.others_only,
        "on_unscored": model.on_unscored,
    }
    write_text(spark, f"{folder}/{MANIFEST}", json.dumps(manifest, indent=1))
    return folder


def load_purchase_model(spark: SparkSession, path: str, version: int | None = None) -> PurchaseModel:
    """The newest finished version below ``path``, or the one asked for; ``path`` may be a version's folder."""
    path = path.rstrip("/")
    wanted = list(reversed(_versions(spark, path))) if version is None else [version]
    for folder in [path, *[f"{path}/v{number}" for number in wanted]]:
        text = read_text(spark, f"{folder}/{MANIFEST}")
        if text is None:
            continue
        manifest = json.loads(text)
        if manifest["format"] != FORMAT:
            raise ValueError(f"{folder} has format {manifest['format']}, this library reads {FORMAT}")
        # The declared schema also tells a table with missing or changed columns.
        schema = T.StructType.fromJson(manifest["per_game_schema"])
        per_game = spark.read.schema(schema).parquet(f"{folder}/{PER_GAME}")
        stages = PipelineModel.load(f"{folder}/{STAGES}")
        features = FeatureModel(per_game, stages, manifest["n_games"], manifest["game_as"])
        trees = PipelineModel.load(f"{folder}/{TREES}") if manifest["trees"] else None
        return PurchaseModel(features, trees, manifest["others_only"], manifest["on_unscored"])
    raise FileNotFoundError(f"no finished model under {path}")


def save_features(features: FeatureModel, path: str, **made_with) -> str:
    """Save fitted features alone; ``made_with`` are ``others_only`` and ``on_unscored``."""
    return save_purchase_model(PurchaseModel(features, **made_with), path)


def load_features(spark: SparkSession, path: str, version: int | None = None) -> FeatureModel:
    return load_purchase_model(spark, path, version).features


def _predicted(model: PurchaseModel, vectors: DataFrame) -> DataFrame:
    """``vectors`` with the predicted class, the margin and probability of a purchase."""
    margin = vector_to_array("rawPrediction")[1]
    probability = vector_to_array(F.col("probability"))[1]
    found = model.trees.transform(vectors)
    own = [c for c in vectors.columns if c != FEATURES]
    return found.select(
        *own, "prediction", margin.alias("margin"), probability.alias("probability")
    )


def scored_columns(reviews: DataFrame, scorer: Callable, on_unscored: str) -> DataFrame:
    """``reviews`` with both scores as numbers, however far they come: raw, scored, or flat."""
    with_scored = on_unscored == "exclude"
    if POSITIVE_SCORE in reviews.columns and NEGATIVE_SCORE in reviews.columns:
        if with_scored and "scored" not in reviews.columns:
            reviews = reviews.withColumn("scored", F.lit(True))
    else:
        if SENTIMENT not in reviews.columns:
            reviews = score_reviews(reviews, scorer)
        reviews = flatten_sentiment(reviews, with_scored)
    return fill_numeric(reviews, [POSITIVE_SCORE, NEGATIVE_SCORE])


def predict(
    model: PurchaseModel,
    reviews: DataFrame,
    keep: Sequence[str] = (),
    scorer: Callable = lexicon_scorer,
    aggregated: Column | None = None,
    **join_options,
) -> DataFrame:
    """``keep``, ``label`` where the purchase is known, and the prediction for each review.

    ``reviews`` are raw; no column but the game is needed, others that a model looks at
    count as null. Games the model was not fitted on count as games without reviews.

    Without ``others_only`` all reviews of a game get the same prediction: it is made once
    per game and attached, and texts are not scored. With it, a review's own vote and
    scores decide what is taken off its game's aggregates, for the rows that
    ``aggregated``, a condition, names as part of those; new reviews (the default) are
    not. The scorer must then be the one the model was made with.
    """
    if model.trees is None:
        raise ValueError("the model has no trees yet")
    label = []
    if PURCHASE in reviews.columns:
        label = [purchase_label(F.col(PURCHASE)).alias("label")]
    if not model.others_only:
        rows = reviews.select(*dict.fromkeys([*keep, GAME]), *label)
        games = _predicted(model, model.features.encode_games().select(GAME, FEATURES))
        unknown = _predicted(model, model.features.vector_of_no_game())
        unknown = unknown.select(F.struct(*PREDICTED)).scalar()
        rows = attach_by_key(rows, games, sizes=model.features.per_game, **join_options)
        rows = rows.withColumns({c: F.coalesce(F.col(c), unknown[c]) for c in PREDICTED})
    else:
        own = {f.name: f.dataType for f in REVIEW_SCHEMA if f.name in (VOTE, TEXT)}
        absent = {c: F.lit(None).cast(t) for c, t in own.items() if c not in reviews.columns}
        inside = F.lit(False) if aggregated is None else aggregated
        flat = scored_columns(
            reviews.withColumns({**absent, "_inside": inside}), scorer, model.on_unscored
        )
        needed = [GAME, VOTE, POSITIVE_SCORE, NEGATIVE_SCORE, "_inside"]
        needed += ["scored"] if model.on_unscored == "exclude" else []
        flat = flat.select(*dict.fromkeys([*keep, *needed]), *label)
        vectors = review_vectors(
            flat, model.features, True, model.on_unscored, F.col("_inside"), **join_options
        )
        rows = _predicted(model, vectors)
    return rows.select(*keep, *(["label"] if label else []), *PREDICTED)
