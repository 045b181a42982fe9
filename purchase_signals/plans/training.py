"""Fitting, applying and evaluating the purchase model."""

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.encoding import FEATURES, WEIGHT
from ..operators.features import feature_columns
from ..operators.metrics import auc_binned, auc_exact
from ..shared import ensure_checkpoint_dir, materialise
from .model import is_purchase_model, load_purchase_model, predict

LABEL = "label"


def collapse_examples(df: DataFrame) -> DataFrame:
    """One row per distinct example, with its number of copies as ``weight``.

    Features are per-game values, so the reviews of a game share one vector and
    the result has a few rows per game. A weighted fit on it has the same objective
    as an unweighted fit on all reviews. Weights that are there already are summed.
    """
    copies = F.sum(WEIGHT) if WEIGHT in df.columns else F.count(F.lit(1)).cast("double")
    return df.groupBy(*[c for c in df.columns if c != WEIGHT]).agg(copies.alias(WEIGHT))


def _categories(train: DataFrame) -> list[int]:
    """How many values each category among the features has; a tree needs as many bins."""
    if FEATURES not in train.columns:
        return [0]
    attributes = train.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {})
    return [0, *[a["num_vals"] for a in attributes.get("nominal", [])]]


def train_gbt(train: DataFrame, max_iter: int = 50, seed: int = 42) -> PipelineModel:
    """Gradient-boosted trees on every column but ``label`` and ``weight``.

    The distinct examples are written out before the fit: its many passes then
    read a small table and survive the loss of an executor.
    """
    ensure_checkpoint_dir(train.sparkSession)
    columns = feature_columns(train.drop(WEIGHT), LABEL)
    ready = columns == [FEATURES] and isinstance(train.schema[FEATURES].dataType, VectorUDT)
    stages = [] if ready else [VectorAssembler(inputCols=columns, outputCol=FEATURES)]
    values = max(_categories(train))
    trees = GBTClassifier(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, maxIter=max_iter, seed=seed,
        maxBins=max(32, values),
    )
    examples = materialise(collapse_examples(train), "examples")
    rows = examples.count()
    if 0 < rows < values:
        # Trees allow no more bins than rows: each example in equal parts.
        parts = -(-values // rows)
        examples = examples.withColumn(WEIGHT, F.col(WEIGHT) / parts)
        examples = examples.select("*", F.explode(F.array_repeat(F.lit(0), parts))).drop("col")
    return Pipeline(stages=[*stages, trees]).fit(examples)


def predictions(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the model's columns and the margin of the positive class."""
    margin = vector_to_array("rawPrediction")[1]
    return model.transform(df).withColumn("margin", margin)


def evaluate(
    model: PipelineModel, validation: DataFrame, num_bins: int = 1000, out: str | None = None
) -> dict:
    """Exact and binned area under the ROC curve on ``validation``.

    The distinct examples and their predictions are written to ``out``, or else to the
    shared folder, with their number of copies as ``weight``.
    """
    columns = [LABEL, WEIGHT, "rawPrediction", "margin", "prediction"]
    scored = predictions(model, materialise(collapse_examples(validation), "examples"))
    scored = scored.select(*columns)
    if out is None:
        scored = materialise(scored, "predictions")
    else:
        spark, schema = validation.sparkSession, scored.schema
        scored.write.mode("overwrite").parquet(out)
        scored = spark.read.schema(schema).parquet(out)
    return {
        "auc": auc_exact(scored, "margin", LABEL, WEIGHT).first()["auc"],
        "auc_binned": auc_binned(scored, num_bins, LABEL, WEIGHT),
    }


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def batch_predict(
    df: DataFrame, path: str, keep: Sequence[str] | None = None, **options
) -> DataFrame:
    """Apply the model saved at ``path``.

    Where it is a whole purchase model, ``df`` holds raw reviews and the result has
    ``keep`` (default: all their columns) and the predictions; see ``model.predict`` for the
    options. Where it is trees alone, or ``df`` holds features already, these are applied.
    """
    spark = df.sparkSession
    if not is_purchase_model(spark, path):
        return predictions(PipelineModel.load(path), df)
    model = load_purchase_model(spark, path)
    if FEATURES in df.columns:
        return predictions(model.trees, df)
    return predict(model, df, df.columns if keep is None else keep, **options)
