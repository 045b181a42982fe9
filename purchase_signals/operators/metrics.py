"""Area under the ROC curve."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .encoding import running_total_before


def auc_exact(df: DataFrame, score: str, label: str = "label", weight: str | None = None):
    """One row: the exact area, ties counted half; null if one class is absent.

    Rows of equal score are summed up first. The distinct scores are then cut into
    ranges; each range is worked through by itself and the ranges are put together
    from one row each, so no task sees the whole order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    ties = known.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.sum(F.when(F.col(label) == 1, w).otherwise(0.0)).alias("_pos"),
        F.sum(F.when(F.col(label) == 1, 0.0).otherwise(w)).alias("_neg"),
    )
    ranged = ties.repartitionByRange(parts, "_score").withColumn("_part", F.spark_partition_id())
    lower = Window.partitionBy("_part").orderBy("_score")
    lower = lower.rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(lower), F.lit(0.0))
    ranges = (
        ranged.withColumn("_wins", F.col("_pos") * (below + F.col("_neg") / 2))
        .groupBy("_part")
        .agg(*[F.sum(c).alias(c) for c in ("_wins", "_pos", "_neg")])
        .withColumn("_before", running_total_before("_neg", "_part"))
    )
    wins = F.sum(F.col("_wins") + F.col("_pos") * F.col("_before"))
    return ranges.agg(F.try_divide(wins, F.sum("_pos") * F.sum("_neg")).alias("auc"))


def auc_binned(
    predictions: DataFrame,
    num_bins: int = 1000,
    label: str = "label",
    weight: str | None = None,
) -> float:
    """Spark ML's area, from about ``num_bins`` points of the curve (0: all)."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, metricName="areaUnderROC", numBins=num_bins
    )
    if weight:
        evaluator = evaluator.setWeightCol(weight)
    return evaluator.evaluate(predictions)
