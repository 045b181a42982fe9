"""Looking at data and counting it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SENTIMENT
from .sampling import smallest_rows


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``key``."""
    return smallest_rows(df, F.col(key), key, n)


def first_valid_rows(df: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """The first ``n`` parsed rows by ``key``; rejected lines do not count."""
    return smallest_rows(df, F.col(key), key, n)


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"))


def sentiment_label_counts(df: DataFrame, column: str = SENTIMENT) -> DataFrame:
    """Rows per sentiment label; failed scorings are the rows of ERROR."""
    return df.groupBy(F.col(f"{column}.label").alias("label")).agg(
        F.count(F.lit(1)).alias("reviews")
    )
