"""Review-shaped frames over the benchmark tables, for queries, tests and bench."""

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sentiment import lexicon_scorer

# Common words, since the test texts are invented prose.
TEST_POSITIVE = ["the", "and", "is", "that", "la", "der"]
TEST_NEGATIVE = ["of", "to", "was", "with", "le", "und"]
benchmark_scorer = partial(lexicon_scorer, positive=TEST_POSITIVE, negative=TEST_NEGATIVE)

# SQL text that Spark and DuckDB read alike.
REVIEW_EXPRESSIONS = [
    "doc_id AS review_id",
    "source AS game",
    "lang AS language",
    "CASE WHEN doc_id % 37 = 0 THEN NULL WHEN doc_id % 41 = 0 THEN '' ELSE text END AS review",
    "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id % 500 END AS author_num_games_owned",
    "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE doc_id % 90 END AS author_num_reviews",
    "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE doc_id * 3 END AS author_playtime_forever",
    "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id % 60 END AS author_playtime_last_two_weeks",
    "CASE WHEN doc_id % 17 = 0 THEN NULL ELSE doc_id * 2 END AS author_playtime_at_review",
    "CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS comment_count",
    "quality = 1 AS voted_up",
    "toxic = 1 AS steam_purchase",
]
FACT_EXPRESSIONS = [
    "l_orderkey * 10 + l_linenumber AS review_id",
    "p_brand AS game",
    "CAST(l_discount * 10 AS FLOAT) AS positive_score",
    "CAST(1 - l_discount * 10 AS FLOAT) AS negative_score",
    "CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS voted_up",
    "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS steam_purchase",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to as many tasks as there are cores, however few row groups its files have."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with text; some texts, votes and numbers are missing."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id", "left").selectExpr(*REVIEW_EXPRESSIONS)


def fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )


def reviews_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews that are scored already; ``review_id`` repeats."""
    return fact_rows(spark, sf_dir).selectExpr(*FACT_EXPRESSIONS)


def reviews_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reviews_fact`` with parts as games, of which there are very many."""
    games = ["CAST(l_partkey AS STRING) AS game" if " AS game" in e else e for e in FACT_EXPRESSIONS]
    return fact_rows(spark, sf_dir).selectExpr(*games)
