"""From raw documents to a training corpus: the stages, and a run over all of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from purchase_signals.llm.bpe import encode_and_decode
from purchase_signals.llm.frames import numbered, table
from purchase_signals.llm.minhash_dedup import near_duplicates
from purchase_signals.llm.mixing import joined_in_training_order, mix
from purchase_signals.llm.secret_scan import masked, may_hold_secrets, scan
from purchase_signals.llm.toxicity import without_toxic
from purchase_signals.shared import materialise


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key that tells rows apart that repeat an id with another text."""
    return docs.withColumn("_key", F.xxhash64("doc_id", "text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labels, rejects go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_place``: by id, rows without one last; rows of one id by their contents."""
    rows = materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "near_duplicates-rows")
    order = [F.col("doc_id").isNull().alias("_unnamed"), "doc_id", F.xxhash64(*docs.columns).alias("_hash"), "_row"]
    places = numbered(rows.select(*order), ["_unnamed", "doc_id", "_hash", "_row"], "near_duplicates-order")
    places = materialise(places.select("_row", F.col("position").alias("_place")), "near_duplicates-places")
    return rows.join(places, "_row").drop("_row")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group stays: that of the smallest id, one without id only if none has one.

    Rows that repeat an id are rows of their own, by their place.
    """
    named = docs.groupBy("doc_id").count()
    if not named.where("count > 1 or doc_id is null").isEmpty():
        placed = _placed(docs)
        found = materialise(near_duplicates(placed, doc_id="_place", width=5, percent=80), "near_duplicates")
        copies = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_place"))
        return placed.join(copies, "_place", "left_anti").select(*docs.columns)
    found = materialise(near_duplicates(docs, width=5, percent=80), "near_duplicates")
    return docs.join(found.where("doc_id <> component_id").select("doc_id"), "doc_id", "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials are masked in the texts; examples that several owners hold stay.

    Only texts that could hold a secret are written apart, scanned and joined with what
    is found; the others pass as they are.
    """
    suspect = may_hold_secrets(F.col("text"))
    keyed = materialise(_keyed(docs.where(suspect)), "suspects")
    _, findings = scan(keyed, doc_id="_key", repository=F.concat_ws("/", "source", "lang"))
    spans = (
        findings.where("verdict = 'live'")
        .groupBy(F.col("doc_id").alias("_key"))
        .agg(F.collect_set(F.struct("start", "end")).alias("_spans"))
    )
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(masked(F.col("text"), F.col("_spans")))
    done = keyed.join(spans, "_key", "left").withColumn("text", text)
    length = F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    done = done.withColumn("n_chars", length).select(*docs.columns)
    return docs.where(~suspect).unionByName(done)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in training order."""
    keyed = _keyed(docs)
    mixed = mix(keyed.dropDuplicates(["_key"]) if _repeats(keyed) else keyed, doc_id="_key")
    taken = mixed.select(F.col("doc_id").alias("_key"), F.explode("positions").alias("position"))
    return joined_in_training_order(keyed, taken, "_key").select(*docs.columns)


def _repeats(keyed: DataFrame) -> bool:
    return not keyed.groupBy("_key").count().where("count > 1").isEmpty()


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digest of what they decode to."""
    coded = encode_and_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    digest = F.sha2(F.col("decoded").cast("binary"), 256)
    return coded.select("doc_id", "n_tokens", "ids", digest.alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# SQL can express neither the classifier nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
