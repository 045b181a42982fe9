"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .best_fit import packed, token_pieces
from .bpe import encode_and_decode
from .embedding_dedup import near_vectors
from .frames import table
from .html_text import extract
from .minhash_dedup import near_duplicates
from .mixing import in_training_order, mix
from .order_minhash import compared_with_edited
from .packing import pack
from .periodic_runs import periodic_runs, split_words
from .quality import quality
from .secret_scan import scan
from .toxicity import toxicity
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents, by shingles of four words as the contract has it."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@query
def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-sensitive fingerprints of all documents and of their edited texts."""
    return compared_with_edited(table(spark, sf_dir, "documents"))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often and when each document is taken when sources weigh 1, 2, 3 by turns."""
    return in_training_order(mix(table(spark, sf_dir, "documents")).drop("positions"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, with how many of them are live and how many copied.

    A source is an owner, its part in one language a repository.
    """
    documents, findings = scan(
        table(spark, sf_dir, "documents"), repository=F.concat_ws("/", "source", "lang")
    )
    verdicts = findings.groupBy("doc_id").agg(
        F.count_if(F.col("verdict") == "live").alias("n_live"),
        F.count_if(F.col("verdict") == "copied").alias("n_copied"),
    )
    return documents.join(verdicts, "doc_id", "left").na.fill(0, ["n_live", "n_copied"])


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, trained on the labels outside the held-out third."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    scored = toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train_on=~held_out
    )
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, trained on the labels outside the held-out quarter."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    scored = quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train_on=~held_out
    )
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' token ids and of what they decode to."""
    coded = encode_and_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token ids, packed into rows of 2048."""
    return pack(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    found = extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all vectors by cosine 0.9."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces, packed into sequences of 2048 tokens by best fit."""
    pieces = token_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    narrow = pieces.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return packed(narrow)


def words_with_a_planted_period(doc_id: int | None, text: str) -> list[bytes]:
    """The words of a text; a tenth of the ids gets a stretch repeated up to the text's end.

    Rows without an id keep their words.
    """
    words = split_words(doc_id, text)
    if doc_id is None or not words:
        return words
    drawn, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if last:
        return words
    start = drawn % len(words)
    rest = len(words) - start
    period = 1 + rest // (3 + drawn % 8)
    repeated = words[start : start + period] * -(-rest // period)
    return words[:start] + repeated[:rest]


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents, and digests of the texts without the repeats."""
    found = periodic_runs(
        table(spark, sf_dir, "documents"), words_of=words_with_a_planted_period
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    # The longest run, then the one that starts first, then the shortest period.
    ranked = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    longest = F.array_max(ranked)
    return found.withColumn("_longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_longest.col2")).alias("start"),
        F.col("_longest.length").alias("length"),
        (-F.col("_longest.col3")).alias("period"),
        F.expr("1000 * _longest.length div -_longest.col3").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of all vectors."""
    return whiten(table(spark, sf_dir, "embeddings"))
