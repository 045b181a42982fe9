"""Packing token ids into rows of one length by best fit, largest first.

Documents are dealt to shards of about ``shard_rows`` by a hash of their id. A shard's
texts are encoded in batches; documents longer than a row are split into full rows
and a rest, so no token is lost. The pieces go, longest first, into the open row
that they fit best; a segment tree over the capacities finds it in logarithmic time.
A packed row holds the ids, padded to the full length, the cumulative lengths of its
segments, and positions that restart with each of them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "shard long, row int, n_tokens int, ids binary, segment_ends array<int>, positions binary,"
    " doc_ids array<long>, doc_starts array<long>"
)


class CapacityTree:
    """How many open rows have each free capacity; finds the least that suffices."""

    def __init__(self, most: int):
        self.size = 1 << max(1, most).bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, free: int, row: int) -> None:
        self.open[free].append(row)
        at = free + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """``(free, row)`` of the tightest row with at least ``need`` free, removed."""
        at = need + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.size
        row = self.open[free].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return free, row


def best_fit(lengths: list[int], size: int) -> list[int]:
    """The row of each piece, none longer than ``size``; longest first, ties in order."""
    tree, rows, placed = CapacityTree(size), 0, [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            found, rows = (size, rows), rows + 1
        free, placed[i] = found
        if free > lengths[i]:
            tree.add(free - lengths[i], placed[i])
    return placed


def packed(documents: list[tuple[int | None, np.ndarray]], size: int, pad: int) -> Iterator[dict]:
    """Rows of ``size`` ids from ``(doc_id, ids)``; documents without ids give nothing."""
    pieces = [
        (doc, start, ids[start : start + size])
        for doc, ids in documents
        for start in range(0, len(ids), size)
    ]
    rows: dict[int, list] = {}
    for piece, row in zip(pieces, best_fit([len(p[2]) for p in pieces], size), strict=True):
        rows.setdefault(row, []).append(piece)
    for row in sorted(rows):
        lengths = [len(p[2]) for p in rows[row]]
        used = sum(lengths)
        ids = np.full(size, pad, dtype="<u4")
        ids[:used] = np.concatenate([p[2] for p in rows[row]])
        positions = np.zeros(size, dtype="<u4")
        ends = np.cumsum(lengths)
        positions[:used] = np.arange(used) - np.repeat(ends - lengths, lengths)
        yield {
            "row": row,
            "n_tokens": used,
            "ids": ids.tobytes(),
            "segment_ends": ends.tolist(),
            "positions": positions.tobytes(),
            "doc_ids": [p[0] for p in rows[row]],
            "doc_starts": [p[1] for p in rows[row]],
        }


def _encoder(ranks: bytes, pattern: str):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    own = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=own, special_tokens={})


def pack(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 2048,
    pad: int = 0,
    shard_rows: int = 2048,
) -> DataFrame:
    """Packed rows ``(shard, row)`` of all ``docs``, with the columns of ``SCHEMA``.

    ``ids`` and ``positions`` are little-endian unsigned 32-bit integers, ``size`` of
    each; beyond ``n_tokens`` they are padding. ``doc_starts`` tells where in its document a
    segment begins. The number of shards follows from the number of rows alone, so
    the result does not depend on how the input is dealt; rows that repeat an id or have none
    spread over all shards. Null and empty texts have no
    tokens and give nothing. Repeated rows are packed each; null ids are kept as null.
    Further columns are passed over. Written as Parquet the rows are the matrices.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, most = docs.groupBy("doc_id").count().agg(F.sum("count"), F.max("count")).first()
    shards = max(1, -(-(rows or 0) // shard_rows))
    with open(ranks_file, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    held: dict = {}

    def of(group: pa.Table) -> pa.Table:
        if not held:
            held["encoder"] = _encoder(ranks.value, pattern)
        encode = held["encoder"].encode_ordinary
        group = group.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        documents = (
            (doc.as_py(), np.array(encode(words.as_py() or ""), dtype="<u4"))
            for doc, words in zip(group.column("doc_id"), group.column("text"), strict=True)
        )
        rows = list(packed(list(documents), size, pad))
        shard = group.column("shard")[0].as_py()
        return pa.Table.from_pylist([r | {"shard": shard} for r in rows], _ARROW)

    by = ["doc_id"]
    if (most or 0) > 1:
        # Rows of one id are dealt by their texts, too, and equal rows by their number.
        by = ["doc_id", "digest", "copy"]
        equal = docs.where("text <> ''").groupBy("doc_id", F.sha2("text", 256).alias("digest"))
        equal = equal.agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
        docs = equal.withColumn("copy", copies)
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64(*by), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(of, SCHEMA)


_ARROW = pa.schema(
    [
        ("shard", pa.int64()),
        ("row", pa.int32()),
        ("n_tokens", pa.int32()),
        ("ids", pa.binary()),
        ("segment_ends", pa.list_(pa.int32())),
        ("positions", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_starts", pa.list_(pa.int64())),
    ]
)
