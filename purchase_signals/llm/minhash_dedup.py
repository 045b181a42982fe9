"""Near-duplicate texts by one-permutation MinHash.

One hash orders a text's word shingles; ``bands * rows`` bins each keep their
smallest. An empty bin borrows from the first filled bin of its own fixed random
order of all bins ("optimal" densification), so texts of any length give full
signatures whose bins agree with the probability of the sets' similarity. Bands
of bins are bucket keys. In a bucket one text is the hub, and only edges from it
to the others are candidates: a star instead of all pairs. Candidates are confirmed
on the full sets.

What a star can miss are links between two texts of which at least one is not linked
to their common hub. Such texts differ from the hub in some shingles, and if they are
a link then largely in the same ones. So texts of a bucket that is not one component
by then are indexed by their differences from its hub, rarest first, and only texts
that share one of those early enough for a link are held against each other. This is
exact: stars and differences together find each link that all pairs of all buckets
would, without ever pairing a bucket's texts.

With 46 bands of 6 rows a pair of similarity 0.8 misses all buckets with
probability (1 - 0.8**6)**46, below one in a million.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialise
from . import hashing
from .frames import map_arrow
from .graph import connected_components

_SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>"


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])]


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's distinct word shingles as sorted 64-bit hashes.

    Fewer words than ``width`` make one shingle; without words the set is empty.
    """
    kinds, fold = hashing.spaced_kinds(), hashing.lower_fold()
    hashes, starts = hashing.words_by_text(column, kinds, fold)
    factor = np.uint64(0x9E3779B97F4A7C15)

    def chained(parts: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(parts[0]), len(parts), dtype=np.uint64)
        for part in parts:
            out = hashing.mix(out * factor + part)
        return out

    found = []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        own = hashes[a:b]
        if len(own) < width:
            found.append(chained([own[i : i + 1] for i in range(len(own))]) if len(own) else own)
        else:
            found.append(_distinct(chained([own[i : len(own) - width + 1 + i] for i in range(width)])))
    return found


@cache
def _places(bins: int, seed: int) -> np.ndarray:
    """Row j: the place of every bin in bin j's own random order."""
    random = np.random.default_rng(seed)
    return np.stack([random.permutation(bins) for _ in range(bins)]).astype(np.int32)


def signature(shingles: np.ndarray, bins: int, seed: int = 7) -> np.ndarray:
    """One value per bin for a set that is not empty."""
    order = np.sort(hashing.mix(shingles ^ np.uint64(0xD6E8FEB86659FD93)))
    at = ((order >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    filled = at[first]
    out = np.zeros(bins, dtype=np.uint64)
    out[filled] = order[first]
    if len(filled) < bins:
        empty = np.setdiff1d(np.arange(bins), filled, assume_unique=True)
        nearest = _places(bins, seed)[np.ix_(empty, filled)].argmin(axis=1)
        out[empty] = order[first][nearest]
    return out


def band_keys(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    values = signature(shingles, bands * rows).reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        keys = hashing.mix(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, i])
    return keys.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Per row: the size of its set, a digest of the set and its bucket keys."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), width)
        keys = [band_keys(s, bands, rows) if len(s) else s.view(np.int64) for s in sets]
        ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ],
            ["doc_id", "n_shingles", "digest", "bands"],
        )

    return map_arrow(docs, sign, _SIGNED)


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The full sets of the texts in ``wanted (doc_id)``."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column("text"), width)
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
            ["doc_id", "shingles"],
        )

    return map_arrow(docs.join(wanted, "doc_id", "left_semi"), of, "doc_id long, shingles array<long>")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs (a, b)`` with the sizes of the intersection and the union of their full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_right"))
    shared = F.size(F.array_intersect("_left", "_right"))
    union = F.size("_left") + F.size("_right") - F.col("shared")
    joined = pairs.join(left, "a").join(right, "b").withColumn("shared", shared)
    return joined.select("a", "b", "shared", union.alias("either"))


def _differences(spread: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each text of ``spread (hub, doc_id)`` by the shingles in which it differs from its hub.

    With D the shingles that only one of a text and the hub has, two texts differ in
    ``|D| + |D'| - 2 |D & D'|`` shingles. They are a link exactly if ``100 + percent`` times
    that is at most ``100 - percent`` times the sum of their sizes, so exactly if
    ``2 (100 + percent) |D & D'|`` reaches the sum of their ``need``, which is
    ``(100 + percent) |D| - (100 - percent) size``. A text is no link of its hub exactly if its
    need exceeds ``(100 - percent) hub size``; every need exceeds minus that, so a link of
    which one text is no link of the hub has some difference in common.

    Returns ``hub, doc_id, n, need, outside, item, left``: ``left`` is how many differences
    from ``item`` on the text has when they are sorted by their number in all texts of the
    hub. Those of which too few are left, or that no other text has, are not returned.
    """
    own = sets.select("doc_id", F.col("shingles").alias("_own"))
    of_hub = sets.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("_hub"))
    apart = F.concat(F.array_except("_own", "_hub"), F.array_except("_hub", "_own"))
    level = (100 - percent) * F.col("n_hub")
    need = (100 + percent) * F.size("apart") - (100 - percent) * F.col("n")
    spread = (
        spread.join(own, "doc_id")
        .join(of_hub, "hub")
        .select("hub", "doc_id", F.size("_own").alias("n"), F.size("_hub").alias("n_hub"), apart.alias("apart"))
        .select("hub", "doc_id", "n", need.alias("need"), (need > level).alias("outside"), level.alias("level"), "apart")
    )
    each = materialise(spread.withColumn("item", F.explode("apart")).drop("apart"), "differences")
    counts = each.groupBy("hub", "item").agg(F.count(F.lit(1)).alias("texts"))
    ordered = (
        each.join(counts, ["hub", "item"])
        .groupBy("hub", "doc_id", "n", "need", "outside", "level")
        .agg(F.array_sort(F.collect_list(F.struct("texts", "item"))).alias("items"))
    )
    # A text outside may be held against all others, one inside only against those outside.
    least = F.col("need") + F.when(F.col("outside"), -F.col("level")).otherwise(F.col("level"))
    return (
        ordered.select(
            "hub", "doc_id", "n", "need", "outside", F.size("items").alias("size"), least.alias("least"),
            F.posexplode("items").alias("place", "found"),
        )
        .withColumn("left", F.col("size") - F.col("place"))
        .where((F.col("found.texts") > 1) & (2 * (100 + percent) * F.col("left") >= F.col("least")))
        .select("hub", "doc_id", "n", "need", "outside", "found.item", "left")
    )


def _beside_hubs(indexed: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of texts of different components that ``_differences`` does not rule out."""
    rows = indexed.join(components.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id")
    )
    rows = materialise(rows, "differences")
    # Each pair once: of two texts outside, the one of the smaller id comes first.
    other = rows.select("hub", "item", *[F.col(c).alias(f"_{c}") for c in rows.columns if c not in ("hub", "item")])
    return (
        rows.where("outside")
        .join(other, ["hub", "item"])
        .where("component_id <> _component_id and (not _outside or doc_id < _doc_id)")
        .where(100 * F.least("n", "_n") >= percent * F.greatest("n", "_n"))
        .where(2 * (100 + percent) * F.least("left", "_left") >= F.col("need") + F.col("_need"))
        .select(F.least("doc_id", "_doc_id").alias("a"), F.greatest("doc_id", "_doc_id").alias("b"))
        .distinct()
    )


def _linked_classes(
    docs: DataFrame, classes: DataFrame, width: int, percent: int
) -> DataFrame:
    """Components of the class representatives: ``(id, component_id)``, linked ones only."""
    rows = classes.select(
        "doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")
    )
    buckets = (
        rows.groupBy("bucket")
        .agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("size"))
        .where("hub <> last")
        .select("bucket", "size")
    )
    waiting = materialise(rows.join(buckets, "bucket"), "buckets")
    # The text that shares most bins with others, such as the original of many edited
    # copies, makes the best hub.
    met = waiting.groupBy("doc_id").agg(F.sum("size").alias("met"))
    waiting = materialise(waiting.drop("size").join(met, "doc_id"), "buckets")
    sets = materialise(_sets(docs, met.select("doc_id"), width), "shingles")

    def confirmed(pairs: DataFrame) -> DataFrame:
        measured = _measured(materialise(pairs, "pairs"), sets)
        found = measured.where(100 * F.col("shared") >= percent * F.col("either")).select("a", "b")
        return materialise(found, "links")

    central = waiting.groupBy("bucket").agg(F.max(F.struct("met", "doc_id", "n")).alias("hub"))
    central = central.select("bucket", F.col("hub.doc_id").alias("hub"), F.col("hub.n").alias("n_hub"))
    links = confirmed(
        waiting.join(central, "bucket")
        .where("hub <> doc_id")
        .where(100 * F.least("n", "n_hub") >= percent * F.greatest("n", "n_hub"))
        .select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b"))
        .distinct()
    )
    components = materialise(connected_components(links), "components")
    now = waiting.join(components.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id")
    )
    # A bucket that is one component is done, and so are the hubs, which met everyone.
    open_buckets = (
        now.groupBy("bucket")
        .agg(F.min("component_id").alias("low"), F.max("component_id").alias("high"))
        .where("low <> high")
        .select("bucket")
    )
    spread = (
        waiting.select("bucket", "doc_id")
        .join(central.join(open_buckets, "bucket").select("bucket", "hub"), "bucket")
        .where("hub <> doc_id")
        .select("hub", "doc_id")
        .distinct()
    )
    spread = materialise(spread, "spread")
    several = spread.groupBy("hub").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("hub")
    spread = spread.join(several, "hub", "left_semi")
    if spread.isEmpty():
        return components
    more = confirmed(_beside_hubs(_differences(spread, sets, percent), components, percent))
    if more.isEmpty():
        return components
    return materialise(connected_components(links.union(more)), "components")


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = 46,
    rows: int = 6,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Texts are lower-cased (A-Z) and parted at ASCII white space. Two are linked if
    100 times the shared shingles reach ``percent`` times those in either. Texts
    with equal sets are first made one class, so that copies cost one row each,
    however many; only classes meet in buckets. A null or empty text has no
    shingles and stays alone. Rows that repeat a ``doc_id`` are rows of one
    document and all returned; a row without id links with nothing and has no
    component. Further columns are passed over.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = materialise(signatures(docs, width, bands, rows), "signatures")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    classes = materialise(
        full.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "classes"
    )
    banded = full.join(classes, ["digest", "doc_id"], "left_semi")
    components = _linked_classes(docs, banded, width, percent)
    roots = classes.join(components.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "digest", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(roots, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id"))
            .otherwise(F.col("doc_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )
