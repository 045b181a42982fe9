"""Near-duplicate vectors by counting collisions on one-dimensional projections.

Unit vectors are projected onto many random directions. Beyond a cut-off at both ends of a
direction is a tail, which holds few rows: a vector is in the tail of few directions, but
one that is close to it is likely to be there, too. Two vectors collide in a tail where either is
in the window around the other; tails are not sorted, all their pairs are formed, and the
window drops few of them. Pairs that collide ``least`` times
are verified by their cosine. Cut-off, window and number of directions follow from
the number of rows and from the chance, for a pair right at the threshold, to collide
that often, which is at least ``recall``.

Groups of copies are not expanded. Equal vectors are one row with a weight. Vectors
within half the threshold's angle of a hub are all linked to one another (the angle
is a metric): such a ball stands in the tails as one row, and two balls are told linked
or apart by their hubs and radii where that suffices; only what is left goes by
single vectors.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialise
from .frames import map_arrow, numbered
from .graph import connected_components

_CELL_DIRECTIONS = 24
_CELLS = 3
_MARGIN = 1e-7  # radians by which a bound must hold before it spares a verification


def _above(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2))


def collision_chance(cut: float, window: float, cosine: float) -> float:
    """That two unit vectors of this cosine are both beyond ``cut`` within ``window``."""
    spread = math.sqrt(1 - cosine**2)
    grid = np.linspace(cut, cut + 6, 2001)
    total = 0.0
    for u in grid:
        low, high = max(cut, u - window), u + window
        inside = _above((low - cosine * u) / spread) - _above((high - cosine * u) / spread)
        total += math.exp(-u * u / 2) / math.sqrt(2 * math.pi) * max(0.0, inside)
    return total * (grid[1] - grid[0])


@lru_cache
def calibrated(n: int, cosine: float, recall: float, least: int) -> tuple[float, float, int]:
    """``(cut, window, directions)`` for ``n`` vectors.

    A tail holds a share of the rows that falls with the root of their number, so that
    both the projections and the pairs in the tails grow with its power 1.5.
    """
    share = min(0.02, 0.113 / math.sqrt(max(n, 1)))
    low, high = 0.0, 10.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if _above(middle) > share else (low, middle)
    cut, window = low, 3 * math.sqrt(1 - cosine**2)
    chance = collision_chance(cut, window, cosine)
    mean = 0.0
    missed = 1.0
    while missed > 1 - recall:  # fewer than `least` collisions, as a Poisson count
        mean += 0.05
        missed = sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(least))
    return cut, window, math.ceil(mean / chance / 2)


@lru_cache(maxsize=4)
def _directions(dimensions: int, number: int, seed: int) -> np.ndarray:
    random = np.random.default_rng([seed, dimensions])
    return random.standard_normal((dimensions, number), dtype=np.float32)


def _prepared(vectors: DataFrame) -> DataFrame:
    """Each row's unit vector (null where it links with nothing), its digest and its cells."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        units: list[np.ndarray | None] = []
        cells: list[list[int]] = []
        for found in batch.column("vector").to_pylist():
            vector = np.array([np.nan if x is None else x for x in found or [np.nan]], dtype=np.float64)
            scale = np.abs(vector).max() if np.isfinite(vector).all() else 0.0
            if not scale > 0:
                units.append(None)
                cells.append([])
                continue
            vector = vector / scale
            unit = vector / np.sqrt(vector @ vector)
            units.append(unit)
            values = unit.astype(np.float32) @ _directions(len(unit), _CELLS * _CELL_DIRECTIONS, 3)
            best = np.argsort(-values.reshape(_CELLS, -1), axis=1, kind="stable")[:, :2].astype(np.int64)
            key = best[:, 0] * 64 + best[:, 1] + len(unit) * 4096
            cells.append(key.tolist())
        digests = [None if u is None else hashlib.blake2b(u.tobytes(), digest_size=16).digest() for u in units]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"),
                pa.array(digests, pa.binary()),
                pa.array([None if u is None else u.tolist() for u in units], pa.list_(pa.float64())),
                pa.array(cells, pa.list_(pa.int64())),
            ],
            ["vec_id", "digest", "unit", "cells"],
        )

    return map_arrow(vectors, of, "vec_id long, digest binary, unit array<double>, cells array<long>")


def _dot(a: str, b: str) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.when(
        F.size(a) == F.size(b), F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    ).otherwise(-1.0)


def _angle(cosine: Column) -> Column:
    return F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0)))


def _balls(classes: DataFrame, half: float) -> DataFrame:
    """``classes`` with ``hub`` and ``angle``; hubs and vectors on their own have angle 0."""
    rest = classes.withColumn("hub", F.lit(None).cast("long")).withColumn("angle", F.lit(0.0))
    done = None
    for turn in range(_CELLS):
        cell = F.col("cells")[turn]
        hubs = rest.groupBy(cell.alias("cell")).agg(
            F.min(F.struct("vec_id", "unit")).alias("h"), F.count(F.lit(1)).alias("n")
        )
        hubs = hubs.where("n > 1").select("cell", F.col("h.vec_id").alias("_hub"), F.col("h.unit").alias("_unit"))
        tried = (
            rest.withColumn("cell", cell)
            .join(hubs, "cell", "left")
            .withColumn("_angle", F.when(F.col("vec_id") == F.col("_hub"), 0.0).otherwise(_angle(_dot("unit", "_unit"))))
        )
        near = F.col("_angle") <= half
        tried = materialise(
            tried.withColumn("hub", F.when(near, F.col("_hub")))
            .withColumn("angle", F.when(near, F.col("_angle")).otherwise(0.0))
            .drop("cell", "_hub", "_unit", "_angle"),
            "balls",
        )
        # A hub without others stays free for the next turn.
        full = tried.where("hub is not null").groupBy("hub").count().where("count > 1").select("hub")
        members = tried.join(full, "hub", "left_semi").select(*rest.columns)
        done = members if done is None else done.union(members)
        rest = tried.join(full, "hub", "left_anti").select(*rest.columns)
    alone = rest.withColumn("hub", F.col("vec_id")).withColumn("angle", F.lit(0.0))
    return materialise(done.union(alone).drop("cells"), "balls")


def _tails(members: DataFrame, cut: float, directions: int) -> DataFrame:
    """``tail, hub, value`` of every vector and every direction in whose tail it is."""

    def of(batches):
        for batch in batches:
            units = batch.column("unit")
            sizes = np.diff(np.asarray(units.offsets))
            flat = np.asarray(units.flatten())
            ends = np.cumsum(sizes)
            hubs = np.asarray(batch.column("hub"))
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                matrix = flat[(ends[rows] - size)[:, None] + np.arange(size)].astype(np.float32)
                for a in range(0, len(rows), 256):
                    for b in range(0, directions, 4096):
                        part = _directions(int(size), directions, 5)[:, b : b + 4096]
                        values = matrix[a : a + 256] @ part
                        row, column = np.nonzero(np.abs(values) >= cut)
                        value = values[row, column]
                        tail = ((column + b) * 2 + (value < 0)).astype(np.int64) + (int(size) << 40)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(tail), pa.array(hubs[rows[a + row]]), pa.array(np.abs(value))],
                            ["tail", "hub", "value"],
                        )

    return members.select("hub", "unit").mapInArrow(of, "tail long, hub long, value float")


def near_vectors(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    cosine: float = 0.9,
    recall: float = 0.999,
    least: int = 2,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``vectors``.

    Links are pairs of cosine at least ``cosine`` (between 0.5 and 1), found with
    probability ``recall`` or more each and verified in double precision. A vector that
    is null, empty, zero or not finite links with nothing. Vectors of different lengths
    never link. Rows that repeat a ``vec_id`` are vectors like any others, with links of their own and of one
    component; a null id has no links and no component. Further columns are passed over.
    """
    prepared = materialise(
        _prepared(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))),
        "vectors",
    )
    usable = prepared.where("vec_id is not null and digest is not null")
    of_id = usable.groupBy("vec_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
    if of_id.where("a <> b").isEmpty():
        return _linked(prepared, cosine, recall, least)
    # Vectors are told apart by their places in the order of ids.
    places = numbered(usable.select("vec_id", "digest").distinct(), ["vec_id", "digest"], "places")
    places = materialise(places.withColumnRenamed("position", "place"), "places")
    keyed = usable.join(places, ["vec_id", "digest"])
    keyed = materialise(keyed.select(F.col("place").alias("vec_id"), "digest", "unit", "cells"), "vectors")
    found = _linked(keyed, cosine, recall, least).select(F.col("vec_id").alias("place"), "n_links", "component_id")
    found = materialise(found.dropDuplicates(["place"]).join(places, "place"), "links")
    # Vectors of one id are of one component.
    first = found.groupBy("vec_id").agg(F.min("component_id").alias("a"))
    tied = found.select("vec_id", F.col("component_id").alias("b")).join(first, "vec_id")
    tied = connected_components(tied.select("a", "b")).withColumnRenamed("component_id", "whole")
    found = found.join(tied.withColumnRenamed("id", "component_id"), "component_id", "left")
    # The first place of a component is that of its smallest id.
    root = places.select(F.col("place").alias("whole"), F.col("vec_id").alias("component_id"))
    found = found.withColumn("whole", F.coalesce("whole", "component_id")).drop("component_id")
    found = found.join(root, "whole").select("vec_id", "digest", "n_links", "component_id")
    return _told(prepared, found, ["vec_id", "digest"])


def _told(prepared: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """The result's columns for each row; rows that ``found`` lacks link with nothing."""
    return prepared.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest")).join(
        found, by, "left"
    ).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )


def _linked(prepared: DataFrame, cosine: float, recall: float, least: int) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of vectors of which each id has one, if several times."""
    usable = prepared.where("vec_id is not null and digest is not null")
    copies = materialise(
        usable.groupBy("digest").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight")),
        "copies",
    )
    classes = usable.dropDuplicates(["digest", "vec_id"]).join(copies, ["digest", "vec_id"])
    limit = math.acos(cosine)
    members = _balls(classes.select("vec_id", "digest", "weight", "unit", "cells"), limit / 2 - _MARGIN)
    balls = members.groupBy("hub").agg(
        F.max("angle").alias("radius"), F.sum("weight").alias("weight")
    )
    centres = materialise(
        members.where("vec_id = hub").select("hub", "unit").dropDuplicates(["hub"]).join(balls, "hub"), "centres"
    )
    cut, window, directions = calibrated(max(copies.count(), 1), cosine, recall, least)
    tails = materialise(
        _tails(members, cut, directions)
        .groupBy("tail", "hub")
        .agg(F.min("value").alias("low"), F.max("value").alias("high")),
        "tails",
    )
    other = tails.select("tail", F.col("hub").alias("b"), F.col("low").alias("l"), F.col("high").alias("h"))
    counted = (
        tails.withColumnRenamed("hub", "a")
        .join(other, "tail")
        .where((F.col("a") < F.col("b")) & (F.col("l") - F.col("high") <= window) & (F.col("low") - F.col("h") <= window))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
    )
    left = centres.select(*[F.col(c).alias(n) for c, n in (("hub", "a"), ("unit", "_a"), ("radius", "ra"), ("weight", "wa"))])
    right = centres.select(*[F.col(c).alias(n) for c, n in (("hub", "b"), ("unit", "_b"), ("radius", "rb"), ("weight", "wb"))])
    close = counted.join(left, "a").join(right, "b").withColumn("dot", _dot("_a", "_b")).drop("_a", "_b")
    reach, gap = F.col("ra") + F.col("rb"), _angle(F.col("dot"))
    linked = F.when(reach == 0, F.col("dot") >= cosine).otherwise(gap + reach <= limit - _MARGIN)
    pairs = materialise(
        close.withColumn("linked", linked).where(F.col("linked") | (reach > 0) & (gap - reach <= limit + _MARGIN)),
        "pairs",
    )
    both = pairs.where("linked").select("a", "b", "wa", "wb")
    # Whole balls: each vector of one gets the weight of the other.
    to_balls = both.select(F.col("a").alias("hub"), F.col("wb").alias("n")).union(both.select("b", "wa"))
    edges = [members.select(F.col("vec_id").alias("a"), F.col("hub").alias("b")), both.select("a", "b")]
    # A vector of one ball against the other ball as a whole.
    own = members.select(F.col("hub").alias("a"), F.col("vec_id").alias("x"), F.col("unit").alias("_x"), F.col("weight").alias("wx"), F.col("digest").alias("dx"))
    single = (
        pairs.where("not linked")
        .select("a", "b", "rb", "wb")
        .join(own, "a")
        .join(right.select("b", "_b"), "b")
        .withColumn("dot", _dot("_x", "_b"))
    )
    gap = _angle(F.col("dot"))
    linked = F.when(F.col("rb") == 0, F.col("dot") >= cosine).otherwise(gap + F.col("rb") <= limit - _MARGIN)
    single = materialise(
        single.withColumn("linked", linked).where(
            F.col("linked") | (F.col("rb") > 0) & (gap - F.col("rb") <= limit + _MARGIN)
        ),
        "pairs",
    )
    whole = single.where("linked")
    to_balls = to_balls.union(whole.select("b", F.col("wx")))
    to_vectors = whole.select(F.col("dx").alias("digest"), F.col("wb").alias("n"))
    edges.append(whole.select("x", "b"))
    # What is still open, vector by vector.
    theirs = members.select(F.col("hub").alias("b"), F.col("vec_id").alias("y"), F.col("unit").alias("_y"), F.col("weight").alias("wy"), F.col("digest").alias("dy"))
    last = materialise(
        single.where("not linked")
        .join(theirs, "b")
        .where(_dot("_x", "_y") >= cosine)
        .select("x", "y", "dx", "dy", "wx", "wy"),
        "links",
    )
    to_vectors = to_vectors.union(last.select("dx", "wy")).union(last.select("dy", "wx"))
    edges.append(last.select("x", "y"))
    links = edges[0]
    for more in edges[1:]:
        links = links.union(more)
    components = connected_components(links)
    of_balls = to_balls.groupBy("hub").agg(F.sum("n").alias("more"))
    of_vectors = to_vectors.groupBy("digest").agg(F.sum("n").alias("extra"))
    told = (
        members.select("digest", "vec_id", "hub")
        .join(balls.select("hub", F.col("weight").alias("ball")), "hub")
        .join(of_balls, "hub", "left")
        .join(of_vectors, "digest", "left")
        .join(components.withColumnRenamed("id", "vec_id"), "vec_id", "left")
        .select(
            "digest",
            (F.col("ball") - 1 + F.coalesce("more", F.lit(0)) + F.coalesce("extra", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
    )
    return _told(prepared, told, ["digest"])
