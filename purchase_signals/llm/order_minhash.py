"""Fingerprints of texts by order MinHash.

A text's k-mers are numbered by occurrence, so that the second "abcdef" is another
item than the first. For each of ``sketches`` random orders the two smallest items are
taken, put back in the order in which they stand in the text, and hashed as a tuple.
Two texts share a tuple if they share the items *and* their order, so likeness falls
with edit distance, not only with the overlap of sets (Marcais et al., 2019).

All items of a text compete in all orders. Each item has one random hash; the orders
are those in which the items follow 32 fixed points on the circle of hashes. In each of
them any two items are equally likely to be the smallest, and a sorted array gives
them without a pass for each order. Orders of a text of few k-mers often begin alike, so
its likeness varies more. All of it is built-in expressions over arrays of longs.

Whole tables are numbered and hashed as rows, not by lambdas over arrays, and only items
near a point are put into arrays again: the two smallest items of an order are nearly always
among them. Where they are not, which shows afterwards, a text's items are taken all.
"""

from __future__ import annotations

import hashlib

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialise
from .frames import numbered

SHINGLE = 6
SKETCHES = 32
# The low bits of a hash hold the item's place; an array of more strings is too large for Spark.
_BITS = 27
_PLACE = (1 << _BITS) - 1
# Occurrences below this number are told by looking back in the sorted array, row by row.
_LOOK_BACK = 8
# Items are taken from each point on as far as this many are expected.
_NEAR = 24
# An order's length in steps of the bits above the place.
_ROUND = 1 << (64 - _BITS)
# Texts are dealt to so many times the shuffle partitions, which bounds a task's rows.
_FINER = 4
_SEEDS = [
    int.from_bytes(hashlib.sha256(b"order %d" % i).digest()[:8], "big", signed=True) for i in range(SKETCHES)
]
_PLACED = ["named", "key", "digest"]


def _kmers(text: Column) -> Column:
    """All k-mers in text order; a shorter text is one, an empty one none."""
    kmers = F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{SHINGLE}}}))"), F.lit(1))
    return (
        F.when(F.length(text) >= SHINGLE, kmers)
        .when(F.length(text) > 0, F.array(text))
        .otherwise(F.expr("cast(array() as array<string>)"))
    )


def _kmer(placed: Column) -> Column:
    return placed.bitwiseAND(F.lit(~_PLACE))


def _place(placed: Column) -> Column:
    return placed.bitwiseAND(F.lit(_PLACE))


def placed_kmers(text: Column, after: Column | None = None) -> Column:
    """Hashes of all k-mers above their places, in text order; places begin at ``after``."""
    place = (lambda i: i) if after is None else lambda i: i + after
    return F.transform(_kmers(text), lambda k, i: _kmer(F.xxhash64(k)).bitwiseOR(place(i).cast("long")))


def _items(placed: Column, starts: Column, number: int = 0) -> Column:
    """Hashes of k-mers joined with the number of the occurrence, above the item's place.

    ``placed`` holds the k-mers' hashes above their places, sorted, so that those of one
    k-mer stand together in text order; ``starts`` tells where each k-mer's own begin. The
    first of each has the number ``number``.
    """

    def at(j: Column) -> Column:
        return F.coalesce(F.get(placed, j), F.lit(0).cast("long"))

    def run(start: Column, k: Column) -> Column:
        last = F.coalesce(F.get(starts, k + 1), F.size(placed)) - 1
        return F.transform(
            F.sequence(start, last),
            lambda j: _kmer(F.xxhash64(_kmer(at(start)), j - start + number)).bitwiseOR(_place(at(j))),
        )

    return F.flatten(F.transform(starts, run))


def _sketch(circle: Column, firsts: Column) -> Column:
    """One tuple hash for each order; an order's two smallest items, in text order."""

    def item(j: Column) -> Column:
        return F.get(circle, j % F.size(circle))

    def tuple_hash(first: Column) -> Column:
        a, b = item(first), item(first + 1)
        hash_a, hash_b = a.bitwiseAND(F.lit(~_PLACE)), b.bitwiseAND(F.lit(~_PLACE))
        in_order = a.bitwiseAND(F.lit(_PLACE)) < b.bitwiseAND(F.lit(_PLACE))
        return (
            F.when(F.size(circle) == 1, F.xxhash64(hash_a))
            .when(in_order, F.xxhash64(hash_a, hash_b))
            .otherwise(F.xxhash64(hash_b, hash_a))
        )

    return F.transform(firsts, tuple_hash)


def _starts(placed: str) -> Column:
    """Where the k-mers of a sorted column of placed ones begin."""

    def begins(j: Column) -> Column:
        kmer, before = (_kmer(F.get(placed, i)) for i in (j, j - 1))
        return ~kmer.eqNullSafe(before)

    places = F.sequence(F.lit(0), F.greatest(F.size(placed) - 1, F.lit(0)))
    return F.filter(places, begins)


def _firsts(circle: str) -> Column:
    """How many items of a sorted column lie before each point, by halving steps."""

    def first_after(seed: Column) -> Column:
        return F.aggregate(
            F.array(*[F.lit(1 << b) for b in reversed(range(_BITS))]),
            F.lit(0),
            lambda n, step: F.when(F.get(circle, n + step - 1) < seed, n + step).otherwise(n),
        )

    seeds = F.array(*[F.lit(seed) for seed in _SEEDS])
    return F.when(F.size(circle) > 0, F.transform(seeds, first_after)).otherwise(
        F.slice(F.array(F.lit(0)), 1, 0)
    )


def with_sketch(df: DataFrame, placed: str, name: str) -> DataFrame:
    """``df`` with the sketch of a column of placed k-mers; each step is computed once.

    A column that a lambda reads is made a step earlier and read twice, else Spark
    puts its expression into the lambda and computes it for every element.
    """
    df = df.withColumn("_placed", F.sort_array(placed))
    df = df.withColumn("_starts", _starts("_placed"))
    df = df.withColumn("_circle", F.sort_array(_items(F.col("_placed"), F.col("_starts"))))
    df = df.withColumn("_firsts", _firsts("_circle"))
    df = df.withColumn(name, _sketch(F.col("_circle"), F.col("_firsts")))
    return df.drop("_placed", "_starts", "_circle", "_firsts")


def _since_point(item: str) -> Column:
    """Steps from the last of the points that is not after ``item``, found by halving."""
    step = F.shiftright(item, _BITS)
    points = sorted(seed >> _BITS for seed in _SEEDS)

    def last(low: int, high: int) -> Column:
        if high - low == 1:
            return F.lit(points[low] if low >= 0 else points[-1] - _ROUND)
        half = (low + high) // 2
        return F.when(step >= points[half], last(half, high)).otherwise(last(low, half))

    return step - last(-1, len(points))


def _lacks(circle: str, firsts: str, width: Column) -> Column:
    """Whether a second item lies so far from its point that others may lie before it."""

    def far(first: Column, seed: Column) -> Column:
        second = F.get(circle, (first + 1) % F.size(circle))
        steps = F.shiftright(second, _BITS) - F.shiftright(seed, _BITS)
        return steps + F.when(second < seed, F.lit(_ROUND)).otherwise(F.lit(0)) >= width

    seeds = F.array(*[F.lit(seed) for seed in _SEEDS])
    missed = F.exists(F.zip_with(firsts, seeds, far), lambda e: e)
    return (width <= _ROUND) & ((F.size(circle) < 2) | missed)


def with_both_sketches(df: DataFrame) -> DataFrame:
    """``df`` with sketches in place of ``own`` and ``tail``, and whether they lack items.

    ``df`` has one row for each place (``_PLACED``) and should be dealt by it. ``own`` holds a text's
    placed k-mers; the other text's are the first ``kept`` of these and those in
    ``tail``. A sorted array is numbered, hashed and thinned out as rows. An item is made by a generator
    of its own, else the optimiser puts its expression into all parts of the filter.
    """
    carried = [c for c in df.columns if c not in (*_PLACED, "own", "tail")]
    df = df.withColumn("other", F.concat(F.slice("own", F.lit(1), F.col("kept")), F.col("tail")))
    fewest = F.greatest(F.least(F.size("own"), F.size("other")), F.lit(1))
    df = df.withColumn("width", F.ceil(F.lit(float(_NEAR * _ROUND)) / fewest).cast("long") + 1)
    texts = F.array(*[
        F.struct(F.lit(edited).alias("edited"), F.sort_array(c).alias("placed"))
        for edited, c in ((False, "own"), (True, "other"))
    ])
    df = df.select(*_PLACED, F.struct(*carried, "width").alias("row"), "kept", "width", F.explode(texts).alias("_t"))
    df = df.select(*_PLACED, "row", "kept", "width", "_t.edited", F.col("_t.placed").alias("placed"))
    df = df.select("*", F.posexplode_outer("placed").alias("at", "x"))

    def same(back: int) -> Column:
        return F.shiftright(F.get("placed", F.col("at") - back), _BITS) == F.shiftright("x", _BITS)

    number = F.lit(_LOOK_BACK - 1)
    for back in reversed(range(1, _LOOK_BACK)):
        number = F.when(same(back), number).otherwise(F.lit(back - 1))
    item = _kmer(F.xxhash64(_kmer(F.col("x")), number)).bitwiseOR(_place(F.col("x")))
    item = F.when(same(_LOOK_BACK), F.lit(None)).otherwise(item)
    df = df.select(*_PLACED, "row", "kept", "width", "edited", "at", "x", F.explode(F.array(item)).alias("item"))
    # Of the edited text only what the own one does not have; one row of each text in any case.
    new = ~F.col("edited") | (_place(F.col("x")) >= F.col("kept"))
    head = ~F.col("edited") & (F.coalesce("at", F.lit(0)) == 0)
    df = df.where(F.col("item").isNull() | head | (new & (_since_point("item") < F.col("width"))))
    df = df.select(*_PLACED, F.when(head, F.col("row")).alias("row"), "edited", "x", "item")

    def listed(value: Column, edited: bool) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("edited") == edited, value)))

    late = F.when(F.col("item").isNull(), F.col("x"))
    df = df.groupBy(*_PLACED).agg(
        F.first("row", ignorenulls=True).alias("row"),
        listed(F.col("item"), False).alias("_own"),
        listed(F.col("item"), True).alias("_other"),
        listed(late, False).alias("_own_late"),
        listed(late, True).alias("_other_late"),
    )
    df = df.select(*_PLACED, "row.*", "_own", "_other", "_own_late", "_other_late")
    for name in ("_own", "_other"):
        df = df.withColumn(f"{name}_starts", _starts(f"{name}_late"))
        df = df.withColumn(
            f"{name}_late", _items(F.col(f"{name}_late"), F.col(f"{name}_starts"), _LOOK_BACK)
        )
    kept = F.col("kept")
    df = df.withColumn("_own", F.sort_array(F.concat("_own", "_own_late")))
    df = df.withColumn("_other", F.sort_array(F.concat(
        F.filter("_own", lambda e: _place(e) < kept),
        "_other",
        F.filter("_other_late", lambda e: _place(e) >= kept),
    )))
    for name in ("_own", "_other"):
        df = df.withColumn(f"{name}_firsts", _firsts(name))
    lacks = _lacks("_own", "_own_firsts", F.col("width")) | _lacks("_other", "_other_firsts", F.col("width"))
    return df.select(
        *_PLACED,
        *carried,
        lacks.alias("lacks"),
        *[_sketch(F.col(f"_{c}"), F.col(f"_{c}_firsts")).alias(c) for c in ("own", "other")],
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples; two empty texts are alike, an empty one is like no other."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(same / SKETCHES)
    )


def printed(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), "")


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint``, a row for each row of ``docs``; a null text is an empty one."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), placed_kmers(F.coalesce(F.col(text), F.lit(""))).alias("sketch")
    )
    return with_sketch(rows, "sketch", "sketch").select("doc_id", printed(F.col("sketch")).alias("fingerprint"))


def _with_kmers(rows: DataFrame) -> DataFrame:
    """What is known of each text and its edited one, and their placed k-mers."""
    edge = SHINGLE - 1
    n = F.length("text")
    rows = rows.withColumn("body", n - F.col("cut"))
    body = F.substring(F.col("text"), F.lit(1), F.col("body"))
    joint = F.substring(
        F.col("text"),
        F.greatest(F.col("body") - edge + 1, F.lit(1)),
        F.least(F.lit(edge), F.col("body")),
    )
    edited = F.concat(body, F.col("head"))
    long_enough = F.col("body") >= SHINGLE
    rows = rows.withColumn("kept", F.when(long_enough, F.col("body") - edge).otherwise(0))
    return rows.select(
        *_PLACED,
        "following",
        "times",
        n.cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        placed_kmers(F.col("text")).alias("own"),
        "kept",
        # With a body of some length the k-mers that end in it are known already.
        F.when(
            ~long_enough | (F.length(F.concat(joint, F.col("head"))) >= SHINGLE),
            placed_kmers(F.when(long_enough, F.concat(joint, F.col("head"))).otherwise(edited), F.col("kept")),
        )
        .otherwise(F.slice(F.array(F.lit(0).cast("long")), 1, 0))
        .alias("tail"),
    )


def compared_with_edited(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint next to that of its edited text and of the next document.

    The edited text ends with the beginning of the next document (by ascending id, the first
    after the last) in place of its own last quarter. Returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, a row for each
    row of ``docs``. Rows without an id come before all others; rows that repeat an id or
    have none stand by the digests of their texts, and of equal rows each is followed by
    the next one. A null text is an empty one; further columns are passed over.
    """
    base = docs.select(
        F.col(doc_id).isNotNull().alias("named"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0).cast("long")).alias("key"),
        F.lit("").alias("digest"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )

    def places(base: DataFrame) -> DataFrame:
        narrow = base.select(*_PLACED, "copies", F.length("text").cast("long").alias("n"))
        return materialise(numbered(narrow, _PLACED, "lengths"), "places")

    narrow = places(base)
    repeats = not narrow.groupBy("named", "key").count().where("count > 1").isEmpty()
    if repeats:
        # Equal rows stand as one with their number; all others are told apart by the digest.
        base = base.withColumn("digest", F.sha2("text", 256))
        base = base.groupBy(*_PLACED).agg(F.first("text").alias("text"), F.sum("copies").alias("copies"))
        narrow = places(base)
    texts = base
    if not repeats:
        finer = _FINER * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        base = base.repartition(finer, "named", "key")
    total = narrow.count()
    if not total:
        total = 1
    before = narrow.select(
        F.struct(*_PLACED).alias("before"),
        F.floor(F.col("n") / 4).cast("int").alias("cut"),
        ((F.col("position") + 1) % total).alias("position"),
    )
    after = narrow.select(*_PLACED, "position").join(before, "position").drop("position")
    # Only the part of the next text that is needed goes to its neighbour; both joins
    # read one shuffle of the texts.
    head = F.substring(F.col("text"), F.lit(1), F.col("cut")).alias("head")
    following = F.struct(*_PLACED).alias("following")

    def parts(base: DataFrame, after: DataFrame, texts: DataFrame) -> list[DataFrame]:
        heads = texts.join(after, _PLACED).select("before.*", following, "cut", head)
        rows = [base.join(heads, _PLACED).withColumn("times", F.lit(1).cast("long"))]
        if repeats:
            again = base.where("copies > 1").withColumn("cut", F.floor(F.length("text") / 4).cast("int"))
            rows.append(again.select("*", following, head, (F.col("copies") - 1).alias("times")))
        return rows

    # Numbered part by part: within one, a place has one row and is dealt by its name.
    found = [with_both_sketches(_with_kmers(rows)) for rows in parts(base, after, base)]
    found = materialise(reduce(DataFrame.unionByName, found), "fingerprints")
    signed = found.where("NOT lacks")
    # Written, so that Spark sees how few they are and shuffles no other texts.
    lacking = materialise(found.where("lacks").select(*_PLACED, "times"), "lacking")
    if not lacking.isEmpty():
        following_them = lacking.select(F.struct(*_PLACED).alias("before"))
        few = materialise(after.join(following_them, "before", "left_semi"), "lacking")
        wanted = texts.join(lacking.select(*_PLACED), _PLACED, "left_semi")
        rows = reduce(DataFrame.unionByName, parts(wanted, few, texts))
        rows = _with_kmers(rows.join(lacking, [*_PLACED, "times"], "left_semi"))
        rows = rows.withColumn("lacks", F.lit(False))
        rows = rows.withColumn("other", F.concat(F.slice("own", F.lit(1), F.col("kept")), F.col("tail")))
        rows = with_sketch(with_sketch(rows.drop("tail"), "own", "own"), "other", "other")
        signed = signed.unionByName(materialise(rows, "lacking"))
    signed = signed.drop("kept", "lacks")
    # A place's own fingerprint is in both of its rows if it has two.
    signatures = signed.select(F.struct(*_PLACED).alias("following"), F.col("own").alias("next"))
    if repeats:
        signatures = signatures.dropDuplicates(["following"])
    compared = signed.join(signatures, "following").select(
        F.when(F.col("named"), F.col("key")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        printed(F.col("own")).alias("fingerprint"),
        printed(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
        "times",
    )
    if repeats:
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
        compared = compared.withColumn("copy", copies).drop("copy")
    return compared.drop("times")
