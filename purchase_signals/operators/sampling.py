"""Stable top rows, exact-size sampling and splitting."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import materialise

_ORDER = "_order"


def _column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


# Rows that one task may merge. Where a cluster's tasks could send more, the n-th value
# is looked for by counting.
MERGED_ROWS = 1 << 20
# Values that divide the rows in each round of counting, drawn from a sample, and how
# few rows are sorted at last.
PIVOTS, SAMPLED, SORTED = 63, 4000, 20_000


def _rank(by: Column, key: Column) -> Column:
    """One value that sorts by (``by``, ``key``), nulls last."""
    return F.struct(
        by.isNull().alias("a"), by.alias("b"), key.isNull().alias("c"), key.alias("d")
    )


def nth_smallest(values: DataFrame, n: int) -> tuple[Column, int] | None:
    """The ``n``-th smallest ``_v`` of ``values`` and how many are below it; None if there are fewer.

    ``values`` is a written table. Each round draws pivots from a sample of the rows that the
    value may be among and counts the rows between them, by task and then in all: a
    few numbers, whatever the number of rows and tasks. The value is exact; the
    sample decides only how many rounds it takes.
    """
    left, below, seed = values, 0, 0
    total = left.count()
    if n < 1 or total < n:
        return None
    while total > SORTED:
        seed += 1
        some = left.sample(min(1.0, SAMPLED / total), seed=seed)
        ordered = F.sort_array(F.collect_list("_v"))
        step = F.greatest(F.lit(1), F.ceil(F.size("_all") / (PIVOTS + 1)).cast("int"))
        picked = F.transform(
            F.sequence(step, F.size("_all"), step), lambda i: F.element_at("_all", i.cast("int"))
        )
        pivots = some.agg(ordered.alias("_all")).where(F.size("_all") > 0)
        pivots = materialise(pivots.select(F.array_distinct(picked).alias("_p")), "pivots")
        if pivots.isEmpty():
            continue
        place = F.size(F.filter("_p", lambda p: p < F.col("_v")))
        at = F.coalesce(F.get("_p", place) == F.col("_v"), F.lit(False))
        placed = left.withColumn("_p", pivots.select("_p").scalar())
        counts = placed.groupBy(place.alias("place"), at.alias("at")).count().collect()
        # At most two rows for each pivot: those between, then those equal to it.
        for place, at, count in sorted(map(tuple, counts)):
            if below + count >= n:
                break
            below += count
        if at:
            return pivots.select(F.get("_p", F.lit(place))).scalar(), below
        low = F.get("_p", F.lit(place - 1)) if place else F.lit(None)
        ends = pivots.select(low.alias("low"), F.get("_p", F.lit(place)).alias("high"))
        over = F.lit(True) if not place else F.col("_v") > ends.select("low").scalar()
        high = ends.select("high").scalar()
        left = left.where(over & F.coalesce(F.col("_v") < high, F.lit(True)))
        total = count
    first = left.orderBy("_v").limit(n - below)
    bound = materialise(first.agg(F.max("_v").alias("_v")), "bound").select("_v").scalar()
    return bound, below + left.where(F.col("_v") < bound).count()


def smallest_rows(df: DataFrame, by: Column, key: str | Column, n: int) -> DataFrame:
    """The ``n`` rows that come first by (``by``, ``key``), whole and in that order.

    A first pass reads only the ordering columns and finds the n-th value. The
    second pass drops what lies beyond it at the scan, so that about ``n`` whole rows
    are sorted however many tasks there are. For few rows the n-th value is
    merged from those of all tasks, in one; beyond ``MERGED_ROWS``, with as many tasks as shuffle
    partitions, it is counted out (``nth_smallest``).
    """
    ordered = df.withColumn(_ORDER, by)
    order = [F.col(_ORDER).asc_nulls_last(), _column(key).asc_nulls_last()]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n * tasks > MERGED_ROWS:
        rank = _rank(F.col(_ORDER), _column(key))
        found = nth_smallest(materialise(ordered.select(rank.alias("_v")), "ranks"), n)
        if found is None:
            return ordered.orderBy(*order).drop(_ORDER)
        bound, below = found
        # Rows alike in both are as good as each other.
        ties = ordered.where(rank == bound).limit(n - below)
        return ordered.where(rank < bound).unionByName(ties).orderBy(*order).drop(_ORDER)
    first = ordered.select(_ORDER, _column(key).alias("_key")).orderBy(
        F.col(_ORDER).asc_nulls_last(), F.col("_key").asc_nulls_last()
    )
    # Null while fewer than n rows have a value: then every row stays in.
    bound = first.limit(n).agg(F.when(F.count(_ORDER) == n, F.max(_ORDER))).scalar()
    near = ordered.where(F.coalesce(F.col(_ORDER) <= bound, F.lit(True)))
    return near.orderBy(*order).limit(n).drop(_ORDER)


def sample_exact(df: DataFrame, key: str | Column, n: int = 200, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows without replacement, the same on every run and layout.

    Rows are ranked by a hash of ``seed`` and ``key``; ``key`` should be unique.
    """
    ticket = F.md5(F.concat(F.lit(f"{seed}_"), F.coalesce(_column(key).cast("string"), F.lit(""))))
    return smallest_rows(df, ticket, key, n)


# Copies of one row that one task numbers.
_COPIES = 1 << 16


def sample_equal_rows(df: DataFrame, column: str, n: int = 200, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` of the texts in ``column``, which may repeat, without replacement.

    The draw follows from the texts and how often each occurs, so it is the same on every run and
    layout, without a key. Each copy of a text has a ticket of its own: a hash of
    ``seed``, the text's digest and the copy's number. Only digests are shuffled; copies of one
    text are numbered in pieces, by many tasks if they are many.
    """
    digest = F.md5(F.col(column)).alias("_digest")
    counts = df.where(F.col(column).isNotNull()).groupBy(digest).agg(F.count(F.lit(1)).alias("_n"))
    last = F.expr(f"(_n - 1) div {_COPIES}")
    dealt = counts.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = dealt.repartition("_digest", "_piece")
    copies = F.sequence(
        F.col("_piece") * _COPIES + 1, F.least("_n", (F.col("_piece") + 1) * _COPIES)
    )
    tickets = dealt.select("_digest", F.explode(copies).alias("_copy"))
    ticket = F.md5(F.concat_ws("_", F.lit(str(seed)), "_digest", "_copy"))
    drawn = smallest_rows(tickets, ticket, F.col("_digest"), n)
    drawn = materialise(drawn.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")), "drawn")
    texts = df.select(column, digest).join(drawn, "_digest")
    texts = texts.groupBy("_digest").agg(F.first(column).alias(column), F.first("_n").alias("_n"))
    return texts.select(column, F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).drop("col")


def in_train(key: str | Column, train_pct: int) -> Column:
    """Whether the MD5 of ``key`` is in the lower ``train_pct`` percent of all values.

    Digests are compared as hexadecimal text, which sorts like the numbers.
    """
    bound = train_pct * 2**128 // 100
    bound = f"{bound:032x}" if bound < 2**128 else "g"
    return F.md5(F.coalesce(_column(key).cast("string"), F.lit(""))) < bound


def split_by_key(
    df: DataFrame, key: str | Column, train_pct: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together are ``df``; rows of one key stay together.

    A row's side depends on its key alone, not on partitions, order or run.
    """
    train = in_train(key, train_pct)
    return df.where(train), df.where(~train)


def split_random(
    df: DataFrame, weights: tuple[float, float] = (0.8, 0.2), seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split.

    Its draw follows the layout of the input. The input is written out first, so
    that both parts are drawn from the same layout and no row is lost or doubled.
    """
    train, validation = materialise(df, "split").randomSplit(list(weights), seed=seed)
    return train, validation
