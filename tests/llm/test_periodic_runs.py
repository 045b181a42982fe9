"""Periodic runs against a plain search over all periods, and on odd tables."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from purchase_signals.llm.periodic_runs import find_runs, periodic_runs, runs_of_documents
from purchase_signals.llm.queries import op12_periodic_runs

SF = "/root/testdata/sf0.01"


def plain(words, exponent=4, shortest=6):
    """Runs by comparing all words at all distances, and the words that stay."""
    n, found = len(words), {}
    for period in range(1, n // exponent + 1):
        i = 0
        while i + period < n:
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            length = i + period - start
            if i > start and length >= max(shortest, exponent * period):
                found.setdefault((start, length), period)
            i += i == start
    runs = sorted((start, period, length) for (start, length), period in found.items())
    gone = {i for start, period, length in runs for i in range(start + period, start + length)}
    return [(s, n, p) for s, p, n in runs], b" ".join(w for i, w in enumerate(words) if i not in gone)


def same(documents, exponent=4, shortest=6):
    for words, (runs, collapsed) in zip(
        documents, runs_of_documents(documents, exponent, shortest), strict=True
    ):
        want = plain(words, exponent, shortest)
        assert ([tuple(r) for r in runs.tolist()], collapsed) == want, words


def drawn(draw):
    letters, n = draw.choice([1, 2, 3, 5, 50]), draw.choice([0, 1, 3, 8, 20, 60, 150, 400])
    words = [b"%d" % draw.randrange(letters) for _ in range(n)]
    for _ in range(draw.randrange(4) if n > 8 else 0):
        start = draw.randrange(n)
        period = draw.randint(1, max(1, (n - start) // draw.choice([3, 4, 5, 8])))
        for i in range(start, draw.randint(start, n)):
            words[i] = words[start + (i - start) % period]
    return words


def nested(draw):
    """A block with highly periodic stretches, repeated."""

    def block(depth):
        if not depth:
            return [b"%d" % draw.randrange(3) for _ in range(draw.randint(1, 6))]
        words = []
        for _ in range(draw.randint(1, 3)):
            words += block(depth - 1) * draw.choice([1, 1, 4, 5, 9, 12])
        return [*words, b"%d" % draw.randrange(9)]

    return (block(2) * draw.randint(4, 7) + block(1))[:1500]


def fibonacci(n):
    a, b = [b"x"], [b"x", b"y"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_a_plain_search(seed):
    draw = random.Random(seed)
    same([drawn(draw) for _ in range(draw.choice([1, 3, 30]))])
    same([nested(draw)])
    same([drawn(draw) for _ in range(5)], exponent=5, shortest=1)


def test_words_without_an_end_of_patterns():
    cube_free = [b"%d" % (bin(i).count("1") % 2) for i in range(2000)]
    same([fibonacci(700), cube_free[:700], [b"w"] * 5, [b"w"] * 6, [b"w"] * 700, [b"a", b"b"] * 300])
    # Copies of one document do not repeat one another.
    same([fibonacci(50)] * 40 + [[b"a", b"b", b"c"]] * 40)


def test_a_very_long_document():
    draw = random.Random(5)
    words = [b"%d" % draw.randrange(4000) for _ in range(300_000)]
    planted = [(10_000, 7), (40_000, 3_000), (90_000, 20_001), (200_000, 1)]
    for start, period in planted:
        for i in range(start + period, start + 4 * period + 5):
            words[i] = words[i - period]
    runs, _ = next(runs_of_documents([words], 4, 6))
    assert {p for _, _, p in runs.tolist()} >= {p for _, p in planted}
    for start, length, period in runs.tolist():
        stretch = words[start : start + length]
        assert stretch[period:] == stretch[:-period] and length >= max(6, 4 * period)


def test_proposals_are_few():
    """Positions chosen at a scale thin out, also where everything repeats."""
    import numpy as np

    from purchase_signals.llm import periodic_runs as module

    asked = []
    plain_runs = module._proposed_runs

    def counted(words, at, period, scale):
        asked.append((scale, len(at)))
        return plain_runs(words, at, period, scale)

    draw = random.Random(1)
    block = [draw.randrange(500) for _ in range(1000)]
    first: dict[int, int] = {}
    words = np.array([first.setdefault(w, i) for i, w in enumerate(block * 30)])
    module._proposed_runs = counted
    try:
        assert find_runs(words, len(words)).tolist() == [[0, 30_000, 1000]]
    finally:
        module._proposed_runs = plain_runs
    assert dict(asked)[512] < 30_000 / 512 * 8


def test_query_equals_a_plain_search(spark):
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    planted = 0
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"])
        h = zlib.crc32(str(row["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        r = got[row["doc_id"]]
        if n > 3000:
            continue
        runs, collapsed = plain([w.encode() for w in words])
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed).hexdigest()
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
    assert planted > 50 and sum(r["n_runs"] > 0 for r in got.values()) > 50


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b " * 10), (4, "a b " * 10), (4, "other"), (None, "z " * 6), (5, "q " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS runs", "2 AS n_words", "'x' AS collapsed", "0 AS start"
    )
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(docs).collect())
    assert got == [
        (0, 6, [(0, 6, 1)], "z"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 1, [], "other"),
        (4, 20, [(0, 20, 2)], "a b"), (4, 20, [(0, 20, 2)], "a b"), (5, 50_000, [(0, 50_000, 1)], "q"),
    ]
    assert periodic_runs(docs.where(F.lit(False))).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs, exponent=3)
