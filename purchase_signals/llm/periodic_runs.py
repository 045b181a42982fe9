"""Periodic runs of words, found by string synchronising sets.

A run is a longest stretch of words with smallest period ``q`` that repeats it at least
``exponent`` times. At scale ``t`` (1, 2, 4, ...) a position is synchronising if the hash of
the ``t`` words that begin there, or of those that begin ``t`` words later, is the least
among all that begin between the two; positions whose ``t`` words are highly periodic do
not take part. Whether a position is chosen follows from the ``2 * t`` words after it, its
context, alone. So a run of period ``p`` in ``[t, 2 * t)`` and at least ``4 * p`` words has a chosen
position among its first ``t``, and the position ``p`` words on is the next one with an equal
context: pairs of neighbours with equal contexts propose all periods. They are few, as the
chosen positions thin out with the scale. Highly periodic stretches are the runs of short
period that the smaller scales have found; they supply the periods left out there.

Contexts are compared by exact names: the name of ``2 * t`` words is the pair of names of
its halves, numbered anew at each scale, only where it occurs more than once in its
document. Elsewhere nothing can repeat, so in plain text few positions are left after
two or three scales. The stretches that proposals show to repeat are merged, and their
ends followed word by word. All documents of a batch are worked through together:
first names differ between documents, so that nothing repeats across two of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import pieces

RUNS = "array<struct<start: long, length: long, period: long>>"
RESULT = f"doc_id long, n_words long, runs {RUNS}, collapsed string"
# Comparisons made at once when the ends of stretches are followed.
_AT_ONCE = 1 << 20


def split_words(doc_id: int | None, text: str) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return text.encode().split()


def _hashed(names: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit numbers, below the greatest one."""
    h = names.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) >> np.uint64(1)


_PERIODIC = np.uint64(2**64 - 1)


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``values[i : i + width]`` for each ``i`` where these are all there."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, _PERIODIC)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    from_left = np.minimum.accumulate(blocks, axis=1).ravel()
    to_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_right[: n - width + 1], from_left[width - 1 : n])


def _within(at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the sorted positions ``at`` lie in one of the intervals ``[start, end)``."""
    change = np.zeros(len(at) + 1, dtype=np.int64)
    np.add.at(change, np.searchsorted(at, starts), 1)
    np.add.at(change, np.searchsorted(at, ends), -1)
    return np.cumsum(change[:-1]) > 0


def _agreeing(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int, width: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step``, equal those ``period`` behind them."""
    agree, n = np.zeros(len(at), dtype=np.int64), len(words)
    rows = max(1, _AT_ONCE // width)
    for first in range(0, len(at), rows):
        active = np.arange(first, min(first + rows, len(at)))
        while len(active):
            near = (at[active] + step * agree[active])[:, None] + step * np.arange(width)
            far = near + period[active, None]
            inside = (near >= 0) & (far < n)
            equal = inside & (words[np.maximum(near, 0).clip(max=n - 1)] == words[far.clip(0, n - 1)])
            whole = equal.all(axis=1)
            agree[active] += np.where(whole, width, equal.argmin(axis=1))
            active = active[whole]
    return agree


def _proposed_runs(words: np.ndarray, at: np.ndarray, period: np.ndarray, scale: int) -> np.ndarray:
    """``(start, length, period)`` of the longest stretches around the proposals ``(at, period)``.

    The ``2 * scale`` words from ``at`` on equal those ``period`` behind them.
    """
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    # Proposals of one period that overlap or touch are one stretch.
    apart = np.flatnonzero((period[1:] != period[:-1]) | (at[1:] > at[:-1] + 2 * scale)) + 1
    firsts, lasts = np.append(0, apart), np.append(apart, len(at)) - 1
    start, end, period = at[firsts], at[lasts] + 2 * scale, period[firsts]
    width = min(max(8, scale), 4096)
    start = start - _agreeing(words, start - 1, period, -1, width)
    end = end + _agreeing(words, end, period, 1, width)
    return np.unique(np.stack([start, end + period - start, period], axis=1), axis=0)


def find_runs(words: np.ndarray, longest: int, exponent: int = 4, shortest: int = 6) -> np.ndarray:
    """``(start, length, period)`` of all runs in ``words``, by start, then period.

    A run repeats its smallest period at least ``exponent`` (4 or more) times and has at least
    ``shortest`` words. ``words`` are numbers below ``len(words)``, other ones in each document; no document
    has more than ``longest``.
    """
    n, found = len(words), np.empty((0, 3), dtype=np.int64)
    if n:
        at = np.flatnonzero(np.bincount(words, minlength=n)[words] > 1)
        name, scale = words[at], 1
    while n and len(at) > scale and exponent * scale <= longest:
        # Contexts whose words all belong to something that repeats.
        whole = np.flatnonzero(at[scale:] - at[:-scale] == scale)
        pair = name[whole] * n + name[whole + scale]
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        new = np.append(True, ordered[1:] != ordered[:-1]) if len(ordered) else np.empty(0, bool)
        group = np.cumsum(new) - 1
        repeats = np.bincount(group, minlength=1)[group] > 1 if len(group) else new
        order, group = order[repeats], group[repeats]
        if not len(order):
            break
        value = _hashed(name)
        short = found[(found[:, 2] * 4 <= scale) & (found[:, 1] >= scale)]
        if len(short):
            periodic = _within(at, short[:, 0], short[:, 0] + short[:, 1] - scale + 1)
            value[periodic] = _PERIODIC
        place = whole[order]
        least = _window_minimum(value, scale + 1)[place]
        chosen = (least == value[place]) | (least == value[place + scale])
        chosen &= least != _PERIODIC
        position, context = at[place[chosen]], group[chosen]
        apart = position[1:] - position[:-1]
        near = (context[1:] == context[:-1]) & (apart >= scale) & (apart < 2 * scale)
        if near.any():
            runs = _proposed_runs(words, position[:-1][near], apart[near], scale)
            enough = np.maximum(shortest, exponent * runs[:, 2])
            found = np.concatenate([found, runs[runs[:, 1] >= enough]])
        back = np.argsort(place)
        at, name, scale = at[place[back]], group[back], 2 * scale
    # A stretch counts once, with its smallest period.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), dtype=bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of_documents(documents: list[list[bytes]], exponent: int, shortest: int):
    """For each document its runs, and its words without those that only repeat a run's first ones."""
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    names = np.empty(int(lengths.sum()), dtype=np.int64)
    for words, begin, length in zip(documents, starts.tolist(), lengths.tolist(), strict=True):
        # A word's name is the place where its document has it first.
        first: dict[bytes, int] = {}
        given = map(first.setdefault, words, range(begin, begin + length))
        names[begin : begin + length] = np.fromiter(given, dtype=np.int64, count=length)
    found = find_runs(names, int(lengths.max(initial=0)), exponent, shortest)
    change = np.zeros(len(names) + 1, dtype=np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    bounds = np.searchsorted(found[:, 0], np.append(starts, len(names)))
    for i, words in enumerate(documents):
        runs = found[bounds[i] : bounds[i + 1]]
        if len(runs):
            own = keep[starts[i] : starts[i] + lengths[i]]
            words = [word for word, stays in zip(words, own.tolist(), strict=True) if stays]
        yield runs - [starts[i], 0, 0], b" ".join(words)


def periodic_runs(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    exponent: int = 4,
    shortest: int = 6,
    words_of: Callable[[int | None, str], list[bytes]] = split_words,
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of each row of ``docs``.

    ``runs`` lists ``(start, length, period)`` in words by start, then period, of the runs that
    repeat their smallest period at least ``exponent`` times (4 or more) and have at least ``shortest``
    words; ``collapsed`` holds the words, joined by spaces, without those that lie in a run
    after its first period. ``words_of`` splits a text. Null and empty texts have no
    words and no runs. Rows that repeat or lack an id are rows like any other; further
    columns are passed over. There is no shuffle; a task holds about 4 MB of texts, or one
    longer text, at a time.
    """
    if exponent < 4:
        raise ValueError(f"exponent: {exponent}")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def find(batches):
        for whole in batches:
            for batch in pieces(whole):
                ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
                words = [words_of(i, t or "") for i, t in zip(ids, texts, strict=True)]
                runs, collapsed = zip(*runs_of_documents(words, exponent, shortest), strict=True)
                flat = np.concatenate(runs)
                fields = [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)]
                items = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), items),
                        pa.array([c.decode() for c in collapsed], pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.mapInArrow(find, RESULT)
