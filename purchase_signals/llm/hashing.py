"""Hashes of all words of a batch of texts at once, in numpy.

A word's hash is a polynomial of its bytes modulo 2**64, taken as a difference of
prefix sums, and then mixed. Nothing here holds more than a slice of the bytes at
eight times its size; cuts fall between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

# The white space of the contracts, and the letters A-Z.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
UPPER = range(0x41, 0x5B)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2**64."""
    size = 1 << max(SLICE, size).bit_length()
    if size not in _POWERS:
        _POWERS.clear()

        def powers(base: int) -> np.ndarray:
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        _POWERS[size] = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
    return _POWERS[size]


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each text begins; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray, space: np.ndarray) -> Iterator[tuple[int, int]]:
    start, end = 0, len(data)
    while start < end:
        stop = min(start + SLICE, end)
        while stop < end:
            gaps = np.flatnonzero(space[data[start:stop]])
            text = offsets[np.searchsorted(offsets, stop, side="right") - 1]
            cut = max(start + gaps[-1] + 1 if len(gaps) else 0, int(text))
            if cut > start:
                stop = cut
                break
            stop = min(stop + SLICE, end)  # one word longer than a slice
        yield start, stop
        start = stop


def words(
    data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slice by slice, each word's hash and the number of its text.

    ``kinds`` maps a byte to its kind: 0 between words, else a word is a run of
    bytes of one kind. A word never spans two texts.
    """
    for start, stop in _cuts(data, offsets, kinds == 0):
        part = data[start:stop]
        kind = kinds[part]
        first = np.empty(len(part), dtype=bool)
        first[0] = True
        np.not_equal(kind[1:], kind[:-1], out=first[1:])
        inner = offsets[np.searchsorted(offsets, start) : np.searchsorted(offsets, stop)] - start
        first[inner] = True
        begins = np.flatnonzero(first)
        ends = np.append(begins[1:], len(part))
        kept = kind[begins] > 0
        begins, ends = begins[kept], ends[kept]
        power, inverse = _powers(len(part))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        hashes = mix((sums[ends] - sums[begins]) * inverse[begins])
        yield hashes, np.searchsorted(offsets, begins + start, side="right") - 1


def words_by_text(
    column: pa.Array | pa.ChunkedArray, kinds: np.ndarray, fold: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of a column in order, and where each text's begin."""
    data, offsets = text_buffer(column)
    if fold is not None:
        data = fold[data]
    found = list(words(data, offsets, kinds))
    hashes = np.concatenate([h for h, _ in found]) if found else np.zeros(0, np.uint64)
    texts = np.concatenate([t for _, t in found]) if found else np.zeros(0, np.int64)
    return hashes, np.searchsorted(texts, np.arange(len(offsets)))


def spaced_kinds() -> np.ndarray:
    """Words are all that white space does not part."""
    kinds = np.ones(256, dtype=np.uint8)
    kinds[list(SPACES)] = 0
    return kinds


def lower_fold() -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    fold = np.arange(256, dtype=np.uint8)
    fold[list(UPPER)] += 32
    return fold
