"""Exact byte-level BPE with a compiled lexicon of the corpus' frequent words.

The most frequent words of the corpus and their token ids are compiled into a minimal
acyclic transducer: an automaton that shares prefixes and suffixes, whose edges carry
numbers that add up to a word's place in the sorted lexicon, and so to its ids. Its
arrays are memory-mapped by every Python worker, and all distinct words of a group of
texts walk through it together. Words it lacks are merged exactly, so the lexicon
changes the speed and never a result.

Merges, vocabulary and special tokens come from a tokenizer's JSON file, whose size
bounds what is broadcast, as ``max_words`` bounds the lexicon.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import tempfile
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialise

GROUP_CHARS = 1 << 20
HELD_WORDS = 200_000

# Fixed value: how byte-level BPE parts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# The same for texts within Latin-1, whose letters, numbers and white space are these.
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_LATIN_WORDS = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)


class Vocabulary(NamedTuple):
    """``merges`` maps two ids to rank and id; ``tokens`` holds each id's bytes."""

    bytes_to_id: list[int]
    merges: dict[tuple[int, int], tuple[int, int]]
    tokens: list[bytes]
    special: dict[str, int]


class Lexicon(NamedTuple):
    """Edges by ``state * 256 + byte``; ``skips`` add up to a word's number."""

    edges: np.ndarray
    targets: np.ndarray
    skips: np.ndarray
    final: np.ndarray
    starts: np.ndarray
    ids: np.ndarray
    longest: int


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: printable Latin-1 for itself, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    letters, ids = _byte_letters(), told["model"]["vocab"]
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in ids.items():
        tokens[i] = bytes(letters[c] for c in token)
    for token, i in special.items():
        tokens[i] = token.encode()
    merges = {}
    for rank, pair in enumerate(told["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[ids[left], ids[right]] = rank, ids[left + right]
    by_byte = {b: ids[c] for c, b in letters.items()}
    return Vocabulary([by_byte[b] for b in range(256)], merges, tokens, special)


def merged(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """A word's ids: the pair of least rank is merged, the leftmost first, until none is left."""
    ids = [vocabulary.bytes_to_id[b] for b in word]
    merges = vocabulary.merges
    if len(ids) > 64:
        return _merged_long(ids, merges)
    get, none = merges.get, _NO_MERGE
    found = list(map(get, zip(ids, ids[1:], strict=False), repeat(none)))
    while found:
        # A rank belongs to one pair; its first place is the leftmost.
        best = min(found)
        if best is none:
            break
        at = found.index(best)
        ids[at : at + 2] = [best[1]]
        del found[at]
        if at < len(found):
            found[at] = get((best[1], ids[at + 1]), none)
        if at:
            found[at - 1] = get((ids[at - 1], best[1]), none)
    return ids


# Sorts after all merges.
_NO_MERGE = (1 << 62, -1)


def _merged_long(ids: list[int], merges: dict) -> list[int]:
    """The same with a heap and links, for words of any length."""
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    heap = [
        (found[0], i, ids[i], ids[i + 1], found[1])
        for i in range(len(ids) - 1)
        if (found := merges.get((ids[i], ids[i + 1])))
    ]
    heapq.heapify(heap)
    while heap:
        _, i, left, right, new = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= len(ids) or ids[j] != right:
            continue
        ids[i], ids[j], after[i] = new, -1, after[j]
        if after[j] < len(ids):
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < len(ids) and (found := merges.get((ids[a], ids[b]))):
                heapq.heappush(heap, (found[0], a, ids[a], ids[b], found[1]))
    return [i for i in ids if i >= 0]


def split_words(text: str, special: dict[str, int], pattern: regex.Pattern) -> list[str]:
    """The words of a text in order; special tokens part it and are words of their own."""
    if _within_latin_1(text):
        pattern = _LATIN_WORDS
    if not special or not any(token in text for token in special):
        return pattern.findall(text)
    found = []
    for part in regex.split(f"({'|'.join(map(regex.escape, special))})", text):
        found += [part] if part in special else pattern.findall(part)
    return found


def _within_latin_1(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def compile_lexicon(words: dict[bytes, list[int]]) -> Lexicon:
    """The minimal acyclic transducer of ``words`` and their ids (sorted insertion, Daciuk et al.)."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def frozen(final: bool, edges: list[tuple[int, int]]) -> int:
        state = final, tuple(edges)
        if state not in register:
            register[state] = len(states)
            states.append(state)
        return register[state]

    path: list[list] = [[False, []]]
    last = b""
    for word in sorted(words):
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        for depth in range(len(last), shared, -1):
            done = frozen(*path.pop())
            path[-1][1].append((last[depth - 1], done))
        path += [[False, []] for _ in range(len(word) - shared)]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        done = frozen(*path.pop())
        path[-1][1].append((last[depth - 1], done))
    root = frozen(*path.pop())
    # Children are frozen before their parents, so the paths below a state are known.
    below = np.zeros(len(states), dtype=np.int64)
    edges, targets, skips = [], [], []
    for state, (final, outgoing) in enumerate(states):
        seen = int(final)
        for byte, target in outgoing:
            edges.append((root - state) * 256 + byte)
            targets.append(root - target)
            skips.append(seen)
            seen += int(below[target])
        below[state] = seen
    order = np.argsort(np.array(edges, dtype=np.int64))
    lengths = [len(words[w]) for w in sorted(words)]
    flat = [i for w in sorted(words) for i in words[w]]
    return Lexicon(
        np.array(edges, dtype=np.int64)[order],
        np.array(targets, dtype=np.int64)[order],
        np.array(skips, dtype=np.int64)[order],
        np.array([final for final, _ in reversed(states)], dtype=np.uint8),
        np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
        np.array(flat, dtype=np.int64),
        max(map(len, words), default=0),
    )


def lexicon_bytes(lexicon: Lexicon) -> bytes:
    sizes = np.array([len(a) for a in lexicon[:-1]] + [lexicon.longest], dtype=np.int64)
    parts = [sizes, *(a for a in lexicon[:-1] if a.dtype == np.int64), lexicon.final]
    return b"".join(a.tobytes() for a in parts)


def mapped_lexicon(data: bytes) -> Lexicon:
    """The arrays on a memory-mapped file that is gone from its folder at once."""
    with tempfile.TemporaryFile() as file:
        file.write(data)
        file.flush()
        view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    sizes = np.frombuffer(view, dtype=np.int64, count=7)
    at, found = 56, {}
    for name, size in zip(Lexicon._fields[:-1], sizes, strict=False):
        if name != "final":
            found[name] = np.frombuffer(view, dtype=np.int64, count=size, offset=at)
            at += 8 * int(size)
    final = np.frombuffer(view, dtype=np.uint8, count=sizes[3], offset=at)
    return Lexicon(final=final, longest=int(sizes[6]), **found)


def look_up(words: list[bytes], lexicon: Lexicon) -> np.ndarray:
    """Each word's number in the lexicon, -1 for those it lacks; all walk together."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    number = np.zeros(len(words), dtype=np.int64)
    state = np.zeros(len(words), dtype=np.int64)
    alive = lengths <= lexicon.longest
    if not len(lexicon.edges):
        return np.full(len(words), -1)
    data = np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8)
    begins = np.cumsum(lengths) - lengths
    for depth in range(lexicon.longest):
        at = np.flatnonzero(alive & (lengths > depth))
        if not len(at):
            break
        key = state[at] * 256 + data[begins[at] + depth]
        edge = np.minimum(np.searchsorted(lexicon.edges, key), len(lexicon.edges) - 1)
        hit = lexicon.edges[edge] == key
        alive[at[~hit]] = False
        at, edge = at[hit], edge[hit]
        number[at] += lexicon.skips[edge]
        state[at] = lexicon.targets[edge]
    return np.where(alive & (lexicon.final[state] == 1), number, -1)


def _gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[start : start + length]`` of all pieces, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class Coder:
    """Encodes and decodes groups of texts; one for each task."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.pattern = regex.compile(WORDS)
        self.unseen: dict[bytes, list[int]] = {}
        sizes = [len(t) for t in vocabulary.tokens]
        self.token_bytes = np.frombuffer(b"".join(vocabulary.tokens), dtype=np.uint8)
        self.token_sizes = np.array(sizes, dtype=np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes

    def _merged(self, word: bytes) -> list[int]:
        if word not in self.unseen:
            if len(self.unseen) >= HELD_WORDS:
                self.unseen.clear()
            self.unseen[word] = merged(word, self.vocabulary)
        return self.unseen[word]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin."""
        numbers: dict[str, int] = {}
        words: list[int] = []
        ends = [0]
        for text in texts:
            words += [
                numbers.setdefault(w, len(numbers))
                for w in split_words(text, self.vocabulary.special, self.pattern)
            ]
            ends.append(len(words))
        distinct = list(numbers)
        raw = [w.encode() for w in distinct]
        known = look_up(raw, self.lexicon)
        starts = np.zeros(len(distinct), dtype=np.int64)
        lengths = np.zeros(len(distinct), dtype=np.int64)
        has = known >= 0
        starts[has] = self.lexicon.starts[known[has]]
        lengths[has] = self.lexicon.starts[known[has] + 1] - starts[has]
        more: list[int] = []
        first = len(self.lexicon.ids)
        for i in np.flatnonzero(~has).tolist():
            special = self.vocabulary.special.get(distinct[i])
            own = self._merged(raw[i]) if special is None else [special]
            starts[i], lengths[i] = first + len(more), len(own)
            more += own
        pool = np.concatenate([self.lexicon.ids, np.array(more, dtype=np.int64)])
        order = np.array(words, dtype=np.int64)
        ids = _gathered(pool, starts[order], lengths[order])
        places = np.concatenate([[0], np.cumsum(lengths[order])])
        return ids, places[np.array(ends)]

    def decode(self, ids: np.ndarray) -> str:
        sizes = self.token_sizes[ids]
        return _gathered(self.token_bytes, self.token_starts[ids], sizes).tobytes().decode("utf-8", "replace")


def _groups(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Where a group of texts of about ``GROUP_CHARS`` begins, and the group; null is empty."""
    group: list[str] = []
    first = size = 0
    for i, text in enumerate(texts):
        group.append(text or "")
        size += len(group[-1])
        if size >= GROUP_CHARS:
            yield first, group
            group, first, size = [], i + 1, 0
    if group:
        yield first, group


def frequent_words(docs: DataFrame, special: dict[str, int], max_words: int) -> list[bytes]:
    """The most frequent words of all of ``docs (text)``, at most ``max_words``.

    Words are taken by steps of frequency (3 %, single counts where these are small), each
    with all or none of its words: so no task sorts words, and only those that stay come to the driver.
    """

    def counted(batches):
        pattern, seen = regex.compile(WORDS), Counter()

        def out():
            words = [w.encode() for w in seen]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for text in batch.column("text"):
                seen.update(split_words(text.as_py() or "", special, pattern))
                if len(seen) > 2 * HELD_WORDS:
                    yield out()
                    seen.clear()
        yield out()

    counts = docs.select("text").mapInArrow(counted, "word binary, n long")
    counts = materialise(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # Steps of frequency, at most some 1,400: how many words each holds tells which to fetch.
    step = F.floor(F.log("n") * 32)
    steps = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    lowest, words = None, 0
    for found in steps:
        words += found["count"]
        if words > max_words:
            break
        lowest = found["step"]
    best = counts.where(step >= lowest).select("word").collect() if lowest is not None else []
    return [bytes(r["word"]) for r in best if bytes(r["word"]).decode() not in special]


_MAPPED: dict[str, Coder] = {}


def encode_and_decode(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    max_words: int = 100_000,
    longest: int = 64,
) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of each row of ``docs``.

    ``ids`` holds little-endian unsigned 32-bit integers; ``decoded`` is what they decode
    to. A null or empty text has no ids. Repeated rows and null doc_ids are rows like any
    other; further columns are passed over. ``max_words`` frequent words of at most
    ``longest`` bytes enter the lexicon.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    vocabulary = read_vocabulary(tokenizer)
    words = [w for w in frequent_words(docs, vocabulary.special, max_words) if len(w) <= longest]
    lexicon = lexicon_bytes(compile_lexicon({w: merged(w, vocabulary) for w in words}))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((tuple(vocabulary), lexicon))
    name = f"{context.applicationId}-{id(shared)}-{len(lexicon)}"

    def code(batches):
        if name not in _MAPPED:
            _MAPPED.clear()
            parts, data = shared.value
            _MAPPED[name] = Coder(Vocabulary(*parts), mapped_lexicon(data))
        coder = _MAPPED[name]
        for batch in batches:
            for first, group in _groups(batch.column("text").to_pylist()):
                ids, places = coder.encode(group)
                own = [ids[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(group)),
                        pa.array(np.diff(places)),
                        pa.array([i.astype("<u4").tobytes() for i in own], pa.binary()),
                        pa.array([coder.decode(i) for i in own], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    return docs.mapInArrow(code, "doc_id long, n_tokens long, ids binary, decoded string")
