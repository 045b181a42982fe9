"""Documents in as few token sequences as best fit decreasing needs, over the whole corpus.

Best fit decreasing takes the longest piece first and puts it into the open sequence that
has the least room left that suffices. Pieces of one length are alike to it, and so are
sequences with the same room. The packing of any number of documents therefore follows
from how many pieces there are of each length, at most ``size`` numbers: a plan is made
from those. A segment tree over the capacities finds the tightest open sequences in
logarithmic time, and all pieces of one length that they take are placed at once.

The plan says, for stretches of the pieces in order of falling length, into which
sequences they go. Its size is bounded by ``size`` alone: each length splits at most one
set of alike sequences, and a sequence holds fewer than ``sqrt(2 * size)`` different
lengths. It is sent to all tasks, where each piece finds its place from its number in
that order. Only narrow rows, without texts and ids, are put in order.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialise
from .frames import numbered, pieces as batch_pieces

PIECES = "doc_id long, piece int, start long, length int, ids binary"
# Parts whose ids a Python worker remembers: twice as many at most.
HELD_PARTS = 1 << 19
# Parts and texts that are encoded at once.
PARTS_AT_ONCE, CHARS_AT_ONCE = 4096, 1 << 21

# Parts of a text that the tokenizer never merges across. White space separates. Where all
# between is ASCII or a letter of Latin-1, parts are the tokenizer's own word classes:
# endings after an apostrophe, letters, single digits, the rest. Anything else is left
# whole for the tokenizer to compose and split.
_SPACE = "\x20\x09-\x0d"
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_OTHER = "\x80-\xbf\xd7\xf7\u0100-\U0010ffff"
_CLASSES = rf"[{_LETTERS}]+|[0-9]|'(?:[sStTmMdD]|[rRvV][eE]|[lL][lL])|[^{_SPACE}{_LETTERS}0-9]+"
_PLAIN = re.compile(_CLASSES)
_PARTS = re.compile(rf"[^{_SPACE}{_OTHER}]*[{_OTHER}][^{_SPACE}]*|{_CLASSES}")
_WHOLE = re.compile(f"[{_OTHER}]")


# What a tokenizer does before it merges, for which these parts are right.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _splits_in_parts(told: dict) -> bool:
    try:
        own = told["normalizer"]["normalizers"]
        split, by_bytes = told["pre_tokenizer"]["pretokenizers"]
        return (
            [n["type"] for n in own] == _NORMALIZERS
            and (own[1]["pattern"], own[1]["content"]) == ({"Regex": r"\s+"}, " ")
            and split["pattern"] == {"Regex": _SPLIT}
            and (split["behavior"], split["invert"]) == ("Removed", True)
            and by_bytes["type"] == "ByteLevel"
            and not (by_bytes["add_prefix_space"] or by_bytes["use_regex"])
            and told["model"]["type"] == "BPE"
        )
    except (KeyError, TypeError, ValueError):
        return False


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes which are not printable Latin-1, from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts as the tokenizers library gives them, with those of recent parts remembered.

    Where the tokenizer is of another kind than the one that the parts are made for, whole texts go to it.
    """

    def __init__(self, definition: str):
        # The task has one core; the library's own threads would take the others'.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Special tokens are found before anything else, also inside words.
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.named = frozenset(special)
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        told = json.loads(definition)
        self.model = None
        if _splits_in_parts(told):
            own = told["model"]
            settings = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
            self.model = BPE(
                vocab=own["vocab"],
                merges=[tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in own["merges"]],
                # Words come here once; remembering them is done above.
                cache_capacity=0,
                **{k: own[k] for k in settings if own.get(k) is not None},
            )
            self.letters = _byte_letters()

    def parts(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return (_PARTS if _WHOLE.search(text) else _PLAIN).findall(text)
        pieces = self.special.split(text)
        return [p for i, t in enumerate(pieces) for p in ([t] if i % 2 else _PARTS.findall(t))]

    def _new(self, parts: list[str]) -> list[bytes]:
        """Ids of parts. Those of one word class need nothing but lower case and the model's merges."""
        apart = [p for p in parts if p in self.named or _WHOLE.search(p)]
        found = self.tokenizer.encode_batch_fast(apart, add_special_tokens=False)
        ids = dict(zip(apart, map(_packed, (e.ids for e in found)), strict=True))
        merge = self.model.tokenize
        for part in parts:
            if part not in ids:
                word = part.lower()
                if not (word.isascii() and word.isprintable()):
                    word = word.encode().decode("latin-1").translate(self.letters)
                ids[part] = _packed([t.id for t in merge(word)])
        return [ids[p] for p in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.model is None:
            return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if len(self.known) > HELD_PARTS:
            # What the last parts did not use is forgotten.
            self.known, self.earlier = {}, self.known
        parts = [self.parts(text) for text in texts]
        # Held apart for these texts: a small table is quicker to look things up in.
        own, unseen = {}, []
        for part in set().union(*parts):
            ids = self.known.get(part) or self.earlier.get(part)
            if ids:
                own[part] = self.known[part] = ids
            else:
                unseen.append(part)
        for first in range(0, len(unseen), PARTS_AT_ONCE):
            some = unseen[first : first + PARTS_AT_ONCE]
            found = dict(zip(some, self._new(some), strict=True))
            own.update(found)
            self.known.update(found)
        return [b"".join(map(own.__getitem__, p)) for p in parts]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in groups of about ``CHARS_AT_ONCE``, or one longer text."""
    group: list[str] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= CHARS_AT_ONCE:
            yield group
            group, size = [], 0
    yield group


_ENCODERS: dict[str, Encoder] = {}


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 2048,
    end_id: int = 0,
) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of the pieces of each row of ``docs``.

    A document is its text's ids, as a ``tokenizers`` file gives them, and ``end_id``. Only
    documents longer than ``size`` are cut, into pieces of that length and a rest; ``ids``
    holds little-endian unsigned 32-bit integers. A null or empty text is ``end_id`` alone.
    Rows that repeat or lack an id are rows like any other; further columns are passed over.
    """
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(definition)
    name = f"{context.applicationId}-{tokenizer}"
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        if name not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[name] = Encoder(shared.value)
        encoder = _ENCODERS[name]
        for whole in batches:
            for batch in batch_pieces(whole):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                own = [ids for group in _groups(texts) for ids in encoder.encode(group)]
                doc_ids, numbers, starts, lengths, ids = [], [], [], [], []
                for doc, found in zip(batch.column("doc_id").to_pylist(), own, strict=True):
                    found += end
                    for number, at in enumerate(range(0, len(found), 4 * size)):
                        doc_ids.append(doc)
                        numbers.append(number)
                        starts.append(at // 4)
                        ids.append(found[at : at + 4 * size])
                        lengths.append(len(ids[-1]) // 4)
                columns = [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int32()),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "piece", "start", "length", "ids"]
                )

    return docs.mapInArrow(cut, PIECES)


class Rooms:
    """Sets of open sequences by the room they have left, under a segment tree."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.sets: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.open[node] += by
            node //= 2

    def add(self, room: int, first: int, number: int) -> None:
        """``number`` sequences from ``first`` on have ``room`` left."""
        if room and number:
            self.sets[room].append((first, number))
            self._change(room, 1)

    def tightest(self, need: int) -> int | None:
        """The least room of an open sequence that is at least ``need``."""
        node = need + self.leaves
        while not self.open[node]:
            # Up to where a right neighbour begins behind this node, then into it.
            while node & 1:
                node //= 2
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, room: int) -> tuple[int, int]:
        self._change(room, -1)
        return self.sets[room].pop()


class Plan(NamedTuple):
    """Stretches of the pieces by falling length; piece ``starts[k] + r`` is the ``r % each``-th
    of its stretch in sequence ``first + r // each``, from ``offsets[k]`` on."""

    starts: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    each: np.ndarray
    offsets: np.ndarray
    sequences: int


def best_fit_decreasing(counts: dict[int, int], size: int) -> Plan:
    """Where best fit decreasing puts ``counts[length]`` pieces of each length up to ``size``."""
    rooms, sequences, position, stretches = Rooms(size), 0, 0, []
    for length in sorted(counts, reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"a piece of length {length}")
        left = counts[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, first, number = size, sequences, -(-left // (size // length))
                sequences += number
            else:
                first, number = rooms.take(room)
            # A sequence that takes a piece stays the tightest until no more fits in.
            each = room // length
            taken = min(left, number * each)
            stretches.append((position, length, first, each, size - room))
            full, rest = divmod(taken, each)
            rooms.add(room - each * length, first, full)
            if rest:
                rooms.add(room - rest * length, first + full, 1)
            used = full + bool(rest)
            rooms.add(room, first + used, number - used)
            left -= taken
            position += taken
    columns = np.array(stretches, dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences)


def packed(pieces: DataFrame, *, size: int = 2048, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, packed by best fit decreasing.

    Any rows with a ``length`` of 1 to ``size`` can be packed; they should be narrow, as they
    are written twice and shuffled twice. Sequences are numbered from 0, and the pieces of one
    stand in it without gaps. Ties go by the other columns, then by the row's place in
    ``pieces``. An empty table stays empty.
    """
    own = [c for c in pieces.columns if c != length]
    # Written before anything reads it twice, so that a row keeps its place.
    rows = pieces.select("*", F.monotonically_increasing_id().alias("_row"))
    rows = materialise(rows.withColumn("_short", F.lit(size) - F.col(length)), "pieces")
    # At most one row per length.
    counts = {r[0]: r[1] for r in rows.groupBy(length).count().collect()}
    plan = rows.sparkSession.sparkContext.broadcast(best_fit_decreasing(counts, size))
    placed = numbered(rows, ["_short", *own, "_row"], "pieces-in-order")
    placed = placed.select(*pieces.columns, "position")

    def place(batches):
        starts, lengths, first, each, offsets, _ = plan.value
        for batch in batches:
            position = np.asarray(batch.column("position"))
            k = np.searchsorted(starts, position, side="right") - 1
            sequence, number = np.divmod(position - starts[k], each[k])
            columns = [*batch.columns[:-1], first[k] + sequence, offsets[k] + number * lengths[k]]
            columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
            names = [*batch.schema.names[:-1], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = placed.drop("position").schema
    schema = schema.add("sequence_id", "long").add("offset", "long")
    return placed.mapInArrow(place, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id, n_tokens, ids, doc_ids, starts, lengths``.

    ``pieces`` come from ``packed`` with their ``ids``. A sequence gathers at most its own
    tokens, so no row is larger than that.
    """
    parts = F.struct("offset", "doc_id", "start", "length", "ids")
    held = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(parts)).alias("_p"))
    ids = F.aggregate("_p", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"]))
    return held.select(
        "sequence_id",
        F.aggregate("_p", F.lit(0), lambda n, p: n + p["length"]).alias("n_tokens"),
        ids.alias("ids"),
        F.col("_p.doc_id").alias("doc_ids"),
        F.col("_p.start").alias("starts"),
        F.col("_p.length").alias("lengths"),
    )
