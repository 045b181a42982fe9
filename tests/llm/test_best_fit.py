"""Best-fit packing against a plain search, and on odd tables."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from purchase_signals.llm.best_fit import (
    Encoder,
    best_fit_decreasing,
    packed,
    sequences,
    token_pieces,
)
from purchase_signals.llm.queries import op13_best_fit

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("word_bpe_49k.json")


def plain(lengths, size):
    """Rooms left after best fit decreasing, one piece after the other."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(size - length)
    return sorted(rooms)


def filled(lengths, plan, size):
    """Rooms left by a plan; checks that sequences are filled without gaps or overlaps."""
    at = {}
    for position, length in enumerate(sorted(lengths, reverse=True)):
        k = np.searchsorted(plan.starts, position, side="right") - 1
        assert plan.lengths[k] == length
        sequence, number = divmod(position - plan.starts[k], plan.each[k])
        offset = plan.offsets[k] + number * length
        at.setdefault(plan.first[k] + sequence, []).append((offset, length))
    assert sorted(at) == list(range(plan.sequences))
    rooms = []
    for pieces in at.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        rooms.append(size - end)
    return sorted(rooms)


@pytest.mark.parametrize("size", [1, 2, 7, 16, 100, 2048])
def test_plan_equals_a_plain_search(size):
    draw = random.Random(size)
    for most in (size, max(1, size // 2), max(1, size // 9)):
        for n in (0, 1, 5, 400):
            lengths = [draw.randint(1, most) for _ in range(n)]
            counts = {x: lengths.count(x) for x in lengths}
            plan = best_fit_decreasing(counts, size)
            assert filled(lengths, plan, size) == plain(lengths, size)


def test_plan_of_very_many_pieces_is_small():
    plan = best_fit_decreasing({length: 10**12 + length for length in range(1, 2049)}, 2048)
    assert len(plan.starts) < 50_000
    tokens = sum(length * (10**12 + length) for length in range(1, 2049))
    assert plan.sequences * 2048 < 1.001 * tokens


def test_a_length_beyond_the_size_is_refused():
    with pytest.raises(ValueError):
        best_fit_decreasing({9: 1}, 8)


TEXTS = [
    "Don't stop, I'LL go; they've 12,345 re's 'tis 'S ''s it's!!!", "a<|endoftext|>B<|startoftext|>", "x!!<|endoftext|>!!y",
    "<|ENDOFTEXT|> <|endoftext|", "été ́x cafés Straße İİ ΣΣ", "K ﬁn next word\x85z\x1cy\x1fx",
    "\x00\x01 \x7f~ \t\v\f\r\n", "กำ 你好世界 \U0001f600\U0001f1e9\U0001f1ea ۱۲ Ⅷ x²", "", " ", "a" * 3000, "ab " * 3000,
]


def test_ids_equal_the_library(spark):
    tokenizer = Tokenizer.from_file(FILE)
    with open(FILE, encoding="utf-8") as file:
        encoder = Encoder(file.read())
    texts = TEXTS + [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["".join(map(chr, range(a, a + 64))) for a in range(0, 0x3100, 64)]
    draw = random.Random(3)
    letters = "aZ9 '́é.<|>\t sT一"
    texts += ["".join(draw.choices(letters, k=40)) for _ in range(2000)]
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, ids, encoding in zip(texts, encoder.encode(texts), want, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.ids, text


def test_other_tokenizers_get_whole_texts():
    file = public_tokenizers.path("byte_bpe_50k.json")
    with open(file, encoding="utf-8") as definition:
        encoder = Encoder(definition.read())
    want = Tokenizer.from_file(file).encode_batch(TEXTS, add_special_tokens=False)
    for ids, encoding in zip(encoder.encode(TEXTS), want, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.ids


def test_query_packs_all_documents(spark):
    got = op13_best_fit(spark, SF).collect()
    tokenizer = Tokenizer.from_file(FILE)
    want, lengths = {}, []
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = np.array([*tokenizer.encode(row["text"], add_special_tokens=False).ids, 0], dtype="<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            lengths.append(len(part))
            want[row["doc_id"], k // 2048] = (k, len(part), zlib.crc32(part.tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    assert len(got) == len(want)
    ends, places = {}, {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for sequence, parts in places.items():
        ends[sequence] = 0
        for offset, length in sorted(parts):
            assert offset == ends[sequence]
            ends[sequence] += length
    assert sorted(2048 - e for e in ends.values()) == plain(lengths, 2048)


def test_odd_rows(spark):
    """Null and empty texts, repeated rows and ids, null ids, a long text, clashing columns."""
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (3, "other"), (None, "x"), (None, "x"), (4, "word " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS piece", "'a' AS ids", "3 AS length", "0 AS start", "7 AS position", "1 AS _row", "2 AS _range"
    )
    pieces = token_pieces(docs, FILE)
    got = packed(pieces).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["length"]) for r in got) == sorted(
        [(1, 0, 1), (2, 0, 1), (3, 0, 2), (3, 0, 2), (3, 0, 2), (0, 0, 2), (0, 0, 2)]
        + [(4, k, 2048) for k in range(4)] + [(4, 4, 9001 - 4 * 2048)]
    )
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    whole = {r["sequence_id"]: r for r in sequences(packed(pieces)).collect()}
    assert sum(r["n_tokens"] for r in whole.values()) == 9001 + 12
    for r in got:
        held = whole[r["sequence_id"]]["ids"][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert bytes(held) == bytes(r["ids"])
    empty = packed(token_pieces(docs.where(F.lit(False)), FILE))
    assert empty.count() == 0 and sequences(empty).count() == 0


def test_one_id_on_all_rows_spreads_and_reruns_agree(spark):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"))
    got = packed(token_pieces(docs, FILE, size=16).drop("ids"), size=16)
    first = sorted((r["sequence_id"], r["offset"]) for r in got.collect())
    assert first == [(i // 4, 4 * (i % 4)) for i in range(4000)]
