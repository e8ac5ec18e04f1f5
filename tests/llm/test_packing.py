"""Packing against the library's ids, gapless sequences and serial best fit."""

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import SCHEMA, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casebeacon.llm import packing
from casebeacon.llm.queries import QUERIES

MODEL = public_tokenizers.path("word_bpe_49k.json")
SMALL = os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.001")


def pieces_by_hand(rows, capacity):
    encoder, out = Tokenizer.from_file(MODEL), []
    for doc_id, text in rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return Counter(out)


def sequences(rows, capacity):
    """Number of sequences; fails unless each is gapless from 0 and fits."""
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        upto = 0
        for offset, length in sorted(places):
            assert offset == upto
            upto += length
        assert upto <= capacity
    return len(held)


def best_fit_decreasing(lengths, capacity):
    gaps, n = Counter(), 0
    for length in sorted(lengths, reverse=True):
        gap = min((g for g, c in gaps.items() if c and g >= length), default=None)
        if gap is None:
            gap, n = capacity, n + 1
        else:
            gaps[gap] -= 1
        gaps[gap - length] += 1
    return n


def test_pieces_equal_the_library(spark):
    rng = random.Random(5)
    bits = ["a", "The", " ", "  ", "'s", "\n", "\t", "é", "É", "日本", "<|endoftext|>", "<|startoftext|>", "ΟΔΟΣ", "😀", "\x00", "\x85", "\xa0", " ", "12", "́", "İ", "ing", "!?", "\x0b", "ﬁ", ".", ",", "ENDE.", "क़", "Ⅷ", "²", "\x1c", "\x1f", " ", "　", "᠎", "​", "\xad", "ſ", "<|EndOfText|>"]
    texts = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(60)))) for i in range(2500)]
    texts += [(6000, None), (601, ""), (602, " \n"), (603, "x" * 30_000), (604, "ab " * 30_000), (None, "no id"), (1, texts[1][1]), (1, texts[1][1])]
    docs = frame(spark, texts).withColumn("piece", F.lit("x")).withColumn("length", F.lit(-1)).repartition(3)
    got = packing.token_pieces(docs, MODEL, 64, block=3000)
    assert Counter(map(tuple, got.collect())) == pieces_by_hand(texts, 64)


@pytest.mark.parametrize("kind", ["uniform", "small", "one size", "halves"])
def test_sequences_are_full(spark, kind):
    rng = random.Random(kind)
    draw = {"uniform": lambda: rng.randrange(1, 201), "small": lambda: rng.randrange(1, 9), "one size": lambda: rng.choice([67, 67, rng.randrange(1, 70)]), "halves": lambda: rng.choice([99, 100, 101, 200, 1])}[kind]
    lengths = [draw() for _ in range(3000)]
    rows = packing.pack(spark.createDataFrame([(n,) for n in lengths], "length int"), 200).collect()
    assert Counter(r.length for r in rows) == Counter(lengths)
    serial = best_fit_decreasing(lengths, 200)
    assert sequences(rows, 200) <= serial + max(2, serial // 200)


def test_columns_and_lengths_without_place(spark):
    data = [(1, 5, "x", "s", "r"), (2, None, None, None, None), (3, 0, "", "", ""), (4, 11, "y", "s", "r"), (5, 10, "z", "s", "r"), (5, 10, "z", "s", "r")]
    frame_ = spark.createDataFrame(data, "key long, length long, place string, sequence_id string, row string")
    got = packing.pack(frame_, 10)
    assert got.columns == ["key", "length", "place", "row", "sequence_id", "offset"]
    rows = got.collect()
    assert Counter((r.key, r.length, r.place, r.row) for r in rows) == Counter((k, n, p, r) for k, n, p, _, r in data)
    assert {r.key for r in rows if r.sequence_id is None} == {r.key for r in rows if r.offset is None} == {2, 3, 4}
    assert sequences([r for r in rows if r.sequence_id is not None], 10) == 3


def test_nothing(spark):
    pieces = packing.token_pieces(spark.createDataFrame([], SCHEMA), MODEL)
    assert packing.pack(pieces).collect() == []


def test_a_sweep_takes_the_smallest_gap_that_holds():
    assert packing.sweep({5: 3, 2: 1}, {4: 1, 6: 1, 9: 5}, 5) == [(5, 6, 1, 0, 1), (5, 9, 1, 0, 2), (2, 4, 1, 0, 1)]
    assert packing.sweep({3: 5}, {9: 1, 7: 1}, 3) == [(3, 7, 2, 0, 2), (3, 9, 3, 0, 3)]
    assert packing.sweep({7: 1}, {6: 9}, 7) == []


def test_the_query_on_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_best_fit_packing"](spark, SMALL).collect()
    want = pieces_by_hand(rows, 2048)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    serial = best_fit_decreasing([k[3] for k in want.elements()], 2048)
    assert sequences(got, 2048) <= serial + max(1, serial // 500)
