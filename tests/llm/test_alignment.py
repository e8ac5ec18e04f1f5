"""Cross-tokenizer alignment against the libraries and plain loops."""

import hashlib
import os
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from helpers import SCHEMA, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casebeacon.llm import alignment
from casebeacon.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.001")


def byte_table():
    """The published byte-to-character map of byte-level vocabularies, written out step by step."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table, free = {chr(b): b for b in shown}, 256
    for b in range(256):
        if b not in shown:
            table[chr(free)] = b
            free += 1
    return table


def by_hand(rows):
    """RESULT rows of (doc_id, text), token by token on whole texts."""
    a, b, table = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_table()
    a.encode_special_tokens = True
    docs, count = [], Counter()
    for doc_id, text in rows:
        whole = (" " + text).encode() if text else b""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces, strict=True)]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        owner_a = [i for i, x in enumerate(bytes_a) for _ in x]
        owner_b = [j for j, x in enumerate(bytes_b) for _ in x]
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        groups, since_a, since_b = [], 0, 0
        for at in range(1, len(whole) + 1 if ids_a else 0):
            if at == len(whole) or (owner_a[at] != owner_a[at - 1] and owner_b[at] != owner_b[at - 1]):
                groups.append((ids_a[since_a : owner_a[at - 1] + 1], ids_b[since_b : owner_b[at - 1] + 1]))
                since_a, since_b = owner_a[at - 1] + 1, owner_b[at - 1] + 1
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        docs.append((doc_id, len(ids_a), len(ids_b), len(groups), [(ids_a[i], ids_b[j]) for i, j in links], hashlib.sha256(text.encode()).hexdigest() if ids_a else ""))
        count.update(docs[-1][4])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return Counter((d, na, nb, ng, len(ls), sum(count[p] == best[p[1]] for p in ls), sum(count[p] for p in ls), sha) for d, na, nb, ng, ls, sha in docs)


def test_odd_texts_equal_whole_encodings(spark):
    rng = random.Random(11)
    bits = ["a", "the", " ", "  ", "'s", "\n", "\t", "é", "日本", "<s>", "<|endoftext|>", "▁", "😀", "\x00", "\x1c", "\x85", "\xa0", "᠎", "​", "　", "12", "3.14", "́", "ing", "Worte", "!?", "\r\n", "﻿", "don't"]
    texts = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 40)))) for i in range(600)]
    texts += [(700, None), (701, ""), (702, " "), (703, " lead"), (704, "trail "), (705, "▁"), (706, "x" * 20_000), (707, "ab " * 20_000), (708, "a" + " " * 3000 + "b"), (None, "no id"), (703, " lead"), (703, " lead")]
    docs = frame(spark, texts).withColumn("pairs", F.lit(1)).withColumn("block", F.lit("x")).repartition(3)
    got = alignment.align(docs, A, B, block=5000)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == by_hand(texts)


def test_a_text_longer_than_a_block(spark):
    rng = random.Random(12)
    long = " ".join("".join(rng.choices("abcdeéß", k=rng.randrange(1, 9))) for _ in range(260_000))
    texts = [(1, long), (2, "short text"), (3, long[:500])]
    assert len(long) > 1_000_000
    assert Counter(map(tuple, alignment.align(frame(spark, texts), A, B, block=100_000).collect())) == by_hand(texts)


def test_nothing(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), A, B).collect() == []
    assert [r.n_a for r in alignment.align(frame(spark, [(1, None)]), A, B).collect()] == [0]


def test_doubling_reaches_the_end_of_long_chains():
    """Tokens that overlap like bricks form one component."""
    import numpy as np

    n = 5000
    ends_a, ends_b = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n)
    group_a, group_b = alignment.terminals(ends_a, ends_b)
    assert set(group_a) == set(group_b) == {len(ends_b) - 1}


@pytest.mark.parametrize("models", [(public_tokenizers.path("word_bpe_49k.json"), B)])
def test_other_tokenizers_are_refused(models):
    with pytest.raises(ValueError):
        alignment._encoders(*models)


def test_the_query_on_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, QUERIES["op11_token_alignment"](spark, SMALL).collect())) == by_hand(rows)
