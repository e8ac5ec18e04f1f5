"""The registered queries that SQL can't express, over whole test tables, against plain versions."""

import os
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from helpers import lower, words
from test_dedup import component_ids, cut_by_hand

from casebeacon.llm import decontaminate
from casebeacon.llm.queries import QUERIES

SMALL = os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def test_near_duplicates(spark, texts):
    want, sets = component_ids(texts)
    got = QUERIES["op1_minhash_dedup"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == Counter((d, len(s), c, d == c) for (d, _), c, s in zip(texts, want, sets, strict=True))


def test_repeated_strings(spark, texts):
    want = cut_by_hand([(t or "").encode() for _, t in texts], 200)
    got = QUERIES["op2_suffix_dedup"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == Counter((d, *w) for (d, _), w in zip(texts, want, strict=True))


def test_leaks(spark, texts):
    """Every item that a text holds word for word is found, and nothing below the overlaps."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    held = {(d, i) for d, t in texts for i, x in items.items() if " ".join(words(lower(x))) in " ".join(words(lower(t or "")))}
    got = {(r.doc_id, r.item_id): r for r in QUERIES["op4_decontaminate"](spark, SMALL).collect()}
    assert held <= set(got)
    for (d, i), row in got.items():
        w = words(lower(items[i]))
        have = {tuple(x) for x in zip(*[words(lower(dict(texts)[d]))[k:] for k in range(5)], strict=False)}
        answer = len(words(decontaminate._answer(items[i])))
        asked = {tuple(w[k : k + 5]) for k in range(len(w) - answer - 4)}
        assert len(asked & have) >= 0.75 * len(asked) and row.question_overlap >= 0.75


def test_tokens(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    counts = [len(x) for x in library.encode([t or "" for _, t in texts], num_threads=1)]
    got = QUERIES["op5_token_counts"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == Counter((d, len((t or "").encode()), n, n > 4096) for (d, t), n in zip(texts, counts, strict=True))


def test_passages(spark, texts):
    """All pairs of texts: runs of 50 equal words are found, and a text without a similar partner has none."""
    got = {r.doc_id: r for r in QUERIES["op10_substring_dedup"](spark, SMALL).collect()}
    low = {d: words(lower(t or "")) for d, t in texts}
    places, shingles = {}, {}
    for d, w in low.items():
        for i in range(len(w) - 49):
            places.setdefault(tuple(w[i : i + 50]), set()).add((d, i))
        for i in range(len(w) - 4):
            shingles.setdefault(tuple(w[i : i + 5]), set()).add(d)
    for spots in places.values():
        if len({d for d, _ in spots}) > 1:
            assert len({got[d].class_id for d, _ in spots}) == 1
            assert all(any(s["from"] <= i and i + 50 <= s["to"] for s in got[d].spans) for d, i in spots)
    for d, w in low.items():
        partners = Counter(e for i in range(len(w) - 4) for e in shingles[tuple(w[i : i + 5])] - {d})
        if max(partners.values(), default=0) < 30:
            assert got[d].n_spans == 0 and got[d].class_id == d


def test_every_text_query_is_registered():
    names = [n for n in QUERIES if re.fullmatch(r"op\d+_\w+", n)]
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))
