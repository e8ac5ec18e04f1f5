"""Benchmark decontamination: a BM25 index of test items, queried with every passage.

The index holds the test items, cut into parts of at most ``PART`` words: postings with impacts
that are divided by the part's own threshold (``SHARE`` of the score that the part gives itself), so
a score of 1 is the threshold of every part. Parts are grouped into blocks, and each term keeps its
largest impact per block. A passage's terms are sorted by their largest impact; those that cannot
reach 1 together open no block (the pivot of WAND) and the others open theirs. A block stays
if the block maxima of all terms reach 1, and only its postings are scored. All passages of a
block of text go through these steps together as arrays. Parts found are verified on the words: most
shingles of the question and most words of the answer have to occur around the passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebeacon.llm import text as tx

K1, B = 1.2, 0.75
SHARE = 0.5
PART = 256
BLOCK_PARTS = 4
SHARD_BYTES = 32_000_000  # test text per broadcast index; more items make more indexes
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.75, 0.5


def _expand(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [begin, begin + count): the range number and every index inside."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted different values; sorting beats hashing for the sizes here."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def _among(x: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(x), bool)
    return ascending[np.minimum(np.searchsorted(ascending, x), len(ascending) - 1)] == x


@dataclass
class Item:
    item_id: int
    question: np.ndarray  # distinct shingles that end in the question
    answer: np.ndarray  # distinct words of the answer
    size: int  # words of a shingle
    several: bool  # cut into parts


class Statistics:
    """What BM25 has to know of all parts together: their number, mean and largest length, parts per word.

    Holds 16 bytes per different word of the test items.
    """

    def __init__(self) -> None:
        self.words, self.df = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.n = self.length = self.longest = 0

    def add(self, parts: list[np.ndarray]) -> None:
        if not parts:
            return
        self.n += len(parts)
        self.length += sum(map(len, parts))
        self.longest = max(self.longest, *map(len, parts))
        found, counts = np.unique(np.concatenate([np.unique(p) for p in parts]), return_counts=True)
        words, place = np.unique(np.concatenate([self.words, found]), return_inverse=True)
        self.df = np.bincount(place, np.concatenate([self.df, counts]), len(words)).astype(np.int64)
        self.words = words


def _parts(words: np.ndarray) -> list[np.ndarray]:
    return [words[at : at + PART] for at in range(0, len(words), PART)]


class Index:
    """The index of some items, weighted by the ``statistics`` of all items, their own if none are given."""

    def __init__(self, rows: list[tuple[int, str]], statistics: Statistics | None = None) -> None:
        words = [_words(text) for _, text in rows]
        self.items, self.part_item, parts = [], [], []
        for (item_id, text), own in zip(rows, words, strict=True):
            if not len(own):
                continue
            tail = len(_words(_answer(text)))
            split = len(own) - tail
            size = min(tx.SHINGLE, len(own))
            shingles = tx.shingle_hashes(own, size)
            asked = shingles[: max(0, split - size + 1)] if split >= size else shingles
            parts += _parts(own)
            self.part_item += [len(self.items)] * (len(parts) - len(self.part_item))
            self.items.append(Item(item_id, np.unique(asked), np.unique(own[split:]), size, len(own) > PART))
        if statistics is None:
            statistics = Statistics()
            statistics.add(parts)
        self.stride = max(32, statistics.longest)
        self.part_item = np.array(self.part_item, np.int64)
        self._post(parts, statistics)

    def _post(self, parts: list[np.ndarray], statistics: Statistics) -> None:
        lengths = np.array([len(p) for p in parts], float)
        flat = np.concatenate([np.zeros(0, np.uint64), *parts])
        self.vocabulary, term = np.unique(flat, return_inverse=True)
        self.slot_mask = np.uint64((1 << max(16, int(16 * len(self.vocabulary)).bit_length())) - 1)
        self.slots = np.zeros(int(self.slot_mask) + 1, bool)
        self.slots[self.vocabulary & self.slot_mask] = True
        part = np.repeat(np.arange(len(parts)), lengths.astype(int))
        keys, tf = np.unique(term * max(1, len(parts)) + part, return_counts=True)
        term, part = keys // max(1, len(parts)), keys % max(1, len(parts))
        df = statistics.df[np.searchsorted(statistics.words, self.vocabulary)]
        idf = np.log(1 + (statistics.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / max(1.0, statistics.length / max(1, statistics.n)))
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[part])
        self.threshold = SHARE * np.bincount(part, impact, len(parts))
        self.part, self.impact = part, impact / np.maximum(self.threshold[part], 1e-12)
        self.begin = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        block = part // BLOCK_PARTS
        self.n_blocks = max(1, -(-len(parts) // BLOCK_PARTS))
        keys, first = np.unique(term * self.n_blocks + block, return_index=True)
        self.block_max = np.maximum.reduceat(self.impact, first) if len(first) else np.zeros(0)
        self.block = keys % self.n_blocks
        self.block_begin = np.searchsorted(keys // self.n_blocks, np.arange(len(self.vocabulary) + 1))
        self.term_max = np.maximum.reduceat(self.impact, self.begin[:-1]) if len(self.vocabulary) else np.zeros(0)

    def _terms(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that the index knows, and their terms; a table of slots rules most others out."""
        maybe = np.flatnonzero(self.slots[words & self.slot_mask])
        at = np.minimum(np.searchsorted(self.vocabulary, words[maybe]), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == words[maybe]
        return maybe[hit], at[hit]

    def search(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, part, score / threshold) of all pairs at or above the threshold.

        ``passage`` and ``term`` are the distinct pairs, sorted by passage.
        """
        slack = 1 - 1e-9
        bound = np.bincount(passage, self.term_max[term])
        keep = bound[passage] >= slack
        passage, term = passage[keep], term[keep]
        opened = self._open_blocks(passage, term, slack)
        wanted = np.zeros(int(passage[-1]) + 2 if len(passage) else 1, bool)
        wanted[opened // self.n_blocks] = True
        keep = wanted[passage]
        passage, term = passage[keep], term[keep]
        owner, at = _expand(self.begin[term], np.diff(self.begin)[term])
        inside = _among(passage[owner] * self.n_blocks + self.part[at] // BLOCK_PARTS, opened)
        owner, at = owner[inside], at[inside]
        parts = max(1, len(self.part_item))
        pairs = passage[owner] * parts + self.part[at]
        found, score = self._enough(pairs, self.impact[at], _distinct(pairs), slack)
        return found // parts, found % parts, score

    def _open_blocks(self, passage: np.ndarray, term: np.ndarray, slack: float) -> np.ndarray:
        """Keys (passage, block), ascending, whose block maxima reach the threshold over all terms of the passage."""
        if not len(passage):
            return np.zeros(0, np.int64)
        counts = np.diff(self.block_begin)
        owner, at = _expand(self.block_begin[term], counts[term])
        keys, bounds = passage[owner] * self.n_blocks + self.block[at], self.block_max[at]
        # Only a term that can lift the ones below it over the threshold opens blocks (the pivot).
        order = np.lexsort((self.term_max[term], passage))
        passage, term = passage[order], term[order]
        running = np.cumsum(self.term_max[term])
        first = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        before = np.repeat(running[first] - self.term_max[term][first], np.diff(np.append(first, len(passage))))
        essential = running - before >= slack
        owner, at = _expand(self.block_begin[term[essential]], counts[term[essential]])
        opened = _distinct(passage[essential][owner] * self.n_blocks + self.block[at])
        return self._enough(keys, bounds, opened, slack)[0]

    @staticmethod
    def _enough(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Of the sorted ``wanted`` keys, those whose values sum to at least ``least``, with the sums."""
        if not len(wanted):
            return wanted, np.zeros(0)
        place = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        hit = wanted[place] == keys
        total = np.bincount(place[hit], values[hit], len(wanted))
        return wanted[total >= least], total[total >= least]

    def leaks(self, data: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
        """Per text the test items that it contains."""
        out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        words, _, _, doc = tx.word_hashes(data, offsets)
        if not len(words) or not len(self.vocabulary):
            return out
        first_word = np.searchsorted(doc, np.arange(len(offsets)))
        # A passage is two neighbouring stretches of ``stride`` words of one text.
        stretches = np.maximum(1, -(-np.diff(first_word) // self.stride))
        base = np.cumsum(stretches) - stretches
        stretch = base[doc] + (np.arange(len(words)) - first_word[doc]) // self.stride
        known, place = self._terms(words)
        stretch, begins = stretch[known], base[doc[known]]
        # Counting repeated words as often as they occur gives a cheap bound that rules most passages out.
        total = np.bincount(stretch, self.term_max[place], int(base[-1] + stretches[-1]) + 1)
        total[:-1] += total[1:]
        ahead = total >= 1 - 1e-9
        here, before = ahead[stretch], (stretch > begins) & ahead[stretch - 1]
        size = len(self.vocabulary)
        keys = _distinct(np.concatenate([stretch[here] * size + place[here], (stretch[before] - 1) * size + place[before]]))
        passage, part, score = self.search(keys // size, keys % size)
        best: dict[tuple[int, int], dict] = {}
        for p, q, s in zip(passage.tolist(), part.tolist(), score.tolist(), strict=True):
            d, i = int(np.searchsorted(base, p, "right") - 1), int(self.part_item[q])
            low = first_word[d] + (p - base[d] - 1) * self.stride
            item = self.items[i]
            around = words[max(first_word[d], low) : min(first_word[d + 1], low + 4 * self.stride)]
            if item.several:  # its other parts may stand further away
                around = words[first_word[d] : first_word[d + 1]]
            row = {
                "item_id": item.item_id,
                "score": s * float(self.threshold[q]),
                "question_overlap": _share(item.question, tx.shingle_hashes(around, item.size)),
                "answer_overlap": _share(item.answer, around),
            }
            if row["question_overlap"] < QUESTION_OVERLAP or row["answer_overlap"] < ANSWER_OVERLAP:
                continue
            old = best.get((d, i))
            if old is None or (row["question_overlap"], row["answer_overlap"], row["score"]) > (old["question_overlap"], old["answer_overlap"], old["score"]):
                best[d, i] = row
        for (d, _), row in sorted(best.items()):
            out[d].append(row)
        return out


def _share(wanted: np.ndarray, there: np.ndarray) -> float:
    return float(np.isin(wanted, there).mean()) if len(wanted) else 1.0


def _words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return tx.word_hashes(data, np.array([0, len(data)], np.int64))[0]


def _answer(text: str) -> str:
    """The last sentence or line of an item of several; an item of one sentence has no answer part."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n", text.strip()) if p.strip()]
    return parts[-1] if len(parts) > 1 else ""


LEAKS = "array<struct<item_id: long, score: double, question_overlap: double, answer_overlap: double>>"
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))


def _groups(ordered: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in order, at most ``SHARD_BYTES`` of text at a time (or one longer item)."""
    rows, held = [], 0
    for row in ordered.toLocalIterator():
        if rows and held + len(row.text) > SHARD_BYTES:
            yield rows
            rows, held = [], 0
        rows.append((row.item_id, row.text))
        held += len(row.text)
    if rows:
        yield rows


def _shards(items: DataFrame) -> Iterator[Index]:
    """One index per group of items. All use the statistics of all groups, so scores don't depend on ``SHARD_BYTES``."""
    ordered = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").distinct().orderBy("item_id", "text")
    statistics, n, rows = Statistics(), 0, []
    for n, rows in enumerate(_groups(ordered), 1):  # noqa: B007
        statistics.add([p for _, text in rows for p in _parts(_words(text))])
    for group in [rows] if n == 1 else _groups(ordered) if n else []:
        yield Index(group, statistics)


def mark_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with ``leaks``: the test items found in each whole text, empty where there are none.

    Null and empty texts, and items without words, match nothing. Repeated rows and null ids are
    searched like others, texts of any length passage by passage; a column named ``leaks`` is replaced; empty tables are fine on either side.
    The pass is a map: neither a hot source nor copies are moved. The test set is read in shards of
    a fixed size, each broadcast as one index, and every shard is one further pass over the texts.
    """
    rest = [c for c in docs.columns if c.lower() != "leaks"]
    docs = docs.select(*[F.col(f"`{c}`") for c in rest]).withColumn("leaks", F.array().cast(LEAKS))
    for index in _shards(items):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: list[list[dict]] = []
                for _, data, offsets in tx.blocks(batch):
                    found += sent.value.leaks(data, offsets)
                at = batch.schema.get_field_index("leaks")
                before = batch.column(at).to_pylist()
                yield batch.set_column(at, "leaks", pa.array([a + b for a, b in zip(before, found, strict=True)], _ARROW))

        docs = docs.mapInArrow(work, docs.schema)
    return docs


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any test item, with their columns."""
    return mark_leaks(docs, items).filter(F.size("leaks") == 0).drop("leaks")
