"""Alignment of two tokenizations of the same text, by pointer jumping.

Every token points to its farthest-right overlapping token of the other side. The last byte of a token lies
in that token, so pointers lead to the right until a token of each side ends at the same byte. Doubling
the successors of all tokens of a batch brings each to the terminal token of its component: its group.

Neither tokenizer lets a token cross a single blank between two visible characters, so texts are cut
there and every different string of a task is encoded and aligned once. The corpus-wide counts of id pairs
come back to the documents block by block: a block sends each of its different pairs once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebeacon.llm.tables import stored
from casebeacon.llm.text import column_bytes

SPACE = "▁"
BLOCK = 8_000_000  # bytes of text (or one longer text) that share a list of pairs
KNOWN = 500_000  # remembered strings; only saves time
FRESH = 50_000  # strings aligned at once
JOINED = 1000  # strings encoded in one call
CUT = re.compile(r"(?<=\S) (?=\S)")
# Fixed value: how byte-level vocabularies of this kind cut a text before merging.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LATIN = "ɐ"  # below it all libraries agree on what a letter is
SHIFT = 20  # a pair of ids in one number: A's above, B's below


@lru_cache(maxsize=4)
def _encoders(model_a: str, model_b: str):
    """A's library, the same vocabulary in a faster one for Latin text, B's library; the bytes of every id and their number."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import sentencepiece
    import tiktoken
    from sentencepiece import sentencepiece_model_pb2
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(model_a)
    a.no_truncation()
    a.no_padding()
    a.encode_special_tokens = True
    with open(model_a, encoding="utf-8") as file:
        spec = json.load(file)
    if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
        raise ValueError("A must be a plain byte-level tokenizer")
    byte = {c: b for b, c in _byte_characters().items()}
    bytes_a = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    ranks = {token: i for i, token in enumerate(bytes_a)}
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    in_order = [ranks[bytes(byte[c] for c in x + y)] for x, y in merges]
    if in_order != sorted(in_order) or spec["model"]["vocab"].keys() - a.get_vocab().keys():
        raise ValueError("A's ids must follow the order of its merges")
    special = {t["content"].encode() for t in spec["added_tokens"]}
    fast = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks={t: i for t, i in ranks.items() if t not in special}, special_tokens={})
    proto = sentencepiece_model_pb2.ModelProto()
    with open(model_b, "rb") as file:
        proto.ParseFromString(file.read())
    norm = proto.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces if p.type == 1):
        raise ValueError("B must keep white space, add a blank and have no piece across one")
    bytes_b = [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
    if max(len(bytes_a), len(bytes_b)) >> SHIFT:
        raise ValueError("vocabulary too large")
    b = sentencepiece.SentencePieceProcessor(model_file=model_b)
    return a, fast, b, bytes_a, bytes_b, np.array([len(x) for x in bytes_a]), np.array([len(x) for x in bytes_b])


def _byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte: itself, or the next free one from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For tokens with ascending ends over the same bytes: the B token in which each A and each B token's component ends."""
    n = len(ends_a)
    to_b = np.searchsorted(ends_b, ends_a)
    to_a = np.searchsorted(ends_a, ends_b)
    own = np.arange(n, n + len(ends_b))
    successor = np.concatenate([n + to_b, np.where(ends_a[to_a] > ends_b, to_a, own)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor[:n] - n, successor[n:] - n
        successor = further


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (A token, B token) whose byte ranges overlap."""
    starts = np.concatenate([[0], ends_a[:-1]])
    first = np.searchsorted(ends_b, starts, "right")
    n = np.searchsorted(ends_b, ends_a) - first + 1
    left = np.repeat(np.arange(len(ends_a)), n)
    return left, np.arange(len(left)) - np.repeat(np.cumsum(n) - n - first, n)


def _digits(ids: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the decimal ids, each followed by its separator, and the length of each."""
    width = len(str(int(ids.max()))) if len(ids) else 1
    tens = 10 ** np.arange(width - 1, -1, -1)
    figures = (ids[:, None] // tens % 10 + 48).astype(np.uint8)
    length = 1 + (ids[:, None] >= tens[None, :-1]).sum(1)
    table = np.concatenate([figures, separators[:, None].astype(np.uint8)], axis=1)
    return table[np.arange(width + 1) >= (width - length)[:, None]], length + 1


class Aligner:
    """Strings (each standing for a blank and itself) with their numbers, links and group lists, remembered."""

    def __init__(self, model_a: str, model_b: str) -> None:
        self.models = (model_a, model_b)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[bytes] = []  # 'a1,a2|b1;' per string, None where bytes differ
        self.numbers = np.zeros((0, 4), np.int32)  # n_a, n_b, n_groups, n_links
        self.links = np.zeros(0, np.int64)  # pairs of ids, string by string

    def learn(self, strings: list[str]) -> None:
        numbers, links = [self.numbers], [self.links]
        for at in range(0, len(strings), FRESH):
            found = self._align(strings[at : at + FRESH])
            numbers.append(found[0])
            links.append(found[1])
        self.numbers, self.links = np.concatenate(numbers), np.concatenate(links)

    def _one_by_one(self, strings: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of both sides one string after the other and how many each has; none where the bytes differ."""
        a, _, b, bytes_a, bytes_b, _, _ = _encoders(*self.models)
        rows_a = [e.ids for e in a.encode_batch_fast([" " + s for s in strings], add_special_tokens=False)]
        rows_b = b.encode(strings, num_threads=1)
        for i, s in enumerate(strings):
            whole = b" " + s.encode()
            if b"".join(map(bytes_a.__getitem__, rows_a[i])) != whole or b"".join(map(bytes_b.__getitem__, rows_b[i])) != whole:
                rows_a[i] = rows_b[i] = []
        found = []
        for rows in (rows_a, rows_b):
            n = np.fromiter(map(len, rows), np.int64, len(rows))
            found += [np.fromiter((x for row in rows for x in row), np.int64, int(n.sum())), n]
        return tuple(found)

    def _together(self, strings: list[str]) -> tuple[np.ndarray, ...]:
        """The same from one call per side, cut at the strings' ends, if all bytes agree and all ends are ends of tokens."""
        a, fast, b, bytes_a, bytes_b, size_a, size_b = _encoders(*self.models)
        text = " ".join(strings)
        whole = b" " + text.encode()
        ends = np.cumsum([1 + len(s.encode()) for s in strings])
        found = []
        ids_a = fast.encode_ordinary(" " + text) if max(text) < LATIN else a.encode(" " + text, add_special_tokens=False).ids
        ids_b = [i for row in b.encode(strings, num_threads=1) for i in row]
        for ids, table, size in ((ids_a, bytes_a, size_a), (ids_b, bytes_b, size_b)):
            if b"".join(map(table.__getitem__, ids)) != whole:
                return self._one_by_one(strings)
            ids = np.array(ids, np.int64)
            upto = np.cumsum(size[ids])
            last = np.searchsorted(upto, ends)
            if not np.array_equal(upto[last], ends):
                return self._one_by_one(strings)
            found += [ids, np.diff(last + 1, prepend=0)]
        return tuple(found)

    def _align(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        *_, size_a, size_b = _encoders(*self.models)
        kind = [0 if s != s.strip() or SPACE in s else 1 if s.isascii() or max(s) < LATIN else 2 for s in strings]
        kinds = [[s for s, k in zip(strings, kind, strict=True) if k == n] for n in range(3)]
        parts = [self._one_by_one(kinds[0])] if kinds[0] else []
        parts += [self._together(group[at : at + JOINED]) for group in kinds[1:] for at in range(0, len(group), JOINED)]
        strings = [s for group in kinds for s in group]
        ids_a, n_a, ids_b, n_b = map(np.concatenate, zip(*parts, strict=True))
        of_a, of_b = (np.repeat(np.arange(len(strings)), n) for n in (n_a, n_b))
        ends_a, ends_b = np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])
        group_a, group_b = terminals(ends_a, ends_b)
        left, right = overlaps(ends_a, ends_b)
        is_end = group_b == np.arange(len(group_b))
        n_groups = np.bincount(of_b[is_end], minlength=len(strings))
        n_links = np.bincount(of_a[left], minlength=len(strings))

        # Groups as text: tokens by group, A's first; the separator tells what follows a token.
        group, side = np.concatenate([group_a, group_b]), np.repeat([0, 1], [len(ids_a), len(ids_b)])
        order = np.argsort(2 * group + side, kind="stable")
        group, side, ids = group[order], side[order], np.concatenate([ids_a, ids_b])[order]
        same = np.append((group[1:] == group[:-1]) & (side[1:] == side[:-1]), False)
        text, length = _digits(ids, np.where(same, ord(","), np.where(side == 0, ord("|"), ord(";"))))
        upto = np.cumsum(np.bincount(np.concatenate([of_a, of_b])[order], length, len(strings)).astype(np.int64))
        text, since = text.tobytes(), 0
        for s, end, found in zip(strings, upto.tolist(), n_a.tolist(), strict=True):
            self.index[s] = len(self.groups)
            self.groups.append(text[since:end] if found else None)
            since = end
        return np.stack([n_a, n_b, n_groups, n_links], axis=1).astype(np.int32), (ids_a[left] << SHIFT) | ids_b[right]

    def of(self, rows: list[list[str]]) -> list[list[int]]:
        """Numbers of the strings of each row."""
        index = self.index
        fresh = list({s for row in rows for s in row if s not in index})
        if fresh:
            self.learn(fresh)
        return [list(map(index.__getitem__, row)) for row in rows]


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the ranges, one after the other."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


ALIGNED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, strings array<int>, "
    "pairs array<long>, pair_links array<long>, string_at array<int>, string_pairs array<int>"
)


def _aligned_block(aligner: Aligner, block: int, doc_ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    """A row per text with the numbers of its strings, and a row with the block's pairs and what strings hold of them."""
    rows = aligner.of([CUT.split(t) if t else [] for t in texts])
    strings = aligner.groups
    rows = [row if None not in map(strings.__getitem__, row) else [] for row in rows]
    m = len(rows)
    lengths = np.fromiter(map(len, rows), np.int64, m)
    every = np.fromiter((i for row in rows for i in row), np.int64, int(lengths.sum()))
    of = np.repeat(np.arange(m), lengths)
    totals = np.zeros((m, 4), np.int64)
    np.add.at(totals, of, aligner.numbers[every])
    digests = [hashlib.sha256(b"".join(map(strings.__getitem__, row))[:-1]).hexdigest() if row else "" for row in rows]

    used, local = np.unique(every, return_inverse=True)
    n_links = aligner.numbers[:, 3].astype(np.int64)
    starts = np.cumsum(n_links) - n_links
    pairs, string_pairs = np.unique(aligner.links[_ragged(starts[used], n_links[used])], return_inverse=True)
    string_at = np.concatenate([[0], np.cumsum(n_links[used])])
    pair_links = np.zeros(len(pairs), np.int64)
    np.add.at(pair_links, string_pairs, np.repeat(np.bincount(local, minlength=len(used)), n_links[used]))

    whole = lambda values, kind: pa.ListArray.from_arrays(pa.array([0] * (m + 1) + [len(values)], pa.int32()), pa.array(values, kind))
    number = lambda values: pa.array([*values.tolist(), None], pa.int64())
    return pa.record_batch(
        {
            "block": pa.array(np.full(m + 1, block, np.int64)),
            "doc_id": pa.concat_arrays([doc_ids.cast(pa.int64()), pa.nulls(1, pa.int64())]),
            "n_a": number(totals[:, 0]),
            "n_b": number(totals[:, 1]),
            "n_groups": number(totals[:, 2]),
            "n_links": number(totals[:, 3]),
            "groups_sha256": pa.array([*digests, None], pa.string()),
            "strings": pa.ListArray.from_arrays(pa.array([0, *np.cumsum(lengths).tolist(), int(lengths.sum())], pa.int32()), pa.array(local.astype(np.int32))),
            "pairs": whole(pairs, pa.int64()),
            "pair_links": whole(pair_links, pa.int64()),
            "string_at": whole(string_at, pa.int32()),
            "string_pairs": whole(string_pairs, pa.int32()),
        }
    )


def aligned_blocks(docs: DataFrame, model_a: str, model_b: str, block: int = BLOCK) -> DataFrame:
    """Documents aligned block by block: per block a row per document (n_a is set) and one with its id pairs.

    ``strings`` are numbers into ``string_at``, whose ranges of ``string_pairs`` are numbers into ``pairs``.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(model_a, model_b)
        number = TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0

        def flushed() -> pa.RecordBatch:
            if len(aligner.groups) > KNOWN:
                aligner.clear()
            return _aligned_block(aligner, number, pa.array(ids, pa.int64()), texts)

        for batch in batches:
            _, offsets = column_bytes(batch.column(1))
            for i, text, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), np.diff(offsets).tolist(), strict=True):
                if texts and held + size > block:
                    yield flushed()
                    number += 1
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(text)
                held += size
        if texts:
            yield flushed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(align, ALIGNED)


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _with_counts(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block with the corpus-wide counts of its pairs summed over their links."""
    own = rows.column("n_a").is_valid()
    listed = rows.filter(pc.invert(own))
    docs = rows.filter(own)
    at = counts["at"].to_numpy()
    string_at = listed["string_at"].combine_chunks().flatten().to_numpy()
    string_pairs = listed["string_pairs"].combine_chunks().flatten().to_numpy()
    sums = []
    for name in ("count", "best"):
        of_pair = np.zeros(len(at), np.int64)
        of_pair[at] = counts[name].to_numpy()
        running = np.concatenate([[0], np.cumsum(of_pair[string_pairs])])
        of_string = running[string_at[1:]] - running[string_at[:-1]]
        strings = docs["strings"].combine_chunks()
        running = np.concatenate([[0], np.cumsum(of_string[strings.flatten().to_numpy()])])
        upto = np.concatenate([[0], np.cumsum(pc.list_value_length(strings).to_numpy(zero_copy_only=False).astype(np.int64))])
        sums.append(running[upto[1:]] - running[upto[:-1]])
    return pa.table(
        {
            **{c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
            "n_best": pa.array(sums[1], pa.int64()),
            "count_sum": pa.array(sums[0], pa.int64()),
            "groups_sha256": docs["groups_sha256"],
        }
    )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): links of each id pair over all blocks; best is 1 if no other pair of its B id has more."""
    own = blocks.filter("n_a is null").select(F.explode(F.arrays_zip("pairs", "pair_links")).alias("e"))
    counts = stored(own.groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.pair_links").alias("count")), "pair-counts")
    of_b = F.col("pair").bitwiseAND((1 << SHIFT) - 1)
    most = counts.groupBy(of_b.alias("b")).agg(F.max("count").alias("most"))  # a row per id of a vocabulary
    joined = counts.join(F.broadcast(most), of_b == F.col("b"))
    return joined.select("pair", "count", F.when(F.col("count") == F.col("most"), 1).otherwise(0).cast("long").alias("best"))


def align(docs: DataFrame, model_a: str, model_b: str, block: int = BLOCK) -> DataFrame:
    """How the tokens of A and B align in every whole text: RESULT, one row per row of ``docs``.

    Texts that are null or empty, or whose joined token bytes differ from the text after a blank, have no
    tokens: zeros and ''. Repeated rows and null ids are kept and all count; ties for the highest count of a B id are
    all best; further columns are ignored. An empty table gives an empty result. A task needs
    memory for one block of text, or for one longer text.
    """
    blocks = stored(aligned_blocks(docs, model_a, model_b, block), "aligned")
    listed = blocks.filter("n_a is null").select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("at", "pair"))
    counts = listed.join(pair_counts(blocks), "pair").select("of_block", "at", "count", "best")
    rows = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "strings", "string_at", "string_pairs")
    return rows.groupBy("block").cogroup(counts.groupBy("of_block")).applyInArrow(_with_counts, RESULT)
