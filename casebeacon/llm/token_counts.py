"""Token counts of a sentencepiece BPE model by rank-synchronous merging.

A text is cut into pre-tokens at places that no piece of the vocabulary spans. The different
pre-tokens of a batch are held as one ragged array of symbols; in every round each sequence merges
its pair of lowest rank, all sequences at once, and pairs of one rank within a sequence too where
the vocabulary proves that this cannot change the outcome. The symbols that survive are counted.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CACHE = 400_000  # remembered pre-tokens per worker; only saves time
NONE = np.int32(2**31 - 1)


@dataclass
class Vocabulary:
    size: int
    characters: np.ndarray  # symbol by code point, -1 outside the vocabulary
    cost: np.ndarray  # tokens that a surviving symbol stands for
    pair_keys: np.ndarray  # left * size + right, ascending
    pair_rank: np.ndarray
    pair_result: np.ndarray
    steady: np.ndarray  # by result: later merges with it rank higher
    prefix: bool


@lru_cache(maxsize=4)
def vocabulary(model: str) -> Vocabulary:
    """Merge tables of the model file; raises for models that are not plain BPE with byte fallback."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as file:
        proto.ParseFromString(file.read())
    norm = proto.normalizer_spec
    if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only BPE models with byte fallback and identity normalisation are supported")
    if any(p.type not in (1, 2, 3, 6) for p in proto.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    score = {p.piece: p.score for p in proto.pieces if p.type == 1}
    if any(SPACE in p.lstrip(SPACE) for p in score):
        raise ValueError("a piece spans a word boundary")
    characters = sorted({c for p in score for c in p})
    symbols = {s: i for i, s in enumerate(dict.fromkeys([*characters, *score]))}
    levels = {x: r for r, x in enumerate(sorted({x for s, x in score.items() if len(s) > 1}, reverse=True))}
    order = {s: levels[x] for s, x in score.items() if len(s) > 1}
    cost = np.array([1 if s in score else len(s.encode()) for s in symbols], np.int32)
    size, found, steady = len(symbols), {}, np.ones(len(symbols), bool)
    for piece, rank in order.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in symbols and right in symbols:
                found[symbols[left] * size + symbols[right]] = (rank, symbols[piece])
                for part in (left, right):
                    if order.get(part, -1) >= rank:
                        steady[symbols[part]] = False
    shared = Counter(order.values())
    for piece, rank in order.items():
        if shared[rank] > 1:
            steady[symbols[piece]] = False
    keys = np.array(sorted(found), np.int64)
    table = np.full(0x110000, -1, np.int32)
    for c in characters:
        table[ord(c)] = symbols[c]
    values = np.array([found[k] for k in keys.tolist()], np.int64).reshape(-1, 2)
    return Vocabulary(size, table, cost, keys, values[:, 0].astype(np.int32), values[:, 1].astype(np.int32), steady, norm.add_dummy_prefix)


def _ranks(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = left.astype(np.int64) * v.size + right
    at = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
    hit = (v.pair_keys[at] == key) & (left >= 0) & (right >= 0)
    return np.where(hit, v.pair_rank[at], NONE), v.pair_result[at]


def merge_counts(v: Vocabulary, sequences: list[str]) -> np.ndarray:
    """Tokens per pre-token."""
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    points = np.frombuffer("".join(sequences).encode("utf-32-le"), np.uint32)
    ids = v.characters[points]
    unknown = None
    if (ids < 0).any():
        unknown = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    owner = np.repeat(np.arange(len(sequences)), lengths)
    total = np.zeros(len(sequences), np.int64)
    if unknown is not None:  # characters outside the vocabulary never merge; they only separate
        total += np.bincount(owner, np.where(ids < 0, unknown, 0), len(sequences)).astype(np.int64)
    while len(ids) > 1:
        rank, result = _ranks(v, ids[:-1], ids[1:])
        rank[owner[:-1] != owner[1:]] = NONE
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        low = np.minimum.reduceat(np.append(rank, NONE), starts)
        own = np.repeat(low, np.diff(np.append(starts, len(ids))))
        hit = np.flatnonzero((rank == own[:-1]) & (rank < NONE))
        active = own < NONE
        if not len(hit):
            break
        first = np.concatenate([[True], owner[hit[1:]] != owner[hit[:-1]]])
        # In a run of overlapping hits every second one merges, from the left.
        head = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | first[1:]])
        place = np.arange(len(hit))
        even = (place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0
        hit = hit[first | (even & v.steady[result[hit]])]
        ids[hit] = result[hit]
        keep = active.copy()
        keep[hit + 1] = False
        done = ~active
        total += np.bincount(owner[done], np.where(ids[done] >= 0, v.cost[ids[done]], 0), len(sequences)).astype(np.int64)
        ids, owner = ids[keep], owner[keep]
    total += np.bincount(owner, np.where(ids >= 0, v.cost[ids], 0), len(sequences)).astype(np.int64)
    return total


@lru_cache(maxsize=4)
def _splitter(model: str) -> re.Pattern:
    return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def count_texts(model: str, texts: list[str], cache: dict[str, int]) -> list[int]:
    """Tokens of each text, as the library counts them without begin and end tokens."""
    v, split = vocabulary(model), _splitter(model)
    words = []
    for text in texts:
        text = text.replace(" ", SPACE)
        words.append(split.findall(SPACE + text if v.prefix and text else text))
    if len(cache) > CACHE:
        cache.clear()
    fresh = list({w for row in words for w in row if w not in cache})
    for at in range(0, len(fresh), 50_000):
        part = fresh[at : at + 50_000]
        cache.update(zip(part, merge_counts(v, part).tolist(), strict=True))
    return [sum(map(cache.__getitem__, row)) for row in words]


def token_counts(docs: DataFrame, model: str, limit: int = 4096, block: int = 4_000_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (``n_tokens > limit``) of every whole text.

    Each input row gives one row: nulls and empty texts have 0 bytes and 0 tokens, repeated rows
    and null ids are kept, other columns are ignored. An empty table gives an empty result.
    ``model`` must be a path that executors can read, as the installed vocabulary files are.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame["text"]]
            sizes = [len(t.encode()) for t in texts]
            counts, at = [], 0
            while at < len(texts):
                end, held = at + 1, sizes[at]
                while end < len(texts) and held + sizes[end] <= block:
                    held += sizes[end]
                    end += 1
                counts += count_texts(model, texts[at:end], cache)
                at = end
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": sizes, "n_tokens": counts})

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(count, "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
