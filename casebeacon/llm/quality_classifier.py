"""A compression classifier for text quality.

Two zstandard dictionaries are trained on good and bad labelled texts. A text that resembles the
good ones compresses better with the good dictionary. Every piece of ``PIECE`` bytes of a text is
compressed with both (whole long texts would soon be compressed by their own past); the
difference of the two sizes, divided by the larger one, is averaged over the bytes and turned into
a probability by a logistic curve fitted to labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebeacon.llm.tables import stored

SAMPLE_ROWS = 3000  # labelled texts per class brought to the driver
SAMPLE_BYTES = 24_000_000  # and their total size per class
DICTIONARY_BYTES = 262_144
PIECE = 512
LEVEL = 3


@dataclass(frozen=True)
class Classifier:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    prior: float  # score of texts without bytes

    def difference(self, texts: list[bytes]) -> np.ndarray:
        good, bad = (_compressor(d).compress for d in (self.good, self.bad))
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            total = 0.0
            for piece in pieces(text):
                ours, theirs = len(good(piece)), len(bad(piece))
                total += len(piece) * (theirs - ours) / max(ours, theirs)
            out[i] = total / max(1, len(text))
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        value = 1 / (1 + np.exp(-np.clip(self.slope * self.difference(texts) + self.offset, -500, 500)))
        return np.where(np.fromiter(map(len, texts), int, len(texts)) > 0, value, self.prior)


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    kept = zstandard.ZstdCompressionDict(dictionary)
    kept.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=kept, write_content_size=False, write_dict_id=False)


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the texts themselves where they are too few to train on."""
    samples = [p for t in texts for p in pieces(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:].ljust(8)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a slight pull of the slope towards 0."""
    w = np.zeros(2)
    a = np.stack([x, np.ones_like(x)], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag([ridge, 1e-9])
        step = np.linalg.solve(h, a.T @ (y - p) - np.array([ridge, 0]) * w)
        w = w + np.clip(step, -50, 50)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Classifier:
    """Fit on a bounded sample: ``rows`` labelled texts per class in hash order, cut off after ``size`` bytes.

    The sample is drawn among labelled ids that have a text in ``docs``, a null or one of more than ``size`` / 8
    bytes not counted. An id labelled both good and bad says nothing and is left out; repeated rows of an id
    with the same text count once.

    Every second sampled text goes to the dictionaries, the others fit the curve. Without texts
    of one class the difference says nothing, so every text gets the same score: the share of good labels,
    or 0.5 without labels.
    """
    marks = labels.select(F.col("doc_id").alias("id"), F.col(column).cast("int").alias("label")).filter("label in (0, 1)")
    marks = marks.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter(F.length("text") <= size // 8)
    texts = texts.withColumn("t", F.xxhash64("text"))
    drawn = texts.select("doc_id", "t").join(marks, F.col("doc_id") == F.col("id")).select("id", "t", "label").distinct()
    picked = None
    for label in (0, 1):
        part = drawn.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id", "t").limit(rows)
        picked = part if picked is None else picked.union(part)
    picked = stored(picked, "classifier-sample")
    sample = texts.join(F.broadcast(picked), (F.col("doc_id") == F.col("id")) & (texts.t == picked.t)).drop(picked.t).dropDuplicates(["id", "t"])
    groups: dict[int, list[bytes]] = {0: [], 1: []}
    held = [0, 0]
    for row in sample.select("label", "text", F.xxhash64("doc_id").alias("h")).orderBy("h", "label", "text").toLocalIterator():
        if held[row.label] + len(row.text) <= size:
            groups[row.label].append(bytes(row.text))
            held[row.label] += len(row.text)
    counts = {r["label"]: r["n"] for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = (counts.get(1, 0) / sum(counts.values())) if counts else 0.5
    if min(map(len, groups.values())) < 2:
        return Classifier(b" " * 8, b" " * 8, 0.0, float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))), prior)
    model = Classifier(_dictionary(groups[1][::2]), _dictionary(groups[0][::2]), 1.0, 0.0, prior)
    x = np.concatenate([model.difference(groups[k][1::2]) for k in (0, 1)])
    y = np.concatenate([np.full(len(groups[k][1::2]), float(k)) for k in (0, 1)])
    slope, offset = _logistic(x, y)
    # The sample holds as many bad as good texts; the offset restores the share among all labels.
    share = y.mean()
    offset += float(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return Classifier(model.good, model.bad, slope, offset, prior)


def score(docs: DataFrame, model: Classifier, threshold: float = 0.3) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (score >= threshold) of each whole text.

    Null and empty texts get the share of good labels. Repeated rows and null ids are scored like
    others, and texts of any length piece by piece; existing columns named score or predicted are replaced; an empty table stays empty.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY_BYTES

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(sent.value.score([t.encode() if isinstance(t, str) else b"" for t in part]))

    return docs.withColumn("score", scored("text")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the ids that labels are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def fit_quality(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> Classifier:
    """The classifier of ``labels.quality``, learnt from the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    return train(docs if docs is not None else spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
