"""Exact substring dedup by grouping fingerprints of content-defined anchors and windows.

Which 200-byte strings start at more than one place? This is not prefix doubling: no suffix is sorted, no offset
grows and no rank feeds the next round. Doubling over every position would shuffle many times the input (not
measured), so a sample of places that equal strings are sure to share stands for them:
each window of ``length`` bytes selects the place of its smallest short hash as its anchor, and
consecutive windows with one anchor form a run. A rank below is a fingerprint of a stretch, hashed from its two
halves; Spark groups equal ones, drops what is unique and looks closer at the rest:

1. ranks of the anchors' prefixes of ``core`` bytes, the pair (first half, second half): runs whose anchor has a
   unique rank hold no repeated window;
2. the pair (that rank, rank of the whole stretch that the windows of the run cover): if it occurs
   again, every window of the run is repeated;
3. only where runs agree in the first pair and differ in the second, each window start on its own, with the
   pair (first half, second half) of ``length`` bytes, past which nothing is compared.

One run of every stretch known to be repeated takes part in step 3, so a window that occurs once elsewhere
inside such a stretch is found too. Every step is an aggregate with combining before the shuffle and
a join back whose other side has one row per key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebeacon.llm import text as tx
from casebeacon.llm.tables import discard, stored, unused_name

LENGTH = 200
SEGMENT = 1_000_000  # window starts handled at once inside one long text


def _layout(length: int) -> tuple[int, int]:
    """(width, core): anchors are chosen among ``width`` places, and width + core - 1 = length."""
    width = max(1, length * 8 // 25)
    return width, length - width + 1


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return tx.mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _rank(prefix: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Rank of the ``size`` bytes from each start: the pair of the ranks of its halves."""
    half = size // 2
    return _pair(tx.span_hash(prefix, start, start + half), tx.span_hash(prefix, start + half, start + size))


def _runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, first window (in its text), windows, and the two ranks."""
    width, core = _layout(length)
    windows = len(data) - length + 1
    if windows < 1:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefix = tx.prefix_hash(data)
    size = min(16, core)
    at = np.arange(windows + width - 1)
    # The place in the low bits names the anchor, and makes the leftmost of equal hashes the smallest.
    bits = np.uint64((1 << max(1, int(len(data)).bit_length())) - 1)
    hashed = (tx.span_hash(prefix, at, at + size) & ~bits) | at.astype(np.uint64)
    anchor = (_window_minimum(hashed, width)[:windows] & bits).astype(np.int64)
    text = np.searchsorted(offsets, at[:windows], "right") - 1
    valid = at[:windows] + length <= offsets[text + 1]
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    last = valid.copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~valid[1:]
    first, end = np.flatnonzero(new), np.flatnonzero(last) + 1
    anchor, text = anchor[first], text[first]
    shared = _rank(prefix, anchor, core)
    whole = _pair(shared, tx.span_hash(prefix, first, end - 1 + length) + ((anchor - first) << 20).astype(np.uint64))
    return text, first - offsets[text], end - first, shared, whole


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, shift, bytes, offsets): a block as it is, or a long text in overlapping segments."""
    if len(offsets) > 2 or len(data) <= SEGMENT + length:
        yield 0, 0, data, offsets
        return
    for start in range(0, max(1, len(data) - length + 1), SEGMENT):
        part = data[start : start + SEGMENT + length - 1]
        yield 0, start, part, np.array([0, len(part)], np.int64)


def _run_rows(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for rows, data, offsets in tx.blocks(batch):
                for _, shift, part, bounds in _pieces(data, offsets, length):
                    text, start, n, shared, whole = _runs(part, bounds, length)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[rows][text], pa.int64()),
                            pa.array(start + shift, pa.int32()),
                            pa.array(n, pa.int32()),
                            pa.array(shared.view(np.int64)),
                            pa.array(whole.view(np.int64)),
                        ],
                        names=["t", "start", "n", "shared", "whole"],
                    )

    return work


def _window_rows(length: int):
    """Ranks of the single windows of the asked runs: (t, start, shared, rank, again)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            asked = batch.column(2)
            for rows, data, offsets in tx.blocks(batch):
                part = asked[rows]
                counts = np.diff(part.offsets.to_numpy())
                flat = part.flatten()
                start, n, shared, again = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                text = np.repeat(np.arange(len(counts)), counts)
                prefix = tx.prefix_hash(data)
                for low in range(0, len(start), 20_000):
                    some = slice(low, low + 20_000)
                    size = n[some].astype(np.int64)
                    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    place = np.repeat(start[some], size) + inner
                    owner = np.repeat(text[some], size)
                    rank = _rank(prefix, offsets[owner] + place, length)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[rows][owner], pa.int64()),
                            pa.array(place, pa.int32()),
                            pa.array((np.repeat(shared[some], size) >> 32).astype(np.int32)),
                            pa.array(rank.view(np.int64)),
                            pa.array(np.repeat(again[some], size), pa.bool_()),
                        ],
                        names=["t", "start", "shared", "rank", "again"],
                    )

    return work


def text_key() -> Column:
    return F.xxhash64(F.col("text"), F.octet_length("text"))


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(t, start, n): windows start .. start + n - 1 of the texts with key t occur more than once in ``docs``.

    Equal texts have one key and one set of rows. Written to the shared folder.
    """
    texts = docs.select(text_key().alias("t"), "text").filter(F.octet_length("text") >= length)
    # Copies of a text repeat all their windows; the rounds see each as often as it occurs.
    runs = stored(texts.mapInArrow(_run_rows(length), "t long, start int, n int, shared long, whole long"), "suffix-runs")
    again = stored(runs.groupBy("shared").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("shared"), "suffix-round1")
    left = stored(runs.join(again, "shared"), "suffix-left")
    discard(runs, again)

    classes = left.groupBy("shared", "whole").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("t", "start", "n")).alias("one"))
    classes = stored(classes, "suffix-round2")
    known = stored(left.join(classes.filter("m > 1").select("shared", "whole"), ["shared", "whole"]).select("t", "start", "n").distinct(), "suffix-known")
    discard(left)
    mixed = classes.groupBy("shared").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("shared")
    asked = classes.join(mixed, "shared").select("one.t", F.struct("one.start", "one.n", "shared", (F.col("m") > 1).alias("again")).alias("run"))
    asked = stored(asked.groupBy("t").agg(F.collect_list("run").alias("runs")), "suffix-asked")
    discard(classes)

    bodies = texts.join(asked.select("t"), "t", "left_semi").dropDuplicates(["t"])
    single = bodies.join(asked, "t").select("t", "text", "runs").mapInArrow(_window_rows(length), "t long, start int, shared int, rank long, again boolean")
    single = stored(single, "suffix-single")
    discard(asked)
    met = single.groupBy("shared", "rank").agg(F.count(F.lit(1)).alias("m"), F.max("again").alias("known")).filter("m > 1 or known").select("shared", "rank")
    met = stored(met, "suffix-round3")
    found = single.filter("not again").join(met, ["shared", "rank"]).select("t", "start", F.lit(1).alias("n"))
    out = stored(known.union(found), "suffix-repeats")
    discard(known, single, met)
    return out


def covered(starts: np.ndarray, counts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal byte runs [from, to) that the repeated windows cover; touching runs are one."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    low = starts[order].astype(np.int64)
    high = np.maximum.accumulate(low + counts[order] - 1 + length)
    first = np.concatenate([[True], low[1:] > high[:-1]])
    return list(zip(low[first].tolist(), high[np.append(first[1:], True)].tolist(), strict=True))


def _cut(length: int, texts: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, rows = batch.column(1), []
            for i, text in enumerate(batch.column(0).cast(pa.binary())):
                data = text.as_py() or b""
                mine = runs[i].values
                spans = covered(*(mine.field(j).to_numpy(zero_copy_only=False) for j in range(2)), length) if mine is not None else []
                at, rest = 0, []
                for low, high in spans:
                    rest.append(data[at:low])
                    at = high
                kept = b"".join([*rest, data[at:]])
                rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if texts else None, spans if texts else []))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            columns[5] = [[{"from": a, "to": b} for a, b in spans] for spans in columns[5]]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[*batch.schema.names[2:], *NAMES])

    return work


NAMES = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "spans"]
ADDED = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string, spans array<struct<from: long, to: long>>"


def remove_repeats(docs: DataFrame, length: int = LENGTH, texts: bool = True) -> DataFrame:
    """``docs`` without ``text``, and n_bytes, n_removed, n_spans, kept_sha256, kept_text and spans.

    Every byte covered by a string of ``length`` bytes that also starts elsewhere in the table, the
    same document included, is removed; strings are judged on the input. Texts are taken as UTF-8 bytes;
    kept_text leaves out characters of which a part was removed. A null or short text loses
    nothing by itself; null ids and repeated rows are documents like others, so equal rows remove
    each other. Columns of ``docs`` with a name used here are replaced; an empty table stays empty.
    ``texts=False`` leaves kept_text null and spans empty.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in NAMES and c != "text"]
    filler = unused_name(docs.columns, "filler")  # a struct needs a field, even if docs holds texts only
    repeats = repeated_windows(docs, length)
    spans = stored(repeats.groupBy("t").agg(F.collect_list(F.struct("start", "n")).alias("runs")), "suffix-spans")
    discard(repeats)
    rows = docs.select("text", F.struct(*rest, F.lit(0).alias(filler)).alias("row"), text_key().alias("t")).join(spans, "t", "left").select("text", "runs", "row")
    cut = rows.mapInArrow(_cut(length, texts), f"row {rows.schema['row'].dataType.simpleString()}, {ADDED}")
    return cut.select("row.*", *NAMES).drop(filler)
