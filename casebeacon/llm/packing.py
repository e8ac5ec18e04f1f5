"""Packing of tokenised documents into sequences of fixed length by bulk-synchronous best fit.

Pieces and gaps (what is left in open sequences) are range-sorted by size. In a round every piece
of a band of sizes seeks its successor, the smallest gap that holds it; a sweep over the sizes from
above settles which ranks of a size go to which gaps; joins on ranks carry this out on the rows,
the gaps are updated and sorted again, and the next round follows. A gap that holds several pieces
of the band takes several at once. Pieces for which no gap is left open new sequences, the largest
first and no more than their volume needs. The sweep itself sees counts per size only.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebeacon.llm.tables import discard, stored
from casebeacon.llm.text import column_bytes

BAND = 4  # the smallest size in a band is a quarter of its largest
PART_ROWS = 1_000_000  # of a range-sorted table, in one task
KNOWN = 1_000_000  # remembered words per worker; only saves time
BLANK = re.compile("[ \t\n\r]+")
NO_BLANK = "\x1c\x1d\x1e\x1f"  # white space for Python, marks for tokenizers
TAIL = ".,!?;:"


@lru_cache(maxsize=4)
def _encoder(model: str):
    """The tokenizer of a file, for each id whether it ends a word, and its plain words in a faster library if it allows."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(model)
    encoder.no_truncation()
    encoder.no_padding()
    suffix = encoder.model.end_of_word_suffix
    ends = np.zeros(encoder.get_vocab_size(), bool)
    for token, i in encoder.get_vocab().items():
        ends[i] = bool(suffix) and token.endswith(suffix)
    return encoder, ends, _plain_words(model)


def _plain_words(model: str):
    """The merges among ASCII symbols as byte merges: a symbol that ends a word is its byte plus 128.

    None unless ids follow the order of merges and every merge makes a token of its own.
    """
    import tiktoken

    with open(model, encoding="utf-8") as file:
        spec = json.load(file)["model"]
    suffix, vocab = spec["end_of_word_suffix"], spec["vocab"]
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["merges"]]
    made = [vocab[m] for m in merges]
    if not suffix or made != list(range(made[0], made[0] + len(made))):
        return None
    ranks = {}
    for token, i in vocab.items():
        body = token.removesuffix(suffix)
        if body.isascii() and body.isprintable() and (len(body) == 1 or token in merges[i - made[0] : i - made[0] + 1]):
            ranks[body.encode() if body == token else body[:-1].encode() + bytes([ord(body[-1]) + 128])] = i
    spare = len(vocab)
    for b in range(256):
        if bytes([b]) not in ranks:  # never met in a plain word, but the library wants every byte
            ranks[bytes([b])] = spare = spare + 1
    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def _stem(word: str) -> str:
    """The word without the marks after its last letter or digit, in lower case if that is plain."""
    stem = word.rstrip(TAIL)
    if len(stem) == len(word) or not stem or not unicodedata.normalize("NFC", stem[-1]).lower()[-1].isalnum():
        stem = word
    return stem.lower() if stem.isascii() and stem.isalpha() else stem


class Encoder:
    """Ids of texts for lower-casing tokenizers that drop white space and mark word ends.

    Words between blanks are encoded once and remembered, each as its stem and the marks that follow. This
    equals encoding the whole text if no rule of the tokenizer looks across a blank and letters, digits
    and marks are kept apart.
    """

    def __init__(self, model: str) -> None:
        self.model, self.known, self.stems = model, {}, {}

    def _learn(self, stems: list[str]) -> None:
        encoder, ends, plain = _encoder(self.model)
        if plain is not None:
            encode = plain._encode_single_piece
            for s in stems:
                if s.isascii() and s.isalpha():
                    self.stems[s] = array("I", encode(s[:-1].encode() + bytes([ord(s[-1]) + 128]))).tobytes()
            stems = [s for s in stems if s not in self.stems]
        letters = [s for s in stems if s.isalpha()]
        others = [s for s in stems if not s.isalpha()]
        for at in range(0, len(letters), 1000):
            part = letters[at : at + 1000]
            ids = np.array(encoder.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            cut = np.flatnonzero(ends[ids]) + 1
            if len(cut) != len(part):  # some letters come apart when normalised
                others += part
                continue
            text, cut = ids.tobytes(), (4 * cut).tolist()
            self.stems.update(zip(part, map(text.__getitem__, map(slice, [0, *cut[:-1]], cut)), strict=True))
        for at in range(0, len(others), 20_000):
            part = others[at : at + 20_000]
            found = encoder.encode_batch_fast(part, add_special_tokens=False)
            self.stems.update((s, np.array(f.ids, "<u4").tobytes()) for s, f in zip(part, found, strict=True))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers."""
        rows = [BLANK.split(t) if any(map(t.__contains__, NO_BLANK)) else t.split() for t in texts]
        known, stems = self.known, self.stems
        words = set().union(*rows)
        fresh = [w for w in words if w not in known]
        cut = list(map(_stem, fresh))
        tails = [w[len(s) :] for w, s in zip(fresh, cut, strict=True)]
        self._learn(list({s for s in (*cut, *tails) if s not in stems}))
        known.update((w, stems[s] + stems[t]) for w, s, t in zip(fresh, cut, tails, strict=True))
        near = {w: known[w] for w in words}  # few enough to stay in the processor's cache
        out = [b"".join(map(near.__getitem__, row)) for row in rows]
        if len(known) > KNOWN:
            known.clear()  # is soon built again from the stems
        if len(stems) > KNOWN:
            stems.clear()
        return out


@lru_cache(maxsize=2)
def _shared(model: str) -> Encoder:
    """The worker's encoder of a model: what it remembers outlives a task."""
    return Encoder(model)


def token_pieces(docs: DataFrame, model: str, capacity: int = 2048, end: int = 0, block: int = 4_000_000) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of the pieces of every whole text.

    A text's ids, then ``end``, are cut into pieces of ``capacity`` if there are more of them. Null and empty texts
    have the id ``end`` alone. Each row counts for itself, so repeated rows, repeated and null ids
    are kept; other columns are ignored. A task needs memory for a ``block`` of text or one longer text.
    """
    last = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _shared(model)
        for batch in batches:
            texts = batch.column(1)
            _, offsets = column_bytes(texts)
            row = 0
            while row < batch.num_rows:
                upto = min(max(row + 1, int(np.searchsorted(offsets, offsets[row] + block, "right")) - 1), batch.num_rows)
                places, found = [], []
                for i, ids in enumerate(encoder.ids([t or "" for t in texts.slice(row, upto - row).to_pylist()]), row):
                    ids += last
                    total = len(ids) // 4
                    for piece, start in enumerate(range(0, total, capacity)):
                        part = ids[4 * start : 4 * (start + capacity)]
                        places.append(i)
                        found.append((piece, start, len(part) // 4, zlib.crc32(part)))
                columns = np.array(found, np.int64)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0).take(pa.array(places, pa.int64())),
                        "piece": columns[:, 0].astype(np.int32),
                        "start": columns[:, 1],
                        "length": columns[:, 2],
                        "ids_crc32": columns[:, 3],
                    }
                )
                row = upto

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _in_order(table: DataFrame, rows: int, columns: list[str], size: str, label: str) -> tuple[DataFrame, dict[int, int], DataFrame]:
    """The table range-sorted and stored, with ``place`` (from 0); rows per size; the stored table.

    ``rows`` is a bound on the number of rows. The driver gets a count per task and size: the tasks grow with the table, the sizes are bounded.
    """
    spark = table.sparkSession
    tasks = max(1, -(-rows // PART_ROWS))
    order = table.repartitionByRange(tasks, *columns).sortWithinPartitions(*columns)
    kept = stored(order.withColumn("slot", F.monotonically_increasing_id()), label)
    part = F.shiftright("slot", 33).cast("int")
    counts = kept.groupBy(part.alias("part"), F.col(size).alias("size")).count().collect()
    parts, sizes = defaultdict(int), defaultdict(int)
    for row in counts:
        parts[row["part"]] += row["count"]
        sizes[row["size"]] += row["count"]
    before, starts = 0, []
    for p in sorted(parts):
        starts.append((p, before))
        before += parts[p]
    starts = F.broadcast(spark.createDataFrame(starts, "part int, before long"))
    placed = kept.withColumn("part", part).join(starts, "part").withColumn("place", F.col("before") + F.col("slot").bitwiseAND((1 << 33) - 1))
    return placed.drop("part", "slot", "before"), dict(sizes), kept


def sweep(docs: dict[int, int], gaps: dict[int, int], top: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit of one round: (size, gap, slots of a gap, first slot, pieces), sizes falling.

    ``docs`` and ``gaps`` count by size; no piece is larger than ``top``. A gap offers as many equal slots as
    it holds pieces of ``top``, at least one. Sizes are swept from above: gaps met on the way wait on a
    stack, whose head is the smallest that is free, and pieces of a size take from it.
    """
    offers = defaultdict(list)
    for gap, n in gaps.items():
        slots = max(1, gap // top)
        offers[gap // slots].append([gap, slots, n * slots, 0])
    flows, free = [], []
    for size in sorted({*docs, *offers}, reverse=True):
        free += sorted(offers.get(size, []), reverse=True)
        left = docs.get(size, 0)
        while left and free:
            gap, slots, n, used = free[-1]
            taken = min(left, n - used)
            flows.append((size, gap, slots, used, taken))
            left -= taken
            free[-1][3] += taken
            if free[-1][3] == n:
                free.pop()
    return flows


def _seeds(docs: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """(size, pieces) that open new sequences: the largest, as many as the volume needs, all above half."""
    volume = sum(s * n for s, n in docs.items())
    need = max(-(-volume // capacity), sum(n for s, n in docs.items() if 2 * s > capacity))
    out = []
    for size in sorted(docs, reverse=True):
        n = min(need, docs[size])
        if n:
            out.append((size, n))
            need -= n
    return out


def _first(sizes: dict[int, int]) -> dict[int, int]:
    """Place of the first row of each size."""
    before, out = 0, {}
    for size in sorted(sizes):
        out[size] = before
        before += sizes[size]
    return out


def _round(docs: DataFrame, gaps: DataFrame | None, low: int, top: int, moves: list[tuple], seeds: list[tuple], capacity: int) -> DataFrame:
    """(place, size, sequence, offset) of the pieces that this round places.

    ``moves``: (size, from, to, gap place, first slot, slots); ``seeds``: (size, from, to) by places of pieces.
    """
    spark = docs.sparkSession
    band = docs.filter((F.col("size") > low) & (F.col("size") <= top)).select("size", "place")
    out = []
    if moves:
        plan = F.broadcast(spark.createDataFrame(moves, "size int, since long, until long, at long, slot long, slots long"))
        asked = band.join(plan, "size").filter("place >= since and place < until")
        asked = asked.select("place", "size", F.expr("at + (slot + place - since) div slots").alias("gap_place"))
        held = asked.join(gaps.select(F.col("place").alias("gap_place"), "sequence", "gap"), "gap_place")
        held = held.selectExpr("place", "size", "sequence", f"{capacity} - gap + sum(size) over (partition by sequence order by place) - size as offset")
        out.append(held)
    if seeds:
        plan = F.broadcast(spark.createDataFrame(seeds, "size int, since long, until long"))
        new = band.join(plan, "size").filter("place >= since and place < until")
        out.append(new.selectExpr("place", "size", "place as sequence", "cast(0 as bigint) as offset"))
    placed = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    return placed.select("place", "size", "sequence", F.col("offset").cast("long"))


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``: no sequence is longer than ``capacity``, offsets are gapless from 0.

    ``length`` tells a row's size; where it is null, below 1 or above ``capacity`` the row has no place
    (null). Columns called sequence_id and offset before are replaced, all others are kept. Rows
    may repeat; an empty table gives an empty result. Sequences are numbered by the place of their largest piece.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    given = stored(pieces.select(F.col("length").cast("int").alias("size"), row, F.monotonically_increasing_id().alias("key")), "pieces")
    fits = F.coalesce(F.col("size").between(1, capacity), F.lit(False))
    docs, left, _ = _in_order(given.filter(fits), given.count(), ["size", "key"], "size", "pieces-sorted")
    first = _first(left)
    gaps, open_gaps, gap_files = None, {}, None
    rounds: list[DataFrame] = []
    top = capacity
    while left:
        low = capacity // 2 if top == capacity else top // BAND
        while band := {s: n for s, n in left.items() if s > low}:
            highest = max(band)
            flows = sweep(band, open_gaps, highest)
            seeds = [] if flows else _seeds(band, capacity)
            gap_first, moves, opened = _first(open_gaps), [], []
            taken = defaultdict(int)
            for size, gap, slots, used, n in flows:
                since = first[size] + taken[size]
                moves.append((size, since, since + n, gap_first[gap], used, slots))
                taken[size] += n
            for size, n in seeds:
                opened.append((size, first[size], first[size] + n))
                taken[size] += n
            placed = stored(_round(docs, gaps, low, highest, moves, opened, capacity), "placed")
            rounds.append(placed)
            for size, n in taken.items():
                first[size] += n
                left[size] -= n
                if not left[size]:
                    del left[size]
            change = placed.select("sequence", (-F.col("size")).alias("gap"))
            if opened:
                change = change.union(placed.filter("place = sequence").select("sequence", F.lit(capacity).alias("gap")))
            if gaps is not None:
                change = change.union(gaps.select("sequence", "gap"))
            after = change.groupBy("sequence").agg(F.sum("gap").cast("int").alias("gap")).filter("gap > 0")
            bound = sum(open_gaps.values()) + sum(n for _, n in seeds)
            gaps, open_gaps, files = _in_order(after, bound, ["gap", "sequence"], "gap", "gaps")
            if gap_files is not None:
                discard(gap_files)
            gap_files = files
        top = low
    placed = pieces.sparkSession.createDataFrame([], "place long, sequence_id long, offset long")
    if rounds:
        placed = pieces.sparkSession.read.schema(rounds[0].schema).parquet(*[r.stored_at for r in rounds])
        placed = placed.select("place", F.col("sequence").alias("sequence_id"), "offset")
    own = [F.col(f"row.`{c}`") for c in names]
    put = docs.join(placed, "place").select(*own, "sequence_id", "offset")
    rest = given.filter(~fits).select(*own, F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"))
    return put.unionByName(rest)
