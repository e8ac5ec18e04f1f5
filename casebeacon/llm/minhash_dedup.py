"""Near-duplicate documents from bottom-k sketches of one hash function.

1. Every text becomes its set of word shingles; its ``K`` smallest hashes are the sketch. Documents
   with equal sets are one node from here on.
2. Inverted lists hold the nodes that retain a value. Of each list, the nodes are paired with one
   hub; pairs pass the estimate from the bottom-k of the union of both sketches and then the exact
   Jaccard test on full sets. Connected components of the verified links absorb groups of copies
   of any size with a number of pairs that is linear in the group.
3. What the hubs may have missed are links between different components. Lists of up to ``COLD``
   nodes pair all nodes of different components. A longer list comes from a passage
   that many texts share, or from a large group of near copies. Two similar texts that meet only in long
   lists must have sketches that consist mostly of such values, so only these nodes are taken
   further, and of these only the ones that share enough shingles with any other: they meet where
   ``ROWS`` min-hashes of the full sets agree, in one of ``BANDS`` ways. Neighbours in size inside such a bucket
   are tried together with the hubs, so that here, too, few components are left to compare.

With similarity 0.75, two sketches share none of the smallest r values of their union with a chance
of 0.25 ** r. Two full sets share no bucket with a chance of (1 - 0.75 ** 4) ** 32 = 5e-6, whatever their sizes: none
of 8,000 drawn pairs of a set and its subset (similarity 0.75 to 0.80) did, where buckets taken from sketches
had missed 172. No list is cut and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebeacon.llm import text as tx
from casebeacon.llm.suffix_dedup import text_key
from casebeacon.llm.tables import components, discard, small_side, stored

K = 64
HUB_VALUES = 4
DEPTH = 32
COLD = 32
HOT_SHARE = 0.5
BANDS, ROWS = 32, 4
PARTS = 32
LARGE_K = 256  # sketch of the nodes that share long lists; there are many dissimilar pairs among them
THRESHOLD = (75, 100)


def _signature(sets: list[np.ndarray]) -> tuple[list[int], list[int], list[np.ndarray]]:
    sizes, nodes, sketches = [], [], []
    for s in sets:
        sizes.append(len(s))
        nodes.append(int(tx.ordered(tx.mix(tx.mix(s).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s))))[0]) if len(s) else 0)
        sketches.append(tx.ordered(s[:K]))
    return sizes, nodes, sketches


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, t, n_shingles, node, sketch) of every row; t is the key of its text, node a fingerprint of the whole set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in tx.blocks(batch):
                sizes, nodes, sketches = _signature(tx.shingle_sets(data, offsets))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sketches])]).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.int64), *sketches])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[rows], batch.column(2)[rows], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                    names=["doc_id", "t", "n_shingles", "node", "sketch"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("t")).mapInArrow(work, "doc_id long, t long, n_shingles long, node long, sketch array<long>")


def _similar_size(a: str, b: str) -> str:
    return f"{THRESHOLD[1]} * least({a}, {b}) >= {THRESHOLD[0]} * greatest({a}, {b})"


def _estimated(pairs: DataFrame, nodes: DataFrame, k: int = K) -> DataFrame:
    """Pairs (a, b) whose union sketch doesn't rule the threshold out.

    Five standard deviations are allowed; none where the sketches hold the whole union.
    """
    left = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    rows = pairs.join(left, "a").join(right, "b")
    union = rows.withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k))
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), "u"))
    p, size = THRESHOLD[0] / THRESHOLD[1], F.size("u")
    allowed = F.when(size < k, 0.0).otherwise(5 * F.sqrt(p * (1 - p) * size))
    return union.filter(both >= p * size - allowed).select("a", "b")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets have the required Jaccard similarity."""
    pairs = stored(pairs, "near-pairs")
    texts = _full_sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "doc_id"), "node"), docs)
    left = texts.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = texts.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(a, b, strict=True)):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            out[i] = THRESHOLD[1] * common >= THRESHOLD[0] * (len(x) + len(y) - common)
        return pd.Series(out)

    return pairs.join(left, "a").join(right, "b").filter(linked("sa", "sb")).select("a", "b")


def _full_sets(needed: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles) of the asked nodes (node, doc_id), read again from the texts."""
    needed = stored(needed, "near-needed")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(needed), "doc_id").select("node", "text")
    # Two rows may share an id with different texts: the right one is recognised by its set.
    out = stored(texts.mapInArrow(_matching_sets, "node long, shingles binary").dropDuplicates(["node"]), "near-sets")
    discard(needed)
    return out


def _matching_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in tx.blocks(batch):
            sets = tx.shingle_sets(data, offsets)
            _, nodes, _ = _signature(sets)
            asked = batch.column(0)[rows].to_pylist()
            keep = [i for i, (n, m) in enumerate(zip(nodes, asked, strict=True)) if n == m]
            yield pa.RecordBatch.from_arrays(
                [pa.array([asked[i] for i in keep], pa.int64()), pa.array([sets[i].tobytes() for i in keep], pa.binary())], names=["node", "shingles"]
            )


def _band_keys(shingles: pd.Series) -> pd.Series:
    """The ``BANDS`` bucket keys of whole sets: each from the least values under ``ROWS`` hash functions."""
    seeds = tx.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
    out = []
    for packed in shingles:
        v = np.frombuffer(packed, np.uint64)
        least = np.array([tx.mix(v ^ seed).min() for seed in seeds]).reshape(BANDS, ROWS)
        key = np.zeros(BANDS, np.uint64)
        for i in range(ROWS):
            key = tx.mix(key + least[:, i])
        out.append((key + np.arange(BANDS, dtype=np.uint64)).view(np.int64))
    return pd.Series(out)


def _bands(entries: DataFrame, nodes: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(v, node, n, most, before, counts): bucket keys of the nodes that can be linked through long lists only; and their larger sketches.

    Two such nodes share nothing but values of long lists, so these make up most of their sketches.
    most is the number of a node's shingles, of the full set, that another such node has too:
    no intersection is larger, and nodes with fewer than the threshold asks for are left out. counts
    tells them by the rest of their hash: an intersection is no larger than the sum of the smaller counts either.
    """
    hot = entries.groupBy("node").agg(F.sum((F.col("length") > COLD).cast("int")).alias("hot"))
    hot = hot.join(nodes, "node").filter(F.col("hot") >= HOT_SHARE * F.size("sketch")).select("node", "doc_id", "n", "sketch")
    hot = stored(hot, "near-hot")
    sets = _full_sets(hot.select("node", "doc_id"), docs)
    parts = F.explode(F.pandas_udf(lambda s: s.map(lambda b: np.frombuffer(b, np.int64)), "array<long>")("shingles"))
    parts = stored(sets.select("node", parts.alias("x")), "near-hot-values")
    again = stored(parts.groupBy("x").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("x"), "near-hot-shared")
    counts = F.array(*[F.count_if(F.pmod("x", F.lit(PARTS)) == p).cast("int") for p in range(PARTS)])
    most = parts.join(again, "x").groupBy("node").agg(F.count(F.lit(1)).alias("most"), counts.alias("counts"))
    kept = hot.join(most, "node").filter(f"{THRESHOLD[1]} * most >= {THRESHOLD[0]} * n").select("node", "n", "most", "counts")
    keys, large = F.pandas_udf(_band_keys, "array<long>"), F.pandas_udf(_large_sketch, "array<long>")
    kept = sets.join(kept, "node").select("node", "n", "most", "counts", keys("shingles").alias("keys"), large("shingles").alias("sketch"))
    kept = stored(kept, "near-large")
    out = kept.select("node", "n", "most", "counts", F.posexplode("keys").alias("band", "v"), "keys")
    # Earlier keys as whole numbers of 32 bits: enough to see whether two nodes have met before.
    before = F.transform(F.slice("keys", F.lit(1), F.col("band")), lambda k: F.hash(k))
    out = out.select("v", "node", "n", "most", before.alias("before"), "counts")
    out = stored(out, "near-bands")
    discard(hot, sets, parts, again)
    return out, kept


def _large_sketch(shingles: pd.Series) -> pd.Series:
    return shingles.map(lambda b: tx.ordered(np.frombuffer(b, np.uint64)[:LARGE_K]))


def _different(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (v, node, ...) of keys v that nodes of different components share, with ``label``."""
    rows = stored(rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "near-meeting")
    split = rows.groupBy("v").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("v")
    split = stored(split, "near-split")
    out = stored(rows.join(split, "v"), "near-open")
    discard(rows, split)
    return out


def _crossing(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that share a key v and have sizes and shared parts that allow a link."""
    rows = _different(rows, labels)
    left = rows.select("v", F.col("node").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"), F.col("most").alias("ma"), F.col("before").alias("ea"), F.col("counts").alias("ca"))
    right = rows.select("v", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"), F.col("most").alias("mb"), F.col("before").alias("eb"), F.col("counts").alias("cb"))
    # A pair counts where it meets first; two nodes that share an earlier bucket have met there.
    enough = f"{sum(THRESHOLD)} * least(ma, mb) >= {THRESHOLD[0]} * (na + nb)"
    common = "aggregate(zip_with(ca, cb, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
    enough = f"{enough} and (ca is null or {sum(THRESHOLD)} * {common} >= {THRESHOLD[0]} * (na + nb))"
    return left.join(right, "v").filter(f"la < lb and {_similar_size('na', 'nb')} and {enough} and not arrays_overlap(ea, eb)").select("a", "b").distinct()


def _neighbours(bands: DataFrame, by: Column) -> DataFrame:
    """Pairs (a, b) of a bucket: each node with the first one and with the one before it in order of ``by``.

    x and y are their labels where ``bands`` has any. Buckets are sorted as streams; a salt by size
    splits a bucket of very many nodes into ranges.
    """
    label = F.col("label") if "label" in bands.columns else F.lit(0)
    order = Window.partitionBy("v", (F.log2("n") * 8).cast("int")).orderBy(by, "node")
    one = F.struct(F.col("node").alias("a"), label.alias("x"))
    rows = bands.select("node", label.alias("y"), F.lag(one).over(order).alias("before"), F.first(one).over(order).alias("first"))
    sides = [rows.select(f"{side}.a", F.col("node").alias("b"), f"{side}.x", "y") for side in ("before", "first")]
    return sides[0].union(sides[1]).filter("a <> b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Words are runs of bytes other than space and 0x09 to 0x0D, with A-Z lower-cased; a text with fewer than five words
    is one shingle, one without words (or null) has the empty set and is linked with nothing. Documents with
    Jaccard similarity of at least 0.75 are linked; component_id is the smallest id reachable, itself
    included, and kept says whether it is the row's own. Rows that repeat an id are documents of their own:
    with equal texts they share a component, with different ones they are linked like others.
    A row without id is not linked with others: its component_id is null and it is kept. Other columns are
    ignored; an empty table gives an empty result.
    """
    out = labelled(docs).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, t (key of the text), n_shingles, label and component_id of every row; one label per component, null where a row is not linked with others."""
    signed = stored(signatures(docs), "near-signatures")
    linkable = signed.filter("n_shingles > 0 and doc_id is not null")
    nodes = stored(
        linkable.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "near-nodes"
    )

    values = nodes.select("node", "n", F.posexplode("sketch").alias("pos", "v"))
    lists = stored(values.groupBy("v").agg(F.count(F.lit(1)).alias("length"), F.min(F.struct("node", "n")).alias("hub")).filter("length > 1"), "near-lists")
    entries = stored(values.join(lists, "v").select("v", "node", "n", "pos", "length", "hub"), "near-entries")
    discard(lists)
    hubs = entries.filter(f"pos < {HUB_VALUES} and node <> hub.node and {_similar_size('n', 'hub.n')}").select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
    bands, large = _bands(entries, nodes, docs)
    either = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    likely = _estimated(either(hubs), nodes).union(_estimated(either(_neighbours(bands, F.col("n"))), large, LARGE_K)).distinct()
    links = stored(_verified(likely, nodes, docs), "near-links")
    labels = components(links)

    # Nodes of long lists that are apart so far try other members of their buckets, in random order.
    open_bands = _different(bands, labels)
    near = _neighbours(open_bands, F.xxhash64("node", "v")).filter("x <> y")
    more = stored(_verified(_estimated(either(near), large, LARGE_K), nodes, docs), "near-more")
    discard(open_bands)
    if not more.isEmpty():
        links = stored(links.union(more), "near-links")
        labels = components(links)

    # What is left: links between different components.
    none = F.array().cast("array<int>")
    cold = entries.filter(f"length <= {COLD} and pos < {DEPTH}").select("v", "node", "n", F.col("n").alias("most"), none.alias("before"), F.lit(None).cast("array<int>").alias("counts"))
    crossing = [(_crossing(cold, labels), nodes, K), (_crossing(bands, labels), large, LARGE_K)]
    likely = [_estimated(pairs, sketches, k) for pairs, sketches, k in crossing]
    late = stored(_verified(likely[0].union(likely[1]).distinct(), nodes, docs), "near-late")
    discard(entries, bands, large)
    if not late.isEmpty():
        labels = components(links.union(late))

    grouped = linkable.select("doc_id", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # Documents of one component, and those that share a row id, are joined through the smallest id.
    smallest = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    members = labels.join(smallest, "label").select("node", "component_id", "label")
    alone = nodes.select("node", F.col("doc_id").alias("own_first"))
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    out = signed.join(alone, (signed.node == alone.node) & linked, "left").drop(alone.node)
    out = out.join(members, "node", "left")
    component = F.when(linked, F.coalesce("component_id", "own_first")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "t", "n_shingles", F.when(linked, F.coalesce("label", "node")).alias("label"), component.alias("component_id"))
