"""Mixing sources to target weights by weighted fair queueing.

Documents wait in one queue per source, shuffled by a seeded hash. Serving a source at the rate of
its target, a document starts at (words before it) / target and finishes at (words up to it) /
target on a common virtual clock. The mix is the queue in the order of virtual finish times, cut
where the budget is used up; a source whose target exceeds its size is queued again for a next pass.
Words are served evenly, so the cut falls inside at most one document of each source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebeacon.llm.tables import stored, unused_name

WEIGHTS = (3, 1, 2)
BUDGET = (150, 100)  # share of all words, as a fraction
REPEATS = 2
BUCKET_ROWS = 50_000


def text_size(text: Column) -> Column:
    """Number of words of a text; a null has none."""
    parts = F.size(F.split(text, r"[\x20\x09-\x0D]+"))
    edges = text.rlike(r"\A[\x20\x09-\x0D]").cast("int") + text.rlike(r"[\x20\x09-\x0D]\z").cast("int")
    return F.when(text.isNull() | (text == ""), 0).otherwise(parts - edges).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Weights repeat along the sources in code point order, null last. The budget is shared by
    weight; a source takes at most ``repeats`` times its size and the excess goes to the others by
    weight. Ordering the sources by (limit / weight) makes the limited ones a prefix: source k is
    limited if its ratio is at most the level that the budget reaches when all before it are limited.
    One row per source passes through the windows, a table that grows with the number of sources only.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * repeats)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    rows = rows.select(
        "*",
        (F.col("most") / F.col("weight")).alias("ratio"),
        (F.sum("source_size").over(whole) * budget[0] / budget[1]).alias("budget"),
        (F.sum("most").over(by_ratio) - F.col("most")).alias("most_before"),
        (F.sum("weight").over(whole) - F.sum("weight").over(by_ratio) + F.col("weight")).alias("weight_left"),
    )
    rows = rows.withColumn("level", (F.col("budget") - F.col("most_before")) / F.col("weight_left"))
    first_free = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", F.col("source").isNull(), "source", "level"))).over(whole)
    rows = rows.withColumn("level", first_free["level"])
    target = F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return rows.select("source", "source_size", target.alias("target"))


def schedule(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET, repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """``docs`` with size, source_size, target, virtual_start, virtual_finish and taken.

    The clock columns are those of the first pass; a later pass adds source_size / target. taken is the number
    of words served before the budget ends, over all passes. A document without words takes
    nothing. Null sources form a queue of their own; null ids and repeated rows are documents like
    others, equal rows in any order among themselves. Columns of ``docs`` named like one of the six are
    replaced, all others stay. A text of any length is one document. An empty table gives an empty schedule.

    The running sums are split: the hash order is cut into buckets of about ``BUCKET_ROWS`` rows,
    the bucket totals of a source are summed in order, and rows are summed inside their bucket, so
    a source with a third of all rows is spread over many tasks.
    """
    replaced = {"size", "source_size", "target", "virtual_start", "virtual_finish", "taken"}
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in replaced])
    place, bucket, tie, within, before, s, b = (unused_name(docs.columns, n) for n in ("place", "bucket", "tie", "within", "before", "s", "b"))
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary"))
    rows = rows.withColumns({"size": text_size(F.col("text")), place: hashed, tie: F.xxhash64("text")})
    # 16 ** digits buckets per source, so that the largest source has about BUCKET_ROWS rows in each.
    largest = docs.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    digits = next(d for d in range(1, 33) if largest <= BUCKET_ROWS * 16**d)
    rows = rows.withColumn(bucket, F.substring(place, 1, digits))
    totals = stored(rows.groupBy("source", F.col(bucket).alias("bucket")).agg(F.sum("size").alias("size")), "mix-totals")
    in_order = Window.partitionBy("source").orderBy("bucket")
    totals_before = totals.select(F.col("source").alias(s), F.col("bucket").alias(b), (F.sum("size").over(in_order) - F.col("size")).alias(before))
    targets = source_targets(totals.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, repeats)
    heads = stored(totals_before.join(targets, F.col(s).eqNullSafe(F.col("source"))).drop("source"), "mix-heads")

    order = Window.partitionBy("source", bucket).orderBy(place, "doc_id", tie).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(within, F.coalesce(F.sum("size").over(order), F.lit(0)))
    rows = rows.join(heads, F.col("source").eqNullSafe(F.col(s)) & (F.col(bucket) == F.col(b)))
    start = F.col(before) + F.col(within)
    clock = lambda words: F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))
    # At virtual time 1 every source has been served its target, and the budget is used up.
    served = F.floor("target").cast("long")
    taken = sum(F.least(F.greatest(served - start - n * F.col("source_size"), F.lit(0)), F.col("size")) for n in range(repeats))
    rows = rows.withColumns({"virtual_start": clock(start), "virtual_finish": clock(start + F.col("size")), "taken": taken.cast("long")})
    return rows.drop(place, bucket, tie, within, before, s, b)


def in_queue_order(scheduled: DataFrame) -> DataFrame:
    """All documents, range-partitioned and sorted by virtual finish time: the queue and what the cut left."""
    return scheduled.repartitionByRange("virtual_finish", "doc_id").sortWithinPartitions("virtual_finish", "doc_id")


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET, repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """The mix itself: one row per served pass, globally sorted by its virtual finish time.

    ``words`` is the number of words served in that pass: all of them but for the documents at the cut.
    """
    rows = schedule(docs, weights, budget, repeats, seed).filter("taken > 0")
    rows = rows.withColumn("pass", F.explode(F.expr("sequence(0L, (taken - 1) div size)")))
    shift = F.col("pass") * F.col("source_size") / F.col("target")
    rows = rows.withColumns({"virtual_start": F.col("virtual_start") + shift, "virtual_finish": F.col("virtual_finish") + shift, "words": F.least("size", F.col("taken") - F.col("pass") * F.col("size"))})
    return in_queue_order(rows)
