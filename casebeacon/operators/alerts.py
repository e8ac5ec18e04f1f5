"""Rate-limited outbreak alerts from a sliding count of positives per region.

Regions are few and may be heavy, so neither the count nor the rate limit gives a region to
one task. The time line of each region is cut into slices; work runs per (region, slice), and
only small per-slice results are put in sequence.

Times are handled as whole microseconds. Cases of a region at the same microsecond count
together, which also bounds how many rows a slice can hold after the first aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebeacon.functions import expressions as X
from casebeacon.functions import folds

WINDOW_SECONDS = 60
THRESHOLD = 10
COOLDOWN_SECONDS = 30

# Default lengths of a slice: in windows when counting, in cooldowns when rate-limiting. Longer
# slices leave less to put in sequence, shorter ones give more parallel work.
WINDOWS_PER_SLICE = 10
COOLDOWNS_PER_SLICE = 64

# Slices whose summaries are composed into one, in one task.
SLICES_PER_BLOCK = 4096

_MICROS = 1_000_000


def rolling_positive_count(
    cases: DataFrame,
    *,
    window_seconds: int = WINDOW_SECONDS,
    slice_seconds: int | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Positives of a region in the window up to each moment with a case, both edges included.

    Cases without a region or a time cannot be placed and stay out; cleaning removes the former.
    A positive adds one when it arrives and takes it back one microsecond after the window has
    passed. The count is the running sum of these changes: what was open when the slice
    began plus the changes inside the slice.
    """
    moments = (
        cases.where(F.col(ts).isNotNull() & F.col("region_id").isNotNull())
        .select("region_id", F.unix_micros(F.col(ts).cast("timestamp")).alias("at"), X.positive_flag().alias("p"))
        .groupBy("region_id", "at")
        .agg(F.count("*").alias("cases"), F.sum("p").alias("positives"))
    )
    counts = rolling_moments(moments, window_seconds=window_seconds, slice_seconds=slice_seconds)
    time = F.timestamp_micros("at").cast(cases.schema[ts].dataType).alias("ts")
    return counts.select("region_id", time, "cases", "positives", "positives_in_window", "at")


def rolling_moments(moments: DataFrame, *, window_seconds: int = WINDOW_SECONDS, slice_seconds: int | None = None) -> DataFrame:
    """`rolling_positive_count` of moments: region_id, at (microseconds, once per region), cases and positives."""
    window = window_seconds * _MICROS
    slice_length = (slice_seconds or WINDOWS_PER_SLICE * window_seconds) * _MICROS
    arrive = F.struct("at", "cases", "positives", F.col("positives").alias("change"))
    expire = F.struct(
        (F.col("at") + window + 1).alias("at"),
        F.lit(0).cast("bigint").alias("cases"),
        F.lit(0).cast("bigint").alias("positives"),
        (-F.col("positives")).alias("change"),
    )
    changes = (
        moments.select(
            "region_id",
            F.inline(F.when(F.col("positives") > 0, F.array(arrive, expire)).otherwise(F.array(arrive))),
        )
        .withColumn("slice", _slice("at", slice_length))
    )

    # The filter is always true. It keeps `cases` in use, so both readers of `moments` have the
    # same plan up to its shuffle and Spark computes that shuffle once.
    per_slice = (
        changes.groupBy("region_id", "slice")
        .agg(F.sum("change").alias("net"), F.sum("cases").alias("cases"), F.sum("positives").alias("positives"))
        .where("cases >= positives")
    )
    earlier = Window.partitionBy("region_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    opening = per_slice.select(
        "region_id",
        (F.col("slice") * slice_length - 1).alias("at"),
        F.lit(0).cast("bigint").alias("cases"),
        F.lit(0).cast("bigint").alias("positives"),
        F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("change"),
        "slice",
    )
    running = Window.partitionBy("region_id", "slice").orderBy("at")
    return (
        changes.unionByName(opening)
        .withColumn("positives_in_window", F.sum("change").over(running))
        .where("cases > 0")
        .select("region_id", "cases", "positives", "positives_in_window", "at")
    )


def alert_cooldown(
    candidates: DataFrame,
    *,
    cooldown_seconds: int = COOLDOWN_SECONDS,
    slice_seconds: int | None = None,
    slices_per_block: int = SLICES_PER_BLOCK,
) -> DataFrame:
    """Keeps a candidate only if it is strictly later than the last kept one plus the cooldown.

    ``candidates`` has ``region_id``, ``at`` (microseconds, unique per region) and
    ``positives_in_window``. The alert before a stretch of time decides the last one in it by a step
    function, and step functions compose, so no region is followed from end to end in one task:

    1. per (region, slice): the step function of the slice;
    2. per (region, block of slices): those of its slices composed into one;
    3. per region, over blocks only: the alert each block starts from. A century has about 400 blocks
       of the default length, however many candidates;
    4. per (region, block): the alert each slice starts from;
    5. per (region, slice): the alerts themselves.

    Each step reads its rows as a sorted stream and holds no group in memory. Steps 1 and 5
    read the output of a window function: it is grouped by (region, slice) and sorted, and
    ``position`` 1 marks where a group begins.
    """
    cooldown = cooldown_seconds * _MICROS
    slice_length = (slice_seconds or COOLDOWNS_PER_SLICE * cooldown_seconds) * _MICROS

    # The join below implies that its keys are not null. Saying so here keeps both readers of
    # `ordered` the same, and Spark shuffles the candidates once.
    position = F.row_number().over(Window.partitionBy("region_id", "slice").orderBy("at"))
    ordered = (
        candidates.select("region_id", _slice("at", slice_length).alias("slice"), "at", "positives_in_window")
        .where("region_id IS NOT NULL AND slice IS NOT NULL")
        .withColumn("position", position)
    )

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bool]]:
        """Stretches of one group within a batch: from, to, and whether the group begins here."""
        begins = np.flatnonzero(batch.column("position").to_numpy() == 1)
        cuts = [0, *(int(i) for i in begins if i > 0), batch.num_rows]
        first = set(begins.tolist())
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield start, end, start in first

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region = span = follower = None

        def summary() -> pa.RecordBatch:
            first_upto, last = follower.exits()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([region] * len(last), pa.string()),
                    pa.array([span] * len(last), pa.int64()),
                    pa.array(first_upto, pa.int64()),
                    pa.array(last, pa.int64()),
                ],
                ["region_id", "slice", "first_upto", "last"],
            )

        for batch in batches:
            times = batch.column("at").to_numpy()
            for start, end, begins in groups(batch):
                if begins:
                    if follower is not None:
                        yield summary()
                    region = batch.column("region_id")[start].as_py()
                    span = batch.column("slice")[start].as_py()
                    follower = folds.SpanFollower(span * slice_length, cooldown)
                follower.feed(times[start:end])
        if follower is not None:
            yield summary()

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region = block = span = steps = None
        first_upto, last = [], []

        def summary() -> pa.RecordBatch:
            steps.then(np.array(first_upto, np.int64), np.array(last, np.int64))
            size = len(steps.last)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([region] * size, pa.string()),
                    pa.array([block] * size, pa.int64()),
                    pa.array(steps.first_upto, pa.int64()),
                    pa.array(steps.last, pa.int64()),
                ],
                ["region_id", "block", "first_upto", "last"],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("region_id", "block", "slice", "first_upto", "last"))
            for row_region, row_block, row_span, row_first, row_last in zip(*columns):
                if steps is None or (row_region, row_block) != (region, block):
                    if steps is not None:
                        yield summary()
                    region, block, span = row_region, row_block, row_span
                    steps = folds.Steps(block * slices_per_block * slice_length, cooldown)
                    first_upto, last = [], []
                elif row_span != span:
                    steps.then(np.array(first_upto, np.int64), np.array(last, np.int64))
                    span, first_upto, last = row_span, [], []
                first_upto.append(row_first)
                last.append(row_last)
        if steps is not None:
            yield summary()

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The alert before each ``inner`` stretch of an ``outer`` one, whose own comes with its rows."""
        region = outer = inner = leaving = None
        decided = started = False
        for batch in batches:
            regions, inners, carried = [], [], []
            columns = (batch.column(i).to_pylist() for i in range(6))
            for row_region, row_outer, row_inner, first_upto, last, before in zip(*columns):
                if not started or (row_region, row_outer) != (region, outer):
                    region, outer, inner, leaving, started = row_region, row_outer, None, before, True
                if row_inner != inner:
                    inner, entering, decided = row_inner, leaving, False
                    regions.append(region)
                    inners.append(inner)
                    carried.append(entering)
                if not decided and (entering is None or first_upto > entering + cooldown):
                    leaving, decided = last, True
            yield pa.RecordBatch.from_arrays(
                [pa.array(regions, pa.string()), pa.array(inners, pa.int64()), pa.array(carried, pa.int64())],
                ["region_id", "inner", "entering"],
            )

    def select_kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            times = batch.column("at").to_numpy()
            kept = []
            for start, end, begins in groups(batch):
                if begins:
                    last = batch.column("entering")[start].as_py()
                here = folds.kept_positions(times[start:end], cooldown, last)
                if here:
                    last = int(times[start + here[-1]])
                    kept.extend(start + i for i in here)
            yield batch.select(["region_id", "at", "positives_in_window"]).take(pa.array(kept, pa.int64()))

    # As above: both readers of the summaries share one shuffle.
    summaries = (
        ordered.mapInArrow(summarise, "region_id string, slice bigint, first_upto bigint, last bigint")
        .withColumn("block", _slice("slice", slices_per_block))
        .where("region_id IS NOT NULL AND block IS NOT NULL")
        .repartition("region_id", "block")
    )
    blocks = (
        summaries.sortWithinPartitions("region_id", "block", "slice", "first_upto")
        .mapInArrow(compose, "region_id string, block bigint, first_upto bigint, last bigint")
    )
    followed = "region_id string, inner bigint, entering bigint"
    block_starts = (
        blocks.select("region_id", F.lit(0).cast("bigint"), "block", "first_upto", "last", F.lit(None).cast("bigint"))
        .repartition("region_id")
        .sortWithinPartitions("region_id", "block", "first_upto")
        .mapInArrow(follow, followed)
        .withColumnRenamed("inner", "block")
    )
    starts = (
        summaries.join(block_starts, ["region_id", "block"])
        .select("region_id", "block", "slice", "first_upto", "last", "entering")
        .sortWithinPartitions("region_id", "block", "slice", "first_upto")
        .mapInArrow(follow, followed)
        .withColumnRenamed("inner", "slice")
    )
    # The join keeps the grouping of its left side; the sort is dropped where it changes nothing.
    return (
        ordered.join(starts, ["region_id", "slice"])
        .sortWithinPartitions("region_id", "slice", "at")
        .mapInArrow(select_kept, "region_id string, at bigint, positives_in_window bigint")
    )


def outbreak_alerts(
    cases: DataFrame,
    *,
    window_seconds: int = WINDOW_SECONDS,
    threshold: int = THRESHOLD,
    cooldown_seconds: int = COOLDOWN_SECONDS,
    ts: str = "timestamp",
) -> DataFrame:
    """Alerts of each region: enough positives in the window, and none too soon after another.

    Every case is a moment at which the rule is checked, negative ones included.
    """
    counts = rolling_positive_count(cases, window_seconds=window_seconds, ts=ts)
    candidates = counts.where(F.col("positives_in_window") >= threshold)
    kept = alert_cooldown(candidates, cooldown_seconds=cooldown_seconds)
    return kept.select(
        "region_id", F.timestamp_micros("at").cast(cases.schema[ts].dataType).alias("ts"), "positives_in_window"
    )


def in_key_order(cases: DataFrame, *, slice_seconds: int = 3600, ts: str = "timestamp") -> DataFrame:
    """A region's cases of one slice of time together and in order, spread over all slices.

    Ids decide between equal times; cases without a time form a slice of their own, null.
    """
    at = cases.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    return (
        at.withColumn("slice", _slice("_at", slice_seconds * _MICROS))
        .repartition("region_id", "slice")
        .sortWithinPartitions("region_id", "slice", "_at", "case_id")
        .drop("_at")
    )


def format_alert(
    alerts: DataFrame, window_seconds: int = WINDOW_SECONDS, instance: str | None = None
) -> DataFrame:
    """One log line per alert."""
    text = F.format_string(
        "%s [ALERT] %s: %d positive cases in the last %ds" + ("" if instance is None else " (instance %s)"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.col("region_id"),
        F.col("positives_in_window"),
        F.lit(window_seconds),
        *([] if instance is None else [F.lit(instance)]),
    )
    return alerts.select("region_id", "ts", text.alias("line"))


def _slice(at: str, length: int) -> Column:
    # Whole-number floor division that also holds for times before 1970.
    return F.expr(f"({at} - pmod({at}, {length}L)) div {length}L")
