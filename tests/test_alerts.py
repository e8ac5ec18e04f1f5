"""Rolling counts and rate-limited alerts against a message-by-message model."""

import datetime as dt
from collections import defaultdict, deque

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebeacon.functions import folds
from casebeacon.operators import alerts

START = dt.datetime(2024, 1, 1)
SCHEMA = "region_id string, timestamp timestamp_ntz, rapid_test_result string"


def frame(spark, rows):
    """Rows of (region, seconds, positive)."""
    return spark.createDataFrame(
        [(r, START + dt.timedelta(seconds=s), "positive" if p else "negative") for r, s, p in rows], SCHEMA
    )


def model(rows, window, threshold, cooldown):
    """The rule as a consumer would apply it, peers at one moment taken together."""
    moments = defaultdict(lambda: defaultdict(int))
    for region, second, positive in rows:
        moments[region][second] += int(positive)
    counts, fired = {}, []
    for region, series in moments.items():
        recent, last = deque(), None
        for second in sorted(series):
            recent.extend([second] * series[second])
            while recent and second - recent[0] > window:
                recent.popleft()
            counts[region, second] = len(recent)
            if len(recent) >= threshold and (last is None or second - last > cooldown):
                last = second
                fired.append((region, second, len(recent)))
    return counts, sorted(fired)


def seconds(value):
    return round((value - START).total_seconds(), 6)


def result(df):
    return sorted((r["region_id"], seconds(r["ts"]), r["positives_in_window"]) for r in df.collect())


def test_boundaries(spark):
    rows = [("N", s, True) for s in range(10)] + [("N", 45, False), ("N", 60, True)]
    counts = alerts.rolling_positive_count(frame(spark, rows))
    by_second = {seconds(r["ts"]): r["positives_in_window"] for r in counts.collect()}
    assert by_second[9] == 10 and by_second[45] == 10
    assert by_second[60] == 11, "an age of exactly the window still counts"
    assert result(alerts.outbreak_alerts(frame(spark, rows))) == [("N", 9, 10), ("N", 45, 10)]


def test_cooldown_is_strict(spark):
    rows = [("N", s, True) for s in range(10)] + [("N", 39, True), ("N", 40, True)]
    assert [r[1] for r in result(alerts.outbreak_alerts(frame(spark, rows)))] == [9, 40]


def test_rows_without_time_stay_out(spark):
    df = frame(spark, [("N", s, True) for s in range(10)]).unionByName(
        spark.createDataFrame([("N", None, "positive")], SCHEMA)
    )
    assert len(result(alerts.outbreak_alerts(df))) == 1


def test_no_rows(spark):
    assert alerts.outbreak_alerts(frame(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("slice_seconds", [7, 20, 60, 4000])
def test_matches_model_for_any_slice(spark, slice_seconds):
    rng = np.random.default_rng(slice_seconds)
    rows = [
        (str(rng.choice(["N", "S", "E"], p=[0.8, 0.15, 0.05])), int(rng.integers(-200, 1800)), bool(rng.random() < 0.6))
        for _ in range(1500)
    ]
    counts, fired = model(rows, 60, 10, 30)
    rolled = alerts.rolling_positive_count(frame(spark, rows), slice_seconds=slice_seconds)
    assert {(r, s): n for r, s, n in result(rolled)} == counts
    kept = alerts.alert_cooldown(rolled.where("positives_in_window >= 10"), slice_seconds=slice_seconds, slices_per_block=3)
    got = kept.select("region_id", F.timestamp_micros("at").cast("timestamp_ntz").alias("ts"), "positives_in_window")
    assert result(got) == fired
    assert result(alerts.outbreak_alerts(frame(spark, rows))) == fired


def test_alerts_keep_their_distance(spark, sf_dir):
    from casebeacon.plans import views

    fired = alerts.outbreak_alerts(views.cases(spark, sf_dir), window_seconds=43200, cooldown_seconds=21600, ts="ts")
    by_region = defaultdict(list)
    for region, second, n in result(fired):
        assert n >= alerts.THRESHOLD
        by_region[region].append(second)
    assert by_region
    for times in by_region.values():
        assert all(b - a > 21600 for a, b in zip(times, times[1:]))


times_in_spans = st.lists(st.integers(-50, 400), min_size=1, max_size=80, unique=True)


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(
    times_in_spans,
    st.integers(0, 40),
    st.integers(1, 90),
    st.one_of(st.none(), st.integers(1, 60)),
    st.integers(1, 8),
    st.integers(1, 20),
)
def test_span_summaries_lead_to_the_same_chain(times, cooldown, length, gap, parts, block):
    """Following span by span gives the chain of the whole line."""
    line = np.array(sorted(times))
    before = None if gap is None else int(line[0]) // length * length - gap
    whole = [int(line[i]) for i in folds.kept_positions(line, cooldown, before)]
    last, chained = before, []
    for span in sorted({t // length for t in times}):
        inside = line[line // length == span]
        follower = folds.SpanFollower(span * length, cooldown)
        follower.BLOCK = block
        for part in np.array_split(inside, parts):
            follower.feed(part)
        upto, exits = follower.exits()
        chained += [int(inside[i]) for i in folds.kept_positions(inside, cooldown, last)]
        for first, leave in zip(upto, exits):
            if last is None or first > last + cooldown:
                last = int(leave)
                break
        assert last == (chained[-1] if chained else before)
    assert chained == whole


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(times_in_spans, st.integers(0, 40), st.integers(1, 60), st.one_of(st.none(), st.integers(1, 60)), st.integers(1, 6))
def test_composed_spans_lead_to_the_same_last_alert(times, cooldown, length, gap, size):
    """The steps of a block of spans, composed, tell the block's last alert for any alert before it."""
    line = np.array(sorted(times))
    last = None if gap is None else int(line[0]) // (length * size) * length * size - gap
    for block in sorted({t // (length * size) for t in times}):
        inside = line[line // (length * size) == block]
        steps = folds.Steps(block * size * length, cooldown)
        for span in sorted({int(t) // length for t in inside}):
            follower = folds.SpanFollower(span * length, cooldown)
            follower.feed(inside[inside // length == span])
            steps.then(*follower.exits())
        assert (steps.first_upto[:-1] < steps.first_upto[1:]).all()
        kept = folds.kept_positions(inside, cooldown, last)
        want = int(inside[kept[-1]]) if kept else last
        last = next((int(e) for f, e in zip(steps.first_upto, steps.last) if last is None or f > last + cooldown), last)
        assert last == want


def test_one_region_is_spread_by_blocks(spark):
    """A region of 100,000 slices: tasks share its blocks, summaries are shuffled once, the chain is the whole one's."""
    apart, cooldown = 7, 10
    many = spark.range(300_000).select(F.lit("N").alias("region_id"), (F.col("id") * apart * 1_000_000).alias("at"), F.lit(10).cast("long").alias("positives_in_window"))
    kept = alerts.alert_cooldown(many, cooldown_seconds=cooldown, slice_seconds=21, slices_per_block=256)
    assert "ReusedExchange [region_id" in _final_plan(kept)
    row = kept.agg(F.count("*"), F.min("at"), F.max("at"), F.sum(F.col("at") / 1_000_000 % (2 * apart))).first()
    assert tuple(row) == (150_000, 0, 149_999 * 2 * apart * 1_000_000, 0.0)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 100), st.integers(1, 5)), max_size=40),
    st.lists(st.integers(0, 100), min_size=1, max_size=20),
    st.integers(0, 30),
)
def test_rolling_sums(amounts, at, length):
    amounts = sorted(amounts)
    times = np.array([t for t, _ in amounts], np.int64)
    values = np.array([a for _, a in amounts], np.int64)
    got = folds.rolling_sums(times, values, np.array(at), length)
    assert list(got) == [sum(a for t, a in amounts if m - length <= t <= m) for m in at]


def test_line_format(spark):
    df = spark.createDataFrame([("N", START, 12)], "region_id string, ts timestamp_ntz, positives_in_window bigint")
    assert alerts.format_alert(df).first()["line"] == (
        "2024-01-01 00:00:00 [ALERT] N: 12 positive cases in the last 60s"
    )
    assert alerts.format_alert(df, 60, "A").first()["line"].endswith("last 60s (instance A)")


def test_key_order(spark, sf_dir):
    from casebeacon.plans import views

    ordered = alerts.in_key_order(views.cases(spark, sf_dir), slice_seconds=86400, ts="ts")
    seen = ordered.select(F.spark_partition_id().alias("p"), "region_id", "slice", "ts").collect()
    places = defaultdict(set)
    previous = {}
    for row in seen:
        key = (row["region_id"], row["slice"])
        places[key].add(row["p"])
        assert key not in previous or previous[key] <= row["ts"]
        previous[key] = row["ts"]
    assert all(len(p) == 1 for p in places.values())
