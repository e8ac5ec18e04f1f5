"""URL filters with dated lists.

A list is a log of dated entries: a value was added to it or removed from it. The log becomes
validity intervals, and every capture is judged by the entries that were active when it was
fetched: an as-of join on the lookup keys of its URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebeacon.llm.tables import stored


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, value, since, until, removed) from a log (list, kind, value, action, at).

    action is ``add`` or ``remove``; of entries with the same key and time a removal wins. An
    entry holds from its time (included) until the next one of its key (excluded; null: still holds).
    Entries without list, kind, value or time have no effect.
    """
    log = entries.filter("list is not null and kind is not null and value is not null and at is not null and action in ('add', 'remove')")
    log = log.groupBy("list", "kind", "value", "at").agg(F.max(F.col("action") == "remove").alias("removed"))
    key = Window.partitionBy("list", "kind", "value").orderBy("at")
    return log.select("list", "kind", "value", F.col("at").alias("since"), F.lead("at").over(key).alias("until"), "removed").filter("not removed")


def url_host(url: Column) -> Column:
    """Lower-case host without user, port, trailing dot or leading ``www.``; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@\[\]]+)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"\.+$", ""), r"^www\.", "")
    return F.when(host != "", host)


def url_path(url: Column) -> Column:
    """Path without query and fragment; ``/`` where it is empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def lookup_keys(url: Column) -> Column:
    """Array of (kind, value): the host, each domain above it, and each folder of the path.

    Its length follows the URL's own length, however many labels or folders that has; a null or unreadable URL
    has no keys.
    """
    host, path = url_host(url), url_path(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value")),
    )
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    folders = F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")).alias("value")),
        ),
    ).otherwise(F.array().cast("array<struct<kind:string,value:string>>"))
    exact = F.array(F.struct(F.lit("host").alias("kind"), host.alias("value")))
    return F.when(host.isNull(), F.array().cast("array<struct<kind:string,value:string>>")).otherwise(F.array_distinct(F.concat(exact, domains, folders)))


def filter_captures(captures: DataFrame, entries: DataFrame, allow: tuple[str, ...] = ("allow",), id_column: str = "page_id") -> DataFrame:
    """id, host, n_entries, lists and blocked of every capture (id, url, fetched_at).

    n_entries counts the entries active at fetch time that match, lists names their lists in order;
    a capture is blocked if a list outside ``allow`` matches and none of ``allow`` does. A capture
    without URL or host, or without fetch time, matches nothing and passes. Repeated rows and null
    ids stay rows of their own; further columns are ignored; both tables may be empty.

    Captures are first reduced to their different (url, time) pairs and these to lookup keys; the join
    is on the key, with the interval as its condition. The intervals are a written table, so the
    keys of a very frequent host are a join side that Spark can split, and the counts per pair are combined
    before their shuffle.
    """
    valid = stored(intervals(entries), "list-intervals")
    rows = captures.select(F.col(id_column).alias("id"), F.col("url").alias("url"), F.col("fetched_at").alias("fetched_at"))
    pairs = rows.filter("url is not null and fetched_at is not null").distinct()
    keys = pairs.select("url", "fetched_at", F.explode(lookup_keys(F.col("url"))).alias("k")).select("url", "fetched_at", "k.kind", "k.value")
    active = (F.col("since") <= F.col("fetched_at")) & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until")))
    hits = keys.join(valid, ["kind", "value"]).filter(active)
    verdicts = hits.groupBy("url", "fetched_at").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.array_sort(F.collect_set("list")).alias("lists"),
        F.max(F.col("list").isin(*allow)).alias("allowed"),
        F.max(~F.col("list").isin(*allow)).alias("listed"),
    )
    verdicts = stored(verdicts, "list-verdicts")
    out = rows.join(verdicts, ["url", "fetched_at"], "left")
    return out.select(
        F.col("id").alias(id_column),
        url_host(F.col("url")).alias("host"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce(F.array_join("lists", ","), F.lit("")).alias("lists"),
        F.coalesce(F.col("listed") & ~F.col("allowed"), F.lit(False)).alias("blocked"),
    )
