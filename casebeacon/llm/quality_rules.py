"""Quality rules as a bitmask ledger, with DataFrame functions only.

``rule_ledger`` measures each text once and stores one bit per failed rule. Policies are versioned
masks over these bits: applying one, or asking what a rule alone removes, never reads a text again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[^#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL condition over the measurements


#: Bit i of the ledger belongs to rule i; add new rules at the end so that stored ledgers stay valid.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words * 3"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("shouting", "2 * n_upper > word_chars"),
    Rule("many_words", "n_words > 100000"),
)
BASE = ("few_words", "repeated_windows")
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines", "short_words", "long_words", "shouting"),
}


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(bits[n] for n in set(names))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _repeated(frame: DataFrame) -> DataFrame:
    """n_repeat_words from ``words``: positions inside three-word windows that occur at least twice.

    Windows with their position are sorted, so equal ones are neighbours; of the positions that
    have an equal neighbour, each covers three words or as many as remain up to the next one.
    """
    frame = frame.withColumn(
        "windows",
        F.when(F.size("words") >= 3, F.expr("transform(slice(words, 1, size(words) - 2), (w, i) -> concat_ws(' ', w, words[i + 1], words[i + 2]))")),
    )
    frame = frame.withColumn(
        "sorted_windows",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.expr("array_sort(transform(windows, (w, i) -> struct(w, i)))")),
    )
    last = "size(sorted_windows) - 1"
    frame = frame.withColumn(
        "places",
        F.expr(
            "array_sort(transform(filter(sorted_windows, (x, j) -> (j > 0 and x.w = sorted_windows[greatest(j - 1, 0)].w)"
            f" or (j < {last} and x.w = sorted_windows[least(j + 1, {last})].w)), x -> x.i))"
        ),
    )
    covered = "aggregate(places, named_struct('n', 0L, 'end', 0), (s, p) -> named_struct('n', s.n + p + 3 - greatest(s.end, p), 'end', p + 3), s -> s.n)"
    return frame.withColumn("n_repeat_words", F.coalesce(F.expr(covered), F.lit(0)).cast("long"))


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    frame = docs.select(F.col("doc_id").cast("long"), text.alias("body"), _words(text).alias("words"))
    frame = _repeated(frame)
    frame = frame.withColumn("lines", F.filter(F.split("body", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return frame.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("body", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("body", SYMBOL, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("body", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
    )


def rule_ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: doc_id, measurements and ``failures``, one bit per failed rule.

    A null text has no words and counts like an empty one: all measurements 0, ``few_words``
    fails. Ids may be null or repeated and are passed on; further columns are ignored. The plan is
    one map without a shuffle, so a hot source or group of copies cannot skew it.
    """
    bits = sum((F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(0) for i, r in enumerate(rules)), F.lit(0))
    return measurements(docs).withColumn("failures", bits.cast("long"))


def apply_policy(ledger: DataFrame, version: str = "v2", policies: Mapping[str, tuple[str, ...]] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with base_failed and kept under one version of the policy."""
    failed = lambda names: F.col("failures").bitwiseAND(F.lit(mask(names, rules))) != 0
    base = tuple(n for n in BASE if n in {r.name for r in rules})
    return ledger.withColumn("base_failed", failed(base)).withColumn("kept", ~failed((*base, *policies[version])))


def ablations(ledger: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """policy, rule, n_failed, n_only, n_kept and any_failures: what each rule removes, and alone.

    The ledger is first counted per bit pattern (at most 2 ** rules of them, combined before the
    shuffle); policies and rules are then evaluated on these few rows with bit operations.
    """
    patterns = ledger.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    cases = [(v, r.name, mask(p, rules), 1 << i) for v, p in policies.items() for i, r in enumerate(rules) if r.name in p]
    unfold = F.explode(F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.lit(m).alias("mask"), F.lit(b).alias("bit")) for v, r, m, b in cases]))
    rows = patterns.select("failures", "n", unfold.alias("c")).select("failures", "n", "c.*")
    hit = F.col("failures").bitwiseAND(F.col("mask"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    return rows.groupBy("policy", "rule").agg(
        total(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(hit == F.col("bit")).alias("n_only"),
        total(hit == 0).alias("n_kept"),
        F.bit_or("failures").alias("any_failures"),
    )
