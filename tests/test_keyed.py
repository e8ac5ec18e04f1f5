"""Upserts by bucket: what is rewritten, versions, crashes, conflicts."""

import random
from collections import Counter

import pytest

from casebeacon.operators import merge
from casebeacon.sources import keyed

SCHEMA = "case_id string, n int, note string"


def rows(spark, pairs):
    return spark.createDataFrame([(k, n, f"r{n}") for k, n in pairs], SCHEMA)


def updates(spark, triples):
    return spark.createDataFrame([(k, n, f"u{n}", a) for k, n, a in triples], SCHEMA + ", arrival int")


def bag(df):
    return Counter(map(tuple, df.collect()))


def folders(spark, path):
    return keyed.manifest(spark, path)["folders"]


def test_only_touched_buckets_are_rewritten(spark, run_dir):
    keyed.create(rows(spark, [(f"C{i}", i) for i in range(500)]), run_dir, buckets=16)
    before = folders(spark, run_dir)
    assert keyed.upsert(updates(spark, [("C3", -1, 1), ("C3", -2, 2), ("new", 7, 1)]), run_dir) == 1
    after = folders(spark, run_dir)
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2 and len(after) == 16
    table = {r.case_id: (r.n, r.note) for r in keyed.read(spark, run_dir).collect()}
    assert len(table) == 501 and table["C3"] == (-2, "u-2") and table["new"] == (7, "u7") and table["C4"] == (4, "r4")
    assert keyed.read(spark, run_dir, version=0).count() == 500


def test_equals_the_plain_upsert_over_many_batches(spark, run_dir):
    rng = random.Random(1)
    current = rows(spark, [(f"C{i}", i) for i in range(200)] + [(None, 5)])
    keyed.create(current, run_dir, buckets=8)
    for batch in range(4):
        new = updates(spark, [(rng.choice([f"C{rng.randrange(260)}", None, "hot"]), 1000 * batch + i, rng.randrange(50)) for i in range(80)])
        new = new.dropDuplicates(["case_id", "arrival"]).cache()
        current = merge.upsert_cases(current, new).select(*current.columns)
        keyed.upsert(new, run_dir)
        assert bag(keyed.read(spark, run_dir)) == bag(current)


def test_a_crash_before_the_manifest_leaves_the_old_version(spark, run_dir, monkeypatch):
    keyed.create(rows(spark, [(f"C{i}", i) for i in range(50)]), run_dir, buckets=4)
    before = bag(keyed.read(spark, run_dir))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "_commit", crash)
        with pytest.raises(RuntimeError):
            keyed.upsert(updates(spark, [("C1", 99, 1)]), run_dir)
    assert keyed.versions(spark, run_dir) == [0] and bag(keyed.read(spark, run_dir)) == before
    assert keyed.remove_unused(spark, run_dir) == 1 and bag(keyed.read(spark, run_dir)) == before
    assert keyed.upsert(updates(spark, [("C1", 99, 1)]), run_dir) == 1


def test_the_second_of_two_writers_fails(spark, run_dir):
    keyed.create(rows(spark, [("a", 1), ("b", 2)]), run_dir, buckets=4)
    held = keyed.manifest(spark, run_dir)
    keyed.upsert(updates(spark, [("a", 5, 1)]), run_dir)
    with pytest.raises(keyed.Conflict):
        keyed._commit(spark, run_dir, held | {"version": 1})
    with pytest.raises(keyed.Conflict):
        keyed.create(rows(spark, []), run_dir)
    assert {r.case_id: r.n for r in keyed.read(spark, run_dir).collect()} == {"a": 5, "b": 2}


def test_unused_folders_go_and_old_versions_with_them(spark, run_dir):
    keyed.create(rows(spark, [(f"C{i}", i) for i in range(100)]), run_dir, buckets=4)
    for n in range(3):
        keyed.upsert(updates(spark, [(f"C{i}", n, 1) for i in range(100)]), run_dir)
    now = bag(keyed.read(spark, run_dir))
    assert keyed.remove_unused(spark, run_dir, keep=1) == 12
    assert keyed.versions(spark, run_dir) == [3] and bag(keyed.read(spark, run_dir)) == now


def test_few_keys_read_few_buckets(spark, run_dir):
    keyed.create(rows(spark, [(f"C{i}", i) for i in range(300)]), run_dir, buckets=16)
    found = keyed.lookup(spark, run_dir, ["C7", "absent"])
    assert [tuple(r) for r in found.collect()] == [("C7", 7, "r7")]
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 2


def test_empty_tables_and_batches(spark, run_dir):
    keyed.create(rows(spark, []), run_dir, buckets=4)
    assert keyed.read(spark, run_dir).count() == 0
    assert keyed.upsert(updates(spark, []), run_dir) == 0
    assert keyed.upsert(updates(spark, [("a", 1, 1)]), run_dir) == 1
    assert bag(keyed.read(spark, run_dir)) == {("a", 1, "u1"): 1}
