import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from helpers import SCHEMA, corpus, edited, frame, lower, prose, words
from pyspark.sql import functions as F

from casebeacon.llm import minhash_dedup, substring_dedup, suffix_dedup, tables
from casebeacon.llm import text as tx
from casebeacon.llm.tables import components


def shingle_set(text):
    w = words(lower(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def component_ids(rows):
    """Smallest id per row index, by comparing all pairs."""
    sets, label = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    return [rows[i][0] if rows[i][0] is None else min(d for d in groups[root(i)] if d is not None) for i in range(len(rows))], sets


def check_near(spark, rows):
    want, sets = component_ids(rows)
    got = minhash_dedup.near_duplicates(frame(spark, rows).withColumnRenamed("lang", "Node")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(
        (d, len(s), c, d is None or d == c) for (d, _), c, s in zip(rows, want, sets, strict=True)
    )


def test_near_duplicates_equal_all_pairs(spark):
    check_near(spark, list(corpus().items()))


def test_near_duplicates_repeated_rows_and_null_ids(spark):
    rng = random.Random(3)
    a, b = prose(rng, 60), prose(rng, 60)
    check_near(spark, [(1, a), (1, a), (2, b), (3, edited(rng, b, 60)), (None, a), (None, None), (7, None), (8, ""), (9, "x"), (10, "X")])


def test_near_duplicates_of_large_groups_and_common_passages(spark, monkeypatch):
    """Lists longer than COLD, from near copies and from a passage that different texts share."""
    monkeypatch.setattr(minhash_dedup, "COLD", 4)
    rng = random.Random(4)
    base, passage = prose(rng, 120, 10**6), prose(rng, 30, 10**6)
    rows = [(i, edited(rng, base, 30 + i % 60)) for i in range(40)]
    rows += [(100 + i, passage + " " + prose(rng, 60, 10**6)) for i in range(40)]
    rows += [(200 + i, edited(rng, t, 70)) for i, (_, t) in enumerate(rows[40:60])]
    check_near(spark, rows)


def test_near_duplicates_of_shortened_copies_in_long_lists(spark, monkeypatch):
    """Only buckets can link the pairs: a text and its first three quarters, with similarity 0.75."""
    monkeypatch.setattr(minhash_dedup, "COLD", 1)
    monkeypatch.setattr(minhash_dedup, "HUB_VALUES", 0)
    rng, rows = random.Random(5), []
    for i in range(300):
        text = prose(rng, 404, 10**6)
        rows += [(2 * i, text), (2 * i + 1, " ".join(text.split(" ")[:304]))]
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert [d for d, c in got.items() if c != d - d % 2] == []


def test_near_duplicates_of_nothing(spark):
    assert minhash_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_follow_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def cut_by_hand(texts, length):
    counts = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        hit = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                hit[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, hit, strict=True) if not y)
        runs = sum(1 for i in range(len(b)) if hit[i] and (i == 0 or not hit[i - 1]))
        out.append((len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [200, 33, 2])
def test_suffix_dedup_equals_all_positions(spark, length):
    rng = random.Random(5)
    rows = list(corpus(2).items()) if length == 200 else [(i, "".join(rng.choice("abé ") for _ in range(rng.randrange(90)))) for i in range(40)]
    rows += [(900, "a" * 900), (901, "ab" * 300 + "c"), (902, "a" * 150), (None, "ab" * 300), (None, None), (900, "a" * 900)]
    got = suffix_dedup.remove_repeats(frame(spark, rows).withColumnRenamed("lang", "t"), length).collect()
    want = cut_by_hand([(t or "").encode() for _, t in rows], length)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter((d, *w) for (d, _), w in zip(rows, want, strict=True))
    for r in got:
        assert sum(s["to"] - s["from"] for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans


def test_suffix_dedup_of_long_texts_in_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    monkeypatch.setattr(tx, "BLOCK", 1000)
    rng = random.Random(6)
    shared = prose(rng, 500)
    rows = [(1, prose(rng, 90) + shared), (2, shared[:2500] + prose(rng, 300)), (3, prose(rng, 30))]
    # Workers import the module anew, so the segments are tried in this process.
    data = [t.encode() for _, t in rows]
    for b in data[:2]:
        whole = np.frombuffer(b, np.uint8)
        starts = []
        for _, shift, part, offsets in suffix_dedup._pieces(whole, np.array([0, len(whole)]), 200):
            _, start, n, _, _ = suffix_dedup._runs(part, offsets, 200)
            starts += [shift + s + i for s, k in zip(start, n, strict=True) for i in range(k)]
        assert starts == list(range(len(b) - 199))


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_compact_windows_are_tree_nodes():
    rng = np.random.default_rng(1)
    tokens, valid = rng.integers(1, 40, 300).astype(np.uint64), np.ones(300, bool)
    valid[[50, 51, 200]] = False
    value = tx.mix(tokens ^ np.uint64(12345))
    for least in (1, 5, 30):
        left, centre, right, _ = substring_dedup.compact_windows(tokens, valid, least, np.uint64(12345))
        want = set()
        for i in np.flatnonzero(valid):
            a = b = i
            while a and valid[a - 1] and value[a - 1] > value[i]:
                a -= 1
            while b < 299 and valid[b + 1] and value[b + 1] >= value[i]:
                b += 1
            if b - a + 1 >= least:
                want.add((a, i, b))
        assert set(zip(left, centre, right, strict=True)) == want


def test_passages_cover_repeated_windows(spark):
    """Every run of 50 words that occurs in two documents is inside the spans, and such documents share a class."""
    texts = corpus(7)
    got = {r.doc_id: r for r in substring_dedup.near_duplicate_passages(frame(spark, texts).withColumnRenamed("lang", "key")).collect()}
    places, low = {}, {d: words(lower(t or "")) for d, t in texts.items()}
    for d, w in low.items():
        for i in range(len(w) - 49):
            places.setdefault(tuple(w[i : i + 50]), set()).add((d, i))
    for spots in places.values():
        if len({d for d, _ in spots}) > 1:
            assert len({got[d].class_id for d, _ in spots}) == 1
            for d, i in spots:
                assert any(s["from"] <= i and i + 50 <= s["to"] for s in got[d].spans)
    for d, r in got.items():
        assert r.n_words == len(low[d]) and r.n_spans == len(r.spans) and r.n_dup_words == sum(s["to"] - s["from"] for s in r.spans)
        if r.n_spans == 0:
            assert r.class_id == d
    assert {d for d, r in got.items() if r.n_spans} >= {300, 301, 302, 303, 304, 305, 500, 501}
    assert not any(got[d].n_spans for d in range(20, 30) if len(low[d]) < 50)


def test_passages_inside_a_component_whose_list_heads_lack_them(spark):
    rng, texts, want = random.Random(11), {}, {}
    own = lambda n: prose(rng, n, 10**6)
    for group in range(0, 600, 100):
        licence, one, two = own(80), own(30), own(30)
        for i in range(2):
            texts[group + i] = " ".join([own(40), licence, own(1500), one, two, own(40)])
            want[group + i] = [(40, 120), (1620, 1680)]
        texts |= {group + 10 + i: " ".join([own(50), line, own(50)]) for i, line in enumerate([one, two] * 7)}
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup.near_duplicate_passages(frame(spark, texts)).collect()}
    # The ends of a passage are those of its windows, which can stop a few words short.
    assert {d: len(s) for d, s in got.items() if s} == {d: len(s) for d, s in want.items()}
    assert all(x <= a <= x + 4 and y - 4 <= b <= y for d in want for (a, b), (x, y) in zip(got[d], want[d], strict=True))


def test_passages_in_long_lists_that_end_with_the_text(spark):
    """All windows of the pairs lie in lists of a common line; the passage has no second centre after it."""
    rng = random.Random(21)
    own = lambda n: prose(rng, n, 10**6)
    line, rows = own(30), [(-1, own(60))]
    rows += [(1000 + i, own(40) + " " + line + " " + own(40)) for i in range(40)]
    for i in range(0, 60, 2):
        rest = own(22)
        rows += [(i, own(60) + " " + rest + " " + line), (i + 1, own(70) + " " + rest + " " + line)]
    got = {r.doc_id: r for r in substring_dedup.near_duplicate_passages(frame(spark, rows)).collect()}
    assert [i for i in range(60) if got[i].class_id != i - i % 2 or got[i].n_spans != 1] == []
    assert not any(got[1000 + i].n_spans for i in range(40))


def test_passages_of_common_lines_only(spark, monkeypatch):
    """Different texts made of the same common words around: only windows full of common tokens are compared."""
    monkeypatch.setattr(substring_dedup, "COLD", 2)
    rng = random.Random(22)
    own = lambda n: prose(rng, n, 10**6)
    lines = [own(70) for _ in range(3)]
    rows = [(10 * n + i, " ".join([own(50 + i), line, own(55)])) for n, line in enumerate(lines) for i in range(6)]
    rows += [(100, lines[0] + " " + own(200) + " " + lines[1]), (101, " ".join(line[: len(line) // 3] for line in lines))]
    got = {r.doc_id: r for r in substring_dedup.near_duplicate_passages(frame(spark, rows)).collect()}
    assert {d: r.class_id for d, r in got.items()} == {d: 20 if 20 <= d < 26 else 101 if d == 101 else 0 for d in got}


def test_passages_leave_no_tables_and_hand_a_text_to_python_once(spark, monkeypatch):
    """Disk holds what a later step reads; surroundings are written for one window of each kind, and texts aren't repeated."""
    monkeypatch.setattr(substring_dedup, "COLD", 2)
    monkeypatch.setattr(substring_dedup, "SLICE_ROWS", 50)
    monkeypatch.setattr(substring_dedup, "SLICE_PAIRS", 2)
    given, real, handed, paired = [], substring_dedup.stored, [], substring_dedup._with_texts

    def recorded(df, label, *settings, **more):
        given.append((label, real(df, label, *settings, **more)))
        return given[-1][1]

    def counted(windows, bodies, work, more):
        handed.append((windows.count(), windows.select("t").distinct().count(), bodies.count()))
        return paired(windows, bodies, work, more)

    monkeypatch.setattr(substring_dedup, "stored", recorded)
    monkeypatch.setattr(substring_dedup, "_with_texts", counted)
    rng = random.Random(23)
    own = lambda n: prose(rng, n, 10**6)
    line, copied = own(20), own(90)
    rows = [(i, own(40) + " " + line + " " + own(40)) for i in range(12)] + [(20 + i, own(30) + " " + copied + " " + line) for i in range(4)]
    passages, labels = substring_dedup.passage_links(frame(spark, rows))
    assert {r.label for r in labels.collect()} and labels.count() == 4
    assert {label for label, table in given if os.path.exists(table.stored_at)} <= {"passages"}
    written = {label: table.columns for label, table in given}
    assert [label for label, columns in written.items() if "near" in columns] == ["passage-near"]
    (all_windows, texts, bodies), (firsts, _, _) = handed
    slices = [label for label, _ in given].count("passage-tokens")
    assert slices == min(substring_dedup.SLICES, 1 + firsts // 50) > 1
    assert texts == bodies < all_windows and firsts <= all_windows


def test_a_text_that_repeats_a_line_has_one_row_per_list(spark, monkeypatch):
    """Its many windows with one key are one row where lists are made and where members are paired."""
    monkeypatch.setattr(substring_dedup, "COLD", 4)
    real, rows_of = substring_dedup.stored, {}

    def recorded(df, label, *settings, **more):
        out = real(df, label, *settings, **more)
        if label in ("passage-windows", "passage-open"):
            rows_of.setdefault(label, []).append((out.count(), out.select("key", "t").distinct().count()))
        return out

    monkeypatch.setattr(substring_dedup, "stored", recorded)
    rng = random.Random(24)
    own = lambda n: prose(rng, n, 10**6)
    lines = [own(20) for _ in range(3)]
    rows = [(i, " ".join(x for _ in range(12) for x in [rng.choice(lines), own(rng.randrange(1, 12))])) for i in range(20)]
    rows += [(100 + i, own(30) + " " + " ".join(lines) + " " + own(30 + i)) for i in range(6)]
    got = {r.doc_id: r for r in substring_dedup.near_duplicate_passages(frame(spark, rows)).collect()}
    assert len({got[100 + i].class_id for i in range(6)}) == 1 and all(got[100 + i].n_dup_words >= 55 for i in range(6))
    assert len(rows_of["passage-windows"]) == 1 and len(rows_of["passage-open"]) >= 4
    assert [x for found in rows_of.values() for x in found if x[0] != x[1]] == []


def test_pairs_of_members_are_those_of_all_their_windows(spark):
    """Ends and pairs as from comparing each window of a list with each other one."""
    rng = random.Random(25)
    label = {t: rng.randrange(4) for t in range(30)}
    windows = []
    for key in range(40):
        for t in rng.sample(range(30), rng.randrange(1, 9)):
            for _ in range(rng.randrange(1, 5)):
                left = rng.randrange(500)
                windows.append((key, t, left, left + rng.randrange(50, 90), label[t], rng.random() < 0.15))
    met = {}
    for x in windows:
        for y in windows:
            if x[0] == y[0] and x[1] < y[1] and (x[4] != y[4] or x[5] or y[5]):
                met.setdefault((x[1], y[1]), []).append((x[0], x[2], x[3], y[2], y[3]))
    for enough in (1, 2):
        want = {(a, b, *(f(m[i] for m in p) for i, f in enumerate((min, max, min, max), 1))) for (a, b), p in met.items() if len({m[0] for m in p}) >= enough}
        made = spark.createDataFrame(windows, "key long, t long, left int, right int, label long, open boolean")
        got = substring_dedup._crossing(made, enough).select("a", "b", "la", "ra", "lb", "rb").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_the_fewest_different_tokens_and_the_possible_stretches():
    rng = np.random.default_rng(26)
    for _ in range(300):
        least, x = int(rng.integers(1, 12)), rng.integers(0, rng.integers(1, 40), rng.integers(0, 60))
        stretches = [len(set(x[i : i + least])) for i in range(len(x) - least + 1)]
        assert substring_dedup._fewest(substring_dedup._earlier(x), least) == min(stretches, default=least)
        hit = rng.random(len(x)) < 0.6
        dense = any(hit[i:j].sum() >= 0.75 * (j - i) for i in range(len(x)) for j in range(i + least, len(x) + 1))
        assert substring_dedup._possible(hit, least) == dense


@pytest.mark.parametrize("size", [500, 1000, 2000])
def test_neighbouring_passages_that_stand_apart_in_the_other_text(size):
    rng = np.random.default_rng(size)
    for gap in (400, 1000):
        x, y, z = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (size, size, gap))
        beside, apart = tx.shingle_hashes(np.concatenate([x, y])), tx.shingle_hashes(np.concatenate([x, z, y]))
        for a, b in ((beside, apart), (apart, beside)):
            found = substring_dedup.shared_passages(a, b, 46)
            for text, ends in ((a, [f[:2] for f in found]), (b, [f[2:] for f in found])):
                covered = np.zeros(len(text), bool)
                for start, end in ends:
                    covered[start:end] = True
                assert covered[np.isin(text, beside) & np.isin(text, apart)].all()


def test_passages_with_edits_and_without_clean_texts(spark):
    rng = random.Random(9)
    rows = []
    for i in range(30):
        passage = prose(rng, 60, 10**6)
        rows += [(2 * i, prose(rng, 80, 10**6) + " " + passage), (2 * i + 1, edited(rng, passage, 60) + " " + prose(rng, 80, 10**6))]
    rows += [(100 + i, prose(rng, 120, 10**6)) for i in range(20)]
    got = {r.doc_id: r for r in substring_dedup.near_duplicate_passages(frame(spark, rows)).collect()}
    found = sum(got[2 * i].class_id == got[2 * i + 1].class_id for i in range(30))
    assert found >= 27  # 0.9 of the passages with one changed word
    assert not any(got[100 + i].n_spans for i in range(20))


def test_passages_of_copies_nulls_and_nothing(spark):
    rng = random.Random(10)
    text = prose(rng, 80)
    rows = [(3, text), (3, text), (5, text), (None, text), (None, None), (6, None), (7, ""), (8, "short text"), (9, "short text")]
    got = Counter((r.doc_id, r.n_spans, r.n_dup_words, r.class_id) for r in substring_dedup.near_duplicate_passages(frame(spark, rows)).collect())
    assert got == Counter({(3, 1, 80, 3): 2, (5, 1, 80, 3): 1, (None, 1, 80, 3): 1, (None, 0, 0, None): 1, (6, 0, 0, 6): 1, (7, 0, 0, 7): 1, (8, 0, 0, 8): 1, (9, 0, 0, 9): 1})
    assert substring_dedup.near_duplicate_passages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_settings_hold_while_a_table_is_written(spark):
    """The rows of a batch inside the write, and the session's settings after it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = {k: spark.conf.get(k) for k in (*tables.WHILE_WRITING, *tables.SIEVED)}

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    out = tables.stored(spark.range(0, 9000, 1, 1).mapInArrow(sizes, "n long"), "sizes", tables.SIEVED)
    assert max(r.n for r in out.collect()) == int(tables.WHILE_WRITING[name])
    assert before == {k: spark.conf.get(k) for k in before}


def test_suffix_dedup_keeps_columns_with_names_of_its_own(spark):
    docs = frame(spark, {1: "x" * 300, 2: None}).withColumns({"__": F.lit("a"), "Filler": F.lit("b"), "t": F.lit("c"), "runs": F.lit("d")})
    got = suffix_dedup.remove_repeats(docs).collect()
    assert [(r["__"], r["Filler"], r["t"], r["runs"]) for r in got] == [("a", "b", "c", "d")] * 2


def test_a_passage_with_one_edited_word_is_found_wherever_the_edit_is():
    """Five shingles differ; the passage of 60 words lies between different texts."""
    rng, n = np.random.default_rng(5), 56
    draw = lambda k: rng.integers(0, 2**60, k).astype(np.uint64)
    for edit in range(n - 4):
        a = draw(n)
        b = a.copy()
        b[edit : edit + 5] = draw(5)
        found = substring_dedup.shared_passages(np.concatenate([draw(200), a, draw(200)]), np.concatenate([draw(150), b, draw(300)]), 46)
        assert len(found) == 1
