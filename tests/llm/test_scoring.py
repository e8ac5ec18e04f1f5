import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import SCHEMA, frame, prose, upper, words
from pyspark.sql import functions as F

from casebeacon.llm import decontaminate, mixing, quality_classifier, quality_rules, token_counts, url_filters

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_token_counts_equal_the_library(spark):
    rng = random.Random(1)
    bits = ["a", "b", " ", "  ", "th", "e", "\n", "\t", "é", "日本", "<s>", "</s>", "<unk>", "▁", "😀", "<0x0A>", "an", "ing", "\x00", "́", "aaaa", "   ", "▁▁", "The", "Words"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(800)] + ["", " ", "▁", "a" * 5000, " " * 3000, "the" * 3000, "x" * 200_000, "nope " * 5000]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = [len(x) for x in library.encode(texts, num_threads=1)]
    rows = list(enumerate(texts)) + [(None, "a b"), (3, None), (3, None)]
    got = token_counts.token_counts(frame(spark, rows).withColumnRenamed("lang", "n_tokens"), MODEL).collect()
    expected = [(i, len(t.encode()), n, n > 4096) for (i, t), n in zip(rows, want, strict=False)] + [(None, 3, len(library.encode("a b")), False), *[(3, 0, 0, False)] * 2]
    assert Counter(map(tuple, got)) == Counter(expected)


def test_token_counts_of_nothing(spark):
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA), MODEL).collect() == []


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(MODEL, "rb").read())
    proto.trainer_spec.byte_fallback = False
    path = tmp_path / "other.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        token_counts.vocabulary(str(path))


def labelled(rng, n):
    good = [prose(rng, rng.randrange(30, 150)) + "." for _ in range(n)]
    bad = [" ".join(f"BUY{rng.randrange(50)}!!" for _ in range(rng.randrange(30, 150))) for _ in range(n)]
    return [(i, t, int(i < n)) for i, t in enumerate(good + bad)]


def test_classifier_separates_held_out_texts(spark):
    rng = random.Random(2)
    rows = labelled(rng, 150)
    docs = frame(spark, [(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (None, rows[0][1])]).withColumn("Score", F.lit("x"))
    labels = spark.createDataFrame([(i, q, None) for i, _, q in rows] + [(None, 1, None), (0, None, 1), (5000, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train(docs, labels.filter(~quality_classifier.held_out() | F.col("doc_id").isNull()))
    got = {r.doc_id: r for r in quality_classifier.score(docs, model).collect()}
    held = {r.doc_id for r in docs.filter(quality_classifier.held_out()).select("doc_id").collect()}
    assert np.mean([got[i].predicted == q for i, _, q in rows if i in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert got[900].score == got[901].score == pytest.approx(model.prior)


def test_classifier_accuracy_on_the_test_tables(spark, sf_dir):
    from casebeacon.llm.queries import op3_quality_classifier

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [(labels[r.doc_id], r.predicted, r.score) for r in op3_quality_classifier(spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b, _ in rows]) >= 0.9
    assert np.mean([b for a, b, _ in rows if a == 1]) >= 0.98
    assert np.mean([s for a, _, s in rows if a == 1]) > np.mean([s for a, _, s in rows if a == 0]) + 0.4


def test_classifier_without_labels_or_documents(spark):
    docs, none = frame(spark, {1: "some text", 2: None}), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_classifier.score(docs, quality_classifier.train(docs, none)).collect()} == {0.5}
    assert [r.predicted for r in quality_classifier.score(docs, quality_classifier.train(docs, one)).collect()] == [1, 1]
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_classifier.score(empty, quality_classifier.train(empty, none)).collect() == []


def rules_by_hand(text):
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {p for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for p in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_rules_equal_a_plain_count(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "b", "c#", "É|", "dd"]) + rng.choice(["", "\n", "\t", "\x0b"]) for _ in range(rng.randrange(80))) for _ in range(60)]
    texts += [None, "", " \n ", "a", "a a a a", "x\ny\nx\n\n\n x", "😀 😀", prose(rng, 20_000), "a b c a b c", "\x1c a b"]
    rows = list(enumerate(texts)) + [(None, "a b"), (1, texts[1])]
    ledger = quality_rules.rule_ledger(frame(spark, rows).withColumnRenamed("lang", "words"))
    got = quality_rules.apply_policy(ledger).collect()
    want = Counter((d, *rules_by_hand(t)) for d, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_ablations_come_from_the_ledger(spark):
    ledger = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 3), (5, 4)], "doc_id long, failures long")
    got = {(r.policy, r.rule): (r.n_failed, r.n_only, r.n_kept) for r in quality_rules.ablations(ledger).collect()}
    assert got["v1", "few_words"] == (3, 2, 2) and got["v1", "repeated_windows"] == (1, 0, 2)
    assert got["v2", "symbols"] == (1, 1, 1)
    assert quality_rules.ablations(ledger.filter("false")).collect() == []
    assert quality_rules.apply_policy(quality_rules.rule_ledger(spark.createDataFrame([], SCHEMA))).collect() == []


def test_rules_stay_in_the_jvm(spark, sf_dir):
    from casebeacon.llm.queries import op7_quality_rules

    plan = op7_quality_rules(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def targets_by_hand(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [n for n in sizes if n is None]
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] > 2 * sizes[n]}
        if not over:
            return target | share
        target |= {n: 2 * sizes[n] for n in over}
        free -= over
    return target


@pytest.mark.parametrize("seed", range(3))
def test_mixture_meets_its_targets(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    rng = random.Random(seed)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(60))), rng.choice(["b", "a", "Z", "é", None, "rare"] if i % 7 else ["b"])) for i in range(150)]
    rows += [(500, None, "b"), (501, "", "empty"), (None, "a b c", "a"), (7, "x y", "b"), (7, "x y", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("bucket", F.lit(1)).withColumn("Target", F.lit(2))
    got = mixing.schedule(docs).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows)
    sizes = Counter()
    for r in got:
        assert r.size == len(words(r.text)) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
    want = targets_by_hand(sizes)
    for source, size in sizes.items():
        mine = [r for r in got if r.source == source]
        assert {r.source_size for r in mine} == {size}
        assert all(r.target == pytest.approx(want[source]) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[source]) < 1
    again = mixing.schedule(docs.repartition(3)).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))
    mixed = mixing.mixture(docs).collect()
    assert sum(r.words for r in mixed) == sum(r.taken for r in got)
    assert [r.virtual_finish for r in mixed] == sorted(r.virtual_finish for r in mixed)


def test_mixture_of_nothing(spark):
    assert mixing.mixture(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.taken for r in mixing.schedule(frame(spark, {1: None, 2: ""})).collect()] == [0, 0]


def test_index_finds_what_scoring_every_part_finds():
    rng = random.Random(5)
    items = [(i, prose(rng, rng.randrange(1, 60), 120)) for i in range(90)] + [(90, "The " * 700 + "end."), (91, "")]
    index = decontaminate.Index(items)
    dense = np.zeros((len(index.vocabulary), len(index.part_item)))
    for t in range(len(index.vocabulary)):
        dense[t, index.part[index.begin[t] : index.begin[t + 1]]] = index.impact[index.begin[t] : index.begin[t + 1]]
    pairs, want = [], set()
    for p in range(200):
        terms = np.array(sorted(rng.sample(range(len(index.vocabulary)), rng.randrange(0, 80))), np.int64)
        pairs += [(p, t) for t in terms]
        score = dense[terms].sum(axis=0)
        want |= {(p, int(q)) for q in np.flatnonzero(score >= 1 - 1e-9)}
    passage, term = np.array(pairs, np.int64).T
    found, part, score = index.search(passage, term)
    assert set(zip(found.tolist(), part.tolist(), strict=True)) == want and len(want) > 50
    assert all(s == pytest.approx(dense[term[passage == p], q].sum()) for p, q, s in zip(found, part, score, strict=True))


def test_leaks_are_found_and_clean_texts_stay(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 500)
    rng = random.Random(6)
    items = [(i, prose(rng, 25, 900) + ".\n" + prose(rng, 6, 900)) for i in range(12)] + [(50, None), (51, "  "), (52, prose(rng, 700, 900)), (None, prose(rng, 30, 900))]
    test_set = spark.createDataFrame(items, "item_id long, text string")
    clean = [(1000 + i, prose(rng, 200, 900)) for i in range(20)]
    dirty = [(i, prose(rng, 70 * i, 900) + "\t" + upper(items[i][1]).replace(" ", "  ") + " " + prose(rng, 40, 900)) for i in range(12)]
    dirty += [(52, prose(rng, 300, 900) + " " + items[14][1]), (53, items[0][1] + " x " + items[1][1])]
    rows = clean + dirty + [(None, items[2][1]), (60, None), (61, ""), (2, dirty[2][1])]
    docs = frame(spark, rows).withColumnRenamed("lang", "Leaks")
    got = decontaminate.mark_leaks(docs, test_set).collect()
    found = Counter((r.doc_id, x.item_id) for r in got for x in r.leaks)
    want = Counter([(i, i) for i in range(12)] + [(52, 52), (53, 0), (53, 1), (None, 2), (2, 2)])
    assert found == want
    assert all(x.question_overlap >= 0.75 and x.answer_overlap >= 0.5 and x.score > 0 for r in got for x in r.leaks)
    assert {r.doc_id for r in decontaminate.decontaminate(frame(spark, rows), test_set).collect()} == {d for d, _ in clean} | {60, 61}


def test_leaks_with_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.leaks for r in decontaminate.mark_leaks(frame(spark, {1: "a b"}), none).collect()] == [[]]
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.mark_leaks(spark.createDataFrame([], SCHEMA), some).collect() == []


def test_list_entries_hold_from_their_day_until_the_next(spark):
    log = spark.createDataFrame(
        [
            ("bad", "host", "a.org", "add", "2024-01-05"), ("bad", "host", "a.org", "remove", "2024-01-10"), ("bad", "host", "a.org", "add", "2024-01-20"),
            ("bad", "host", "a.org", "add", "2024-01-20"), ("dom", "domain", "b.com", "add", "2024-01-01"), ("allow", "prefix", "x.b.com/ok", "add", "2024-01-02"),
            ("tie", "host", "c.net", "add", "2024-01-01"), ("tie", "host", "c.net", "remove", "2024-01-01"), (None, "host", "a.org", "add", "2024-01-01"), ("bad", "host", None, "add", "2024-01-01"),
        ],
        "list string, kind string, value string, action string, at string",
    ).withColumn("at", F.to_date("at"))
    rows = [
        (1, "http://a.org/", "2024-01-04"), (2, "https://user@www.A.org:80?q", "2024-01-05"), (3, "http://a.org", "2024-01-10"), (4, "http://a.org./x", "2024-02-01"),
        (5, "http://x.b.com/no/page", "2024-01-03"), (6, "http://x.b.com/ok/page", "2024-01-03"), (7, "http://x.b.com/ok", "2024-01-01"), (8, "http://xb.com/", "2024-01-03"),
        (9, "http://c.net/", "2024-01-03"), (10, None, "2024-01-03"), (11, "not a url", "2024-01-03"), (12, "http://a.org/", None), (1, "http://a.org/", "2024-01-04"), (None, "http://b.com", "2024-01-03"),
    ]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at string").withColumn("fetched_at", F.to_date("fetched_at")).withColumn("value", F.lit(1))
    got = Counter((r.page_id, r.n_entries, r.lists, r.blocked) for r in url_filters.filter_captures(captures, log).collect())
    assert got == Counter({
        (1, 0, "", False): 2, (2, 1, "bad", True): 1, (3, 0, "", False): 1, (4, 1, "bad", True): 1, (5, 1, "dom", True): 1, (6, 2, "allow,dom", False): 1, (7, 1, "dom", True): 1,
        (8, 0, "", False): 1, (9, 0, "", False): 1, (10, 0, "", False): 1, (11, 0, "", False): 1, (12, 0, "", False): 1, (None, 1, "dom", True): 1,
    })
    assert url_filters.filter_captures(captures.filter("false"), log).collect() == []
    assert {r.blocked for r in url_filters.filter_captures(captures, log.filter("false")).collect()} == {False}


def test_scores_do_not_depend_on_the_size_of_a_shard(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = []
    for size in (32_000_000, 2_000):
        monkeypatch.setattr(decontaminate, "SHARD_BYTES", size)
        rows = decontaminate.mark_leaks(docs, items).filter("size(leaks) > 0").select("doc_id", "leaks").collect()
        found.append({(r.doc_id, x.item_id): tuple(x) for r in rows for x in r.leaks})
    assert found[0] == found[1] and found[0]


def test_weak_terms_open_no_block():
    rng = random.Random(9)
    items = [(i, "of the and " + prose(rng, 30, 5000)) for i in range(400)]
    index = decontaminate.Index(items)
    terms = np.unique(index._terms(decontaminate._words(items[7][1]))[1])
    passage = np.zeros(len(terms), np.int64)
    opened = index._open_blocks(passage, terms, 1 - 1e-9)
    assert 7 // decontaminate.BLOCK_PARTS in opened and len(opened) < index.n_blocks / 10
    assert 7 in index.search(passage, terms)[1]


def test_leak_at_the_end_of_a_very_long_text(spark):
    rng = random.Random(10)
    item = prose(rng, 40, 10**6)
    rows = [(1, prose(rng, 300_000, 900) + " " + item), (2, prose(rng, 200_000, 900))]
    assert len(rows[0][1]) > 1 << 20
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    got = decontaminate.mark_leaks(frame(spark, rows), items).collect()
    assert {r.doc_id: [x.item_id for x in r.leaks] for r in got} == {1: [5], 2: []}


def test_hosts_with_very_many_labels(spark):
    log = spark.createDataFrame([("dom", "domain", "b.com", "add", "2024-01-01")], "list string, kind string, value string, action string, at string").withColumn("at", F.to_date("at"))
    rows = [(1, "http://" + "x." * 140 + "b.com/", "2024-01-03"), (2, "http://" + "x." * 140 + "c.com/", "2024-01-03")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at string").withColumn("fetched_at", F.to_date("fetched_at"))
    assert {r.page_id: r.blocked for r in url_filters.filter_captures(captures, log).collect()} == {1: True, 2: False}


def test_the_sample_is_drawn_among_labelled_texts(spark):
    rng = random.Random(11)
    rows = labelled(rng, 60)
    docs = frame(spark, [(i, t) for i, t, _ in rows] + [(300, rows[0][1]), (0, rows[0][1])])
    others = spark.range(1000, 9000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    marks = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int").union(others)
    model = quality_classifier.train(docs, marks, rows=60)
    assert model.slope > 0
    # Contradicting labels have no effect, in whatever order they come.
    twice = marks.union(spark.createDataFrame([(300, 0), (300, 1)], "doc_id long, quality int"))
    assert quality_classifier.train(docs, twice.repartition(5), rows=60) == model


def test_scores_equal_a_plain_calculation(spark):
    import zstandard

    rng = random.Random(12)
    rows = labelled(rng, 80)
    long = prose(rng, 200_000)
    assert len(long) > 1 << 20
    docs = frame(spark, [(i, t) for i, t, _ in rows] + [(900, long), (901, "é" * 700)])
    model = quality_classifier.train(docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int"))

    def size(dictionary, piece):
        kept = zstandard.ZstdCompressionDict(dictionary)
        return len(zstandard.ZstdCompressor(level=3, dict_data=kept, write_content_size=False, write_dict_id=False).compress(piece))

    for r in quality_classifier.score(docs.filter("doc_id % 20 = 0 or doc_id > 900"), model).collect():
        data, total = r.text.encode(), 0.0
        for at in range(0, len(data), 512):
            good, bad = (size(d, data[at : at + 512]) for d in (model.good, model.bad))
            total += len(data[at : at + 512]) * (bad - good) / max(good, bad)
        assert r.score == pytest.approx(1 / (1 + np.exp(-(model.slope * total / len(data) + model.offset))), abs=1e-6)
    assert 0 <= quality_classifier.score(docs.filter("doc_id = 900"), model).first().score <= 1


def test_mixture_keeps_columns_with_names_of_its_own(spark):
    names = ["place", "Bucket", "tie", "within", "before", "s", "b", "_s"]
    docs = frame(spark, {1: "a b c", 2: "d " * 1_000_000, 3: None}).select("*", *[F.lit(n).alias(n) for n in names])
    got = mixing.schedule(docs).collect()
    assert all(r[n] == n for r in got for n in names)
    assert sorted(r.size for r in got) == [0, 3, 1_000_000]
