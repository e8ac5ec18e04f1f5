import random
from collections import Counter

import pytest
from comparison import difference, duck
from helpers import SCHEMA, edited, frame, prose
from pyspark.sql import functions as F

import corpus_pipeline
from casebeacon.llm.oracle import ORACLE
from casebeacon.llm.queries import QUERIES
from casebeacon.llm.tables import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE[name]) is None


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of which it is known what each stage does with them."""
    rng = random.Random(1)
    good = [prose(rng, 120, 10**6) for _ in range(60)]
    bad = [" ".join(f"BUY{rng.randrange(60)}!!" for _ in range(100)) for _ in range(60)]
    item = prose(rng, 30, 10**6) + ". " + prose(rng, 8, 10**6)
    shared = prose(rng, 60, 10**6)
    rows = list(enumerate(good)) + [(100 + i, t) for i, t in enumerate(bad)]
    rows += [(200, edited(rng, good[3], 90)), (201, good[4]), (202, prose(rng, 150, 10**6) + " " + item), (203, shared + " " + prose(rng, 90, 10**6)), (204, prose(rng, 90, 10**6) + " " + shared), (205, None), (206, ""), (None, prose(rng, 80, 10**6)), (5, good[5])]
    path = str(tmp_path_factory.mktemp("tables"))
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 60), 0) for i in [*range(60), *range(100, 160)]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, shared, rows


def test_every_stage_does_its_part(spark, tables):
    path, shared, rows = tables
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, path), "test-stage")
        assert docs.columns[:5] == COLUMNS
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name == "near duplicates":
            assert Counter(r.doc_id for r in docs.collect())[5] == 1
    ids = {name: set(k) for name, k in kept.items()}
    assert ids["quality classifier"] == {d for d, _ in rows if d is None or not 100 <= d < 160}
    assert ids["near duplicates"] == ids["quality classifier"] - {200, 201}
    texts = {d: r.text for d, r in kept["repeated passages"].items()}
    assert shared not in texts[203] + texts[204] and len(texts[203]) > 300
    assert ids["repeated passages"] == ids["near duplicates"]
    assert texts[10] == dict(rows)[10] and texts[205] in (None, "") and texts[206] == ""
    assert ids["benchmark decontamination"] == ids["repeated passages"] - {202}
    assert ids["mixing"] == ids["benchmark decontamination"]
    assert 0 < sum(r.taken for r in kept["mixing"].values())


def test_run_equals_the_stages(spark, tables):
    path, _, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, path), "test-run")
    key = lambda df: Counter((r.doc_id, r.text, r.taken) for r in df.collect())
    assert key(corpus_pipeline.run(spark, path)) == key(docs)


def test_stages_take_empty_tables_and_further_columns(spark, tables):
    path, _, _ = tables
    more = frame(spark, [(1, "some words here"), (2, None)]).withColumns({c: F.lit(1) for c in ("score", "size", "leaks", "kept", "t", "dropped_id")})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), path).count() == 0
        assert set(COLUMNS) <= set(stage(spark, more, path).columns)
        assert stage(spark, more, path).count() == 2


def test_near_duplicates_of_repeated_ids(spark):
    rng = random.Random(8)
    a, b, c = (prose(rng, 120) for _ in range(3))
    docs = frame(spark, [(1, a), (2, edited(rng, a, 120)), (2, b), (3, c), (3, edited(rng, c, 120)), (3, c)])
    left = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in left) == [1, 2, 3]
    assert {r.text for r in left if r.doc_id < 3} == {a, b}
