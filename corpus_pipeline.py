"""A corpus from raw documents: quality, near duplicates, repeated passages, test items, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents, so each works on what its predecessor kept. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebeacon.llm import decontaminate, minhash_dedup, mixing, quality_classifier, suffix_dedup
from casebeacon.llm.suffix_dedup import text_key
from casebeacon.llm.tables import stored


def _packed(docs: DataFrame) -> DataFrame:
    """The text beside the whole row, so that no column of a document meets one that an operator adds."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good (score of 0.3 or more)."""
    scored = quality_classifier.score(_packed(docs), quality_classifier.fit_quality(spark, sf_dir, docs))
    return scored.filter("predicted = 1").select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows of a group that share this id one stays; rows without id all stay. Decisions hold for an id and a
    text, so a repeated id does not pass them on to other texts.
    """
    found = stored(minhash_dedup.labelled(docs).filter("label is not null").select("doc_id", "t", "label"), "pipeline-found")
    first = found.groupBy("label").agg(F.min(F.struct("doc_id", "t")).alias("first"))
    dropped = found.join(first, "label").filter(F.struct("doc_id", "t") != F.col("first")).select(F.col("doc_id").alias("dropped_id"), F.col("t").alias("dropped_text")).distinct()
    dropped = stored(dropped, "pipeline-dropped")
    kept = docs.join(dropped, (docs.doc_id == dropped.dropped_id) & (text_key() == dropped.dropped_text), "left_anti")
    return kept.filter("doc_id is not null").dropDuplicates(["doc_id", "text"]).union(kept.filter("doc_id is null")).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that occur more than once; those of which nothing is left go.

    n_chars follows the shortened text. A text that was empty before stays.
    """
    cut = suffix_dedup.remove_repeats(_packed(docs))
    cut = cut.filter((F.col("n_removed") == 0) | (F.trim("kept_text") != ""))
    shorter = F.col("n_removed") > 0
    own = {"text": F.when(shorter, F.col("kept_text")).otherwise(F.col("document.text")), "n_chars": F.when(shorter, F.length("kept_text")).otherwise(F.col("document.n_chars"))}
    return cut.select(*[own[c].alias(c) if c in own else F.col(f"document.`{c}`") for c in docs.columns])


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontaminate.decontaminate(_packed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("document.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in queue order with size, source_size, target, virtual times and the words taken."""
    return mixing.in_queue_order(mixing.schedule(docs))


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark decontamination", without_test_items),
    ("mixing", mix),
]

#: Compression scores can't be stated in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
