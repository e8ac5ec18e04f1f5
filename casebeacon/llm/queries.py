"""One query per operator over its whole table, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebeacon.llm import alignment, decontaminate, minhash_dedup, mixing, packing, quality_classifier, quality_rules, substring_dedup, suffix_dedup, token_counts, url_filters, warc, whitening
from casebeacon.llm.tables import documents
from casebeacon.session import work_dir

TOKENIZER = "piece_bpe_32k.model"


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text"), texts=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = quality_classifier.score(docs.select(F.col("doc_id").cast("long"), "text"), quality_classifier.fit_quality(spark, sf_dir, docs))
    return scored.select("doc_id", quality_classifier.held_out().alias("held_out"), "score", "predicted")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text")
    marked = decontaminate.mark_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    written = warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    records, gaps = warc.read_archives(written, folder, payloads=False)
    lost = gaps.limit(5).collect()
    if lost:
        raise ValueError(f"records that were written can't be read again: {lost}")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.apply_policy(quality_rules.rule_ledger(documents(spark, sf_dir)))
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failures")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long"), "text", "source")
    return mixing.in_queue_order(mixing.schedule(docs).select("doc_id", "size", "source_size", "target", "taken", "virtual_finish"))


def _day(text, offset: int = 0):
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("int") % 366
    return F.date_add(F.lit("2024-01-01").cast("date"), number + offset)


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated lists for the hosts of ``pages``: hosts come and go, domains stay, folders are allowed for a while."""
    host, path = url_filters.url_host(F.col("url")), url_filters.url_path(F.col("url"))
    names = pages.select(host.alias("host"), F.regexp_extract(path, "^/([^/]+)", 1).alias("folder")).filter("host is not null").distinct()
    hosts = names.select("host").distinct()
    domains = hosts.select(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("value")).filter("value <> ''").distinct()
    folders = names.filter("folder <> ''").select(F.concat_ws("/", "host", "folder").alias("value"))
    row = lambda name, kind, value, action, at: (F.lit(name).alias("list"), F.lit(kind).alias("kind"), value.alias("value"), F.lit(action).alias("action"), at.alias("at"))
    h, v = F.col("host"), F.col("value")
    return (
        hosts.select(*row("malware", "host", h, "add", _day(F.concat(F.lit("m"), h))))
        .union(hosts.select(*row("malware", "host", h, "remove", _day(F.concat(F.lit("m"), h), 90))))
        .union(domains.select(*row("adult", "domain", v, "add", _day(F.concat(F.lit("a"), v), 120))))
        .union(folders.select(*row("allow", "prefix", v, "add", _day(F.concat(F.lit("p"), v)))))
        .union(folders.select(*row("allow", "prefix", v, "remove", _day(F.concat(F.lit("p"), v), 150))))
    )


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").cast("long"), "url")
    captures = pages.withColumn("fetched_at", _day(F.concat(F.lit("f"), F.col("page_id").cast("string"))))
    return url_filters.filter_captures(captures, list_entries(pages))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.near_duplicate_passages(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path(TOKENIZER))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(packing.token_pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_counts": op5_token_counts,
    "op6_warc": op6_warc,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_url_filters": op9_url_filters,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_whitening": op13_whitening,
}
