"""The operators over the given tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    line_dedup,
    mixing,
    quality,
    resample,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    url_filter,
    warc,
)
from evalspark.session import configure

SHARDS = 40
#: Fixed values: (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shard_by_bytes(docs, SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"), length=50)
    return found.select(
        "doc_id",
        F.col("n_tokens").alias("n_bytes"),
        _covered("spans").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(_table(spark, sf_dir, "pages"))
    read = warc.resolved(warc.read_records(index))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, _table(spark, sf_dir, "benchmark"), length=13)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"), (1, 2, 3))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"), length=20)
    return found.select(
        "doc_id",
        F.col("n_tokens").alias("n_words"),
        _covered("spans").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(configure(spark), f"{sf_dir}/documents.parquet")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_dedup.line_dedup(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.importance(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _covered(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_suffix_dedup,
        op3_warc,
        op4_url_filter,
        op5_decontamination,
        op6_mixing,
        op7_substring_dedup,
        op8_quality,
        op9_exact_dedup,
        op10_simhash,
        op11_line_dedup,
        op12_collocations,
        op13_resampling,
    )
}
