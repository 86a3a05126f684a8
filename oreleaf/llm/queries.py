"""Registered queries of the operators over whole tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreleaf.llm import bpe, conversations, decontamination, filter_audit, licenses, quality, resampling, sharding, simhash, suffixes, thresholds, token_files, url_filters
from oreleaf.llm.common import staged
from oreleaf.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers find the package where the driver found it, unless it is installed or sent along.
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if PACKAGE_ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([PACKAGE_ROOT, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = suffixes.keyed(docs).withColumn("_whole", F.sha2("_text", 256)).drop("_text", "text")
    return suffixes.with_facts(rows, suffixes.facts(docs)).select(
        "doc_id", "n_bytes", F.expr("aggregate(coalesce(spans, array()), 0L, (n, s) -> n + s.end - s.first)").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), F.coalesce(F.sha2("kept", 256), "_whole").alias("kept_sha256"),
    )


def op2_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= quality.CUTOFF).cast("int").alias("predicted"),
    )


def op3_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return thresholds.judge(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


def op4_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.collapse(table(spark, sf_dir, "conversations"))


def op5_simhash_vp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("expressions")


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list log made from the hosts of `pages`: block entries for the domain above each host, allow entries for hosts' first path parts."""
    hosts = pages.select(url_filters.host("url").alias("h"), url_filters.first_part("url").alias("part")).where("h <> ''").distinct()
    domain = F.expr("substring_index(h, '.', -3)")
    domains = hosts.select(domain.alias("pattern")).distinct().withColumns({"n": F.length("pattern").cast("long"), "a": F.ascii(F.expr("substring(pattern, 5, 1)")).cast("long")})
    start = "(31 * n + 17 * a) % 200"
    blocks = domains.selectExpr("pattern", f"stack(3, 'add', {start}, 'remove', {start} + 10 + a % 50, 'add', {start} + 90 + n) as (action, day)")
    parts = hosts.where("part in ('de', 'fr')").selectExpr("concat(h, '/', part) as pattern", "cast(length(h) as long) as n")
    allows = parts.selectExpr("pattern", "stack(2, 'add', 11 * n % 300, 'remove', 11 * n % 300 + 40) as (action, day)")
    return blocks.select(F.lit("block").alias("list"), "pattern", "action", "day").union(allows.select(F.lit("allow"), "pattern", "action", "day"))


def op8_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("day", F.col("page_id") * 37 % 365)
    return url_filters.judge(captures, list_entries(pages)).withColumn("since", F.coalesce("since", F.lit(-1)))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.byte_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_folder(spark)
    tokens = token_files.tokenize(table(spark, sf_dir, "documents"), WORD_BPE, END_ID)
    token_files.write(staged(tokens, "token-ids", compression="zstd"), path)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_bytes": op1_repeated_bytes,
    "op2_neighbour_quality": op2_neighbour_quality,
    "op3_certified_rules": op3_certified_rules,
    "op4_snapshot_collapse": op4_snapshot_collapse,
    "op5_simhash_vp": op5_simhash_vp,
    "op6_license_scan": op6_license_scan,
    "op7_winnowing": op7_winnowing,
    "op8_temporal_url_filter": op8_temporal_url_filter,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_byte_shards": op10_byte_shards,
    "op11_huffman_ids": op11_huffman_ids,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_filter_audit": op13_filter_audit,
}
