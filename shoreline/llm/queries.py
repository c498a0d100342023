"""Registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_repair, embedding_dedup, exact_dedup, html_extract, merkle, mixing, oracles, packing, pii,
               quality, simhash_dedup, token_counts, topk_search, toxicity)
from .common import fold, table


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_extract.main_text(table(spark, sf_dir, "pages"))
    return text.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", model.score_column(spark, F.col("text")).alias("score"))
    return _held_out(scored, 0.5)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (exact_dedup.duplicate_groups(docs)
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.token_lengths(table(spark, sf_dir, "documents")))


def _held_out(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _held_out(docs.select("doc_id", model.score_column(F.col("text")).alias("score")), quality.THRESHOLD)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = embedding_dedup.near_duplicate_groups(table(spark, sf_dir, "embeddings"))
    return got.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select(F.col("id").alias("doc_id"), "n_tokens",
                      *[F.coalesce(F.col("p")[f"quality{q}_toxic{t}"], F.lit(0.0)).alias(f"p_quality{q}_toxic{t}")
                        for q, t in mixing.TARGETS], "rate", "copies")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (simhash_dedup.near_duplicate_groups(table(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), simhash_dedup.hex16(F.col("fp")).alias("fingerprint"),
                    "component_id"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(_joined("plain"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered, when = merkle.tampered_thirds()
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered=tampered, when=when).withColumnRenamed("id", "doc_id")


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, real = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows, real=real).report.withColumnRenamed("conv", "conv_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_extract, op2_toxicity, op3_exact_dedup, op4_token_counts, op5_quality,
                                    op6_embedding_dedup, op7_mixing, op8_simhash, op9_packing, op10_pii, op11_merkle,
                                    op12_topk, op13_repair)}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": oracles.EXACT_DEDUP,
        "op11_merkle": oracles.MERKLE,
        "op12_topk": oracles.TOPK,
        "op13_repair": oracles.REPAIR,
    }
