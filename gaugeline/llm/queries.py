"""Registered queries of the operators: ``name -> f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import (divergence, html_extract, katz, language_id, line_dedup, ngram_join, packing, quality_gam,
               suffix_decontam, token_store, warc, whitening, zone_clusters)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_ngram_join(spark, sf_dir):
    return ngram_join.linked(table(spark, sf_dir, "documents"))


def fold(id_col: str, folds: int):
    """The remainder by which held-out rows are told."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


@query
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = language_id.identified(docs, fold("doc_id", 5) != 0, carried=["doc_id"])
    return rows.select("row.doc_id", "lang_pred", "score", "rejected").withColumn(
        "held_out", fold("doc_id", 5) == 0)


@query
def op3_quality_gam(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality_gam.scored(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2, carried=["doc_id"])
    return rows.select("row.doc_id", "score", "predicted").withColumn("held_out", fold("doc_id", 4) == 2)


@query
def op4_divergence(spark, sf_dir):
    rows = divergence.judged(table(spark, sf_dir, "documents"), carried=["doc_id"])
    return rows.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept")


@query
def op5_suffix_decontamination(spark, sf_dir):
    rows = suffix_decontam.marked(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  table(spark, sf_dir, "benchmark"))
    return rows.select("row.doc_id", *[f"found.{c}" for c in (
        "n_words", "n_hit", "n_items", "items_sha256", "contaminated")])


@query
def op6_line_dedup(spark, sf_dir):
    rows = line_dedup.cleaned(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("row.doc_id", "text", "n_lines", "n_dropped")


@query
def op7_token_store(spark, sf_dir):
    path = scratch_path(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"))
    return token_store.read_store(spark, path, with_ids=False)


@query
def op8_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.captures(warc.read_records(spark, path))
    about = F.col("metadata.fields")
    return found.select(
        F.regexp_extract(about, r"page-id: (-?\d+)", 1).try_cast("bigint").alias("page_id"),
        F.col("capture.payload_bytes").alias("payload_bytes"),
        F.coalesce("capture.found_digest", "capture.digest").alias("payload_digest"),
        F.col("capture.kind").alias("record_type"),
        F.regexp_extract(about, r"refers-to-page: (-?\d+)", 1).try_cast("bigint").alias("refers_to"))


@query
def op9_html_extract(spark, sf_dir):
    rows = html_extract.extracted(table(spark, sf_dir, "pages"), carried=["page_id", "url"])
    return rows.select("row.page_id", "row.url", "text", "n_chars")


@query
def op10_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), with_ids=False)


@query
def op11_whitening(spark, sf_dir):
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"), carried=["vec_id"])
    return rows.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                       "deviation_exact")


@query
def op12_zone_clusters(spark, sf_dir):
    rows = zone_clusters.clustered(table(spark, sf_dir, "embeddings"), carried=["vec_id"])
    return rows.select("row.vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query
def op13_katz(spark, sf_dir):
    rows = katz.scored(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2, carried=["doc_id"])
    return rows.select("row.doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").withColumn(
        "held_out", fold("doc_id", 7) == 2)
