"""The registered queries: each applies its operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chosen_path, cover_tree, hashing_index, html_render, language_id, mixing, packing, pii, secret_scan, warc
from .common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = secret_scan.spans_text(F.col("spans"), ("assign", "access", "hex"))
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(base, 256).alias("base_sha256"), secret_scan.spans_text(F.col("spans")).alias("spans"))


def op2_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.extract_text(table(spark, sf_dir, "pages"))


def fold(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(F.coalesce(~fold(), F.lit(True))), key=("doc_id",))
    return language_id.predict(docs.select(F.struct("doc_id", F.coalesce(fold(), F.lit(False)).alias("held_out")).alias("row"), "text"), model, id_col="row").select("row.doc_id", "row.held_out", "lang_pred", "score")


def op6_cover_tree_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_counts(table(spark, sf_dir, "documents"))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii.session_key(spark))


def op10_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_secret_scan, op2_multi_index_hashing, op3_chosen_path_join, op4_html_extraction, op5_language_id, op6_cover_tree_pairs, op7_best_fit_packing, op8_source_mixing, op9_pii_surrogates, op10_warc_packages]
    return {f.__name__: f for f in found}
