"""The queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontaminate import leaks
from .filter_audit import AUDIT_SQL, audit_documents
from .html_wrappers import extract_pages
from .licenses import scan_licenses
from .line_dedup import EQUAL_CHARS, line_report
from .near_dups import COMPONENTS_SQL, near_duplicates
from .packing import pack_documents
from .quality import quality_rules
from .secrets import scan_secrets
from .sharding import shard_documents
from .token_files import encode_documents
from .topk_search import SEARCH_SQL, search_embeddings


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents").select("doc_id", "text"), least=EQUAL_CHARS, by_words=True)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_embeddings(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_html_extraction,
        op2_line_dedup,
        op3_token_files,
        op4_secret_scan,
        op5_quality_rules,
        op6_near_duplicates,
        op7_decontamination,
        op8_best_fit_packing,
        op9_license_scan,
        op10_sharding,
        op11_filter_audit,
        op12_exact_top_k,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op6_near_duplicates": COMPONENTS_SQL, "op11_filter_audit": AUDIT_SQL, "op12_exact_top_k": SEARCH_SQL}
