"""The queries opN_<name> over whole tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, html_text, language, licenses, quality, secrets, similar, substrings, toxicity


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


_documents = _table("documents")
_pages = _table("pages")
_labels = _table("labels")
_benchmark = _table("benchmark")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": lambda s, d: toxicity.digest(_documents(s, d), _labels(s, d)),
        "op2_language_id": lambda s, d: language.digest(_documents(s, d)),
        "op3_decontaminate": lambda s, d: decontaminate.digest(_documents(s, d), _benchmark(s, d)),
        "op4_html_text": lambda s, d: html_text.extract(_pages(s, d)),
        "op5_secret_scan": lambda s, d: secrets.digest(_documents(s, d)),
        "op6_substring_dedup": lambda s, d: substrings.digest(_documents(s, d)),
        "op7_quality_rules": lambda s, d: quality.digest(_documents(s, d)),
        "op8_bpe": lambda s, d: bpe.digest(_documents(s, d)),
        "op9_license_scan": lambda s, d: licenses.scan_licenses(_documents(s, d)),
        "op10_jaccard_join": lambda s, d: similar.link_documents(_documents(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_substring_dedup": substrings.SQL, "op10_jaccard_join": similar.SQL}
