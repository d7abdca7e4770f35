"""The operators applied to whole tables: one query each, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsmart.llm import (
    decontaminate, html, jaccard, licenses, lines, packing, pii, quality, rules, runs, turns, urls, windows,
)
from newsmart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_empirical_bayes_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality, toxicity and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_site_spread_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that many sites share."""
    return lines.dedup(table(spark, sf_dir, "documents"))


def op3_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of every document goes."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op5_heavy_light_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under shared shingles."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's address."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    return licenses.find(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdict of every document."""
    return rules.judge(table(spark, sf_dir, "documents"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data."""
    return pii.replace(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


def op11_survivor_viterbi_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    return turns.audit(turns.damaged(table(spark, sf_dir, "conversations")))


def op12_monotone_queue_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of every document goes when their order is kept."""
    return windows.packed(table(spark, sf_dir, "documents"))


def op13_basic_factor_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, every tenth with a planted tail."""
    return runs.summary(table(spark, sf_dir, "documents"), runs.planted)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_empirical_bayes_quality, op2_site_spread_line_dedup, op3_spaced_seed_decontamination,
        op4_sum_of_squares_packing, op5_heavy_light_jaccard_join, op6_url_filters, op7_license_scan,
        op8_quality_rules, op9_surrogates, op10_html_extraction, op11_survivor_viterbi_repair,
        op12_monotone_queue_windows, op13_basic_factor_runs,
    )
}
ORACLES: dict[str, str] = {"op2_site_spread_line_dedup": lines.ORACLE_SQL, "op6_url_filters": urls.ORACLE_SQL}
