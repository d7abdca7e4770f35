"""From raw documents to packed training sequences, stage by stage.

Each stage reads what its predecessor has kept, as Parquet in the shared folder;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsmart.llm import decontaminate, jaccard, lines, packing, quality
from newsmart.llm.common import ready, stored, table


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    ready(spark)
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, boilerplate lines at their first place only."""
    ready(spark)
    return lines.dedup(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    ready(spark)
    return jaccard.keep_first(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of every document goes."""
    ready(spark)
    return packing.packed(docs)


STAGES = [
    ("quality classifier", judge_quality),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("best-fit packing", pack),
]

#: SQL expresses neither the classifier nor the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
