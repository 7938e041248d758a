"""A training corpus from ``documents`` in five stages, each one operator of ``brasa.llm``.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all that
the stage before kept; ``run`` writes each result as Parquet in the shared
checkpoint folder and rereads it, so a lost executor costs at most one stage.
All stages but the last return the columns of ``documents``; the last returns
one row per document with the words the mix takes from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brasa.llm import decontaminate, line_dedup, mixing, quality, simhash
from brasa.llm.common import table
from brasa.session import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source."""
    return line_dedup.without_boilerplate(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes from each document."""
    return mixing.mix(docs)


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("simhash_near_dedup", simhash_stage),
          ("benchmark_decontamination", benchmark_stage), ("mixing", mixing_stage)]

#: SQL has no XXH64 for the SimHash stage; tests hold run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
