"""From documents to shards: quality, near duplicates, benchmark passages, mixing, sharding.

Each stage reads all that its predecessor kept, as a written table, and writes what it keeps.
Stages before the last return the columns of their input, so extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm.decontamination import decontamination_stage
from tablecraft.llm.mixing import mixing_stage
from tablecraft.llm.neardup import near_duplicate_stage
from tablecraft.llm.quality import quality_stage
from tablecraft.llm.sharding import op3_consistent_sharding
from tablecraft.shared import settled


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the classifier accept."""
    return quality_stage(docs, _read(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_duplicate_stage(docs)


def keep_clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark."""
    return decontamination_stage(docs, _read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three rows."""
    return mixing_stage(docs)


def put_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return op3_consistent_sharding(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", keep_clean_of_benchmarks),
    ("mixing", mix_sources),
    ("sharding", put_into_shards),
]

#: No SQL: MinHash groups and a fitted classifier are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
