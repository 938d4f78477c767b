"""One query for each operator on the whole of its table, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from inspect import cleandoc

from pyspark.sql import DataFrame, SparkSession

from tablecraft.llm import alignment, decontamination, hardnegatives, htmltext, katz, linetemplates, mixing, neardup, quality, secrets, sharding, suffixdedup, tokenids

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        LLM_QUERIES[function.__name__] = function
        if oracle is not None:
            LLM_ORACLES[function.__name__] = cleandoc(oracle)
        return function

    return add


@_query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.op1_suffix_dedup(_table(spark, sf_dir, "documents"))


@_query()
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op2_secret_scan(_table(spark, sf_dir, "documents"))


@_query()
def op3_consistent_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op3_consistent_sharding(_table(spark, sf_dir, "documents"))


@_query()
def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op4_pareto_mix(_table(spark, sf_dir, "documents"))


@_query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op5_decontamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query()
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op6_jaccard_join(_table(spark, sf_dir, "documents"))


@_query()
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.op7_html_text(_table(spark, sf_dir, "pages"))


@_query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op8_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query(linetemplates.OP9_SQL)
def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linetemplates.op9_line_templates(_table(spark, sf_dir, "documents"))


@_query()
def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenids.op10_token_ids(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.op11_token_alignment(_table(spark, sf_dir, "documents"), *paths)


@_query()
def op12_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.op12_katz_scores(_table(spark, sf_dir, "documents"))


@_query(hardnegatives.OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardnegatives.op13_hard_negatives(_table(spark, sf_dir, "embeddings"))
