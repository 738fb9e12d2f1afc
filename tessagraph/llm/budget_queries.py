"""Queries on containers and mixtures, in tokens of a public tokenizer, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessagraph.llm.mixing import mix_sources
from tessagraph.llm.packing import pack
from tessagraph.llm.tokens import with_token_counts
from tessagraph.session import table


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return pack(with_token_counts(table(spark, sf_dir, "documents"), "text", {"doc_id": "id"}), table(spark, sf_dir, "pack_sizes"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or piece of one, for each capacity."""
    return _packed(spark, sf_dir)[0].withColumnRenamed("id", "doc_id")


def p7_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, space used and the lower bound for each capacity."""
    return _packed(spark, sf_dir)[1]


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mix_sources(with_token_counts(table(spark, sf_dir, "documents"), "text", {"doc_id": "id", "source": "source"}), table(spark, sf_dir, "mix_targets"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn, in order of their training position."""
    return _mixed(spark, sf_dir)[0].withColumnRenamed("id", "doc_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's target and actual share of the tokens."""
    return _mixed(spark, sf_dir)[1]


QUERIES = {"p7_containers": p7_containers, "p7_summary": p7_summary, "p8_mix": p8_mix, "p8_shares": p8_shares}
SQL: dict[str, str] = {}
