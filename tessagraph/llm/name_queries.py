"""Queries on variant spellings of persons and companies, over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.llm.names import entity_pairs, link_names
from tessagraph.session import table


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "vertices").filter(F.col("label").isin("person", "company"))
    p = F.col("properties")
    field = F.when(F.col("label") == "person", p.birthDate.cast("string")).otherwise(F.concat_ws("|", F.nullif(p.establishmentYear.cast("string"), F.lit("")), p.city))
    field = F.when((F.col("label") == "person") | (p.establishmentYear.isNotNull() & p.city.isNotNull()), field)
    return link_names(v.select("id", F.col("label").alias("kind"), p["name"].alias("name"), field.alias("field"), p.city.alias("place"), p.industry.alias("hint")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of vertices that are one person or company."""
    return entity_pairs(_linked(spark, sf_dir))


def p3_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vertex with its entity, and the vertices of that entity."""
    linked = _linked(spark, sf_dir)
    return linked.join(linked.groupBy("entity").agg(F.count("*").alias("vertices")), "entity").select("id", "entity", "vertices")


QUERIES = {"p3_found": p3_found, "p3_entities": p3_entities}
SQL: dict[str, str] = {}
