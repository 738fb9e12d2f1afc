"""Queries on most similar vectors, over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.llm.neighbours import nearest_vectors
from tessagraph.session import table


def p6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 most similar vertices of every vertex with a usable feature."""
    return nearest_vectors(table(spark, sf_dir, "feat_vertices"), "vertex_id", "feat").select(F.col("id").alias("vertex_id"), "rank", F.col("other").alias("neighbour_id"), F.round("similarity", 6).alias("similarity"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of vertices with a cosine similarity of at least 0.9, one among the other's 10 most similar."""
    near = nearest_vectors(table(spark, sf_dir, "feat_vertices"), "vertex_id", "feat").filter("similarity >= 0.9")
    return near.select(F.least("id", "other").alias("vertex_id_a"), F.greatest("id", "other").alias("vertex_id_b")).distinct()


QUERIES = {"p6_found": p6_found, "p6_neighbours": p6_neighbours}
SQL = {
    "p6_found": """
WITH u AS (SELECT vertex_id, CAST(feat AS DOUBLE[64]) AS f FROM feat_vertices WHERE len(feat) = 64 AND len(list_filter(feat, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(feat, lambda x: x <> 0)) > 0),
s AS (SELECT a.vertex_id AS a, b.vertex_id AS b, array_cosine_similarity(a.f, b.f) AS sim FROM u a JOIN u b ON a.vertex_id <> b.vertex_id),
t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) <= 10)
SELECT DISTINCT least(a, b) AS vertex_id_a, greatest(a, b) AS vertex_id_b FROM t WHERE sim >= 0.9""",
}
