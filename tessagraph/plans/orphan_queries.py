"""Queries on orphan references and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.operators.orphans import Orphans, graph_orphans
from tessagraph.session import table


def _orphans(spark: SparkSession, sf_dir: str) -> Orphans:
    t = lambda n: table(spark, sf_dir, n)
    return graph_orphans(t("edges"), [t("vertices"), t("base_vertices")], t("vertex_removals"), t("vertexlabels"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per orphan endpoint of an edge, with its reason."""
    return _orphans(spark, sf_dir).rows().select("edge_id", "endpoint", "reason")


def p2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references per endpoint label and month of the edge's loaded_at."""
    return _orphans(spark, sf_dir).counts().withColumn("month", F.date_format("period", "yyyy-MM")).drop("period")


_SQL = r"""
WITH ends AS (
  SELECT DISTINCT edge_id, 'outV' AS endpoint, outVLabel AS ref_label, regexp_replace(outV, '^\s+|\s+$', '', 'g') AS v, loaded_at AS t FROM edges WHERE outV IS NOT NULL
  UNION
  SELECT DISTINCT edge_id, 'inV', inVLabel, regexp_replace(inV, '^\s+|\s+$', '', 'g'), loaded_at FROM edges WHERE inV IS NOT NULL),
refs AS (
  SELECT e.*, CASE WHEN l.label IS NOT NULL AND starts_with(v, l.label || ':') THEN l.label_id || substr(v, length(l.label) + 1) ELSE v END AS ref_id
  FROM ends e LEFT JOIN vertexlabels l ON e.ref_label = l.label AND len(l.primary_keys) > 0),
loads AS (
  SELECT DISTINCT id, label, loaded_at AS ts FROM (SELECT id, label, loaded_at FROM vertices UNION ALL SELECT id, label, loaded_at FROM base_vertices)),
first AS (SELECT id, label, min(ts) AS first_load FROM loads GROUP BY ALL),
events AS (
  SELECT id, label, ts, 1 AS is_load FROM loads
  UNION ALL SELECT DISTINCT vertex_id, label, removed_at, 0 FROM vertex_removals),
last AS (
  SELECT r.edge_id, r.endpoint, arg_max(e.is_load, (e.ts, e.is_load)) AS is_load
  FROM refs r JOIN events e ON e.id = r.ref_id AND e.label = r.ref_label AND e.ts <= r.t GROUP BY ALL),
orphans AS (
  SELECT r.edge_id, r.endpoint, r.ref_label, r.t,
    CASE WHEN f.first_load IS NULL THEN 'missing' WHEN f.first_load > r.t THEN 'late' WHEN l.is_load = 0 THEN 'deleted' END AS reason
  FROM refs r LEFT JOIN first f ON f.id = r.ref_id AND f.label = r.ref_label LEFT JOIN last l ON l.edge_id = r.edge_id AND l.endpoint = r.endpoint)
"""

QUERIES = {"p2_found": p2_found, "p2_counts": p2_counts}
SQL = {
    "p2_found": _SQL + "SELECT DISTINCT edge_id, endpoint, reason FROM orphans WHERE reason IS NOT NULL",
    "p2_counts": _SQL + "SELECT ref_label, endpoint, strftime(t, '%Y-%m') AS month, reason, count(DISTINCT (edge_id, endpoint)) AS orphans FROM orphans WHERE reason IS NOT NULL GROUP BY ALL",
}
