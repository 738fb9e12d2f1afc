"""python -m tessagraph.llm.recall DIRECTORY: recall of the 10 nearest of feat_vertices against an exact search.

Asked are the rows whose id is divisible by 50, against all rows; exact copies are told apart by their ids.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.llm.neighbours import GraphRule, nearest_vectors, unit_vectors
from tessagraph.operators.vectors import search_many
from tessagraph.session import table


def exact_neighbours(df: DataFrame, id_col: str, vec_col: str, k: int, dim: int, each: int = 50) -> DataFrame:
    """(id, other, similarity): the k nearest other rows of each row whose id is divisible by `each`, by matrix products."""
    u = unit_vectors(df, id_col, vec_col, dim)
    top = search_many(u, "id", "unit", u.filter(F.col("id") % each == 0), "id", k + 1, metric="cosine").filter("query <> id")
    return top.select(F.col("query").alias("id"), F.col("id").alias("other"), (1 - F.col("distance")).alias("similarity"))


def recall(df: DataFrame, id_col: str, vec_col: str, k: int = 10, dim: int = 64, rule: GraphRule = GraphRule(), each: int = 50) -> float:
    """Share of the exact neighbours' similarities that `nearest_vectors` reaches, ties counted as found."""
    got = nearest_vectors(df, id_col, vec_col, k, dim, rule).filter(F.col("id") % each == 0)
    want = exact_neighbours(df, id_col, vec_col, k, dim, each)
    limit = want.groupBy("id").agg(F.element_at(F.sort_array(F.collect_list("similarity"), asc=False), F.least(F.lit(k), F.count("*")).cast("int")).alias("least"), F.least(F.lit(k), F.count("*")).alias("n"))
    hits = got.join(limit, "id").filter(F.col("similarity") >= F.col("least") - 1e-9).groupBy("id").agg(F.count("*").alias("hits"))
    r = limit.join(hits, "id", "left").agg(F.sum(F.coalesce("hits", F.lit(0))).alias("h"), F.sum("n").alias("n")).first()
    return r.h / r.n if r.n else 1.0


if __name__ == "__main__":
    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "16").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    t = time.time()
    print(f"recall {recall(table(spark, sys.argv[1], 'feat_vertices'), 'vertex_id', 'feat'):.4f} in {time.time() - t:.0f} s")
