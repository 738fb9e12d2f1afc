import __spark_entry__ as entry
import pytest

from tessagraph.operators.learning import arithmetic_hash
from tessagraph.plans import gremlin_queries, traversal_queries
from tessagraph.sources import datasets as D
from pyspark.sql import functions as F


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p2_found", *gremlin_queries.QUERIES, *traversal_queries.QUERIES} <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["ref_label", "endpoint", "reason", "orphans", "month"] and df.count() > 0


def test_datasets(spark, tmp_path):
    g = D.movie_graph(spark)
    nodes, edges = D.heterogeneous(g, ["name"])
    assert {k: v.count() for k, v in nodes.items()} == {"Person": 2, "Movie": 3}
    assert {(r.src_idx, r.dst_idx) for r in edges[("Person", "ActedIn", "Movie")].collect()} == {(0, 0), (0, 1), (1, 1), (1, 2)}
    n = D.with_masks(spark.range(100).select(F.col("id").cast("string").alias("id"), F.array(F.lit(1.0)).alias("feat"), (F.col("id") % 3).alias("label"), "id").toDF("id", "feat", "label", "n"), arithmetic_hash(F.col("n"), 1) / 1_000_003)
    e = spark.createDataFrame([("1", "2"), ("2", "1"), ("2", "2"), ("5", "none")], "src string, dst string")
    a, b = D.homogeneous(n, e)
    assert a.columns == ["idx", "feat", "label", *D.MASKS] and b.count() == 3
    assert a.agg(F.sum(F.col("train_mask") + F.col("val_mask") + F.col("test_mask"))).first()[0] == 100
    assert [tuple(r) for r in D.undirected_ids(e).filter("b <> 'none'").collect()] == [("1", "2")]
    with pytest.raises(ValueError):
        D.homogeneous(n.unionByName(n.withColumn("feat", F.array(F.lit(1.0), F.lit(2.0)))), e)
    for name, text in (("f", "id,x,y\n1,2,3\n2,4,5\n"), ("l", "id,c\n1,0\n"), ("e", "u,v\n1,2\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    nodes, edges = D.read_table_graph(spark, *[str(tmp_path / f"{x}.csv") for x in "fle"])
    assert {r.id: (r.feat, r["class"]) for r in nodes.collect()} == {"1": ([2.0, 3.0], 0), "2": ([4.0, 5.0], None)} and edges.count() == 1
