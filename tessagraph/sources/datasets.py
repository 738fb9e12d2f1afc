"""Graph-learning datasets into node and edge tables with dense numbers, features, labels and masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.errors import SchemaError
from tessagraph.graph import PropertyGraph
from tessagraph.operators.learning import convert_graph, dense_index

MASKS = ("train_mask", "val_mask", "test_mask")


def with_masks(nodes: DataFrame, order, train: float = 0.7, valid: float = 0.2) -> DataFrame:
    """`nodes` with 0/1 masks by a hash in 0..1."""
    part = {"train_mask": order < train, "val_mask": (order >= train) & (order < train + valid), "test_mask": order >= train + valid}
    return nodes.withColumns({k: c.cast("int") for k, c in part.items()})


def homogeneous(nodes: DataFrame, edges: DataFrame, feat: str = "feat", label: str = "label", masks: Sequence[str] = MASKS, edge_feat: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes (idx, feat, label, masks), edges (src_idx, dst_idx[, feat])) of nodes (id, ..) and edges (src, dst, ..).

    Masks that the nodes lack are left out; features must have one length.
    """
    lengths = nodes.filter(F.col(feat).isNotNull()).agg(F.min(F.size(feat)), F.max(F.size(feat))).first()
    if lengths[0] != lengths[1]:
        raise SchemaError(f"features of {lengths[0]} to {lengths[1]} numbers")
    n, e = convert_graph(nodes, edges)
    return n.select("idx", feat, label, *[m for m in masks if m in nodes.columns]), e.select("src_idx", "dst_idx", *([F.col(edge_feat).alias("feat")] if edge_feat else []))


def heterogeneous(g: PropertyGraph, features: Sequence[str] = ()) -> tuple[dict[str, DataFrame], dict[tuple[str, str, str], DataFrame]]:
    """Nodes (idx, features) per label and edges (src_idx, dst_idx) per (source label, label, target label), numbered per label."""
    n = dense_index(g.vertices.select("id", "label", *features), "id", ["label"])
    ids = n.select("id", "idx", F.col("label").alias("l"))
    e = g.edges.select("label", "src", "dst").join(ids.withColumnsRenamed({"id": "src", "idx": "src_idx", "l": "sl"}), "src").join(ids.withColumnsRenamed({"id": "dst", "idx": "dst_idx", "l": "dl"}), "dst")
    labels = [r.label for r in n.select("label").distinct().collect()]  # labels are schema, a handful
    kinds = [tuple(r) for r in e.select("sl", "label", "dl").distinct().collect()]
    return {x: n.filter(F.col("label") == x).select("idx", *features) for x in labels}, {k: e.filter((F.col("sl") == k[0]) & (F.col("label") == k[1]) & (F.col("dl") == k[2])).select("src_idx", "dst_idx") for k in kinds}


def undirected_ids(edges: DataFrame) -> DataFrame:
    """(a, b): each pair of neighbours once, loops left out."""
    return edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).filter("a <> b").distinct()


def read_table_graph(spark: SparkSession, features: str, labels: str, edges: str) -> tuple[DataFrame, DataFrame]:
    """(nodes (id, feat, class), edges (src, dst)) of CSV files with a header: features and labels by row, edges as two columns."""
    f = spark.read.csv(features, header=True, inferSchema=True)
    key, *cols = f.columns
    y = spark.read.csv(labels, header=True, inferSchema=True)
    e = spark.read.csv(edges, header=True, inferSchema=True)
    nodes = f.select(F.col(key).cast("string").alias("id"), F.array(*[F.col(c).cast("double") for c in cols]).alias("feat")).join(y.select(F.col(y.columns[0]).cast("string").alias("id"), F.col(y.columns[1]).alias("class")), "id", "left")
    return nodes, e.select(F.col(e.columns[0]).cast("string").alias("src"), F.col(e.columns[1]).cast("string").alias("dst"))


def movie_graph(spark: SparkSession) -> PropertyGraph:
    """A small sample: two persons, three movies, four edges."""
    v = [("p1", "Person", "Ada North", "1970-01-01"), ("p2", "Person", "Ben South", "1980-05-05"), ("m1", "Movie", "The Hill", None), ("m2", "Movie", "The Lake", None), ("m3", "Movie", "The Road", None)]
    e = [(1, "ActedIn", "p1", "m1"), (2, "ActedIn", "p1", "m2"), (3, "ActedIn", "p2", "m2"), (4, "ActedIn", "p2", "m3")]
    return PropertyGraph(spark.createDataFrame(v, "id string, label string, name string, birthDate string"), spark.createDataFrame(e, "id bigint, label string, src string, dst string"))


def graph_collection(nodes: DataFrame, edges: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A collection of graphs: (vertices (id, graph_id, label, feat), edges (id, label, src, dst, graph_id), graphs (graph_id, class)).

    nodes: (graph_id, node, feat), edges: (graph_id, src, dst), labels: (graph_id, class); node numbers count per graph, so that ids
    are 'graph-node'. Edges without both nodes are left out.
    """
    vid = lambda n: F.concat_ws("-", F.col("graph_id").cast("string"), F.col(n).cast("string"))
    v = nodes.select(vid("node").alias("id"), "graph_id", F.lit("node").alias("label"), "feat").dropDuplicates(["id"])
    e = edges.select(vid("src").alias("src"), vid("dst").alias("dst"), "graph_id").distinct()
    ids = v.select("id")
    e = e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return v, e.select(F.xxhash64("src", "dst").alias("id"), F.lit("edge").alias("label"), "src", "dst", "graph_id"), labels.select("graph_id", "class")
