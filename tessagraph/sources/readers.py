"""Files in and out: documents, question sheets, JSON graphs, edge lists, backups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.errors import ParseError
from tessagraph.graph import PropertyGraph
from tessagraph.operators.loading import ELEMENT, json_graph


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of text files, whole; other kinds need a parser that is not part of this package."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).filter(F.trim("text") != "")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(query, gremlin) of a CSV with quoted cells over several lines, or of a JSON list."""
    if path.endswith(".json"):
        return spark.read.json(path, schema="query string, gremlin string", multiLine=True)
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', schema="query string, gremlin string")


def read_json_graph(spark: SparkSession, text: str) -> DataFrame:
    """Elements of one JSON graph; ParseError if it isn't JSON or holds none."""
    import json

    try:
        json.loads(text)
    except ValueError as e:
        raise ParseError(f"no JSON: {e}") from None
    out = spark.createDataFrame([(text,)], "t string").select(F.inline(json_graph(F.col("t"))))
    if out.isEmpty():
        raise ParseError(f"no elements of {ELEMENT[:40]}")
    return out


def read_typed_edges(spark: SparkSession, path: str) -> DataFrame:
    """(label, src, dst) in both directions of lines 'type u v'."""
    p = F.split(F.trim("value"), r"\s+")
    e = spark.read.text(path).select(p[0].alias("label"), p[1].alias("src"), p[2].alias("dst")).filter("dst is not null")
    return e.unionByName(e.select("label", F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def write_graph(g: PropertyGraph, path: str) -> None:
    """Vertices and edges as parquet, partitioned by label."""
    g.vertices.write.mode("overwrite").partitionBy("label").parquet(f"{path}/vertices")
    g.edges.write.mode("overwrite").partitionBy("label").parquet(f"{path}/edges")


def read_graph(spark: SparkSession, path: str) -> PropertyGraph:
    return PropertyGraph(spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges"))


def backup(g: PropertyGraph, path: str, stamp: str, keep: int = 7, drop_ids: bool = False) -> list[str]:
    """Writes the whole graph as JSON lines below path/stamp, and deletes all but the newest `keep` stamps; the ones deleted."""
    (g.vertices.drop("id") if drop_ids else g.vertices).write.mode("overwrite").json(f"{path}/{stamp}/vertices")
    g.edges.write.mode("overwrite").json(f"{path}/{stamp}/edges")
    spark = g.vertices.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    stamps = sorted(s.getPath().getName() for s in fs.listStatus(p))
    old = stamps[: max(0, len(stamps) - keep)]
    for s in old:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{s}"), True)
    return old
