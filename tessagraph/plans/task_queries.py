"""Queries on trained models and housekeeping; their results are not SQL's to express, or follow from the library's learners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessagraph.graph import graph_of_tables
from tessagraph.operators import learning as L
from tessagraph.operators import models as D
from tessagraph.operators.loading import typed_graph
from tessagraph.operators.retrieval import property_starts, vertex_details
from tessagraph.plans.graph_sql import E
from tessagraph.plans.retrieval_queries import SCHEMA
from tessagraph.schema import GraphSchema, PropertyKey, VertexLabel, schema_of_dict
from tessagraph.session import checkpoint, table
from tessagraph.sources.datasets import graph_collection


def _nodes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Embeddings as nodes, and edges between neighbours by id and label."""
    n = table(spark, d, "embeddings").select(F.col("vec_id").alias("node"), F.col("embedding").alias("feat"), "label")
    e = n.select(F.col("node").alias("src"), "label").withColumn("dst", F.lead("src").over(Window.partitionBy("label").orderBy("src"))).filter("dst is not null").select("src", "dst")
    return n, checkpoint(L.bidirected(e))


def mdl_node_classifier(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy on the rows that were not trained on, with propagated features."""
    n, e = _nodes(spark, d)
    f = D.Features("powers", 1).make(n.select("node", "feat"), e, 64)
    return D.node_classifier(f, n.select("node", "label"), L.arithmetic_hash(F.col("node"), 3) < 700_000, rounds=20)[1]


def mdl_weighted_detector(spark: SparkSession, d: str) -> DataFrame:
    n, e = _nodes(spark, d)
    return D.weighted_detector(n.select("node", "feat"), n.select("node", (F.col("label") == 0).cast("int").alias("label")), L.arithmetic_hash(F.col("node"), 3) < 700_000, 20)[1]


def mdl_link_scores(spark: SparkSession, d: str) -> DataFrame:
    n, e = _nodes(spark, d)
    s = D.link_scores(n.select("node", "feat"), e.filter("src < dst").select(F.col("src").alias("a"), F.col("dst").alias("b")))
    return s.select("a", "b", F.round("score", 6).alias("score"))


def mdl_walk_embeddings(spark: SparkSession, d: str) -> DataFrame:
    g = graph_of_tables(spark, d).restrict(["knows", "created"])
    w = L.random_walks(g.undirected, g.vertices.filter("label = 'software'").select(F.col("id").alias("source")), 4, 8)
    return D.walk_embeddings(w, 16)


def ddl_schema(spark: SparkSession, d: str) -> DataFrame:
    """The keys and labels of a declared schema."""
    return schema_of_dict(SCHEMA).to_df(spark).select("kind", "name")


def ddl_primary_key_ids(spark: SparkSession, d: str) -> DataFrame:
    """Vertices whose id is what the declared primary keys of their label say."""
    v = graph_of_tables(spark, d).vertices
    schema = GraphSchema()
    for p in v.columns[2:]:
        schema.create(PropertyKey(p))
    keyed = table(spark, d, "vertexlabels").filter(F.size("primary_keys") > 0).collect()  # schema, a handful of rows
    own = F.lit(None).cast("string")
    for r in keyed:
        schema.create(VertexLabel(r.label, tuple(v.columns[2:]), tuple(r.primary_keys), id=r.label_id))
        own = F.when(F.col("label") == r.label, schema.vertex_id(r.label)).otherwise(own)
    return v.filter(own.isNotNull()).groupBy("label", (own == F.col("id")).alias("agrees")).agg(F.count("*").alias("n"))


def ddl_single_edges(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of endpoints with more than one edge of a label that should have one."""
    return graph_of_tables(spark, d).edge_multiplicity("created")


def dml_edge_properties(spark: SparkSession, d: str) -> DataFrame:
    """Partners' edges after a city was set on those with an id below 500 and the weight taken off those above 1000."""
    g = graph_of_tables(spark, d).restrict(["partners"])
    some = lambda c: [r.id for r in g.edges.filter(c).select("id").collect()]  # noqa: E731  # as a user names them
    g = g.append_edge_properties(some("id < 500"), {"city": F.lit("Newtown")}).eliminate_edge_properties(some("id > 1000"), ["weight"])
    return g.edges.groupBy("city", F.col("weight").isNull().alias("bare")).agg(F.count("*").alias("edges"))


def src_collection(spark: SparkSession, d: str) -> DataFrame:
    """The feature vertices as a collection of graphs, one per label, with edges between vertices that follow each other."""
    f = table(spark, d, "feat_vertices").select(F.col("vertex_label").alias("graph_id"), F.col("vertex_id").alias("node"), "feat").filter("graph_id is not null")
    e = f.select("graph_id", F.col("node").alias("src"), (F.col("node") + 1).alias("dst"))
    v, e, _ = graph_collection(f, e, f.select("graph_id", F.lit(0).alias("class")).distinct())
    return v.groupBy("graph_id").agg(F.count("*").alias("nodes")).join(e.groupBy("graph_id").agg(F.count("*").alias("edges")), "graph_id", "left").fillna(0, ["edges"])


def kg_typed_graph(spark: SparkSession, d: str) -> DataFrame:
    """Typed triples of who created what, read into vertices and edges; the ends of every edge are vertices."""
    e = graph_of_tables(spark, d).edges.filter("label = 'created'")
    safe = lambda c: F.regexp_replace(c, r"[^\p{L}\p{N}:]", "_")
    x = e.select(F.concat(F.lit("("), safe("src"), F.lit(", created, "), safe("dst"), F.lit(") - created")).alias("text"))
    v, links = typed_graph(x, schema_of_dict(SCHEMA))
    return v.groupBy("label").agg(F.count("*").alias("n")).unionByName(links.groupBy("label").agg(F.count("*").alias("n")))


def rag_property_starts(spark: SparkSession, d: str) -> DataFrame:
    """Vertices of which a property is one of the industries and cities of companies, as questions by industry."""
    v = graph_of_tables(spark, d).vertices
    k = v.filter("label = 'company' and industry is not null and city is not null").select(F.length("industry").cast("bigint").alias("q"), F.explode(F.array("industry", "city")).alias("keyword")).distinct()
    return property_starts(k, v, ["industry", "city"]).groupBy("q").agg(F.count("*").alias("vertices"))


def rag_vertex_details(spark: SparkSession, d: str) -> DataFrame:
    """The first 20 companies of one industry with their names and cities."""
    v = graph_of_tables(spark, d).vertices
    x = vertex_details(v, v.filter("industry = 'Energy'").select("id"))
    return x.select("id", "label", F.col("properties.name").alias("name"), F.col("properties.city").alias("city"))


QUERIES = {f.__name__: f for f in (mdl_node_classifier, mdl_weighted_detector, mdl_link_scores, mdl_walk_embeddings, ddl_schema, ddl_primary_key_ids, ddl_single_edges, dml_edge_properties, src_collection, kg_typed_graph, rag_property_starts, rag_vertex_details)}
_E = "WITH RECURSIVE " + E + " "
_KINDS = [("property_keys", sorted({p for x in (*SCHEMA["vertexlabels"], *SCHEMA["edgelabels"]) for p in x["properties"]})), ("vertex_labels", [x["name"] for x in SCHEMA["vertexlabels"]]), ("edge_labels", [x["name"] for x in SCHEMA["edgelabels"]])]
SQL = {
    "ddl_schema": "SELECT kind, name FROM (VALUES " + ", ".join(f"('{k}', '{n}')" for k, names in _KINDS for n in names) + ") t(kind, name)",
    "dml_edge_properties": _E + "SELECT CASE WHEN id < 500 THEN 'Newtown' ELSE city END AS city, (id > 1000 OR weight IS NULL) AS bare, count(*) AS edges FROM e WHERE label = 'partners' GROUP BY ALL",
    "src_collection": "WITH f AS (SELECT DISTINCT vertex_label AS graph_id, vertex_id AS n FROM feat_vertices WHERE vertex_label IS NOT NULL) SELECT a.graph_id, count(*) AS nodes, count(b.n) AS edges FROM f a LEFT JOIN f b ON b.graph_id = a.graph_id AND b.n = a.n + 1 GROUP BY a.graph_id",
    "kg_typed_graph": _E + r", t AS (SELECT DISTINCT regexp_replace(src, '[^\p{L}\p{N}:]', '_', 'g') AS s, regexp_replace(dst, '[^\p{L}\p{N}:]', '_', 'g') AS o FROM e WHERE label = 'created') SELECT 'person' AS label, count(DISTINCT s) AS n FROM t UNION ALL SELECT 'software', count(DISTINCT o) FROM t UNION ALL SELECT 'created', count(*) FROM t",
    "rag_property_starts": _E + ", k AS (SELECT DISTINCT length(industry) AS q, unnest([industry, city]) AS k FROM v WHERE label = 'company' AND industry IS NOT NULL AND city IS NOT NULL) SELECT q, count(DISTINCT id) AS vertices FROM k JOIN v ON k IN (v.industry, v.city) GROUP BY q",
    "rag_vertex_details": _E + "SELECT id, label, name, city FROM v WHERE industry = 'Energy' ORDER BY id LIMIT 20",
    "mdl_link_scores": "WITH n AS (SELECT vec_id, embedding AS f, lead(vec_id) OVER (PARTITION BY label ORDER BY vec_id) AS nx FROM embeddings) SELECT a.vec_id AS a, b.vec_id AS b, round(list_sum(list_transform(range(1, 65), lambda i: CAST(a.f[i] AS DOUBLE) * b.f[i])), 6) AS score FROM n a JOIN embeddings b0 ON b0.vec_id = a.nx JOIN n b ON b.vec_id = a.nx",
    "ddl_primary_key_ids": _E + "SELECT label, id = CASE label WHEN 'person' THEN '1:' || concat_ws('!', name, birthDate) WHEN 'software' THEN '2:' || name ELSE '5:' || concat_ws('!', name, establishmentYear, city) END AS agrees, count(*) AS n FROM v WHERE label IN ('person', 'software', 'company') GROUP BY ALL",
    "ddl_single_edges": _E + "SELECT src, dst, count(*) AS n FROM e WHERE label = 'created' GROUP BY ALL HAVING count(*) > 1",
}
