"""Queries on loading, retrieval and streams, and the same in SQL."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.functions.models import embed, hashing_embedder
from tessagraph.graph import graph_of_tables
from tessagraph.operators import loading as L
from tessagraph.operators import retrieval as R
from tessagraph.operators.vectors import search_many
from tessagraph.plans.graph_sql import E, V
from tessagraph.schema import schema_of_dict
from tessagraph.session import checkpoint, checkpoint_dir, table

SCHEMA = {
    "vertexlabels": [{"name": "person", "properties": ["name", "age", "city"], "primary_keys": ["name"], "nullable_keys": ["city"]}, {"name": "software", "properties": ["name", "price"], "primary_keys": ["name"]}],
    "edgelabels": [{"name": "created", "source_label": "person", "target_label": "software", "properties": ["date"]}],
    "propertykeys": [{"name": "age", "data_type": "INT"}, {"name": "price", "data_type": "INT"}],
}


def kg_triples(spark: SparkSession, d: str) -> DataFrame:
    """Predicates of triples written out as text and read again."""
    e = graph_of_tables(spark, d).edges.filter("label in ('created', 'knows') and not contains(src, '(') and not contains(dst, '(') and not contains(src, ', ') and not contains(dst, ', ')")
    x = e.select(F.concat(F.lit("say ("), "src", F.lit(", "), "label", F.lit(", "), "dst", F.lit(")")).alias("text"))
    return x.select(F.inline(L.triples(F.col("text")))).groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("s").alias("subjects"))


def _loaded(spark: SparkSession, d: str):
    v = graph_of_tables(spark, d).vertices
    rows = v.select("id", "label", F.map_filter(F.create_map(F.lit("name"), F.col("name"), F.lit("age"), F.col("age").cast("string"), F.lit("price"), F.when(F.col("price") % 7 == 0, "much").otherwise(F.col("price").cast("string")), F.lit("city"), F.col("city")), lambda k, x: x.isNotNull()).alias("properties"))
    return L.load_vertices(rows, schema_of_dict(SCHEMA))


def kg_load_vertices(spark: SparkSession, d: str) -> DataFrame:
    v, _, _ = _loaded(spark, d)
    p = F.col("properties")
    return v.select("id", "label", p["age"].alias("age"), p["price"].alias("price"))


def kg_load_rejected(spark: SparkSession, d: str) -> DataFrame:
    return _loaded(spark, d)[2].groupBy("label", "why").agg(F.count("*").alias("n"))


def kg_long_ids(spark: SparkSession, d: str) -> DataFrame:
    from tessagraph.functions.text import short_ids

    return short_ids(graph_of_tables(spark, d).vertices, "id", 256).groupBy("label").agg(F.count("*").alias("n"))


def _keywords(spark: SparkSession, d: str) -> DataFrame:
    """A question for each software of a low price: its name, and a word that names nothing."""
    v = graph_of_tables(spark, d).vertices.filter("label = 'software' and price < 60")
    return v.select(F.col("price").cast("bigint").alias("q"), F.explode(F.array("name", F.concat("name", F.lit("zz")))).alias("keyword")).distinct()


def rag_exact_match(spark: SparkSession, d: str) -> DataFrame:
    return R.exact_matches(_keywords(spark, d), graph_of_tables(spark, d).vertices, 5)[0]


def rag_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return R.exact_matches(_keywords(spark, d), graph_of_tables(spark, d).vertices, 5)[1]


def rag_fuzzy_match(spark: SparkSession, d: str) -> DataFrame:
    """Nearest stored embeddings of the rows with an id divisible by 50, themselves left out."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    q = e.filter("id % 50 = 0").withColumnRenamed("id", "query")
    x = R.fuzzy_matches(q, e, 2, 2.0).filter("query <> id")
    return x.select("query", "id", F.round("distance", 6).alias("distance"))


def _paths(spark: SparkSession, d: str):
    g = graph_of_tables(spark, d)
    s = g.vertices.filter("label = 'software'").select(F.col("price").cast("bigint").alias("q"), "id")
    return g, checkpoint(R.expand(g, s))


def rag_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths around all software over all labels, with the limits of `expand`: 40 edges from a vertex, 30 paths a start."""
    x = _paths(spark, d)[1]
    return x.select("q", "start", "path_no", F.array_join(F.transform("path", lambda n: n.vertex), ">").alias("vertices"))


def rag_path_texts(spark: SparkSession, d: str) -> DataFrame:
    g, p = _paths(spark, d)
    return R.path_texts(g, p)


def rag_depth_sets(spark: SparkSession, d: str) -> DataFrame:
    return R.depth_sets(_paths(spark, d)[1]).select("q", "depth", F.array_join("vertices", ",").alias("vertices"))


def rag_merge(spark: SparkSession, d: str) -> DataFrame:
    """Graph texts and similar documents of each question by quota, reranked by BLEU."""
    g, p = _paths(spark, d)
    graph = R.path_texts(g, p).select("q", F.lit("graph").alias("source"), "text")
    questions = g.vertices.filter("label = 'software'").groupBy(F.col("price").cast("bigint").alias("q")).agg(F.concat(F.lit("which worker created the tool "), F.min("name")).alias("question"))
    docs = table(spark, d, "documents")
    vec = hashing_embedder()
    near = search_many(docs.select("doc_id", embed(F.col("text"), vec).alias("vec")), "doc_id", "vec", questions.select("q", embed(F.col("question"), vec).alias("vec")), "q", 5)
    vector = near.join(docs.select(F.col("doc_id").alias("id"), "text"), "id").select(F.col("query").alias("q"), F.lit("vector").alias("source"), "text")
    return R.merge_rerank(questions, graph.unionByName(vector), 6, 0.5)


def str_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events and users per day and type, as a stream over the events table that ends when all is read (an extension)."""
    from tessagraph.streaming.streams import windowed_degrees

    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    out = f"{checkpoint_dir(spark)}/stream-{next(tempfile._get_candidate_names())}"
    q = windowed_degrees(stream, "36500 days").writeStream.format("memory").queryName(f"w{abs(hash(out))}").outputMode("complete").option("checkpointLocation", out).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(q.name).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "events")


QUERIES = {f.__name__: f for f in (kg_triples, kg_load_vertices, kg_load_rejected, kg_long_ids, rag_exact_match, rag_unmatched, rag_fuzzy_match, rag_paths, rag_path_texts, rag_depth_sets, rag_merge, str_windows)}

_E, _V = "WITH RECURSIVE " + E, "WITH " + V
_K = _V + ", k AS (SELECT DISTINCT CAST(price AS BIGINT) AS q, unnest([name, name || 'zz']) AS keyword FROM v WHERE label = 'software' AND price < 60), h AS (SELECT q, keyword, v.id FROM k JOIN v ON v.id IN (keyword, '1:' || keyword, '2:' || keyword, '3:' || keyword, '4:' || keyword, '5:' || keyword) QUALIFY row_number() OVER (PARTITION BY q ORDER BY v.id, keyword) <= 8)"
_P = _E + """, a AS (SELECT src, dst, id, false AS back FROM e UNION ALL SELECT dst, src, id, true FROM e WHERE src <> dst),
c AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY src ORDER BY id, back) <= 40),
st AS (SELECT DISTINCT CAST(price AS BIGINT) AS q, id AS start FROM v WHERE label = 'software'),
one AS (SELECT q, start, [start, c.dst] AS p, [NULL, c.id] AS es FROM st JOIN c ON c.src = start WHERE c.dst <> start),
two AS (SELECT q, start, list_append(p, c.dst) AS p, list_append(es, c.id) AS es FROM one JOIN c ON c.src = p[2] WHERE NOT list_contains(p, c.dst)),
pth AS (SELECT *, row_number() OVER (PARTITION BY q, start ORDER BY len(p), p, es) AS path_no FROM (FROM one UNION ALL FROM two) QUALIFY path_no <= 30)"""
SQL = {
    "kg_triples": _E + " SELECT label AS p, count(*) AS n, count(DISTINCT src) AS subjects FROM e WHERE label IN ('created', 'knows') AND NOT contains(src, '(') AND NOT contains(dst, '(') AND NOT contains(src, ', ') AND NOT contains(dst, ', ') GROUP BY label",
    "kg_load_vertices": _V + " SELECT '1:' || name AS id, label, max(coalesce(CAST(age AS VARCHAR), '0')) AS age, NULL AS price FROM v WHERE label = 'person' GROUP BY name, label UNION ALL SELECT '2:' || name, label, NULL, max(CAST(price AS VARCHAR)) FROM v WHERE label = 'software' AND (price IS NULL OR price % 7 <> 0) GROUP BY name, label",
    "kg_load_rejected": _V + " SELECT label, CASE WHEN label = 'software' THEN 'type' ELSE 'label' END AS why, count(*) AS n FROM v WHERE label NOT IN ('person', 'software') OR (label = 'software' AND price % 7 = 0) GROUP BY ALL",
    "kg_long_ids": _V + " SELECT label, count(*) AS n FROM v WHERE strlen(id) < 256 GROUP BY label",
    "rag_exact_match": _K + " SELECT * FROM h",
    "rag_unmatched": _K + " SELECT q, keyword FROM k WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.q = k.q AND contains(h.id, k.keyword))",
    "rag_fuzzy_match": "WITH t AS (SELECT q.vec_id AS query, e.vec_id AS id, list_sum(list_transform(range(1, 65), lambda i: (CAST(q.embedding[i] AS DOUBLE) - e.embedding[i]) ** 2)) AS d FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0), r AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY query ORDER BY round(d, 12), id) <= 2) SELECT query, id, round(d, 6) AS distance FROM r WHERE d < 2 AND query <> id",
    "rag_paths": _P + " SELECT q, start, path_no, array_to_string(p, '>') AS vertices FROM pth",
    "rag_depth_sets": _P + " SELECT q, CAST(i - 1 AS INT) AS depth, string_agg(DISTINCT p[i], ',' ORDER BY p[i]) AS vertices FROM pth, LATERAL (SELECT unnest(range(1, len(p) + 1)) AS i) GROUP BY q, i",
    "str_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS events FROM events GROUP BY ALL",
}
