"""Queries on scans, neighbourhoods, paths, cycles and ranks, and the same in SQL.

Start vertices are the smallest source of a label (one value read to the driver). Neighbourhoods and shortest paths run over all
labels; queries that list paths run over the labels knows and created, whose graph has no hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.graph import PropertyGraph, graph_of_tables
from tessagraph.operators import traversal as T
from tessagraph.plans.graph_sql import E, V, undirected

SOCIAL = ("knows", "created")


def _graph(spark: SparkSession, sf_dir: str, labels: tuple[str, ...] = SOCIAL) -> tuple[PropertyGraph, str]:
    g = graph_of_tables(spark, sf_dir)
    e = g.edges.filter(F.col("label").isin(*labels))
    return PropertyGraph(g.vertices, e), e.filter(F.col("label") == labels[0]).agg(F.min("src")).first()[0]


def _whole(spark: SparkSession, sf_dir: str) -> tuple[PropertyGraph, str]:
    """The graph with all labels, and the smallest source of knows."""
    g = graph_of_tables(spark, sf_dir)
    return g, g.edges.filter("label = 'knows'").agg(F.min("src")).first()[0]


def _text(df: DataFrame) -> DataFrame:
    return df.withColumn("path", F.array_join("path", ">"))


def scan_vertices(spark: SparkSession, d: str) -> DataFrame:
    return graph_of_tables(spark, d).scan_vertices("company", {"industry": "Energy"}).select("id", "name", "city", "establishmentYear")


def scan_vertices_page(spark: SparkSession, d: str) -> DataFrame:
    g = graph_of_tables(spark, d)
    return g.scan_vertices("person", page="1:M", limit=25).select("id", "name")


def scan_edges_by_vertex(spark: SparkSession, d: str) -> DataFrame:
    g = graph_of_tables(spark, d)
    hub = g.edges.groupBy("dst").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dst").first().dst
    return g.scan_edges("serve", hub, "IN").select("id", "src")


def graph_summary(spark: SparkSession, d: str) -> DataFrame:
    s = graph_of_tables(spark, d).summary()
    return s.select("vertex_num", "edge_num", F.size("vertices").cast("bigint").alias("ids"), F.array_join("edges", ",").alias("edges"))


def relations(spark: SparkSession, d: str) -> DataFrame:
    return graph_of_tables(spark, d).relations()


def degrees(spark: SparkSession, d: str) -> DataFrame:
    return graph_of_tables(spark, d).degrees


def remove_vertices(spark: SparkSession, d: str) -> DataFrame:
    g = graph_of_tables(spark, d)
    left = g.remove_vertices(g.vertices.filter("label = 'company' and industry = 'Energy'").select("id"))
    return left.edges.groupBy("label").agg(F.count("*").alias("edges"))


def k_out(spark: SparkSession, d: str) -> DataFrame:
    g, s = _whole(spark, d)
    return T.k_out(g.undirected, T.seeds(g.edges, [s]), 3)


def k_neighbor(spark: SparkSession, d: str) -> DataFrame:
    g, s = _whole(spark, d)
    return T.k_neighbor(g.undirected, T.seeds(g.edges, [s]), 4)


def k_neighbor_all(spark: SparkSession, d: str) -> DataFrame:
    """Every department's neighbourhood at once."""
    g = graph_of_tables(spark, d).restrict(["reports_to"])
    start = g.vertices.filter("label = 'department'").select(F.col("id").alias("source"))
    return T.k_neighbor(g.undirected, start, 2).groupBy("source", "depth").agg(F.count("*").alias("n"))


def same_neighbors(spark: SparkSession, d: str) -> DataFrame:
    g = graph_of_tables(spark, d)
    a, b = (r.src for r in g.edges.filter("label = 'serve'").groupBy("src").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "src").limit(2).collect())
    return T.same_neighbors(g.undirected, a, b)


def jaccard_top(spark: SparkSession, d: str) -> DataFrame:
    """The ten most similar persons by shared software, for every pair with a common one."""
    g = graph_of_tables(spark, d).restrict(["created"])
    x = T.jaccard_all(g.undirected).filter("a like '1:%'")
    return x.withColumn("jaccard", F.round("jaccard", 6)).orderBy(F.desc("jaccard"), F.desc("common"), "a", "b").limit(10)


def shortest_paths_from(spark: SparkSession, d: str) -> DataFrame:
    g, s = _whole(spark, d)
    return _text(T.single_source_shortest(g.undirected, T.seeds(g.edges, [s]), 4))


def shortest_path(spark: SparkSession, d: str) -> DataFrame:
    g, s = _whole(spark, d)
    t = T.k_out(g.undirected, T.seeds(g.edges, [s]), 4).agg(F.max("node")).first()[0]
    return _text(T.shortest_path(g.undirected, s, t, 5))


def all_shortest_paths(spark: SparkSession, d: str) -> DataFrame:
    g, s = _whole(spark, d)
    t = T.k_out(g.undirected, T.seeds(g.edges, [s]), 4).agg(F.max("node")).first()[0]
    return _text(T.all_shortest_paths(g.undirected, s, t, 5))


def weighted_paths(spark: SparkSession, d: str) -> DataFrame:
    """Least weights over partners within three steps."""
    g, s = _graph(spark, d, ("partners",))
    x = T.weighted_shortest(g.adjacency("BOTH", extra=["weight"]), T.seeds(g.edges, [s]), 3)
    return _text(x.withColumn("weight", F.round("weight", 6)))


def multi_node_paths(spark: SparkSession, d: str) -> DataFrame:
    g, s = _whole(spark, d)
    ids = [r.node for r in T.k_neighbor(g.undirected, T.seeds(g.edges, [s]), 2).select("node").orderBy("node").limit(4).collect()]
    return T.multi_node_shortest(g.undirected, ids, 4).select("source", "node", "weight")


def simple_paths(spark: SparkSession, d: str) -> DataFrame:
    g, s = _graph(spark, d)
    t = T.k_out(g.undirected, T.seeds(g.edges, [s]), 2).agg(F.max("node").alias("target"))
    return _text(T.paths(g.undirected, T.seeds(g.edges, [s]), t, 4))


def template_paths(spark: SparkSession, d: str) -> DataFrame:
    """knows, then created, then back along created, from every person."""
    g, _ = _graph(spark, d)
    start = g.vertices.filter("label = 'person'").select(F.col("id").alias("source"))
    return _text(T.customized_paths(g, start, [T.Step("OUT", ("knows",)), T.Step("OUT", ("created",)), T.Step("IN", ("created",))]).select("source", "path"))


def weighted_template(spark: SparkSession, d: str) -> DataFrame:
    g, s = _graph(spark, d, ("partners", "knows"))
    x = T.customized_paths(g, T.seeds(g.edges, [s]), [T.Step("BOTH", ("partners",), "weight"), T.Step("BOTH", ("partners",), "weight")], "INCR")
    return _text(x.select("path", F.round(F.aggregate("weights", F.lit(0.0), lambda a, w: a + w), 6).alias("weight")))


def crosspoints(spark: SparkSession, d: str) -> DataFrame:
    g, s = _graph(spark, d)
    t = T.k_out(g.undirected, T.seeds(g.edges, [s]), 2).agg(F.max("node")).first()[0]
    return _text(T.crosspoints(g.undirected, s, t, 4))


def rings(spark: SparkSession, d: str) -> DataFrame:
    """All rings of three or four steps over knows and created."""
    g, _ = _graph(spark, d)
    return _text(T.rings(g.undirected, g.vertices.filter("label = 'software'").select(F.col("id").alias("source")), 4))


def rays(spark: SparkSession, d: str) -> DataFrame:
    g, s = _graph(spark, d)
    return _text(T.rays(g.undirected, T.seeds(g.edges, [s]), 3))


def fusiform(spark: SparkSession, d: str) -> DataFrame:
    """Persons who share most of the software that another created, in at least two cities."""
    g, _ = _graph(spark, d)
    start = g.vertices.filter("label = 'person'").select(F.col("id").alias("source"))
    x = T.fusiform_similarity(g, start, "created", "OUT", 2, 0.5, 1, 5, "city", 2)
    return x.withColumn("score", F.round("score", 6))


def personal_rank(spark: SparkSession, d: str) -> DataFrame:
    g, s = _graph(spark, d, ("created",))
    return T.personal_rank(g, s, "created", max_depth=3, limit=50, with_label="OTHER_LABEL").select("node", F.round("rank", 6).alias("rank"))


def neighbor_rank(spark: SparkSession, d: str) -> DataFrame:
    g, s = _graph(spark, d)
    return T.neighbor_rank(g, s, [T.Step("OUT", ("knows",)), T.Step("OUT", ("created",)), T.Step("IN", ("created",))], top=1000).select("layer", "node", F.round("rank", 6).alias("rank"))


QUERIES = {f.__name__: f for f in (
    scan_vertices, scan_vertices_page, scan_edges_by_vertex, graph_summary, relations, degrees, remove_vertices, k_out, k_neighbor, k_neighbor_all, same_neighbors, jaccard_top, shortest_paths_from, shortest_path, all_shortest_paths,
    weighted_paths, multi_node_paths, simple_paths, template_paths, weighted_template, crosspoints, rings, rays, fusiform, personal_rank, neighbor_rank,
)}

_U, _ALL = undirected(SOCIAL), undirected(SOCIAL, every=True)
#: The nodes of each level with the smallest of their shortest paths.
_LEVELS = "l0 AS (SELECT s AS n, [s] AS p FROM s), " + ", ".join(f"l{i} AS (SELECT u.dst AS n, min(list_append(p, u.dst)) AS p FROM l{i - 1} JOIN u ON u.src = n WHERE u.dst NOT IN ({' UNION ALL '.join(f'SELECT n FROM l{j}' for j in range(i))}) GROUP BY u.dst)" for i in (1, 2, 3, 4))
_END = "t AS (SELECT max(n) AS t FROM l4)"
_BFS = "bfs(n, d) AS (SELECT s, 0 FROM s UNION SELECT u.dst, d + 1 FROM bfs JOIN u ON u.src = n WHERE d < {0}), least AS (SELECT n, min(d) AS d FROM bfs GROUP BY n)"
_WALK = "walk(p, n) AS (SELECT [s], s FROM s UNION ALL SELECT list_append(p, u.dst), u.dst FROM walk JOIN u ON u.src = n WHERE len(p) <= {0} AND NOT list_contains(p, u.dst))"
_T = ", t AS (SELECT max(n) AS t FROM least WHERE d = {0})"


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ", ".join(parts)


SQL = {
    "scan_vertices": _with(V) + " SELECT id, name, city, establishmentYear FROM v WHERE label = 'company' AND industry = 'Energy'",
    "scan_vertices_page": _with(V) + " SELECT id, name FROM v WHERE label = 'person' AND id > '1:M' ORDER BY id LIMIT 25",
    "scan_edges_by_vertex": _with(E) + " SELECT id, src FROM e WHERE label = 'serve' AND dst = (SELECT dst FROM e GROUP BY dst ORDER BY count(*) DESC, dst LIMIT 1)",
    "graph_summary": _with(E) + " SELECT (SELECT count(*) FROM v) AS vertex_num, (SELECT count(*) FROM e) AS edge_num, (SELECT least(count(*), 10000) FROM v) AS ids, (SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT id FROM e ORDER BY id LIMIT 200)) AS edges",
    "relations": _with(E) + " SELECT DISTINCT a.label || '--' || e.label || '-->' || b.label AS relation FROM e JOIN v a ON a.id = src JOIN v b ON b.id = dst",
    "degrees": _with(E) + " SELECT src AS id, count(*) AS degree FROM (SELECT src, dst FROM e UNION SELECT dst, src FROM e) GROUP BY src",
    "remove_vertices": _with(E) + ", gone AS (SELECT id FROM v WHERE label = 'company' AND industry = 'Energy') SELECT label, count(*) AS edges FROM e WHERE src NOT IN (FROM gone) AND dst NOT IN (FROM gone) GROUP BY label",
    "k_out": _with(_ALL, _LEVELS) + " SELECT s AS source, n AS node FROM l3, s",
    "k_neighbor": _with(_ALL, _LEVELS) + " SELECT s AS source, n AS node, d AS depth FROM (" + " UNION ALL ".join(f"SELECT n, {i} AS d FROM l{i}" for i in (1, 2, 3, 4)) + "), s",
    "k_neighbor_all": _with(undirected(("reports_to",)), "bfs(s0, n, d) AS (SELECT id, id, 0 FROM v WHERE label = 'department' UNION SELECT s0, u.dst, d + 1 FROM bfs JOIN u ON u.src = n WHERE d < 2), least AS (SELECT s0, n, min(d) AS d FROM bfs GROUP BY ALL)") + " SELECT s0 AS source, d AS depth, count(*) AS n FROM least WHERE d > 0 GROUP BY ALL",
    "same_neighbors": _with(E) + ", u AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), top AS (SELECT src FROM e WHERE label = 'serve' GROUP BY src ORDER BY count(*) DESC, src LIMIT 2) SELECT dst AS node FROM u WHERE src IN (FROM top) GROUP BY dst HAVING count(*) = 2",
    "jaccard_top": _with(undirected(("created",))) + ", deg AS (SELECT src, count(*) AS n FROM u GROUP BY src), c AS (SELECT x.dst AS a, y.dst AS b, count(*) AS common FROM u x JOIN u y ON x.src = y.src AND x.dst < y.dst WHERE x.dst LIKE '1:%' GROUP BY ALL) SELECT a, b, common, round(common / (p.n + q.n - common), 6) AS jaccard FROM c JOIN deg p ON p.src = a JOIN deg q ON q.src = b ORDER BY jaccard DESC, common DESC, a, b LIMIT 10",
    "shortest_paths_from": _with(_ALL, _LEVELS) + " SELECT s AS source, n AS node, CAST(len(p) - 1 AS DOUBLE) AS weight, array_to_string(p, '>') AS path FROM (" + " UNION ALL ".join(f"FROM l{i}" for i in (1, 2, 3, 4)) + "), s",
    "shortest_path": _with(_ALL, _LEVELS, _END) + " SELECT s AS source, t AS node, 4.0::DOUBLE AS weight, array_to_string(p, '>') AS path FROM l4 JOIN t ON n = t, s",
    "all_shortest_paths": _with(_ALL, _LEVELS, _END, "b3 AS (SELECT n FROM l3 WHERE n IN (SELECT src FROM u JOIN t ON dst = t))", "b2 AS (SELECT n FROM l2 WHERE n IN (SELECT src FROM u WHERE dst IN (FROM b3)))", "b1 AS (SELECT n FROM l1 WHERE n IN (SELECT src FROM u WHERE dst IN (FROM b2)))") + " SELECT array_to_string([s, b1.n, b2.n, b3.n, t], '>') AS path FROM s, t, b1 JOIN u x ON x.src = b1.n JOIN b2 ON b2.n = x.dst JOIN u y ON y.src = b2.n JOIN b3 ON b3.n = y.dst",
    "weighted_paths": _with(undirected(("partners",)), "st AS (SELECT src, dst, min(w) AS w FROM (SELECT src, dst, coalesce(weight, 1.0) AS w FROM e WHERE label = 'partners' UNION ALL SELECT dst, src, coalesce(weight, 1.0) FROM e WHERE label = 'partners') GROUP BY ALL)", "walk(p, n, w) AS (SELECT [s], s, 0.0::DOUBLE FROM s UNION ALL SELECT list_append(p, st.dst), st.dst, walk.w + st.w FROM walk JOIN st ON st.src = n WHERE len(p) <= 3 AND NOT list_contains(p, st.dst))") + " SELECT s AS source, n AS node, round(w, 6) AS weight, array_to_string(p, '>') AS path FROM walk, s WHERE n <> s QUALIFY row_number() OVER (PARTITION BY n ORDER BY w, p) = 1",
    "multi_node_paths": _with(_ALL, _LEVELS, "top AS (SELECT n FROM (FROM l1 UNION ALL FROM l2) ORDER BY n LIMIT 4)", "b2(s0, n, d) AS (SELECT n, n, 0 FROM top UNION SELECT s0, u.dst, d + 1 FROM b2 JOIN u ON u.src = n WHERE d < 4)") + " SELECT s0 AS source, n AS node, CAST(min(d) AS DOUBLE) AS weight FROM b2 WHERE n IN (FROM top) AND s0 < n GROUP BY ALL",
    "simple_paths": _with(_U, _BFS.format(2) + _T.format(2), _WALK.format(4)) + " SELECT s AS source, t AS target, array_to_string(p, '>') AS path FROM walk, s, t WHERE n = t",
    "template_paths": _with(E) + " SELECT a.src AS source, array_to_string([a.src, a.dst, b.dst, c.src], '>') AS path FROM e a JOIN e b ON b.src = a.dst AND b.label = 'created' JOIN e c ON c.dst = b.dst AND c.label = 'created' JOIN v ON v.id = a.src AND v.label = 'person' WHERE a.label = 'knows' AND a.src <> a.dst AND c.src NOT IN (a.src, a.dst)",
    "weighted_template": _with(undirected(("partners",)), "st AS (SELECT src, dst, coalesce(weight, 1.0) AS w FROM e WHERE label = 'partners' UNION ALL SELECT dst, src, coalesce(weight, 1.0) FROM e WHERE label = 'partners' AND src <> dst)") + " SELECT array_to_string([s, a.dst, b.dst], '>') AS path, round(a.w + b.w, 6) AS weight FROM s JOIN st a ON a.src = s JOIN st b ON b.src = a.dst WHERE a.dst <> s AND b.dst NOT IN (s, a.dst)",
    "crosspoints": _with(_U, _BFS.format(2) + _T.format(2), _WALK.format(4)) + " SELECT p[len(p) // 2 + 1] AS crosspoint, array_to_string(p, '>') AS path FROM walk, t WHERE n = t",
    "rings": _with(_U) + ", r AS (SELECT [a.src, a.dst, b.dst, c.dst] AS p FROM u a JOIN u b ON b.src = a.dst AND b.dst NOT IN (a.src, a.dst) JOIN u c ON c.src = b.dst AND c.dst = a.src UNION ALL SELECT [a.src, a.dst, b.dst, c.dst, f.dst] FROM u a JOIN u b ON b.src = a.dst AND b.dst NOT IN (a.src, a.dst) JOIN u c ON c.src = b.dst AND c.dst NOT IN (a.src, a.dst, b.dst) JOIN u f ON f.src = c.dst AND f.dst = a.src WHERE a.dst <> a.src) SELECT p[1] AS source, array_to_string(p, '>') AS path FROM r JOIN v ON v.id = p[1] AND v.label = 'software' WHERE p[2] > p[-2] AND p[1] <> p[2]",
    "rays": _with(_U, _WALK.format(3)) + " SELECT s AS source, array_to_string(p, '>') AS path FROM walk, s WHERE len(p) = 4 OR (len(p) > 1 AND NOT EXISTS (SELECT 1 FROM u WHERE u.src = n AND NOT list_contains(p, u.dst)))",
    "fusiform": _with(E) + ', a AS (SELECT DISTINCT src, dst FROM e WHERE label = \'created\'), deg AS (SELECT src, count(*) AS n FROM a GROUP BY src), x AS (SELECT p.src AS source, q.src AS "similar", count(*) / any_value(n) AS score, count(*) AS common FROM a p JOIN deg ON deg.src = p.src AND n >= 2 JOIN a q ON q.dst = p.dst AND q.src <> p.src GROUP BY ALL HAVING count(*) / any_value(n) >= 0.5), m AS (SELECT source, "similar" FROM x UNION ALL SELECT source, source FROM x), ok AS (SELECT source FROM m JOIN v ON v.id = m."similar" GROUP BY source HAVING count(DISTINCT city) >= 2) SELECT source, "similar", round(score, 6) AS score, common FROM x WHERE source IN (FROM ok) QUALIFY row_number() OVER (PARTITION BY source ORDER BY x.score DESC, "similar") <= 5',
    "personal_rank": _with(undirected(("created",))) + ", g AS (SELECT src, dst, count(*) OVER (PARTITION BY src) AS deg FROM u), r0 AS (SELECT s AS n, 1.0::DOUBLE AS r FROM s)" + "".join(f", r{i} AS (SELECT n, sum(r) AS r FROM (SELECT dst AS n, 0.85 * r / deg AS r FROM r{i - 1} JOIN g ON g.src = n UNION ALL SELECT s, 1 - 0.85::DOUBLE FROM s) GROUP BY n)" for i in (1, 2, 3)) + " SELECT n AS node, round(r, 6) AS rank FROM r3 JOIN v ON v.id = n WHERE v.label <> 'person' ORDER BY r DESC, n LIMIT 50",
    "neighbor_rank": _with(_U) + ", l1 AS (SELECT dst AS n, sum(0.85 / k) AS r FROM (SELECT *, count(*) OVER (PARTITION BY src) AS k FROM e WHERE label = 'knows') JOIN s ON src = s WHERE dst <> s GROUP BY dst), l2 AS (SELECT dst AS n, sum(0.85 * r / k) AS r FROM (SELECT *, count(*) OVER (PARTITION BY src) AS k FROM e WHERE label = 'created') JOIN l1 ON src = n WHERE dst NOT IN (SELECT s FROM s UNION SELECT n FROM l1) GROUP BY dst), l3 AS (SELECT src AS n, sum(0.85 * r / k) AS r FROM (SELECT *, count(*) OVER (PARTITION BY dst) AS k FROM e WHERE label = 'created') JOIN l2 ON dst = n WHERE src NOT IN (SELECT s FROM s UNION SELECT n FROM l1 UNION SELECT n FROM l2) GROUP BY src) SELECT 1 AS layer, n AS node, round(r, 6) AS rank FROM l1 UNION ALL SELECT 2, n, round(r, 6) FROM l2 UNION ALL SELECT 3, n, round(r, 6) FROM l3",
}
