"""Queries on vectors, graph-learning data, message passing and scores, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessagraph.graph import PropertyGraph, graph_of_tables, union_all
from tessagraph.operators import learning as L
from tessagraph.operators import messages as M
from tessagraph.operators import metrics as S
from tessagraph.operators import vectors as N
from tessagraph.plans.graph_sql import E, V, levels, undirected
from tessagraph.session import checkpoint, table


def _emb(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings")


def _first(spark: SparkSession, d: str) -> list[float]:
    return _emb(spark, d).orderBy("vec_id").first().embedding


def _social(spark: SparkSession, d: str, labels: tuple[str, ...] = ("knows", "created")) -> PropertyGraph:
    return graph_of_tables(spark, d).restrict(labels)


def vec_search_l2(spark, d):
    return N.search(_emb(spark, d), "vec_id", "embedding", _first(spark, d), 10, 1.9).withColumn("distance", F.round("distance", 6))


def vec_search_cosine(spark, d):
    return N.search(_emb(spark, d), "vec_id", "embedding", _first(spark, d), 10, 0.95, "cosine").withColumn("distance", F.abs(F.round("distance", 6)))


def vec_search_many(spark, d):
    """Queries are the rows whose id is divisible by 50, against all rows."""
    e = _emb(spark, d)
    return N.search_many(e, "vec_id", "embedding", e.filter("vec_id % 50 = 0"), "vec_id", 5).withColumn("distance", F.round("distance", 6))


def vec_search_cells(spark, d):
    """The same through an index of cells (approximate)."""
    e = _emb(spark, d)
    return N.search_cells(e, "vec_id", "embedding", e.filter("vec_id % 50 = 0"), "vec_id", 5, N.fit_cells(e, "embedding", 32), 20)


def vec_pairwise(spark, d):
    """Similarities of neighbours by id."""
    e = _emb(spark, d)
    x = e.select("vec_id", F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id")
    return x.select("vec_id", F.round(N.dot(F.col("a"), F.col("b")), 6).alias("dot"), F.round(N.cosine_similarity(F.col("a"), F.col("b")), 6).alias("cosine"), F.round(-F.sqrt(N.l2sq(F.col("a"), F.col("b"))), 6).alias("euclidean"))


def vec_refresh(spark, d):
    """What an index of vertex ids must drop and add between the removals and the loads of a month."""
    v = table(spark, d, "vertices").filter("label = 'company'")
    gone, new = N.refresh(v.filter("loaded_at < '2025-01-01'").select("id"), v.filter("loaded_at >= '2025-01-01'").select("id"), "id")
    return gone.withColumn("change", F.lit("removed")).unionByName(new.withColumn("change", F.lit("added")))


def gml_dense_index(spark, d):
    g = _social(spark, d)
    n, e = L.convert_graph(g.vertices.filter("label in ('person', 'software')").select("id", "label"), g.edges.select("id", "src", "dst").withColumnRenamed("id", "edge"))
    return e.select("edge", "src_idx", "dst_idx")


def gml_hetero_index(spark, d):
    return L.dense_index(graph_of_tables(spark, d).vertices.select("id", "label"), "id", ["label"])


def gml_collection_stats(spark, d):
    return L.collection_stats(table(spark, d, "feat_vertices"), "vertex_label", "feat", "label")


def gml_single_directed(spark, d):
    return L.single_directed(_social(spark, d, ("knows",)).edges)


def gml_split_edges(spark, d):
    e = _social(spark, d, ("partners",)).edges
    return L.split_edges(e, L.arithmetic_hash(F.col("id"), 5) / 1_000_003).groupBy("split").agg(F.count("*").alias("edges"))


def gml_negative_edges(spark, d):
    n, e = L.convert_graph(_social(spark, d, ("knows",)).vertices.filter("label = 'person'").select("id"), _social(spark, d, ("knows",)).edges.select("src", "dst"))
    return L.negative_edges(e.select(F.col("src_idx").alias("src"), F.col("dst_idx").alias("dst")), n.count(), 2, draw=L.arithmetic_hash)


def gml_closeness(spark, d):
    g = graph_of_tables(spark, d, ("reports_to",))
    start = g.vertices.filter("label = 'department'").select(F.col("id").alias("source"))
    lists = L.closeness(L.path_lists(g.undirected, start)).withColumn("closeness", F.round("closeness", 6))
    return lists.select("source", F.explode("nodes").alias("node"), "closeness")


def gml_nearest_anchors(spark, d):
    g = graph_of_tables(spark, d, ("reports_to",))
    start = g.vertices.filter("label = 'department'").select(F.col("id").alias("source"))
    nodes = L.dense_index(start.withColumnRenamed("source", "id"), "id")
    sets = L.anchor_sets(nodes, nodes.count()).join(nodes, "idx").select("set", F.col("id").alias("idx"))
    lists = L.closeness(L.nearest_lists(g.undirected, sets)).withColumn("closeness", F.round("closeness", 6))
    return lists.select("set", "closeness", F.inline("near")).select("node", "set", "closeness", "anchor")


def gml_subgraphs(spark, d):
    """Enclosing subgraphs of the knows edges: nodes and edges per pair."""
    g = _social(spark, d)
    n, e = L.enclosing_subgraphs(g.undirected, g.edges.filter("label = 'knows' and src <> dst").select(F.col("id").alias("pair"), F.col("src").alias("a"), F.col("dst").alias("b")))
    return n.groupBy("pair").agg(F.count("*").alias("nodes")).join(e.groupBy("pair").agg(F.count("*").alias("edges")), "pair", "left").fillna(0, ["edges"])


def gml_drnl(spark, d):
    g = _social(spark, d)
    p = checkpoint(g.edges.filter("label = 'knows' and src <> dst").select(F.col("id").alias("pair"), F.col("src").alias("a"), F.col("dst").alias("b")))
    n, e = L.enclosing_subgraphs(g.undirected, p)
    return L.drnl_labels(n, checkpoint(e), p).groupBy("z").agg(F.count("*").alias("nodes"))


def gml_walks(spark, d):
    g = _social(spark, d)
    w = L.random_walks(g.undirected, g.vertices.filter("label = 'software'").select(F.col("id").alias("source")), 2, 5, draw=L.text_draw)
    return L.skip_grams(w, 5)


def gml_sample_neighbors(spark, d):
    g = _social(spark, d, ("serve",))
    steps = g.edges.select("src", "dst")
    seeds = g.vertices.filter("label = 'company'").select(F.col("id").alias("seed"))
    return L.sample_neighbors(steps, seeds, 5, F.md5(F.concat("src", F.lit("|"), "dst")))


def gml_cluster_parts(spark, d):
    g = _social(spark, d)
    part = lambda c: (L.text_draw(F.col(c)) % 4).cast("int")
    return L.cluster_parts(g.edges.select("id", "src", "dst"), part("src"), part("dst")).groupBy("part").agg(F.count("*").alias("edges"))


def gml_node_types(spark, d):
    return L.nodes_per_type(graph_of_tables(spark, d).edges).groupBy("label").agg(F.count("*").alias("nodes"))


def gml_features(spark, d):
    """Scaled, filled and target-encoded columns of the vertices, fitted on the persons born before 1980."""
    v = graph_of_tables(spark, d).vertices.filter("label = 'person'").select("id", F.col("age").cast("double").alias("age"), "city", F.year("birthDate").alias("year"))
    x = L.target_encode(v, "city", "year", F.col("year") < 1980)
    x = L.replace_missing(x, ["age"], F.col("year") < 1980)
    x = L.normalize_features(x, ["age"], F.col("year") < 1980)
    return x.select("id", F.round("age", 6).alias("age"), F.round("city_enc", 6).alias("city_enc"))


def _ages(g: PropertyGraph) -> DataFrame:
    return g.vertices.filter("label = 'person'").select(F.col("id").alias("node"), F.lit(0).alias("dim"), (F.coalesce("age", F.lit(0)) / 100).alias("val"))


def msg_mean(spark, d):
    g = _social(spark, d, ("knows",))
    return M.aggregate(_ages(g), g.edges, "mean").select("node", F.round("val", 6).alias("val"))


def msg_label_propagation(spark, d):
    g = _social(spark, d, ("knows",))
    return M.label_propagation(_ages(g), M_both(g), 2, 0.7).select("node", F.round("val", 6).alias("val"))


def M_both(g: PropertyGraph) -> DataFrame:
    return L.bidirected(g.edges)


def msg_powers(spark, d):
    g = _social(spark, d, ("knows",))
    return M.mean_of_powers(_ages(g), M_both(g), 2, "DA").select("node", F.round("val", 6).alias("val"))


def msg_softmax(spark, d):
    g = _social(spark, d, ("knows",))
    m = g.edges.join(_ages(g).withColumnRenamed("node", "src"), "src").select("dst", "dim", "val")
    return M.softmax_aggregate(m, 2.0).select("node", F.round("val", 6).alias("val"))


def msg_closest(spark, d):
    g = _social(spark, d)
    s = g.vertices.select(F.col("id").alias("node"), (F.coalesce("age", "price", F.lit(0)) / 400).alias("score"))
    return M.closest_sources(s, g.edges.select("label", "src", "dst").distinct(), 0.5).select("label", "src", "dst")


def msg_attention(spark, d):
    f = table(spark, d, "feat_vertices").filter("size(feat) = 64 and not exists(feat, x -> isnan(x))")
    n = L.dense_index(f.select(F.col("vertex_id").alias("id"), "feat"), "id").select(F.col("idx").alias("node"), "feat")
    top = n.agg(F.max("node")).first()[0]
    ring = n.select(F.col("node").alias("src"), F.explode(F.array(*[F.pmod(F.col("node") + k, F.lit(top + 1)) for k in (0, 1, 2)])).alias("dst"))
    return M.attention(M.long(n), ring).groupBy("node").agg(F.round(F.sum("val"), 6).alias("total"))


def _indexed(spark, d):
    """(persons with idx, knows edges (src, dst) as numbers)."""
    g = _social(spark, d, ("knows",))
    n, e = L.convert_graph(g.vertices.filter("label = 'person'").select("id"), g.edges.select("src", "dst"))
    return checkpoint(n), checkpoint(e.select(F.col("src_idx").alias("src"), F.col("dst_idx").alias("dst")))


def gml_rewired(spark, d):
    """The graph of acquaintances with about a hundredth of its edges led elsewhere."""
    n, e = _indexed(spark, d)
    return L.rewired(e, n.count())


def gml_block_pairs(spark, d):
    """Pairs of persons in one block of 20."""
    return L.block_pairs(_indexed(spark, d)[0])


def gml_labelled_pairs(spark, d):
    """A tenth of the acquaintances beside the same share of absent pairs."""
    n, e = _indexed(spark, d)
    return L.labelled_pairs(e, n.count(), 1, 0.1).groupBy("label").agg(F.count("*").alias("pairs")).filter("label = 1")


def gml_graph_splits(spark, d):
    """Graphs of a collection, one per label of the features, by split."""
    x = table(spark, d, "feat_vertices").select(F.coalesce("vertex_id", F.lit(0)).alias("graph_id"))
    return L.split_graphs(x, L.arithmetic_hash(F.col("graph_id"), 3) / 1_000_003).groupBy("split").agg(F.count("*").alias("graphs"))


def msg_jumping(spark, d):
    g = _social(spark, d, ("knows",))
    return M.jumping_sum(_ages(g), checkpoint(M_both(g)), 1, 1, "max").select("node", F.round("val", 6).alias("val"))


def msg_stacks(spark, d):
    g = _social(spark, d, ("knows",))
    return M.recursive_stacks(_ages(g), checkpoint(M_both(g)), [(0.5, 1.0), (1.0, -0.5)], 1).select("node", F.round("val", 6).alias("val"))


def msg_norm(spark, d):
    g = _social(spark, d, ("knows",))
    return M.message_norm(_ages(g), M.aggregate(_ages(g), g.edges, "mean"), 0.5).select("node", F.round("val", 6).alias("val"))


def msg_anchors(spark, d):
    """Messages from each department's nearest anchors, by headcount."""
    v = graph_of_tables(spark, d, ("reports_to",)).vertices.filter("label = 'department'")
    x = v.select(F.col("id").alias("node"), F.lit(0).alias("dim"), (F.coalesce("headcount", F.lit(0)) / 100).alias("val"))
    structure, position = M.anchor_messages(x, gml_nearest_anchors(spark, d), [2.0])
    return structure.select("node", F.round("val", 6).alias("structure")).join(position.groupBy("node").agg(F.round(F.sum("val"), 6).alias("position")), "node")


def msg_readout(spark, d):
    """Cities as graphs: their persons' ages, weighted by attention."""
    v = graph_of_tables(spark, d).vertices.filter("label = 'person' and city is not null")
    x = v.select(F.col("id").alias("node"), F.lit(0).alias("dim"), (F.coalesce("age", F.lit(0)) / 100).alias("val"))
    return M.attention_readout(x, v.select(F.col("id").alias("node"), F.col("city").alias("graph_id")), [2.0]).select("graph_id", F.round("val", 6).alias("val"))


def met_warmed_cosine(spark, d):
    """A learning rate for the first 200 rows of the embeddings as steps."""
    return S.warmed_cosine(_emb(spark, d).select(F.col("vec_id").alias("step")), 0.1, 50, 400).select("step", F.round("rate", 9).alias("rate"))


def met_scores(spark, d):
    """Accuracy of the rule 'label = id mod 10' on the embeddings, and the area under the curve of the first component for label 0."""
    e = _emb(spark, d).select("label", (F.col("vec_id") % 10).cast("int").alias("prediction"), F.col("embedding")[0].cast("double").alias("score"))
    a = S.auc(e.select((F.col("label") == 0).cast("int").alias("label"), F.round("score", 3).alias("score")))
    return S.accuracy(e).crossJoin(a).select(F.round("accuracy", 6).alias("accuracy"), F.round("auc", 6).alias("auc"))


def met_hits(spark, d):
    e = _emb(spark, d).select("label", F.col("embedding")[1].cast("double").alias("score"))
    return union_all([S.hits_at(e.filter("label < 3"), e.filter("label >= 3"), k).select(F.lit(k).alias("k"), F.round("hits", 6).alias("hits")) for k in (1, 10, 100)])


def met_class_weights(spark, d):
    return S.class_weights(_emb(spark, d)).select("label", F.round("weight", 9).alias("weight"))


QUERIES = {f.__name__: f for f in (
    vec_search_l2, vec_search_cosine, vec_search_many, vec_search_cells, vec_pairwise, vec_refresh, gml_dense_index, gml_hetero_index, gml_collection_stats, gml_single_directed, gml_split_edges, gml_negative_edges, gml_closeness,
    gml_nearest_anchors, gml_subgraphs, gml_drnl, gml_walks, gml_sample_neighbors, gml_cluster_parts, gml_node_types, gml_features, msg_mean, msg_label_propagation, msg_powers, msg_softmax, msg_closest, msg_attention, gml_rewired, gml_block_pairs, gml_labelled_pairs, gml_graph_splits, msg_jumping, msg_stacks, msg_norm, msg_anchors, msg_readout, met_warmed_cosine, met_scores, met_hits, met_class_weights,
)}

_D = "list_sum(list_transform(range(1, 65), lambda i: {}))"
_L2 = _D.format("(CAST({a}[i] AS DOUBLE) - {b}[i]) * (CAST({a}[i] AS DOUBLE) - {b}[i])")
_DOT = _D.format("CAST({a}[i] AS DOUBLE) * {b}[i]")
_COS = f"({_DOT} / (sqrt({_DOT.format(a='{a}', b='{a}')}) * sqrt({_DOT.format(a='{b}', b='{b}')})))"
_E = "WITH RECURSIVE " + E + " "
_KNOWS = "WITH RECURSIVE " + undirected(("knows",)) + ", x AS (SELECT id AS node, coalesce(age, 0) / 100 AS val FROM v WHERE label = 'person'), k AS (SELECT src, dst FROM e WHERE label = 'knows')"
_Q = "q AS (SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1)"
_DEP = "WITH RECURSIVE " + undirected(("reports_to",)) + ", " + levels("bfs", "SELECT id, id, 0 FROM v WHERE label = 'department'", "u", "s0") + ", c AS (SELECT s0 AS source, n AS node, 1 / (d + 1) AS c FROM bfs)"
def _draw(c: str) -> str:
    return f"CAST('0x' || substr(md5({c}), 1, 8) AS BIGINT)"


def _hash(c: str, seed: int) -> str:
    return f"(((({c}) * 7919 + {seed}) % 1000003 * 104729 + {seed}) % 1000003)"


_IDX = "WITH RECURSIVE " + E + ", n AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx FROM v WHERE label = 'person'), c AS (SELECT count(*) AS c FROM n), k AS (SELECT DISTINCT a.idx AS src, b.idx AS dst FROM e JOIN n a ON a.id = src JOIN n b ON b.id = dst WHERE label = 'knows')"
_DAD = _KNOWS + ", b AS (SELECT src, dst FROM k UNION SELECT dst, src FROM k), g AS (SELECT src AS node, count(*) AS d FROM b GROUP BY src), w AS (SELECT src, dst, 1 / (sqrt(p.d) * sqrt(q.d)) AS w FROM b JOIN g p ON p.node = src JOIN g q ON q.node = dst), a AS (SELECT dst AS node, sum(w * val) AS val FROM w JOIN x ON node = src GROUP BY dst)"
SQL = {
    "gml_negative_edges": _IDX + f", t AS (SELECT src, dst, i, a, ((src * c + dst) * 2 + i) * 8 + a AS z FROM k, c, LATERAL (SELECT unnest([0, 1]) AS i), LATERAL (SELECT unnest(range(8)) AS a)), h AS (SELECT t.src AS s0, t.dst AS d0, i, a, {_hash('z', 1)} % c AS src, {_hash('z', 2)} % c AS dst FROM t, c), f AS (SELECT * FROM h WHERE src <> dst AND NOT EXISTS (SELECT 1 FROM k WHERE k.src = h.src AND k.dst = h.dst)) SELECT DISTINCT src, dst FROM (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY s0, d0, i ORDER BY a) = 1)",
    "gml_rewired": _IDX + f", p AS (SELECT src, dst, {_hash('src * c + dst', 8)} % c AS new FROM k, c WHERE {_hash('src * c + dst', 7)} / 1000003 < 0.01), m AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.src = p.src AND k.dst = p.new)), z AS (SELECT src, dst FROM k WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.src = k.src AND m.dst = k.dst) UNION SELECT src, new FROM m) SELECT src, dst FROM z WHERE src <> dst UNION SELECT dst, src FROM z WHERE src <> dst",
    "gml_block_pairs": _IDX + " SELECT a.idx AS a, b.idx AS b FROM n a JOIN n b ON a.idx > b.idx AND a.idx // 20 = b.idx // 20",
    "gml_labelled_pairs": _IDX + f" SELECT 1 AS label, count(*) AS pairs FROM k, c WHERE {_hash('src * c + dst', 10)} / 1000003 < 0.1 HAVING count(*) > 0",
    "gml_graph_splits": f"SELECT CASE WHEN h < 0.7::DOUBLE THEN 'train' WHEN h < 0.9::DOUBLE THEN 'valid' ELSE 'test' END AS split, count(*) AS graphs FROM (SELECT {_hash('coalesce(vertex_id, 0)', 3)} / 1000003 AS h FROM feat_vertices) GROUP BY 1",
    "msg_jumping": _DAD + ", h AS (SELECT node, max(val) AS val FROM (FROM x UNION ALL FROM a) GROUP BY node) SELECT dst AS node, round(sum(val), 6) AS val FROM b JOIN h ON node = src GROUP BY dst",
    "msg_stacks": _DAD + ", sv AS (SELECT node, sum(v1) AS v1, sum(v2) AS v2 FROM (SELECT node, val * 0.5::DOUBLE AS v1, val AS v2 FROM a UNION ALL SELECT node, val, val * -0.5::DOUBLE FROM x) GROUP BY node) SELECT node, round(greatest(v1, 0) * 0.5::DOUBLE + greatest(v2, 0) * 0.5::DOUBLE, 6) AS val FROM sv",
    "msg_norm": _KNOWS + ", m AS (SELECT dst AS node, avg(val) AS val FROM k JOIN x ON x.node = src GROUP BY dst) SELECT m.node, round(CASE WHEN m.val = 0 THEN 0 ELSE coalesce(abs(x.val), 0) * 0.5::DOUBLE END, 6) AS val FROM m LEFT JOIN x ON x.node = m.node",
    "msg_readout": "WITH " + V + ", x AS (SELECT city AS graph_id, coalesce(age, 0) / 100 AS a FROM v WHERE label = 'person' AND city IS NOT NULL) SELECT graph_id, round(sum(a * exp(2 * a)) / sum(exp(2 * a)), 6) AS val FROM x GROUP BY graph_id",
    "met_warmed_cosine": "SELECT vec_id AS step, round(CASE WHEN vec_id BETWEEN 0 AND 400 THEN 0.1::DOUBLE * least(1, vec_id / 50) * (cos(greatest(0, (vec_id - 50) / 350) * pi()) + 1) / 2 END, 9) AS rate FROM embeddings",
    "vec_search_l2": f"WITH {_Q}, t AS (SELECT vec_id AS id, {_L2.format(a='embedding', b='q')} AS distance FROM embeddings, q ORDER BY distance, id LIMIT 10) SELECT id, round(distance, 6) AS distance FROM t WHERE distance < 1.9",
    "vec_search_cosine": f"WITH {_Q}, t AS (SELECT vec_id AS id, 1 - {_COS.format(a='embedding', b='q')} AS distance FROM embeddings, q ORDER BY distance, id LIMIT 10) SELECT id, abs(round(distance, 6)) AS distance FROM t WHERE distance < 0.95",
    "vec_search_many": f"WITH t AS (SELECT q.vec_id AS query, e.vec_id AS id, round({_L2.format(a='q.embedding', b='e.embedding')}, 12) AS distance FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0) SELECT query, id, round(distance, 6) AS distance FROM t QUALIFY row_number() OVER (PARTITION BY query ORDER BY t.distance, id) <= 5",
    "vec_pairwise": f"SELECT a.vec_id, round({_DOT.format(a='a.embedding', b='b.embedding')}, 6) AS dot, round({_COS.format(a='a.embedding', b='b.embedding')}, 6) AS cosine, round(-sqrt({_L2.format(a='a.embedding', b='b.embedding')}), 6) AS euclidean FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "vec_refresh": "WITH p AS (SELECT DISTINCT id FROM vertices WHERE label = 'company' AND loaded_at < '2025-01-01'), n AS (SELECT DISTINCT id FROM vertices WHERE label = 'company' AND loaded_at >= '2025-01-01') SELECT id, 'removed' AS change FROM p WHERE id NOT IN (FROM n) UNION ALL SELECT id, 'added' FROM n WHERE id NOT IN (FROM p)",
    "gml_dense_index": _E + ", n AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx FROM v WHERE label IN ('person', 'software')) SELECT e.id AS edge, a.idx AS src_idx, b.idx AS dst_idx FROM e JOIN n a ON a.id = src JOIN n b ON b.id = dst WHERE label IN ('knows', 'created')",
    "gml_hetero_index": _E + "SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY id) - 1 AS idx FROM v",
    "gml_collection_stats": "SELECT count(*) AS n_graphs, max(n) AS max_n_nodes, max(f) AS n_feat_dim, (SELECT count(DISTINCT label) FROM feat_vertices) AS n_classes FROM (SELECT count(*) AS n, CAST(max(len(feat)) AS INT) AS f FROM feat_vertices GROUP BY vertex_label)",
    "gml_single_directed": _E + "SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM e WHERE label = 'knows' AND src <> dst",
    "gml_split_edges": _E + ", h AS (SELECT (((id * 7919 + 5) % 1000003 * 104729 + 5) % 1000003) / 1000003 AS o FROM e WHERE label = 'partners') SELECT CASE WHEN o < 1 - 0.2::DOUBLE THEN 'train' WHEN o < 1 - 0.2::DOUBLE / 2 THEN 'valid' ELSE 'test' END AS split, count(*) AS edges FROM h GROUP BY 1",
    "gml_closeness": _DEP + " SELECT source, node, round(c, 6) AS closeness FROM c",
    "gml_nearest_anchors": _DEP + ", n AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx FROM v WHERE label = 'department'), m AS (SELECT CAST(floor(log2(count(*))) AS INT) AS m FROM n), st AS (SELECT i * m + j AS set, 1 / 2 ** (i + 1) AS share FROM m, LATERAL (SELECT unnest(range(m)) AS i), LATERAL (SELECT unnest(range(m)) AS j)), an AS (SELECT CAST(set AS INT) AS set, id FROM n, st WHERE (((idx + set * 31) * 7919 + 7) % 1000003 * 104729 + 7) % 1000003 / 1000003 < share) SELECT node, set, round(max(c), 6) AS closeness, arg_min(source, (-c, source)) AS anchor FROM c JOIN an ON an.id = c.source GROUP BY node, set",
    "gml_subgraphs": "WITH RECURSIVE " + undirected(("knows", "created")) + ", p AS (SELECT id AS pair, src AS a, dst AS b FROM e WHERE label = 'knows' AND src <> dst), n AS (SELECT pair, a AS node FROM p UNION SELECT pair, b FROM p UNION SELECT pair, u.dst FROM p JOIN u ON u.src IN (a, b)), g AS (SELECT n.pair, count(*) AS edges FROM n JOIN u ON u.src = n.node JOIN n m ON m.pair = n.pair AND m.node = u.dst JOIN p ON p.pair = n.pair WHERE NOT (u.src = a AND u.dst = b) AND NOT (u.src = b AND u.dst = a) GROUP BY n.pair) SELECT pair, count(*) AS nodes, any_value(coalesce(edges, 0)) AS edges FROM n LEFT JOIN g USING (pair) GROUP BY pair",
    "gml_drnl": "WITH RECURSIVE " + undirected(("knows", "created")) + """, p AS (SELECT id AS pair, src AS a, dst AS b FROM e WHERE label = 'knows' AND src <> dst), n AS (SELECT pair, a AS node FROM p UNION SELECT pair, b FROM p UNION SELECT pair, u.dst FROM p JOIN u ON u.src IN (a, b)),
g AS (SELECT n.pair, u.src, u.dst, a, b FROM n JOIN u ON u.src = n.node JOIN n m ON m.pair = n.pair AND m.node = u.dst JOIN p ON p.pair = n.pair WHERE NOT (u.src = a AND u.dst = b) AND NOT (u.src = b AND u.dst = a)),
ga AS (SELECT pair, src, dst FROM g WHERE src <> b AND dst <> b), gb AS (SELECT pair, src, dst FROM g WHERE src <> a AND dst <> a),
""" + levels("xa", "SELECT pair, a, 0 FROM p", "ga", "pair") + ", " + levels("xb", "SELECT pair, b, 0 FROM p", "gb", "pair") + """,
da AS (SELECT pair, n AS node, d AS x FROM xa), db AS (SELECT pair, n AS node, d AS y FROM xb),
z AS (SELECT CASE WHEN n.node IN (p.a, p.b) THEN 1 ELSE coalesce(1 + CASE WHEN x < y THEN x ELSE y END + ((x + y) // 2) * ((x + y) // 2 + (x + y) % 2 - 1), 0) END AS z FROM n JOIN p USING (pair) LEFT JOIN da ON da.pair = n.pair AND da.node = n.node LEFT JOIN db ON db.pair = n.pair AND db.node = n.node)
SELECT CAST(z AS INT) AS z, count(*) AS nodes FROM z GROUP BY 1""",
    "gml_sample_neighbors": _E + ", s AS (SELECT DISTINCT src, dst FROM e JOIN v ON v.id = dst AND v.label = 'company' WHERE e.label = 'serve') SELECT src, dst FROM s QUALIFY row_number() OVER (PARTITION BY dst ORDER BY md5(src || '|' || dst), src) <= 5",
    "gml_cluster_parts": _E + f", p AS (SELECT {_draw('src')} % 4 AS a, {_draw('dst')} % 4 AS b FROM e WHERE label IN ('knows', 'created')) SELECT CAST(a AS INT) AS part, count(*) AS edges FROM p WHERE a = b GROUP BY a",
    "gml_walks": "WITH RECURSIVE " + undirected(("knows", "created")) + ", st AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS at, count(*) OVER (PARTITION BY src) AS deg FROM u), w0 AS (SELECT id AS source, walk, [id] AS path FROM v, (SELECT unnest([0, 1]) AS walk) WHERE label = 'software')" + "".join(f", w{i + 1} AS (SELECT source, walk, CASE WHEN st.dst IS NULL THEN path ELSE list_append(path, st.dst) END AS path FROM w{i} LEFT JOIN st ON st.src = path[-1] AND len(path) = {i + 1} AND st.at = " + _draw("'7|" + str(i) + "|' || source || '|' || walk") + " % st.deg)" for i in range(4)) + ", x AS (SELECT source, walk, unnest(path) AS n, generate_subscripts(path, 1) AS i FROM w4) SELECT DISTINCT a.n AS a, b.n AS b FROM x a JOIN x b ON a.source = b.source AND a.walk = b.walk AND a.i <> b.i AND abs(a.i - b.i) <= 2",
    "gml_node_types": _E + "SELECT label, count(*) AS nodes FROM (SELECT label, src FROM e UNION SELECT label, dst FROM e) GROUP BY label",
    "gml_features": _E + ", p AS (SELECT id, CAST(age AS DOUBLE) AS age, city, year(birthDate) AS y FROM v WHERE label = 'person'), t AS (SELECT city, avg(y) AS m FROM p WHERE y < 1980 GROUP BY city), r AS (SELECT min(age) AS lo, max(age) AS hi, avg(y) AS m FROM p WHERE y < 1980), f AS (SELECT *, coalesce(age, lo - 1) AS a FROM p, r), q AS (SELECT min(a) AS lo2, max(a) AS hi2 FROM f WHERE y < 1980) SELECT id, round((a - lo2) / (hi2 - lo2), 6) AS age, round(coalesce(t.m, f.m), 6) AS city_enc FROM f CROSS JOIN q LEFT JOIN t ON t.city IS NOT DISTINCT FROM f.city",
    "msg_mean": _KNOWS + " SELECT dst AS node, round(avg(val), 6) AS val FROM k JOIN x ON x.node = src GROUP BY dst",
    "msg_label_propagation": _KNOWS + ", b AS (SELECT src, dst FROM k UNION SELECT dst, src FROM k), g AS (SELECT src AS node, count(*) AS d FROM b GROUP BY src), w AS (SELECT src, dst, 1 / (sqrt(p.d) * sqrt(q.d)) AS w FROM b JOIN g p ON p.node = src JOIN g q ON q.node = dst), y0 AS (FROM x)" + "".join(f", y{i} AS (SELECT node, greatest(0, least(1, sum(val))) AS val FROM (SELECT dst AS node, 0.7 * w * val AS val FROM w JOIN y{i - 1} ON node = src UNION ALL SELECT node, (1 - 0.7::DOUBLE) * val FROM x) GROUP BY node)" for i in (1, 2)) + " SELECT node, round(val, 6) AS val FROM y2",
    "msg_powers": _KNOWS + ", b AS (SELECT src, dst FROM k UNION SELECT dst, src FROM k), g AS (SELECT src AS node, count(*) AS d FROM b GROUP BY src), w AS (SELECT src, dst, 1 / q.d AS w FROM b JOIN g q ON q.node = dst), a AS (SELECT dst AS node, sum(w * val) AS val FROM w JOIN x ON node = src GROUP BY dst), a2 AS (SELECT dst AS node, sum(w * val) AS val FROM w JOIN a ON node = src GROUP BY dst) SELECT node, round(sum(val) / 3, 6) AS val FROM (FROM x UNION ALL FROM a UNION ALL FROM a2) GROUP BY node",
    "msg_softmax": _KNOWS + " SELECT dst AS node, round(sum(val * exp(2 * val)) / sum(exp(2 * val)), 6) AS val FROM (SELECT src, dst FROM e WHERE label = 'knows') JOIN x ON x.node = src GROUP BY dst",
    "msg_closest": _E + ", s AS (SELECT id, coalesce(age, price, 0) / 400 AS s FROM v), d AS (SELECT DISTINCT label, src, dst FROM e WHERE label IN ('knows', 'created')) SELECT label, src, dst FROM d JOIN s a ON a.id = src JOIN s b ON b.id = dst QUALIFY row_number() OVER (PARTITION BY label, dst ORDER BY abs(tanh(a.s) - tanh(b.s)), src) <= ceil(count(*) OVER (PARTITION BY label, dst) * 0.5)",
    "met_scores": "WITH x AS (SELECT label, vec_id % 10 AS p, round(CAST(embedding[1] AS DOUBLE), 3) AS s FROM embeddings), r AS (SELECT label = 0 AS y, avg(rn) OVER (PARTITION BY s) AS rank FROM (SELECT *, row_number() OVER (ORDER BY s) AS rn FROM x)) SELECT round((SELECT avg(CASE WHEN label = p THEN 1 ELSE 0 END) FROM x), 6) AS accuracy, round((sum(rank) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2) / (count(*) FILTER (y) * count(*) FILTER (NOT y)), 6) AS auc FROM r",
    "met_hits": "WITH x AS (SELECT label, CAST(embedding[2] AS DOUBLE) AS s FROM embeddings) " + " UNION ALL ".join(f"SELECT {k} AS k, round(avg(CASE WHEN s > (SELECT min(s) FROM (SELECT s FROM x WHERE label >= 3 ORDER BY s DESC LIMIT {k})) THEN 1 ELSE 0 END), 6) AS hits FROM x WHERE label < 3" for k in (1, 10, 100)),
    "met_class_weights": "SELECT label, round(1 / count(*), 9) AS weight FROM embeddings GROUP BY label",
}
SQL["msg_anchors"] = f"""WITH an AS ({SQL["gml_nearest_anchors"]}), hv AS (SELECT id, any_value(coalesce(h, 0) / 100) AS h FROM ({"WITH " + V + " SELECT id, headcount AS h FROM v WHERE label = 'department'"}) GROUP BY id),
m AS (SELECT node, greatest(0, o.h + closeness * f.h) AS m FROM an JOIN hv o ON o.id = node JOIN hv f ON f.id = anchor) SELECT node, round(avg(m), 6) AS structure, round(sum(2 * m), 6) AS position FROM m GROUP BY node"""
