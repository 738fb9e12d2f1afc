"""The goldens of the small software graph."""

import pytest
from pyspark.sql import functions as F

from tessagraph.errors import NotFoundError
from tessagraph.graph import PropertyGraph
from tessagraph.operators import traversal as T

M, V, J, P, L, R = "1:marko", "1:vadas", "1:josh", "1:peter", "2:lop", "2:ripple"


@pytest.fixture(scope="module")
def g(spark):
    v = [(M, "person", "marko", 29, "Beijing", None), (V, "person", "vadas", 27, "Hongkong", None), (J, "person", "josh", 32, "Beijing", None), (P, "person", "peter", 29, "Shanghai", None), (L, "software", "lop", None, None, 328), (R, "software", "ripple", None, None, 199)]
    e = [("e1", "knows", M, V, "2012-01-10", None), ("e2", "knows", M, J, "2013-01-10", None), ("e3", "created", M, L, "2014-01-10", "Shanghai"), ("e4", "created", J, R, "2015-01-10", "Beijing"), ("e5", "created", J, L, "2016-01-10", "Beijing"), ("e6", "created", P, L, "2017-01-10", "Hongkong")]
    return PropertyGraph(
        spark.createDataFrame(v, "id string, label string, name string, age int, city string, price int"),
        spark.createDataFrame(e, "id string, label string, src string, dst string, date string, city string").withColumn("weight", F.lit(None).cast("double")),
    )


def col(df, c="node"):
    return sorted(r[c] for r in df.collect())


def test_neighbourhoods(spark, g):
    u, m = g.undirected, T.seeds(g.edges, [M])
    assert col(T.k_out(u, m, 2)) == sorted([P, R])
    assert col(T.k_neighbor(u, m, 2)) == sorted([P, J, L, R, V])
    assert col(T.k_out(u, m, 9)) == []
    assert col(T.same_neighbors(u, M, J)) == [L]
    pairs = spark.createDataFrame([(M, J), ("x", "y")], "a string, b string")
    assert {(r.a, r.jaccard) for r in T.jaccard_similarity(u, pairs).collect()} == {(M, 0.2), ("x", 0.0)}
    assert {(r.a, r.b): r.jaccard for r in T.jaccard_all(u, 10).collect()}[(J, M)] == 0.2


def test_shortest_paths(spark, g):
    u, m = g.undirected, T.seeds(g.edges, [M])
    assert T.shortest_path(u, M, R, 3).first().path == [M, J, R]
    assert [r.path for r in T.all_shortest_paths(u, M, R, 3).collect()] == [[M, J, R]]
    assert {r.node: (r.weight, r.path) for r in T.weighted_shortest(g.adjacency("BOTH", extra=["weight"]), m, 3).collect()}[R] == (2.0, [M, J, R])
    assert {(r.node, r.weight, tuple(r.path)) for r in T.single_source_shortest(u, m, 2).collect()} == {(P, 2.0, (M, L, P)), (J, 1.0, (M, J)), (L, 1.0, (M, L)), (R, 2.0, (M, J, R)), (V, 1.0, (M, V))}
    assert [(r.source, r.node, r.path) for r in T.multi_node_shortest(u, [M, J], 2).collect()] == [(J, M, [J, M])]
    assert T.all_shortest_paths(u, M, "none", 4).count() == 0


def test_paths_and_patterns(spark, g):
    u, m = g.undirected, T.seeds(g.edges, [M])
    to = T.seeds(u, [J]).withColumnRenamed("source", "target")
    assert sorted(r.path for r in T.paths(u, m, to, 2).collect()) == [[M, J], [M, L, J]]
    assert [r.path for r in T.paths(u, m, to, 2, nearest=True).collect()] == [[M, J]]
    got = T.customized_paths(g, m, [T.Step("OUT", ("created",), default_weight=8, sample=1)], "INCR").collect()
    assert [(r.path, r.weights) for r in got] == [([M, L], [8.0])]
    t = T.seeds(u, [R]).withColumnRenamed("source", "target")
    steps = [T.Step("IN", ("knows",)), T.Step("OUT", ("created",)), T.Step("IN", ("created",)), T.Step("OUT", ("created",))]
    assert [r.path for r in T.customized_paths(g, T.seeds(u, [V]), steps, targets=t).collect()] == [[V, M, L, J, R]]
    assert {(r.crosspoint, tuple(r.path)) for r in T.crosspoints(u, M, J, 2).collect()} == {(L, (M, L, J)), (J, (M, J))}
    assert col(T.customized_crosspoints(g, [L, R], [[T.Step("IN", ("created",))]]), "crosspoint") == [J]
    assert [r.path for r in T.rings(u, m, 3).collect()] == [[M, L, J, M]]
    assert sorted(r.path for r in T.rays(u, m, 2).collect()) == sorted([[M, L, J], [M, L, P], [M, V], [M, J, R], [M, J, L]])
    assert T.fusiform_similarity(g, m, "knows", "OUT", 8, 0.75, 1, 1, "city", 2).count() == 0
    assert [(r.similar, r.score) for r in T.fusiform_similarity(g, m, "created", "OUT", 1, 0.75).orderBy("similar").collect()] == [(J, 1.0), (P, 1.0)]


def test_ranks(g):
    r = {x.node: x["rank"] for x in T.personal_rank(g, M, "created", with_label="OTHER_LABEL").collect()}
    assert set(r) == {L, R} and r[L] > r[R]
    assert set(x.node for x in T.personal_rank(g, M, "created", with_label="SAME_LABEL").collect()) == {J, P}
    layers = {(x.layer, x.node): round(x["rank"], 6) for x in T.neighbor_rank(g, M, [T.Step("OUT", ("created",)), T.Step("IN", ("created",))], 1.0).collect()}
    assert layers == {(1, L): 1.0, (2, J): 0.333333, (2, P): 0.333333}


def test_scans_and_changes(spark, g):
    assert col(g.scan_vertices("person", {"city": "Beijing"}), "id") == [J, M]
    assert [r.id for r in g.scan_vertices(page=J, limit=2).collect()] == [M, P]
    assert col(g.scan_edges(vertex_id=J, direction="BOTH"), "id") == ["e2", "e4", "e5"] and col(g.scan_edges("created", J, "OUT"), "id") == ["e4", "e5"]
    with pytest.raises(NotFoundError):
        g.scan_edges(vertex_id=J)
    s = g.summary().first()
    assert (s.vertex_num, s.edge_num, len(s.vertices)) == (6, 6, 6)
    assert col(g.relations(), "relation") == ["person--created-->software", "person--knows-->person"]
    gone = g.remove_vertices(spark.createDataFrame([(J,)], "id string"))
    assert gone.vertices.count() == 5 and col(gone.edges, "id") == ["e1", "e3", "e6"]
    new, bad = g.upsert_edges(spark.createDataFrame([("e9", "knows", V, P), ("e8", "knows", V, "no")], "id string, label string, src string, dst string"))
    assert new.edges.count() == 7 and col(bad, "id") == ["e8"]
    up = g.upsert_vertices(spark.createDataFrame([(M, "person", "Marko")], "id string, label string, name string"))
    assert up.vertices.count() == 6 and up.vertices.filter(F.col("id") == M).first().age is None
    assert g.append_properties([M], {"age": F.lit(30)}).vertices.filter("age = 30").count() == 1 and g.eliminate_properties([M], ["age"]).vertices.filter("age is null").count() == 3
    assert g.remove_edges(spark.createDataFrame([("e1",)], "id string")).edges.count() == 5 and g.clear().edges.count() == 0 and g.vertices_by_id([]).count() == 0 and g.edges_by_id(["e1", "e2"]).count() == 2
    assert g.edge_multiplicity("created").count() == 0
