"""Results that earlier caps cut, against brute force."""

from itertools import combinations

from pyspark.sql import functions as F

from tessagraph.functions import text as X
from tessagraph.graph import graph_of_tables
from tessagraph.operators import learning as L
from tessagraph.operators import traversal as T
from tessagraph.plans import learning_queries, retrieval_queries, text_queries, traversal_queries

DATA = "/root/testdata/sf0.001"


def distances(near, start):
    """Least numbers of steps from start to all nodes that it reaches."""
    d, front = {start: 0}, [start]
    for x in front:
        for y in near.get(x, ()):
            if y not in d:
                d[y] = d[x] + 1
                front.append(y)
    return d


def neighbours(steps):
    near = {}
    for a, b in steps:
        near.setdefault(a, set()).add(b)
    return near


def test_jaccard_keeps_hubs(spark):
    e = {("hub", f"n{i:02}") for i in range(30)} | {(f"m{i % 4}", f"n{i:02}") for i in range(8)} | {("o", "n00")}
    near = {}
    for a, b in e:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {(a, b): (len(near[a] & near[b]), round(len(near[a] & near[b]) / len(near[a] | near[b]), 9)) for a, b in combinations(sorted(near), 2) if near[a] & near[b]}
    steps = spark.createDataFrame([p for a, b in e for p in ((a, b), (b, a))], "src string, dst string")
    for chunk in (7, 1000):
        rows = T.jaccard_all(steps, chunk).select("a", "b", "common", F.round("jaccard", 9).alias("j")).collect()
        assert len(rows) == len(want) and {(r.a, r.b): (r.common, r.j) for r in rows} == want


def test_closeness_of_far_nodes(spark):
    g = graph_of_tables(spark, DATA).restrict(["reports_to"])
    near = neighbours((r.src, r.dst) for r in g.undirected.collect())
    ids = sorted(r.id for r in g.vertices.filter("label = 'department'").collect())
    far = {i: distances(near, i) for i in ids}
    assert max(d for x in far.values() for d in x.values()) > 2
    got = {(r.source, r.node): r.closeness for r in learning_queries.gml_closeness(spark, DATA).collect()}
    assert got == {(i, n): round(1 / (d + 1), 6) for i, x in far.items() for n, d in x.items()}
    m = len(ids).bit_length() - 1
    u = lambda i, s: ((i + s * 31) * 7919 + 7) % 1_000_003 * 104_729
    sets = {i * m + j: [x for k, x in enumerate(ids) if (u(k, i * m + j) + 7) % 1_000_003 / 1_000_003 < 1 / 2 ** (i + 1)] for i in range(m) for j in range(m)}
    want = {}
    for s, members in sets.items():
        for a in members:
            for n, d in far[a].items():
                want[n, s] = min(want.get((n, s), (d, a)), (d, a))
    rows = learning_queries.gml_nearest_anchors(spark, DATA).collect()
    assert {(r.node, r.set): (r.closeness, r.anchor) for r in rows} == {k: (round(1 / (d + 1), 6), a) for k, (d, a) in want.items()}


def test_levels_without_limit(spark):
    steps = spark.createDataFrame([(i, i + 1) for i in range(14)], "src int, dst int")
    got = {r.node: r.depth for r in L.path_lengths(steps, spark.createDataFrame([(0,)], "source int")).collect()}
    assert got == {i: i for i in range(15)}


def test_node_labels_of_far_nodes(spark):
    ring = [(i, (i + 1) % 26) for i in range(26)]
    near = neighbours([p for i, j in ring[1:] for p in ((i, j), (j, i))])
    x = distances({k: v - {1} for k, v in near.items() if k != 1}, 0)
    y = distances({k: v - {0} for k, v in near.items() if k != 0}, 1)
    want = {i: 1 if i < 2 else 1 + min(x[i], y[i]) + (x[i] + y[i]) // 2 * ((x[i] + y[i]) // 2 + (x[i] + y[i]) % 2 - 1) for i in range(26)}
    pairs = spark.createDataFrame([(1, 0, 1)], "pair int, a int, b int")
    edges = spark.createDataFrame([(1, i, j) for i in near for j in near[i]], "pair int, src int, dst int")
    nodes = spark.createDataFrame([(1, i) for i in range(26)], "pair int, node int")
    assert {r.node: r.z for r in L.drnl_labels(nodes, edges, pairs).collect()} == want


def test_drnl_query(spark):
    g = graph_of_tables(spark, DATA).restrict(["knows", "created"])
    near = neighbours((r.src, r.dst) for r in g.undirected.collect())
    want = {}
    for r in g.edges.filter("label = 'knows' and src <> dst").collect():
        a, b = r.src, r.dst
        inside = {a, b} | near[a] | near[b]
        cut = lambda gone: {n: (near[n] & inside) - {gone} for n in inside if n != gone}
        x, y = distances(cut(b), a), distances(cut(a), b)
        for n in inside:
            h = (x.get(n, 0) + y.get(n, 0)) // 2
            z = 1 if n in (a, b) else 1 + min(x[n], y[n]) + h * (h + (x[n] + y[n]) % 2 - 1) if n in x and n in y else 0
            want[z] = want.get(z, 0) + 1
    assert {r.z: r.nodes for r in learning_queries.gml_drnl(spark, DATA).collect()} == want


def test_cells_recall(spark):
    d = DATA.replace("0.001", "0.01")
    pairs = lambda f: {(r.query, r.id) for r in f(spark, d).collect()}
    exact = pairs(learning_queries.vec_search_many)
    assert len(pairs(learning_queries.vec_search_cells) & exact) / len(exact) >= 0.9


def test_searches_over_all_labels(spark):
    g = graph_of_tables(spark, DATA)
    near = neighbours((r.src, r.dst) for r in g.undirected.collect())
    start = min(r.src for r in g.edges.filter("label = 'knows'").collect())
    far = distances(near, start)
    got = {n: {tuple(r) for r in traversal_queries.QUERIES[n](spark, DATA).collect()} for n in ("k_out", "k_neighbor", "shortest_paths_from", "shortest_path", "all_shortest_paths", "multi_node_paths")}
    assert got["k_out"] == {(start, n) for n, d in far.items() if d == 3}
    assert got["k_neighbor"] == {(start, n, d) for n, d in far.items() if 0 < d <= 4}
    all_paths = {start: [[start]]}
    for n in sorted(far, key=far.get):
        if n != start:
            all_paths[n] = [[*p, n] for x in near[n] if far[x] == far[n] - 1 for p in all_paths[x]]
    assert got["shortest_paths_from"] == {(start, n, float(d), ">".join(min(all_paths[n]))) for n, d in far.items() if 0 < d <= 4}
    end = max(n for n, d in far.items() if d == 4)
    assert got["shortest_path"] == {(start, end, 4.0, ">".join(min(all_paths[end])))}
    assert got["all_shortest_paths"] == {(">".join(p),) for p in all_paths[end]}
    ids = sorted(n for n, d in far.items() if 0 < d <= 2)[:4]
    assert got["multi_node_paths"] == {(a, b, float(distances(near, a)[b])) for a, b in combinations(ids, 2) if distances(near, a)[b] <= 4}


def test_paths_of_all_software(spark):
    g = graph_of_tables(spark, DATA)
    edges = [(r.id, r.src, r.dst) for r in g.edges.collect()]
    steps = {}
    for i, a, b in edges:
        steps.setdefault(a, []).append((i, False, b))
        if a != b:
            steps.setdefault(b, []).append((i, True, a))
    steps = {a: sorted(x)[:40] for a, x in steps.items()}
    want = set()
    for r in g.vertices.filter("label = 'software'").collect():
        one = [((r.id, b), (i,)) for i, _, b in steps.get(r.id, ()) if b != r.id]
        two = [((*p, b), (*e, i)) for p, e in one for i, _, b in steps[p[-1]] if b not in p]
        for n, (p, _) in enumerate(sorted(one + two, key=lambda x: (len(x[0]), *x))[:30], 1):
            want.add((r.price, r.id, n, ">".join(p)))
    got = {(r.q, r.start, r.path_no, r.vertices) for r in retrieval_queries.rag_paths(spark, DATA).collect()}
    assert got == want
    assert {(r.q, r.start, r.path_no) for r in retrieval_queries.rag_path_texts(spark, DATA).collect()} == {x[:3] for x in want}
    sets = {}
    for q, _, _, p in want:
        for i, v in enumerate(p.split(">")):
            sets.setdefault((q, i), set()).add(v)
    assert {(r.q, r.depth, r.vertices) for r in retrieval_queries.rag_depth_sets(spark, DATA).collect()} == {(*k, ",".join(sorted(v))) for k, v in sets.items()}


def test_texts_of_all_languages(spark):
    d = DATA.replace("0.001", "0.01")
    t = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang", X.without_stop_words(X.tokens(F.col("text"))).alias("t")).filter("size(t) > 0").cache()
    assert t.filter("lang is null or lang <> 'en'").count() > 0
    ids = {r[0] for r in text_queries.txt_hybrid_keywords(spark, d).select("id").distinct().collect()}
    assert ids == {r.doc_id for r in t.collect()}
    pairs = X.cooccurrence(t, "doc_id", "t", 2).groupBy("a", "b").agg(F.count("*").alias("docs")).filter("docs >= 5")
    assert {(r.a, r.b): r.docs for r in text_queries.txt_cooccurrence(spark, d).collect()} == {(r.a, r.b): r.docs for r in pairs.collect()}
