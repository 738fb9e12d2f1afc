import numpy as np
import pytest
from pyspark.sql import functions as F

from tessagraph.functions import models, text
from tessagraph.graph import PropertyGraph
from tessagraph.operators import learning as L
from tessagraph.operators import messages as M
from tessagraph.operators import metrics as S
from tessagraph.operators import vectors as N


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_text_functions(spark):
    df = spark.createDataFrame([(1, "One. Two! 三。四", "KEYWORDS:Graph:0.5, Bad, x:9，y:-1"), (2, None, None), (3, "", "")], "id int, t string, r string")
    assert [list(r[0] or []) for r in df.select(text.sentences(F.col("t"))).collect()] == [["One.", "Two!", "三。", "四"], [], []]
    assert [[(w.word, w.score) for w in (r[0] or [])] for r in df.select(text.parse_keywords(F.col("r"))).collect()][0] == [("graph", 0.5), ("x", 1.0), ("y", 0.0)]
    one = spark.range(1)
    tok = lambda s: one.select(text.tokens(F.lit(s))).first()[0]
    assert tok("See https://a.b/c or a.b@c.de, state-of-the-art 3.14 don't") == ["see", "https://a.b/c", "or", "a.b@c.de", "state-of-the-art", "3.14", "don't"]
    b = lambda q, c, n=2: one.select(text.bleu(F.lit(q.split()), F.lit(c.split()), n)).first()[0]
    assert b("a b c", "a b c") == pytest.approx(1) and b("a b c", "x y") == 0 and b("a b c d", "a b") == pytest.approx(np.exp(-1)) and b("a a b", "a a a b") == pytest.approx(np.sqrt(3 / 4 * 2 / 3))
    j = one.select(text.redact(F.lit('{"a": {"API_KEY": "x\\"y", "n": 1}, "password": 12, "t": [1]}'))).first()[0]
    assert j == '{"a": {"API_KEY": "***", "n": 1}, "password": "***", "t": [1]}'
    ranked = df.select("id", text.textrank(text.tokens(F.coalesce("t", F.lit("")))).alias("s")).collect()
    assert {r.id: len(r.s) for r in ranked} == {1: 4, 2: 0, 3: 0}
    assert max(w.score for w in ranked[0].s) == 1.0
    chunks = text.split_text("para one.\n\n" + "word " * 300 + "\n\nlast", 100, 20)
    assert all(len(c) <= 100 for c in chunks) and chunks[0].startswith("para one.") and chunks[-1].endswith("last") and text.split_text(None) == []
    assert all(len(c) <= 50 for c in text.split_text("x" * 500, 50, 10))


def test_vectors(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vec array<double>")
    q = df.filter("id % 50 = 0")
    for metric in ("l2sq", "cosine"):
        u = x / np.linalg.norm(x, axis=1)[:, None]
        d = ((x[:, None] - x[None]) ** 2).sum(-1) if metric == "l2sq" else 1 - u @ u.T
        want = {i: [int(j) for j in np.lexsort((np.arange(300), np.round(d[i], 12)))[:4]] for i in range(0, 300, 50)}
        got = {}
        for r in N.search_many(df, "id", "vec", q.withColumnRenamed("id", "query"), "query", 4, metric=metric, rows_per_block=70, queries_per_block=2).orderBy("query", "distance", "id").collect():
            got.setdefault(r.query, []).append(r.id)
        assert got == want
        assert [r.id for r in N.search(df, "id", "vec", x[0].tolist(), 4, metric=metric).collect()] == want[0]
    c = N.fit_cells(df, "vec", 10)
    got = {(r.query, r.id) for r in N.search_cells(df, "id", "vec", q.withColumnRenamed("id", "query"), "query", 4, c, 6, rows_per_block=20).collect()}
    exact = {(r.query, r.id) for r in N.search_many(df, "id", "vec", q.withColumnRenamed("id", "query"), "query", 4).collect()}
    assert len(got & exact) / len(exact) > 0.9
    index = N.VectorIndex(spark, str(tmp_path / "i"))
    assert not index.exists()
    index.add(df.select("id", "vec", F.col("id").cast("string").alias("payload")))
    index.add(spark.createDataFrame([(999, [0.0] * 8, "zero")], "id bigint, vec array<double>, payload string"))
    assert (index.info().first().dim, index.info().first().rows) == (8, 301)
    assert index.search([0.0] * 8, 1).first().id == "zero"
    assert index.remove(spark.createDataFrame([("zero",), ("none",)], "payload string")) == 1 and index.info().first().rows == 300
    index.add(spark.createDataFrame([(999, [0.0] * 8, "zero")], "id bigint, vec array<double>, payload string"))  # what comes after a removal stays
    assert index.info().first().rows == 301 and index.compact().info().first().rows == 301 and index.remove(spark.createDataFrame([("zero",)], "payload string")) == 1
    index.add(spark.createDataFrame([(1, [1.0], "a")], "id bigint, vec array<double>, payload string"))
    assert index.info().first().dim == 1
    index.clean()
    assert not index.exists()


def test_learning(spark):
    df = spark.createDataFrame([(c,) for c in "dbacebf"], "id string")
    idx = {r.id: r.idx for r in L.dense_index(df, "id").collect()}
    assert sorted(r.idx for r in L.dense_index(df, "id").collect()) == list(range(7)) and idx["a"] == 0 and idx["f"] == 6
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    both = L.bidirected(e)
    pairs = spark.createDataFrame([(1, "a", "b")], "pair bigint, a string, b string")
    n, se = L.enclosing_subgraphs(both, pairs, 2)
    assert {r.node for r in n.collect()} == {"a", "b", "c", "d"} and ("a", "b") not in {(r.src, r.dst) for r in se.collect()}
    assert {r.node: r.z for r in L.drnl_labels(n, se, pairs).collect()} == {"a": 1, "b": 1, "c": 2, "d": 5}
    w = L.random_walks(both, spark.createDataFrame([("a",), ("z",)], "source string"), 3, 5).collect()
    edges = {(r.src, r.dst) for r in both.collect()}
    assert len(w) == 6 and all((x, y) in edges for r in w for x, y in zip(r.path, r.path[1:])) and all(len(r.path) == (5 if r.source == "a" else 1) for r in w)
    assert rows(L.skip_grams(spark.createDataFrame([(["x", "y", "z"],)], "path array<string>"), 2)) == [("x", "y"), ("y", "x"), ("y", "z"), ("z", "y")]
    neg = L.negative_edges(spark.range(200).selectExpr("id src", "(id + 1) % 200 dst"), 200, 2)
    assert 300 < neg.count() <= 400 and neg.join(spark.range(200).selectExpr("id src", "(id + 1) % 200 dst"), ["src", "dst"]).count() == 0
    m = L.mask_features(spark.createDataFrame([([1.0] * 50,)], "feat array<double>"), "feat", 50, 0.5).first().feat
    assert 5 < sum(m) < 45
    t = spark.createDataFrame([(1.0, "x", 2.0, True), (3.0, "x", 4.0, True), (None, "y", 9.0, False)], "a double, c string, y double, tr boolean")
    assert rows(L.normalize_features(L.replace_missing(t, ["a"], F.col("tr")), ["a"], F.col("tr")).select("a")) == [(-0.5,), (0.0,), (1.0,)]
    assert {(r.c, r.c_enc) for r in L.target_encode(t, "c", "y", F.col("tr")).collect()} == {("x", 3.0), ("y", 3.0)}
    assert rows(L.mask_splits(spark.createDataFrame([("a", "b", 1, 0), ("c", "d", -1, 1)], "src string, dst string, m1 int, m2 int"), {"train": "m1", "test": "m2"})) == [("a", "b", "train"), ("c", "d", "test")]


def test_messages(spark):
    a = np.array([[0, 1, 1, 0], [1, 0, 1, 0], [1, 1, 0, 1], [0, 0, 1, 0]], float)
    x = np.array([[1.0, 2], [0, 1], [3, 0], [1, 1]])
    e = spark.createDataFrame([(i, j) for i in range(4) for j in range(4) if a[i, j]], "src int, dst int")
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node int, feat array<double>")
    lx = M.long(nodes)
    dense = lambda df: np.array([df_map.get((i, d), 0.0) for df_map in [{(r.node, r.dim): r.val for r in df.collect()}] for i in range(4) for d in range(2)]).reshape(4, 2)
    deg = a.sum(0)
    dad = a / np.sqrt(deg[:, None] * deg[None, :])
    assert np.allclose(dense(M.propagate(lx, M.normalized(e))), dad.T @ x)
    assert np.allclose(dense(M.mean_of_powers(lx, e, 2)), (x + dad @ x + dad @ dad @ x) / 3)
    h = x
    for _ in range(2):
        h = np.clip(0.6 * dad @ h + 0.4 * x, 0, 1)
    assert np.allclose(dense(M.label_propagation(lx, e, 2, 0.6)), h)
    assert np.allclose(dense(M.isomorphism(lx, e)), x + a @ x)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    w = np.exp(u @ u.T) * a
    assert np.allclose(dense(M.attention(lx, e)), (w / w.sum(0)).T @ x)
    s = spark.createDataFrame([(i, c, 0.5) for i in range(4) for c in range(2)], "node int, cluster int, s double")
    pooled, adj = M.soft_pool(lx, s, e)
    assert sum(r.w for r in adj.collect()) == pytest.approx(a.sum()) and M.entropy_loss(s).first().loss == pytest.approx(np.log(2))
    assert {r.graph_id: r.val for r in M.readout(lx.filter("dim = 0"), nodes.select("node", F.lit(1).alias("graph_id")), "max").collect()} == {1: 3.0}
    soft = spark.createDataFrame([(i, d, 0.5) for i in range(4) for d in range(2)], "node int, dim int, val double")
    lab = spark.createDataFrame([(0, 0, 1.0), (0, 1, 0.0)], "node int, dim int, val double")
    fixed = dense(M.correct_and_smooth(soft, lab, e))
    assert fixed[0, 0] > fixed[0, 1] and fixed[1, 0] > fixed[1, 1]
    p = M.power_mean_aggregate(spark.createDataFrame([(1, 0, 1.0), (1, 0, 3.0)], "dst int, dim int, val double"), 2.0).first().val
    assert p == pytest.approx(np.sqrt(5))


def test_scores(spark):
    s = S.EarlyStopping(patience=2)
    assert [s.update(v) for v in (3, 2, 2.5, 2.1)] == [False, False, False, True] and s.best_step == 1
    rates = {r.step: r.rate for r in S.warmed_cosine(spark.createDataFrame([(0,), (5,), (10,), (15,), (20,), (21,)], "step int"), 1.0, 10, 20).collect()}
    assert rates == {0: 0.0, 5: 0.5, 10: 1.0, 15: pytest.approx(0.5), 20: pytest.approx(0), 21: None}


def test_score_tables(spark):
    rng = np.random.default_rng(1)
    y, v = rng.integers(0, 2, 200), np.round(rng.normal(size=200), 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, v)], "label int, score double")
    want = np.mean([(p > n) + 0.5 * (p == n) for p in v[y == 1] for n in v[y == 0]])
    assert S.auc(df).first().auc == pytest.approx(want)
    assert S.auc(df.filter("label = 1")).first().auc is None
    assert S.hits_at(df.filter("label = 1"), df.filter("label = 0"), 5).first().hits == pytest.approx(np.mean(v[y == 1] > np.sort(v[y == 0])[-5]))
    assert S.hits_at(df.filter("label = 1"), df.limit(0), 5).first().hits == 1.0


def test_learners(spark):
    from tessagraph.operators.models import Features, boosted_residuals, link_scores, node_classifier, walk_embeddings, weighted_detector

    n = 60
    nodes = spark.createDataFrame([(i, [float(i % 2), float((i * 7) % 5) / 5], i % 2, i % 3 != 0) for i in range(n)], "node int, feat array<double>, label int, tr boolean")
    edges = spark.createDataFrame([(i, (i + 2) % n) for i in range(n)], "src int, dst int")
    labels = nodes.select("node", "label", "tr")
    for kind in ("powers", "personalized", "isomorphism", "beside", "attention", "none"):
        feats = Features(kind).make(nodes.select("node", "feat"), edges, 2)
        assert feats.count() == n
    assert node_classifier(feats, labels, F.col("tr"))[1].first().accuracy == 1.0
    assert node_classifier(feats, labels, F.col("tr"), (4,))[1].first().accuracy >= 0.5
    assert weighted_detector(feats, labels, F.col("tr"))[1].first().auc == 1.0
    assert link_scores(feats, spark.createDataFrame([(1, 3)], "a int, b int")).count() == 1
    walks = spark.createDataFrame([(["a", "b", "a", "b"],)] * 5, "path array<string>")
    assert walk_embeddings(walks, 4).count() == 2
    t = nodes.select("node", F.col("feat")[0].alias("x"), (F.col("label") * 10).alias("y"))
    assert boosted_residuals(t, ["x"], "y", edges).join(t, "node").agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 4


def test_models_and_flows(spark, tmp_path):
    from tessagraph.operators.vectors import VectorIndex
    from tessagraph.plans import flows
    from tessagraph.schema import schema_of_dict

    q = spark.createDataFrame([(1, "who created lop"), (2, None)], "q bigint, question string")
    a = {r.q: r.answer for r in models.batch_answers(q, "ask: {query}", lambda p: p.upper()).collect()}
    assert a == {1: "ASK: WHO CREATED LOP", 2: "ASK: "}
    with pytest.raises(ValueError):
        models.fill("{x}", y=F.lit(1))
    fake = models.CannedModel(["a", "b"])
    assert [fake("p"), fake("q"), fake("r")] == ["a", "b", "a"] and fake.seen == ["p", "q", "r"]
    g = PropertyGraph(spark.createDataFrame([("1:marko", "person", "marko"), ("2:lop", "software", "lop")], "id string, label string, name string"), spark.createDataFrame([(1, "created", "1:marko", "2:lop", 0.4)], "id bigint, label string, src string, dst string, weight double"))
    recall = flows.graph_recall(q.filter("q = 1"), g, 2).collect()
    assert [r.text for r in recall] == ["2:lop{name: lop}<--[created{weight: 0.4}]--1:marko{name: marko}"]
    docs = spark.createDataFrame([(1, "lop is software"), (2, "rain falls")], "id bigint, text string")
    emb = models.hashing_embedder(32)
    index = flows.build_chunk_index(docs, VectorIndex(spark, str(tmp_path / "c")), emb)
    out = flows.answers(q.filter("q = 1"), "graph_vector", lambda p: p, g, 2, index, emb).first().answer
    assert out.startswith("1. 2:lop{name: lop}<--") and "lop is software" in out and out.endswith("who created lop")
    assert flows.answers(q.filter("q = 1"), "raw", lambda p: "x").first().answer == "x"
    assert [flows.answer_kind(*f) for f in [(1, 0, 0, 0), (1, 1, 0, 0), (0, 0, 1, 0), (0, 1, 1, 0), (0, 0, 0, 1)]] == ["raw", "vector", "graph", "graph_vector", "graph_vector"]
    ids = VectorIndex(spark, str(tmp_path / "v"))
    assert flows.refresh_index(g.vertices.select("id"), ids, emb) == (0, 2)
    assert flows.refresh_index(spark.createDataFrame([("2:lop",), ("1:new",)], "id string"), ids, emb) == (1, 1)
    s = schema_of_dict({"vertexlabels": [{"name": "person", "properties": ["name"]}], "edgelabels": []})
    got = flows.extract_graph(docs, s, lambda p: '{"vertices": [{"id": "x", "label": "person", "properties": {"name": "Ann"}}], "edges": []}')
    assert [r.id for r in got["vertices"].collect()] == ["1:Ann"]


def test_sources_streams_admin(spark, tmp_path):
    from tessagraph.admin import GraphSession
    from tessagraph.errors import NotFoundError, ParseError
    from tessagraph.sources import readers as R
    from tessagraph.streaming.streams import each_batch, merge_tokens

    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "p.csv").write_text('query,gremlin\n"a, b","g.V()\n.count()"\nc,d\n')
    (tmp_path / "e.edges").write_text("1 a b\n2 b c\n")
    assert [r.text for r in R.read_documents(spark, str(tmp_path / "a.txt")).collect()] == ["one\ntwo"]
    assert rows(R.read_pairs(spark, str(tmp_path / "p.csv"))) == [("a, b", "g.V()\n.count()"), ("c", "d")]
    assert R.read_typed_edges(spark, str(tmp_path / "e.edges")).count() == 4
    assert R.read_json_graph(spark, '{"vertices": [{"id": "1", "label": "p"}], "edges": []}').count() == 1
    with pytest.raises(ParseError):
        R.read_json_graph(spark, "{")
    g = PropertyGraph(spark.createDataFrame([("1", "p", "n")], "id string, label string, name string"), spark.createDataFrame([(1, "k", "1", "1")], "id bigint, label string, src string, dst string"))
    R.write_graph(g, str(tmp_path / "g"))
    assert R.read_graph(spark, str(tmp_path / "g")).vertices.count() == 1
    assert [R.backup(g, str(tmp_path / "b"), f"2024-01-0{i}", keep=2) for i in (1, 2, 3)] == [[], [], ["2024-01-01"]]
    s = GraphSession(spark)
    s.set_variable("a", 1)
    assert s.variable("a") == 1 and s.variables() == {"a": 1} and s.tasks() == [] and s.metrics()["parallelism"] > 0 and "spark" in s.version()
    with pytest.raises(NotFoundError):
        s.variable("b")
    src = tmp_path / "s"
    src.mkdir()
    (src / "1.json").write_text('{"kind":"raw","seq":2,"token":"b"}\n{"kind":"raw","seq":1,"token":"a"}\n{"kind":"graph","seq":1,"token":"x"}\n')
    stream = spark.readStream.schema("kind string, seq bigint, token string").json(str(src))
    got = []
    q = merge_tokens(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ck")).foreachBatch(lambda df, i: got.extend(tuple(r) for r in df.collect())).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(got) == [("graph", "x", 1), ("raw", "ab", 2)]
    n = []
    each_batch(stream, lambda df, i: n.append(df.count()), str(tmp_path / "ck2")).awaitTermination()
    assert sum(n) == 3
