import asyncio
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessagraph.errors import GraphError, SchemaError
from tessagraph.functions import models as X
from tessagraph.functions import text as T
from tessagraph.graph import PropertyGraph, quoted_id
from tessagraph.operators import learning as L
from tessagraph.operators import loading as D
from tessagraph.operators import messages as M
from tessagraph.operators import models as K
from tessagraph.operators import retrieval as R
from tessagraph.operators import vectors as N
from tessagraph.plans import flows as W
from tessagraph.schema import checked_request, schema_of_dict
from tessagraph.sources import datasets as S

SCHEMA = {"vertexlabels": [{"name": "cook", "properties": ["title", "town"]}, {"name": "dish", "properties": ["title"]}], "edgelabels": [{"name": "makes", "source_label": "cook", "target_label": "dish"}]}


@pytest.fixture(scope="module")
def g(spark):
    v = spark.createDataFrame([("1:Ann", "cook", "Ann", "Lund"), ("1:Bea", "cook", "Bea", None), ("2:Pie", "dish", "Pie", None), ("2:Stew", "dish", "Stew", None)], "id string, label string, title string, town string")
    e = spark.createDataFrame([(1, "makes", "1:Ann", "2:Pie", 0.5), (2, "makes", "1:Ann", "2:Stew", 1.0), (3, "makes", "1:Bea", "2:Stew", 2.0), (4, "makes", "1:Bea", "2:Gone", 2.0)], "id bigint, label string, src string, dst string, w double")
    return PropertyGraph(v, e)


def test_graph_changes(g):
    assert {r.id: r.w for r in g.append_edge_properties([1, 2], {"w": F.lit(9.0)}).edges.collect()} == {1: 9.0, 2: 9.0, 3: 2.0, 4: 2.0}
    assert {r.id: r.w for r in g.eliminate_edge_properties([3], ["w"]).edges.collect()}[3] is None
    assert {r.id for r in g.rebuilt().edges.collect()} == {r.id for r in g.rebuilt("makes").edges.collect()} == {1, 2, 3} and g.rebuilt("zz").edges.count() == 4
    u = uuid.UUID(int=5)
    assert quoted_id("a/b") == '"a/b"' and quoted_id("a/b", path=True) == "%22a%2Fb%22" and quoted_id(7) == "7" and quoted_id(u) == f'U"{u}"'
    for bad, error in ((None, TypeError), (True, TypeError), (1.5, TypeError), (1 << 63, ValueError)):
        with pytest.raises(error):
            quoted_id(bad)


def test_requests():
    texts, schema = checked_request(["a", " ", ""], SCHEMA)
    assert texts == ["a"] and schema["vertexlabels"][0]["primary_keys"] == ["title"]
    assert checked_request("x", " my_graph ")[1] == "my_graph"
    for args in (("", SCHEMA), ("x", "{bad"), ("x", "no/name"), ("x", {}), ("x", SCHEMA, "page"), ("x", SCHEMA, "document", "xx")):
        with pytest.raises(SchemaError):
            checked_request(*args)


def test_extraction_by_models(spark):
    docs = spark.createDataFrame([(1, "some text")], "id bigint, text string")
    model = X.CannedModel(["(Ann, title, Ann) - cook (Ann, makes, Soup) - makes"])
    v, e = D.extract_triples(docs, model, schema=schema_of_dict(SCHEMA))
    assert {(r.id, tuple(r.properties.items())) for r in v.collect()} == {("cook-Ann", (("title", "Ann"),)), ("dish-Soup", ())}  # ends are vertices
    assert [(r.src, r.dst) for r in e.collect()] == [("cook-Ann", "dish-Soup")]
    v, e = D.extract_triples(docs, X.CannedModel(["(Ann, likes, Bea)"]))
    assert {r.id for r in v.collect()} == {"Ann", "Bea"} and e.first().name == "likes"
    rows = spark.createDataFrame([("a", "friend", "b"), ("c", "is friends with", "b"), ("c", "eats", "d")], "s string, p string, o string")
    said = D.unify_predicates(rows, X.CannedModel(["is friends with -> friend\nnothing -> x\nnoise"]))
    assert {tuple(r) for r in said.collect()} == {("a", "friend", "b"), ("c", "friend", "b"), ("c", "eats", "d")}
    assert D.unify_predicates(rows.limit(0), X.CannedModel([""])).count() == 0
    import json

    assert list(D.model_schema(["s"], X.CannedModel([f"```json\n{json.dumps(SCHEMA)}\n```"])).edge_labels) == ["makes"]
    for bad in ("none", "{broken", "{}"):
        with pytest.raises(SchemaError):
            D.model_schema(["s"], X.CannedModel([bad]))
    assert D.extraction_prompt("s", "c", "e", X.CannedModel([" do it "])) == "do it"
    with pytest.raises(SchemaError):
        D.extraction_prompt("", "c", "e", X.CannedModel(["x"]))
    text = 'Nodes: ["ann", "cook", {"town": "Lund", "old": True}], [x], [bea, cook, {bad}] Relationships: [ann, knows, bea, {"since": 3}], [a, b]'
    n, r = spark.createDataFrame([(text,), (None,)], "t string").select(*D.labelled_blocks(F.col("t"))).collect()[0]
    assert [(x["name"], x["label"], x["properties"]) for x in n] == [("ann", "cook", {"town": "Lund", "old": "true"}), ("bea", "cook", {})]
    assert [(x["start"], x["end"], x["type"], x["properties"]) for x in r] == [("ann", "bea", "knows", {"since": "3"})]


def test_text_splitters_and_tags(spark):
    df = spark.createDataFrame([("The cat sat, and sat. " * 20,), (None,)], "t string")
    got = [r[0] for r in df.select(T.legacy_chunks(F.col("t"), "sentence", "en")).collect()]
    assert all(len(c) <= 50 for c in got[0]) and got[1] == []
    tag = lambda ts: ["NN" if t == "cat" else "VB" for t in ts]
    assert set(df.select(T.tagged_tokens(F.col("t"), tag)).first()[0]) == {"cat"} and "sat" in df.select(T.tagged_tokens(F.col("t"))).first()[0]
    one = spark.createDataFrame([(["only"],), (["a", "b", "a", "c"],), ([],)], "t array<string>").select(T.textrank(F.col("t")).alias("s")).collect()
    assert [(w.word, w.score) for w in one[0].s] == [("only", 1.0)] and max(w.score for w in one[1].s) == 1.0 and one[2].s == []


def test_models_and_sheets(spark):
    m = X.Models().register("fake", lambda: X.TextModel(lambda p: p.upper(), lambda p: iter([p, "!"]))).assign("chat", "fake")
    t = m.of("query")
    assert t("a b") == "A B" and list(t.pieces("a")) == ["a", "!"] and asyncio.run(t.later("x")) == "X" and t.tokens("a b c") == 3 and list(X.TextModel(str.upper).pieces("q")) == ["Q"]
    with pytest.raises(ValueError):
        m.assign("chat", "none")
    with pytest.raises(ValueError):
        X.Models().of("chat")
    q = spark.createDataFrame([(1, "why"), (2, "how")], "q bigint, question string")
    sheet = X.answer_sheet(q, {"raw": lambda x: W.answers(x, "raw", X.CannedModel(["yes"])), "loud": lambda x: X.batch_answers(x, "{query}", str.upper)}, preview=1)
    assert [tuple(r) for r in sheet.collect()] == [(1, "why", "yes", "WHY")]


def test_retrieval(spark, g):
    q = spark.createDataFrame([(1, "which dish makes Ann"), (2, "Lund")], "q bigint, question string")
    words = spark.createDataFrame([(1, "Ann"), (1, "zzz"), (2, "Lund")], "q bigint, keyword string")
    near = lambda left: left.select("q", F.concat(F.lit("near-"), "keyword").alias("id"))
    assert {tuple(r) for r in R.semantic_ids(words, g.vertices, 2, near).collect()} == {(1, "1:Ann"), (1, "near-zzz"), (2, "near-Lund")}
    assert {tuple(r) for r in R.property_starts(words, g.vertices, ["title", "town"]).collect()} == {(1, "1:Ann"), (2, "1:Ann")}
    assert [(r.id, r.properties) for r in R.vertex_details(g.vertices, words.select(F.concat(F.lit("1:"), "keyword").alias("id"))).collect()] == [("1:Ann", {"title": "Ann", "town": "Lund"})]
    paths = R.expand(g, spark.createDataFrame([(1, "1:Ann")], "q bigint, id string"))
    ordered = R.near_neighbours_first(q, g, paths).orderBy("order").collect()
    assert [r.order for r in ordered] == list(range(1, paths.count() + 1)) and {len(r.path) for r in ordered} == {2, 3}
    both = spark.createDataFrame([(1, "aa"), (1, "b"), (1, "b"), (2, "c")], "q bigint, text string")
    assert {(r.q, r.text) for r in R.rerank_top(both, q, lambda a, b: len(b), 1).collect()} == {(1, "aa"), (2, "c")} and R.rerank_top(both, q, lambda a, b: 0.0).count() == 3
    with pytest.raises(ValueError):
        R.rerank_top(both, q, lambda a, b: 0.0, -1)
    other = lambda qs: spark.createDataFrame([(i, "graph", "paths") for i in qs], "q bigint, source string, text string")
    got = {(r.q, r.text) for r in R.graph_results(g, {1: "g.V().has('title','Ann').values('town')", 2: "g.V(", 3: None, 4: "g.V('none')"}, other).collect()}
    assert got == {(1, '{"value":"Lund"}'), (2, "paths"), (3, "paths"), (4, "paths")}


def test_flows(spark, g, tmp_path):
    emb = X.hashing_embedder(16)
    q = spark.createDataFrame([(1, "Ann")], "q bigint, question string")
    pairs = spark.createDataFrame([("Ann", "g.V('1:Ann')"), (None, "x")], "query string, gremlin string")
    index = W.example_index(pairs, N.index_of(spark, N.index_path(str(tmp_path), "food", "examples"), "flat"), emb)
    assert index.info().first().rows == 1 and N.index_path("r/", "g", "ids", "s") == "r/s_g/ids"
    with pytest.raises(GraphError):
        N.index_of(spark, "x", "other")
    model = lambda prompt: "```gremlin\ng.V('1:Ann').values('town')\n```" if "1:Ann" in prompt else "```gremlin\ng.V(\n```"
    r = W.ask_in_words(q, g, index, emb, model)[0]
    assert (r["rows"], r["error"], r["raw_rows"]) == ([{"value": "Lund"}], "", None) and r["raw_error"]
    assert W.index_report(g, index, N.VectorIndex(spark, str(tmp_path / "none"))) == {"vertices": 4, "edges": 4, "indices": [{"dim": 16, "rows": 1}, None]}
    assert {r.id for r in W.graph_only(q.withColumn("question", F.lit("Ann Bea")), PropertyGraph(g.vertices.withColumn("id", F.lower("id")), g.edges), 2, stop="vertices").collect()} == {"1:ann", "1:bea"}
    low = PropertyGraph(g.vertices.withColumn("id", F.lower("id")), g.edges.withColumns({"src": F.lower("src"), "dst": F.lower("dst")}))
    chain = W.Chain(q, low, 2).keywords().match().expand().merge()
    assert chain.found.count() > 0 and "1:ann" in chain.answer(lambda p: p).first().answer
    assert W.Chain(q).answer(str.upper).first().answer == "ANN"


def test_messages(spark):
    e = spark.createDataFrame([(0, 1), (1, 0), (1, 2), (2, 1)], "src int, dst int")
    x = spark.createDataFrame([(i, d, float(i + d)) for i in range(3) for d in range(2)], "node int, dim int, val double")
    X0 = np.array([[0.0, 1], [1, 2], [2, 3]])
    A = np.array([[0, 1, 0], [1, 0, 1], [0, 1, 0]], float)
    deg = A.sum(1)
    D_ = A / np.sqrt(deg)[:, None] / np.sqrt(deg)[None, :]
    dense = lambda df, w: np.array([[{(r.node, r.dim): r.val for r in df.collect()}.get((i, d), 0.0) for d in range(w)] for i in range(3)])
    assert np.allclose(dense(M.jumping_sum(x, e, 1, 2), 4), A @ np.concatenate([X0, D_ @ X0], 1))
    assert np.allclose(dense(M.recursive_stacks(x, e, [(0.5, 1.0), (-1.0, 0.5)], 2), 2), sum(np.maximum(0, w * D_ @ np.maximum(0, w * D_ @ X0 + v * X0) + v * X0) for w, v in ((0.5, 1.0), (-1.0, 0.5))) / 2)
    big = M.softmax_aggregate(spark.createDataFrame([(1, 0, 800.0), (1, 0, 1.0)], "dst int, dim int, val double")).first().val
    assert big == 800.0
    m = M.message_norm(x, x.withColumn("val", F.col("val") * 7), 2.0)
    assert np.allclose(dense(m, 2), 2 * X0)
    att = {(r.graph_id, r.dim): r.val for r in M.attention_readout(x, spark.createDataFrame([(0, 5), (1, 5), (2, 6)], "node int, graph_id int"), [1000.0, 0.0]).collect()}
    assert att[5, 0] == pytest.approx(1) and att[6, 1] == 3
    s, p = M.anchor_messages(x, spark.createDataFrame([(0, 0, 2, 0.5), (0, 1, 1, 1.0)], "node int, set int, anchor int, closeness double"), [1.0, 2.0])
    assert {r.dim: r.val for r in s.collect()} == {0: 1.0, 1: 2.75} and {r.set: r.val for r in p.collect()} == {0: 6.0, 1: 7.0}
    b = M.ShareBandit({"a": 0.5, "b": 0.01})
    for k in range(12):
        b = b.update(k, {"a": float(k % 2), "b": float(k)})
    assert "a" in b.settled and 0 < b.share["b"] <= 0.03 and "b" not in b.settled


def test_learning_data_and_tasks(spark):
    nodes = spark.range(40).select(F.col("id").alias("idx"))
    e = spark.createDataFrame([(i, (i + 1) % 40) for i in range(40)], "src bigint, dst bigint")
    pairs = {tuple(r) for r in L.block_pairs(nodes).collect()}
    assert len(pairs) == 2 * 190 and all(a > b and a // 20 == b // 20 for a, b in pairs)
    w = {tuple(r) for r in L.rewired(e, 40, 0.5).collect()}
    assert all((b, a) in w and a != b for a, b in w) and len(w) > 60
    no = L.negative_edges(e, 40, 3).collect()
    assert len(no) > 100 and not {tuple(r) for r in no} & {tuple(r) for r in e.collect()} and all(r.src != r.dst for r in no)
    lab = {r.label: r["count"] for r in L.labelled_pairs(e, 40, 1, 0.5).groupBy("label").count().collect()}
    assert 5 < lab[1] < 35
    x = spark.createDataFrame([(i, [float(i % 2), 1.0]) for i in range(40)], "node bigint, feat array<double>")
    labels = spark.createDataFrame([(i, i % 2, i < 30) for i in range(40)], "node bigint, label int, train boolean")
    loops = spark.createDataFrame([(i, i, [float(i % 2)]) for i in range(40)], "src bigint, dst bigint, feat array<double>")
    assert K.node_classifier_with_edges(x, loops, labels, F.col("train"), 2, 1)[1].first().accuracy == 1
    graph_of = spark.createDataFrame([(i, i // 2 * 2 + i % 2) for i in range(40)], "node bigint, graph_id bigint")
    assert K.graph_classifier(x, loops, graph_of, labels.withColumnRenamed("node", "graph_id"), F.col("train"), 2)[1].first().accuracy == 1
    assert K.consistent_classifier(x, loops, labels, F.col("train"), 2, 0.9, 1, 2)[1].first().accuracy > 0.8
    task = {r.metric: r.value for r in K.link_task(x, spark.createDataFrame([(1, 3, 1), (5, 7, 1), (0, 2, 0), (2, 4, 0)], "a bigint, b bigint, label int"), (1,)).collect()}
    assert task == {"auc": 1.0, "hits_1": 1.0}
    counts = spark.createDataFrame([(i, i % 2, 2 + i % 2, 3, i < 30) for i in range(40)], "pair bigint, label int, z int, n int, train boolean")
    scores, auc = K.subgraph_link_classifier(counts, F.col("train"))
    assert auc.first().auc == 1 and K.detector_recall(scores).first().recall == 1
    v, ed, gr = S.graph_collection(spark.createDataFrame([(7, 0, [1.0]), (7, 1, [2.0])], "graph_id int, node int, feat array<double>"), spark.createDataFrame([(7, 0, 1), (7, 1, 5)], "graph_id int, src int, dst int"), spark.createDataFrame([(7, 1)], "graph_id int, class int"))
    assert {r.id for r in v.collect()} == {"7-0", "7-1"} and [(r.src, r.dst, r.graph_id) for r in ed.collect()] == [("7-0", "7-1", 7)] and gr.count() == 1
    split = {r.split for r in L.split_graphs(nodes.withColumnRenamed("idx", "graph_id"), L.arithmetic_hash(F.col("graph_id"), 1) / 1_000_003).collect()}
    assert split == {"train", "valid", "test"}


def test_keywords_streams_and_sources(spark, g, tmp_path):
    from tessagraph.admin import GraphSession
    from tessagraph.errors import NotFoundError
    from tessagraph.operators.traversal import sources_where

    q = spark.createDataFrame([(1, "Ann cooks stew")], "q bigint, question string")
    said = X.CannedModel(["KEYWORDS:ann:0.9, stew:0.2, pie:1.0"])
    assert {r.keyword for r in W.extract_keywords(q, 2, "model", said).collect()} == {"pie", "ann"}
    assert "ann" in {r.keyword for r in W.extract_keywords(q, 3, "hybrid", said).collect()} and W.extract_keywords(q, 2).count() == 2
    with pytest.raises(ValueError):
        W.extract_keywords(q, 2, "other")
    q.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(q.schema).parquet(str(tmp_path / "in"))
    W.answer_stream(stream, lambda b: W.answers(b, "raw", X.CannedModel(["yes"])), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert [(r.q, r.answer) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(1, "yes")]
    assert W.example_pairs([{"description": "d", "gremlin": "g.V()", "x": 1}, {"description": "d"}, "x"]) == [{"description": "d", "gremlin": "g.V()"}]
    assert {r.source for r in sources_where(g.vertices, "cook", {"title": ["Ann", "Zoe"]}).collect()} == {"1:Ann"} and sources_where(g.vertices).count() == 4
    s = GraphSession(spark)
    assert "spark.app.name" in s.conf()
    with pytest.raises(NotFoundError):
        s.task(10**9)
    old = '{"vertices": [], "edges": [{"label": "makes", "source": "a", "target": "b", "properties": {}}]}'
    e = spark.createDataFrame([(old,)], "t string").select(F.inline(D.json_graph(F.col("t")))).first()
    assert (e.outV, e.inV, e.type) == ("a", "b", "edge")
