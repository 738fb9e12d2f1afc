import random
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest

from tessagraph.llm import neighbours
from tessagraph.llm.names import components, entity_pairs, lcs, link_names, one_slip, read_company, read_person
from tessagraph.llm.neighbours import GraphRule, NearLists, nearest_vectors
from tessagraph.llm.recall import recall
from tessagraph.session import shared_dir


@pytest.mark.parametrize("name", ["Matthew Trombemwyn", "Trombemwyn, Matt", 'Matthew "Matt" Trombemwyn', "TROMBEMWYN Matthew", "Dr. matthew  trómbemwyn", "MatthewTrombemwyn", "Mathew J. Trombemwyn", "trombemwyn matthew"])
def test_persons(name):
    assert read_person(name) == (["trombemwyn"], ["matthew"], "")


def test_other_readings():
    assert read_person("T. Weasgro") == (["weasgro"], [], "t") == read_person("Weasgro, T.")
    assert read_person("Ted Weasgro")[1] == ["edward", "theodore"]
    for n in ("Foods Trumcrai Grp", "Trumcrai Fds Grp.", "Trumcrai (Jodapimu) Foods Grp.", "The Trumcrai-Foods Company Limited", "TRUMCRAI FOODS"):
        assert read_company(n, "Jodapimu") == (["trumcrai"], ["foods"], "")
    assert read_company("Trumcrai Grp", "x", "Foods")[1] == ["foods"] and read_company("Inc.", None)[0] == ["inc"] and read_person("") == ([], [], "")


def test_lcs_and_slips():
    def plain_lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rng = random.Random(0)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in "xy")
        assert lcs(a, b) == plain_lcs(a, b)
    assert one_slip("abcd", "abdc") and one_slip("abc", "abxc") and one_slip("abc", "ab") and not one_slip("abc", "bca") and not one_slip("ab", "cd")


def rows(spark, data):
    return spark.createDataFrame(data, "id string, kind string, name string, field string, place string, hint string, entity string")


@pytest.mark.parametrize("chunk", [2, 500])
def test_links(spark, chunk):
    data = [(i, "person", n, "1950-01-01", None, None, "z") for i, n in [("a", "Joseph Troscoley"), ("b", "Troscoley, Joe"), ("c", "Jospeh Troscoley"), ("d", "Josephine Troscoley"), ("e", "J. Troscoley"), ("f", "Robert Troscoley"), ("g", "R. Troscoely"), ("h", "Q. Alone"), ("i", "Q. Alone"), ("j", None)]]
    data += [("k", "person", "Joseph Troscoley", "1950-01-02", None, None, "z"), ("l", "person", "Joseph Troscoley", None, None, None, "z"), ("a", "person", "Joseph Troscoley", "1950-01-01", None, None, "z")]
    data += [(i, "company", n, "1990|X", "X", None, "z") for i, n in [("m", "Bimbork Energy Inc."), ("n", "Bimbork Enrg."), ("o", "Bimbork Mining"), ("p", "Bimbork Inc"), ("q", "Zarkel Foods"), ("r", "Zarkle Ltd")]]
    # Names that no list has: a slip in the given name, another given name, and another line of business.
    data += [(i, "person", n, "1960-01-01", None, None, "z") for i, n in [("s", "Siobhan Keller"), ("t", "Siobahn Keller"), ("u", "Siegrun Keller")]]
    data += [(i, "company", n, "1991|X", "X", None, "z") for i, n in [("v", "Nuvizeve Brewing"), ("w", "Nuvizeve Fishing"), ("x", "Nuvizeve Brewng Ltd")]]
    got = {(r.id_a, r.id_b) for r in entity_pairs(link_names(rows(spark, data), chunk=chunk)).collect()}
    want = {("a", "b"), ("a", "c"), ("b", "c"), ("f", "g"), ("h", "i"), ("m", "n"), ("q", "r"), ("s", "t"), ("v", "x")}
    assert got == want | {(x, "e") for x in "abcd"} | {(x, "p") for x in "mno"}  # readings that fit two entities go with both


@pytest.mark.parametrize("seed", range(3))
def test_tasks_and_joins_link_alike(spark, seed):
    rng = random.Random(seed)
    given, last = ["Robert", "Bob", "Robrt", "R.", "Rosalind", "Edward", "Ted", "E.", "Theodore"], ["Weasgro", "Wesgro", "Weasgor", "Troscoley", "Trosley"]
    trade = ["Energy", "Enrg", "Foods", "", "Mining"]
    data = [(f"p{i:03}", "person", f"{rng.choice(given)} {rng.choice(last)}", f"1950-01-0{rng.randrange(1, 3)}", None, None, "z") for i in range(60)]
    data += [(f"c{i:03}", "company", f"{rng.choice(last)} {rng.choice(trade)} Ltd", "1990|X", "X", None, "z") for i in range(40)]
    one, many = ({tuple(r) for r in link_names(rows(spark, data), chunk=c).collect()} for c in (500, 3))
    assert one == many and len({e for _, e in one}) > 5


def test_links_empty(spark):
    assert link_names(rows(spark, [])).count() == 0
    assert [tuple(r) for r in link_names(rows(spark, [("a", "person", None, None, None, None, "z")])).collect()] == [("a", "a")]


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(7, 7), (200, 200)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def vectors(n, copies=0):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 16))
    for i in range(0, n // 4):
        x[n - 1 - i] = x[i] + rng.normal(size=16) * 0.05
    data = [(i, v.tolist(), "l") for i, v in enumerate(x)]
    data += [(10_000 + i, (x[3] * (i + 1)).tolist(), "l") for i in range(copies)]
    bad = [None, [], [0.0] * 16, [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    return data + [(20_000 + i, v, "l") for i, v in enumerate(bad)]


def brute(data, k):
    ok = [(i, v) for i, v, _ in data if i < 20_000]
    ids, x = np.array([i for i, _ in ok]), np.array([v for _, v in ok])
    x /= np.linalg.norm(x, axis=1)[:, None]
    s = np.round(x @ x.T, 8)
    np.fill_diagonal(s, -9)
    return {int(ids[i]): [(int(ids[j]), s[i, j]) for j in np.lexsort((ids, -s[i]))[:k]] for i in range(len(ids))}


@pytest.mark.parametrize("rule", [GraphRule(), GraphRule(degree=8, beam=40, build_beam=24, batch=32, shard_rows=150), GraphRule(degree=8, beam=40, build_beam=24, batch=32, shard_rows=150, most_rows=60)])
def test_nearest_vectors(spark, rule):
    data = vectors(400, copies=30)
    df = spark.createDataFrame(data, "vertex_id bigint, feat array<double>, id string")
    want, got = brute(data, 10), {}
    for r in nearest_vectors(df, "vertex_id", "feat", 10, 16, rule).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.other, r.similarity))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({o for o, _ in got[i]} & {o for o, _ in want[i]}) for i in want if i < 10_000 and i != 3)
    assert hits / (10 * 399) > 0.95
    for i in [3, *range(10_000, 10_030)]:  # copies: the smallest ids first
        assert [o for o, _ in got[i]] == [o for o, _ in want[i]]
    assert all(abs(s - dict(want[i]).get(o, s)) < 1e-6 for i in want for o, s in got[i])


def test_nearest_vectors_small_tables(spark):
    df = spark.createDataFrame(vectors(400)[-7:], "vertex_id bigint, feat array<double>, id string")
    assert nearest_vectors(df, "vertex_id", "feat", 10, 16).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 0.0])], "vertex_id bigint, feat array<double>")
    assert [(r.id, r.other) for r in nearest_vectors(two, "vertex_id", "feat", 1, 2).orderBy("id").collect()] == [(1, 3), (2, 1), (3, 1)]


def test_recall_of_several_graphs(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/feat_vertices.parquet")
    assert recall(df, "vertex_id", "feat", rule=GraphRule(shard_rows=250), each=5) > 0.97


def test_nodes_met_in_large_graphs():
    """Pairs whose places in the matrix of all pairs differ by 2^32 are different pairs."""
    near = NearLists(70_000, 1)
    near.meet(np.array([0, 61_356], np.int32), np.array([5, 47_301], np.int32), np.array([0.5, 0.25], np.float32))
    assert near.ids[[0, 61_356], 0].tolist() == [5, 47_301]


def test_vectors_travel_once(spark):
    """What is shuffled and stored does not grow with the graphs, and their files go when the search is over."""
    df = spark.read.parquet("/root/testdata/sf0.01/feat_vertices.parquet")
    sc, gate = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway

    def stages():
        sc.listenerBus().waitUntilEmpty(30_000)
        found = sc.statusStore().stageList(None, False, False, gate.new_array(gate.jvm.double, 0), gate.jvm.java.util.ArrayList())
        return {x.stageId(): x.shuffleWriteBytes() for x in (found.apply(i) for i in range(found.size()))}

    def moved(rows):
        seen = stages()
        assert nearest_vectors(df, "vertex_id", "feat", rule=GraphRule(shard_rows=rows, most_rows=rows)).count() > 5000
        return sum(n for k, n in stages().items() if k not in seen)

    assert moved(40) < 1.5 * moved(300)
    assert not list(Path(shared_dir(spark).removeprefix("file:")).glob("graphs-*"))


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_copies_across_graphs(spark, kind, monkeypatch):
    """Directions with many rows, in several graphs and pieces: as with one graph."""
    data = [(i, v) for i, v, _ in vectors(120, copies=40) if i < 20_000] + [(30_000 + i, [x * 2 for x in v]) for i, v, _ in vectors(120)[:30]]
    df = spark.createDataFrame(data, "vertex_id bigint, feat array<double>").selectExpr(f"CAST(vertex_id AS {kind}) vertex_id", "feat")
    few = GraphRule(beam=60, shard_rows=40, most_rows=40, piece_rows=7)
    rows = lambda rule: {(r.id, r.rank): (r.other, round(r.similarity, 6)) for r in nearest_vectors(df, "vertex_id", "feat", 10, 16, rule).collect()}
    want = rows(GraphRule(beam=200, build_beam=200))
    assert len(want) == 10 * len(data) and rows(few) == want
    monkeypatch.setattr(neighbours, "HEAVY_COPIES", 3)
    assert rows(few) == want
