"""Searches within tasks against brute force and against joins."""

import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessagraph.operators import learning as L
from tessagraph.plans import learning_queries
from tessagraph.session import shared_dir
from tests.test_whole import distances, neighbours


def random_steps(n, m, seed=5):
    r = random.Random(seed)
    return sorted({(f"n{r.randrange(n):03}", f"n{r.randrange(n):03}") for _ in range(m)})


def stored_bytes(spark):
    return sum(p.stat().st_size for p in Path(shared_dir(spark).removeprefix("file:")).rglob("*") if p.is_file())


def test_pairs_are_not_stored(spark):
    pairs = random_steps(250, 700)
    near = neighbours(pairs)
    steps = spark.createDataFrame(pairs, "src string, dst string")
    ids = [f"n{i:03}" for i in range(250)] + ["alone", "n000"]
    before = stored_bytes(spark)
    rows = L.path_lengths(steps, spark.createDataFrame([(i,) for i in ids], "source string")).collect()
    assert stored_bytes(spark) - before < len(rows)
    want = {(i, n): d for i in ids for n, d in distances(near, i).items()}
    assert len(rows) == len(want) > 30_000 and {(r.source, r.node): r.depth for r in rows} == want


@pytest.mark.parametrize("pairs", [[], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 9000)], [(i, 0) for i in range(1, 300)]])
def test_lists_and_joins_agree(spark, pairs):
    steps = spark.createDataFrame(pairs, "src bigint, dst bigint")
    sources = spark.createDataFrame([(i,) for i in (0, 1, 5, 77, 12345)], "source bigint")
    flat = lambda most: {(r.source, r.node, r.depth) for r in L.path_lists(steps, sources, most).select("source", F.explode("nodes").alias("node"), "depth").collect()}
    near = neighbours(pairs)
    assert flat(1 << 20) == {(i, n, d) for i in (0, 1, 5, 77, 12345) for n, d in distances(near, i).items()}
    if len(pairs) < 2 or pairs[0][0] == 0 and len(pairs) > 8000:
        assert flat(-1) == flat(1 << 20)


@pytest.mark.parametrize("pairs", [random_steps(120, 260), [(f"n{i:03}", f"n{i + 1:03}") for i in range(12)], [("n001", "n001")], []])
def test_nearest_of_sets(spark, pairs):
    r = random.Random(2)
    sets = sorted({(s, f"n{r.randrange(130):03}") for s in range(6) for _ in range(1 + s * s)} | {(7, "alone")})
    near = neighbours(pairs)
    want = {}
    for s, a in sets:
        for n, d in distances(near, a).items():
            want[n, s] = min(want.get((n, s), (d, a)), (d, a))
    steps = spark.createDataFrame(pairs, "src string, dst string")
    anchors = spark.createDataFrame(sets, "set int, idx string")
    for most in (1 << 20, -1):
        rows = L.nearest_lists(steps, anchors, most).select("set", "depth", F.inline("near")).collect()
        assert len(rows) == len(want) and {(x.node, x.set): (x.depth, x.anchor) for x in rows} == want
    rows = L.nearest_anchors(L.closeness(L.path_lengths(steps, anchors.select(F.col("idx").alias("source")))), anchors).collect()
    assert {(x.node, x.set): (round(1 / x.closeness) - 1, x.anchor) for x in rows} == want


def test_anchors_of_queries_follow_no_pairs(spark, monkeypatch):
    for f in ("path_lengths", "path_lists", "levels"):
        monkeypatch.setattr(L, f, None)
    assert learning_queries.gml_nearest_anchors(spark, "/root/testdata/sf0.001").count() > 0


def test_messages_look_up_their_label_only(spark, tmp_path):
    d = shutil.copytree("/root/testdata/sf0.001", tmp_path / "tables", copy_function=shutil.copyfile)
    tables = Path(shared_dir(spark).removeprefix("file:"), "tables")
    before = set(tables.glob("*-edges*"))
    x = learning_queries.msg_anchors(spark, str(d))
    assert {tuple(r) for r in x.collect()} == {tuple(r) for r in learning_queries.msg_anchors(spark, "/root/testdata/sf0.001").collect()}
    made = set(tables.glob("*-edges*")) - before
    assert made and {r.label for p in made for r in spark.read.parquet(str(p)).select("label").distinct().collect()} == {"reports_to"}
