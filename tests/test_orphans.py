from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessagraph.operators.orphans import graph_orphans

T = datetime(2024, 1, 1)
VERTEX = "id string, label string, loaded_at timestamp_ntz, extra string"
EDGE = "edge_id bigint, outV string, outVLabel string, inV string, inVLabel string, loaded_at timestamp_ntz, label string, n string"


def at(days, hours=0):
    return T + timedelta(days=days, hours=hours)


def run(spark, edges, vertices, removals, heavy_rows=100_000):
    labels = spark.createDataFrame([(1, "person", ["name"]), (3, "book", [])], "label_id int, label string, primary_keys array<string>")
    return graph_orphans(
        spark.createDataFrame(edges, EDGE), [spark.createDataFrame(vertices, VERTEX)],
        spark.createDataFrame(removals, "vertex_id string, label string, removed_at timestamp_ntz"), labels, heavy_rows,
    )


def edge(i, out, inv, t, label="person"):
    return (i, out, label, inv, label, t, "knows", None)


@pytest.mark.parametrize("heavy_rows", [1, 2, 100_000])
def test_reasons_match_brute_force(spark, heavy_rows):
    vertices = [("1:a", "person", at(0), None), ("1:a", "person", at(0), None), ("1:b", "person", at(20), None), ("1:c", "person", at(0), None), ("1:c", "person", at(50), None), ("1:a", "book", at(0), None)]
    removals = [("1:c", "person", at(10)), ("1:c", "person", at(10)), ("1:c", "person", at(11)), ("1:zz", "person", at(1)), ("1:c", "person", at(60, 1))]
    names = ["1:a", " person:a\t", "1:b", "1:c", " 1:c", "1:d", "persons:a", None, "", "1:a"]
    edges = [edge(i, names[i % 10], names[(i * 7 + 3) % 10], at(i * 2 % 80, i % 3)) for i in range(120)]
    edges += edges[:15]
    got = {(r.edge_id, r.endpoint, r.reason) for r in run(spark, edges, vertices, removals, heavy_rows).rows().collect()}
    want = set()
    for i, out, label, inv, _, t, *_ in edges:
        for end, raw in (("outV", out), ("inV", inv)):
            if raw is None:
                continue
            key = raw.strip()
            key = "1:" + key[7:] if key.startswith("person:") else key
            loads = [v[2] for v in vertices if v[0] == key and v[1] == label]
            gone = [r[2] for r in removals if r[0] == key and r[1] == label]
            past = sorted([(x, 1) for x in loads if x <= t] + [(x, 0) for x in gone if x <= t])
            if not loads:
                want.add((i, end, "missing"))
            elif min(loads) > t:
                want.add((i, end, "late"))
            elif past and past[-1][1] == 0:
                want.add((i, end, "deleted"))
    assert got == want
    assert {r for _, _, r in want} == {"missing", "late", "deleted"}


def test_hot_key_and_counts(spark):
    edges = [edge(i, "1:hub", "1:gone", at(i % 40)) for i in range(400)]
    out = run(spark, edges, [("1:hub", "person", at(0), None)], [], heavy_rows=10)
    assert {(r.endpoint, str(r.period)[:7], r.reason, r.orphans) for r in out.counts().collect()} == {("inV", "2024-01", "missing", 310), ("inV", "2024-02", "missing", 90)}


def test_empty_and_null(spark):
    assert run(spark, [], [], []).rows().count() == 0
    none = run(spark, [(1, "1:a", None, None, "person", at(0), None, None), (2, "1:a", "person", "1:a", "person", None, None, None)], [("1:a", "person", at(0), None), ("1:a", None, at(0), None)], []).rows()
    assert [(r.edge_id, r.endpoint, r.reason) for r in none.select("edge_id", "endpoint", "reason").collect()] == [(1, "outV", "missing")]
    assert none.filter(F.col("reason").isNull()).count() == 0
