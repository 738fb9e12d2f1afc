import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from tessagraph.llm.pairs import main_defect, pair_defects
from tessagraph.llm.pieces import PieceRule, cut_pieces, cut_table
from tessagraph.llm.records import collapse, record_fields
from tessagraph.llm.repetition import BIT, RULES, Policy, ablate, apply_policies, measure, repetition_ledger


def norm(s):
    return None if s is None else re.sub(r"[^\w.]|_|\.(?!\d)|(?<!\d)\.", "", s).lower()


@pytest.mark.parametrize("heavy", [2, 100_000])
def test_records_collapse(spark, heavy):
    rows = [
        (5, "How many?", "g.V().valueMap('a','b')"), (2, "how  MANY", "G.v().VALUEMAP( 'b' , \"a\" )"), (9, "how many", "g.V().valueMap('a','b','b')"), (3, "x 1.5", "g"), (4, "x 15", "g"), (6, "X, 1.5!", "G"),
        (7, None, "g"), (8, None, "g"), (10, "", "g"), (11, "q", None), (12, "Q", None), (13, "q", ""), (14, "q", "g.valueMap('a').valueMap('b')"), (15, "q", "g.valueMap('b').valueMap('a')"), (16, "q", "g.valueMap('a"),
        *[(100 + i, "hot", "g.valueMap('z','y')" if i % 2 else "g.valuemap('Y', 'z')") for i in range(60)],
    ]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "pair_id bigint, query string, gremlin string, fields string, n int")
    got = {(r.first_id, r.copy_id) for r in collapse(record_fields(df, "pair_id", ["query"], {"gremlin": "valueMap"}), heavy).collect()}
    assert got == {(2, 5), (3, 6), (7, 8), (11, 12)} | {(100, 100 + i) for i in range(1, 60)}


def test_records_collision_and_empty(spark, monkeypatch):
    import tessagraph.llm.records as records
    from pyspark.sql import functions as F

    monkeypatch.setattr(records, "multiset_hash", lambda fields, seed: F.lit(1).cast("bigint"))
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "B", "x"), (4, "a!", "x"), (5, "c", "x")], "pair_id bigint, query string, gremlin string")
    fields = record_fields(df, "pair_id", ["query"], {"gremlin": "valueMap"})
    assert {(r.first_id, r.copy_id) for r in collapse(fields).collect()} == {(1, 4), (2, 3)}
    assert collapse(fields.limit(0)).count() == 0


PAIRS = [
    (None, "empty"), ("", "empty"), (" \n", "empty"), ("N/A", "empty"), ("// TODO", "empty"), ("```gremlin\n```", "empty"), ("''", "empty"),
    ("g.V().has('name','x", "truncated"), ("g.V().out('a').", "truncated"), ("g.V().out", "truncated"), ("g.V().has('a',…", "truncated"), ("```\ng.V().values(\n```", "truncated"), ("g.V().has('p', containing('(19')).values('n", "truncated"),
    ("I'm sorry, but I can't help.", "refusal"), ("# We can't give out an answer here: X", "refusal"), ("抱歉，我无法回答。", "refusal"), ("Request refused.", "refusal"), ("Leider kann ich das nicht.", "refusal"),
    ("who is Ann?", "copy"), ("Question: Who is Ann", "copy"), ("Who is Ann?\nWho is Ann?", "copy"), ("SELECT 1", "other_language"), ("The name of Ann is known.", "other_language"), ("MATCH (a) RETURN a", "other_language"),
    ("g.V().has('phone', containing('(1984')).values('name')", None), (" g.V( ).out('x') ; ", None), ("```gremlin\ng.V().count()\n```", None), ("G.V().HAS(\"A\",\"O'Neil\").COUNT()", None), ("// find\ng.V().count()", None), ("g.E().limit(1)", None),
    ("The email of Sorry Bakery is known.", "other_language"), ("g.V().has(’a’,’b’).count()", None),
]


def test_pair_defects(spark):
    df = spark.createDataFrame([(i, "Who is Ann?", a, "z") for i, (a, _) in enumerate(PAIRS)] + [(99, None, "g.V()", "z")], "pair_id int, query string, gremlin string, defect string")
    got = {r.pair_id: (list(r.defects), r.main) for r in pair_defects(df, "query", "gremlin").withColumn("main", main_defect(F.col("defects"))).collect()}
    assert [(a, got[i][1]) for i, (a, _) in enumerate(PAIRS)] == PAIRS
    assert got[99] == ([], None)


def test_every_defect_comes_out(spark):
    q = "Which companies does Ann serve?"
    cases = [
        ("g.V().has('name','x'].count()", ["truncated"]), ("g.V().hasLabel(']').out(]", ["truncated"]), ("g.V().hasLabel(')').out()", []), ("graph.traversal().V().count()", []), (":> g.V().count()", []), ("x = g.V().count()", []),
        ("Je regrette, impossible.", ["refusal", "other_language"]), ("Ich möchte das nicht beantworten.", ["refusal", "other_language"]), ("SELECT a FROM b WHERE (c = 'x", ["truncated", "other_language"]), ("Which companies does", ["copy", "other_language"]),
        ("Which companies does Ann serve? g.V().count()", ["copy", "other_language"]), ("Sorry, which companies does Ann serve", ["refusal", "other_language"]), ("...", ["empty"]), ("Анна служит", ["other_language"]), ("42", []), ("g" * 90_000, []), ("g.V()" + " " * 90_000 + ".out()", []), ("x" + " " * 90_000 + "x", []), ("g.V('" + "\\n" * 30_000 + "')", []), ("(" * 3_000, ["empty"]), ("# a\n  " * 9_000 + "g.V()", []),
    ]
    df = spark.createDataFrame([(i, q, a) for i, (a, _) in enumerate(cases)], "pair_id int, query string, gremlin string")
    got = {r.pair_id: list(r.defects) for r in pair_defects(df, "query", "gremlin").collect()}
    assert [(a[:60], got[i]) for i, (a, _) in enumerate(cases)] == [(a[:60], w) for a, w in cases]
    assert pair_defects(df.limit(0), "query", "gremlin").count() == 0


def longest_run(t):
    return max(map(len, re.split(r"[\s.,;:!?。，；：！？、]", t)), default=0)


@pytest.mark.parametrize("rule", [PieceRule(), PieceRule(20, 5), PieceRule(10, 0, 0.9), PieceRule(7, 6)])
def test_pieces_are_whole_and_small(rule):
    rng = random.Random(rule.limit)
    texts = ["", "a", "a" * rule.limit, "a" * (rule.limit + 1), "." * 99, " " * 99, "a" * 3000] + ["".join(rng.choice("aaaaaaaab中。 .\n,") for _ in range(rng.randrange(400))) + "x" * rng.choice([0, 0, rule.limit, 3 * rule.limit]) + " yz" * rng.randrange(9) for _ in range(300)]
    t = cut_table(texts, rule)
    by = {}
    for d, k, a, b, h in zip(*(t[c].tolist() for c in ("doc", "piece_no", "start", "stop", "hard"))):
        by.setdefault(d, []).append((k, a, b, h))
    for i, x in enumerate(texts):
        p = by.get(i, [])
        assert [q[0] for q in p] == list(range(len(p))) and bool(p) == bool(x)
        assert all(0 < b - a <= rule.limit for _, a, b, _ in p)
        if p:
            assert p[0][1] == 0 and p[-1][2] == len(x)
            assert all(0 <= prev[2] - cur[1] <= rule.overlap and cur[2] > prev[2] for prev, cur in zip(p, p[1:]))
            assert any(q[3] for q in p) == (longest_run(x) > rule.limit)
            assert len(p) == 1 or len(x) > rule.limit


def test_cuts_go_to_the_farthest_boundary():
    text = "One two. " * 30 + "a b c d e f g h i j"
    t = cut_table([text], PieceRule(40, 5))
    ends = [i for i in range(1, len(text) + 1) if i == len(text) or text[i] in " ." or text[i - 1] in " ."]
    at, want = 0, []
    while at < len(text):
        at = max(e for e in ends if at < e <= at + (40 if not want else 35))
        want.append(at)
    assert t["stop"].tolist() == want
    strong = cut_table([text], PieceRule(40, 5, 0.5))["stop"].tolist()
    assert all(text[e - 1] == "." for e in strong[:5])


def test_pieces_on_tables(spark):
    df = spark.createDataFrame([(1, "ab. " * 300, "u"), (1, "ab. " * 300, "u"), (2, None, "u"), (3, "", "u"), (4, "q" * 1001, "u")], "doc_id bigint, text string, id string")
    rows = cut_pieces(df, "doc_id", "text").collect()
    assert {(r.id, r.hard) for r in rows} == {(1, False), (4, True), (4, False)}
    assert all(len(r.piece) == r.stop - r.start for r in rows)
    assert cut_pieces(df.limit(0), "doc_id", "text").count() == 0


def test_the_ledger_is_stored(spark, tmp_path, monkeypatch):
    from tessagraph.llm import text_queries

    d = str(tmp_path)
    spark.createDataFrame([(1, "ab " * 60), (2, None), (3, "")], "doc_id bigint, text string").write.parquet(f"{d}/documents.parquet")
    first = {tuple(r) for r in text_queries.p9_policies(spark, d).collect()}
    monkeypatch.setattr(text_queries, "_ledger", None)
    assert {tuple(r) for r in text_queries.p9_policies(spark, d).collect()} == first and text_queries.p9_ablation(spark, d).count() == 28
    monkeypatch.undo()
    spark.createDataFrame([(4, "cd " * 60)], "doc_id bigint, text string").write.mode("append").parquet(f"{d}/documents.parquet")
    assert text_queries.p9_ledger(spark, d).count() == 4


def covered(t, k):
    s = "".join(c for c in t.lower() if c.isalnum())
    seen, out = set(), set()
    for i in range(len(s) - k + 1):
        if s[i : i + k] in seen:
            out |= set(range(i, i + k))
        seen.add(s[i : i + k])
    return len(out) / len(s) if s else 0


def test_repeated_passages_match_brute_force():
    rng = random.Random(3)
    texts = ["", "!!", "a" * 100, "ab " * 50]
    for _ in range(200):
        part = "".join(rng.choice("ab C,中") for _ in range(rng.randrange(60)))
        texts.append("".join(part if rng.random() < 0.4 else "".join(rng.choice("xyzw .") for _ in range(30)) for _ in range(rng.randrange(8))))
    for k in (1, 3, 5, 20):
        assert np.allclose(measure(texts, k)[:, 0], [covered(t, k) for t in texts])


def test_ledger_and_policies(spark):
    df = spark.createDataFrame([(1, "One two three four five six.\n" * 9, 0), (2, "Nothing here is said a second time.", 0), (3, None, 0), (4, "", 0), (5, "....", 0)], "doc_id bigint, text string, failed int")
    ledger = repetition_ledger(df, "doc_id", "text")
    rows = {r.id: r for r in ledger.collect()}
    assert rows[1].failed & BIT["passages"] and rows[1].failed & BIT["lines"] and rows[2].failed == rows[3].failed == rows[4].failed == 0 and rows[5].failed == BIT["one_sign"]
    assert rows[1].measures[1] == pytest.approx(8 / 9) and len(rows[1].measures) == len(RULES)
    policies = [Policy("p", 1, ("passages", "lines")), Policy("p", 2, ("one_sign",)), Policy("q", 1, ("passages", "lines"), 3)]
    assert {(r.policy, r.version, r.texts, r.dropped) for r in apply_policies(ledger, policies).collect()} == {("p", 1, 5, 1), ("p", 2, 5, 1), ("q", 1, 5, 0)}
    assert {(r.policy, r.version, r.rule, r.failing, r.dropped_without, r.only_by_it) for r in ablate(ledger, policies[:2]).collect()} == {("p", 1, "passages", 1, 1, 0), ("p", 1, "lines", 1, 1, 0), ("p", 2, "one_sign", 1, 0, 1)}
