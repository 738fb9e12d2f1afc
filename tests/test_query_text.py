import pytest
from pyspark.sql import functions as F

from tessagraph.errors import GraphError
from tessagraph.graph import PropertyGraph
from tessagraph.operators.query_text import check_texts, compile_text, ensure_limit, parse, run_text, try_text


@pytest.fixture(scope="module")
def g(spark):
    v = spark.createDataFrame([("a", "baker", "Ada", 30), ("b", "baker", "Bo", 40), ("c", "oven", "Cee", None), ("d", "oven", "Dee", 7)], "id string, label string, name string, age int")
    e = spark.createDataFrame([(1, "likes", "a", "b", 0.5), (2, "heats", "a", "c", 1.0), (3, "heats", "b", "c", 2.0), (4, "heats", "b", "d", 3.0)], "id bigint, label string, src string, dst string, w double")
    return PropertyGraph(v, e)


CASES = [
    ("g.V().count()", ["4"]), ("g.E().count().toList()", ["4"]), ("g.V('a').out().values('name')", ["Bo", "Cee"]), ("g.v().HAS('baker','age', gt(35)).id()", ["b"]), ("g.V().has(\"name\", within('Ada','Dee')).id();", ["a", "d"]),
    ("g.V().has(’name’,’Ada’).outE('heats').inV().label()", ["oven"]), ("g.V().hasLabel('oven').hasNot('age').id()", ["c"]), ("g.V().where(__.out('likes')).id()", ["a"]), ("g.V().not(out()).id()", ["c", "d"]),
    ("g.V('a').as('x').out('heats').in('heats').where(neq('x')).id()", ["b"]), ("g.V('a').bothE().where(otherV().has('name','Bo')).label()", ["likes"]), ("g.V().hasLabel('baker').order().by('age', desc).limit(1).id()", ["b"]),
    ("g.V().hasLabel('baker').order().by('age', Order.desc).out('heats').limit(2).id()", ["c", "d"]), ("g.V('b').outE('heats').has('w', P.between(2.5, 9)).inV().id()", ["d"]), ("g.V('a').repeat(out()).times(2).emit().dedup().id()", ["b", "c", "d"]),
    ("g.V('b').out('heats').path().by('name')", ["['Bo', 'Cee']", "['Bo', 'Dee']"]), ("g.V('b').outE('heats').inV().path().by('id').by('label')", ["['b', 'heats', 'c']", "['b', 'heats', 'd']"]),
    ("g.V().hasLabel('baker').values('age').sum()", ["70"]), ("g.V().values('age').max()", ["40"]), ("g.V().order().by('name').range(1,3).id()", ["b", "c"]), ("g.V().has('name', startingWith('A')).id()", ["a"]), ("g.V().coalesce(out('likes'), constant('none')).count()", ["4"]),
    ("g.V().or(out('likes'), has('name','Dee')).id()", ["a", "d"]), ("g.V().has('zzz', 1).id()", []), ("g.V('zzz')", []), ("g.V('a').valueMap('name').next()", ["{'name': ['Ada']}"]), ("g.V().hasLabel('oven').aggregate('o').cap('o').unfold()", ["c", "d"]),
]


@pytest.mark.parametrize("text,want", CASES)
def test_texts(g, text, want):
    assert sorted(str(r[0]) for r in run_text(g, text).collect()) == want


def test_projections_and_bags(g):
    got = run_text(g, "g.V().has('baker','name','Bo').as('a').project('info','ovens','n').by(select('a').valueMap('age')).by(select('a').out('heats').values('name').fold()).by(out().count())").collect()
    assert [(r.info, list(r.ovens), r.n) for r in got] == [('{"age":["40"]}', ["Cee", "Dee"], 2)]
    r = run_text(g, "g.V().hasLabel('oven').aggregate('all').count().as('count').select('count','all')").first()
    assert (r["count"], list(r["all"])) == (2, ["c", "d"])
    assert {tuple(r) for r in run_text(g, "g.V().groupCount().by('label')").collect()} == {("baker", 2), ("oven", 2)}
    assert compile_text(g, "g.V().hasLabel('oven').drop()").edges.count() == 1


def test_limits_and_errors(g):
    assert ensure_limit("g.V().out()") == "g.V().out().limit(100)" and ensure_limit("g.E();") == "g.E().limit(100)"
    assert ensure_limit("g.V().LIMIT(3)") == "g.V().LIMIT(3)" and ensure_limit("") == "" and ensure_limit("hello") == "hello"
    assert run_text(g, "g.V()", 2).count() == 2
    for bad in ("", None, "g", "g.V(", "g.V().has('a'", "g.V().fly()", "SELECT 1", "g.V().out() x", "g.V().repeat(out())", "g.V().project('a')", "g.V().select('q')", "g.V().drop()"):
        df, why = try_text(g, bad)
        assert df is None and why, bad
    with pytest.raises(GraphError):
        parse("g.V().has('open)")


def test_check_of_many(spark):
    df = spark.createDataFrame([(1, "g.V().has('x','y').count()"), (2, "g.V().has('x"), (3, None), (4, "g.V().jump()")], "i int, q string")
    assert {r.i: (r.steps, r.problem is None) for r in check_texts(df, "q").collect()} == {1: (["v", "has", "count"], True), 2: (None, False), 3: (None, False), 4: (None, False)}
    assert check_texts(df.limit(0), "q").count() == 0 and check_texts(df, "q").filter(F.col("problem").isNull()).count() == 1
