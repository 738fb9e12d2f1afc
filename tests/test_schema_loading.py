import pytest
from pyspark.sql import functions as F

from tessagraph.errors import GraphError, NotFoundError, SchemaError
from tessagraph.operators import loading as L
from tessagraph.schema import EdgeLabel, GraphSchema, IndexLabel, PropertyKey, VertexLabel, complete_schema, schema_of_dict

GIVEN = {"vertexlabels": [{"name": "person", "properties": ["name", "age"]}, {"name": "software", "properties": ["name", "lang"]}], "edgelabels": [{"name": "created", "source_label": "person", "target_label": "software", "properties": ["date"]}], "propertykeys": [{"name": "age", "data_type": "INT"}, {"name": "date", "data_type": "DATE"}]}


def test_completion_and_builders():
    d = complete_schema(GIVEN)
    assert d["vertexlabels"][0]["primary_keys"] == ["name"] and d["vertexlabels"][0]["nullable_keys"] == ["age"]
    assert {p["name"]: p["data_type"] for p in d["propertykeys"]} == {"age": "INT", "date": "DATE", "name": "TEXT", "lang": "TEXT"}
    for bad in ([], {}, {"vertexlabels": [], "edgelabels": 1}, {"vertexlabels": [{"name": "x"}], "edgelabels": []}, {"vertexlabels": [{"name": "x", "properties": ["a"], "primary_keys": ["b"]}], "edgelabels": []}, {**GIVEN, "edgelabels": [{"name": "e", "source_label": "no", "target_label": "person"}]}):
        with pytest.raises(SchemaError):
            complete_schema(bad)
    s = schema_of_dict(GIVEN)
    assert s.relations() == ["person--created-->software"] and [v.id for v in s.vertex_labels.values()] == [1, 2]
    assert GraphSchema.from_json(s.to_json()) == s
    with pytest.raises(SchemaError):
        s.create(PropertyKey("age"))
    assert s.create(PropertyKey("age", "LONG"), if_not_exist=True).data_type == "INT"
    with pytest.raises(SchemaError):
        s.create(EdgeLabel("x", "person", "nobody"))
    with pytest.raises(SchemaError):
        EdgeLabel("x", "person", "person", frequency="MULTIPLE")
    with pytest.raises(SchemaError):
        s.remove("vertex_labels", "person")
    with pytest.raises(NotFoundError):
        s.remove("edge_labels", "no")
    s.create(PropertyKey("city"))
    assert s.append("vertex_labels", "person", properties=("city",), nullable_keys=("city",)).properties == ("name", "age", "city")
    assert s.eliminate("vertex_labels", "person", properties=("city",)).properties == ("name", "age")
    s.create(EdgeLabel("wrote", "person", "software", parent="created"))
    assert s.children("created") == ["created", "wrote"] and s.struct("person").fieldNames() == ["id", "name", "age"]
    assert [v["id"] for v in s.simple()["vertexlabels"]] == [1, 2] and s.property_keys["age"].default == 0


def test_schema_tables(spark):
    s = schema_of_dict(GIVEN)
    s.create(IndexLabel("by_name", "person", ("name",), kind="UNIQUE"))
    assert s.to_df(spark).count() == 8
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "name string, age int")
    assert [r.name for r in s.unique_violations("by_name", df).collect()] == ["a"]
    assert [r.id for r in df.select(s.vertex_id("person").alias("id")).collect()] == ["1:a", "1:a", "1:b"]


def test_triples(spark):
    s = schema_of_dict(GIVEN)
    df = spark.createDataFrame([("(Ann, Age, 20) - person (Ann, name, Ann) - person (Lop, lang, java) - software\\n(Ann, wrote, Lop) - created (x, y, z) - other",), (None,), ("none",)], "text string")
    v, e = L.typed_graph(df, s)
    assert {r.id: r.properties for r in v.collect()} == {"person-Ann": {"age": "20", "name": "Ann"}, "software-Lop": {"lang": "java"}}
    assert [tuple(r) for r in e.collect()] == [("created", "person-Ann", "software-Lop")]
    fv, fe = L.free_graph(df.select(F.inline(L.triples(F.col("text")))))
    assert fv.count() == 6 and ("Ann", "Lop", "wrote") in {tuple(r) for r in fe.collect()}


def test_json_and_load(spark):
    s = schema_of_dict(GIVEN)
    answers = [
        '```json\n{"vertices": [{"id": "1", "label": "person", "properties": {"name": "Ann", "age": "20", "x": "y"}}, {"id": "9", "label": "alien", "properties": {}}, {"id": "5", "label": "person", "properties": {"age": "3"}}, {"id": "6", "label": "person", "properties": {"name": "Bo", "age": "old"}}], "edges": [{"label": "created", "outV": "1", "outVLabel": "person", "inV": "2", "inVLabel": "software", "properties": {"date": "2020-01-01", "q": "1"}}]}\n```',
        'text [{"type": "vertex", "id": "2", "label": "software", "properties": {"name": "Lop"}}, {"type": "edge", "label": "created", "outV": "2", "outVLabel": "software", "inV": "1", "inVLabel": "person"}, {"type": "edge", "label": "created", "outV": "1", "outVLabel": "person", "inV": "77", "inVLabel": "software"}]',
        "{broken", None,
    ]
    els = spark.createDataFrame([(a,) for a in answers], "a string").select(F.inline(L.json_graph(F.col("a"))))
    v, m, bad = L.load_vertices(els.filter("type = 'vertex'").select("id", "label", "properties"), s)
    assert {r.id: r.properties for r in v.collect()} == {"1:Ann": {"age": "20", "name": "Ann"}, "2:Lop": {"name": "Lop"}}
    assert {(r.id, r.why) for r in bad.collect()} == {("9", "label"), ("5", "primary key"), ("6", "type")}
    e, wrong = L.load_edges(els.filter("type = 'edge'").select("label", "outV", "outVLabel", "inV", "inVLabel", "properties"), s, m, v)
    assert [tuple(r) for r in e.collect()] == [("created", "1:Ann", "2:Lop", {"date": "2020-01-01"})]
    assert {(r.outV, r.inV, r.why) for r in wrong.collect()} == {("2", "1", "ends"), ("1", "77", "vertex")}
    with pytest.raises(GraphError):
        L.require_graph(v.limit(0), e.limit(0))


def test_value_types(spark):
    cases = [("INT", "12", True), ("INT", "1.0", False), ("INT", "99999999999", False), ("LONG", "99999999999", True), ("DOUBLE", "1.5", True), ("DOUBLE", "1", False), ("DATE", "2020-02-30", False), ("DATE", "2020-02-03", True), ("BOOLEAN", "True", True), ("BLOB", "x", False), ("TEXT", "", True)]
    row = spark.range(1).select(*[L.valid_value(t, F.lit(v)).alias(str(i)) for i, (t, v, _) in enumerate(cases)]).first()
    assert [row[i] for i in range(len(cases))] == [w for *_, w in cases]
