"""Extracted graphs into tables: triples, JSON answers, validation against a schema, id mapping."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessagraph.errors import GraphError, SchemaError
from tessagraph.schema import GraphSchema, schema_of_dict
from tessagraph.session import checkpoint

ELEMENT = "struct<id:string,label:string,type:string,properties:map<string,string>,outV:string,outVLabel:string,inV:string,inVLabel:string>"
#: As models may write elements: older answers name an edge's ends source and target.
WRITTEN = ELEMENT[:-1] + ",source:string,target:string>"


def _clean(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\n", " "), r"[\\\n\r]", " ")


def triples(text: Column) -> Column:
    """array<struct<s, p, o>> of '(subject, predicate, object)' in a text."""
    part = lambda i: F.regexp_extract_all(_clean(text), F.lit(r"\((.*?), (.*?), (.*?)\)"), F.lit(i))
    return F.arrays_zip(part(1).alias("s"), part(2).alias("p"), part(3).alias("o"))


def typed_triples(text: Column) -> Column:
    """array<struct<s, p, o, label>> of '(subject, predicate, object) - label'."""
    part = lambda i: F.regexp_extract_all(_clean(text), F.lit(r"\((.*?), (.*?), (.*?)\) - ([^ ]*)"), F.lit(i))
    return F.arrays_zip(part(1).alias("s"), part(2).alias("p"), part(3).alias("o"), part(4).alias("label"))


def typed_graph(df: DataFrame, schema: GraphSchema, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(vertices (id, label, name, properties), edges (label, src, dst)) of typed triples.

    A triple of a vertex label is a property of the vertex 'label-subject', whose key is matched without case; of several
    values the largest stays. A triple of an edge label is an edge between the vertices of the label's ends, which are vertices
    even if no triple gives them a property.
    """
    t = df.select(F.inline(typed_triples(F.col(text_col)))).select(*[F.trim(c).alias(c) for c in ("s", "p", "o", "label")])
    props = df.sparkSession.createDataFrame([(v.name, p.lower(), p) for v in schema.vertex_labels.values() for p in v.properties], "label string, low string, key string")
    ends = df.sparkSession.createDataFrame([(e.name, e.source, e.target) for e in schema.edge_labels.values()], "label string, source string, target string")
    facts = t.withColumn("low", F.lower("p")).join(F.broadcast(props), ["label", "low"])  # metadata
    vals = facts.groupBy("label", "s", "key").agg(F.max("o").alias("o"))
    v = vals.groupBy("label", "s").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "o")))).alias("properties"))
    vid = lambda label, name: F.concat_ws("-", label, name)
    linked = t.join(F.broadcast(ends), "label")
    edges = linked.select("label", vid(F.col("source"), F.col("s")).alias("src"), vid(F.col("target"), F.col("o")).alias("dst")).distinct()
    named = linked.select(F.inline(F.array(F.struct(F.col("source").alias("label"), "s"), F.struct(F.col("target").alias("label"), F.col("o").alias("s"))))).distinct()
    v = named.join(v, ["label", "s"], "full").withColumn("properties", F.coalesce("properties", F.create_map().cast("map<string,string>")))
    return v.select(vid(F.col("label"), F.col("s")).alias("id"), "label", F.col("s").alias("name"), "properties"), edges


def free_graph(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices (id) and edges (src, dst, name) of triples (s, p, o) without a schema; texts are trimmed, empty ones left out."""
    t = rows.select(*[F.trim(c).alias(c) for c in ("s", "p", "o")]).filter("s <> '' and o <> ''")
    return t.select(F.explode(F.array("s", "o")).alias("id")).distinct(), t.select(F.col("s").alias("src"), F.col("o").alias("dst"), F.col("p").alias("name")).distinct()


def json_graph(answer: Column) -> Column:
    """array<element> of an answer with a JSON graph: {"vertices": [...], "edges": [...]} or a list of elements with a type.

    Code fences and text around the JSON are ignored; malformed JSON gives an empty array. Elements without a label are left out.
    """
    body = F.regexp_extract(F.regexp_replace(answer, r"```[a-zA-Z]*", ""), r"(?s)(\{.*\}|\[.*\])", 1)
    both = F.from_json(body, f"struct<vertices:array<{WRITTEN}>,edges:array<{WRITTEN}>>")
    none = F.array().cast(f"array<{WRITTEN}>")
    typed = lambda a, t: F.transform(F.coalesce(a, none), lambda x: x.withField("type", F.lit(t)))
    as_list = F.from_json(body, f"array<{WRITTEN}>")
    out = F.when(body.startswith("["), as_list).otherwise(F.concat(typed(both.vertices, "vertex"), typed(both.edges, "edge")))
    good = F.filter(F.coalesce(out, none), lambda x: x.label.isNotNull() & x.type.isin("vertex", "edge"))
    return F.transform(good, lambda x: x.withField("outV", F.coalesce(x.outV, x.source)).withField("inV", F.coalesce(x.inV, x.target)).dropFields("source", "target"))


def valid_value(data_type: str, value: Column) -> Column:
    """Whether a text is a value of a data type; dates are yyyy-MM-dd."""
    if data_type in ("TEXT", "UUID", "OBJECT"):
        return value.isNotNull()
    if data_type == "BOOLEAN":
        return F.lower(value).isin("true", "false")
    if data_type in ("BYTE", "INT", "LONG"):
        return value.rlike(r"^[+-]?\d+$") & value.try_cast({"BYTE": "tinyint", "INT": "int", "LONG": "bigint"}[data_type]).isNotNull()
    if data_type in ("FLOAT", "DOUBLE"):
        return value.rlike(r"^[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?$")
    if data_type == "DATE":
        return value.rlike(r"^\d{4}-\d{2}-\d{2}$") & value.try_cast("date").isNotNull()
    return F.lit(False)


def load_vertices(rows: DataFrame, schema: GraphSchema) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vertices (id, label, properties), mapping (label, old, id), rejected with `why`) of rows (id, label, properties map).

    Unknown labels are rejected. Properties that the label lacks are dropped. A missing primary key is rejected if every key is
    missing, else filled with its type's default, as is every other missing property that must not be null; a value of
    the wrong type rejects the row. Ids follow from the label id and the primary keys; rows with one id merge by the larger value.
    """
    parts, bad = [], rows.filter(~F.coalesce(F.col("label").isin(list(schema.vertex_labels)), F.lit(False))).withColumn("why", F.lit("label"))
    for v in schema.vertex_labels.values():
        x = rows.filter(F.col("label") == v.name)
        keep = F.map_filter(F.coalesce("properties", F.create_map().cast("map<string,string>")), lambda k, val: k.isin(list(v.properties)) & val.isNotNull() & (val != ""))
        x = x.withColumn("p", keep)
        none = F.lit(True)
        for k in v.primary_keys:
            none = none & F.col("p")[k].isNull()
        wrong = F.lit(False)
        for k in v.properties:
            wrong = wrong | (F.col("p")[k].isNotNull() & F.coalesce(~valid_value(schema.property_keys[k].data_type, F.col("p")[k]), F.lit(True)))
        must = [k for k in v.properties if k not in v.nullable_keys]
        fill = F.create_map(*[y for k in must for y in (F.lit(k), F.coalesce(F.col("p")[k], F.lit(str(schema.property_keys[k].default))))]) if must else F.create_map().cast("map<string,string>")
        full = F.map_concat(F.map_filter("p", lambda k, val: ~k.isin(must)), fill)
        x = x.withColumn("why", F.when(none & F.lit(bool(v.primary_keys)), "primary key").when(wrong, "type")).withColumn("full", full)
        bad = bad.unionByName(x.filter("why is not null").select(*rows.columns, "why"))
        own = F.concat(F.lit(f"{v.id}:"), F.concat_ws("!", *[F.col("full")[k] for k in v.primary_keys])) if v.id_strategy == "PRIMARY_KEY" else F.col("id")
        parts.append(x.filter("why is null").select(own.alias("id"), F.col("id").alias("old"), "label", F.col("full").alias("properties")))
    if not parts:
        raise GraphError("the schema has no vertex labels")
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.unionByName(p)
    cells = all_.select("id", "label", F.explode_outer("properties").alias("k", "val")).groupBy("id", "label", "k").agg(F.max("val").alias("val"))
    v = cells.groupBy("id", "label").agg(F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "val"))))).alias("properties"))
    return v, all_.select("label", "old", "id").distinct(), bad


def load_edges(rows: DataFrame, schema: GraphSchema, mapping: DataFrame, vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges (label, src, dst, properties), rejected with `why`) of rows (label, outV, outVLabel, inV, inVLabel, properties).

    Ends are mapped by label and old id, or stay as they are; the labels of the ends must be the schema's, and both vertices must exist.
    """
    ends = rows.sparkSession.createDataFrame([(e.name, e.source, e.target, list(e.properties)) for e in schema.edge_labels.values()], "label string, source string, target string, allowed array<string>")
    x = rows.join(F.broadcast(ends), "label", "left")  # metadata
    for end, lab in (("outV", "outVLabel"), ("inV", "inVLabel")):
        m = mapping.select(F.col("label").alias(lab), F.col("old").alias(end), F.col("id").alias(f"_{end}"))
        x = x.join(m, [lab, end], "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
        x = x.join(vertices.select(F.col("id").alias(f"_{end}"), F.lit(True).alias(f"has_{end}")), f"_{end}", "left")
    why = F.when(F.col("source").isNull(), "label").when((F.col("outVLabel") != F.col("source")) | (F.col("inVLabel") != F.col("target")), "ends").when(F.col("has_outV").isNull() | F.col("has_inV").isNull(), "vertex")
    x = x.withColumn("why", why)
    props = F.map_filter(F.coalesce("properties", F.create_map().cast("map<string,string>")), lambda k, v: F.array_contains("allowed", k))
    return x.filter("why is null").select("label", F.col("_outV").alias("src"), F.col("_inV").alias("dst"), props.alias("properties")), x.filter("why is not null").select(*rows.columns, "why")


def require_graph(vertices: DataFrame, edges: DataFrame) -> None:
    """Raises if there is neither a vertex nor an edge."""
    if vertices.isEmpty() and edges.isEmpty():
        raise GraphError("no vertices and no edges")


def labelled_blocks(text: Column) -> tuple[Column, Column]:
    """(nodes array<struct<name, label, properties>>, links array<struct<start, end, type, properties>>) of an answer with the headings
    'Nodes:' and 'Relationships:' and bracketed lists below them.

    An item is '[name, label, {properties}]' or '[start, type, end, {properties}]'; quotes and blanks around parts are taken
    off; properties that are no JSON are empty; items with too few parts are left out.
    """
    block = lambda head, stop: F.regexp_extract(text, rf"(?s){head}:(.*?)(?:{stop}:|$)", 1)
    items = lambda b: F.regexp_extract_all(b, F.lit(r"\[([^\[\]]*)\]"), F.lit(1))
    part = lambda i, n: F.trim(F.replace(F.get(F.split(F.regexp_replace(i, r"(?s)\{.*", ""), ","), F.lit(n)), F.lit('"')))
    props = lambda i: F.coalesce(F.from_json(F.replace(F.regexp_replace(F.regexp_extract(i, r"(?s)\{.*\}", 0), r"\bTrue\b", "true"), F.lit("\\")), "map<string,string>"), F.create_map().cast("map<string,string>"))
    nodes = F.transform(items(block("Nodes", "Relationships")), lambda i: F.struct(part(i, 0).alias("name"), part(i, 1).alias("label"), props(i).alias("properties")))
    links = F.transform(items(block("Relationships", "Nodes")), lambda i: F.struct(part(i, 0).alias("start"), part(i, 2).alias("end"), part(i, 1).alias("type"), props(i).alias("properties")))
    return F.filter(nodes, lambda x: (x["name"] != "") & (F.coalesce(x["label"], F.lit("")) != "")), F.filter(links, lambda x: (x["start"] != "") & (F.coalesce(x["end"], F.lit("")) != ""))


def extract_triples(docs: DataFrame, model: Callable[[str], str], template: str = "{text}", schema: GraphSchema | None = None) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) that a model's triples give, per chunk of docs (id, text): typed by a schema, or free without one."""
    from tessagraph.functions.models import fill, generate
    from tessagraph.functions.text import chunks

    answered = checkpoint(docs.select(F.explode(chunks(F.col("text"))).alias("text")).select(generate(fill(template, text=F.col("text")), model).alias("text")))
    return typed_graph(answered, schema) if schema is not None else free_graph(answered.select(F.inline(triples(F.col("text")))))


def unify_predicates(rows: DataFrame, model: Callable[[str], str], template: str = "{names}") -> DataFrame:
    """Triples (s, p, o) with predicates of one meaning under one name.

    A model sees the distinct predicates (a vocabulary, not the triples) and answers with lines 'name -> unified name';
    what it does not name stays.
    """
    names = sorted(r.p for r in rows.select("p").distinct().collect())
    said = model(template.replace("{names}", "\n".join(names)))
    pairs = [tuple(x.strip() for x in line.split("->", 1)) for line in said.splitlines() if "->" in line]
    known = {a: b for a, b in pairs if a in names and b}
    if not known:
        return rows.select("s", "p", "o").distinct()
    to = rows.sparkSession.createDataFrame(sorted(known.items()), "p string, q string")
    return rows.join(F.broadcast(to), "p", "left").select("s", F.coalesce("q", "p").alias("p"), "o").distinct()  # at most the vocabulary


def model_schema(samples: Sequence[str], model: Callable[[str], str], template: str = "{samples}") -> GraphSchema:
    """The schema that a model writes as JSON for sample texts, completed and checked; SchemaError if it is none."""
    import json
    import re

    said = model(template.replace("{samples}", "\n".join(samples)))
    body = re.search(r"(?s)\{.*\}", re.sub(r"```[a-zA-Z]*", "", said or ""))
    try:
        return schema_of_dict(json.loads(body.group(0)) if body else {})
    except json.JSONDecodeError as e:
        raise SchemaError(f"no JSON: {e}") from e


def extraction_prompt(sample: str, scenario: str, example: str, model: Callable[[str], str], template: str = "{example}\n{scenario}\n{sample}") -> str:
    """The extraction prompt that a model writes for a scenario after a worked example."""
    if not all(x and x.strip() for x in (sample, scenario, example)):
        raise SchemaError("a sample, a scenario and an example are needed")
    return model(template.replace("{example}", example).replace("{scenario}", scenario).replace("{sample}", sample)).strip()
