"""Declared schemas: property keys, vertex, edge and index labels, with validation, completion and Spark types."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessagraph.errors import NotFoundError, SchemaError

#: Spark type and default value of each data type (fixed values).
TYPES: dict[str, tuple[T.DataType, object]] = {
    "BOOLEAN": (T.BooleanType(), False), "BYTE": (T.ByteType(), 0), "INT": (T.IntegerType(), 0), "LONG": (T.LongType(), 0), "FLOAT": (T.FloatType(), 0.0), "DOUBLE": (T.DoubleType(), 0.0),
    "TEXT": (T.StringType(), ""), "BLOB": (T.BinaryType(), ""), "DATE": (T.TimestampType(), "2000-01-01"), "UUID": (T.StringType(), ""), "OBJECT": (T.StringType(), None),
}
CARDINALITIES = ("SINGLE", "LIST", "SET")
AGGREGATES = ("NONE", "MAX", "MIN", "SUM", "OLD")
ID_STRATEGIES = ("AUTOMATIC", "PRIMARY_KEY", "CUSTOMIZE_STRING", "CUSTOMIZE_NUMBER", "CUSTOMIZE_UUID")


@dataclass(frozen=True)
class PropertyKey:
    name: str
    data_type: str = "TEXT"
    cardinality: str = "SINGLE"
    aggregate: str = "NONE"
    user_data: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.data_type not in TYPES or self.cardinality not in CARDINALITIES or self.aggregate not in AGGREGATES:
            raise SchemaError(f"property key {self.name}: {self.data_type}, {self.cardinality}, {self.aggregate}")

    @property
    def spark_type(self) -> T.DataType:
        t = TYPES[self.data_type][0]
        return t if self.cardinality == "SINGLE" else T.ArrayType(t)

    @property
    def default(self):
        return TYPES[self.data_type][1] if self.cardinality == "SINGLE" else []

    def merge(self, c, order=None):
        """The aggregate that merges values of one element on upsert."""
        return {"MAX": F.max, "MIN": F.min, "SUM": F.sum}.get(self.aggregate, F.first)(c) if self.aggregate != "OLD" or order is None else F.min_by(c, order)


@dataclass(frozen=True)
class VertexLabel:
    name: str
    properties: tuple[str, ...] = ()
    primary_keys: tuple[str, ...] = ()
    nullable_keys: tuple[str, ...] = ()
    id_strategy: str = "PRIMARY_KEY"
    id: int | None = None
    enable_label_index: bool = True
    user_data: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.id_strategy not in ID_STRATEGIES:
            raise SchemaError(f"vertex label {self.name}: {self.id_strategy}")


@dataclass(frozen=True)
class EdgeLabel:
    name: str
    source: str
    target: str
    properties: tuple[str, ...] = ()
    sort_keys: tuple[str, ...] = ()
    nullable_keys: tuple[str, ...] = ()
    frequency: str = "SINGLE"
    parent: str | None = None
    user_data: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.frequency not in ("SINGLE", "MULTIPLE") or (self.frequency == "MULTIPLE" and not self.sort_keys):
            raise SchemaError(f"edge label {self.name}: frequency {self.frequency} with sort keys {self.sort_keys}")

    @property
    def relation(self) -> str:
        return f"{self.source}--{self.name}-->{self.target}"


@dataclass(frozen=True)
class IndexLabel:
    name: str
    base: str
    fields: tuple[str, ...]
    on: str = "VERTEX"
    kind: str = "SECONDARY"

    def __post_init__(self):
        if self.kind not in ("SECONDARY", "RANGE", "SEARCH", "SHARD", "UNIQUE") or self.on not in ("VERTEX", "EDGE"):
            raise SchemaError(f"index label {self.name}: {self.kind} on {self.on}")


_KINDS = {"property_keys": PropertyKey, "vertex_labels": VertexLabel, "edge_labels": EdgeLabel, "index_labels": IndexLabel}


@dataclass
class GraphSchema:
    """A mutable catalogue of keys and labels by name."""

    property_keys: dict[str, PropertyKey] = field(default_factory=dict)
    vertex_labels: dict[str, VertexLabel] = field(default_factory=dict)
    edge_labels: dict[str, EdgeLabel] = field(default_factory=dict)
    index_labels: dict[str, IndexLabel] = field(default_factory=dict)

    def _of(self, item) -> dict:
        return next(getattr(self, k) for k, t in _KINDS.items() if isinstance(item, t))

    def create(self, item, if_not_exist: bool = False):
        """Adds a key or label; its names must be known. An existing name is an error, or is left alone if asked."""
        own = self._of(item)
        if item.name in own:
            if if_not_exist:
                return own[item.name]
            raise SchemaError(f"{item.name} exists")
        unknown = [p for p in (*getattr(item, "properties", ()), *(item.fields if isinstance(item, IndexLabel) else ())) if p not in self.property_keys]
        if isinstance(item, EdgeLabel):
            unknown += [v for v in (item.source, item.target) if v not in self.vertex_labels]
        if isinstance(item, VertexLabel):
            unknown += [p for p in (*item.primary_keys, *item.nullable_keys) if p not in item.properties]
            if item.id_strategy == "PRIMARY_KEY" and not item.primary_keys:
                raise SchemaError(f"vertex label {item.name} has no primary key")
            item = replace(item, id=item.id if item.id is not None else 1 + max([0, *(v.id for v in own.values())]))
        if unknown:
            raise SchemaError(f"{item.name}: unknown {', '.join(unknown)}")
        own[item.name] = item
        return item

    def _change(self, kind: str, name: str, add: bool, **parts):
        own = getattr(self, kind)
        if name not in own:
            raise NotFoundError(name)
        new = {}
        for k, v in parts.items():
            old = getattr(own[name], k)
            new[k] = ({**old, **v} if add else {a: b for a, b in old.items() if a not in v}) if isinstance(old, dict) else tuple(dict.fromkeys((*old, *v))) if add else tuple(x for x in old if x not in v)
        own[name] = replace(own[name], **new)
        return own[name]

    def append(self, kind: str, name: str, **parts):
        """Adds properties, nullable keys or user data to a label."""
        return self._change(kind, name, True, **parts)

    def eliminate(self, kind: str, name: str, **parts):
        return self._change(kind, name, False, **parts)

    def remove(self, kind: str, name: str) -> None:
        if name not in getattr(self, kind):
            raise NotFoundError(name)
        users = [e.name for e in self.edge_labels.values() if kind == "vertex_labels" and name in (e.source, e.target)] + [x.name for x in (*self.vertex_labels.values(), *self.edge_labels.values()) if kind == "property_keys" and name in x.properties]
        if users:
            raise SchemaError(f"{name} is in use by {', '.join(users)}")
        del getattr(self, kind)[name]

    def relations(self) -> list[str]:
        return [e.relation for e in self.edge_labels.values()]

    def children(self, label: str) -> list[str]:
        """An edge label with all labels below it."""
        return [label, *(c for e in self.edge_labels.values() if e.parent == label for c in self.children(e.name))]

    def simple(self) -> dict:
        """What a prompt needs: names, ids and properties."""
        return {
            "vertexlabels": [{"id": v.id, "name": v.name, "properties": list(v.properties)} for v in self.vertex_labels.values()],
            "edgelabels": [{"name": e.name, "source_label": e.source, "target_label": e.target, "properties": list(e.properties)} for e in self.edge_labels.values()],
        }

    def to_json(self) -> str:
        return json.dumps({k: [asdict(x) for x in getattr(self, k).values()] for k in _KINDS}, ensure_ascii=False)

    @staticmethod
    def from_json(text: str) -> GraphSchema:
        data = json.loads(text)
        s = GraphSchema()
        for k, t in _KINDS.items():
            for x in data.get(k, []):
                s.create(t(**{a: tuple(b) if isinstance(b, list) else b for a, b in x.items()}))
        return s

    def struct(self, label: str) -> T.StructType:
        """Spark type of a vertex or edge label's rows."""
        v = self.vertex_labels.get(label)
        e = self.edge_labels.get(label)
        if v is None and e is None:
            raise NotFoundError(label)
        head = [T.StructField("id", T.StringType(), False)] if v else [T.StructField("src", T.StringType(), False), T.StructField("dst", T.StringType(), False)]
        return T.StructType(head + [T.StructField(p, self.property_keys[p].spark_type, p in (v or e).nullable_keys) for p in (v or e).properties])

    def vertex_id(self, label: str):
        """Column expression of a primary-key id: label id, colon, keys joined by '!'."""
        v = self.vertex_labels[label]
        return F.concat(F.lit(f"{v.id}:"), F.concat_ws("!", *[F.col(k).cast("string") for k in v.primary_keys]))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """(kind, name, definition): one row per key and label."""
        rows = [(k, x.name, json.dumps(asdict(x), ensure_ascii=False)) for k in _KINDS for x in getattr(self, k).values()]
        return spark.createDataFrame(rows, "kind string, name string, definition string")

    def unique_violations(self, index: str, df: DataFrame) -> DataFrame:
        f = self.index_labels[index].fields
        return df.groupBy(*f).agg(F.count("*").alias("n")).filter("n > 1")


def complete_schema(given: dict) -> dict:
    """A user's schema {vertexlabels, edgelabels, propertykeys} checked and completed.

    Primary keys default to the first property, nullable keys to the others; properties that are not declared become single
    texts. Missing or wrongly typed parts raise SchemaError.
    """
    if not isinstance(given, dict):
        raise SchemaError("a schema is a dictionary")
    for k in ("vertexlabels", "edgelabels"):
        if not isinstance(given.get(k), list):
            raise SchemaError(f"{k} must be a list")
    keys = {p["name"]: dict(p) for p in given.get("propertykeys", []) if isinstance(p, dict) and p.get("name")}
    vertices, edges = [], []
    for v in given["vertexlabels"]:
        if not isinstance(v, dict) or not isinstance(v.get("name"), str):
            raise SchemaError("a vertex label needs a name")
        props = v.get("properties")
        if not isinstance(props, list) or not props:
            raise SchemaError(f"vertex label {v['name']} needs properties")
        pk = v.get("primary_keys") or props[:1]
        if not set(pk) <= set(props):
            raise SchemaError(f"vertex label {v['name']}: primary keys must be properties")
        vertices.append({**v, "primary_keys": pk, "nullable_keys": v.get("nullable_keys") or [p for p in props if p not in pk]})
    names = {v["name"] for v in vertices}
    for e in given["edgelabels"]:
        if not isinstance(e, dict) or not all(isinstance(e.get(k), str) for k in ("name", "source_label", "target_label")):
            raise SchemaError("an edge label needs name, source_label and target_label")
        if not {e["source_label"], e["target_label"]} <= names:
            raise SchemaError(f"edge label {e['name']} has unknown ends")
        edges.append({**e, "properties": e.get("properties", [])})
    for x in (*vertices, *edges):
        for p in x["properties"]:
            keys.setdefault(p, {"name": p, "data_type": "TEXT", "cardinality": "SINGLE"})
    return {"vertexlabels": vertices, "edgelabels": edges, "propertykeys": list(keys.values())}


def schema_of_dict(given: dict) -> GraphSchema:
    """A GraphSchema of a completed dictionary; all properties of edges may be null."""
    d, s = complete_schema(given), GraphSchema()
    for p in d["propertykeys"]:
        s.create(PropertyKey(p["name"], p.get("data_type", "TEXT"), p.get("cardinality", "SINGLE")))
    for v in d["vertexlabels"]:
        s.create(VertexLabel(v["name"], tuple(v["properties"]), tuple(v["primary_keys"]), tuple(v["nullable_keys"])))
    for e in d["edgelabels"]:
        s.create(EdgeLabel(e["name"], e["source_label"], e["target_label"], tuple(e["properties"]), nullable_keys=tuple(e["properties"])))
    return s


def checked_request(texts: str | list[str], schema: str | dict, split: str = "document", language: str = "zh") -> tuple[list[str], dict | str]:
    """(texts that are not blank, a completed schema or the name of a graph) of an extraction request.

    A schema is a dictionary, JSON text that begins with a brace, or else a graph's name of letters, digits, '_' and '-'.
    """
    some = [t for t in ([texts] if isinstance(texts, str) else texts) if t and t.strip()]
    if not some:
        raise SchemaError("no text")
    if split not in ("document", "paragraph", "sentence") or language not in ("zh", "en"):
        raise SchemaError(f"unknown split {split!r} or language {language!r}")
    if isinstance(schema, dict):
        return some, complete_schema(schema)
    name = schema.strip()
    if name.startswith("{"):
        try:
            return some, complete_schema(json.loads(name))
        except json.JSONDecodeError as e:
            raise SchemaError(f"no JSON: {e}") from e
    if not re.fullmatch(r"[\w-]+", name):
        raise SchemaError(f"{name!r} is neither JSON nor a graph's name")
    return some, name
