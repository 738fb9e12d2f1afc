"""The property graph as two DataFrames, with scans, point reads, upserts and removals."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessagraph.errors import NotFoundError
from tessagraph.operators.orphans import canonical_endpoint
from tessagraph.session import checkpoint, is_stored, small, stored, table, version


def _matches(df: DataFrame, label: str | None, properties: dict | None) -> DataFrame:
    if label:
        df = df.filter(F.col("label") == label)
    for k, v in (properties or {}).items():
        df = df.filter(F.col(k) == F.lit(v))
    return df


def _page(df: DataFrame, key: str, page: str | None, limit: int) -> DataFrame:
    """Keyset pagination: the next `limit` rows after key `page`; a limit of 0 is none."""
    if page is not None:
        df = df.filter(F.col(key) > page)
    return df.orderBy(key).limit(limit) if limit > 0 else df


def quoted_id(value: object, path: bool = False) -> str:
    """A vertex id as JSON (texts in quotes, UUIDs behind U), for a path with every reserved sign escaped.

    Whole numbers must fit 64 bits; truth values and other types are errors.
    """
    if isinstance(value, bool) or not isinstance(value, (str, int, uuid.UUID)):
        raise TypeError(f"no vertex id: {value!r}")
    if isinstance(value, int) and not -(1 << 63) <= value < 1 << 63:
        raise ValueError(f"{value} does not fit 64 bits")
    text = f"U{json.dumps(str(value))}" if isinstance(value, uuid.UUID) else json.dumps(value)
    return quote(text, safe="") if path else text


@dataclass(frozen=True)
class PropertyGraph:
    """vertices (id, label, properties...) and edges (id, label, src, dst, properties...), ids unique."""

    vertices: DataFrame
    edges: DataFrame

    @cached_property
    def undirected(self) -> DataFrame:
        """(src, dst): both directions of every edge, each pair once."""
        e = self.edges.select("src", "dst")
        return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()

    @cached_property
    def degrees(self) -> DataFrame:
        """(id, degree): distinct neighbours in either direction."""
        return self.undirected.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))

    def adjacency(self, direction: str = "BOTH", labels: Sequence[str] = (), extra: Sequence[str] = ()) -> DataFrame:
        """(src, dst, extra...): edges as steps along a direction, in bag semantics; a loop is one step in BOTH."""
        e = self.edges.filter(F.col("label").isin(list(labels))) if labels else self.edges
        out = e.select("src", "dst", *extra)
        back = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *extra)
        return {"OUT": out, "IN": back}.get(direction) if direction != "BOTH" else out.unionByName(back.filter("src <> dst"))

    def restrict(self, labels: Sequence[str]) -> PropertyGraph:
        """The graph with edges of these labels only."""
        return PropertyGraph(self.vertices, self.edges.filter(F.col("label").isin(list(labels))))

    def scan_vertices(self, label: str | None = None, properties: dict | None = None, page: str | None = None, limit: int = 0) -> DataFrame:
        """Vertices by label and equal properties; `page` is the last id of the page before."""
        return _page(_matches(self.vertices, label, properties), "id", page, limit)

    def scan_edges(self, label: str | None = None, vertex_id: str | None = None, direction: str | None = None, properties: dict | None = None, page: str | None = None, limit: int = 0) -> DataFrame:
        """Edges by label, equal properties, and incident vertex, which needs a direction."""
        e = _matches(self.edges, label, properties)
        if vertex_id is not None:
            if direction not in ("OUT", "IN", "BOTH"):
                raise NotFoundError("a vertex needs the direction OUT, IN or BOTH")
            at = {"OUT": F.col("src") == vertex_id, "IN": F.col("dst") == vertex_id}
            e = e.filter(at.get(direction, at["OUT"] | at["IN"]))
        return _page(e, "id", page, limit)

    def vertices_by_id(self, ids: Sequence[str]) -> DataFrame:
        return self.vertices.filter(F.col("id").isin(list(ids))) if ids else self.vertices.limit(0)

    def edges_by_id(self, ids: Sequence[str]) -> DataFrame:
        return self.edges.filter(F.col("id").isin(list(ids))) if ids else self.edges.limit(0)

    def upsert_vertices(self, rows: DataFrame) -> PropertyGraph:
        """Rows replace vertices of the same id; columns that rows lack are null. Repeated ids: any one row, as they must agree."""
        rows = rows.dropDuplicates(["id"])
        kept = self.vertices.join(rows.select("id"), "id", "left_anti")
        return PropertyGraph(kept.unionByName(rows, allowMissingColumns=True), self.edges)

    def upsert_edges(self, rows: DataFrame) -> tuple[PropertyGraph, DataFrame]:
        """The graph with edges added or replaced by id, and the rejected rows that have an endpoint without vertex."""
        ids = self.vertices.select("id")
        good = rows.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
        bad = rows.join(good.select("id"), "id", "left_anti")
        kept = self.edges.join(good.select("id"), "id", "left_anti")
        return PropertyGraph(self.vertices, kept.unionByName(good.dropDuplicates(["id"]), allowMissingColumns=True)), bad

    def append_properties(self, ids: Sequence[str], properties: dict[str, Column]) -> PropertyGraph:
        """Sets properties of vertices; on arrays, adds the values that are not there yet."""
        at, kinds = F.col("id").isin(list(ids)), dict(self.vertices.dtypes)
        add = lambda k, v: F.array_union(F.coalesce(F.col(k), F.array().cast(kinds[k])), v) if kinds.get(k, "").startswith("array") else v
        return PropertyGraph(self.vertices.withColumns({k: F.when(at, add(k, v)).otherwise(F.col(k) if k in kinds else F.lit(None)) for k, v in properties.items()}), self.edges)

    def eliminate_properties(self, ids: Sequence[str], keys: Sequence[str]) -> PropertyGraph:
        at = F.col("id").isin(list(ids))
        return PropertyGraph(self.vertices.withColumns({k: F.when(~at, F.col(k)) for k in keys}), self.edges)

    def append_edge_properties(self, ids: Sequence, properties: dict[str, Column]) -> PropertyGraph:
        """`append_properties` for edges."""
        return PropertyGraph(self.vertices, PropertyGraph(self.edges, self.edges).append_properties(ids, properties).vertices)

    def eliminate_edge_properties(self, ids: Sequence, keys: Sequence[str]) -> PropertyGraph:
        return PropertyGraph(self.vertices, PropertyGraph(self.edges, self.edges).eliminate_properties(ids, keys).vertices)

    def rebuilt(self, label: str | None = None) -> PropertyGraph:
        """The graph with derived tables made anew: edges of a label (or all) whose endpoints are gone leave, repeated ids count once."""
        at = F.lit(True) if label is None else F.col("label") == label
        ids = self.vertices.select("id").distinct()
        own = self.edges.filter(at).dropDuplicates(["id"]).join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
        return PropertyGraph(self.vertices.dropDuplicates(["id"]), own if label is None else self.edges.filter(~at).unionByName(own))

    def remove_vertices(self, ids: DataFrame) -> PropertyGraph:
        """Without the vertices `ids` (id) and without their edges."""
        gone = ids.select("id").distinct()
        e = self.edges.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
        return PropertyGraph(self.vertices.join(gone, "id", "left_anti"), e)

    def remove_edges(self, ids: DataFrame) -> PropertyGraph:
        return PropertyGraph(self.vertices, self.edges.join(ids.select("id").distinct(), "id", "left_anti"))

    def clear(self) -> PropertyGraph:
        return PropertyGraph(self.vertices.limit(0), self.edges.limit(0))

    def summary(self, vertex_ids: int = 10_000, edge_ids: int = 200) -> DataFrame:
        """One row: counts, and the first ids of vertices and edges."""
        v = self.vertices.agg(F.count("*").alias("vertex_num"))
        e = self.edges.agg(F.count("*").alias("edge_num"))
        first = lambda df, n, name: df.select("id").orderBy("id").limit(n).agg(F.array_sort(F.collect_list("id")).alias(name))
        return v.crossJoin(e).crossJoin(first(self.vertices, vertex_ids, "vertices")).crossJoin(first(self.edges, edge_ids, "edges"))

    def relations(self) -> DataFrame:
        """(relation): source--label-->target of every edge label in use."""
        lab = self.vertices.select("id", F.col("label").alias("l"))
        e = self.edges.select("label", "src", "dst").join(lab.withColumnsRenamed({"id": "src", "l": "s"}), "src").join(lab.withColumnsRenamed({"id": "dst", "l": "d"}), "dst")
        return e.select(F.format_string("%s--%s-->%s", "s", "label", "d").alias("relation")).distinct()

    def edge_multiplicity(self, label: str, keys: Sequence[str] = ()) -> DataFrame:
        """Violations of SINGLE (no keys) or MULTIPLE by sort keys: endpoints with more than one edge."""
        return self.edges.filter(F.col("label") == label).groupBy("src", "dst", *keys).agg(F.count("*").alias("n")).filter("n > 1")


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def graph_of_tables(spark: SparkSession, sf_dir: str, labels: Sequence[str] = ()) -> PropertyGraph:
    """The graph of a data directory: each vertex as last loaded unless it was removed after that, each edge once, edges
    without both vertices left out.

    Both tables are made once per application and state of the files, and then read from the shared folder. With `labels` the
    graph has edges of these labels only, and no others are looked up; where the edges of all labels are stored, they serve.
    """
    names = ("vertices", "base_vertices", "edges", "vertex_removals", "vertexlabels")
    raw = {n: table(spark, sf_dir, n) for n in names}
    key = "graph-" + hashlib.blake2b(version(*raw.values()).encode(), digest_size=12).hexdigest()
    v = stored(spark, f"{key}-vertices", lambda: _present_vertices(raw))
    if labels and not is_stored(spark, f"{key}-edges"):
        own = raw | {"edges": raw["edges"].filter(F.col("label").isin(list(labels)))}
        return PropertyGraph(v, stored(spark, f"{key}-edges-{'-'.join(sorted(labels))}", lambda: _known_edges(own, v)))
    g = PropertyGraph(v, stored(spark, f"{key}-edges", lambda: _known_edges(raw, v)))
    return g.restrict(labels) if labels else g


def _present_vertices(raw: dict[str, DataFrame]) -> DataFrame:
    rows = raw["vertices"].unionByName(raw["base_vertices"]).filter(F.col("properties").isNotNull())
    last = Window.partitionBy("id").orderBy(F.desc("loaded_at"), "label", F.col("properties.name"), F.col("properties.city"))
    v = rows.withColumn("r", F.row_number().over(last)).filter("r = 1")
    gone = raw["vertex_removals"].groupBy(F.col("vertex_id").alias("id"), "label").agg(F.max("removed_at").alias("removed_at"))
    v = v.join(gone, ["id", "label"], "left").filter(F.col("removed_at").isNull() | (F.col("removed_at") <= F.col("loaded_at")))
    return v.select("id", "label", "properties.*")


def _known_edges(raw: dict[str, DataFrame], v: DataFrame) -> DataFrame:
    # The schema table is metadata of a few rows.
    keyed = {r.label: r.label_id for r in raw["vertexlabels"].filter(F.size("primary_keys") > 0).collect()}
    e = raw["edges"].filter(F.col("outV").isNotNull() & F.col("inV").isNotNull())
    e = e.select(F.col("edge_id").alias("id"), "label", canonical_endpoint(F.col("outV"), F.col("outVLabel"), keyed).alias("src"), canonical_endpoint(F.col("inV"), F.col("inVLabel"), keyed).alias("dst"), "outVLabel", "inVLabel", "properties.*")
    kept = e
    for end, lab in (("src", "outVLabel"), ("dst", "inVLabel")):
        # Endpoints are made distinct before the shuffle, so that a hub is one row of it; those without a vertex are few as a rule.
        lost = checkpoint(e.select(end, lab).distinct().join(v.select(F.col("id").alias(end), F.col("label").alias(lab)), [end, lab], "left_anti"))
        kept = kept.filter(F.col(lab).isNotNull()).join(F.broadcast(lost) if small(lost) else lost, [end, lab], "left_anti")
    return kept.distinct().select("id", "label", "src", "dst", "date", "city", "weight", "shareholdingRatio")
