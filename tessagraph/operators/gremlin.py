"""A typed traversal builder: g.V().has(...).out(...) compiled to joins, filters and aggregations of DataFrames.

A traverser is a row: `cur` is the current element or value, `path` the ids so far, and one column per tag. Steps have bag
semantics, as in the traversal language: nothing is made distinct but by dedup(). Sub-traversals begin with `__`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessagraph.graph import PropertyGraph

_ids = count()


@dataclass(frozen=True)
class P:
    """A predicate on a value."""

    test: Callable[[Column], Column]

    @staticmethod
    def eq(v) -> P:
        return P(lambda c: c == F.lit(v))

    @staticmethod
    def neq(v) -> P:
        return P(lambda c: c != F.lit(v))

    @staticmethod
    def lt(v) -> P:
        return P(lambda c: c < F.lit(v))

    @staticmethod
    def lte(v) -> P:
        return P(lambda c: c <= F.lit(v))

    @staticmethod
    def gt(v) -> P:
        return P(lambda c: c > F.lit(v))

    @staticmethod
    def gte(v) -> P:
        return P(lambda c: c >= F.lit(v))

    @staticmethod
    def between(a, b) -> P:
        """Half open: a <= value < b."""
        return P(lambda c: (c >= F.lit(a)) & (c < F.lit(b)))

    @staticmethod
    def inside(a, b) -> P:
        """Open: a < value < b."""
        return P(lambda c: (c > F.lit(a)) & (c < F.lit(b)))

    @staticmethod
    def outside(a, b) -> P:
        return P(lambda c: (c < F.lit(a)) | (c > F.lit(b)))

    @staticmethod
    def within(*v) -> P:
        return P(lambda c: c.isin(*v))

    @staticmethod
    def without(*v) -> P:
        return P(lambda c: ~c.isin(*v))

    @staticmethod
    def containing(s: str) -> P:
        return P(lambda c: c.contains(s))

    @staticmethod
    def starting_with(s: str) -> P:
        return P(lambda c: c.startswith(s))

    @staticmethod
    def ending_with(s: str) -> P:
        return P(lambda c: c.endswith(s))


def _test(v) -> P:
    return v if isinstance(v, P) else P.eq(v)


@dataclass(frozen=True)
class Anonymous:
    """A sub-traversal: steps that are applied later. `__.out('knows').has(...)`."""

    steps: tuple = ()

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        return lambda *a, **kw: Anonymous((*self.steps, (name, a, kw)))

    def apply(self, t: Traversal) -> Traversal:
        for name, a, kw in self.steps:
            t = getattr(t, name)(*a, **kw)
        return t


__ = Anonymous()
#: The wildcard import leaves out names with an underscore.
anonymous = __


PATH = "array<struct<k:string,id:string>>"


def _place(kind: str, c: Column) -> Column:
    return F.array(F.struct(F.lit(kind).alias("k"), c.cast("string").alias("id")))


@dataclass(frozen=True)
class Traversal:
    """Traversers so far. kind: 'v', 'e' or 'x' for values. Columns: cur, path (places of kind and id), t_<tag>, for edges came,
    and after order() its key as _ord, which the traversers keep on later moves. bags: what aggregate() gathered."""

    g: PropertyGraph
    df: DataFrame
    kind: str
    tags: dict[str, str] = field(default_factory=dict)
    default_limit: int | None = None
    limited: bool = False
    bags: dict[str, DataFrame] = field(default_factory=dict)
    order_by: bool | None = None

    # Elements are structs with their id and all properties; adjacency is joined by id only.
    def _v(self) -> DataFrame:
        v = self.g.vertices
        return v.select(F.col("id").alias("_id"), F.struct(*v.columns).alias("_v"))

    def _e(self) -> DataFrame:
        e = self.g.edges
        return e.select("src", "dst", F.struct(*e.columns).alias("_e"))

    def _next(self, df: DataFrame, kind: str | None = None, **kw) -> Traversal:
        return replace(self, df=df, kind=kind or self.kind, **kw)

    def _prop(self, key: str) -> Column:
        return F.col(f"cur.{key}")

    def _has(self, key: str) -> bool:
        return key in (self.g.vertices if self.kind == "v" else self.g.edges).columns

    # Filters
    def has(self, *args) -> Traversal:
        """has(key, value or P), has(label, key, value or P), has(key): a property that isn't null."""
        if len(args) == 3:
            return self.hasLabel(args[0]).has(*args[1:])
        if not self._has(args[0]):
            return self._next(self.df.limit(0))
        return self._next(self.df.filter(_test(args[1]).test(self._prop(args[0])) if len(args) == 2 else self._prop(args[0]).isNotNull()))

    def hasLabel(self, *labels: str) -> Traversal:
        return self._next(self.df.filter(self._prop("label").isin(*labels)))

    def hasId(self, *ids) -> Traversal:
        return self._next(self.df.filter(self._prop("id").isin(*ids)))

    def is_(self, v) -> Traversal:
        return self._next(self.df.filter(_test(v).test(F.col("cur"))))

    def dedup(self) -> Traversal:
        if self.kind == "x":
            return self._next(self.df.dropDuplicates(["cur"]))
        return self._next(self.df.withColumn("_k", self._prop("id")).dropDuplicates(["_k"]).drop("_k"))

    def limit(self, n: int) -> Traversal:
        """The first n in the order of the last order(), however far back, else by id or value, so that results repeat."""
        return self._next(self._sorted().limit(n), limited=True)

    def range(self, low: int, high: int) -> Traversal:
        """Results low..high - 1 in the order of limit(); a high of -1 is no end."""
        df = self._sorted()
        return self._next((df if high < 0 else df.limit(high)).offset(low), limited=True)

    def _sorted(self) -> DataFrame:
        own = F.col("cur") if self.kind == "x" else self._prop("id")
        own = F.to_json("cur") if self.df.schema["cur"].dataType.typeName() == "map" else own
        return self.df.orderBy(own) if self.order_by is None else self.df.orderBy(F.desc("_ord") if self.order_by else F.asc("_ord"), own)

    def hasNot(self, key: str) -> Traversal:
        return self._next(self.df.filter(self._prop(key).isNull())) if self._has(key) else self

    def simplePath(self) -> Traversal:
        return self._next(self.df.filter(F.size(F.array_distinct("path")) == F.size("path")))

    def where(self, *args) -> Traversal:
        """where(sub-traversal): it has a result. where(P on a tag): where(neq_tag('a')). where(tag, P): the tagged element passes."""
        if len(args) == 1 and isinstance(args[0], Anonymous):
            return self._matching(args[0], "left_semi")
        if len(args) == 1:
            return self._next(self.df.filter(args[0].test(self._prop("id"))))
        return self._next(self.df.filter(args[1].test(F.col(f"{self.tags[args[0]]}.id"))))

    def not_(self, sub: Anonymous) -> Traversal:
        """Traversers without a result of the sub-traversal, which may refer to tags."""
        return self._matching(sub, "left_anti")

    def or_(self, *subs: Anonymous) -> Traversal:
        """Traversers with a result of at least one sub-traversal."""
        return self.where(Anonymous((("union", subs, {}),)))

    def _matching(self, sub: Anonymous, how: str) -> Traversal:
        key = f"_w{next(_ids)}"
        marked = self._next(self.df.withColumn(key, F.struct(self._key(), *[F.col(c) for c in self.tags.values() if c in self.df.columns])))
        hit = sub.apply(marked).df.select(key).distinct()
        return self._next(marked.df.join(hit, key, how).drop(key))

    def _key(self) -> Column:
        return F.col("cur") if self.kind == "x" else self._prop("id")

    def tag(self, name: str) -> P:
        """The predicate 'the same element as the tag': where(t.tag('a'))."""
        return P(lambda c: c == F.col(f"{self.tags[name]}.id"))

    def where_eq(self, name: str) -> Traversal:
        return self._next(self.df.filter(self._prop("id") == F.col(f"{self.tags[name]}.id")))

    def where_neq(self, name: str) -> Traversal:
        return self._next(self.df.filter(self._prop("id") != F.col(f"{self.tags[name]}.id")))

    def where_tags(self, a: str, b: str, same: bool) -> Traversal:
        """where(a, eq(b)) or where(a, neq(b)) on two tags."""
        x, y = self._tagged(a), self._tagged(b)
        return self._next(self.df.filter(x == y if same else x != y))

    def where_all(self, *subs: Anonymous) -> Traversal:
        """Traversers with a result of every sub-traversal."""
        t = self
        for s in subs:
            t = t.where(s)
        return t

    # Moves
    def _move(self, direction: str, labels: Sequence[str], edge: bool) -> Traversal:
        e = self._e()
        if labels:
            e = e.filter(F.col("_e.label").isin(*labels))
        out = e.select(F.col("src").alias("_f"), F.col("dst").alias("_t"), "_e")
        in_ = e.select(F.col("dst").alias("_f"), F.col("src").alias("_t"), "_e")
        step = {"out": out, "in": in_}.get(direction) if direction != "both" else out.unionByName(in_)
        x = self.df.withColumn("_f", self._prop("id")).join(step, "_f")
        if edge:
            return self._next(x.withColumn("came", F.col("_f")).drop("cur", "_f", "_t").withColumnRenamed("_e", "cur").withColumn("path", F.concat("path", _place("e", F.col("cur.id")))), "e")
        x = x.drop("cur", "_f", "_e").withColumnRenamed("_t", "_id").join(self._v(), "_id").withColumn("path", F.concat("path", _place("v", F.col("_id")))).drop("_id").withColumnRenamed("_v", "cur")
        return self._next(x, "v")

    def out(self, *labels: str) -> Traversal:
        return self._move("out", labels, False)

    def in_(self, *labels: str) -> Traversal:
        return self._move("in", labels, False)

    def both(self, *labels: str) -> Traversal:
        return self._move("both", labels, False)

    def outE(self, *labels: str) -> Traversal:
        return self._move("out", labels, True)

    def inE(self, *labels: str) -> Traversal:
        return self._move("in", labels, True)

    def bothE(self, *labels: str) -> Traversal:
        return self._move("both", labels, True)

    def _end(self, end: Column) -> Traversal:
        x = self.df.withColumn("_id", end).drop("cur", "came").join(self._v(), "_id").withColumn("path", F.concat("path", _place("v", F.col("_id")))).drop("_id").withColumnRenamed("_v", "cur")
        return self._next(x, "v")

    def outV(self) -> Traversal:
        return self._end(F.col("cur.src"))

    def inV(self) -> Traversal:
        return self._end(F.col("cur.dst"))

    def otherV(self) -> Traversal:
        return self._end(F.when(F.col("cur.src") == F.col("came"), F.col("cur.dst")).otherwise(F.col("cur.src")))

    def repeat(self, sub: Anonymous, times: int, emit: bool = False) -> Traversal:
        """`times` rounds; with emit the traversers of every round, else of the last."""
        t, all_ = self, []
        for _ in range(times):
            t = sub.apply(t)
            all_.append(t)
        df = all_[-1].df
        if emit:
            df = all_[0].df
            for x in all_[1:]:
                df = df.unionByName(x.df)
        return self._next(df, t.kind)

    def union(self, *subs: Anonymous) -> Traversal:
        return self._united([s.apply(self) for s in subs])

    def _united(self, parts: list[Traversal]) -> Traversal:
        """All parts' traversers; parts of different kinds become ids and values as text."""
        if len({(p.kind, p.df.schema["cur"].dataType.simpleString()) for p in parts}) > 1:
            parts = [p._next(p.df.withColumn("cur", (p._key() if p.kind != "x" else F.col("cur")).cast("string")), "x") for p in parts]
        df = parts[0].df
        for p in parts[1:]:
            df = df.unionByName(p.df, allowMissingColumns=True)
        return self._next(df, parts[0].kind)

    # Tags and projections
    def as_(self, name: str) -> Traversal:
        return self._next(self.df.withColumn(f"t_{name}", F.col("cur")), tags=self.tags | {name: f"t_{name}"})

    def _tagged(self, name: str) -> Column:
        """A tag's value: the id of an element, else the value itself."""
        kind = self.df.schema[self.tags[name]].dataType
        return F.col(f"{self.tags[name]}.id") if kind.typeName() == "struct" and "id" in kind.names else F.col(self.tags[name])

    def select(self, *names: str) -> Traversal:
        """One name: its element or value; several: a struct, in which a bag of aggregate() is an array."""
        t = self
        for n in names:
            if n in t.bags and n not in t.tags:
                t = t._next(t.df.crossJoin(t.bags[n].withColumnRenamed("bag", f"t_{n}")), tags=t.tags | {n: f"t_{n}"})
        if len(names) > 1:
            return t._next(t.df.withColumn("cur", F.struct(*[t._tagged(n).alias(n) for n in names])), "x")
        kind = t.df.schema[t.tags[names[0]]].dataType
        fields = kind.names if kind.typeName() == "struct" else []
        return t._next(t.df.withColumn("cur", F.col(t.tags[names[0]])), "e" if "src" in fields else "v" if "id" in fields else "x")

    def aggregate(self, name: str) -> Traversal:
        """Gathers all current values under a name, for cap() and select(); the bag is one row by its meaning."""
        return self._next(self.df, bags=self.bags | {name: self.df.agg(F.array_sort(F.collect_list(self._key())).alias("bag"))})

    store = aggregate

    def cap(self, name: str) -> Traversal:
        return self._next(self.bags[name].select(F.col("bag").alias("cur"), F.array().cast(PATH).alias("path")), "x", tags={}, order_by=None)

    def values(self, *keys: str) -> Traversal:
        """Property values; missing ones are left out. Several keys: one row each, as text."""
        keys = tuple(k for k in keys if self._has(k))
        if not keys:
            return self._next(self.df.withColumn("cur", F.lit(None).cast("string")).limit(0), "x")
        if len(keys) == 1:
            return self._next(self.df.withColumn("cur", self._prop(keys[0])).filter("cur is not null"), "x")
        return self._next(self.df.withColumn("_a", F.array(*[self._prop(k).cast("string") for k in keys])).withColumn("cur", F.explode("_a")).drop("_a").filter("cur is not null"), "x")

    def valueMap(self, *keys: str, unfold: bool = False) -> Traversal:
        """Map of key to list of values as text, or with unfold to the value; missing ones are left out."""
        keys = tuple(k for k in (keys or [c for c in (self.g.vertices if self.kind == "v" else self.g.edges).columns if c not in ("id", "label", "src", "dst")]) if self._has(k))
        m = F.map_filter(F.create_map(*[x for k in keys for x in (F.lit(k), self._prop(k).cast("string"))]), lambda k, v: v.isNotNull())
        return self._next(self.df.withColumn("cur", m if unfold else F.transform_values(m, lambda k, v: F.array(v))), "x")

    def id(self) -> Traversal:
        return self._next(self.df.withColumn("cur", self._prop("id")), "x")

    def label(self) -> Traversal:
        return self._next(self.df.withColumn("cur", self._prop("label")), "x")

    def constant(self, v) -> Traversal:
        return self._next(self.df.withColumn("cur", F.lit(v)), "x")

    def identity(self) -> Traversal:
        return self

    def path(self, *by: str) -> Traversal:
        """The ids on the way; with keys, each place's property by the keys in turn ('id' and 'label' too), null where it has none."""
        if not by:
            return self._next(self.df.withColumn("cur", F.transform("path", lambda p: p.id)), "x")
        from tessagraph.session import checkpoint

        x = checkpoint(self.df.withColumn("_row", F.monotonically_increasing_id()))
        key = F.element_at(F.array(*[F.lit(k) for k in by]), F.col("_pos") % len(by) + 1)
        places = x.select("_row", F.posexplode("path").alias("_pos", "_p")).select("_row", "_pos", "_p.k", "_p.id", key.alias("_key"))
        props = None
        for kind, df in (("v", self.g.vertices), ("e", self.g.edges)):
            used = [c for c in df.columns if c in by]
            own = df.select(F.lit(kind).alias("k"), F.col("id").cast("string").alias("id"), F.create_map(*[y for c in used for y in (F.lit(c), F.col(c).cast("string"))]).cast("map<string,string>").alias("_m") if used else F.create_map().cast("map<string,string>").alias("_m"))
            props = own if props is None else props.unionByName(own)
        seen = places.join(props, ["k", "id"], "left").groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_pos", F.col("_m")[F.col("_key")].alias("_v")))).alias("_l"))
        return self._next(x.join(seen, "_row").withColumn("cur", F.transform("_l", lambda p: p["_v"])).drop("_row", "_l"), "x")

    def project(self, **by: str | Anonymous) -> Traversal:
        """project(name=key or sub-traversal): a struct; a sub-traversal gives its first value, or all of them after fold()."""
        x, key = self.df.withColumn("_row", F.monotonically_increasing_id()), None
        # Row ids must not change between the branches, so that the rows are fixed once.
        from tessagraph.session import checkpoint

        x = checkpoint(x)
        base = self._next(x)
        fields = []
        for name, sub in by.items():
            if isinstance(sub, str):
                fields.append(self._prop(sub).alias(name) if self._has(sub) else F.lit(None).cast("string").alias(name))
                continue
            folds = bool(sub.steps) and sub.steps[-1][0] == "fold"
            inner = Anonymous(sub.steps[:-1]) if folds else sub
            counts = bool(inner.steps) and inner.steps[-1][0] == "count"
            r = Anonymous(inner.steps[:-1] if counts else inner.steps).apply(base)
            value = r._key()
            value = F.to_json(value) if r.df.schema["cur"].dataType.typeName() == "map" else value  # maps have no order
            agg = F.count("*") if counts else F.array_sort(F.collect_list(value)) if folds else F.min(value)
            key = f"_p_{name}"
            got = r.df.groupBy("_row").agg(agg.alias(key))
            x = x.join(got, "_row", "left")
            base = base._next(base.df)
            filled = F.coalesce(F.col(key), F.lit(0)) if counts else F.coalesce(F.col(key), F.array().cast(dict(got.dtypes)[key])) if folds else F.col(key)
            fields.append(filled.alias(name))
        return self._next(x.withColumn("cur", F.struct(*fields)).drop("_row", *[c for c in x.columns if c.startswith("_p_")]), "x")

    def coalesce(self, *subs: Anonymous) -> Traversal:
        """For each traverser the results of the first branch that has any."""
        key = f"_c{next(_ids)}"
        from tessagraph.session import checkpoint

        left = self._next(checkpoint(self.df.withColumn(key, F.monotonically_increasing_id())))
        parts = []
        for s in subs:
            parts.append(s.apply(left))
            left = left._next(left.df.join(parts[-1].df.select(key).distinct(), key, "left_anti"))
        t = self._united(parts)
        return t._next(t.df.drop(key))

    def match(self, *patterns: tuple[str, Anonymous, str]) -> Traversal:
        """Conjunctive patterns (from tag, sub-traversal, to tag): every way to bind the tags; ends with all tags bound.

        The first pattern's from tag is bound to the current element if it is new.
        """
        t = self
        if patterns[0][0] not in t.tags:
            t = t.as_(patterns[0][0])
        for start, sub, end in patterns:
            r = sub.apply(t.select(start))
            t = r.where_eq(end) if end in r.tags else r.as_(end)
        return t

    # Barriers and ends
    def count(self) -> Traversal:
        return self._next(self.df.agg(F.count("*").alias("cur")).withColumn("path", F.array().cast(PATH)), "x", tags={}, limited=True, order_by=None)

    def fold(self) -> Traversal:
        return self._next(self.df.agg(F.array_sort(F.collect_list(self._key())).alias("cur")).withColumn("path", F.array().cast(PATH)), "x", tags={}, order_by=None)

    def unfold(self) -> Traversal:
        return self._next(self.df.withColumn("_x", F.explode("cur")).drop("cur").withColumnRenamed("_x", "cur"), "x")

    def sum_(self) -> Traversal:
        return self._total(F.sum)

    def max_(self) -> Traversal:
        return self._total(F.max)

    def min_(self) -> Traversal:
        return self._total(F.min)

    def mean(self) -> Traversal:
        return self._total(F.avg)

    def _total(self, f: Callable[[str], Column]) -> Traversal:
        return self._next(self.df.agg(f("cur").alias("cur")).withColumn("path", F.array().cast(PATH)), "x", tags={}, order_by=None)

    def groupCount(self, key: str) -> DataFrame:
        return self.df.groupBy(self._prop(key).alias(key)).agg(F.count("*").alias("count"))

    def order(self, by: str | None = None, desc: bool = False) -> Traversal:
        c = F.col("cur") if by is None else self._prop(by) if self._has(by) else F.lit(None).cast("string")
        return self._next(self.df.withColumn("_ord", c), order_by=desc)

    def drop(self) -> PropertyGraph:
        """The graph without the current elements."""
        ids = self.df.select(self._prop("id").alias("id"))
        return self.g.remove_vertices(ids) if self.kind == "v" else self.g.remove_edges(ids)

    def to_df(self, *names: str) -> DataFrame:
        """The results: columns of a struct, or one column `value`; elements as their id. `names`: tags instead."""
        if names:
            return self.df.select(*[self._tagged(n).alias(n) for n in names])
        t = self if self.limited or self.default_limit is None else self.limit(self.default_limit)
        if t.order_by is not None:
            t = t._next(t._sorted())
        if t.kind != "x":
            return t.df.select(t._prop("id").alias("value"))
        return t.df.select("cur.*") if t.df.schema["cur"].dataType.typeName() == "struct" else t.df.select(F.col("cur").alias("value"))

    toList = to_df

    def hasNext(self) -> bool:
        return not self.df.isEmpty()

    def next(self):
        """The first result, or None."""
        r = self.limit(1).to_df().first()
        return None if r is None else r[0]


@dataclass(frozen=True)
class Source:
    """Where traversals begin. default_limit caps traversals that end without a limit or count; None is no cap."""

    g: PropertyGraph
    default_limit: int | None = None

    def V(self, *ids: str) -> Traversal:
        v = self.g.vertices_by_id(ids) if ids else self.g.vertices
        return Traversal(self.g, v.select(F.struct(*v.columns).alias("cur"), _place("v", F.col("id")).alias("path")), "v", {}, self.default_limit)

    def E(self, *ids) -> Traversal:
        e = self.g.edges_by_id(ids) if ids else self.g.edges
        return Traversal(self.g, e.select(F.struct(*e.columns).alias("cur"), _place("e", F.col("id")).alias("path"), F.col("src").alias("came")), "e", {}, self.default_limit)
