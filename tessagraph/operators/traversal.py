"""Neighbourhoods, paths, cycles, similarities and ranks as joins over edges, one round per hop.

Every operator takes many sources at once where that makes sense; `source` is then a column. Each round's frontier is
checkpointed, so that plans don't grow with the depth. `steps` are (src, dst[, weight]) as of PropertyGraph.adjacency.
Missing sources give no rows. Paths are arrays of ids and simple. Ties between paths go to the smallest array.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessagraph.graph import PropertyGraph, union_all
from tessagraph.session import checkpoint

#: Neighbours of one node that are paired in one task.
CHUNK = 1000


def seeds(steps: DataFrame, ids: Sequence[str]) -> DataFrame:
    return steps.sparkSession.createDataFrame([(i,) for i in ids], "source string")


def sources_where(vertices: DataFrame, label: str | None = None, properties: dict | None = None) -> DataFrame:
    """(source): vertices of a label whose properties have given values (a list: one of them), as the starts of path searches."""
    v = vertices if label is None else vertices.filter(F.col("label") == label)
    for k, want in (properties or {}).items():
        v = v.filter(F.col(k).isin(list(want) if isinstance(want, (list, tuple, set)) else [want]))
    return v.select(F.col("id").alias("source")).distinct()


def levels(steps: DataFrame, sources: DataFrame, max_depth: int | None) -> list[DataFrame]:
    """(source, node, depth) for depths 0..max_depth, each node at its least distance; None: until no node is new."""
    steps = steps.select("src", "dst").distinct()
    if max_depth is None:
        steps = checkpoint(steps)
    seen = checkpoint(sources.select("source", F.col("source").alias("node"), F.lit(0).alias("depth")).distinct())
    out = [seen]
    for depth in count(1) if max_depth is None else range(1, max_depth + 1):
        near = out[-1].join(steps, F.col("node") == F.col("src")).select("source", F.col("dst").alias("node")).distinct()
        near = checkpoint(near.join(seen, ["source", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        out.append(near)
        if near.isEmpty():
            break
        seen = seen.unionByName(near)
    return out


def k_out(steps: DataFrame, sources: DataFrame, max_depth: int) -> DataFrame:
    """(source, node): nodes at exactly max_depth."""
    lv = levels(steps, sources, max_depth)
    return (lv[max_depth] if len(lv) > max_depth else lv[-1].limit(0)).select("source", "node")


def k_neighbor(steps: DataFrame, sources: DataFrame, max_depth: int) -> DataFrame:
    """(source, node, depth): nodes within max_depth, the source left out."""
    return union_all(levels(steps, sources, max_depth)[1:] or [levels(steps, sources, 0)[0].limit(0)])


def same_neighbors(steps: DataFrame, a: str, b: str) -> DataFrame:
    """(node): common neighbours of two nodes."""
    near = lambda x: steps.filter(F.col("src") == x).select(F.col("dst").alias("node"))
    return near(a).intersect(near(b))


def jaccard_similarity(steps: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, jaccard) of pairs (a, b): common over all neighbours; 0 if neither has any."""
    near = steps.select("src", "dst").distinct().groupBy("src").agg(F.count("*").alias("deg"))
    both = pairs.join(steps.select(F.col("src").alias("a"), "dst").distinct(), "a").join(steps.select(F.col("src").alias("b"), "dst").distinct(), ["b", "dst"]).groupBy("a", "b").agg(F.count("*").alias("common"))
    x = pairs.distinct().join(both, ["a", "b"], "left").join(near.withColumnsRenamed({"src": "a", "deg": "da"}), "a", "left").join(near.withColumnsRenamed({"src": "b", "deg": "db"}), "b", "left").fillna(0, ["common", "da", "db"])
    return x.select("a", "b", F.coalesce(F.try_divide(F.col("common").cast("double"), F.col("da") + F.col("db") - F.col("common")), F.lit(0.0)).alias("jaccard"))


def jaccard_all(steps: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(a, b, common, jaccard) a < b: all pairs with a common neighbour.

    The pairs of a hub are quadratic: neighbours of a node with more than `chunk` of them are cut into chunks by hash, and each
    pair of chunks is joined in a group of its own. None is lost.
    """
    e = checkpoint(steps.select("src", "dst").distinct())
    deg = e.groupBy(F.col("src").alias("n")).agg(F.count("*").alias("deg"))
    posts = e.join(deg.select(F.col("n").alias("src"), F.ceil(F.col("deg") / chunk).cast("int").alias("chunks")), "src")
    posts = posts.withColumn("own", F.pmod(F.xxhash64("dst"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    left = posts.select("src", F.col("own").alias("i"), other.alias("j"), F.col("dst").alias("a"))
    right = posts.select("src", F.col("own").alias("j"), other.alias("i"), F.col("dst").alias("b"))
    pairs = left.join(right, ["src", "i", "j"]).filter("a < b").groupBy("a", "b").agg(F.count("*").alias("common"))
    x = pairs.join(deg.withColumnsRenamed({"n": "a", "deg": "da"}), "a").join(deg.withColumnsRenamed({"n": "b", "deg": "db"}), "b")
    return x.select("a", "b", "common", (F.col("common") / (F.col("da") + F.col("db") - F.col("common"))).alias("jaccard"))


def _grow(paths: DataFrame, steps: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Simple paths one step longer; paths has path and keep."""
    return paths.join(steps, F.element_at("path", -1) == F.col("src")).filter(~F.array_contains("path", F.col("dst"))).withColumn("path", F.concat("path", F.array("dst")))


def single_source_shortest(steps: DataFrame, sources: DataFrame, max_depth: int, targets: DataFrame | None = None) -> DataFrame:
    """(source, node, weight, path): hops and the smallest shortest path to each node, or to targets (source, node) only."""
    steps = steps.select("src", "dst").distinct()
    front = checkpoint(sources.select("source", F.col("source").alias("node"), F.array("source").alias("path")).distinct())
    found = [front]
    for _ in range(max_depth):
        near = front.join(steps, F.col("node") == F.col("src")).groupBy("source", F.col("dst").alias("node")).agg(F.min(F.concat("path", F.array("dst"))).alias("path"))
        front = checkpoint(near.join(union_all(found), ["source", "node"], "left_anti"))
        if front.isEmpty():
            break
        found.append(front)
    out = union_all(found[1:] or [front.limit(0)])
    if targets is not None:
        out = out.join(targets, ["source", "node"], "left_semi")
    return out.select("source", "node", (F.size("path") - 1).cast("double").alias("weight"), "path")


def shortest_path(steps: DataFrame, source: str, target: str, max_depth: int) -> DataFrame:
    """(source, node, weight, path): one row if target is within max_depth."""
    pair = steps.sparkSession.createDataFrame([(source, target)], "source string, node string")
    return single_source_shortest(steps, pair.select("source"), max_depth, pair)


def multi_node_shortest(steps: DataFrame, nodes: Sequence[str], max_depth: int = 10) -> DataFrame:
    """(source, node, weight, path) for every pair source < node of a set."""
    s = seeds(steps, nodes)
    pairs = s.crossJoin(s.select(F.col("source").alias("node"))).filter("source < node")
    return single_source_shortest(steps, s, max_depth, pairs)


def all_shortest_paths(steps: DataFrame, source: str, target: str, max_depth: int) -> DataFrame:
    """(path): every shortest path from source to target."""
    steps = steps.select("src", "dst").distinct()
    paths = checkpoint(seeds(steps, [source]).select(F.array("source").alias("path")))
    seen = paths.select(F.col("path")[0].alias("dst"))
    for _ in range(max_depth):
        paths = checkpoint(_grow(paths, steps).select("path", "dst").join(seen, "dst", "left_anti"))
        hit = paths.filter(F.col("dst") == target)
        if not hit.isEmpty():
            return hit.select("path")
        if paths.isEmpty():
            break
        seen = seen.unionByName(paths.select("dst").distinct())
        paths = paths.select("path")
    return paths.select("path").limit(0)


def weighted_shortest(steps: DataFrame, sources: DataFrame, max_depth: int, default_weight: float = 1.0) -> DataFrame:
    """(source, node, weight, path): least sum of weights over at most max_depth steps; a missing weight is the default."""
    steps = steps.groupBy("src", "dst").agg(F.min(F.coalesce("weight", F.lit(default_weight))).alias("w"))
    best = checkpoint(sources.select("source", F.col("source").alias("node"), F.struct(F.lit(0.0).alias("weight"), F.array("source").alias("path")).alias("b")).distinct())
    front = best
    for _ in range(max_depth):
        more = front.join(steps, F.col("node") == F.col("src")).filter(~F.array_contains("b.path", F.col("dst"))).select("source", F.col("dst").alias("node"), F.struct((F.col("b.weight") + F.col("w")).alias("weight"), F.concat("b.path", F.array("dst")).alias("path")).alias("n")).groupBy("source", "node").agg(F.min("n").alias("n"))
        both = checkpoint(best.join(more, ["source", "node"], "full"))
        better = F.col("n").isNotNull() & (F.col("b").isNull() | (F.col("n") < F.col("b")))
        front = both.filter(better).select("source", "node", F.col("n").alias("b"))
        best = both.select("source", "node", F.when(better, F.col("n")).otherwise(F.col("b")).alias("b"))
        if front.isEmpty():
            break
    return best.filter("source <> node").select("source", "node", "b.weight", "b.path")


def paths(steps: DataFrame, sources: DataFrame, targets: DataFrame, max_depth: int, nearest: bool = False) -> DataFrame:
    """(source, target, path): simple paths of at most max_depth steps; with `nearest` only the shortest of each pair."""
    steps = steps.select("src", "dst").distinct()
    p = sources.select("source", F.array("source").alias("path")).distinct()
    out = []
    for _ in range(max_depth):
        p = checkpoint(_grow(p, steps).select("source", "path", F.col("dst").alias("target")))
        out.append(p.join(targets.select("target").distinct(), "target", "left_semi").select("source", "target", "path"))
        # A path that ends at a target doesn't go on through it if it is the only one.
        p = p.select("source", "path")
    found = union_all(out)
    if nearest:
        least = Window.partitionBy("source", "target")
        found = found.withColumn("m", F.min(F.size("path")).over(least)).filter(F.size("path") == F.col("m")).drop("m")
    return found


@dataclass(frozen=True)
class Step:
    """One step of a path template. sample and max_degree: edges of a vertex that are followed, by smallest target; 0 is all."""

    direction: str = "BOTH"
    labels: tuple[str, ...] = ()
    weight_by: str | None = None
    default_weight: float = 1.0
    max_degree: int = 0
    sample: int = 0
    skip_degree: int = 0
    properties: tuple[tuple[str, object], ...] = ()


def customized_paths(g: PropertyGraph, sources: DataFrame, steps: Sequence[Step], sort_by: str = "NONE", limit: int = -1, targets: DataFrame | None = None) -> DataFrame:
    """(source, path, weights): simple paths along the steps, with the weight of each step; sort_by INCR, DECR or NONE.

    With `targets` (target) the paths must end there. Equal paths over parallel edges come out once each.
    """
    p = sources.select("source", F.array("source").alias("path"), F.array().cast("array<double>").alias("weights")).distinct()
    for s in steps:
        e = g.edges
        for k, v in s.properties:
            e = e.filter(F.col(k) == F.lit(v))
        w = F.coalesce(F.col(s.weight_by), F.lit(s.default_weight)).cast("double") if s.weight_by else F.lit(float(s.default_weight))
        adj = PropertyGraph(g.vertices, e.withColumn("w", w)).adjacency(s.direction, s.labels, ["w"])
        cap = min([x for x in (s.sample, s.max_degree) if x > 0], default=0)
        if s.skip_degree > 0:
            adj = adj.join(adj.groupBy("src").agg(F.count("*").alias("n")).filter(F.col("n") < s.skip_degree).select("src"), "src", "left_semi")
        if cap:
            adj = adj.withColumn("r", F.row_number().over(Window.partitionBy("src").orderBy("dst", "w"))).filter(F.col("r") <= cap).drop("r")
        p = _grow(p, adj).select("source", "path", F.concat("weights", F.array("w")).alias("weights"))
    if targets is not None:
        p = p.join(targets.select("target").distinct(), F.element_at("path", -1) == F.col("target"), "left_semi")
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    if sort_by != "NONE":
        p = p.orderBy(total.asc() if sort_by == "INCR" else total.desc(), "path")
    return p.limit(limit) if limit >= 0 else p


def crosspoints(steps: DataFrame, source: str, target: str, max_depth: int) -> DataFrame:
    """(crosspoint, path): simple paths between two nodes with the middle vertex, the later of two, as crossing point."""
    s = seeds(steps, [source])
    found = paths(steps, s, seeds(steps, [target]).withColumnRenamed("source", "target"), max_depth)
    return found.select(F.col("path")[F.floor(F.size("path") / 2).cast("int")].alias("crosspoint"), "path")


def customized_crosspoints(g: PropertyGraph, sources: Sequence[str], patterns: Sequence[Sequence[Step]]) -> DataFrame:
    """(crosspoint): vertices that every source reaches along one of the patterns."""
    s = seeds(g.edges, sources)
    ends = union_all([customized_paths(g, s, p).select("source", F.element_at("path", -1).alias("crosspoint")) for p in patterns]).distinct()
    return ends.groupBy("crosspoint").agg(F.count("*").alias("n")).filter(F.col("n") == len(set(sources))).select("crosspoint")


def rings(steps: DataFrame, sources: DataFrame, max_depth: int) -> DataFrame:
    """(source, path): simple cycles of 3 to max_depth steps; of the two orientations the one whose second id is larger."""
    steps = steps.select("src", "dst").distinct()
    p = sources.select("source", F.array("source").alias("path")).distinct()
    out = []
    for depth in range(1, max_depth):
        p = checkpoint(_grow(p, steps).select("source", "path"))
        if depth >= 2:
            back = p.join(steps, (F.element_at("path", -1) == F.col("src")) & (F.col("source") == F.col("dst"))).filter(F.col("path")[1] > F.element_at("path", -1))
            out.append(back.select("source", F.concat("path", F.array("source")).alias("path")))
    return union_all(out) if out else p.limit(0)


def rays(steps: DataFrame, sources: DataFrame, max_depth: int) -> DataFrame:
    """(source, path): simple paths that have max_depth steps or cannot go on."""
    steps = steps.select("src", "dst").distinct()
    p = checkpoint(sources.select("source", F.array("source").alias("path")).distinct())
    out = []
    for _ in range(max_depth):
        longer = checkpoint(_grow(p, steps).select("source", "path"))
        went = longer.select(F.slice("path", F.lit(1), F.size("path") - 1).alias("path")).distinct()
        out.append(p.join(went, "path", "left_anti").filter(F.size("path") > 1))
        p = longer
    return union_all([*[x.select("source", "path") for x in out], p])


def fusiform_similarity(g: PropertyGraph, sources: DataFrame, label: str, direction: str, min_neighbors: int, alpha: float, min_similars: int = 1, top: int = 0, group_property: str | None = None, min_groups: int = 2) -> DataFrame:
    """(source, similar, score, common): vertices that share at least alpha of the neighbours of a source.

    A source needs min_neighbors neighbours along the label, min_similars similar vertices, and similars (with itself) in
    at least min_groups values of group_property if that is given. top is per source, 0 for all.
    """
    adj = checkpoint(g.adjacency(direction, [label]).distinct())
    deg = adj.groupBy("src").agg(F.count("*").alias("deg"))
    start = sources.select(F.col("source").alias("src")).distinct().join(deg, "src").filter(F.col("deg") >= min_neighbors)
    mid = start.join(adj, "src").select(F.col("src").alias("source"), "deg", "dst")
    both = mid.join(adj.withColumnRenamed("src", "similar"), "dst").filter("similar <> source").groupBy("source", "deg", "similar").agg(F.count("*").alias("common"))
    x = both.withColumn("score", F.col("common") / F.col("deg")).filter(F.col("score") >= alpha).select("source", "similar", "score", "common")
    per = Window.partitionBy("source")
    x = x.withColumn("n", F.count("*").over(per)).filter(F.col("n") >= min_similars).drop("n")
    if group_property:
        v = g.vertices.select("id", F.col(group_property).alias("grp"))
        members = x.select("source", "similar").unionByName(x.select("source", F.col("source").alias("similar")))
        ok = members.join(v, members.similar == v.id).groupBy("source").agg(F.count_distinct("grp").alias("g")).filter(F.col("g") >= min_groups).select("source")
        x = x.join(ok, "source", "left_semi")
    if top > 0:
        x = x.withColumn("r", F.row_number().over(per.orderBy(F.desc("score"), "similar"))).filter(F.col("r") <= top).drop("r")
    return x


def personal_rank(g: PropertyGraph, source: str, label: str, alpha: float = 0.85, max_depth: int = 5, limit: int = 100, with_label: str = "BOTH_LABEL", sorted_: bool = True) -> DataFrame:
    """(node, rank): max_depth rounds of a walk along `label` in both directions that restarts at source with 1 - alpha.

    with_label SAME_LABEL or OTHER_LABEL keeps nodes whose label is the source's, or is not. The source itself is left out.
    """
    adj = checkpoint(g.adjacency("BOTH", [label]).distinct())
    adj = checkpoint(adj.join(adj.groupBy("src").agg(F.count("*").alias("deg")), "src"))
    one = seeds(adj, [source]).select(F.col("source").alias("node"))
    rank = one.withColumn("rank", F.lit(1.0))
    for _ in range(max_depth):
        moved = rank.join(adj, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg((F.sum(F.col("rank") / F.col("deg")) * alpha).alias("rank"))
        rank = checkpoint(moved.unionByName(one.withColumn("rank", F.lit(1 - alpha))).groupBy("node").agg(F.sum("rank").alias("rank")))
    out = rank.filter(F.col("node") != source)
    if with_label != "BOTH_LABEL":
        lab = g.vertices.select(F.col("id").alias("node"), "label")
        own = g.vertices.filter(F.col("id") == source).select(F.col("label").alias("own"))
        out = out.join(lab, "node").crossJoin(F.broadcast(own)).filter((F.col("label") == F.col("own")) == F.lit(with_label == "SAME_LABEL")).select("node", "rank")
    return out.orderBy(F.desc("rank"), "node").limit(limit) if sorted_ else out


def neighbor_rank(g: PropertyGraph, source: str, steps: Sequence[Step], alpha: float = 0.85, top: int = 100) -> DataFrame:
    """(layer, node, rank): probability mass that reaches new nodes in each step, alpha per step, the top of each layer.

    The mass of a node is shared equally among its edges of the step; nodes of earlier layers take theirs and end.
    """
    front = seeds(g.edges, [source]).select(F.col("source").alias("node"), F.lit(1.0).alias("rank"))
    seen, out = front.select("node"), []
    for layer, s in enumerate(steps, 1):
        adj = g.adjacency(s.direction, s.labels)
        adj = adj.join(adj.groupBy("src").agg(F.count("*").alias("deg")), "src")
        if s.max_degree:
            adj = adj.filter(F.col("deg") <= s.max_degree)
        front = checkpoint(front.join(adj, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("node")).agg((F.sum(F.col("rank") / F.col("deg")) * alpha).alias("rank")).join(seen, "node", "left_anti"))
        seen = seen.unionByName(front.select("node"))
        out.append(front.orderBy(F.desc("rank"), "node").limit(top).select(F.lit(layer).alias("layer"), "node", "rank"))
    return union_all(out)
