"""Message passing as joins and sums: node features are arrays, summed per dimension in long form."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessagraph.graph import union_all
from tessagraph.session import checkpoint, small


def degrees(edges: DataFrame) -> DataFrame:
    """(node, deg): incoming edges, for all ends; at least 1."""
    n = edges.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("deg"))
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return ends.join(n, "node", "left").select("node", F.greatest(F.coalesce("deg", F.lit(0)), F.lit(1)).alias("deg"))


def normalized(edges: DataFrame, adj: str = "DAD") -> DataFrame:
    """(src, dst, w): weights of D^-1/2 A D^-1/2 ('DAD'), D^-1 A ('DA') or A D^-1 ('AD'), by in-degrees."""
    d = checkpoint(degrees(edges))
    x = edges.select("src", "dst").join(d.withColumnsRenamed({"node": "src", "deg": "ds"}), "src").join(d.withColumnsRenamed({"node": "dst", "deg": "dd"}), "dst")
    w = {"DAD": 1 / (F.sqrt("ds") * F.sqrt("dd")), "DA": 1 / F.col("dd"), "AD": 1 / F.col("ds")}[adj]
    return x.select("src", "dst", w.alias("w"))


def long(nodes: DataFrame, feat: str = "feat") -> DataFrame:
    """(node, dim, val) of (node, feat)."""
    return nodes.select("node", F.posexplode(feat).alias("dim", "val")).withColumn("val", F.col("val").cast("double"))


def wide(x: DataFrame, name: str = "feat") -> DataFrame:
    return x.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "val"))), lambda s: s.val).alias(name))


def propagate(x: DataFrame, weighted: DataFrame) -> DataFrame:
    """(node, dim, val): for each node the weighted sum of its sources' values."""
    return weighted.join(x.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node"), "dim").agg(F.sum(F.col("w") * F.col("val")).alias("val"))


def aggregate(x: DataFrame, edges: DataFrame, how: str = "sum") -> DataFrame:
    """Sum, mean or max of the values of a node's sources."""
    f = {"sum": F.sum, "mean": F.avg, "max": F.max}[how]
    return edges.select("src", "dst").join(x.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node"), "dim").agg(f("val").alias("val"))


def _mix(parts: list[tuple[DataFrame, float]]) -> DataFrame:
    out = None
    for x, a in parts:
        y = x.select("node", "dim", (F.col("val") * a).alias("val"))
        out = y if out is None else out.unionByName(y)
    return out.groupBy("node", "dim").agg(F.sum("val").alias("val"))


def label_propagation(y: DataFrame, edges: DataFrame, rounds: int, alpha: float, adj: str = "DAD", lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """rounds of y <- clamp(alpha * A y + (1 - alpha) * y0)."""
    w, start = checkpoint(normalized(edges, adj)), y.select("node", "dim", "val")
    for _ in range(rounds):
        y = checkpoint(_mix([(propagate(y, w), alpha), (start, 1 - alpha)]).withColumn("val", F.least(F.lit(hi), F.greatest(F.lit(lo), F.col("val")))))
    return y


def correct_and_smooth(soft: DataFrame, labels: DataFrame, edges: DataFrame, rounds: int = 3, alpha: float = 0.8, scale: float | None = None) -> DataFrame:
    """Predictions soft (node, dim, val) corrected by the propagated errors on the labelled nodes, then labels spread.

    labels: one-hot (node, dim, val) of the training nodes. Without a scale each node's error is rescaled to the mean absolute
    error of the training nodes, by at most 1000, else by 1.
    """
    s, lab = soft, labels.withColumnRenamed("val", "y")
    error = lab.join(s, ["node", "dim"]).select("node", "dim", (F.col("y") - F.col("val")).alias("val"))
    spread = label_propagation(error, edges, rounds, alpha, "DAD", -1.0, 1.0)
    if scale is None:
        sigma = error.agg((F.sum(F.abs("val")) / F.count_distinct("node")).alias("sigma"))
        size = spread.groupBy("node").agg(F.sum(F.abs("val")).alias("l1"))
        ratio = F.try_divide(F.col("sigma"), F.col("l1"))
        spread = spread.join(size, "node").crossJoin(F.broadcast(sigma)).withColumn("val", F.col("val") * F.when(ratio <= 1000, ratio).otherwise(1.0)).select("node", "dim", "val")
    else:
        spread = spread.withColumn("val", F.col("val") * scale)
    fixed = _mix([(s, 1.0), (spread, 1.0)])
    start = fixed.join(labels.select("node").distinct(), "node", "left_anti").unionByName(labels.select("node", "dim", "val"))
    return label_propagation(start, edges, rounds, alpha)


def mean_of_powers(x: DataFrame, edges: DataFrame, k: int, adj: str = "DAD") -> DataFrame:
    """(x + A x + .. + A^k x) / (k + 1); summed first and divided once."""
    w, cur, parts = checkpoint(normalized(edges, adj)), x, [(x, 1.0)]
    for _ in range(k):
        cur = checkpoint(propagate(cur, w))
        parts.append((cur, 1.0))
    return _mix(parts).withColumn("val", F.col("val") / (k + 1))


def personalized(x: DataFrame, edges: DataFrame, k: int, alpha: float) -> DataFrame:
    """k rounds of h <- (1 - alpha) * A h + alpha * x."""
    w, h = checkpoint(normalized(edges)), x
    for _ in range(k):
        h = checkpoint(_mix([(propagate(h, w), 1 - alpha), (x, alpha)]))
    return h


def gated_hops(x: DataFrame, edges: DataFrame, k: int, gate: list[float]) -> DataFrame:
    """Sum over hops 0..k of A^i x, each node's hop weighted by the sigmoid of its product with `gate`."""
    w, cur, out = checkpoint(normalized(edges)), x, None
    for i in range(k + 1):
        g = cur.withColumn("g", F.element_at(F.lit([float(v) for v in gate]), F.col("dim") + 1) * F.col("val")).groupBy("node").agg((1 / (1 + F.exp(-F.sum("g")))).alias("s"))
        part = cur.join(g, "node").select("node", "dim", (F.col("val") * F.col("s")).alias("val"))
        out = part if out is None else out.unionByName(part)
        if i < k:
            cur = checkpoint(propagate(cur, w))
    return out.groupBy("node", "dim").agg(F.sum("val").alias("val"))


def attention(x: DataFrame, edges: DataFrame, beta: float = 1.0) -> DataFrame:
    """(node, dim, val): sources weighted by the softmax of beta * cosine over each node's sources; a node's loop counts if it is an edge."""
    n = x.groupBy("node").agg(F.sqrt(F.sum(F.col("val") * F.col("val"))).alias("n"))
    u = checkpoint(x.join(n, "node").select("node", "dim", "val", F.coalesce(F.try_divide(F.col("val"), F.col("n")), F.lit(0.0)).alias("u")))
    e = edges.select("src", "dst").distinct()
    cos = e.join(u.select(F.col("node").alias("src"), "dim", F.col("u").alias("us")), "src").join(u.select(F.col("node").alias("dst"), "dim", F.col("u").alias("ud")), ["dst", "dim"]).groupBy("src", "dst").agg((F.sum(F.col("us") * F.col("ud")) * beta).alias("c"))
    w = cos.withColumn("w", F.exp("c") / F.sum(F.exp("c")).over(Window.partitionBy("dst"))).select("src", "dst", "w")
    return propagate(x, w)


def softmax_aggregate(m: DataFrame, beta: float = 1.0) -> DataFrame:
    """(node, dim, val) of messages (dst, dim, val): per node and dimension the mean weighted by softmax(beta * val).

    The largest exponent of each group is taken off first, so that values of any size give finite weights.
    """
    by = ["dst", "dim"]
    top = m.groupBy(*by).agg(F.max(F.col("val") * beta).alias("top"))
    e = F.exp(F.col("val") * beta - F.col("top"))
    return m.join(top, by).groupBy(F.col("dst").alias("node"), "dim").agg((F.sum(F.col("val") * e) / F.sum(e)).alias("val"))


def message_norm(x: DataFrame, m: DataFrame, scale: float = 1.0) -> DataFrame:
    """(node, dim, val): messages m at length 1 times the length of the node's own x times `scale`; zero messages stay zero."""
    length = lambda df, name: df.groupBy("node").agg(F.sqrt(F.sum(F.col("val") * F.col("val"))).alias(name))
    y = m.join(length(m, "a"), "node").join(length(x, "b"), "node", "left")
    return y.select("node", "dim", F.coalesce(F.try_divide(F.col("val"), F.col("a")) * F.coalesce("b", F.lit(0.0)) * scale, F.lit(0.0)).alias("val"))


def jumping_sum(x: DataFrame, edges: DataFrame, k: int, dims: int, mode: str = "cat") -> DataFrame:
    """(node, dim, val): the states of hops 0..k side by side ('cat', hop h in dimensions h * dims ..) or their largest ('max'),
    summed over each node's sources."""
    w, cur, hops = checkpoint(normalized(edges)), x, [x]
    for _ in range(k):
        cur = checkpoint(propagate(cur, w))
        hops.append(cur)
    if mode == "cat":
        all_ = [h.withColumn("dim", F.col("dim") + i * dims) for i, h in enumerate(hops)]
        return aggregate(union_all(all_), edges)
    return aggregate(union_all(hops).groupBy("node", "dim").agg(F.max("val").alias("val")), edges)


def recursive_stacks(x: DataFrame, edges: DataFrame, stacks: Sequence[tuple[float, float]], rounds: int) -> DataFrame:
    """(node, dim, val): the mean over stacks (w, v) of `rounds` rounds of h <- max(0, w * A h + v * x), from h = x."""
    adj, outs = checkpoint(normalized(edges)), []
    for w, v in stacks:
        h = x
        for _ in range(rounds):
            h = checkpoint(_mix([(propagate(h, adj), w), (x, v)]).withColumn("val", F.greatest(F.lit(0.0), "val")))
        outs.append((h, 1 / len(stacks)))
    return _mix(outs)


def anchor_messages(x: DataFrame, anchors: DataFrame, position: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """(structure (node, dim, val), positions (node, set, val)) of anchors (node, set, anchor, closeness).

    The message from a set is max(0, x of the node + closeness * x of its anchor); structure is the mean of a node's
    messages, the position in a set the product of its message with `position`.
    """
    if small(x):  # else each message is shuffled to either end
        x = F.broadcast(x)
    own = x.select("node", "dim", F.col("val").alias("own"))
    far = x.select(F.col("node").alias("anchor"), "dim", F.col("val").alias("far"))
    m = anchors.join(far, "anchor").join(own, ["node", "dim"]).select("node", "set", "dim", F.greatest(F.lit(0.0), F.col("own") + F.col("closeness") * F.col("far")).alias("val"))
    weight = F.element_at(F.lit([float(v) for v in position]), F.col("dim") + 1)
    return m.groupBy("node", "dim").agg(F.avg("val").alias("val")), m.groupBy("node", "set").agg(F.sum(F.col("val") * weight).alias("val"))


def attention_readout(x: DataFrame, graph_of: DataFrame, gate: Sequence[float]) -> DataFrame:
    """(graph_id, dim, val): the nodes of each graph weighted by the softmax of their products with `gate`."""
    g = x.withColumn("g", F.element_at(F.lit([float(v) for v in gate]), F.col("dim") + 1) * F.col("val")).groupBy("node").agg(F.sum("g").alias("g")).join(graph_of, "node")
    top = g.groupBy("graph_id").agg(F.max("g").alias("top"))
    g = g.join(top, "graph_id").withColumn("e", F.exp(F.col("g") - F.col("top")))
    w = g.join(g.groupBy("graph_id").agg(F.sum("e").alias("all")), "graph_id").select("node", "graph_id", (F.col("e") / F.col("all")).alias("w"))
    return x.join(w, "node").groupBy("graph_id", "dim").agg(F.sum(F.col("val") * F.col("w")).alias("val"))


@dataclass(frozen=True)
class ShareBandit:
    """The share of sources that each relation keeps: a step down when the mean distance of the kept sources grew, else a step
    up, within (0, 1]; settled once the last ten moves nearly cancel out (from the tenth epoch on)."""

    share: dict[str, float]
    step: float = 0.02
    last: dict[str, float] = field(default_factory=dict)
    moves: dict[str, tuple[int, ...]] = field(default_factory=dict)
    settled: frozenset[str] = frozenset()

    def update(self, epoch: int, distance: dict[str, float]) -> ShareBandit:
        """The state after an epoch whose kept sources lay at these mean distances."""
        share, last, moves, settled = dict(self.share), dict(self.last), dict(self.moves), set(self.settled)
        for r in distance.keys() - self.settled:
            move = -1 if self.last.get(r, 0.0) < distance[r] else 1
            moved = share[r] + move * self.step
            share[r] = moved if 0 < moved <= 1 else share[r]
            last[r], moves[r] = distance[r], (*moves.get(r, ()), move)[-10:]
            if epoch >= 9 and abs(sum(moves[r])) <= 2:
                settled.add(r)
        return ShareBandit(share, self.step, last, moves, frozenset(settled))


def power_mean_aggregate(m: DataFrame, p: float = 1.0, lo: float = 1e-7, hi: float = 100.0) -> DataFrame:
    """(node, dim, val): (mean of clamped val^p)^(1/p)."""
    c = F.least(F.lit(hi), F.greatest(F.lit(lo), F.col("val")))
    return m.groupBy(F.col("dst").alias("node"), "dim").agg(F.pow(F.avg(F.pow(c, p)), 1 / p).alias("val"))


def closest_sources(scored: DataFrame, edges: DataFrame, share: float) -> DataFrame:
    """Edges (label, src, dst) kept per label and target: the ceil(share * n) sources whose scores (node, score) are nearest to the target's."""
    e = edges.join(scored.withColumnsRenamed({"node": "src", "score": "a"}), "src").join(scored.withColumnsRenamed({"node": "dst", "score": "b"}), "dst").withColumn("d", F.abs(F.tanh("a") - F.tanh("b")))
    per = Window.partitionBy("label", "dst")
    return e.withColumn("n", F.count("*").over(per)).withColumn("r", F.row_number().over(per.orderBy("d", "src"))).filter(F.col("r") <= F.ceil(F.col("n") * share)).select("label", "src", "dst", "d")


def readout(x: DataFrame, graph_of: DataFrame, how: str = "sum") -> DataFrame:
    """(graph_id, dim, val): sum, mean or max of the nodes (node, graph_id) of each graph."""
    return x.join(graph_of, "node").groupBy("graph_id", "dim").agg({"sum": F.sum, "mean": F.avg, "max": F.max}[how]("val").alias("val"))


def isomorphism(x: DataFrame, edges: DataFrame, eps: float = 0.0) -> DataFrame:
    """(1 + eps) * x + the sum of the sources."""
    return _mix([(x, 1 + eps), (aggregate(x, edges), 1.0)])


def mean_beside_self(x: DataFrame, edges: DataFrame, dims: int) -> DataFrame:
    """x beside the mean of the sources, whose dimensions follow x's."""
    return x.unionByName(aggregate(x, edges, "mean").withColumn("dim", F.col("dim") + dims))


def soft_pool(x: DataFrame, assign: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cluster, dim, val) = S'X and (a, b, w) = S'AS for soft assignments (node, cluster, s)."""
    pooled = x.join(assign, "node").groupBy("cluster", "dim").agg(F.sum(F.col("s") * F.col("val")).alias("val"))
    a = edges.select("src", "dst").join(assign.select(F.col("node").alias("src"), F.col("cluster").alias("a"), F.col("s").alias("sa")), "src")
    a = a.groupBy("dst", "a").agg(F.sum("sa").alias("sa"))
    return pooled, a.join(assign.select(F.col("node").alias("dst"), F.col("cluster").alias("b"), F.col("s").alias("sb")), "dst").groupBy("a", "b").agg(F.sum(F.col("sa") * F.col("sb")).alias("w"))


def entropy_loss(assign: DataFrame) -> DataFrame:
    """(loss): mean entropy of the assignments per node."""
    e = assign.groupBy("node").agg((-F.sum(F.when(F.col("s") > 0, F.col("s") * F.ln("s")).otherwise(0.0))).alias("e"))
    return e.agg(F.avg("e").alias("loss"))


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), c))
