"""Graph-learning data: dense indices, splits, samples, walks, subgraphs, labels; all keyed, so that many run at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessagraph.graph import union_all
from tessagraph.operators import reach as R
from tessagraph.operators.traversal import levels
from tessagraph.session import checkpoint


def arithmetic_hash(c: Column, seed: int, m: int = 1_000_003) -> Column:
    """A repeatable spread of whole numbers that any SQL engine computes alike."""
    return F.pmod((c * 7919 + seed) % m * 104_729 + seed, F.lit(m))


def dense_index(df: DataFrame, key: str, per: Sequence[str] = ()) -> DataFrame:
    """`df` with `idx`: 0.. in the order of the key, per group of `per` if given.

    The rows are range-partitioned by group and key and numbered from the counts of the partitions before, so that no task sees
    all of a group. Equal keys follow in any order.
    """
    own = list(per)
    spread = checkpoint(df.repartitionByRange(*own, key).withColumn("_p", F.spark_partition_id()))
    before = spread.groupBy(*own, "_p").agg(F.count("*").alias("_n")).withColumn("_b", F.coalesce(F.sum("_n").over(Window.partitionBy(*own).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inner = F.row_number().over(Window.partitionBy(*own, "_p").orderBy(key)) - 1
    on = [F.equal_null(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in [*own, "_p"]]
    numbered = spread.withColumn("_r", inner).alias("a").join(before.alias("b") if own else F.broadcast(before).alias("b"), on)
    return numbered.select(*[F.col(f"a.{c}") for c in df.columns], (F.col("_r") + F.col("_b")).alias("idx"))


def convert_graph(nodes: DataFrame, edges: DataFrame, per: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(nodes with idx, edges with src_idx and dst_idx): ids become dense numbers; edges without both nodes go. `per`: numbered per label."""
    n = dense_index(nodes, "id", per)
    ids = n.select("id", "idx")
    e = edges.join(ids.withColumnsRenamed({"id": "src", "idx": "src_idx"}), "src").join(ids.withColumnsRenamed({"id": "dst", "idx": "dst_idx"}), "dst")
    return n, e


def collection_stats(nodes: DataFrame, graph_col: str, feat_col: str, label_col: str) -> DataFrame:
    """One row: number of graphs, most nodes of one, length of features, number of classes."""
    per = nodes.groupBy(graph_col).agg(F.count("*").alias("n"), F.max(F.size(feat_col)).alias("f"))
    return per.agg(F.count("*").alias("n_graphs"), F.max("n").alias("max_n_nodes"), F.max("f").alias("n_feat_dim")).crossJoin(nodes.agg(F.count_distinct(label_col).alias("n_classes")))


def single_directed(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).filter("src <> dst").distinct()


def bidirected(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def split_edges(edges: DataFrame, order: Column, held_out: float = 0.2) -> DataFrame:
    """`edges` with `split`: 'train', or 'valid' and 'test' for half of the held-out share each, by a hash in 0..1."""
    return edges.withColumn("split", F.when(order < 1 - held_out, "train").when(order < 1 - held_out / 2, "valid").otherwise("test"))


def mask_splits(edges: DataFrame, masks: dict[str, str]) -> DataFrame:
    """(src, dst, split): rows of each split whose mask column is 1; -1 and 0 are absent."""
    return union_all([edges.filter(F.col(c) == 1).select("src", "dst", F.lit(s).alias("split")) for s, c in masks.items()])


def negative_edges(positive: DataFrame, nodes: int, per_edge: int = 1, seed: int = 7, attempts: int = 8, draw: Callable[[Column, int], Column] | None = None) -> DataFrame:
    """(src, dst): per_edge pairs of node numbers for each edge that are no edge and no loop, drawn by hash; repeats count once.

    Each place draws `attempts` times and keeps its first pair that is free, so that a place stays empty only if all its draws
    hit edges. `draw` gives a whole number for a column and a salt; by default a 64-bit hash.
    """
    draw = draw or (lambda c, salt: F.xxhash64(c, F.lit(seed), F.lit(salt)))
    e = positive.select("src", "dst").distinct()
    place = e.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(per_edge - 1)), lambda k: (F.col("src") * nodes + F.col("dst")) * per_edge + k)).alias("place"))
    tries = place.select("place", F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))).alias("try")).withColumn("c", F.col("place") * attempts + F.col("try"))
    drawn = tries.select("place", "try", F.pmod(draw(F.col("c"), 1), F.lit(nodes)).alias("src"), F.pmod(draw(F.col("c"), 2), F.lit(nodes)).alias("dst")).filter("src <> dst")
    free = drawn.join(e, ["src", "dst"], "left_anti")
    return free.groupBy("place").agg(F.min(F.struct("try", "src", "dst")).alias("m")).select("m.src", "m.dst").distinct()


def path_lengths(steps: DataFrame, sources: DataFrame, cutoff: int | None = None) -> DataFrame:
    """(source, node, depth): least numbers of steps up to the cutoff, or all, the source itself at 0."""
    if cutoff is None:
        return path_lists(steps, sources).select("source", F.explode("nodes").alias("node"), "depth")
    return union_all(levels(steps, sources, cutoff))


def path_lists(steps: DataFrame, sources: DataFrame, most: int = R.MOST_STEPS) -> DataFrame:
    """(source, depth, nodes): all of `path_lengths`, the nodes of a source and distance in lists.

    The pairs are quadratic in the nodes: each source is followed within one task, so that only the result holds them all. More than
    `most` distinct steps are joined, one round a step.
    """
    path, steps = R.stored_steps(steps)
    sources = sources.select(F.col("source").cast(dict(steps.dtypes)["src"]).alias("source"))
    if steps.count() > most:
        return union_all(levels(steps, sources, None)).select("source", "depth", F.array("node").alias("nodes"))
    return R.reach_in_tasks(path, sources)


def closeness(lengths: DataFrame) -> DataFrame:
    """`lengths` with closeness, 1 / (distance + 1), in place of depth; pairs that aren't connected have no row (0)."""
    return lengths.select(*[c for c in lengths.columns if c != "depth"], (1 / (F.col("depth") + 1)).alias("closeness"))


def anchor_sets(nodes: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """(set, idx): log2(n)^2 random sets, m = log2(n) of each size n / 2, n / 4 .. of nodes (idx 0..n-1)."""
    m = max(1, n.bit_length() - 1)
    sets = nodes.sparkSession.createDataFrame([(i * m + j, n / 2 ** (i + 1) / n) for i in range(m) for j in range(m)], "set int, share double")
    u = arithmetic_hash(F.col("idx") + F.col("set") * 31, seed) / 1_000_003
    return nodes.select("idx").crossJoin(F.broadcast(sets)).filter(u < F.col("share")).select("set", "idx")


def nearest_anchors(close: DataFrame, anchors: DataFrame) -> DataFrame:
    """(node, set, closeness, anchor): each node's largest closeness to a set, and the smallest anchor that has it."""
    x = close.join(anchors.withColumnRenamed("idx", "source"), "source")
    return x.groupBy("node", "set").agg(F.max("closeness").alias("closeness"), F.min(F.struct((-F.col("closeness")).alias("c"), "source")).alias("m")).select("node", "set", "closeness", F.col("m.source").alias("anchor"))


def nearest_lists(steps: DataFrame, anchors: DataFrame, most: int = R.MOST_STEPS) -> DataFrame:
    """(set, depth, near): `nearest_anchors` of all nodes that steps reach from the sets (set, idx), as lists of (node, anchor) by distance.

    Each set is spread as one, and a node keeps the smallest of its nearest anchors, so that the work grows with the sets and not
    with the pairs of anchors and nodes. More than `most` distinct steps are joined, one round a step.
    """
    path, steps = R.stored_steps(steps)
    own = anchors.select("set", F.col("idx").cast(dict(steps.dtypes)["src"]).alias("anchor"))
    if steps.count() <= most:
        return R.nearest_in_tasks(path, own)
    seen = front = checkpoint(own.select("set", F.col("anchor").alias("node"), "anchor", F.lit(0).alias("depth")).distinct())
    for depth in count(1):
        near = front.join(steps, F.col("node") == F.col("src")).groupBy("set", F.col("dst").alias("node")).agg(F.min("anchor").alias("anchor"))
        front = checkpoint(near.join(seen, ["set", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen.select("set", "depth", F.array(F.struct("node", "anchor")).alias("near"))


def enclosing_subgraphs(steps: DataFrame, pairs: DataFrame, hops: int = 1) -> tuple[DataFrame, DataFrame]:
    """(nodes (pair, node), edges (pair, src, dst)) within `hops` of either end of pairs (pair, a, b); the pair's own edge is left out."""
    ends = pairs.select("pair", F.col("a").alias("n")).unionByName(pairs.select("pair", F.col("b").alias("n")))
    near = union_all(levels(steps, ends.select(F.col("n").alias("source")).distinct(), hops)).select(F.col("source").alias("n"), "node")
    nodes = checkpoint(ends.join(near, "n").select("pair", "node").distinct())
    e = nodes.withColumnRenamed("node", "src").join(steps.select("src", "dst").distinct(), "src").join(nodes.withColumnRenamed("node", "dst"), ["pair", "dst"])
    e = e.join(pairs, "pair").filter(~(((F.col("src") == F.col("a")) & (F.col("dst") == F.col("b"))) | ((F.col("src") == F.col("b")) & (F.col("dst") == F.col("a"))))).select("pair", "src", "dst")
    return nodes, e


def _distances(edges: DataFrame, start: DataFrame, blocked: DataFrame) -> DataFrame:
    """(pair, node, d) from start (pair, node) in each pair's edges without its blocked node (pair, gone)."""
    e = checkpoint(edges.join(blocked, "pair").filter((F.col("src") != F.col("gone")) & (F.col("dst") != F.col("gone"))).select("pair", "src", "dst"))
    front = checkpoint(start.withColumn("d", F.lit(0)))
    seen = front
    for d in count(1):
        front = checkpoint(front.withColumnRenamed("node", "src").join(e, ["pair", "src"]).select("pair", F.col("dst").alias("node")).distinct().join(seen, ["pair", "node"], "left_anti").withColumn("d", F.lit(d)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def drnl_labels(nodes: DataFrame, edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair, node, z): 1 + min(x, y) + (d // 2)(d // 2 + d % 2 - 1), d = x + y, of the distances to either end without the other.

    The ends are 1, nodes that miss an end are 0.
    """
    a, b = pairs.select("pair", F.col("a").alias("node")), pairs.select("pair", F.col("b").alias("node"))
    x = _distances(edges, a, b.withColumnRenamed("node", "gone")).withColumnRenamed("d", "x")
    y = _distances(edges, b, a.withColumnRenamed("node", "gone")).withColumnRenamed("d", "y")
    n = nodes.join(x, ["pair", "node"], "left").join(y, ["pair", "node"], "left").join(pairs, "pair")
    h = F.floor((F.col("x") + F.col("y")) / 2)
    z = 1 + F.least("x", "y") + h * (h + (F.col("x") + F.col("y")) % 2 - 1)
    return n.select("pair", "node", F.when((F.col("node") == F.col("a")) | (F.col("node") == F.col("b")), 1).otherwise(F.coalesce(z, F.lit(0))).cast("int").alias("z"))


def text_draw(*parts: Column) -> Column:
    """A whole number below 2^32 that any SQL engine computes alike from texts and numbers."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("bigint")


def random_walks(steps: DataFrame, sources: DataFrame, walks: int, length: int, seed: int = 7, draw: Callable[..., Column] | None = None) -> DataFrame:
    """(source, walk, path): walks of up to `length` nodes; the next node's number among the neighbours is a hash of walk and step.

    Neighbours are numbered first, so that a walk meets one row of its node's neighbours and not all those of a hub. A walk
    ends early at a node without steps. `draw` gives a whole number for columns; by default a 64-bit hash.
    """
    draw = draw or F.xxhash64
    steps = dense_index(steps.select("src", "dst").distinct(), "dst", ["src"]).select("src", "dst", F.col("idx").cast("bigint").alias("at"))
    steps = checkpoint(steps.join(steps.groupBy("src").agg(F.count("*").alias("deg")), "src"))
    degree = steps.filter("at = 0").select(F.col("src").alias("node"), "deg")
    w = sources.select("source", F.explode(F.sequence(F.lit(0), F.lit(walks - 1))).alias("walk"), F.array("source").alias("path"))
    for i in range(length - 1):
        w = w.withColumn("node", F.element_at("path", -1)).join(degree, "node", "left")
        w = w.withColumn("at", F.pmod(draw(F.lit(seed), F.lit(i), F.col("source"), F.col("walk")), F.col("deg"))).drop("deg")
        w = w.join(steps.select(F.col("src").alias("node"), "at", "dst"), ["node", "at"], "left")
        w = checkpoint(w.select("source", "walk", F.when(F.col("dst").isNotNull() & (F.size("path") == i + 1), F.concat("path", F.array("dst"))).otherwise(F.col("path")).alias("path")))
    return w


def skip_grams(walks: DataFrame, window: int) -> DataFrame:
    """(a, b): distinct pairs of nodes at most window // 2 apart in a walk, in both orders."""
    h = window // 2
    pairs = F.flatten(F.transform("path", lambda x, i: F.transform(F.filter("path", lambda y, j: (F.abs(i - j) <= h) & (i != j)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return walks.select(F.inline(pairs)).distinct()


def sample_neighbors(steps: DataFrame, seeds: DataFrame, fanout: int, order: Column) -> DataFrame:
    """(src, dst): at most `fanout` steps into each seed (seed), the smallest by `order`, then src."""
    e = steps.select("src", "dst").distinct().join(seeds.select(F.col("seed").alias("dst")).distinct(), "dst", "left_semi")
    return e.withColumn("r", F.row_number().over(Window.partitionBy("dst").orderBy(order, "src"))).filter(F.col("r") <= fanout).select("src", "dst")


def nodes_per_type(edges: DataFrame) -> DataFrame:
    return edges.select("label", F.explode(F.array("src", "dst")).alias("node")).distinct()


def cluster_parts(edges: DataFrame, part: Column, other: Column) -> DataFrame:
    """Edges inside one part, with it: the induced subgraphs of a partition by a function of the ends."""
    return edges.withColumn("part", part).filter(part == other)


def drop_edges(edges: DataFrame, share: float, order: Column) -> DataFrame:
    """Edges whose hash in 0..1 is at least `share`."""
    return edges.filter(order >= share)


def mask_features(df: DataFrame, feat_col: str, dims: int, share: float, seed: int = 7) -> DataFrame:
    """`df` with the same features zeroed in all rows: those whose hash is below `share`."""
    keep = [float(((i * 7919 + seed) % 1_000_003 * 104_729 + seed) % 1_000_003 / 1_000_003 >= share) for i in range(dims)]
    return df.withColumn(feat_col, F.zip_with(feat_col, F.array(*[F.lit(k) for k in keep]), lambda x, k: x * k))


def index_mask(df: DataFrame, idx_col: str, chosen: DataFrame) -> DataFrame:
    """`df` with boolean `mask`: whether its index is among chosen (idx)."""
    c = chosen.select(F.col("idx").alias(idx_col)).distinct().withColumn("mask", F.lit(True))
    return df.join(c, idx_col, "left").withColumn("mask", F.coalesce("mask", F.lit(False)))


def normalize_features(df: DataFrame, cols: Sequence[str], train: Column) -> DataFrame:
    """Columns scaled to 0..1 by the range in the training rows; a constant column is 0. Missing values stay."""
    r = df.filter(train).agg(*[f(c).alias(f"_{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    x = df.crossJoin(F.broadcast(r))
    return x.withColumns({c: F.when(F.col(c).isNotNull(), F.coalesce(F.try_divide(F.col(c) - F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}")), F.lit(0.0))) for c in cols}).drop(*r.columns)


def replace_missing(df: DataFrame, cols: Sequence[str], train: Column) -> DataFrame:
    """Missing values become the training minimum less 1."""
    r = df.filter(train).agg(*[F.min(c).alias(f"_lo_{c}") for c in cols])
    return df.crossJoin(F.broadcast(r)).withColumns({c: F.coalesce(F.col(c), F.col(f"_lo_{c}") - 1) for c in cols}).drop(*r.columns)


def target_encode(df: DataFrame, cat_col: str, y: str, train: Column) -> DataFrame:
    """`df` with `<cat>_enc`: the training mean of y per category; the overall mean for unseen ones."""
    m = df.filter(train).groupBy(F.col(cat_col).alias("_c")).agg(F.avg(y).alias(f"{cat_col}_enc"))
    overall = df.filter(train).agg(F.avg(y).alias("_all"))
    return df.join(m, F.col(cat_col).eqNullSafe(F.col("_c")), "left").drop("_c").crossJoin(F.broadcast(overall)).withColumn(f"{cat_col}_enc", F.coalesce(f"{cat_col}_enc", "_all")).drop("_all")


def rewired(edges: DataFrame, nodes: int, share: float = 0.01, seed: int = 7) -> DataFrame:
    """(src, dst) of dense edges (src, dst): about `share` of them lead to another node, unless that edge exists already; no loops,
    both directions."""
    e = edges.select("src", "dst").distinct()
    h = arithmetic_hash(F.col("src") * nodes + F.col("dst"), seed)
    picked = e.filter(h / 1_000_003 < share).withColumn("new", F.pmod(arithmetic_hash(F.col("src") * nodes + F.col("dst"), seed + 1), F.lit(nodes)))
    moved = picked.join(e.select("src", F.col("dst").alias("new")), ["src", "new"], "left_anti")
    kept = e.join(moved.select("src", "dst"), ["src", "dst"], "left_anti").unionByName(moved.select("src", F.col("new").alias("dst")))
    return bidirected(kept.filter("src <> dst"))


def block_pairs(nodes: DataFrame, size: int = 20) -> DataFrame:
    """(a, b): pairs a > b of dense nodes (idx) in one block of `size` following numbers; at most size - 1 a node."""
    low = F.col("idx") - F.col("idx") % size
    pairs = nodes.select(F.col("idx").alias("a"), F.explode(F.when(F.col("idx") > low, F.sequence(low, F.col("idx") - 1)).otherwise(F.array().cast("array<bigint>"))).alias("b"))
    return pairs.join(nodes.select(F.col("idx").alias("b")), "b", "left_semi").select("a", "b")


def labelled_pairs(edges: DataFrame, nodes: int, negatives: int = 1, ratio: float | None = None, seed: int = 7) -> DataFrame:
    """(src, dst, label): edges as 1 beside absent pairs as 0; with `ratio`, about that share of the edges and their negatives."""
    e = edges.select("src", "dst").distinct()
    if ratio is not None:
        e = e.filter(arithmetic_hash(F.col("src") * nodes + F.col("dst"), seed + 3) / 1_000_003 < ratio)
    no = negative_edges(edges, nodes, negatives).join(e.select("src").distinct(), "src", "left_semi") if ratio is not None else negative_edges(edges, nodes, negatives)
    return e.withColumn("label", F.lit(1)).unionByName(no.select("src", "dst", F.lit(0).alias("label")))


def split_graphs(graphs: DataFrame, draw: Column) -> DataFrame:
    """`graphs` (graph_id) with `split`: 70 % train, 20 % valid, 10 % test by a draw in [0, 1)."""
    return graphs.withColumn("split", F.when(draw < 0.7, "train").when(draw < 0.9, "valid").otherwise("test"))
