"""Mixing sources to target weights along a curriculum whose weights change over the training run."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessagraph.session import checkpoint

#: Rows of one source that are summed up in one task.
GROUP = 100_000


def warming_schedule(weights: dict[str, float], swing: float = 0.5) -> dict[str, list[tuple[float, float]]]:
    """Knots (t, weight) for each source: begins nearer to equal shares and ends farther from them.

    Each source's mean over t in [0, 1] is its weight, and the weights sum to 1 at every t. `swing` is the share of the
    largest change that keeps all weights positive.
    """
    even = 1 / max(1, len(weights))
    most = min([1.0, *(w / (even - w) for w in weights.values() if w < even)])
    return {s: [(0.0, w + swing * most * (even - w)), (1.0, w - swing * most * (even - w))] for s, w in weights.items()}


def mix_sources(docs: DataFrame, targets: DataFrame, total: float | None = None, schedule: dict[str, list[tuple[float, float]]] | None = None, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(training, shares) of docs (id, source, tokens) for targets (source, target_weight, max_repeats).

    training: id, source, epoch (from 1), tokens, position (tokens before it in the run's plan), in order of position. Documents
    of a source are drawn in a random order that changes with each epoch; a source's next epoch begins when every document
    was used, and none is used more than max_repeats times. `total` tokens are drawn, or as many as the scarcest source
    allows at its weight. Sources without any token give their weight to the others in proportion. The schedule's
    weights are integrated over the run; the inverse of that integral, at the middle of a document's tokens in
    its source, is its position. A document is drawn if its middle lies within the source's demand, so
    that each source misses it by half a document at most. shares: one row per source of either table with what it has
    and gave; sources that have no target give nothing. Null or zero tokens: never drawn. Null weights and
    repeats count as 0 and 1; repeated target rows count once. To the driver come the totals of the targets' sources.
    """
    spark = docs.sparkSession
    docs = checkpoint(docs.select("id", "source", F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens")))
    targets = targets.filter("source is not null").groupBy("source").agg(F.coalesce(F.max("target_weight"), F.lit(0.0)).alias("w"), F.coalesce(F.max("max_repeats"), F.lit(1)).alias("r"))
    have = docs.groupBy("source").agg(F.sum("tokens").alias("have"), F.count("*").alias("documents"))
    known = [x for x in targets.join(have, "source").filter("w > 0 and r > 0 and have > 0").collect()]
    scale = sum(x.w for x in known)
    weight = {x.source: x.w / scale for x in known}
    most = min((x.have * x.r / weight[x.source] for x in known), default=0.0)
    run = most if total is None else min(float(total), most)
    knots = schedule or warming_schedule(weight)
    rows = []
    for x in known:
        k = knots[x.source]
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(k, k[1:]))
        per, at, parts = weight[x.source] * run / area, 0.0, []
        for (t0, w0), (t1, w1) in zip(k, k[1:]):
            parts.append((t0, t1, w0 * per, w1 * per, at))
            at += (t1 - t0) * (w0 + w1) / 2 * per
        demand = weight[x.source] * run
        rows.append((x.source, demand, min(x.r, max(1, ceil(demand / x.have - 1e-9))), -(-x.documents // GROUP), parts))
    plan = spark.createDataFrame(rows, "source string, demand double, epochs int, groups bigint, parts array<struct<t0:double,t1:double,d0:double,d1:double,before:double>>")
    drawn = docs.filter("tokens > 0").join(F.broadcast(plan), "source").withColumn("epoch", F.explode(F.sequence(F.lit(1), "epochs")))
    drawn = drawn.withColumn("h", F.xxhash64(F.lit(seed), "id", "epoch")).withColumn("grp", F.shiftright(F.shiftrightunsigned("h", 24) * F.col("groups"), 40))
    drawn = drawn.withColumn("key", F.shiftrightunsigned("h", 24))
    sums = drawn.groupBy("source", "epoch", "grp").agg(F.sum("tokens").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("epoch", "grp").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inner = Window.partitionBy("source", "epoch", "grp").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = drawn.withColumn("upto", F.sum("tokens").over(inner)).join(sums, ["source", "epoch", "grp"]).withColumn("mid", F.col("before") + F.col("upto") - F.col("tokens") / 2).filter("mid <= demand")
    part = F.element_at(F.filter("parts", lambda p: p.before <= F.col("mid")), -1)
    placed = placed.withColumn("p", part).withColumn("x", F.col("mid") - F.col("p.before"))
    slope = (F.col("p.d1") - F.col("p.d0")) / (F.col("p.t1") - F.col("p.t0"))
    t = F.col("p.t0") + 2 * F.col("x") / (F.col("p.d0") + F.sqrt(F.greatest(F.lit(0.0), F.col("p.d0") ** 2 + 2 * slope * F.col("x"))))
    training = checkpoint(placed.select("id", "source", "epoch", "tokens", (F.least(t, F.lit(1.0)) * F.lit(float(run))).alias("position")))
    used = training.groupBy("source").agg(F.sum("tokens").alias("used"), F.max("epoch").alias("repeats"))
    all_used = F.sum("used").over(Window.partitionBy())
    shares = targets.join(have, F.equal_null(targets.source, have.source), "full").select(F.coalesce(targets.source, have.source).alias("source"), "w", "r", "have", "documents").join(used, "source", "left")
    shares = shares.select("source", F.col("w").alias("target_weight"), F.col("r").alias("max_repeats"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("have", F.lit(0)).alias("tokens"), F.coalesce("used", F.lit(0)).alias("used_tokens"), F.coalesce("repeats", F.lit(0)).alias("repeats"), F.coalesce(F.col("used") / all_used, F.lit(0.0)).alias("actual_share"))
    return training.orderBy("position", "source", "id"), shares
