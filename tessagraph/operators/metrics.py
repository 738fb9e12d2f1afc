"""Scores of classifiers, rankings and link predictions."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessagraph.session import checkpoint


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def recall_per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("recall"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, weight): 1 over the class's count."""
    return df.groupBy(label).agg((1 / F.count("*")).alias("weight"))


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: area under the curve by ranks, ties at their mean; null without both classes.

    Ranks come from the counts per distinct score, range-partitioned by score: only the partitions' totals are put in one row each.
    """
    spread = checkpoint(df.groupBy(score).agg(F.count("*").alias("n"), F.sum((F.col(label) == 1).cast("bigint")).alias("p")).repartitionByRange(score).withColumn("part", F.spark_partition_id()))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = spread.groupBy("part").agg(F.sum("n").alias("n")).withColumn("base", earlier(Window.orderBy("part"))).drop("n")  # one row per partition
    x = spread.withColumn("before", earlier(Window.partitionBy("part").orderBy(score))).join(F.broadcast(parts), "part").withColumn("rank", F.col("base") + F.col("before") + (F.col("n") + 1) / 2)
    t = x.agg(F.sum(F.col("p") * F.col("rank")).alias("r"), F.sum("p").alias("p"), F.sum(F.col("n") - F.col("p")).alias("m"))
    return t.select(F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p").cast("double") * F.col("m")).alias("auc"))


def hits_at(positive: DataFrame, negative: DataFrame, k: int, score: str = "score") -> DataFrame:
    """One row: share of positives above the k-th largest negative; 1 with fewer negatives."""
    kth = negative.orderBy(F.desc(score)).limit(k).agg(F.count("*").alias("n"), F.min(score).alias("t"))
    return positive.crossJoin(F.broadcast(kth)).agg(F.avg(F.when(F.col("n") < k, 1.0).otherwise((F.col(score) > F.col("t")).cast("double"))).alias("hits"))


@dataclass
class EarlyStopping:
    """Whether a loss (or an accuracy) has not improved by min_delta for `patience` steps; keeps the best step."""

    patience: float = math.inf
    min_delta: float = 0.0
    monitor: str = "loss"
    best: float | None = None
    best_step: int = -1
    step: int = field(default=-1)

    def update(self, value: float) -> bool:
        self.step += 1
        better = self.best is None or (value < self.best - self.min_delta if self.monitor == "loss" else value > self.best + self.min_delta)
        if better:
            self.best, self.best_step = value, self.step
        return self.step - self.best_step >= self.patience


def warmed_cosine(steps: DataFrame, largest: float, warmup: int, total: int) -> DataFrame:
    """`steps` (step) with `rate`: a ramp over the warm-up times half a cosine wave over the rest; null beyond `total`."""
    ramp = F.least(F.lit(1.0), F.col("step") / F.lit(max(warmup, 1)))
    phase = F.greatest(F.lit(0.0), (F.col("step") - warmup) / F.lit(max(total - warmup, 1)))
    return steps.withColumn("rate", F.when(F.col("step").between(0, total), largest * ramp * (F.cos(phase * math.pi) + 1) / 2))
