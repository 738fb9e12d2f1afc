"""References to vertices that are missing, were removed before, or were loaded only later.

Plan: references are pre-aggregated per key and period with map-side combine, so that a key that holds a third of all rows
costs one row per period. Pairs of key and period with `heavy_rows` references and more are split off, if their number allows a
broadcast: they are checked against the loads of their keys alone, and their rows never shuffle. The other pairs meet the keys
that were ever loaded in a shuffled anti-join, which gives the missing ones, and in a join with the first load and removal,
which drops those that are clean for certain. Only the references of suspect pairs are joined again. Both parts' orphans, or
their counts, are united.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessagraph.session import BROADCAST_ROWS, checkpoint, small

KEY = ["ref_label", "ref_id"]
#: Stands for the period of references without a time.
UNDATED = "0001-01-01"


def trimmed(c: Column) -> Column:
    """Without whitespace of any kind (blanks, tabs, line breaks, no-break blanks) at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def canonical_endpoint(raw: Column, label: Column, key_labels: dict[str, int]) -> Column:
    """An endpoint as vertex id: trimmed, the label's name before the first colon replaced by its id.

    `key_labels` has the label ids of the labels with a primary key (schema metadata, a handful of rows).
    """
    v = trimmed(raw)
    out = v
    for name, label_id in sorted(key_labels.items()):
        out = F.when((label == name) & v.startswith(f"{name}:"), F.concat(F.lit(f"{label_id}:"), F.substring(v, len(name) + 2, 1 << 30))).otherwise(out)
    return out


def edge_references(edges: DataFrame, key_labels: dict[str, int]) -> DataFrame:
    """(edge_id, endpoint, ref_label, ref_id, t, period): one row per endpoint that isn't null; period is the month of t."""
    end = lambda e: F.struct(F.lit(e).alias("endpoint"), F.col(f"{e}Label").alias("ref_label"), canonical_endpoint(F.col(e), F.col(f"{e}Label"), key_labels).alias("ref_id"))
    return (
        edges.select("edge_id", F.col("loaded_at").alias("t"), F.inline(F.array(end("outV"), end("inV"))))
        .filter(F.col("ref_id").isNotNull())
        .withColumn("period", F.trunc("t", "month"))
    )


def removal_intervals(loads: DataFrame, removals: DataFrame) -> DataFrame:
    """(ref_label, ref_id, gone_from, gone_to): times at which the last event of a key is a removal; gone_to null is open.

    loads, removals: KEY and ts. The next load after a removal is searched within the removal's day and among the first
    loads of later days, so that no window holds more than a day of one key, or one row per day. At equal times the
    load counts as last.
    """
    removals = removals.filter(F.col("ts").isNotNull()).select(*KEY, "ts").distinct()
    loads = loads.filter(F.col("ts").isNotNull()).join(removals.select(*KEY).distinct(), KEY, "left_semi").select(*KEY, "ts").distinct()
    events = loads.withColumn("load", F.col("ts")).unionByName(removals.withColumn("load", F.lit(None).cast("timestamp_ntz" if dict(loads.dtypes)["ts"] == "timestamp_ntz" else "timestamp")))
    events = events.withColumn("day", F.to_date("ts"))
    in_day = Window.partitionBy(*KEY, "day").orderBy("ts").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    later = Window.partitionBy(*KEY).orderBy("day").rowsBetween(1, Window.unboundedFollowing)
    days = events.groupBy(*KEY, "day").agg(F.min("load").alias("first")).withColumn("next_day", F.min("first").over(later)).select(*KEY, "day", "next_day")
    return (
        events.withColumn("same_day", F.min("load").over(in_day)).filter(F.col("load").isNull())
        .join(days, [*KEY, "day"], "left")
        .select(*KEY, F.col("ts").alias("gone_from"), F.coalesce("same_day", "next_day").alias("gone_to"))
        .groupBy(*KEY, "gone_to").agg(F.min("gone_from").alias("gone_from"))
    )


@dataclass(frozen=True)
class Orphans:
    """Orphan references in disjoint parts (by key and period): of heavy keys, of all others, and without a label."""

    parts: tuple[DataFrame, ...]

    def rows(self) -> DataFrame:
        """(edge_id, endpoint, ref_label, period, reason), each once."""
        return reduce(DataFrame.unionByName, [_dated(p) for p in self.parts]).distinct()

    def counts(self) -> DataFrame:
        """(ref_label, endpoint, period, reason, orphans): each part is counted by itself, and the counts are united.

        An edge whose rows name different vertices counts for each part that these fall into.
        """
        by = ["ref_label", "endpoint", "period", "reason"]
        return reduce(DataFrame.unionByName, [_dated(p).distinct().groupBy(*by).agg(F.count("*").alias("n")) for p in self.parts]).groupBy(*by).agg(F.sum("n").alias("orphans"))


def _dated(part: DataFrame) -> DataFrame:
    return part.withColumn("period", F.nullif(F.col("period"), F.lit(UNDATED).cast("date")))


def orphan_references(refs: DataFrame, loads: DataFrame, removals: DataFrame, heavy_rows: int = 100_000) -> Orphans:
    """The references of `refs` to vertices that are not present at their time.

    refs: as of `edge_references`; loads and removals: ref_label, ref_id, ts. reason: 'missing' if the key was never loaded,
    else 'late' if every load is after t, else 'deleted' if the last load or removal up to t is a removal. Equal rows
    come out once. A null t can be neither late nor deleted; a null label or a load without time never matches. Empty
    tables give an empty result. Other columns of the inputs are ignored.
    """
    on, cols = [*KEY, "period"], ["edge_id", "endpoint", "ref_label", "period", "reason"]
    refs = refs.select("edge_id", "endpoint", *KEY, "t", F.coalesce("period", F.lit(UNDATED).cast("date")).alias("period"))
    keys = checkpoint(refs.filter(F.col("ref_label").isNotNull()).groupBy(*on).agg(F.count("*").alias("n"), F.min("t").alias("t_min"), F.max("t").alias("t_max")))
    hot = keys.filter(F.col("n") >= heavy_rows)
    few = 0 < hot.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    light = keys.join(F.broadcast(hot.select(*on)), on, "left_anti") if few else keys
    events = loads.select(*KEY, "ts", F.lit(True).alias("is_load")).unionByName(removals.select(*KEY, "ts", F.lit(False).alias("is_load")))

    def history(of: DataFrame) -> DataFrame:
        return of.groupBy(*KEY).agg(F.min(F.when(F.col("is_load"), F.col("ts"))).alias("first_load"), F.min(F.when(~F.col("is_load"), F.col("ts"))).alias("first_removal")).filter(F.col("first_load").isNotNull())

    def suspects(some: DataFrame, known: DataFrame) -> DataFrame:
        """Keys that nothing loads, by an anti-join, and keys that may be late or deleted in their period."""
        unclear = (F.col("t_min") < F.col("first_load")) | (F.col("first_removal") <= F.col("t_max"))
        return some.join(known.select(*KEY), KEY, "left_anti").unionByName(some.join(known, KEY).filter(unclear), allowMissingColumns=True).drop("n")

    def judged(rows: DataFrame, gone: DataFrame) -> DataFrame:
        # The intervals of a key are disjoint, so that at most one of them meets a reference.
        r, g = rows.alias("r"), gone.alias("g")
        met = r.join(g, [F.col(f"r.{c}") == F.col(f"g.{c}") for c in on] + [F.col("t") >= F.col("gone_from"), F.col("gone_to").isNull() | (F.col("t") < F.col("gone_to"))], "left").select("r.*", "gone_from")
        reason = F.when(F.col("first_load").isNull(), "missing").when(F.col("t") < F.col("first_load"), "late").when(F.col("gone_from").isNotNull(), "deleted")
        return met.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(cols)

    intervals = removal_intervals(loads, removals)

    def gaps(some: DataFrame) -> DataFrame:
        met = some.filter(F.col("first_removal") <= F.col("t_max")).join(intervals, KEY)
        return met.filter((F.col("gone_from") <= F.col("t_max")) & (F.col("gone_to").isNull() | (F.col("gone_to") > F.col("t_min")))).select(*on, "gone_from", "gone_to")

    cold = checkpoint(suspects(light, history(events)))
    rest = refs.join(F.broadcast(hot.select(*on)), on, "left_anti") if few else refs
    parts = [judged(rest.join(cold.select(*on, "first_load"), on), gaps(cold))]
    if few:  # the rows of heavy keys stay where they are: their suspects, and their gaps after a count, are broadcast
        own = F.broadcast(hot.select(*KEY).distinct())
        warm = checkpoint(suspects(hot, history(events.join(own, KEY, "left_semi"))))
        gone = checkpoint(gaps(warm))
        parts.append(judged(refs.join(F.broadcast(warm.select(*on, "first_load")), on), F.broadcast(gone) if small(gone) else gone))
    # A null label equals no label: such references are missing without a join.
    parts.append(refs.filter(F.col("ref_label").isNull()).withColumn("reason", F.lit("missing")).select(cols))
    return Orphans(tuple(parts))


def graph_orphans(edges: DataFrame, vertices: list[DataFrame], removals: DataFrame, vertexlabels: DataFrame, heavy_rows: int = 100_000) -> Orphans:
    """`orphan_references` for the tables of a property graph; the schema table is read to the driver (metadata)."""
    key_labels = {r["label"]: r["label_id"] for r in vertexlabels.filter(F.size("primary_keys") > 0).select("label", "label_id").collect()}
    loads = None
    for v in vertices:
        part = v.select(F.col("label").alias("ref_label"), F.col("id").alias("ref_id"), F.col("loaded_at").alias("ts"))
        loads = part if loads is None else loads.unionByName(part)
    gone = removals.select(F.col("label").alias("ref_label"), F.col("vertex_id").alias("ref_id"), F.col("removed_at").alias("ts"))
    return orphan_references(edge_references(edges, key_labels), loads, gone, heavy_rows)
