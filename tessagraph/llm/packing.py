"""Filling containers of fixed capacity: dominance reduction, then best fit, on the histogram of sizes.

Sizes are whole numbers up to the capacity, so that an instance of any number of items is a histogram of at most `capacity`
counts. The plan is made on the driver from that histogram: it fixes runs of equal containers at once, so that its
steps follow the number of sizes, never the number of items. The items then find their containers by their rank
among the items of their size; ranks come from counts per group of at most `GROUP` rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessagraph.session import checkpoint

#: Rows of one size that are ranked in one task.
GROUP = 100_000


@dataclass
class Plan:
    """Runs (size, first rank, first container, items per container) and the number of containers."""

    capacity: int
    containers: int = 0
    fixed: int = 0
    runs: list[tuple[int, int, int, int]] = field(default_factory=list)
    used: dict[int, int] = field(default_factory=dict)

    def put(self, size: int, containers: int, base: int, each: int) -> None:
        """The next containers * each items of `size` go into containers from `base` on, `each` into each."""
        self.runs.append((size, self.used.get(size, 0), base, each))
        self.used[size] = self.used.get(size, 0) + containers * each

    def open(self, n: int) -> int:
        self.containers += n
        return self.containers - n


def _smallest(sizes: list[int], left: dict[int, int], without: int, n: int) -> list[int]:
    """The n smallest items left, one item of size `without` not counted; fewer if there are fewer."""
    out: list[int] = []
    for s in sizes:
        out += [s] * min(n - len(out), left[s] - (s == without))
        if len(out) >= n:
            break
    return out[:n]


def reduce(plan: Plan, left: dict[int, int]) -> None:
    """Martello and Toth's reduction: fix sets that dominate every other set with the same item; shrinks `left`.

    For an item w with capacity c: alone if nothing fits beside it; with its exact complement; with the largest item k that
    fits if no two others fit beside w, or if no three fit and k is at least the largest sum of two that fit. Equal
    items are fixed together, as many as the partner allows. Sizes are tried from the largest until none changes.
    """
    c, changed = plan.capacity, True
    while changed:
        changed = False
        for w in sorted(left, reverse=True):
            while left.get(w, 0) > 0:
                sizes = sorted(left)
                least = _smallest(sizes, left, w, 3)
                room = c - w
                if not least or least[0] > room:
                    n = left.pop(w) if not least or w != least[0] else left[w]
                    left.pop(w, None)
                    base = plan.open(n)
                    plan.put(w, n, base, 1)
                    plan.fixed += n
                    changed = True
                    break
                i = bisect_left(sizes, room + 1) - 1
                if sizes[i] == w and left[w] < 2:
                    i -= 1
                k = sizes[i]
                dominant = k == room or len(least) < 2 or least[0] + least[1] > room
                if not dominant and (len(least) < 3 or sum(least) > room):
                    best, a, b = 0, 0, i
                    while a <= b:
                        pair_ok = a != b or left[sizes[a]] - (sizes[a] == w) >= 2
                        if sizes[a] + sizes[b] > room:
                            b -= 1
                        else:
                            if pair_ok:
                                best = max(best, sizes[a] + sizes[b])
                            a += 1
                    dominant = k >= best
                if not dominant:
                    break
                n = left[w] // 2 if k == w else min(left[w], left[k])
                base = plan.open(n)
                if k == w:
                    plan.put(w, n, base, 2)
                    left[w] -= 2 * n
                else:
                    plan.put(w, n, base, 1)
                    plan.put(k, n, base, 1)
                    left[w] -= n
                    left[k] -= n
                plan.fixed += n
                for s in {w, k}:
                    if not left[s]:
                        del left[s]
                changed = True


def best_fit(plan: Plan, left: dict[int, int]) -> None:
    """Best fit by falling size over runs of containers with equal space left."""
    free: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []

    def give(space: int, base: int, n: int) -> None:
        if space > 0 and n > 0:
            if not free.get(space):
                free[space] = []
                insort(spaces, space)
            free[space].append((base, n))

    for s in sorted(left, reverse=True):
        n = left[s]
        while n > 0:
            i = bisect_left(spaces, s)
            if i == len(spaces):
                each = plan.capacity // s
                base, m, space = plan.open(-(-n // each)), -(-n // each), plan.capacity
            else:
                space = spaces[i]
                base, m = free[space].pop()
                if not free[space]:
                    del spaces[i]
                each = space // s
            whole = min(m, n // each)
            if whole:
                plan.put(s, whole, base, each)
                give(space - each * s, base, whole)
                n -= whole * each
            if whole < m:
                if n:
                    plan.put(s, 1, base + whole, n)
                    give(space - n * s, base + whole, 1)
                    whole, n = whole + 1, 0
                give(space, base + whole, m - whole)


def make_plan(histogram: dict[int, int], capacity: int) -> Plan:
    """A plan for sizes 1..capacity with their counts."""
    plan, left = Plan(capacity), {s: n for s, n in histogram.items() if s > 0 and n > 0}
    reduce(plan, left)
    best_fit(plan, left)
    return plan


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """Martello and Toth's bound L2: no packing can use fewer containers."""
    sizes = np.array(sorted(s for s in histogram if s > 0), np.int64)
    n = np.array([histogram[int(s)] for s in sizes], np.int64)
    if not len(sizes):
        return 0
    best = -(-int((sizes * n).sum()) // capacity)
    for k in [0, *sizes[sizes <= capacity // 2].tolist()]:
        big, mid, low = sizes > capacity - k, (sizes <= capacity - k) & (2 * sizes > capacity), (2 * sizes <= capacity) & (sizes >= k)
        spare = int(n[mid].sum()) * capacity - int((sizes * n)[mid].sum())
        best = max(best, int(n[big].sum()) + int(n[mid].sum()) + max(0, -(-(int((sizes * n)[low].sum()) - spare) // capacity)))
    return best


@dataclass
class Runs:
    """All plans' runs, sorted by pack, size and first rank, and the containers of each pack."""

    pack: np.ndarray
    size: np.ndarray
    first: np.ndarray
    base: np.ndarray
    each: np.ndarray
    containers: np.ndarray

    def place(self, pack: np.ndarray, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The container of each item by its rank among the items of its size; items of size 0 are spread over all.

        Packs are searched first, then sizes among the runs of the pack, then ranks among those of the size, so that no
        combined code has to fit into a word.
        """
        spread = rank % np.maximum(1, self.containers[pack])
        if not len(self.pack):
            return spread
        low, high = np.searchsorted(self.pack, pack, "left"), np.searchsorted(self.pack, pack, "right")
        low, high = self._last(self.size, low, high, size - 1) + 1, self._last(self.size, low, high, size) + 1
        i = np.maximum(self._last(self.first, low, high, rank), 0)
        return np.where(size == 0, spread, self.base[i] + (rank - self.first[i]) // self.each[i])

    @staticmethod
    def _last(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """The last index in [low, high) whose value, rising there, is at most `wanted`; low - 1 for none."""
        low, high = low - 1, high.copy()
        while (open_ := high - low > 1).any():
            mid = (low + high) // 2
            fits = open_ & (values[np.clip(mid, 0, len(values) - 1)] <= wanted)
            low, high = np.where(fits, mid, low), np.where(open_ & ~fits, mid, high)
        return low


def pack(items: DataFrame, packs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(assignment, summary) of items (id, tokens) for each row of packs (pack_name, capacity_tokens).

    assignment: pack_name, container_id (from 0), id, piece_no, tokens. An item above the capacity is split into pieces of the
    full capacity, each filling a container, and a rest; no other item is split. Items without tokens (or with null) are
    spread over the containers. Equal ids are items of their own. Packs with a null, zero or negative capacity, and
    repeated packs, are left out. summary: one row per pack with containers, the share of space used, the containers fixed
    by the reduction, and the lower bound. Read to the driver: packs, and at most capacity counts per pack.
    """
    spark = items.sparkSession
    given = sorted({(r.pack_name, r.capacity_tokens) for r in packs.select("pack_name", "capacity_tokens").collect() if r.pack_name is not None and (r.capacity_tokens or 0) > 0})
    items = checkpoint(items.select("id", F.coalesce("tokens", F.lit(0)).alias("tokens")))
    caps = spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(given)], "pack int, pack_name string, capacity bigint")
    sizes = items.groupBy("tokens").agg(F.count("*").alias("n")).crossJoin(F.broadcast(caps))
    whole, rest = F.expr("tokens div capacity"), F.expr("tokens % capacity")
    parts = F.inline(F.array(F.struct(F.col("capacity").alias("size"), (F.col("n") * whole).alias("m")), F.struct(rest.alias("size"), F.when((rest > 0) | (F.col("tokens") == 0), F.col("n")).otherwise(0).alias("m"))))
    counts = sizes.select("pack", "pack_name", "capacity", parts).groupBy("pack", "pack_name", "capacity", "size").agg(F.sum("m").alias("n")).filter("n > 0").collect()
    starts, keys, base, each, rows, total = [], [], [], [], [], {}
    for i, (name, cap) in enumerate(given):
        h = {r["size"]: r["n"] for r in counts if r["pack"] == i}
        plan = make_plan(h, cap)
        total[i] = plan.containers
        for size, first, at, k in plan.runs:
            keys.append((i, size, first))
            starts.append(first)
            base.append(at)
            each.append(k)
        tokens = sum(s * n for s, n in h.items())
        rows.append((name, cap, sum(h.values()), tokens, plan.containers, plan.fixed, lower_bound(h, cap), tokens / (cap * plan.containers) if plan.containers else 0.0))
    summary = spark.createDataFrame(rows, "pack_name string, capacity_tokens bigint, pieces bigint, tokens bigint, containers bigint, containers_fixed bigint, lower_bound bigint, space_used double")
    # Ranks: salted groups of a size, the groups' offsets from their counts.
    salts = spark.createDataFrame([(r["pack"], r["size"], -(-r["n"] // GROUP)) for r in counts], "pack int, size bigint, salts bigint")
    wide = items.crossJoin(F.broadcast(caps)).withColumn("piece_no", F.explode(F.expr("sequence(0L, greatest(0L, (tokens + capacity - 1) div capacity - 1))")))
    pieces = wide.select("pack", "pack_name", "id", F.col("piece_no").cast("int").alias("piece_no"), F.least(F.expr("tokens - piece_no * capacity"), F.col("capacity")).alias("size"))
    pieces = pieces.join(F.broadcast(salts), ["pack", "size"]).withColumn("salt", F.pmod(F.xxhash64("id", "piece_no"), F.col("salts")))
    group = ["pack", "size", "salt"]
    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy("id", "piece_no")) - 1)
    split = {(r["pack"], r["size"]) for r in counts if r["n"] > GROUP}
    if split:  # only sizes with more than one group have offsets other than 0
        many = F.broadcast(spark.createDataFrame(sorted(split), "pack int, size bigint"))
        offsets = pieces.join(many, ["pack", "size"], "left_semi").groupBy(*group).agg(F.count("*").alias("n")).withColumn("offset", F.sum("n").over(Window.partitionBy("pack", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).drop("n")
        ranked = ranked.join(offsets, group, "left").withColumn("rank", F.col("rank") + F.coalesce("offset", F.lit(0)))
    order = sorted(range(len(keys)), key=keys.__getitem__)
    column = lambda x: np.array([x[i] for i in order], np.int64)
    runs = Runs(column([k[0] for k in keys]), column([k[1] for k in keys]), column(starts), column(base), column(each), np.array([total[i] for i in range(len(given))], np.int64))
    table = spark.sparkContext.broadcast(runs)

    @F.pandas_udf("bigint")
    def container(p: pd.Series, size: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(table.value.place(p.to_numpy(np.int64), size.to_numpy(np.int64), rank.to_numpy(np.int64)))

    out = ranked.select("pack_name", container("pack", "size", "rank").alias("container_id"), "id", "piece_no", F.col("size").alias("tokens"))
    return out, summary
