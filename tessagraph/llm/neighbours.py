"""Most similar vectors for every vector: robust-pruned directed graphs, one per shard, searched with beams.

Searches run for many queries at once on arrays; all sizes below are parameters of `GraphRule`.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessagraph.session import BROADCAST_ROWS, checkpoint, shared_dir, split_join

#: Rows of one direction from which it is heavy.
HEAVY_COPIES = 100_000


@dataclass(frozen=True)
class GraphRule:
    """degree: edges kept per node. beam, build_beam: candidates kept in a search. relax: a candidate is pruned if it is this many
    times nearer (squared distance) to a kept neighbour than to the node. width: nodes opened per step. batch: queries at once.
    starts: nodes at which every search may begin. shard_rows: vectors from which a shard is split, while the cluster has slots
    for more graphs; most_rows: vectors that one task's memory holds, beyond which there are more shards than slots. piece_rows: vectors
    that a task takes to the graphs."""

    degree: int = 48
    beam: int = 48
    build_beam: int = 56
    relax: float = 1.3
    width: int = 4
    batch: int = 256
    starts: int = 256
    shard_rows: int = 32_768
    most_rows: int = 500_000
    piece_rows: int = 65_536


def beam_search(points: np.ndarray, edges: np.ndarray, queries: np.ndarray, starts: np.ndarray, beam: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, similarities), both queries x beam and by falling similarity; -1 and -inf where fewer nodes were reached.

    edges: nodes x degree, a node's own number for none. A query begins at the best of `starts`. In each step it opens its
    `width` best unopened candidates; it ends when its best `beam` candidates are all open. No table of visited nodes is kept:
    what a beam has dropped is worse than its last candidate and cannot come back.
    """
    q, n = len(queries), len(points)
    k = min(len(starts), beam)
    first = queries @ points[starts].T
    lead = np.argpartition(-first, k - 1, axis=1)[:, :k] if k else np.zeros((q, 0), np.int64)
    lead = np.take_along_axis(lead, np.argsort(-np.take_along_axis(first, lead, 1), axis=1), 1)
    ids, sims, closed = np.full((q, beam), -1, np.int32), np.full((q, beam), -np.inf, np.float32), np.ones((q, beam), bool)
    ids[:, :k], sims[:, :k], closed[:, :k] = starts[lead], np.take_along_axis(first, lead, 1), False
    out_id, out_sim = ids.copy(), sims.copy()
    live = np.arange(q)
    room = np.empty((q * width * edges.shape[1], points.shape[1]), np.float32)  # fresh arrays of this size cost more than the arithmetic
    while True:
        place = np.cumsum(~closed, axis=1, dtype=np.int32)
        active = place[:, -1] > 0 if beam else np.zeros(len(live), bool)
        if not active.all():
            out_id[live[~active]], out_sim[live[~active]] = ids[~active], sims[~active]
            live, ids, sims, closed, queries, place = (x[active] for x in (live, ids, sims, closed, queries, place))
        if not len(live):
            return out_id, out_sim
        pick = ~closed & (place <= width)
        closed |= pick
        row, col = np.nonzero(pick)
        near = edges[ids[row, col]]
        vec = np.take(points, near.ravel(), axis=0, out=room[: near.size], mode="clip").reshape(*near.shape, -1)
        sim = np.matmul(vec, queries[row][:, :, None])[:, :, 0]
        i, j = np.nonzero(sim > sims[row, -1][:, None])
        key, at = np.unique(row[i] * n + near[i, j], return_index=True)
        i, j = i[at], j[at]
        known = (ids[row[i]] == near[i, j][:, None]).any(1)
        i, j = i[~known], j[~known]
        if not len(i):
            continue
        to, count = row[i], np.bincount(row[i], minlength=len(live))
        wide = beam + int(count.max())
        spot = beam + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        all_id, all_sim, all_closed = np.full((len(live), wide), -1, np.int32), np.full((len(live), wide), -np.inf, np.float32), np.ones((len(live), wide), bool)
        all_id[:, :beam], all_sim[:, :beam], all_closed[:, :beam] = ids, sims, closed
        all_id[to, spot], all_sim[to, spot], all_closed[to, spot] = near[i, j], sim[i, j], False
        best = np.argsort(-all_sim, axis=1)[:, :beam] + np.arange(len(live))[:, None] * wide
        ids, sims, closed = all_id.ravel()[best], all_sim.ravel()[best], all_closed.ravel()[best]


class NearLists:
    """The k nearest that each of n nodes has met so far."""

    def __init__(self, n: int, k: int) -> None:
        self.ids, self.sims = np.full((n, k), -1, np.int32), np.full((n, k), -np.inf, np.float32)

    def meet(self, a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> None:
        """Each a[i] has met b[i]; a pair that was met before changes nothing."""
        better = (a != b) & (sim > self.sims[a, -1])
        a, b, sim = a[better], b[better], sim[better]
        if not len(a):
            return
        at = np.unique(a.astype(np.int64) * len(self.ids) + b, return_index=True)[1]  # 32 bits would do for 46,340 nodes only
        a, b, sim = a[at], b[at], sim[at]
        new = ~(self.ids[a] == b[:, None]).any(1)
        a, b, sim = a[new], b[new], sim[new]
        if not len(a):
            return
        own, first, count = np.unique(a, return_index=True, return_counts=True)
        k, spot = self.ids.shape[1], np.arange(len(a)) - np.repeat(first, count)
        ids, sims = np.full((len(own), k + count.max()), -1, np.int32), np.full((len(own), k + count.max()), -np.inf, np.float32)
        ids[:, :k], sims[:, :k] = self.ids[own], self.sims[own]
        row = np.repeat(np.arange(len(own)), count)
        ids[row, k + spot], sims[row, k + spot] = b, sim
        best = np.argsort(-sims, axis=1)[:, :k]
        self.ids[own], self.sims[own] = np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)


def robust_prune(points: np.ndarray, own: np.ndarray, cand: np.ndarray, sim: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Neighbours (len(own) x degree, -1 for none) chosen from candidates sorted by falling similarity; -1 is no candidate.

    The nearest candidate is kept, and every other one goes that is `relax` times nearer to it than to the node; again.
    """
    b, c = cand.shape
    safe = np.maximum(cand, 0)
    vec = points[safe]
    between = 1 - np.matmul(vec, vec.transpose(0, 2, 1))
    far = 1 - sim
    alive = (cand >= 0) & (cand != own[:, None])
    out = np.full((b, degree), -1, np.int32)
    rows = np.arange(b)
    for k in range(degree):
        any_ = alive.any(1)
        if not any_.any():
            break
        j = alive.argmax(1)
        out[:, k] = np.where(any_, cand[rows, j], -1)
        alive[rows, j] = False
        alive &= ~((relax * between[rows, j] <= far) & any_[:, None])
    return out


def build_graph(points: np.ndarray, rule: GraphRule, k: int = 10, seed: int = 7) -> tuple[np.ndarray, np.ndarray, NearLists]:
    """(edges, starts, near): the points (unit vectors, float32) are inserted in batches in random order.

    A batch searches the graph so far, prunes the candidates and adds the edges back; nodes with too many edges are pruned again.
    The first batch is compared with itself. near: for every node the k nearest among those that its own insertion's search
    met, or whose search met it, or that are nearest to one of these, so that the graph's own nodes need not search it again. In
    edges, a node's own number stands for none.
    """
    n, d = len(points), rule.degree
    rng = np.random.default_rng(seed)
    order = rng.permutation(n).astype(np.int32)
    slack = d + d // 4
    edges = np.repeat(np.arange(n, dtype=np.int32)[:, None], slack, axis=1)
    size = np.zeros(n, np.int32)
    near = NearLists(n, k + 6)

    def shrink(own: np.ndarray, cand: np.ndarray) -> None:
        sim = np.matmul(points[cand], points[own][:, :, None])[:, :, 0]
        sim[cand == own[:, None]] = -np.inf
        keep(own, cand, sim)

    def keep(own: np.ndarray, cand: np.ndarray, sim: np.ndarray) -> np.ndarray:
        o = np.argsort(-sim, axis=1)
        cand, sim = np.take_along_axis(cand, o, 1), np.take_along_axis(sim, o, 1)
        kept = robust_prune(points, own, np.where(np.isfinite(sim), cand, -1), sim, d, rule.relax)
        edges[own] = own[:, None]
        edges[own, :d] = np.where(kept >= 0, kept, own[:, None])
        size[own] = (kept >= 0).sum(1)
        return kept

    def back(own: np.ndarray, kept: np.ndarray) -> None:
        src, dst = np.repeat(own, kept.shape[1]), kept.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        o = np.argsort(dst, kind="stable")
        src, dst = src[o], dst[o]
        while len(dst):
            place = size[dst] + np.arange(len(dst)) - np.searchsorted(dst, dst)
            fits = place < slack
            edges[dst[fits], place[fits]] = src[fits]
            size[:] += np.bincount(dst[fits], minlength=n).astype(np.int32)
            src, dst = src[~fits], dst[~fits]
            over = np.unique(dst)
            for i in range(0, len(over), rule.batch):
                shrink(over[i : i + rule.batch], edges[over[i : i + rule.batch]])

    def insert(own: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        s = points[own] @ points[own].T
        np.fill_diagonal(s, -np.inf)
        c = min(max(k, 8 if at else 96), len(own) - 1)
        if c > 0:  # members of the batch see each other too
            mates = np.argpartition(-s, c - 1, axis=1)[:, :c]
            ids, sims = np.concatenate([ids, own[mates]], 1), np.concatenate([sims, np.take_along_axis(s, mates, 1)], 1)
        a = np.repeat(own, ids.shape[1])
        real = ids.ravel() >= 0
        a, b, sim = a[real], ids.ravel()[real], sims.ravel()[real]
        near.meet(a, b, sim)
        near.meet(b, a, sim)
        back(own, keep(own, np.where(ids >= 0, ids, own[:, None]), np.where(ids >= 0, sims, -np.inf)))

    at = 0
    while at < n:
        own = order[at : at + (min(rule.batch, at // 2) if at else 128)]
        if at:
            ids, sims = beam_search(points, edges, points[own], order[: min(at, rule.starts)], rule.build_beam, rule.width)
        else:
            ids, sims = np.zeros((len(own), 0), np.int32), np.zeros((len(own), 0), np.float32)
        insert(own, ids, sims)
        at += len(own)
    for at in range(0, n, 2 * rule.batch):
        own = np.arange(at, min(n, at + 2 * rule.batch), dtype=np.int32)
        far = near.ids[near.ids[own]].reshape(len(own), -1)
        sim = np.matmul(points[far], points[own][:, :, None])[:, :, 0]
        i, j = np.nonzero((sim > near.sims[own, -1][:, None]) & (near.ids[own] >= 0).repeat(near.ids.shape[1], 1) & (far >= 0))
        near.meet(own[i], far[i, j], sim[i, j])
        near.meet(far[i, j], own[i], sim[i, j])
    return edges, order[: rule.starts], near


def own_partitions(spark: SparkSession, n: int) -> list[int]:
    """For each of n partitions a whole number that Spark's hash partitioning sends there, so that n groups of rows get one each."""
    tried = spark.range(n * (n.bit_length() + 12)).select(F.col("id").cast("int").alias("k"))
    found = {r.p: r.k for r in tried.groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("p")).agg(F.min("k").alias("k")).collect()}
    return [found.get(i, i) for i in range(n)]


#: Whole units of a unit vector's numbers: nine digits, which 32 bits hold.
BILLION = 1_000_000_000


def unit_vectors(df: DataFrame, id_col: str, vec_col: str, dim: int, whole: bool = False) -> DataFrame:
    """(id, unit): the usable vectors at length 1, to nine digits, so that vectors of one direction are equal.

    Usable are vectors of `dim` finite numbers that are not all zero; very large and small numbers do no harm. whole: the
    numbers are billionths, as integers, which say the same in half the bytes.
    """
    kind = pa.int32() if whole else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = b.column("vec")
            b = b.filter(pc.and_(pc.is_valid(vec), pc.fill_null(pc.equal(pc.list_value_length(vec), dim), False)))
            x = b.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # nulls turn into NaN
            good = np.isfinite(x).all(1) & (x != 0).any(1)
            x = x[good]
            x = x / np.abs(x).max(1, initial=0, keepdims=True)
            x = x / np.sqrt((x * x).sum(1, keepdims=True))
            x = np.rint(x * BILLION).astype(np.int32) if whole else np.round(x, 9) + 0.0
            yield pa.RecordBatch.from_pydict({"id": b.column("id").filter(pa.array(good)), "unit": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dim).cast(pa.list_(kind))})

    src = df.select(df[id_col].alias("id"), df[vec_col].alias("vec"))
    return src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, unit array<{'int' if whole else 'double'}>")


def fixed_lists(x: np.ndarray) -> pa.FixedSizeListArray:
    return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])


def read_shard(path: str, columns: list[str]) -> dict[str, np.ndarray | pa.ListArray]:
    """Columns of a shard's file: mapped, not loaded, where the shared folder is a mounted one. Fixed lists come as matrices."""
    files, at = fs.FileSystem.from_uri(path)
    source = pa.memory_map(at) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(at)
    names = pa.ipc.open_file(source).schema.names
    source.seek(0)
    got = pa.ipc.open_file(source, options=pa.ipc.IpcReadOptions(included_fields=[names.index(c) for c in columns])).get_batch(0)
    return {c: x.values.to_numpy().reshape(-1, x.type.list_size) if pa.types.is_fixed_size_list(x.type) else x if pa.types.is_list(x.type) else x.to_numpy(zero_copy_only=False) for c in columns for x in [got[c]]}


def exact_similarities(asked: np.ndarray, units: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Of each asked vector with each of its nodes, to nine digits; -inf where a node is -1."""
    sim = np.einsum("bd,bcd->bc", asked / BILLION, units[np.maximum(nodes, 0)] / BILLION)
    sim[nodes < 0] = -np.inf
    return sim


def graph_index(rows: DataFrame, dim: int, k: int, shards: int, rule: GraphRule, folder: str) -> list[tuple[str, int]]:
    """(path, nodes) of each shard: one graph per shard of `rows` (id, unit, h1, h2), written by its task into a file in `folder`.

    A node is a direction, with the first k + 1 ids of its rows. A task streams its rows, sorted by direction, onto its own disk;
    its memory holds the vectors in single precision, their edges and the nearest so far. A file counts only if its task ended well.
    """
    cell = F.element_at(F.array(*[F.lit(x) for x in own_partitions(rows.sparkSession, shards)]), F.pmod("h1", F.lit(shards)).cast("int") + 1)
    laid = rows.withColumn("cell", cell).repartition(shards, "cell").sortWithinPartitions("cell", "h1", "h2", "id")

    def write(spool: BinaryIO, ids: list[pa.Array], size: list[np.ndarray]) -> tuple[str, int]:
        count = np.concatenate(size)
        n = len(count)
        spool.flush()
        units = np.memmap(spool, np.int32, "r", shape=(n, dim))
        points = np.empty((n, dim), np.float32)
        np.multiply(units, 1 / BILLION, out=points, casting="unsafe")
        edges, starts, near = build_graph(points, rule, k)
        best = np.empty((n, k), np.int32)
        for at in range(0, n, 8192):
            got = near.ids[at : at + 8192]
            sim = exact_similarities(units[at : at + 8192], units, got)
            best[at : at + 8192] = np.take_along_axis(got, np.argsort(-sim, axis=1, kind="stable")[:, :k], 1)
        first = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        members = pa.ListArray.from_arrays(pa.array(first), pa.concat_arrays(ids))
        t = pa.RecordBatch.from_pydict({"unit": fixed_lists(units), "edges": fixed_lists(edges), "start": pa.array(np.isin(np.arange(n), starts).astype(np.int8)), "near": fixed_lists(best), "members": members})
        files, at = fs.FileSystem.from_uri(path := f"{folder}/{uuid4().hex}.arrow")
        files.create_dir(at.rpartition("/")[0])
        with files.open_output_stream(at) as out, pa.ipc.new_file(out, t.schema) as w:
            w.write_batch(t)
        return path, n

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, spool, ids, size, last, seen = None, None, [], [], None, 0

        def done() -> pa.RecordBatch:
            path, n = write(spool, ids, size)
            return pa.RecordBatch.from_pydict({"path": [path], "nodes": pa.array([n], pa.int64())})

        for b in batches:
            cells = b["cell"].to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(cells)) + 1), len(cells)]
            for lo, hi in zip(cut, cut[1:]):
                if hi == lo:
                    continue
                if cells[lo] != of:
                    if of is not None:
                        yield done()
                    of, spool, ids, size, last, seen = cells[lo], tempfile.TemporaryFile(), [], [], None, 0
                piece = b.slice(lo, hi - lo)
                key = np.stack([piece["h1"].to_numpy(), piece["h2"].to_numpy()], 1)
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]).any(1)
                new[0] = last is None or (key[0] != last).any()
                run = np.cumsum(new) - new[0]  # 0 is the direction that the rows before ended with, unless the first is new
                begin = np.flatnonzero(new)
                held = 0 if new[0] else seen
                place = np.arange(len(key)) - (begin[run] if new[0] else np.concatenate([[-held], begin])[run])
                kept = place <= k
                piece["unit"].filter(pa.array(new)).flatten().to_numpy().tofile(spool)
                ids.append(piece["id"].filter(pa.array(kept)))
                counts = np.bincount(run[kept], minlength=run[-1] + 1)
                if not new[0]:
                    size[-1][-1] += counts[0]
                    counts = counts[1:]
                if len(counts):
                    size.append(counts)
                last, seen = key[-1], place[-1] + 1
        if of is not None:
            yield done()

    return [(r.path, r.nodes) for r in laid.select("cell", "h1", "h2", "id", "unit").mapInArrow(build, "path string, nodes bigint").collect()]


def order_by(*keys: np.ndarray) -> np.ndarray:
    """The order by the keys, the first one first, along the last axis; strings count by their place among these."""
    return np.lexsort([np.unique(x, return_inverse=True)[1].reshape(x.shape) if x.dtype == object else x for x in reversed(keys)], axis=-1)


def search_shards(spark: SparkSession, kind: str, index: list[tuple[str, int]], k: int, slots: int, rule: GraphRule) -> DataFrame:
    """(id, copied, other, similarity): for each node, by its first id, up to k + 1 rows that are nearest to its direction, and their similarities.

    First come the node's own rows if it has several (copied), the smallest ids first, then those of the k nearest nodes. A task
    takes a piece of one shard's nodes to every graph, one after the other, and keeps the k nearest so far: its memory holds one graph's
    vectors and its piece, and no vector is shuffled. In its own shard a node has met its nearest when the graph was built.
    """
    blocks = [max(1, -(-slots // len(index)), -(-n // rule.piece_rows)) for _, n in index]
    pieces = [(s, n * i // m, n * (i + 1) // m) for (s, (_, n)), m in zip(enumerate(index), blocks) for i in range(m) if n * i // m < n * (i + 1) // m]
    type_ = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()

    def rep_ids(members: pa.ListArray, nodes: np.ndarray) -> np.ndarray:
        return members.values.take(pa.array(members.offsets.to_numpy()[:-1][nodes.ravel()])).to_numpy(zero_copy_only=False).reshape(nodes.shape)

    def answer(s: int, lo: int, hi: int, members: list[pa.ListArray]) -> Iterator[pa.RecordBatch]:
        mine = read_shard(index[s][0], ["unit", "near"])
        asked, node = mine["unit"][lo:hi], mine["near"][lo:hi].copy()
        sim = np.concatenate([exact_similarities(asked[i : i + 8192], mine["unit"], node[i : i + 8192]) for i in range(0, hi - lo, 8192)])
        shard = np.full(node.shape, s, np.int32)
        rep = rep_ids(members[s], np.maximum(node, 0)).copy()
        for other in [*range(s + 1, len(index)), *range(s)]:
            g = read_shard(index[other][0], ["unit", "edges", "start"])
            points, edges, starts = np.empty(g["unit"].shape, np.float32), g["edges"], np.flatnonzero(g["start"])
            np.multiply(g["unit"], 1 / BILLION, out=points, casting="unsafe")
            for i in range(0, len(asked), rule.batch):
                at = slice(i, i + rule.batch)
                ids, _ = beam_search(points, edges, (asked[at] / BILLION).astype(np.float32), starts, max(rule.beam, k), rule.width)
                got = exact_similarities(asked[at], g["unit"], ids)
                top = np.argsort(-got, axis=1, kind="stable")[:, :k]
                ids, got = np.take_along_axis(ids, top, 1), np.take_along_axis(got, top, 1)
                both = [np.concatenate(x, 1) for x in ((sim[at], got), (rep[at], rep_ids(members[other], np.maximum(ids, 0))), (shard[at], np.full_like(ids, other)), (node[at], ids))]
                top = order_by(-both[0], both[1])[:, :k]
                sim[at], rep[at], shard[at], node[at] = (np.take_along_axis(x, top, 1) for x in both)
        for i in range(0, hi - lo, 4096):
            yield rows_of(s, np.arange(lo + i, min(hi, lo + i + 4096)), shard[i : i + 4096], node[i : i + 4096], sim[i : i + 4096], members)

    def rows_of(s: int, own: np.ndarray, shard: np.ndarray, node: np.ndarray, sim: np.ndarray, members: list[pa.ListArray]) -> pa.RecordBatch:
        """The lists of the nodes `own` of shard s: their rows and those of their nearest nodes, in order."""
        several = np.diff(members[s].offsets.to_numpy())[own] > 1
        row, col = np.nonzero(np.isfinite(sim))
        asks = [(s, np.flatnonzero(several), own[several], np.zeros(several.sum(), np.int8), np.ones(several.sum()))]
        for t in np.unique(shard[row, col]):
            r, c = row[at := shard[row, col] == t], col[at]
            asks.append((t, r, node[r, c], np.ones(len(r), np.int8), sim[r, c]))
        found = []
        for t, r, p, tier, x in asks:
            off = members[t].offsets.to_numpy()
            many = off[p + 1] - off[p]
            spot = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(off[p], many)
            found.append((np.repeat(r, many), np.repeat(tier, many), np.repeat(x, many), members[t].values.take(pa.array(spot)).to_numpy(zero_copy_only=False)))
        r, tier, x, ids = (np.concatenate(y) for y in zip(*found))
        o = order_by(r, tier, -x, ids)
        r, x, ids = r[o], x[o], ids[o]
        kept = np.arange(len(r)) - np.searchsorted(r, r) <= k
        first = pa.array(np.concatenate([[0], np.cumsum(np.bincount(r[kept], minlength=len(own)))]).astype(np.int32))
        return pa.RecordBatch.from_pydict({"id": pa.array(rep_ids(members[s], own), type_), "copied": pa.array(several), "other": pa.ListArray.from_arrays(first, pa.array(ids[kept], type_)), "similarity": pa.ListArray.from_arrays(first, pa.array(x[kept]))})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = [read_shard(path, ["members"])["members"] for path, _ in index]
        for b in batches:
            for t in b["id"].to_pylist():
                yield from answer(*pieces[t], members)

    return spark.range(0, len(pieces), 1, len(pieces)).mapInArrow(search, f"id {kind}, copied boolean, other array<{kind}>, similarity array<double>")


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def nearest_vectors(df: DataFrame, id_col: str, vec_col: str, k: int = 10, dim: int = 64, rule: GraphRule = GraphRule()) -> DataFrame:
    """(id, rank, other, similarity): for each row with a usable vector, the k other rows of the largest cosine similarity.

    Vectors of one direction are one node of a graph, however many rows have them; they are each other's most similar ones, the
    smallest ids first. The other rows come by falling similarity, then id. There are as many graphs as `rule.shard_rows`
    asks for, but no more than the cluster has slots unless `rule.most_rows` demands it, so that graphs grow with the vectors
    and the work grows with vectors times slots. Every node queries every shard. The index is approximate; similarities are
    exact to nine digits. Vectors that are null, of another length, all zero, or hold a null, NaN or infinity take no
    part. Ids are unique numbers or strings. An empty table gives an empty result. `df` is read twice; its vectors are shuffled
    once and stored once, in the graphs' files in the shared folder, which go when the search is over.
    """
    spark = df.sparkSession
    src = unit_vectors(df, id_col, vec_col, dim, whole=True).withColumns({"h1": F.xxhash64("unit"), "h2": F.xxhash64(F.lit(5), "unit")})
    kind = dict(src.dtypes)["id"]
    keyed = checkpoint(src.select("id", "h1", "h2"))
    many = checkpoint(keyed.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("m")).filter("m > 1").withColumn("heavy", F.col("m") > HEAVY_COPIES))
    n = keyed.count() - (many.agg(F.sum(F.col("m") - 1)).first()[0] or 0)
    if n == 0:
        return spark.createDataFrame([], f"id {kind}, rank int, other {kind}, similarity double")
    copies = checkpoint(split_join(keyed, many.drop("m"), ["h1", "h2"], "heavy"))
    slots = spark.sparkContext.defaultParallelism
    shards = max(min(slots, -(-n // rule.shard_rows)), -(-n // rule.most_rows))
    heavy = many.filter("heavy").select("h1", "h2")
    if 0 < heavy.count() <= BROADCAST_ROWS:  # of these directions only the first k + 1 rows travel
        ranked = copies.join(F.broadcast(heavy), ["h1", "h2"]).withColumn("r", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))).filter(F.col("r") <= k + 1)
        last = ranked.groupBy("h1", "h2").agg(F.max("id").alias("last"))
        src = src.join(F.broadcast(last), ["h1", "h2"], "left").filter("last IS NULL OR id <= last").drop("last")
    folder = f"{shared_dir(spark)}/graphs-{uuid4().hex}"
    try:
        index = graph_index(src, dim, k, shards, rule, folder)
        lists = checkpoint(search_shards(spark, kind, index, k, slots, rule))
    finally:
        drop_folder(spark, folder)
    near = lists.select("id", F.arrays_zip("other", "similarity").alias("list"))
    side = lists.filter("copied").select(F.col("id").alias("rep"), F.arrays_zip("other", "similarity").alias("list")).join(many.select("rep", "heavy"), "rep")
    joined = near.unionByName(split_join(copies.filter("id <> rep").select("id", "rep"), side, ["rep"], "heavy").select("id", "list"))
    mine = F.slice(F.filter("list", lambda x: x.other != F.col("id")), 1, k)
    return joined.select("id", F.posexplode(mine).alias("p", "x")).select("id", (F.col("p") + 1).alias("rank"), F.col("x.other").alias("other"), F.col("x.similarity").alias("similarity"))
