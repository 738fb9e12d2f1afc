"""Searches until no node is new, each whole in one task: the steps are a file of the shared folder that every task reads, sources
and sets are dealt out to the tasks, and nothing between the start and the result is shuffled or stored."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame

from tessagraph.session import shared_dir

#: Distinct steps that a task may hold; more are joined.
MOST_STEPS = 2_000_000
#: Entries of a list in the result, and of all lists of one Arrow batch.
LIST, BLOCK = 8192, 1 << 18


def stored_steps(steps: DataFrame) -> tuple[str, DataFrame]:
    """The distinct steps (src, dst), written into the shared folder once: their path, and a scan of them."""
    spark = steps.sparkSession
    path = f"{shared_dir(spark)}/steps-{uuid4().hex}"
    steps.select("src", "dst").filter("src IS NOT NULL").distinct().write.parquet(path)
    return path, spark.read.parquet(path)


class Steps:
    """The steps of a file as arrays. Nodes are numbered in the order of their ids."""

    def __init__(self, path: str, starts: pa.Array) -> None:
        files, at = fs.FileSystem.from_uri(path)
        t = pq.read_table(at, filesystem=files)
        m, kind = t.num_rows, t.schema.field("src").type
        coded = pa.concat_arrays([c.cast(kind) for c in (*t["src"].chunks, *t["dst"].chunks, starts)]).dictionary_encode(null_encoding="encode")
        order = pc.array_sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        node = rank[coded.indices.to_numpy()]
        src, dst, self.starts = node[:m], node[m : 2 * m], node[2 * m :]
        self.ids, self.nodes = coded.dictionary.take(pa.array(order)), len(order)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(src, minlength=self.nodes))])
        self.dst = dst[np.argsort(src, kind="stable")]
        back = np.argsort(dst, kind="stable")
        self.src_in = src[back]  # by dst, whose runs begin at `cut`
        self.met, self.cut = np.unique(dst[back], return_index=True)

    def push(self, front: np.ndarray, values: np.ndarray, join: np.ufunc, none: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes that a step from the front meets, and the values of their predecessors there, joined; `none` where it is not met."""
        times = self.first[front + 1] - self.first[front]
        total = int(times.sum())
        if total == 0:
            return front[:0], values[:0]
        if total * 8 > len(self.dst):
            full = np.full(self.nodes, none, values.dtype)
            full[front] = values
            return self.met, join.reduceat(full[self.src_in], self.cut)
        near = self.dst[np.repeat(self.first[front] - (np.cumsum(times) - times), times) + np.arange(total)]
        order = np.argsort(near, kind="stable")
        near = near[order]
        cut = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
        return near[cut], join.reduceat(np.repeat(values, times)[order], cut)


def runs(which: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, which of each list, bounds of the lists) of rows sorted by `which`, in blocks."""
    for lo in range(0, len(which), BLOCK):
        w = which[lo : lo + BLOCK]
        cut = np.union1d(np.flatnonzero(np.diff(w)) + 1, np.arange(0, len(w), LIST))
        yield slice(lo, lo + len(w)), w[cut], np.append(cut, len(w)).astype(np.int32)


def levels_of(s: Steps, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, place in `own`, node) of up to 64 starts, different and in order, each a bit of a word; sorted by place and node."""
    front, bits = own, np.uint64(1) << np.arange(len(own), dtype=np.uint64)
    seen = np.zeros(s.nodes, np.uint64)
    for depth in count():
        bits = bits & ~seen[front]
        front, bits = front[bits != 0], bits[bits != 0]
        if not len(front):
            return
        seen[front] |= bits
        of = np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, at = np.nonzero(np.ascontiguousarray(of.T))
        yield depth, which, front[at]
        front, bits = s.push(front, bits, np.bitwise_or, 0)


def nearest_of(s: Steps, anchors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, nodes, the smallest of their nearest anchors)."""
    front = label = np.unique(anchors)
    seen = np.zeros(s.nodes, bool)
    for depth in count():
        new = ~seen[front] & (label < s.nodes)
        front, label = front[new], label[new]
        if not len(front):
            return
        seen[front] = True
        yield depth, front, label
        # A nearest anchor of a node is a nearest one of a node before it, so that the smallest is among theirs.
        front, label = s.push(front, label, np.minimum, s.nodes)


def reach_in_tasks(path: str, sources: DataFrame) -> DataFrame:
    """(source, depth, nodes): for each source, once, lists of the nodes at each least distance over the stored steps."""
    kind = dict(sources.dtypes)["source"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = [b["source"] for b in batches if b.num_rows]
        if not starts:
            return
        s = Steps(path, pa.concat_arrays(starts))
        starts = np.unique(s.starts)
        for lo in range(0, len(starts), 64):
            own = starts[lo : lo + 64]
            for depth, which, node in levels_of(s, own):
                for rows, w, bounds in runs(which):
                    nodes = pa.ListArray.from_arrays(pa.array(bounds), s.ids.take(pa.array(node[rows])))
                    yield pa.RecordBatch.from_pydict({"source": s.ids.take(pa.array(own[w])), "depth": pa.array(np.full(len(w), depth, np.int32)), "nodes": nodes})

    slots = sources.sparkSession.sparkContext.defaultParallelism
    return sources.select("source").repartition(2 * slots, "source").mapInArrow(run, f"source {kind}, depth int, nodes array<{kind}>")


def nearest_in_tasks(path: str, anchors: DataFrame) -> DataFrame:
    """(set, depth, near): for each set of anchors (set, anchor), lists of (node, anchor) by least distance over the stored steps."""
    kinds = dict(anchors.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [b for b in batches if b.num_rows]
        if not given:
            return
        s = Steps(path, pa.concat_arrays([b["anchor"] for b in given]))
        sets = pa.concat_arrays([b["set"] for b in given]).dictionary_encode(null_encoding="encode")
        code = sets.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
            for depth, node, anchor in nearest_of(s, s.starts[own]):
                for rows, w, bounds in runs(np.full(len(node), code[own[0]])):
                    near = pa.StructArray.from_arrays([s.ids.take(pa.array(node[rows])), s.ids.take(pa.array(anchor[rows]))], ["node", "anchor"])
                    yield pa.RecordBatch.from_pydict({"set": sets.dictionary.take(pa.array(w)), "depth": pa.array(np.full(len(w), depth, np.int32)), "near": pa.ListArray.from_arrays(pa.array(bounds), near)})

    slots = anchors.sparkSession.sparkContext.defaultParallelism
    return anchors.select("set", "anchor").repartition(2 * slots, "set").mapInArrow(run, f"set {kinds['set']}, depth int, near array<struct<node:{kinds['anchor']},anchor:{kinds['anchor']}>>")
