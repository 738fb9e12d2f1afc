"""Cutting long texts at natural boundaries with overlap, by pointer doubling over tables of boundaries."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessagraph.llm.arrays import bound_batches, by_chunks, code_points, kinds

#: After these a sentence or clause ends; whitespace is a boundary too.
STOPS = ".,;:!?。，；：！？、"
#: Boundaries of the first choice: sentence ends and line breaks.
STRONG = "。！？!?；;\n\r  \x85\x0b\x0c"


@dataclass(frozen=True)
class PieceRule:
    """At most `limit` code points a piece, `overlap` of them from the end of the piece before.

    Each cut goes to the farthest boundary in reach. With `fill`, another mode, a sentence or line end that fills at least that
    part of the limit is preferred to a later blank or comma.
    """

    limit: int = 500
    overlap: int = 30
    fill: float | None = None


def strong_ends(codes: np.ndarray, can: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of the boundaries `can` are ends of sentences, lines or texts."""
    table = np.zeros(0x110000, bool)
    table[[ord(c) for c in STRONG]] = True
    strong = np.zeros(len(can), bool)
    strong[1:] = table[codes] | ((codes == 46) & np.append(kinds()[codes[1:]] != 1, True))  # a point before a letter or digit ends no sentence
    strong &= can
    strong[end] = True
    return strong


def cut_table(texts: list[str], rule: PieceRule) -> dict[str, np.ndarray]:
    """All pieces of `texts`: doc (index), piece_no, start, stop, hard (its end is no natural boundary).

    A state is the end e of a piece; the next piece begins at e - overlap, so it may end at e + limit - overlap at most. Every
    natural boundary is joined to its farthest legal successor by one sorted search. If none is in reach but the next one
    lies within `limit` of e, the overlap shrinks; beyond, the cut is hard. Hard cuts inside a stretch
    without boundaries are states too. The table of successors is then squared again and again, and the cuts that are
    reached from the texts' beginnings are marked, twice as many in each round: log2(pieces) rounds for all texts.
    """
    step, limit = rule.limit - rule.overlap, rule.limit
    codes, starts = code_points(texts, 1)
    n, size = len(texts), len(codes)
    begin, end = starts[:-1], starts[1:] - 1
    stops = np.zeros(0x110000, np.uint8)
    stops[[ord(c) for c in STOPS]] = 1
    natural = (kinds()[codes] == 2) | (stops[codes] == 1)
    natural[end] = False
    can = np.zeros(size + 1, bool)
    can[:-1] |= natural
    can[1:] |= natural
    can[begin] = False
    can[end] = True
    full = end > begin
    pos = np.flatnonzero(can)
    # Hard cuts: step by step through each stretch of more than `limit` without a boundary; the first piece has no overlap.
    left = np.concatenate([pos, begin[full]])
    first = np.concatenate([np.full(len(pos), step), np.full(int(full.sum()), limit)])
    right = np.append(pos, size + 1)[np.searchsorted(pos, left, "right")]
    right[np.isin(left, end[full])] = 0
    wide = right - left > limit
    left, right, first = left[wide], right[wide], first[wide]
    count = np.maximum(0, (right - left - first - 1) // step + 1)
    k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    hard_at = np.repeat(left + first, count) + k * step
    nodes = np.unique(np.concatenate([pos, hard_at, begin[full]]))
    is_begin = np.zeros(size + 1, bool)
    is_begin[begin[full]] = True
    of = np.searchsorted(starts, nodes, "right") - 1
    at_begin = is_begin[nodes]
    reach = nodes + np.where(at_begin, limit, step)
    far = pos[np.maximum(np.searchsorted(pos, reach, "right") - 1, 0)] if len(pos) else nodes
    after = np.searchsorted(pos, nodes, "right")
    nxt = pos[np.minimum(after, max(len(pos) - 1, 0))] if len(pos) else nodes
    succ = np.where(far > nodes, far, np.where(nxt - nodes <= limit, nxt, reach))
    if rule.fill is not None:
        strong = np.flatnonzero(strong_ends(codes, can, end))
        best = strong[np.maximum(np.searchsorted(strong, reach, "right") - 1, 0)] if len(strong) else nodes
        succ = np.where((best >= nodes + int(rule.fill * limit)) & (best <= reach), best, succ)
    succ = np.where(reach >= end[of], end[of], succ)
    succ = np.minimum(succ, end[of])
    to = np.searchsorted(nodes, succ)
    to[nodes == end[of]] = np.flatnonzero(nodes == end[of])
    once = to
    marked = at_begin.copy()
    while True:
        marked[to[np.flatnonzero(marked)]] = True
        squared = to[to]
        if np.array_equal(squared, to):
            break
        to = squared
    cut = np.flatnonzero(marked & (nodes != end[of]))
    e = nodes[once[cut]]
    s = np.where(at_begin[cut], nodes[cut], np.maximum(np.maximum(nodes[cut] - rule.overlap, e - limit), begin[of[cut]]))
    doc = of[cut]
    run = np.arange(len(doc)) - np.searchsorted(doc, doc)
    return {"doc": doc, "piece_no": run, "start": s - begin[doc], "stop": e - begin[doc], "hard": ~can[e]}


def cut_pieces(df: DataFrame, id_col: str, text_col: str, rule: PieceRule = PieceRule(), with_text: bool = True) -> DataFrame:
    """(id, piece_no, start, stop, hard[, piece]): every text cut into pieces of at most `rule.limit` code points.

    start and stop count code points from 0, stop is exclusive; hard marks a piece whose end is no natural boundary. A text
    within the limit is one piece; a null or empty text has none. Rows with one id are cut each for itself. Texts
    don't leave their row's partition: nothing is shuffled. Other columns are dropped.
    """
    src = bound_batches(df.select(df[id_col].alias("id"), df[text_col].alias("text")))
    kind = dict(src.dtypes)["id"]

    def cut(ids: list, texts: list[str]) -> pa.RecordBatch:
        t = cut_table(texts, rule)
        doc = t["doc"].tolist()
        cols = {"id": pa.array(ids).take(pa.array(t["doc"])) if doc else pa.array([], pa.array(ids).type), "piece_no": pa.array(t["piece_no"].astype(np.int32)), "start": pa.array(t["start"]), "stop": pa.array(t["stop"]), "hard": pa.array(t["hard"])}
        if with_text:
            cols["piece"] = pa.array([texts[d][a:b] for d, a, b in zip(doc, t["start"].tolist(), t["stop"].tolist())], pa.string())
        return pa.RecordBatch.from_pydict(cols)

    return src.mapInArrow(by_chunks(cut, "id", "text"), f"id {kind}, piece_no int, start bigint, stop bigint, hard boolean" + ", piece string" * with_text)
