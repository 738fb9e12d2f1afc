"""Texts of a batch as one array of code points, and chunks of rows of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Code points handled at once; a longer text is handled alone.
CHUNK_CHARS = 1_000_000


def bound_batches(df: DataFrame) -> DataFrame:
    """`df` with Arrow batches of the session bounded by bytes where the session leaves them unbounded, for very long texts."""
    conf = df.sparkSession.conf
    try:
        if int(conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) > 1 << 26:
            conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 24))
    except Exception:  # noqa: BLE001  # an older session has no such setting
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return df


@cache
def kinds() -> np.ndarray:
    """For each code point: 1 letter or digit, 2 whitespace, else 0."""
    t = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        ch = chr(i)
        if ch.isalnum():
            t[i] = 1
        elif ch.isspace():
            t[i] = 2
    return t


def code_points(texts: list[str], gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(codes, starts): all texts one after another with `gap` zeros behind each; starts has one entry more than texts."""
    pad = "\0" * gap
    raw = "".join([t + pad for t in texts]).encode("utf-32-le", "surrogatepass")
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + gap, out=starts[1:])
    return np.frombuffer(raw, "<u4"), starts


def by_chunks(f: Callable[[list, list[str]], pa.RecordBatch], id_col: str, text_col: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives `f` ids and texts (null as '') of at most CHUNK_CHARS code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(id_col).to_pylist(), b.column(text_col).to_pylist()
            own, part, size = [], [], 0
            for i, t in zip(ids, texts):
                t = t or ""
                if part and size + len(t) > CHUNK_CHARS:
                    yield f(own, part)
                    own, part, size = [], [], 0
                own.append(i)
                part.append(t)
                size += len(t)
            if part:
                yield f(own, part)

    return run
