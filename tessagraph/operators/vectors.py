"""Nearest neighbours of given query vectors: exact scans in blocks, an index of cells, and a store on a parquet path."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessagraph.errors import GraphError
from tessagraph.session import checkpoint


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2sq(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""
    return _sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))))


def cosine_similarity(a: Column, b: Column) -> Column:
    """0 where a vector is all zero."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def distance(a: Column, b: Column, metric: str) -> Column:
    """'l2sq', or 'cosine' as 1 - cosine."""
    return l2sq(a, b) if metric == "l2sq" else 1 - cosine_similarity(a, b)


def search(df: DataFrame, id_col: str, vec_col: str, query: Sequence[float], k: int, threshold: float | None = None, metric: str = "l2sq") -> DataFrame:
    """(id, distance): the k nearest rows of one query by distance and id, those below the threshold; planned as a top-k."""
    q = F.array(*[F.lit(float(x)) for x in query])
    top = df.filter(F.size(vec_col) == len(query)).select(F.col(id_col).alias("id"), distance(F.col(vec_col), q, metric).alias("distance")).orderBy("distance", "id").limit(max(0, k))
    return top if threshold is None else top.filter(F.col("distance") < threshold)


def _matrix(c: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = c.to_pylist()
    return np.array(rows, np.float64).reshape(len(rows), -1)


def _block_top(metric: str, k: int):
    def run(data: pa.Table, asked: pa.Table) -> pa.Table:
        if not data.num_rows or not asked.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        ids, qid = data["id"].to_numpy(), asked["query"].to_numpy()
        x, q = _matrix(data["vec"]), _matrix(asked["vec"])
        out = []
        for i in range(0, len(q), 256):
            part = q[i : i + 256]
            if metric == "l2sq":
                d = np.maximum(0, (part * part).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * part @ x.T)
            else:
                d = 1 - (part @ x.T) / np.maximum(np.linalg.norm(part, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :], 1e-300)
            m = min(k, len(ids))
            near = np.argpartition(d, m - 1, axis=1)[:, :m]
            # Ties at the edge: all rows at the k-th distance stay candidates.
            edge = np.take_along_axis(d, near, 1).max(1)
            r, c = np.nonzero(d <= edge[:, None] + 1e-12)
            out.append((qid[i + r], ids[c], d[r, c]))
        cols = [np.concatenate(z) for z in zip(*out)]
        return pa.table({"query": pa.array(cols[0]), "id": pa.array(cols[1]), "distance": pa.array(cols[2])})

    return run


def search_many(df: DataFrame, id_col: str, vec_col: str, queries: DataFrame, query_col: str, k: int, threshold: float | None = None, metric: str = "l2sq", rows_per_block: int = 50_000, queries_per_block: int = 2_000) -> DataFrame:
    """(query, id, distance): the k nearest rows of each query, exactly, by matrix products of blocks.

    Data and queries are cut into blocks by hash, each pair of blocks is one group, and only each block's top k leaves it. Ids
    and queries are numbers. Vectors need one length; others are left out by the caller.
    """
    data = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec"))
    asked = queries.select(F.col(query_col).cast("bigint").alias("query"), F.col(vec_col).alias("vec"))
    b, q = max(1, -(-data.count() // rows_per_block)), max(1, -(-asked.count() // queries_per_block))
    d = data.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(b)).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q - 1))))
    a = asked.withColumn("q", F.pmod(F.xxhash64("query"), F.lit(q)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(b - 1))))
    top = d.groupBy("b", "q").cogroup(a.groupBy("b", "q")).applyInArrow(_block_top(metric, k), "query bigint, id bigint, distance double")
    return _merge(top, k, threshold)


def _merge(top: DataFrame, k: int, threshold: float | None) -> DataFrame:
    out = top.withColumn("distance", F.round("distance", 12)).withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))).filter(F.col("r") <= k).drop("r")
    return out if threshold is None else out.filter(F.col("distance") < threshold)


def fit_cells(df: DataFrame, vec_col: str, cells: int = 128, sample: int = 20_000, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Centres of at most `cells` cells by k-means on at most `sample` rows, the smallest by hash (a bounded sample)."""
    rows = df.select(F.col(vec_col).alias("v")).orderBy(F.xxhash64("v")).limit(sample).collect()
    x = np.array([r.v for r in rows], np.float64)
    if not len(x):
        return np.zeros((0, 0))
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(rounds):
        own = ((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :]).argmin(1)
        n = np.bincount(own, minlength=len(c))
        c = np.where(n[:, None] > 0, np.stack([np.bincount(own, x[:, j], len(c)) for j in range(x.shape[1])], 1) / np.maximum(n, 1)[:, None], c)
    return c


def with_cells(df: DataFrame, vec_col: str, centres: np.ndarray, probes: int) -> DataFrame:
    """`df` with `cells`: the nearest centres of each vector."""

    @F.pandas_udf("array<int>")
    def near(v):
        x = np.array(v.tolist(), np.float64)
        d = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]
        return pd.Series(list(np.argsort(d, axis=1)[:, :probes]))

    return df.withColumn("cells", near(F.col(vec_col)))


def search_cells(df: DataFrame, id_col: str, vec_col: str, queries: DataFrame, query_col: str, k: int, centres: np.ndarray, probes: int = 10, metric: str = "l2sq", rows_per_block: int = 50_000) -> DataFrame:
    """(query, id, distance): as `search_many`, but each query meets the rows of its `probes` nearest cells only (approximate).

    Cells of more than rows_per_block rows are cut into parts by hash.
    """
    data = with_cells(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec")), "vec", centres, 1).select("id", "vec", F.col("cells")[0].alias("cell"))
    sizes = checkpoint(data.groupBy("cell").agg(F.ceil(F.count("*") / rows_per_block).cast("int").alias("parts")))  # one row per cell
    d = data.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
    a = with_cells(queries.select(F.col(query_col).cast("bigint").alias("query"), F.col(vec_col).alias("vec")), "vec", centres, probes).select("query", "vec", F.explode("cells").alias("cell"))
    a = a.join(F.broadcast(sizes), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    top = d.groupBy("cell", "part").cogroup(a.groupBy("cell", "part")).applyInArrow(_block_top(metric, k), "query bigint, id bigint, distance double")
    return _merge(top, k, None)


def refresh(past: DataFrame, present: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(removed, added) keys between two states of an index."""
    a, b = past.select(key).distinct(), present.select(key).distinct()
    return a.join(b, key, "left_anti"), b.join(a, key, "left_anti")


@dataclass(frozen=True)
class VectorIndex:
    """A store of (id bigint, vec, payload) on a parquet path.

    write() makes a new version directory; add() and remove() write what changes beside the last version, in numbered deltas, and
    read() puts them together; compact() turns them into a version of its own.
    """

    spark: SparkSession
    path: str
    metric: str = "l2sq"

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self) -> list[str]:
        """The directories that were written to their end."""
        fs, p = self._fs()
        own = self.spark._jvm.org.apache.hadoop.fs.Path
        return [x.getPath().getName() for x in fs.listStatus(p) if fs.exists(own(x.getPath(), "_SUCCESS"))] if fs.exists(p) else []

    def versions(self) -> list[int]:
        return sorted(int(n[1:]) for n in self._names() if re.fullmatch(r"v\d+", n))

    def _deltas(self) -> list[tuple[int, str]]:
        """(number, kind 'add' or 'gone') of the last version's changes, in order."""
        found = [re.fullmatch(rf"v{self.versions()[-1]}_(\d+)(add|gone)", n) for n in self._names()]
        return sorted((int(m[1]), m[2]) for m in found if m)

    def _change(self, df: DataFrame, kind: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/v{self.versions()[-1]}_{len(self._deltas()) + 1}{kind}")

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        if not self.exists():
            raise GraphError(f"no index at {self.path}")
        own, deltas = f"{self.path}/v{self.versions()[-1]}", self._deltas()
        rows = self.spark.read.parquet(own)
        if not deltas:
            return rows
        rows = rows.withColumn("_m", F.lit(0))
        gone = None
        for m, kind in deltas:
            part = self.spark.read.parquet(f"{own}_{m}{kind}").withColumn("_m", F.lit(m))
            if kind == "add":
                rows = rows.unionByName(part, allowMissingColumns=True)
            else:
                gone = part if gone is None else gone.unionByName(part)
        if gone is not None:  # a removal takes what was there before it
            last = gone.groupBy("payload").agg(F.max("_m").alias("_g"))
            rows = rows.join(last, "payload", "left").filter(F.col("_g").isNull() | (F.col("_m") > F.col("_g"))).drop("_g")
        return rows.drop("_m")

    def write(self, df: DataFrame) -> VectorIndex:
        df.write.mode("overwrite").parquet(f"{self.path}/v{(self.versions() or [0])[-1] + 1}")
        return self

    def add(self, df: DataFrame) -> VectorIndex:
        """Appends rows; vectors of another length than the index replace it, as a model with another dimension does."""
        if not self.exists():
            return self.write(df)
        own, new = self.info().first(), df.agg(F.max(F.size("vec"))).first()[0]
        if own.rows and own.dim != new:
            return self.write(df)
        self._change(df, "add")
        return self

    def remove(self, payloads: DataFrame) -> int:
        """Removes rows by payload (payload); the number removed."""
        keys = payloads.select("payload").distinct()
        n = self.read().join(keys, "payload", "left_semi").count()
        if n:
            self._change(keys, "gone")
        return n

    def compact(self) -> VectorIndex:
        """One version of what the last version and its changes hold."""
        return self.write(self.read())

    def info(self) -> DataFrame:
        return self.read().agg(F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("dim"), F.count("*").alias("rows"), F.count_distinct("payload").alias("payloads"))

    def search(self, query: Sequence[float], k: int = 3, threshold: float | None = 2.0) -> DataFrame:
        return search(self.read(), "payload", "vec", query, k, threshold, self.metric)

    def clean(self) -> None:
        fs, p = self._fs()
        fs.delete(p, True)


def index_path(root: str, graph: str, kind: str, space: str | None = None) -> str:
    """Where an index is kept: root/[space_]graph/kind, for kinds such as 'chunks', 'ids' and 'examples'."""
    return f"{root.rstrip('/')}/{f'{space}_{graph}' if space else graph}/{kind}"


#: What an index measures, by the name of its backend; the default is 'flat'.
BACKENDS = {"flat": "l2sq", "inner": "cosine", "cosine": "cosine"}


def index_of(spark: SparkSession, path: str, backend: str = "flat") -> VectorIndex:
    """An index by the name of its backend; unknown names are errors."""
    if backend not in BACKENDS:
        raise GraphError(f"no backend {backend!r}, but {', '.join(BACKENDS)}")
    return VectorIndex(spark, path, BACKENDS[backend])
