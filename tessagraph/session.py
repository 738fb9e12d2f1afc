"""Session helpers shared by every operator: table access, checkpoints, size-checked broadcasts."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: `spark.checkpoint.dir` of the session where it is set.

    Where it is unset, local mode gets a fresh temporary folder and a cluster a folder below the SQL warehouse, which
    executors share.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get()
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="tessagraph-")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder in which this application keeps checkpoints and stored tables."""
    sc = spark.sparkContext._jsc.sc()
    if not sc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return sc.getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` with a reliable checkpoint that outlives any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def version(*scans: DataFrame) -> str:
    """A name for the present state of file scans: it changes with their files, sizes and times. Reads no column."""
    parts = []
    for s in scans:
        seen = s.select(F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("h"))
        r = seen.groupBy("h").agg(F.count("*").alias("n")).agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("h"), F.sum("n").alias("n")).first()
        parts.append(f"{r.h}_{r.n}")
    return "-".join(parts)


def is_stored(spark: SparkSession, name: str) -> bool:
    """Whether this application has stored the table `name`."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tables/{name}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def stored(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table `name` of this application: made and written into the shared folder at its first use, read from there afterwards."""
    path = f"{shared_dir(spark)}/tables/{name}"
    if not is_stored(spark, name):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A file scan with fewer partitions than the session has cores, dealt out to all of them; any other as it is.

    For work on rows that costs far more than moving them; a large table has more partitions anyway.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


#: Rows of a side that may be broadcast after its count was checked; beyond it, joins shuffle.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `limit` rows; reads no more than limit + 1 of them."""
    return df.limit(limit + 1).count() <= limit


def split_join(big: DataFrame, side: DataFrame, on: list[str], heavy: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join of `big` with `side` (unique on `on`), whose boolean column `heavy` marks keys with very many rows in `big`.

    Heavy keys are broadcast if there are at most `limit` of them (their number is counted first), so that their rows stay
    where they are; the others shuffle. Without heavy keys, or with too many, it is one shuffle join, which adaptive
    execution may split. `side` should be checkpointed: it is read up to three times.
    """
    hot, cold = side.filter(F.col(heavy)).drop(heavy), side.filter(~F.col(heavy)).drop(heavy)
    n = hot.limit(limit + 1).count()
    if n == 0 or n > limit:
        return big.join(side.drop(heavy), on)
    keys = F.broadcast(hot.select(*on))
    return big.join(F.broadcast(hot), on).unionByName(big.join(keys, on, "left_anti").join(cold, on))
