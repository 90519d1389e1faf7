"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codexlake.session import ship


#: Applications whose files go when the driver ends.
_CLEARED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only Spark opens the path, so any store will do."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def on_workers(df: DataFrame) -> DataFrame:
    """``df``, after the package has gone to the executors.

    A worker function takes its list of files when it is made, so this comes first.
    """
    ship(df.sparkSession)
    return df


def spread(df: DataFrame, most: int = 256 << 20) -> DataFrame:
    """A small table over all cores, where its files alone give fewer tasks.

    One file of one row group is one task, however many cores wait.  A table of
    more than ``most`` bytes is never dealt anew.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= most and df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it on a cluster.  Where that is unset (tests,
    one machine) a folder under the warehouse is used; on a cluster only if the
    warehouse lies in a store.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_codexlake_checkpoints"
        if not spark.sparkContext.master.startswith("local") and re.match(r"/|file:", base):
            raise ValueError("set spark.checkpoint.dir: the warehouse is a folder of one machine")
    return f"{base.rstrip('/')}/codexlake-{spark.sparkContext.applicationId}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This ends the lineage: a lost executor costs a reread, never the Python work
    that made the rows.  ``discard`` removes the files of what is read no more, ``release``
    those of a session, which happens at the driver's end as well.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if spark.sparkContext.applicationId not in _CLEARED:
        _CLEARED.add(spark.sparkContext.applicationId)
        atexit.register(_clear, spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def _clear(spark: SparkSession) -> None:
    """At the driver's end: what its application has cut is of no use to any other."""
    if spark.sparkContext._jsc is not None and SparkContext._active_spark_context is not None:
        release(spark)


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that ``cut`` gave, once nothing reads them any more."""
    for df in frames:
        if path := getattr(df, "_cut_path", None):
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Delete every file that ``cut`` wrote in this session."""
    _delete(spark, shared_dir(spark))


def tidy() -> None:
    """Hand back to the machine what a task has freed: workers live on, and the next stage needs room."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library: it keeps what it keeps


def bytes_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Strings of a column; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def held_out(id_col: str, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def hash_sample(df: DataFrame, key: list[str], limit: int, place: Column | None = None) -> DataFrame:
    """The ``limit`` rows of least hash of ``key`` (or of a number that is a hash), the same each time.

    A hash threshold from the number of rows comes first, so that no task gathers
    more than about the sample, whatever the number of partitions.
    """
    n = df.count()
    place, full = (F.pmod(F.xxhash64(*key), F.lit(1 << 30)), 1 << 30) if place is None else (place, 1 << 62)
    if n > 2 * limit:
        df = df.where(place < int(full * (1.3 * limit + 100) / n))
    return df.orderBy(place, *key).limit(limit)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Newton's method for a ridge-penalised logistic regression; last weight: bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = l2 * len(x) * np.eye(len(w))
    ridge[-1, -1] = 1e-9
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w
