"""Shared pieces: shared-folder tables, code shipping, Arrow passes, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from ..sources.tables import load, new_path, shared_dir, spread

__all__ = ["UID", "WORD_RE", "arrow_map", "chunks", "components", "cut", "discard", "grouped_runs", "load", "new_path", "own_dir", "shared_dir", "ship", "slices", "spread", "sweep", "trim"]

WORD_RE = r"[^\x20\x09-\x0D]+"
#: a row's number within a table on disk, under a name that no input column has
UID = "_docloom_uid"


def own_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/docloom/{spark.sparkContext.applicationId}"


def sweep(spark: SparkSession) -> None:
    """Deletes the tables that this application's operators wrote in the shared folder. Results that are
    still read from them (every lazily returned DataFrame) must be written elsewhere before."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Spark removes the shuffle files of a query when it has ended
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it again: cuts the lineage with files that
    outlive any executor, unlike a local checkpoint. Once they are there, the query's shuffle files have no more use."""
    spark = df.sparkSession
    path, before = new_path(spark, label), spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._docloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``cut`` wrote, once all that is made of them is written too."""
    for t in tables:
        path = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(t._docloom_path)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def arrow_map(df: DataFrame, fn: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that no slice holds much more than ``max_bytes`` of ``column`` (one row may
    by itself), which bounds what Python holds decoded at a time."""
    size = max(1, batch.column(column).nbytes // max(1, batch.num_rows))
    step = max(1, max_bytes // size)
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def chunks(batches: Iterable[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.Table]:
    """The rows as tables of about ``size`` bytes of ``column``; a larger row is one by itself."""
    held, n = [], 0
    for b in batches:
        for s in slices(b, column, size // 8):
            held.append(s)
            n += s.column(column).nbytes
            if n >= size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def trim() -> None:
    """Gives freed memory back to the system: Python workers stay alive between tasks."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def grouped_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Contiguous rows with equal ``keys`` of a sorted partition: tables of whole runs, with their starts and
    ends. A run over many batches is put together once."""

    def changes(b: pa.RecordBatch | pa.Table) -> np.ndarray:
        change = np.zeros(b.num_rows, dtype=bool)
        for k in keys:
            a = b.column(k).to_numpy()
            change[1:] |= a[1:] != a[:-1]
        return np.flatnonzero(change)

    def whole(parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts)
        starts = np.concatenate(([0], changes(table)))
        return table, starts, np.append(starts[1:], table.num_rows)

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        at = changes(b)
        joins = bool(held) and all(held[-1].column(k)[-1] == b.column(k)[0] for k in keys)
        if held and not joins:
            yield whole(held)
            held = []
        if len(at):
            yield whole([*held, b.slice(0, at[-1])])
            held = [b.slice(at[-1])]
        else:
            held.append(b)
    if held:
        yield whole(held)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) by alternating large and small stars.

    Returns (node, root) for every node but the roots; root is the least node of the component.
    Each round is a few shuffled joins and partial aggregates and ends in a written table; nothing
    but a count and two sums of 64-bit digests comes to the driver. A hot centre is split by AQE's skew join.
    """

    def stamp(df):
        digest = lambda seed: F.sum(F.xxhash64("u", "v", F.lit(seed)).cast("decimal(20,0)"))
        return tuple(df.agg(F.count("*"), digest(1), digest(2)).first())

    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = cut(e, "edges")
    seen = stamp(e)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "star")
        now = stamp(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
