"""Table sources, and the spreading of small ones."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def spread(rows: DataFrame, key: str | None = None) -> DataFrame:
    """rows over all cores where the scan has fewer splits than there are: one small file is one split, and
    what follows is heavy per row. That moves the table once, whatever its size, but a table of more splits than cores is
    left alone. Rows are dealt in turn, not by ``key``, so a repeated key is no heavy task."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


#: parts a core that rows are dealt into, so that a task is short beside the whole
PARTS_A_CORE = 8


def dealt(rows: DataFrame) -> DataFrame:
    """rows dealt in turn into several parts a core, for what follows that is heavy per row. Nothing is run to find out how many
    parts there are, as ``spread`` does, which would run every shuffle before it. Deal a table's own columns, not what is made of them."""
    return rows.repartition(PARTS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where that is unset and Spark
    runs in one process, as in tests, a temporary folder of this driver, remembered on the SparkContext."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not getattr(sc, "_docloom_shared", None):
        sc._docloom_shared = "file://" + tempfile.mkdtemp(prefix="docloom-shared-")
    return sc._docloom_shared


def new_path(spark: SparkSession, label: str) -> str:
    """A folder of this application's own in the shared one."""
    return f"{shared_dir(spark)}/docloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
