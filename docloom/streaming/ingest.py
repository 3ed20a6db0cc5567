"""Incremental ingestion: new files are a stream, each micro-batch is the batch plan and an upsert.

A replayed batch writes the same keys with the same content (ids are digests), so the store is the same after
a restart. Files that were seen before are left out by the source's own log under the checkpoint. Content that was seen
before under another path is left out by state: a digest is remembered from its arrival on for ``remember``, in the state
store of the checkpoint, and forgotten then, so that state is bounded by what arrives in that time. Arrival is the clock's,
not the file's own date, so a file that is old when it comes is not late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import stable_id
from ..operators.store import Store
from ..plans.pipeline import ingest

BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def stream(spark: SparkSession, folder: str, glob: str = "*.{xml,XML}", most_files: int = 1000) -> DataFrame:
    files = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", glob).option("maxFilesPerTrigger", str(most_files)).load(folder)
    return files.select("path", "modificationTime", stable_id("DOC_", F.col("path"), F.sha2("content", 256)).alias("doc_id"), "content")


def distinct_content(files: DataFrame, remember: str = "30 days", arrived: Column | None = None) -> DataFrame:
    """The stream without files whose content came before, within ``remember``."""
    told = files.withColumn("arrived", F.current_timestamp() if arrived is None else arrived).withColumn("digest", F.sha2("content", 256))
    return told.withWatermark("arrived", remember).dropDuplicatesWithinWatermark(["digest"]).drop("arrived", "digest")


def start(spark: SparkSession, folder: str, store: Store, checkpoint: str, now: Callable[[], str], once: bool = True, remember: str | None = None):
    """A streaming query that ingests new files into the store; ``once`` stops when none is left. With ``remember``
    ("30 days") content is stored once, under whatever path it came first."""

    def batch(rows: DataFrame, _: int) -> None:
        if not rows.isEmpty():
            ingest(spark, rows.dropDuplicates(["doc_id"]), now(), target=store)

    files = stream(spark, folder)
    writer = (distinct_content(files, remember) if remember else files).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
