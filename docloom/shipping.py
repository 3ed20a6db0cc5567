"""Sends this package to the executors, so that Python functions find it there."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once per SparkContext; the archive is served by the driver as any job file is."""
    sc = spark.sparkContext
    if getattr(sc, "_docloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    where = Path(tempfile.mkdtemp(prefix="docloom-code-")) / "docloom_code.zip"
    with zipfile.ZipFile(where, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, os.path.join("docloom", p.relative_to(root)))
    sc.addPyFile(str(where))
    sc._docloom_shipped = True
