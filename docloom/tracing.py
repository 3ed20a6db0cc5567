"""JSON-line logs with a trace and a span id, and run counters as observed metrics."""

from __future__ import annotations

import contextlib
import contextvars
import json
import logging
import secrets

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_trace: contextvars.ContextVar[str] = contextvars.ContextVar("trace", default="")
_span: contextvars.ContextVar[str] = contextvars.ContextVar("span", default="")


@contextlib.contextmanager
def trace():
    """A trace with a span in it: 32 and 16 hex digits, as trace contexts have them."""
    tokens = _trace.set(secrets.token_hex(16)), _span.set(secrets.token_hex(8))
    try:
        yield _trace.get(), _span.get()
    finally:
        _trace.reset(tokens[0])
        _span.reset(tokens[1])


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        line = {"time": self.formatTime(record), "level": record.levelname, "logger": record.name, "message": record.getMessage(), "trace_id": _trace.get(), "span_id": _span.get()}
        if record.exc_info:
            line["error"] = self.formatException(record.exc_info)
        return json.dumps(line, ensure_ascii=False)


def counted(rows: DataFrame, name: str, failed: str = "error", *more: Column) -> tuple[DataFrame, Observation]:
    """rows with counters (total, failed and ``more``) that fill as an action reads them, without a pass of their own."""
    seen = Observation(name)
    return rows.observe(seen, F.count("*").alias("total"), F.count_if(F.col(failed).isNotNull()).alias("failed"), *more), seen


class Counters:
    """The counters of a run's stages, gathered from the queries that did the work; ``rows`` has them as a table, and
    every stage is a line in the log as it ends."""

    def __init__(self, spark: SparkSession, run: str) -> None:
        self.spark, self.run, self.seen, self.told = spark, run, {}, set()

    def watch(self, stage: str, rows: DataFrame, failed: str = "error", added: str | None = None) -> DataFrame:
        """``rows``, counted under ``stage`` as soon as an action has read them: total, failed, succeeded and, where
        ``added`` names a column of numbers, its sum over those that did not fail."""
        fine = F.col(failed).isNull()
        more = [F.count_if(fine).alias("succeeded")]
        if added:
            more.append(F.coalesce(F.sum(F.when(fine, F.col(added).cast("long"))), F.lit(0)).alias("added"))
        out, self.seen[stage] = counted(rows, f"{self.run}-{stage}-{len(self.seen)}", failed, *more)
        return out

    def rows(self) -> DataFrame:
        """(run, stage, counter, n); stages that no action has read would be waited for, so ask afterwards."""
        made = []
        for stage, seen in self.seen.items():
            held = seen.get
            made += [(self.run, stage, k, int(v)) for k, v in held.items()]
            if stage not in self.told:
                self.told.add(stage)
                logging.getLogger("docloom").info("%s %s", stage, json.dumps(held))
        return self.spark.createDataFrame(made, "run string, stage string, counter string, n long")
