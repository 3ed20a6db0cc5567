"""Parser strategies: a parser for each format, chosen a row, callable from SQL as a table function.

A strategy is a function of (path, doc_id, content) that gives rows of its own schema. ``parse`` is the table function over
all that are registered: its output has the columns of the strategy that is named, so it is told by a literal::

    SELECT f.doc_id, b.* FROM files f, LATERAL parse('xml', f.path, f.doc_id, f.content) b

``parsed`` chooses by each file's suffix and gives the strategies' common columns. Defined cases: a strategy
that raises gives one row whose ``problem`` says why; a name that is not registered fails when the query is analysed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..shipping import ship
from . import office, pdf, xml

Parser = Callable[[str, str, bytes], Iterator[tuple]]
#: what ``parsed`` gives for every format
COMMON = "kind string, place int, pos int, level int, text string, problem string"


@dataclass(frozen=True)
class Strategy:
    suffixes: tuple[str, ...]
    schema: str  # ends in problem string
    parse: Parser


def _xml(path: str, doc_id: str, content: bytes) -> Iterator[tuple]:
    made = xml.parse(path, doc_id, content, ("blocks",))
    if made["error"]:
        yield (None,) * 5 + (made["error"],)
    for b in made["blocks"] or []:
        yield b["block_type"], None, b["pos"], b["level"], b["text"], None


def _pdf(path: str, doc_id: str, content: bytes) -> Iterator[tuple]:
    for r in pdf.parts_of(path, doc_id, content):
        part = dict(zip(pdf.NAMES, r))
        if part["kind"] in ("run", "bookmark"):
            yield part["kind"], part["page"], part["seq"], part["depth"], part["text"], None
        elif part["kind"] == "problem":
            yield (None,) * 5 + (part["text"],)


def _slides(path: str, doc_id: str, content: bytes) -> Iterator[tuple]:
    for slide, pos, is_title, text in office.shapes_of(content):
        yield "title" if is_title else "text", slide, pos, None, text, None


def _sheets(path: str, doc_id: str, content: bytes) -> Iterator[tuple]:
    for _, sheet, row, record in office.records_of(content):
        yield "record", sheet, row, None, record, None


REGISTRY: dict[str, Strategy] = {
    "xml": Strategy(("xml",), COMMON, _xml), "pdf": Strategy(("pdf",), COMMON, _pdf), "slides": Strategy(("pptx",), COMMON, _slides), "sheets": Strategy(("xlsx",), COMMON, _sheets),
}


def register(spark: SparkSession, more: dict[str, Strategy] | None = None, name: str = "parse") -> dict[str, Strategy]:
    """Makes the table function of the shipped strategies and a user's own."""
    ship(spark)
    known = REGISTRY | (more or {})
    shapes = {k: StructType.fromDDL(s.schema) for k, s in known.items()}  # here: the function's own processes cannot parse DDL

    class Parse:
        @staticmethod
        def analyze(strategy: AnalyzeArgument, path: AnalyzeArgument, doc_id: AnalyzeArgument, content: AnalyzeArgument) -> AnalyzeResult:
            if strategy.value not in known:
                raise ValueError(f"no strategy {strategy.value}; there are {', '.join(sorted(known))}")
            return AnalyzeResult(shapes[strategy.value])

        def eval(self, strategy: str, path: str, doc_id: str, content: bytes):
            width = len(shapes[strategy])
            try:
                yield from known[strategy].parse(path or "", doc_id or "", bytes(content or b""))
            except Exception as e:  # a user's parser may raise anything: the file is told of, the run goes on
                yield (None,) * (width - 1) + (f"{type(e).__name__}: {e}",)

    spark.udtf.register(name, F.udtf(Parse))
    return known


def parsed(files: DataFrame, known: dict[str, Strategy], name: str = "parse") -> DataFrame:
    """(path, doc_id, strategy, COMMON) of files (path, doc_id, content, suffix), each by the strategy of its suffix."""
    columns = [c.split()[0] for c in COMMON.split(", ")]
    made = []
    for key, how in known.items():
        if not set(columns) <= set(StructType.fromDDL(how.schema).names):
            continue  # has no common columns: called by its name only
        mine = files.where(F.lower("suffix").isin(*how.suffixes)).alias("f")
        made.append(files.sparkSession.sql(f"SELECT f.path, f.doc_id, '{key}' AS strategy, {', '.join(f'b.{c}' for c in columns)} FROM {{f}} f, LATERAL {name}('{key}', f.path, f.doc_id, f.content) b", f=mine))
    return reduce(DataFrame.unionByName, made)
