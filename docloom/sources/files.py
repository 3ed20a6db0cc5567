"""File sources: document files by glob, layout tables, presentation of external readers as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import stable_id

GLOB = "*.{pdf,PDF,xml,XML}"


def scan(spark: SparkSession, folder: str, glob: str = GLOB, recursive: bool = False, ordered: bool = False) -> DataFrame:
    """path, doc_id (of path and content), suffix, content of the matching files; by path if ``ordered``, which
    is a sort of all and not paid for unless asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    suffix = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    found = files.select("path", stable_id("DOC_", F.col("path"), F.sha2("content", 256)).alias("doc_id"), suffix.alias("suffix"), "content")
    return found.orderBy("path") if ordered else found


def media_problems(uploads: DataFrame, accepted: tuple[str, ...] = ("application/pdf",)) -> tuple[DataFrame, DataFrame]:
    """(accepted uploads, problem rows with status 415) by content_type."""
    ok = F.coalesce(F.col("content_type").isin(*accepted), F.lit(False))
    bad = uploads.where(~ok).select(F.col("path").alias("instance"), F.lit("unsupported-media-type").alias("type"), F.lit(415).alias("status"), F.concat(F.lit("Unsupported content type: "), F.coalesce("content_type", F.lit("none"))).alias("detail"))
    return uploads.where(ok), bad


def records(table: DataFrame) -> DataFrame:
    """Rows as JSON strings, nulls as empty strings: a sheet's records."""
    text = table.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in table.columns))
    return text.select(F.to_json(F.struct(*text.columns)).alias("record"))


def flatten(table: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as columns with dotted names."""
    from pyspark.sql.types import StructType

    def leaves(schema, path):
        for f in schema.fields:
            here = [*path, f.name]
            if isinstance(f.dataType, StructType):
                yield from leaves(f.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here))

    return table.select(*leaves(table.schema, []))


def slides(shapes: DataFrame) -> DataFrame:
    """(path, slide, title, text) of a presentation's shape rows (path, slide, pos, is_title, text)."""
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("is_title"), F.struct("pos", "text")))), lambda x: x["text"]), "\n")
    return shapes.where(F.trim("text") != "").groupBy("path", "slide").agg(F.min_by("text", F.when(F.col("is_title"), F.col("pos"))).alias("title"), ordered.alias("text"))
