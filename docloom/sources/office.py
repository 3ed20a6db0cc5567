"""Slides and sheets: zip packages of XML parts as rows, and rows as sheets.

Both readers take rows of ``files.scan`` (any store that Spark reads), or are the data sources ``docloom_slides`` and
``docloom_sheets``, which plan several files to a partition. Slides come in the order of the presentation's own
list, resolved through its relationships, not of part names; sheets in the workbook's order, with shared, inline, boolean and
formula cells. A sheet's first row that has cells names its columns.

Defined cases: a file that is no package, or lacks a part that it names, is a problem row; parts that
would expand beyond ``MOST_BYTES`` are such a problem; empty cells are '' in records; a header that is empty or
repeats is named by its column letter.
"""

from __future__ import annotations

import io
import json
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..shipping import ship

SHAPES = "path string, doc_id string, slide int, pos int, is_title boolean, text string, problem string"
CELLS = "path string, doc_id string, sheet string, sheet_pos int, row int, record string, problem string"
MOST_BYTES = 256 << 20
# Namespaces of relationships in packages, and kinds of placeholders that are titles.
OFFICE_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
TITLES = ("title", "ctrTitle")


class Package:
    def __init__(self, data: bytes) -> None:
        self.zip = zipfile.ZipFile(io.BytesIO(data))

    def bytes(self, name: str) -> bytes:
        if self.zip.getinfo(name).file_size > MOST_BYTES:
            raise ValueError(f"{name} is too large")
        return self.zip.read(name)

    def xml(self, name: str) -> ET.Element:
        return ET.fromstring(self.bytes(name))

    def relations(self, part: str) -> dict[str, str]:
        """Targets by id of a part's relationships, as names within the package."""
        folder, name = posixpath.split(part)
        path = f"{folder}/_rels/{name}.rels".lstrip("/")
        if path not in self.zip.namelist():
            return {}
        return {r.get("Id"): posixpath.normpath(posixpath.join(folder, r.get("Target"))) if not r.get("Target").startswith("/") else r.get("Target")[1:] for r in self.xml(path) if r.get("TargetMode") != "External"}

    def main(self) -> str:
        return next(t for t in self.relations("").values() if t.endswith(("presentation.xml", "workbook.xml")))


def local(el: ET.Element) -> str:
    return el.tag.rpartition("}")[2]


def inner(el: ET.Element, name: str) -> Iterator[ET.Element]:
    return (x for x in el.iter() if local(x) == name)


def shapes_of(data: bytes) -> Iterator[tuple[int, int, bool, str]]:
    """(slide, pos, is_title, text) of every shape that has text, groups included."""
    p = Package(data)
    main = p.main()
    target = p.relations(main)
    for n, listed in enumerate(inner(p.xml(main), "sldId"), 1):
        pos = 0
        for shape in inner(p.xml(target[listed.get(OFFICE_REL + "id")]), "sp"):
            body = next((x for x in shape if local(x) == "txBody"), None)
            if body is None:
                continue
            # a line break within a paragraph is a vertical tab, as presentation libraries give it
            text = "\n".join("".join(x.text or "" if local(x) == "t" else "\v" for x in para.iter() if local(x) in ("t", "br")) for para in inner(body, "p"))
            pos += 1
            yield n, pos, any(x.get("type") in TITLES for x in inner(shape, "ph")), text


def column_number(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]*", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def column_letter(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def rows_of(p: Package, part: str, shared: list[str]) -> Iterator[dict[int, str]]:
    """Cells by column of each row; the sheet is read as a stream, row by row."""
    if p.zip.getinfo(part).file_size > MOST_BYTES:
        raise ValueError(f"{part} is too large")
    with p.zip.open(part) as f:
        for _, el in ET.iterparse(f):
            if local(el) != "row":
                continue
            cells, at = {}, 0
            for c in el:
                at = column_number(c.get("r")) if c.get("r") else at
                kind = c.get("t", "n")
                value = next((x.text or "" for x in c if local(x) == "v"), "")
                if kind == "s" and value:
                    value = shared[int(value)]
                elif kind == "inlineStr":
                    value = "".join(x.text or "" for x in inner(c, "t"))
                elif kind == "b":
                    value = "TRUE" if value == "1" else "FALSE"
                if value != "":
                    cells[at] = value
                at += 1
            el.clear()
            yield cells


def records_of(data: bytes) -> Iterator[tuple[str, int, int, str]]:
    """(sheet, sheet_pos, row, record) with records as JSON of the header's names."""
    p = Package(data)
    main = p.main()
    target = p.relations(main)
    text_part = next((t for t in target.values() if t.endswith("sharedStrings.xml")), None)
    shared = ["".join(t.text or "" for t in inner(si, "t")) for si in p.xml(text_part)] if text_part else []
    for n, listed in enumerate(inner(p.xml(main), "sheet"), 1):
        names: dict[int, str] | None = None
        row = 0
        for cells in rows_of(p, target[listed.get(OFFICE_REL + "id")], shared):
            if names is None:
                if cells:
                    names = {}
                    for i in range(max(cells) + 1):
                        name = cells.get(i, "")
                        names[i] = column_letter(i) if name == "" or name in names.values() else name
                continue
            row += 1
            yield listed.get("name"), n, row, json.dumps({name: cells.get(i, "") for i, name in names.items()}, ensure_ascii=False)


def _rows(kind: str, path: str, doc_id: str, data: bytes) -> Iterator[tuple]:
    made = shapes_of if kind == "slides" else records_of
    try:
        for r in made(data):
            yield (path, doc_id, *r, None)
    except (zipfile.BadZipFile, ET.ParseError, KeyError, ValueError, StopIteration, IndexError, NotImplementedError, RuntimeError) as e:
        yield (path, doc_id, *[None] * 4, f"{type(e).__name__}: {e}")


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}
    arrow = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])
    held: list[tuple] = []
    whole = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
    for r in rows:
        held.append(r)
        if len(held) == 5000:
            yield whole()
            held = []
    if held:
        yield whole()


def _read(files: DataFrame, kind: str, schema: str) -> DataFrame:
    ship(files.sparkSession)

    def run(batches):
        for b in batches:
            for path, doc_id, content in zip(*(b.column(c) for c in ("path", "doc_id", "content"))):
                yield from _batches(_rows(kind, path.as_py(), doc_id.as_py(), content.as_py() or b""), schema)

    return files.select("path", F.col("doc_id").cast("string").alias("doc_id"), F.col("content").cast("binary").alias("content")).mapInArrow(run, schema)


def shapes(files: DataFrame) -> DataFrame:
    """SHAPES rows of presentations, for ``files.slides``."""
    return _read(files, "slides", SHAPES)


def sheets(files: DataFrame) -> DataFrame:
    """CELLS rows of workbooks: a record a row."""
    return _read(files, "sheets", CELLS)


def problems(rows: DataFrame) -> DataFrame:
    return rows.where("problem is not null").select(F.col("path").alias("instance"), F.lit("package-syntax").alias("type"), F.lit(400).alias("status"), F.col("problem").alias("detail"))


# -- the data sources


class Group(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


class PackageReader(DataSourceReader):
    kind, suffix, columns = "", "", ""

    def __init__(self, options: dict) -> None:
        self.folder, self.size = options["path"], int(options.get("bytes", 32 << 20))

    def _fs(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder if "://" in self.folder else f"file://{self.folder}")

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, folder = self._fs()
        out, held, n = [], [], 0
        for f in sorted(store.get_file_info(fs.FileSelector(folder, recursive=True)), key=lambda f: f.path):
            if f.type != fs.FileType.File or not f.path.lower().endswith(self.suffix):
                continue
            if held and n + f.size > self.size:
                out.append(Group(held))
                held, n = [], 0
            held.append(f.path)
            n += f.size
        return [*out, Group(held)]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        store, _ = self._fs()
        for path in partition.paths:
            with store.open_input_file(path) as f:
                yield from _batches(_rows(self.kind, path, path, f.read()), self.columns)


class SlidesReader(PackageReader):
    kind, suffix, columns = "slides", ".pptx", SHAPES


class SheetsReader(PackageReader):
    kind, suffix, columns = "sheets", ".xlsx", CELLS


class Slides(DataSource):
    """spark.read.format("docloom_slides").load(folder), after ``register``."""

    @classmethod
    def name(cls) -> str:
        return "docloom_slides"

    def schema(self) -> str:
        return SHAPES

    def reader(self, schema) -> SlidesReader:
        return SlidesReader(self.options)


class Sheets(DataSource):
    @classmethod
    def name(cls) -> str:
        return "docloom_sheets"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> SheetsReader:
        return SheetsReader(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(Slides)
    spark.dataSource.register(Sheets)


# -- rows to packages

REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def zipped(parts: dict[str, str]) -> bytes:
    """A package of parts; the same parts give the same bytes."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), text, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def _relations(targets: list[tuple[str, str]]) -> str:
    inside = "".join(f'<Relationship Id="rId{i}" Type="{REL}/{kind}" Target="{escape(t)}"/>' for i, (kind, t) in enumerate(targets, 1))
    return f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{inside}</Relationships>'


def sheet_bytes(names: list[str], rows: list[list[str | None]], sheet: str = "Sheet1") -> bytes:
    """A workbook of one sheet: a header and rows of text."""
    cell = lambda r, c, v: f'<c r="{column_letter(c)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' if v not in (None, "") else ""
    lines = "".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(row))}</row>' for r, row in enumerate([names, *rows], 1))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    types = '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="xml" ContentType="application/xml"/><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    return zipped({
        "[Content_Types].xml": f'{types}<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>',
        "_rels/.rels": _relations([("officeDocument", "xl/workbook.xml")]),
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{REL}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": _relations([("worksheet", "worksheets/sheet1.xml")]),
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{lines}</sheetData></worksheet>',
    })


def slides_bytes(slides: list[list[tuple[bool, str]]]) -> bytes:
    """A presentation: of each slide its shapes' (is_title, text)."""
    draw, show = "http://schemas.openxmlformats.org/drawingml/2006/main", "http://schemas.openxmlformats.org/presentationml/2006/main"
    para = lambda t: "".join(f"<a:p><a:r><a:t>{escape(x)}</a:t></a:r></a:p>" for x in t.split("\n"))
    shape = lambda title, t: f'<p:sp><p:nvSpPr><p:nvPr>{"<p:ph type=" + chr(34) + "title" + chr(34) + "/>" if title else ""}</p:nvPr></p:nvSpPr><p:txBody>{para(t)}</p:txBody></p:sp>'
    parts = {
        "_rels/.rels": _relations([("officeDocument", "ppt/presentation.xml")]),
        "ppt/presentation.xml": f'<p:presentation xmlns:p="{show}" xmlns:r="{REL}"><p:sldIdLst>{"".join(f"<p:sldId id={chr(34)}{255 + i}{chr(34)} r:id={chr(34)}rId{i}{chr(34)}/>" for i in range(1, len(slides) + 1))}</p:sldIdLst></p:presentation>',
        # parts are numbered from the last slide on: only the relationships tell the order
        "ppt/_rels/presentation.xml.rels": _relations([("slide", f"slides/slide{len(slides) - i}.xml") for i in range(len(slides))]),
    }
    for i, held in enumerate(slides):
        parts[f"ppt/slides/slide{len(slides) - i}.xml"] = f'<p:sld xmlns:p="{show}" xmlns:a="{draw}"><p:cSld><p:spTree>{"".join(shape(*s) for s in held)}</p:spTree></p:cSld></p:sld>'
    return zipped(parts)


def as_sheets(table: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, content): the flat table's rows as one workbook for each set of keys, in the order of all columns. A workbook
    is a file, so a set of keys must be no larger than one."""
    ship(table.sparkSession)
    names = [c for c in table.columns if c not in keys]

    @F.pandas_udf("binary")
    def made(rows: pd.Series) -> pd.Series:
        return rows.map(lambda held: sheet_bytes(names, [[r[c] for c in names] for r in held]))

    text: Column = F.array_sort(F.collect_list(F.struct(*(F.col(c).cast("string").alias(c) for c in names))))
    return table.groupBy(*keys).agg(text.alias("rows")).select(*keys, made("rows").alias("content"))


def as_slides(shapes_: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, content): shape rows (keys, slide, pos, is_title, text) as one presentation for each set of keys."""
    ship(shapes_.sparkSession)

    @F.pandas_udf("binary")
    def made(rows: pd.Series) -> pd.Series:
        def one(held):
            slides: dict = {}
            for r in held:
                slides.setdefault(r["slide"], []).append((bool(r["is_title"]), r["text"] or ""))
            return slides_bytes(list(slides.values()))

        return rows.map(one)

    held = F.array_sort(F.collect_list(F.struct(F.col("slide").cast("int").alias("slide"), F.col("pos").cast("int").alias("pos"), "is_title", "text")))
    return shapes_.groupBy(*keys).agg(held.alias("rows")).select(*keys, made("rows").alias("content"))
