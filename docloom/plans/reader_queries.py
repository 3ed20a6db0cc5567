"""Queries of the paged path, of readers of files, of the ingestion plan with a model's terms, and of the store's views;
with the SQL that gives the same rows. Files are made of the driver's tables and read back by the library's readers.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import tracing
from ..functions import text as T
from ..functions import transforms as X
from ..operators import layout
from ..operators.store import Store
from ..sources import files, models, office, pdf, providers, strategies, xml
from ..sources.tables import PARTS_A_CORE, dealt, load, new_path
from . import paged, pipeline
from .doc_queries import modules
from .xml_queries import _files, _str, _text

# -- paged files


def pdf_files(spark, sf_dir) -> DataFrame:
    """A PDF a customer, a page an order in the order of keys: a numbered heading and two paragraphs."""
    o = load(spark, sf_dir, "orders")
    page = F.struct("o_orderkey", _text(
        "BT /F2 18 Tf 20 370 Td (", (F.col("o_orderkey") % 9 + 1).cast("string"), " ORDER ", _str("o_orderkey"), ") Tj ET\nBT /F1 10 Tf 20 300 Td (Goods of ) Tj (", F.col("o_orderpriority"), ") Tj ET\nBT /F1 10 Tf 20 260 Td [(Status) -300 (", F.col("o_orderstatus"), ".)] TJ ET",
    ).alias("body"))
    # parts of one number, for reading a file is heavy and rows are small
    per = o.repartition(PARTS_A_CORE * spark.sparkContext.defaultParallelism, "o_custkey").groupBy("o_custkey").agg(F.array_sort(F.collect_list(page)).alias("pages"))
    one = lambda x, i: F.concat(
        (i * 2 + 10).cast("string"), F.lit(" 0 obj\n<</Type/Page/Parent 2 0 R/Contents "), (i * 2 + 11).cast("string"), F.lit(" 0 R>>\nendobj\n"),
        (i * 2 + 11).cast("string"), F.lit(" 0 obj\n<</Length "), F.length(x["body"]).cast("string"), F.lit(">>\nstream\n"), x["body"], F.lit("\nendstream\nendobj\n"),
    )
    kids = F.array_join(F.transform("pages", lambda _, i: F.concat((i * 2 + 10).cast("string"), F.lit(" 0 R"))), " ")
    font = lambda n, name: f"{n} 0 obj\n<</Type/Font/Subtype/Type1/BaseFont/{name}/Encoding/WinAnsiEncoding/FontDescriptor<</MissingWidth 500>>>>\nendobj\n"
    text = F.concat(
        F.lit("%PDF-1.4\n1 0 obj\n<</Type/Catalog/Pages 2 0 R>>\nendobj\n2 0 obj\n<</Type/Pages/MediaBox[0 0 400 400]/Resources<</Font<</F1 3 0 R/F2 4 0 R>>>>/Kids["), kids,
        F.lit("]>>\nendobj\n" + font(3, "Helvetica") + font(4, "Helvetica-Bold")), F.array_join(F.transform("pages", one), ""), F.lit("trailer\n<</Root 1 0 R>>\n"),
    )
    return per.select(_text(_str("o_custkey"), ".pdf").alias("path"), _str("o_custkey").alias("doc_id"), F.encode(text, "utf-8").alias("content"), F.lit("pdf").alias("suffix"))


def pdf_spans(spark, sf_dir):
    """Spans of PDF files: blocks, texts, fonts and boxes (SRC4, AGG3)."""
    s = pdf.spans(pdf.read(pdf_files(spark, sf_dir), spanned=True))
    r = lambda c: F.round(c, 3).alias(c)
    return s.select(F.col("doc_id").cast("long").alias("doc_id"), "page", "block", "pos", "text", "font", r("size"), "flags", r("x0"), r("y0"), r("x1"))


def pdf_blocks(spark, sf_dir):
    """Headings and paragraphs of PDF files, classified and under their headings (SRC4, FN4, WIN1, FLT1)."""
    parts = pipeline.written(pdf.read(pdf_files(spark, sf_dir), spanned=True), "spans")  # files are read once, whatever is made of them
    s = pdf.spans(parts)
    b = paged.layout_blocks(s, pdf.bookmarks(parts), pdf.contents_pages(s))
    return b.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("pos").cast("int").alias("pos"), "page", "block_type", "text", F.col("level").cast("int").alias("level"), F.col("parent_pos").cast("int").alias("parent_pos"), F.array_join("context_path", "/").alias("path"))


def _items(spark, sf_dir) -> DataFrame:
    """A structural reader's rows of a document a brand: headings, texts, tables, formulas and empty rows."""
    p, k = load(spark, sf_dir, "part"), F.col("p_partkey")
    kind = lambda *xs: F.element_at(F.array(*(x if isinstance(x, F.Column) else F.lit(x) for x in xs)), (k % 5 + 1).cast("int"))
    d = lambda e: e.cast("double")
    return p.select(
        F.col("p_brand").alias("doc_id"), k.alias("pos"), (k % 7 + 1).cast("int").alias("page"), kind("section_header", "text", "table", "formula", "text").alias("label"), F.when(k % 5 == 0, 1).alias("level"),
        kind(_text(" ", (F.col("p_size") + 1).cast("string"), ". Part ", F.col("p_name"), " "), _text("Words on ", F.col("p_name")), "", _text("E = m ", _str("p_partkey")), "  ").alias("text"),
        d(k % 300).alias("l"), d(k % 700).alias("b"), d(k % 300 + 80).alias("r"), d(k % 700 + 9).alias("t"),
        F.when(k % 5 == 2, F.array(F.lit("name"), F.lit("size"))).alias("headers"), F.when(k % 5 == 2, F.array(F.array(F.col("p_name"), _str("p_size")))).alias("rows"),
    )


def structural_blocks(spark, sf_dir):
    """Items to blocks: types, tables as text, boxes, and parents among headings (SRC5, WIN2, PRJ8, FN25, FLT1)."""
    b = paged.structural_blocks(_items(spark, sf_dir))
    return b.select(
        "doc_id", F.col("pos").cast("int").alias("pos"), "page", "block_type", "text", F.col("parent_pos").cast("long").alias("parent_key"), F.array_join("table_data.headers", ",").alias("headers"), F.element_at("table_data.rows", 1)[0].alias("cell"),
        F.col("equation_data.latex").alias("latex"), "section_label", "section_title", "x0", "y0", "x1", "y1",
    )


def supplemented_blocks(spark, sf_dir):
    """Numbered equations that only the layout source has, with an external reader's text where it gave one (SRC7, JOI4, SET3, WIN4)."""
    p, k = load(spark, sf_dir, "part"), F.col("p_partkey")
    # a box for every part; an equation's span lies on it for even parts, in the page's margin for odd ones
    y = F.col("p_size") * 10.0
    blocks = p.select(F.col("p_brand").alias("doc_id"), k.alias("pos"), (k % 7 + 1).cast("int").alias("page"), F.lit("paragraph").alias("block_type"), _text("Words on ", F.col("p_name")).alias("text"), F.lit(100.0).alias("x0"), F.lit(200.0).alias("x1"), (800.0 - y - 8.0).alias("y0"), (800.0 - y).alias("y1"))
    spans = p.select(
        F.col("p_brand").alias("doc_id"), (k % 7 + 1).cast("int").alias("page"), k.cast("int").alias("block"), k.alias("pos"), _text("x = y  + ", _str("p_size"), " (", _str("p_partkey"), ".1)").alias("text"),
        F.when(k % 2 == 0, 120.0).otherwise(300.0).alias("x0"), F.when(k % 2 == 0, 140.0).otherwise(340.0).alias("x1"), y.alias("y0"), (y + 8.0).alias("y1"), F.lit(800.0).alias("page_height"),
    )
    ocr = p.where("p_partkey % 6 = 1").select(F.col("p_brand").alias("doc_id"), (k % 7 + 1).cast("int").alias("page"), F.lit(300.0).alias("x0"), y.alias("y0"), F.lit("x=y").alias("latex")).distinct()
    b = paged.supplemented(blocks, spans, ocr).where("block_type = 'equation'")
    return b.groupBy("doc_id", "page", "y0", F.col("equation_data.latex").alias("latex"), F.col("equation_data.equationNumber").alias("number"), "text").agg(F.count("*").alias("n"))


def front_matter(spark, sf_dir):
    """Title, identifiers and language by rules over the front pages of PDF files (FLT2, AGG5, AGG6, FN10, FN11, LIM4, LIM5)."""
    spans = pdf.spans(pipeline.written(pdf.read(pdf_files(spark, sf_dir), spanned=True), "spans"))
    m = paged.front_metadata(spans, kept=lambda b: pipeline.written(b, "front"))
    return m.select(F.col("doc_id").cast("long").alias("doc_id"), "dc_title", "dc_language", F.size(F.coalesce("dc_identifier", F.expr("array()"))).cast("long").alias("n_identifiers"))


def scanned_pages(spark, sf_dir):
    """Blocks of scanned documents' first three pages, from an external reader's rows (SRC6, EXT4, LIM4)."""
    l = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
    ocr = l.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), F.when(F.col("part") % 9 == 0, "  ").otherwise(_text(" part ", _str("part"), "\n")).alias("text"))
    return layout.vision_blocks(ocr).select("doc_id", F.col("page").cast("int").alias("page"), "block_type", "text", F.col("confidence").cast("double").alias("confidence"))


# -- packages, folders, strategies


def deck_slides(spark, sf_dir):
    """Presentations of 20 web pages each, written and read back: titles and texts in the deck's order (SRC11)."""
    p = load(spark, sf_dir, "pages").select(F.expr("page_id div 20").alias("deck"), F.expr("page_id % 20").alias("n"), "page_id", "url", F.regexp_extract("html", r"<h1[^>]*>([^<]*)", 1).alias("head"))
    slide = F.explode(F.array(F.struct(F.lit(1).alias("pos"), F.lit(True).alias("is_title"), F.col("url").alias("text")), F.struct(F.lit(2).alias("pos"), F.lit(False).alias("is_title"), F.col("head").alias("text"))))
    decks = office.as_slides(p.select("deck", F.col("n").alias("slide"), slide.alias("s")).select("deck", "slide", "s.*"), ["deck"])
    s = files.slides(office.shapes(decks.select(_text("deck-", _str("deck"), ".pptx").alias("path"), _str("deck").alias("doc_id"), "content")))
    return s.select("path", "slide", "title", F.col("text").alias("body"))


def sheet_records(spark, sf_dir):
    """Workbooks of each nation's suppliers, written and read back as records (SRC12, SNK7)."""
    s = load(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_name", F.when(F.col("s_suppkey") % 3 > 0, F.round(F.col("s_acctbal") * 100).cast("long")).alias("cents"))
    r = office.sheets(office.as_sheets(s, ["s_nationkey"]).select(_str("s_nationkey").alias("path"), _str("s_nationkey").alias("doc_id"), "content"))
    get = lambda k: F.get_json_object("record", f"$.{k}")
    return r.select(F.col("doc_id").cast("int").alias("nation"), get("s_suppkey").cast("long").alias("supplier"), get("s_name").alias("name"), get("cents").alias("cents"), "sheet")


def scan_files(spark, sf_dir):
    """Text files written by key and scanned by glob in the order of paths (SRC1, SET1, LIM1)."""
    o = load(spark, sf_dir, "orders").select(F.format_string("%02d", F.col("o_custkey") % 40).alias("part"), _str("o_orderkey").alias("value"))
    folder = new_path(spark, "scanned")
    o.repartition("part").write.partitionBy("part").text(folder)
    found = files.scan(spark, folder, "*.{txt,none}", recursive=True, ordered=True)
    lines = F.split(F.rtrim(F.decode("content", "utf-8"), F.lit("\n")), "\n")
    return found.select(F.regexp_extract("path", "part=([0-9]+)", 1).alias("part"), "suffix", F.size(lines).cast("long").alias("n_lines"), F.aggregate(F.transform(lines, lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


def media_gate(spark, sf_dir):
    """Uploads that are kept and refused by their content type (SRC2, FLT10)."""
    e = load(spark, sf_dir, "events").select(_str("event_id").alias("path"), F.when(F.col("event_id") % 3 == 0, "application/pdf").when(F.col("event_id") % 3 == 1, F.col("event_type")).alias("content_type"))
    ok, bad = files.media_problems(e)
    return ok.select("path", F.lit(200).alias("status"), F.lit("").alias("detail")).unionByName(bad.select(F.col("instance").alias("path"), "status", "detail"))


def parser_strategies(spark, sf_dir):
    """Files of two formats, each by the parser of its suffix, through the table function (UDF2, API5)."""
    known = strategies.register(spark)
    o = load(spark, sf_dir, "orders")
    notes = dealt(o).where("o_orderkey % 2 = 0").select(F.lit("").alias("path"), _str("o_orderkey").alias("doc_id"), F.encode(_text("<note>Order ", _str("o_orderkey"), F.when(F.col("o_orderkey") % 4 == 0, "</note>").otherwise("")), "utf-8").alias("content"), F.lit("xml").alias("suffix"))
    p = strategies.parsed(pdf_files(spark, sf_dir).unionByName(notes), known)
    return p.select(F.col("doc_id").cast("long").alias("doc_id"), "strategy", "kind", "place", "text", F.col("problem").isNotNull().alias("failed"))


def run_counters(spark, sf_dir):
    """Counters of a run, gathered while its rows were written (AGG10, SNK8)."""
    o = dealt(load(spark, sf_dir, "orders"))
    body = F.when(F.col("o_orderkey") % 4 == 0, _text("<note>", F.col("o_orderpriority"))).otherwise(_text("<note>", F.col("o_orderpriority"), "</note>"))
    c = tracing.Counters(spark, "bulk")
    rows = xml.shred(_files(o.select(F.col("o_orderkey").alias("l_orderkey"), body.alias("xml"))), ("blocks",))
    c.watch("parse", rows.withColumn("n", F.size("blocks")), added="n").write.format("noop").mode("overwrite").save()
    return c.rows()


# -- XML: expressions, relations, raw fields, fragments, transforms


def applic_trees(spark, sf_dir):
    """Steps with the applicability expression they refer to: nodes of and / or over assertions (TRE11, JOI3)."""
    part, supplier = _str("l_partkey"), _str("l_suppkey")
    key = _text(_str("l_linenumber"), "-", part, "-", supplier)
    either = F.when(F.col("l_linenumber") % 2 == 0, "or").otherwise("and")
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", key.alias("key"), _text(
        '<applic id="a', key, '"><evaluate andOr="', either, '"><assert applicPropertyIdent="part" applicPropertyType="prodattr" applicPropertyValues="', part, '"/><evaluate andOr="or"><assert applicPropertyIdent="supplier" applicPropertyValues="', supplier, '"/></evaluate></evaluate></applic>',
    ).alias("a"), _text('<proceduralStep applicRefId="a', key, '"><para>', part, "</para></proceduralStep>").alias("s"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", c))), lambda r: r[c]), "")
    per = rows.groupBy("l_orderkey").agg(joined("a").alias("a"), joined("s").alias("s"))
    m = per.select("l_orderkey", _text("<dmodule><status>", F.col("a"), "</status><content><procedure><mainProcedure>", F.col("s"), "</mainProcedure></procedure></content></dmodule>").alias("xml"))
    b = xml.blocks(xml.shred(_files(m), ("blocks",)))
    held = lambda path: F.get_json_object("structured_content", f"$.applicTree.evaluateTree.{path}")
    return b.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held("andOr").alias("top"), held("children[0].ident").alias("ident"), held("children[0].values").alias("part"), held("children[1].type").alias("inner_type"), held("children[1].andOr").alias("inner"), held("children[1].children[0].values").alias("supplier"))


def catalog_relations(spark, sf_dir):
    """Relations that a catalog's rules find, as codes of the modules referred to (TRE6, FN14)."""
    ref = lambda tag, model, code: _text(f"<{tag}><dmRef><dmRefIdent><dmCode modelIdentCode=\"", model, '" systemDiffCode="A" infoCode="', code, f'"/></dmRefIdent></dmRef></{tag}>')
    o = dealt(load(spark, sf_dir, "orders"))
    m = o.select(F.col("o_orderkey").alias("l_orderkey"), _text("<dmodule><status>", ref("applicCrossRefTableRef", _text("T", _str("o_custkey")), "00W"), F.when(F.col("o_orderkey") % 3 == 0, ref("brexDmRef", _text("B", _str("o_orderkey")), "022")).otherwise(""), "</status><content/></dmodule>").alias("xml"))
    r = xml.relations(xml.shred(_files(m), ("relations",)))
    return r.select(F.col("doc_id").cast("long").alias("o_orderkey"), "relation_type", "target", "confidence")


def raw_fields(spark, sf_dir):
    """The title block's raw code fields (FN20, TRE2)."""
    b = xml.block_rows(_files(modules(spark, sf_dir).withColumnRenamed("o_orderkey", "l_orderkey")), ("text", "structured_content"), ("titles",))
    get = lambda k: F.get_json_object("structured_content", f"$.s1000d_dmCode.{k}")
    return b.select(F.col("doc_id").cast("long").alias("o_orderkey"), "text", get("modelIdentCode").alias("model"), get("infoCode").alias("info"), get("subSystemCode").alias("sub"))


def block_fragments(spark, sf_dir):
    """Source elements and fragments of leaf blocks (TRE8)."""
    b = xml.blocks(xml.shred(_files(modules(spark, sf_dir).withColumnRenamed("o_orderkey", "l_orderkey")), ("blocks", "fragments")))
    return b.where("block_type in ('paragraph', 'procedureStep', 'note')").select(F.col("doc_id").cast("long").alias("o_orderkey"), F.col("pos").cast("int").alias("pos"), "source_element_name", "xml_fragment")


def transform_registry(spark, sf_dir):
    """Every transform by its name in the registry, over an order's attributes and texts (UDF1, JOI7, FN13-FN20)."""
    o = load(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    attributes = F.create_map(*(x for k, v in {
        "modelIdentCode": _text("M", _str("o_custkey")), "infoCode": F.when(key % 2 == 0, "040A").otherwise("999X"), "year": F.year("o_orderdate").cast("string"), "month": F.month("o_orderdate").cast("string"),
        "securityClassification": F.when(key % 5 == 0, "02").otherwise("01"),
    }.items() for x in (F.lit(k), v)))
    names = [F.when(key % 3 > 0, F.lit("Given")), F.col("o_orderpriority")]
    made = {"attributes": lambda f: f(attributes), "text": lambda f: f(_text("  ", F.col("o_orderstatus"), " ")), "names": lambda f: f(*names), "texts": lambda f: f(F.array(*names, F.lit(" ")))}
    text = lambda c: F.to_json(F.struct(c.alias("v")))
    pairs = F.array(*(F.struct(F.lit(name).alias("name"), text(made[takes](build)).alias("value")) for name, (build, takes) in X.REGISTRY.items()))
    return o.select("o_orderkey", F.explode(pairs).alias("x")).select("o_orderkey", "x.name", "x.value")


# -- models and the store


def model_terms(spark, sf_dir):
    """Terms that a service lists from parts' texts, equal questions asked once (EXT2)."""
    p = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.lit(1).alias("pos"), _text(F.col("p_name"), " = ", F.col("p_type"), " of ", F.col("p_brand"), " / long words", "\n", F.when(F.col("p_size") % 2 == 0, _text("size = ", _str("p_size"))).otherwise("")).alias("text"))
    provider = models.ModelProvider(models.Service(models.listed_terms, ["first", "second"]), Store(spark, new_path(spark, "models")), "List the terms.", "")
    return provider.terms(p).select("doc_id", "pos", "term", "definition_en", "definition_ko")


def answered_metadata(model: str, question: str) -> str:
    """A service for trials: metadata of a front text of the form ``title|language|date``."""
    title, language, created = question.split("\n\n", 1)[1].split("|")
    return json.dumps({"dc_title": title, "dc_language": language, "dc_type": "Manual", "dc_date": {"created": created}})


def model_metadata(spark, sf_dir):
    """Metadata that a service gives for front texts, joined with what rules found (EXT1, JOI9)."""
    o = load(spark, sf_dir, "orders")
    front = o.select(F.col("o_orderkey").alias("doc_id"), _text("Title of ", _str("o_custkey"), "|", F.when(F.col("o_orderkey") % 2 == 0, "en").otherwise("x"), "|", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("text"))
    provider = models.ModelProvider(models.Service(answered_metadata, ["only"]), Store(spark, new_path(spark, "models")), "", "Give metadata.", front)
    from ..operators import metadata

    rules = o.select(F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderkey") % 3 == 0, "By rule").alias("title"), F.lit(None).cast("array<struct<scheme:string,value:string>>").alias("identifier"), F.lit("ko").alias("language"))
    m = metadata.two_tracks(rules, provider.metadata(front))
    return m.select("doc_id", "dc_title", "dc_language", F.col("dc_date.created").alias("created"))


def ingest_terms(spark, sf_dir):
    """Modules ingested with a model's terms (of those that have a block long enough to be asked of), then read back from the store's views in SQL: terms that were promoted, the
    last landed of each, and landed records (EXT1, SNK1, SNK2, PRJ4, API2, API4)."""
    o = load(spark, sf_dir, "orders")
    key, group = F.col("o_orderkey"), F.col("o_custkey") % 100
    null = F.lit(None).cast("string")
    given = o.select(
        _str("o_orderkey").alias("doc_id"), key.cast("int").alias("pos"), _text("Term ", group.cast("string")).alias("term"), F.lit("TERM-CLASS").alias("term_type"), null.alias("headword_en"), null.alias("headword_ko"),
        F.when(key % 4 > 0, _text("Definition number ", _str("o_orderkey"), " of it")).alias("definition_en"), F.when(group % 2 == 0, _text("Korean words for number ", _str("o_orderkey"))).otherwise("").alias("definition_ko"), F.array(F.lit("nuclear")).alias("domain"), null.alias("context"),
    )
    given.createOrReplaceTempView("docloom_given_terms")
    s = Store(spark, new_path(spark, "terms"))
    pipeline.ingest(spark, _files(modules(spark, sf_dir).withColumnRenamed("o_orderkey", "l_orderkey")), "2024-01-01T00:00:00Z", provider=providers.TableProvider(spark, terms="docloom_given_terms"), target=s)
    s.views()
    return spark.sql("""
        SELECT 'promoted' AS place, concat(term_kind, '/', term_key) AS key, definition_en AS text, 1L AS n FROM ssot_terms
        UNION ALL SELECT 'landed', concat(term_kind, '/', term_key), definition_en, 1L FROM landing_terms
        UNION ALL SELECT 'record', documentId, metadata.`dc:title`, CAST(size(content) * 100 + size(provenance.sourceXPathMapping) AS BIGINT) FROM landing_docs""")


def store_purge(spark, sf_dir):
    """Tables of a store after one of them was purged (SNK9), and what is left to its views (API2)."""
    s = Store(spark, new_path(spark, "purged"))
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for t in ("fragments", "problems"):
        s.upsert(t, o, ["o_orderkey"], ["o_orderkey"])
    s.purge("problems")
    left = spark.table(s.views()[0])
    return left.groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("purged", F.lit(not s.exists("problems"))).withColumn("views", F.lit(",".join(s.views())))


def stable_ids(spark, sf_dir):
    """Ids of documents by path and content: the same for the same (FN22)."""
    d = load(spark, sf_dir, "documents")
    return d.select("doc_id", T.stable_id("DOC_", F.col("source"), F.sha2("text", 256)).alias("id"))


def korean_labels(spark, sf_dir):
    """Headings of Korean documents: numbered parts and letters, with their depth (FN1, FN5)."""
    p, k = load(spark, sf_dir, "part"), F.col("p_partkey")
    kind = F.element_at(F.array(*map(F.lit, ("장", "절", "항", "목"))), (k % 4 + 1).cast("int"))
    text = F.when(k % 3 == 0, _text("제", _str("p_size"), kind, " ", F.col("p_name"))).when(k % 3 == 1, _text(F.element_at(F.array(*map(F.lit, "가나다")), (k % 3 + 1).cast("int")), ". ", F.col("p_name"))).otherwise(_text("가격 ", F.col("p_name")))
    s = T.section_label(text)
    return p.select("p_partkey", s["label"].alias("label"), s["title"].alias("title"), T.label_depth(s["label"]).cast("int").alias("depth"))


_PAGES = "SELECT o_custkey AS doc_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS page, o_orderkey, o_orderpriority, o_orderstatus FROM orders"
_HEADING = "concat(o_orderkey % 9 + 1, ' ORDER ', o_orderkey)"
_PARTS = "SELECT *, max(CASE WHEN p_partkey % 5 = 0 THEN p_partkey END) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS head FROM part"
SQL = {
    "store_purge": "SELECT o_orderstatus, count(*) AS n, true AS purged, 'fragments' AS views FROM orders GROUP BY o_orderstatus",
    "stable_ids": "SELECT doc_id, concat('DOC_', left(sha256(concat_ws(chr(31), source, sha256(text))), 32)) AS id FROM documents",
    "korean_labels": """WITH t AS (SELECT p_partkey, p_name, CASE p_partkey % 3 WHEN 0 THEN concat('제', p_size, ['장', '절', '항', '목'][p_partkey % 4 + 1]) WHEN 1 THEN '나.' END AS label FROM part)
        SELECT p_partkey, label, CASE WHEN label IS NOT NULL THEN p_name END AS title, CAST(length(label) - length(replace(label, '.', '')) + 1 AS INT) AS depth FROM t""",
    "pdf_spans": f"""WITH p AS ({_PAGES}), s AS (
            SELECT doc_id, page, CAST(1 AS INT) AS block, CAST(1 AS BIGINT) AS pos, {_HEADING} AS text, 'Helvetica-Bold' AS font, 18.0::DOUBLE AS size, CAST(16 AS INT) AS flags, 370 AS y FROM p
            UNION ALL SELECT doc_id, page, 2, 2, concat('Goods of ', o_orderpriority), 'Helvetica', 10.0, 0, 300 FROM p UNION ALL SELECT doc_id, page, 3, 3, concat('Status ', o_orderstatus, '.'), 'Helvetica', 10.0, 0, 260 FROM p)
        SELECT doc_id, page, block, pos, text, font, size, flags, 20.0::DOUBLE AS x0, round((400 - y - 0.8 * size)::DOUBLE, 3) AS y0,
            round((20 + 0.5 * size * (length(text) - CASE WHEN block = 3 THEN 0.4 ELSE 0 END))::DOUBLE, 3) AS x1 FROM s""",
    "pdf_blocks": f"""WITH p AS ({_PAGES})
        SELECT doc_id, CAST(page * 3 - 2 AS INT) AS pos, page, 'section' AS block_type, {_HEADING} AS text, CAST(1 AS INT) AS level, CAST(NULL AS INT) AS parent_pos, '' AS path FROM p
        UNION ALL SELECT doc_id, page * 3 - 1, page, 'paragraph', concat('Goods of ', o_orderpriority), 999, page * 3 - 2, {_HEADING} FROM p
        UNION ALL SELECT doc_id, page * 3, page, 'paragraph', concat('Status ', o_orderstatus, '.'), 999, page * 3 - 2, {_HEADING} FROM p""",
    "structural_blocks": f"""WITH p AS ({_PARTS})
        SELECT p_brand AS doc_id, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS INT) AS pos, CAST(p_partkey % 7 + 1 AS INT) AS page, ['section', 'paragraph', 'table', 'equation'][p_partkey % 5 + 1] AS block_type,
            [concat(p_size + 1, '. Part ', p_name), concat('Words on ', p_name), concat('| name | size |', chr(10), '| --- | --- |', chr(10), '| ', p_name, ' | ', p_size, ' |'), concat('E = m ', p_partkey)][p_partkey % 5 + 1] AS text,
            CASE WHEN p_partkey % 5 > 0 THEN head END AS parent_key, CASE WHEN p_partkey % 5 = 2 THEN 'name,size' END AS headers, CASE WHEN p_partkey % 5 = 2 THEN p_name END AS cell, CASE WHEN p_partkey % 5 = 3 THEN concat('E = m ', p_partkey) END AS latex,
            CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size + 1 AS VARCHAR) END AS section_label, CASE WHEN p_partkey % 5 = 0 THEN concat('Part ', p_name) END AS section_title,
            CAST(p_partkey % 300 AS DOUBLE) AS x0, CAST(p_partkey % 700 AS DOUBLE) AS y0, CAST(p_partkey % 300 + 80 AS DOUBLE) AS x1, CAST(p_partkey % 700 + 9 AS DOUBLE) AS y1
        FROM p WHERE p_partkey % 5 < 4""",
    "supplemented_blocks": """WITH o AS (SELECT DISTINCT p_brand, p_partkey % 7 AS g, p_size FROM part WHERE p_partkey % 6 = 1),
        e AS (SELECT part.*, o.p_size IS NOT NULL AS seen FROM part LEFT JOIN o ON o.p_brand = part.p_brand AND o.g = part.p_partkey % 7 AND o.p_size = part.p_size WHERE part.p_partkey % 2 = 1)
        SELECT p_brand AS doc_id, CAST(p_partkey % 7 + 1 AS INT) AS page, CAST(p_size * 10 AS DOUBLE) AS y0, CASE WHEN seen THEN 'x=y' ELSE concat('x = y + ', p_size) END AS latex, concat(p_partkey, '.1') AS number,
            CASE WHEN seen THEN 'x=y' ELSE concat('x = y  + ', p_size, ' (', p_partkey, '.1)') END AS text, count(*) AS n FROM e GROUP BY ALL""",
    "front_matter": f"""WITH p AS ({_PAGES}) SELECT doc_id, max(CASE WHEN page = 1 THEN {_HEADING} END) AS dc_title, 'en' AS dc_language, CAST(0 AS BIGINT) AS n_identifiers FROM p GROUP BY doc_id""",
    "scanned_pages": """WITH l AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part FROM lineitem GROUP BY ALL)
        SELECT l_orderkey AS doc_id, CAST(l_linenumber AS INT) AS page, 'paragraph' AS block_type, concat('part ', part) AS text, CAST(0.8 AS DOUBLE) AS confidence FROM l WHERE l_linenumber <= 3 AND part % 9 <> 0""",
    "deck_slides": r"""SELECT concat('deck-', page_id // 20, '.pptx') AS path, CAST(row_number() OVER (PARTITION BY page_id // 20 ORDER BY page_id) AS INT) AS slide, url AS title,
        CASE WHEN trim(regexp_extract(html, '<h1[^>]*>([^<]*)', 1)) = '' THEN '' ELSE regexp_extract(html, '<h1[^>]*>([^<]*)', 1) END AS body FROM pages""",
    "sheet_records": "SELECT s_nationkey AS nation, s_suppkey AS supplier, s_name AS name, CASE WHEN s_suppkey % 3 > 0 THEN CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS VARCHAR) ELSE '' END AS cents, 'Sheet1' AS sheet FROM supplier",
    "scan_files": "SELECT printf('%02d', o_custkey % 40) AS part, 'txt' AS suffix, count(*) AS n_lines, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders GROUP BY ALL",
    "media_gate": """SELECT CAST(event_id AS VARCHAR) AS path, CAST(CASE WHEN event_id % 3 = 0 THEN 200 ELSE 415 END AS INT) AS status,
        CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat('Unsupported content type: ', event_type) ELSE 'Unsupported content type: none' END AS detail FROM events""",
    "parser_strategies": f"""WITH p AS ({_PAGES})
        SELECT doc_id, 'pdf' AS strategy, 'run' AS kind, page AS place, unnest([{_HEADING}, 'Goods of ', o_orderpriority, concat('Status ', o_orderstatus, '.')]) AS text, false AS failed FROM p
        UNION ALL SELECT o_orderkey, 'xml', CASE WHEN o_orderkey % 4 = 0 THEN 'paragraph' END, NULL, CASE WHEN o_orderkey % 4 = 0 THEN concat('Order ', o_orderkey) END, o_orderkey % 4 <> 0 FROM orders WHERE o_orderkey % 2 = 0""",
    "run_counters": """WITH c AS (SELECT count(*) AS total, count(*) FILTER (o_orderkey % 4 = 0) AS failed FROM orders)
        SELECT 'bulk' AS run, 'parse' AS stage, unnest(['total', 'failed', 'succeeded', 'added']) AS counter, unnest([total, failed, total - failed, total - failed]) AS n FROM c""",
    "applic_trees": """SELECT l_orderkey AS doc_id, CAST(l_partkey AS VARCHAR) AS text, CASE WHEN l_linenumber % 2 = 0 THEN 'or' ELSE 'and' END AS top, 'part' AS ident, CAST(l_partkey AS VARCHAR) AS part, 'evaluate' AS inner_type, 'or' AS inner, CAST(l_suppkey AS VARCHAR) AS supplier FROM lineitem""",
    "catalog_relations": """SELECT o_orderkey, 'custom:GOVERNED_BY_APPLIC' AS relation_type, concat('DMC-T', o_custkey, '-A-----00W-') AS target, CAST(1 AS DOUBLE) AS confidence FROM orders
        UNION ALL SELECT o_orderkey, 'custom:COMPLIES_WITH', concat('DMC-B', o_orderkey, '-A-----022-'), 1 FROM orders WHERE o_orderkey % 3 = 0""",
    "raw_fields": """SELECT o_orderkey, concat('Order ', o_orderkey, ' - ', o_orderpriority) AS text, concat('M', o_custkey) AS model, CASE o_orderkey % 3 WHEN 0 THEN '040' WHEN 1 THEN '520' ELSE '999' END AS info, CAST(o_orderkey % 9 AS VARCHAR) AS sub FROM orders""",
    "block_fragments": """SELECT o_orderkey, CAST(3 AS INT) AS pos, 'para' AS source_element_name, concat('<para>Total ', o_custkey, '</para>') AS xml_fragment FROM orders
        UNION ALL SELECT o_orderkey, 4, 'proceduralStep', concat('<proceduralStep><para>Step of ', o_orderstatus, '</para></proceduralStep>') FROM orders UNION ALL SELECT o_orderkey, 5, 'note', '<note>Only a note</note>' FROM orders""",
    "transform_registry": """WITH o AS (SELECT o_orderkey, concat('DMC-M', o_custkey, '------', CASE WHEN o_orderkey % 2 = 0 THEN '040A' ELSE '999X' END, '-') AS dmc, CASE WHEN o_orderkey % 2 = 0 THEN '040A' ELSE '999X' END AS info, CASE WHEN o_orderkey % 5 = 0 THEN '02' ELSE '01' END AS sec,
            CAST(year(o_orderdate) AS VARCHAR) AS y, CAST(month(o_orderdate) AS VARCHAR) AS m, o_orderstatus, o_orderpriority, o_custkey, CASE WHEN o_orderkey % 3 > 0 THEN 'Given' END AS given FROM orders)
        SELECT o_orderkey, unnest(['dmc_assemble', 'dmc_from_dmref', 'date_from_attrs', 'text_extract', 'jats_author_name', 'join_text', 's1000d_security', 's1000d_info_code_to_type', 'dmc_raw_fields']) AS name,
            unnest([concat('{"v":[{"scheme":"URI","value":"', dmc, '"}]}'), concat('{"v":"', dmc, '"}'), concat('{"v":"', y, '-', lpad(m, 2, '0'), '-01"}'), concat('{"v":"', o_orderstatus, '"}'), concat('{"v":"', CASE WHEN given IS NULL THEN '' ELSE 'Given ' END, o_orderpriority, '"}'),
                concat('{"v":"', CASE WHEN given IS NULL THEN '' ELSE 'Given; ' END, o_orderpriority, '"}'), concat('{"v":{"accessRights":"', CASE WHEN sec = '01' THEN 'public' ELSE 'restricted' END, '","license":"', sec, '"}}'), concat('{"v":"', CASE WHEN info = '040A' THEN 'TechnicalReport' ELSE 'Procedure' END, '"}'),
                concat('{"v":{"modelIdentCode":"M', o_custkey, '","infoCode":"', info, '","year":"', y, '","month":"', m, '","securityClassification":"', sec, '"}}')]) AS value FROM o""",
    "model_terms": """SELECT p_partkey AS doc_id, CAST(1 AS INT) AS pos, p_name AS term, concat(p_type, ' of ', p_brand) AS definition_en, 'long words' AS definition_ko FROM part
        UNION ALL SELECT p_partkey, 2, 'size', CAST(p_size AS VARCHAR), NULL FROM part WHERE p_size % 2 = 0""",
    "model_metadata": """SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 3 = 0 THEN 'By rule' ELSE concat('Title of ', o_custkey) END AS dc_title, CASE WHEN o_orderkey % 2 = 0 THEN 'en' ELSE 'ko' END AS dc_language, strftime(o_orderdate, '%Y-%m-%d') AS created FROM orders""",
    "ingest_terms": """WITH t AS (SELECT o_custkey % 100 AS g, o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN concat('Definition number ', o_orderkey, ' of it') END AS d FROM orders WHERE length(concat('Order ', o_orderkey, ' - ', o_orderpriority)) > 20)
        SELECT 'promoted' AS place, concat('class/term_', g) AS key, arg_min(d, o_orderkey) AS text, CAST(1 AS BIGINT) AS n FROM t WHERE d IS NOT NULL AND g % 2 = 0 GROUP BY g
        UNION ALL SELECT 'landed', concat('class/term_', g), arg_max(coalesce(d, '[PENDING_DEFINITION]'), o_orderkey), 1 FROM t GROUP BY g
        UNION ALL SELECT 'record', CAST(o_orderkey AS VARCHAR), concat('Order ', o_orderkey, ' - ', o_orderpriority), 504 FROM orders""",
}
QUERIES = {
    f.__name__: f
    for f in (
        pdf_spans, pdf_blocks, structural_blocks, supplemented_blocks, front_matter, scanned_pages, deck_slides, sheet_records, scan_files, media_gate, parser_strategies, run_counters, applic_trees, catalog_relations, raw_fields, block_fragments,
        transform_registry, model_terms, model_metadata, ingest_terms, store_purge, stable_ids, korean_labels,
    )
}
