"""Paged documents end to end, and logs."""

import json
import logging

from pyspark.sql import functions as F

from docloom import tracing
from docloom.plans import paged
from docloom.session import option
from docloom.sources import xml

SPANS = "doc_id string, page int, block int, pos int, text string, size double, flags int, font string, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double"


def spans(spark):
    line = lambda page, block, text, size=10.0, flags=0, x0=20.0, y0=300.0: ("d", page, block, page * 100 + block, text, size, flags, "F", x0, y0, x0 + 100, y0 + 10, 400.0, 800.0)
    return spark.createDataFrame(
        [
            line(1, 1, "A Study of Wheels", 18.0, 16, 150.0, 50.0), line(1, 2, "Report NUREG/CR-5704 here", y0=400.0), line(2, 1, "1 Introduction", 16.0, 16), line(2, 2, "Plain words about wheels and such"), line(2, 3, "1.1 Scope", 15.0, 16),
            line(2, 4, "The fatigue life is given by N = C / S (3.1) where S is it"), line(3, 1, "2 Results", 16.0, 16), line(3, 2, "x = y + z (4)", y0=500.0), line(3, 3, "  "), line(3, 4, "More plain words in the end of it"),
        ],
        SPANS,
    )


def test_layout_source(spark):
    marks = spark.createDataFrame([("d", 1, 1, "2  RESULTS")], "doc_id string, pos int, depth int, title string")
    pages = spark.createDataFrame([("d", 1, "no contents")], "doc_id string, page int, text string")
    b = paged.layout_blocks(spans(spark), marks, pages).orderBy("pos").collect()
    assert [(r["block_type"], r["level"], len(r["context_path"])) for r in b] == [
        ("section", 1, 0), ("equation", 999, 1), ("section", 1, 0), ("paragraph", 999, 1), ("subsection", 2, 1), ("paragraph", 999, 2), ("equation", 999, 2), ("paragraph", 999, 2), ("section", 1, 0), ("equation", 999, 1), ("paragraph", 999, 1),
    ]
    assert [r["equation_data"]["equationNumber"] for r in b if r["block_type"] == "equation"] == ["", "3.1", "4"] and len({r["block_id"] for r in b}) == len(b)


ITEMS = "doc_id string, pos long, page int, label string, level int, text string, l double, b double, r double, t double, headers array<string>, rows array<array<string>>"


def test_structural_source_and_supplement(spark):
    items = spark.createDataFrame(
        [
            ("d", 1, 1, "title", 1, "A Study", 0.0, 700.0, 100.0, 720.0, None, None), ("d", 2, 1, "section_header", 2, "1.1 Scope", 0.0, 600.0, 100.0, 620.0, None, None), ("d", 3, 1, "text", None, "Plain words", 0.0, 580.0, 100.0, 590.0, None, None),
            ("d", 4, 1, "table", None, "", 0.0, 500.0, 100.0, 550.0, ["a", "b"], [["1", "2"]]), ("d", 5, 1, "text", None, " ", 0.0, 1.0, 2.0, 3.0, None, None), ("d", 6, 2, "section_header", 1, "End", 0.0, 600.0, 100.0, 620.0, None, None),
        ],
        ITEMS,
    )
    b = paged.structural_blocks(items)
    got = b.orderBy("pos").collect()
    assert [(r["block_type"], r["parent_pos"], r["section_label"]) for r in got] == [("title", None, None), ("section", 1, "1.1"), ("paragraph", 2, None), ("table", 2, None), ("section", None, None)]
    assert got[3]["text"] == "| a | b |\n| --- | --- |\n| 1 | 2 |" and got[3]["table_data"]["rows"] == [["1", "2"]]
    both = paged.supplemented(b, spans(spark)).orderBy("pos").collect()
    assert [(r["page"], r["block_type"]) for r in both][-1] == (3, "equation") and both[-1]["equation_data"]["latex"] == "x = y + z" and len(both) == len(got) + 1
    ocr = spark.createDataFrame([("d", 3, 20.0, 500.0, "x=y+z")], "doc_id string, page int, x0 double, y0 double, latex string")
    assert paged.supplemented(b, spans(spark), ocr).where("page = 3").first()["text"] == "x=y+z"


def test_front_metadata(spark):
    r = paged.front_metadata(spans(spark)).first()
    assert (r["dc_title"], [x["value"] for x in r["dc_identifier"]], r["dc_language"]) == ("A Study of Wheels", ["NUREG/CR-5704"], "en")
    model = spark.createDataFrame([("d", "Other", "Code")], "doc_id string, dc_title string, dc_type string")
    r = paged.front_metadata(spans(spark), model).first()
    assert (r["dc_title"], r["dc_type"]) == ("A Study of Wheels", "Code")


def test_logs_and_counters(spark):
    record = logging.LogRecord("n", logging.INFO, "f", 1, "hello %s", ("you",), None)
    with tracing.trace() as (t, s):
        line = json.loads(tracing.JsonLines().format(record))
        assert (line["message"], line["trace_id"], line["span_id"], len(t), len(s)) == ("hello you", t, s, 32, 16)
    files = spark.createDataFrame([("p", "a", b"<a>x</a>"), ("q", "b", b"<a>")], "path string, doc_id string, content binary")
    rows, seen = tracing.counted(xml.shred(files), "run")
    assert rows.agg(F.count("*")).first()[0] == 2 and seen.get == {"total": 2, "failed": 1}


def test_options(spark):
    spark.conf.set("spark.docloom.model", "m")
    assert option(spark, "model") == "m" and option(spark, "nothing", "x") == "x"
