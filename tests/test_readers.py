"""PDF files, presentations and workbooks: literal ones, broken ones, and those that Spark writes."""

import json
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.operators import layout, sections
from docloom.sources import files, office, pdf


def pdf_file(pages, *, compress=False, packed=False, table=True, extra="", more_pages=""):
    """A PDF of pages, each the operators of its content; fonts F1 (plain) and F2 (bold, with codes of its own)."""
    widths = " ".join(["500"] * 95)
    cmap = b"1 begincodespacerange <00> <FF> endcodespacerange 1 beginbfchar <41> <00E9> endbfchar 1 beginbfrange <42> <44> <0062> endbfrange"
    kids = " ".join(f"{10 + 2 * i} 0 R" for i in range(len(pages)))
    objects = {
        1: f"<</Type/Catalog/Pages 2 0 R{extra}>>", 2: f"<</Type/Pages/Kids[{kids}]/Count {len(pages)}/MediaBox[0 0 200 400]/Resources<</Font<</F1 3 0 R/F2 4 0 R/F3 6 0 R>>/XObject<</X 8 0 R>>>>{more_pages}>>",
        3: f"<</Type/Font/Subtype/Type1/BaseFont/Helvetica/FirstChar 32/LastChar 126/Widths[{widths}]/Encoding/WinAnsiEncoding>>",
        4: f"<</Type/Font/Subtype/TrueType/BaseFont/ABCDEF+Times-Bold/FirstChar 32/LastChar 126/Widths[{widths}]/ToUnicode 5 0 R/Encoding<</Differences[97/eacute/uni20AC]>>>>",
        5: (b"", cmap), 6: "<</Type/Font/Subtype/Type0/BaseFont/Wide/Encoding/Identity-H/DescendantFonts[7 0 R]/ToUnicode 9 0 R>>", 7: "<</Type/Font/Subtype/CIDFontType2/DW 1000/W[1[250 750] 5 6 400]>>",
        8: (b"/Type/XObject/Subtype/Form/Matrix[1 0 0 1 10 0]", b"BT /F1 10 Tf 0 50 Td (form) Tj ET"), 9: (b"", b"2 beginbfchar <0001> <D83DDE00> <0002> <0066006C> endbfchar"),
    }
    for i, p in enumerate(pages):
        objects[10 + 2 * i] = f"<</Type/Page/Parent 2 0 R/Contents {11 + 2 * i} 0 R>>"
        objects[11 + 2 * i] = (b"", p if isinstance(p, bytes) else p.encode("latin-1"))
    out, places, inside = bytearray(b"%PDF-1.5\n%\xe2\xe3\n"), {}, {}
    for n, body in objects.items():
        if isinstance(body, str) and packed and n != 1:
            inside[n] = body.encode()
            continue
        places[n] = len(out)
        if isinstance(body, tuple):
            head, data = body
            if compress:
                head, data = head + b"/Filter/FlateDecode", zlib.compress(data)
            out += b"%d 0 obj\n<<%s/Length %d>>\nstream\n" % (n, head, len(data)) + data + b"\nendstream\nendobj\n"
        else:
            out += f"{n} 0 obj\n{body}\nendobj\n".encode()
    size = max(objects) + 3
    if packed:
        at, heads, data = 0, [], b""
        for n, b in inside.items():
            heads.append(f"{n} {len(data)}")
            data += b + b" "
        head = " ".join(heads).encode() + b" "
        raw = zlib.compress(head + data)
        places[size - 2] = len(out)
        out += b"%d 0 obj<</Type/ObjStm/N %d/First %d/Filter/FlateDecode/Length %d>>stream\n" % (size - 2, len(inside), len(head), len(raw)) + raw + b"\nendstream endobj\n"
        at = len(out)
        places[size - 1] = at
        rows = []
        for n in range(size):
            rows.append(struct.pack(">BIB", 2, size - 2, list(inside).index(n)) if n in inside else struct.pack(">BIB", 1, places[n], 0) if n in places else struct.pack(">BIB", 0, 0, 0))
        predicted, before = b"", bytes(6)
        for r in rows:  # "up" of each row
            predicted += b"\2" + bytes((x - y) & 255 for x, y in zip(r, before))
            before = r
        raw = zlib.compress(predicted)
        out += b"%d 0 obj<</Type/XRef/Size %d/W[1 4 1]/Root 1 0 R/Filter/FlateDecode/DecodeParms<</Predictor 12/Columns 6>>/Length %d>>stream\n" % (size - 1, size, len(raw)) + raw + b"\nendstream endobj\n"
        return bytes(out) + b"startxref\n%d\n%%%%EOF" % at
    if not table:
        return bytes(out) + b"trailer<</Root 1 0 R>>"
    at = len(out)
    for n in range(size):
        out += (b"xref\n0 %d\n0000000000 65535 f \n" % size if n == 0 else b"") + (b"" if n == 0 else b"%010d 00000 %s \n" % (places.get(n, 0), b"n" if n in places else b"f"))
    return bytes(out) + b"trailer<</Size %d/Root 1 0 R>>\nstartxref\n%d\n%%%%EOF" % (size, at)


PAGE = """BT /F1 12 Tf 20 380 Td (Head) Tj 0 -14 Td (a \\(b\\) \\101\\\nc) Tj ET
q 2 0 0 2 0 0 cm BT /F2 5 Tf 1 0 0 1 10 100 Tm [(AB) -100 (C) -900 (ab)] TJ ET Q
BT /F1 10 Tf 12 TL 20 150 Td (one) ' (two) ' 2 0 (three) " ET BI /W 1 ID (not text) Tj EI /X Do BT /F3 10 Tf 20 20 Td <00010002> Tj ET"""
WANT = [
    ("Head", "Helvetica", 12.0, 0, 20.0, 44.0, 20.0), ("a (b) Ac", "Helvetica", 12.0, 0, 20.0, 68.0, 34.0), ("ébc é€", "Times-Bold", 10.0, 20, 20.0, None, 200.0),
    ("one", "Helvetica", 10.0, 0, 20.0, 35.0, 262.0), ("two", "Helvetica", 10.0, 0, 20.0, 35.0, 274.0), ("three", "Helvetica", 10.0, 0, 20.0, 45.0, 286.0),
    ("form", "Helvetica", 10.0, 0, 10.0, 30.0, 350.0), ("😀fl", "Wide", 10.0, 0, 20.0, 30.0, 380.0),
]


@pytest.mark.parametrize("how", [{}, {"compress": True}, {"packed": True, "compress": True}, {"table": False}])
def test_runs_of_literal_files(how):
    rows = [dict(zip(pdf.NAMES, r)) for r in pdf.parts_of("p", "d", pdf_file([PAGE, "BT ET"], **how))]
    runs = [(r["text"], r["font"], r["size"], r["flags"], r["x0"], r["x1"], r["base"]) for r in rows if r["kind"] == "run"]
    assert [(t, f, s, g, round(x, 6), b) for t, f, s, g, x, _, b in runs] == [(t, f, s, g, x, b) for t, f, s, g, x, _, b in WANT]
    assert all(w[5] is None or abs(r[5] - w[5]) < 1e-9 for r, w in zip(runs, WANT))
    assert [(r["page"], r["page_width"], r["page_height"]) for r in rows if r["kind"] == "page"] == [(1, 200.0, 400.0), (2, 200.0, 400.0)]
    assert not [r for r in rows if r["kind"] == "problem"]


def test_bookmarks_and_shares():
    outline = "/Outlines 100 0 R>>endobj 100 0 obj<</First 101 0 R>>endobj 101 0 obj<</Title(One)/Dest[10 0 R/Fit]/First 102 0 R/Next 103 0 R>>endobj 102 0 obj<</Title<FEFF00E9>/A<</S/GoTo/D[12 0 R/Fit]>>>>endobj 103 0 obj<</Title(Loop)/Next 101 0 R>>endobj 104 0 obj<<"
    data = pdf_file(["BT /F1 9 Tf (a) Tj ET", "BT /F1 9 Tf (b) Tj ET", "BT /F1 9 Tf (c) Tj ET"], table=False, extra=outline)
    rows = [dict(zip(pdf.NAMES, r)) for r in pdf.parts_of("p", "d", data)]
    assert [(r["depth"], r["text"], r["page"]) for r in rows if r["kind"] == "bookmark"] == [(1, "One", 1), (2, "é", 2), (1, "Loop", None)]
    shares = [list(pdf.parts_of("p", "d", data, (i, 2))) for i in range(2)]
    assert sorted(map(str, sum(shares, []))) == sorted(map(str, pdf.parts_of("p", "d", data)))


def test_broken_files_are_problems():
    good = pdf_file([PAGE], compress=True)
    kinds = lambda data: [r[2] for r in pdf.parts_of("p", "d", data)]
    assert kinds(b"") == kinds(b"plain text") == ["problem"]
    assert kinds(good.replace(b"/Root 1 0 R", b"/Root 1 0 R/Encrypt 3 0 R")) == ["problem"]
    assert kinds(good[:-200])[0] == "page"  # without references, objects are sought
    assert "problem" in kinds(good.replace(b"/Filter/FlateDecode", b"/Filter/JBIG2Decode"))
    assert kinds(good.replace(b"/Kids[10 0 R]", b"/Kids[ 2 0 R]")) == []  # a circle of pages
    assert kinds(good.replace(b"/Root 1 0 R", b"/Root 77 0 R").replace(b"/Type/Catalog", b"/Type/Cat")) == ["problem"]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 4000), st.binary(max_size=6), st.booleans())
def test_damaged_files_do_not_break_the_run(at, put, packed):
    data = pdf_file([PAGE], compress=True, packed=packed)
    at %= len(data)
    for r in pdf.parts_of("p", "d", data[:at] + put + data[at + len(put) :]):
        assert len(r) == len(pdf.NAMES)


def test_source_and_spans(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.pdf").write_bytes(pdf_file([f"BT /F1 10 Tf 20 380 Td (Doc {i}) Tj /F2 10 Tf 60 0 Td (abc) Tj /F1 10 Tf -60 -12 Td (next) Tj ( line) Tj 0 -40 Td (far) Tj ET"] * 3, compress=True))
    (tmp_path / "bad.PDF").write_bytes(b"no")
    (tmp_path / "other.txt").write_bytes(b"no")
    pdf.register(spark)
    source = spark.read.format("docloom_pdf").option("bytes", "1500").load(str(tmp_path))
    assert source.rdd.getNumPartitions() > 5 and source.where("kind = 'problem'").count() == 1
    scanned = pdf.read(files.scan(spark, f"file://{tmp_path}"))
    same = lambda d: sorted(map(tuple, d.selectExpr("element_at(split(path, '/'), -1)", *[c for c in pdf.NAMES if c not in ("path", "doc_id")]).collect()), key=str)
    assert same(source) == same(scanned)
    made = pdf.spans(scanned)
    one = [tuple(r) for r in made.where("path like '%/3.pdf' and page = 2").orderBy("pos").select("block", "pos", "text", "font", "flags", "x0", "x1").collect()]
    assert one == [(1, 1, "Doc 3", "Helvetica", 0, 20.0, 45.0), (1, 2, "é€c", "Times-Bold", 20, 80.0, 95.0), (1, 3, "next line", "Helvetica", 0, 20.0, 65.0), (2, 4, "far", "Helvetica", 0, 20.0, 35.0)]
    assert {r["text"] for r in pdf.page_texts(made).where("page = 1").collect()} == {f"Doc {i}\né€c\nnext line\nfar" for i in range(5)}
    assert [r["type"] for r in pdf.problems(scanned).collect()] == ["pdf-syntax"]


def test_spans_feed_the_paged_plan(spark, tmp_path):
    from docloom.plans import paged

    body = "".join(f"BT /F1 10 Tf 20 {300 - 40 * k} Td (Plain words number {k} of the page.) Tj ET\n" for k in range(5))
    (tmp_path / "a.pdf").write_bytes(pdf_file([f"BT /F1 18 Tf 20 370 Td (1 OPENING) Tj ET\n{body}"]))
    parts = pdf.read(files.scan(spark, f"file://{tmp_path}"))
    made = pdf.spans(parts)
    blocks = paged.layout_blocks(made, pdf.bookmarks(parts), pdf.page_texts(made)).orderBy("pos").collect()
    assert [(b["block_type"], b["text"]) for b in blocks][:2] == [("section", "1 OPENING"), ("paragraph", "Plain words number 0 of the page.")]
    assert len(blocks) == 6 and all(b["parent_pos"] == 1 for b in blocks[1:])


# ---------------------------------------------------------------- slides and sheets


def test_slides_in_the_presentations_order(spark, tmp_path):
    held = [[(True, "First"), (False, "a\nb"), (False, " ")], [(False, "only <text> & more")], [(False, "x"), (True, "Last")]]
    (tmp_path / "deck.pptx").write_bytes(office.slides_bytes(held))
    (tmp_path / "broken.pptx").write_bytes(b"PK no")
    scanned = office.shapes(files.scan(spark, f"file://{tmp_path}", "*.pptx"))
    office.register(spark)
    source = spark.read.format("docloom_slides").load(str(tmp_path))
    for shapes in (scanned, source):
        assert shapes.where("problem is not null").count() == 1
        got = sorted(tuple(r)[1:] for r in files.slides(shapes.where("problem is null")).collect())
        assert got == [(1, "First", "a\nb"), (2, None, "only <text> & more"), (3, "Last", "x")]
    assert [r["status"] for r in office.problems(scanned).collect()] == [400]


def test_sheets_to_records(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = office._relations
    (tmp_path / "w.xlsx").write_bytes(office.zipped({
        "_rels/.rels": rel([("officeDocument", "/xl/workbook.xml")]),
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{office.REL}"><sheets><sheet name="B" r:id="rId2"/><sheet name="A" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": rel([("worksheet", "worksheets/one.xml"), ("worksheet", "worksheets/two.xml"), ("sharedStrings", "sharedStrings.xml")]),
        "xl/sharedStrings.xml": f"<sst {main}><si><t>name</t></si><si><r><t>rich </t></r><r><t>text</t></r></si></sst>",
        "xl/worksheets/one.xml": f'<worksheet {main}><sheetData><row/><row r="3"><c r="A3" t="s"><v>0</v></c><c r="C3" t="s"><v>0</v></c></row><row r="4"><c r="A4" t="s"><v>1</v></c><c r="B4"><f>1+1</f><v>2</v></c><c r="C4" t="b"><v>1</v></c></row><row r="5"/></sheetData></worksheet>',
        "xl/worksheets/two.xml": f'<worksheet {main}><sheetData><row><c t="inlineStr"><is><t>k</t></is></c></row><row><c t="str"><v>v</v></c></row></sheetData></worksheet>',
    }))
    rows = office.sheets(files.scan(spark, f"file://{tmp_path}", "*.xlsx")).orderBy("sheet_pos", "row").collect()
    assert [(r["sheet"], r["row"], json.loads(r["record"])) for r in rows] == [("B", 1, {"k": "v"}), ("A", 1, {"name": "rich text", "B": "2", "C": "TRUE"}), ("A", 2, {"name": "", "B": "", "C": ""})]
    assert [office.column_number(office.column_letter(n)) for n in (0, 25, 26, 701, 702, 16383)] == [0, 25, 26, 701, 702, 16383]


def test_sheets_that_spark_writes(spark):
    table = spark.createDataFrame([("x", 1, "a&b", None), ("x", 2, "", 2.5), ("y", 3, "é <", 1.0)], "k string, n int, t string, v double")
    made = office.as_sheets(table, ["k"]).selectExpr("k as path", "k as doc_id", "content")
    got = sorted((r["path"], json.loads(r["record"])["n"], json.loads(r["record"])["t"], json.loads(r["record"])["v"]) for r in office.sheets(made).collect())
    assert got == [("x", "1", "a&b", ""), ("x", "2", "", "2.5"), ("y", "3", "é <", "1.0")]


def test_pages_share_fonts(monkeypatch):
    made, init = [], pdf.Font.__init__
    monkeypatch.setattr(pdf.Font, "__init__", lambda self, p, d: (made.append(1), init(self, p, d))[1])
    page = lambda n: b"%d 0 obj\n<</Type/Page/Parent 2 0 R/Contents 9 0 R>>\nendobj\n" % n
    data = (
        b"%PDF-1.4\n1 0 obj\n<</Type/Catalog/Pages 2 0 R>>\nendobj\n2 0 obj\n<</Type/Pages/MediaBox[0 0 9 9]/Resources<</Font<</F1 3 0 R>>>>/Kids[5 0 R 6 0 R]>>\nendobj\n"
        b"3 0 obj\n<</Type/Font/Subtype/Type1/BaseFont/Helvetica>>\nendobj\n" + page(5) + page(6) + b"9 0 obj\n<</Length 23>>\nstream\nBT /F1 5 Tf (a(b)) Tj ET\nendstream\nendobj\ntrailer\n<</Root 1 0 R>>\n"
    )
    runs = [r for r in pdf.parts_of("p", "d", data) if r[2] == "run"]
    assert [(r[3], r[5]) for r in runs] == [(1, "a(b)"), (2, "a(b)")] and len(made) == 1


def test_spans_told_while_a_page_is_read_are_those_of_windows(spark):
    """spans of a file's runs by a scan of each page, and by windows over all runs; without a shuffle."""
    pages = [
        PAGE, "BT ET", "BT /F1 10 Tf 20 300 Td (a) Tj 30 0 Td (b) Tj 200 0 Td (c) Tj 0 -12 Td (next) Tj -230 -2 Td () Tj (x ) Tj 1 0 Td (y) Tj /F1 10.04 Tf (z) Tj /F1 12 Tf (w) Tj 0 -40 Td (far) Tj 0 90 Td (up) Tj ET",
        "BT /F1 10 Tf 20 300 Td (one) Tj 17 0 Td (two) Tj 14 0 Td ( three) Tj -100 0 Td (back) Tj ET",
    ]
    d = spark.createDataFrame([("p", "d", pdf_file(pages)), ("q", "e", b"none")], "path string, doc_id string, content binary")
    made = pdf.read(d, spanned=True)
    want = pdf.spans(pdf.read(d))
    assert len(want.collect()) > 12 and sorted(map(tuple, want.select(*pdf.spans(made).columns).collect()), key=str) == sorted(map(tuple, pdf.spans(made).collect()), key=str)
    assert "Exchange" not in pdf.spans(made)._jdf.queryExecution().executedPlan().toString() and [r["instance"] for r in pdf.problems(made).collect()] == ["q"]


def test_only_possible_contents_pages_are_gathered(spark):
    """pages with the words of a contents list in a span are those that toc_entries reads; the rest is left out."""
    rows = [("d", 1, 1, 1, "Plain words"), ("d", 2, 1, 1, "Table of CONTENTS"), ("d", 2, 2, 2, "1 Start ....... 3"), ("d", 17, 1, 1, "contents"), ("e", 1, 1, 1, "목차"), ("e", 1, 1, 2, "2 End .... 9")]
    s = spark.createDataFrame(rows, "doc_id string, page int, block int, pos long, text string")
    assert {(r["doc_id"], r["page"]) for r in pdf.contents_pages(s).collect()} == {("d", 2), ("e", 1)}
    entries = lambda p: sorted(map(tuple, sections.toc_entries(p).collect()))
    assert entries(pdf.contents_pages(s)) == entries(pdf.page_texts(s)) != []


def test_whole_blocks_are_features_and_boxes(spark):
    """one aggregate gives what block_features, the boxes and their join do."""
    rows = [("d", 1, b, p, t, z, f, n, float(p), 2.0, p + 5.0, 9.0, 400.0, 800.0) for b, p, t, z, f, n in (
        (1, 1, "a", 9.0, 0, "F"), (1, 2, " ", 8.0, 16, "G"), (1, 3, "b", 11.0, 0, "G"), (1, 4, "c", 9.0, 0, "G"), (2, 5, " ", 9.0, 0, "F"), (3, 6, "x", 9.0, 0, "H"), (3, 7, "y", 9.0, 0, "F"), (4, 8, "z", 9.0, 0, None))]
    s = spark.createDataFrame(rows, "doc_id string, page int, block int, pos long, text string, size double, flags int, font string, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double")
    keys = ["doc_id", "page", "block"]
    box = s.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.first("page_width").alias("page_width"), F.first("page_height").alias("page_height"))
    want = layout.block_features(s, keys).join(box, keys)
    got = layout.whole_blocks(s, keys)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) and got.count() == 3
    want = layout.block_features(s.where("trim(text) <> ''"), keys).join(box, keys)
    assert sorted(map(str, layout.whole_blocks(s, keys, blanks=False).select(*want.columns).collect())) == sorted(map(str, want.collect()))
