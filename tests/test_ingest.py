"""XML documents, catalogs, schemas, stores and the ingestion plan, batch and incremental."""

import json
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docloom.operators import docs, tree, validate
from docloom.operators.store import Store
from docloom.plans import catalogs, pipeline
from docloom.sources import files, providers, xml
from docloom.streaming import ingest as incremental

MODULE = """<?xml version="1.0"?><dmodule><identAndStatusSection><dmAddress><dmIdent>
<dmCode modelIdentCode="CYCLE" systemDiffCode="AAA" systemCode="DA1" subSystemCode="2" subSubSystemCode="0" assyCode="00" disassyCode="00" disassyCodeVariant="A" infoCode="720" infoCodeVariant="A" itemLocationCode="A"/>
<issueInfo issueNumber="002" inWork="01"/></dmIdent><dmAddressItems><issueDate year="2023" month="5" day="9"/><dmTitle><techName>Cycle</techName><infoName>Care</infoName></dmTitle></dmAddressItems></dmAddress>
<dmStatus issueType="changed"><security securityClassification="01"/><responsiblePartnerCompany><enterpriseName>Wheel Works</enterpriseName></responsiblePartnerCompany>
<applicCrossRefTableRef><dmRef><dmRefIdent><dmCode modelIdentCode="T"/></dmRefIdent></dmRef></applicCrossRefTableRef><brexDmRef><dmRef><dmRefIdent><dmCode modelIdentCode="B"/></dmRefIdent></dmRef></brexDmRef>
<applic id="app-1"><displayText><simplePara>Both kinds</simplePara></displayText><evaluate andOr="or"><assert applicPropertyIdent="type" applicPropertyType="prodattr" applicPropertyValues="a"/><evaluate><assert applicPropertyIdent="size"/></evaluate></evaluate></applic>
<skillLevel skillLevelCode="sk01"/><qualityAssurance><firstVerification verificationType="tabtop"/></qualityAssurance></dmStatus></identAndStatusSection>
<content><procedure><preliminaryRqmts><noConds/><noSafety/></preliminaryRqmts><mainProcedure><levelledPara><title>1.1 Daily care</title><warning><para>Hot parts</para></warning><note><notePara>Mind the chain</notePara></note>
<proceduralStep><note>Left over</note></proceduralStep>
<proceduralStep applicRefId="app-1"><para>Tighten the <b>bolt</b></para><reqCondNo id="c1">Lamp on</reqCondNo><supportEquipDescr>Wrench</supportEquipDescr><torque><torqueValue>12.5</torqueValue><torqueUnit>Nm</torqueUnit></torque></proceduralStep>
</levelledPara></mainProcedure><closeRqmts><noSupplies/></closeRqmts></procedure></content></dmodule>"""
ARTICLE = """<article><front><article-meta><article-id pub-id-type="doi">10.1/x</article-id><title-group><article-title>On Wheels</article-title></title-group><contrib-group><contrib contrib-type="author"><name><surname>Doe</surname><given-names>Kim</given-names></name></contrib></contrib-group></article-meta></front>
<body><sec><title>2 Method</title><p>As shown <xref ref-type="bibr" rid="r1">[1]</xref> before.</p><sec><title>Inner</title><disp-formula>a = b</disp-formula><table-wrap>1 2</table-wrap></sec></sec></body><back><ref-list><ref id="r1">Smith</ref></ref-list></back></article>"""


def parsed(data, name="d"):
    return xml.parse("p", name, data.encode() if isinstance(data, str) else data)


def test_module_golden():
    r = parsed(MODULE)
    kinds = [b["block_type"] for b in r["blocks"]]
    assert kinds == ["title", "section", "section", "warning", "note", "note", "procedureStep", "section"]
    title, pre, sec, warn, note, left, step, close = r["blocks"]
    assert title["text"] == "Cycle - Care" and json.loads(title["structured_content"])["s1000d_dmCode"]["infoCode"] == "720"
    assert [c["type"] for c in json.loads(pre["structured_content"])["conditions"]] == ["condition", "safety"]
    assert (sec["section_label"], sec["section_title"], sec["level"]) == ("1.1", "Daily care", 1)
    assert warn["parent_id"] == note["parent_id"] == left["parent_id"] == step["parent_id"] == sec["block_id"] and close["parent_id"] is None
    held = json.loads(step["structured_content"])
    assert step["text"] == "Tighten the bolt Torque: 12.5 Nm" and [c["type"] for c in held["conditions"]] == ["required_condition", "support_equipment"] and held["actions"][0]["parameters"] == {"torqueValue": 12.5, "torqueUnit": "Nm"}
    assert held["applicTree"]["evaluateTree"]["andOr"] == "or" and held["applicTree"]["evaluateTree"]["children"][1]["children"][0]["ident"] == "size"
    assert step["source_xpath"].endswith("/levelledPara/proceduralStep[2]") and step["xml_fragment"].startswith("<proceduralStep")
    assert [(x["relation_type"], x["target"]) for x in r["relations"]] == [("custom:GOVERNED_BY_APPLIC", "DMC-T-------"), ("custom:COMPLIES_WITH", "DMC-B-------")]


def test_module_metadata():
    m = parsed(MODULE)["metadata"]
    assert (m["dc_title"], m["dc_type"], m["dc_description"]) == ("Cycle - Care", "Procedure", "Skill Level: sk01; Verification: tabtop")
    assert m["dc_identifier"] == [{"scheme": "URI", "value": "DMC-CYCLE-AAA-DA1-20-00-00A-720A-A_002-01"}] and m["dc_date"] == {"issued": "2023-05-09"}
    assert m["dc_rights"] == {"accessRights": "public", "license": "01"} and m["dc_creator"][0]["name"] == "Wheel Works" and m["doc_status"] is None
    assert json.loads(m["dc_coverage"])["displayText"] == "Both kinds"


def test_article():
    r = parsed(ARTICLE)
    assert [(b["block_type"], b["level"]) for b in r["blocks"]] == [("title", 0), ("section", 1), ("paragraph", 999), ("section", 2), ("equation", 999), ("table", 999), ("section", 1)]
    assert [(x["relation_type"], x["target"], x["confidence"]) for x in r["relations"]] == [("CITES", "#r1", 0.9), ("CITES", "#r1", 1.0)]
    assert r["blocks"][4]["context_path"] == ["2 Method", "Inner"] and r["metadata"]["dc_creator"][0]["name"] == "Kim Doe" and r["metadata"]["dc_type"] == "JournalArticle" and r["metadata"]["dc_identifier"][0]["scheme"] == "DOI"


def test_generic_and_malformed():
    assert [b["text"] for b in parsed("<root> some <x>text</x> </root>")["blocks"]] == ["some text"]
    bad = parsed("<root>unclosed")
    assert bad["error"] and bad["blocks"] == [] and bad["metadata"] is None
    dc = parsed('<root xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>T</dc:title><dc:subject>a - b</dc:subject><dc:type>Nonsense</dc:type></root>')["metadata"]
    assert (dc["dc_title"], dc["dc_subject"], dc["dc_type"]) == ("T", ["a", "b"], None)


def test_deep_trees_do_not_overflow():
    deep = "<article><body>" + "<sec><title>t</title>" * 3000 + "</sec>" * 3000 + "</body></article>"
    import sys

    assert sys.getrecursionlimit() < 3000
    from xml.etree import ElementTree as ET

    s = xml.Shredder(ET.fromstring(deep), "d", "jats")
    s.path = lambda el: ""  # paths of 3000 steps for 3000 blocks are not the point here
    xml_fragment = ET.tostring
    try:
        ET.tostring = lambda *a, **k: ""
        s.run()
    finally:
        ET.tostring = xml_fragment
    assert len(s.blocks) == 3000 and s.blocks[-1]["level"] == 3000


@pytest.mark.parametrize("tag,want", [("dmodule", "s1000d"), ("Article", "jats"), ("equipment", "jats"), ("root", None)])
def test_catalog_detection(tag, want):
    assert catalogs.detect(tag) == want


def test_yaml_catalogs():
    name, c = catalogs.from_yaml("format_id: own\ndetect: {root_tag_contains: memo}\nmetadata:\n  dc_title: {xpath: './/head'}\ncontent:\n  mappings:\n    - {tag: P, block_type: paragraph, prefix: '> '}\n    - {tag: [warn], block_type_from_tag: true}\n")
    assert name == "own" and c["detect"] == ["memo"] and c["metadata"]["dc_title"] == [{"xpath": ".//head"}] and [r["block"] for r in c["content"]] == ["paragraph", None]
    assert catalogs.from_yaml("a: 1") is None and catalogs.detect("memorandum", {name: c}) == "own"


def test_schema_errors_are_actionable(spark):
    doc = {"documentId": "D 1", "$schema": "s", "version": "1.0.0", "metadata": {"dc:type": "Code", "dc:language": "en"}, "content": [{"blockId": "b", "blockType": "INVALID_TYPE", "text": "t"}], "relations": [{"relationType": "custom:x", "target": "t"}, {"relationType": "??", "target": "t"}], "odd": 1}
    rows = spark.createDataFrame([(json.dumps(doc),), ("not json",), ("{}",)], "j string").select(validate.json_errors("doc", "D1")("j").alias("e")).collect()
    assert [(e["target"], e["validator"]) for e in rows[0]["e"]] == [("D1", "additionalProperties"), ("content[0].blockType", "enum"), ("documentId", "pattern"), ("metadata", "required"), ("relations[1].relationType", "oneOf")]
    assert all(e["detail"] and e["code"] == "DOC_SCHEMA_VALIDATION_FAILED" for r in rows for e in r["e"]) and len(rows[1]["e"]) == 1 and len(rows[2]["e"]) == 5


_TYPES = {
    "object": lambda x: isinstance(x, dict), "array": lambda x: isinstance(x, list), "string": lambda x: isinstance(x, str), "boolean": lambda x: isinstance(x, bool), "null": lambda x: x is None,
    "number": lambda x: isinstance(x, (int, float)) and not isinstance(x, bool), "integer": lambda x: (isinstance(x, int) and not isinstance(x, bool)) or (isinstance(x, float) and x.is_integer()),
}


def walk(schema: dict, value, path: str = ""):
    """(path, validator, expected, value) of every violation; content[0].x is how a path reads."""
    kinds = schema.get("type")
    if kinds is not None:
        if not any(_TYPES[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
            yield path, "type", kinds, value
            return
    if "enum" in schema and value not in schema["enum"]:
        yield path, "enum", schema["enum"], value
    if "oneOf" in schema and sum(not any(walk(s, value)) for s in schema["oneOf"]) != 1:
        yield path, "oneOf", None, value
    if isinstance(value, str):
        if "pattern" in schema and not re.search(schema["pattern"], value):
            yield path, "pattern", schema["pattern"], value
        if len(value) < schema.get("minLength", 0):
            yield path, "minLength", schema["minLength"], value
    if _TYPES["number"](value):
        if "minimum" in schema and value < schema["minimum"]:
            yield path, "minimum", schema["minimum"], value
        if "maximum" in schema and value > schema["maximum"]:
            yield path, "maximum", schema["maximum"], value
    if isinstance(value, dict):
        for name in schema.get("required", ()):
            if name not in value:
                yield path, "required", name, None
        known = schema.get("properties", {})
        for name, v in value.items():
            if name in known:
                yield from walk(known[name], v, f"{path}.{name}" if path else name)
            elif schema.get("additionalProperties") is False:
                yield path, "additionalProperties", False, name
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            yield from walk(schema["items"], v, f"{path}[{i}]")


def odd_values(schema, rng, depth=0):
    """A JSON value that mostly fits a schema."""
    if rng.random() < 0.08:
        return rng.choice([None, True, 0, -3, 2.0, 1.5, 1e300, 12345678901234567890, "", "x", "é" * 12, [], [1], {}, {"a": None}, [["x"]]])
    if "oneOf" in schema:
        schema = rng.choice(schema["oneOf"])
    kind = schema.get("type", "string")
    kind = kind if isinstance(kind, str) else rng.choice(kind)
    if "enum" in schema:
        return rng.choice([*schema["enum"], "other"])
    if kind == "object":
        names = [*schema.get("properties", {})]
        keep = [n for n in names if n in schema.get("required", ()) and rng.random() < 0.93 or rng.random() < 0.5]
        out = {n: odd_values(schema["properties"][n], rng, depth + 1) for n in keep}
        return out | ({"odd key's": 1} if rng.random() < 0.15 else {})
    if kind == "array":
        return [odd_values(schema.get("items", {}), rng, depth + 1) for _ in range(rng.randrange(4))]
    return {"string": rng.choice(["a-b", "1.0.0", "1.2", "en", "term:class:x", "custom:a.b", "long enough text", "x", "日本"]), "number": rng.choice([0.5, 1, -0.1, 2]), "integer": rng.choice([0, 3, -1, 2.0, 2.5]), "boolean": True, "null": None}[kind]


@pytest.mark.parametrize("kind,schema", [("doc", validate.DOC_SCHEMA), ("term", validate.TERM_SCHEMA)])
def test_compiled_schemas_find_what_walking_finds(spark, kind, schema):
    """Records of all sorts of faults: the compiled expression against a plain walk, with no Python in its plan."""
    rng = random.Random(11)
    records = [odd_values(schema, rng) for _ in range(600)] + [None, 1, "x", [], {}]
    texts = [json.dumps(r, ensure_ascii=False) for r in records] + ["not json", "", None, "{"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string").repartition(2).select("i", validate.json_errors(kind)("j").alias("e"))
    assert not any(x in df._jdf.queryExecution().toString() for x in ("Python", "Pandas", "Arrow"))
    found = 0
    for r in df.collect():
        try:
            want = [(p or "<record>", k, json.dumps(e, ensure_ascii=False)) for p, k, e, _ in sorted(walk(schema, json.loads(texts[r["i"]])), key=lambda x: x[0])]
        except (TypeError, ValueError):
            want = [("<record>", "json", '"a JSON document"')]
        got = [(e["target"], e["validator"], e["expected"]) for e in r["e"]]
        assert sorted(got) == sorted(want) and [t for t, *_ in got] == [t for t, *_ in want], texts[r["i"]]
        assert all(e["detail"].endswith(f" fails {e['validator']}") and e["actual"] for e in r["e"])
        found += len(got)
    assert found > 600


def test_actual_values_are_told_as_json(spark):
    record = {"type": "odd \"one\"", "termId": 5, "x\ny": 1}
    e = spark.createDataFrame([(json.dumps(record),)], "j string").select(validate.json_errors("term")("j").alias("e")).first()["e"]
    told = {(x["target"], x["validator"]): x["actual"] for x in e}
    assert told["type", "enum"] == '"odd \\"one\\""' and told["termId", "type"] == "5" and told["<record>", "additionalProperties"] == '"x\\ny"'


def test_documents_are_expanded_by_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(xml, "AT_ONCE", 4)
    monkeypatch.setattr(xml, "BYTES_AT_ONCE", 10)
    sizes = [1, 2, 3, 4, 5, 50, 0, None, 1, 1, 1, 1]
    batch = pa.record_batch({"content": pa.array([None if n is None else b"x" * n for n in sizes], pa.binary())})
    parts = [[None if x is None else len(x) for x in b.column("content").to_pylist()] for b in xml.few(batch)]
    assert parts == [[1, 2, 3, 4], [5], [50], [0, None, 1, 1], [1, 1]] and sum(parts, []) == sizes
    assert list(xml.few(batch.slice(0, 0))) == []


def test_relation_vocabulary(spark):
    df = spark.createDataFrame([("CITES",), ("custom:A_b",), ("custom:",), ("cites",), (None,)], "relation_type string")
    assert [r[0] for r in df.select(validate.relation_ok()).collect()] == [True, True, False, False, False]


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.xml").write_text(MODULE)
    (d / "b.XML").write_text(ARTICLE)
    (d / "bad.xml").write_text("<root>unclosed")
    (d / "note.txt").write_text("no")
    return d


def test_ingest_and_store(spark, folder, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    r = pipeline.ingest_folder(spark, f"file://{folder}", "2024-01-01T00:00:00Z", target=store)
    assert tuple(r.summary().first()) == (2, 0, 2) and r.warnings == [providers.FALLBACK_WARNING]
    assert {p["type"] for p in r.problems.collect()} == {"xml-syntax", "term-missing-fields"}
    assert tree.orphans(r.blocks).count() == 0
    assert r.relations.withColumn("ok", validate.relation_ok()).where("not ok").count() == 0
    assert set(store.views()) == {"landing_docs", "landing_terms", "ssot_docs", "ssot_terms", "fragments", "problems"}
    assert spark.sql("SELECT count(*) FROM ssot_docs d LATERAL VIEW explode(content) c AS x WHERE x.blockType = 'note'").first()[0] == 2
    before = store.read("ssot_docs").select("documentId").collect()
    pipeline.ingest_folder(spark, f"file://{folder}", "2024-01-02T00:00:00Z", target=store)
    assert sorted(before) == sorted(store.read("ssot_docs").select("documentId").collect()) and {x[0] for x in store.read("ssot_docs").select("lastUpdated").collect()} == {"2024-01-02T00:00:00Z"}
    ids = spark.createDataFrame([("nothing",)], "block_id string")
    assert store.fragments(ids).first()["xml_fragment"] is None and store.read("fragments").count() == 12
    store.purge("problems")
    assert not store.exists("problems")


def test_provider_terms(spark, folder, tmp_path):
    spark.createDataFrame(
        [("x", 1, "Fatigue", "TERM-CLASS", None, None, "Damage by cyclic loads", "반복 하중에 의한 손상과 파괴", None, None), ("x", 2, "Fatigue", "TERM-CLASS", None, None, None, "", None, None)],
        "doc_id string, pos int, term string, term_type string, headword_en string, headword_ko string, definition_en string, definition_ko string, domain array<string>, context string",
    ).createOrReplaceTempView("given_terms")

    class Given(providers.TableProvider):
        def terms(self, chunks):
            return self.spark.table("given_terms")

    r = pipeline.ingest_folder(spark, f"file://{folder}", "now", provider=Given(spark))
    assert [t["term_id"] for t in r.terms.collect()] == ["term:class:fatigue"] and r.warnings == []


def test_incremental_is_idempotent(spark, folder, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    for _ in range(2):
        incremental.start(spark, f"file://{folder}", store, f"{tmp_path}/ck", lambda: "t1").awaitTermination()
    assert store.read("ssot_docs").count() == 2
    (folder / "c.xml").write_text(ARTICLE.replace("Wheels", "Spokes"))
    incremental.start(spark, f"file://{folder}", store, f"{tmp_path}/ck", lambda: "t2").awaitTermination()
    assert store.read("ssot_docs").count() == 3


def table_bytes(store, table):
    return {str(f): f.stat().st_size for f in Path(store.root.removeprefix("file://"), table).rglob("*.parquet")}


def test_upsert_writes_its_own_rows_alone(spark, tmp_path):
    """What an upsert of a few rows writes does not grow with the table, and readers of before still read."""
    wrote = []
    for n in (100, 20_000):
        store = Store(spark, f"file://{tmp_path}/s{n}")
        rows = lambda lo, hi, v: spark.range(lo, hi).select("id", F.lit(v).alias("v"))
        store.upsert("t", rows(0, n, 1), ["id"], ["v"])
        opened, before = store.read("t"), table_bytes(store, "t")
        store.upsert("t", rows(5, 8, 2), ["id"], ["v"])
        after = table_bytes(store, "t")
        assert before.items() <= after.items()
        wrote.append(sum(size for f, size in after.items() if f not in before))
        assert opened.where("v = 2").isEmpty() and opened.count() == n
        assert {r["id"]: r["v"] for r in store.read("t").collect()} == {i: 2 if 5 <= i < 8 else 1 for i in range(n)}
        assert [tuple(r) for r in store.lookup("t", spark.range(7, 9)).orderBy("id").collect()] == [(7, 2), (8, 1)]
        assert store.lookup("t", spark.range(0, n), most=10).count() == n
    assert wrote[0] == wrote[1]


def test_segments_are_merged_by_levels(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s", fan=3)
    want = {}
    for v in range(11):
        store.upsert("t", spark.range(v % 4, v % 4 + 2).select("id", F.lit(v).alias("v")), ["id"], ["v"])
        want |= {v % 4: v, v % 4 + 1: v}
        assert {r["id"]: r["v"] for r in store.read("t").collect()} == want
    assert [s["level"] for s in store._commit("t")["segments"]] == [2, 0, 0]  # 9 rows of one, and two more
    store.upsert("t", spark.range(0).select("id", F.lit(1).alias("v")), ["id"], ["v"])
    assert store.read("t").count() == len(want)
    store.compact("t", whole=True)
    assert len(store._commit("t")["segments"]) == 1 and {r["id"]: r["v"] for r in store.read("t").collect()} == want
    opened = store.read("t")
    assert store.vacuum("t") == 0 and store.vacuum("t", 0) > 0 and len(store._numbers("t")) == 1
    assert opened.count() == len(want)
    with pytest.raises(ValueError):
        store.upsert("t", spark.range(1).select("id", F.lit(1).alias("v")), ["v"], ["id"])


def test_a_later_upsert_may_bring_columns(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.upsert("t", spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), ["id"], ["v"])
    store.upsert("t", spark.createDataFrame([(2, "c", 5)], "id long, v string, more int"), ["id"], ["v"])
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a", None), (2, "c", 5)]


@pytest.mark.parametrize("held_at", ["before", "after"])
def test_two_writers_lose_nothing(spark, tmp_path, held_at):
    """A writer held between its segment and its commit, or with the commit written beside the log: the other's rows and
    its own are both there, and its segment is not written again."""
    one, two = (Store(spark, f"file://{tmp_path}/s") for _ in range(2))
    rows = lambda k: spark.createDataFrame([(k, 1)], "k string, v long")
    one.upsert("t", rows("a"), ["k"], ["v"])
    plain, between, create = one._put, [], one.fs

    def late(table, commit, number):
        if not between:
            between.append(1)
            if held_at == "after":  # half a commit lies beside the log
                Path(tmp_path, "s", "t", "_commits", ".half").write_text('{"schema": ')
            two.upsert("t", rows("b"), ["k"], ["v"])
            two.upsert("t", rows("d"), ["k"], ["v"])
        return plain(table, commit, number)

    one._put = late
    one.upsert("t", rows("c"), ["k"], ["v"])
    assert create is one.fs and {r["k"] for r in two.read("t").collect()} == {"a", "b", "c", "d"}
    assert len(list(Path(tmp_path, "s", "t", "data").iterdir())) == 4


def test_a_merge_that_was_overtaken_is_dropped(spark, tmp_path):
    one, two = (Store(spark, f"file://{tmp_path}/s", fan=100) for _ in range(2))
    for k in range(4):
        one.upsert("t", spark.createDataFrame([(k, 1)], "k long, v long"), ["k"], ["v"])
    plain, between = one._segment, []

    def late(*args):
        made = plain(*args)
        if not between:
            between.append(1)
            two.compact("t", whole=True)
        return made

    one._segment = late
    one.compact("t", whole=True)
    assert {r["k"] for r in one.read("t").collect()} == {0, 1, 2, 3} and len(one._commit("t")["segments"]) == 1


def test_problems_of_all_batches_stay(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    bad = lambda name: spark.createDataFrame([(f"/{name}", name, b"<broken")], "path string, doc_id string, content binary")
    for name in ("a", "b", "b"):
        pipeline.ingest(spark, bad(name), "2024-01-01T00:00:00Z", target=store)
    assert sorted(r["instance"] for r in store.read("problems").where("type = 'xml-syntax'").collect()) == ["a", "b"]


def test_upsert_last_wins(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    rows = lambda *x: spark.createDataFrame(list(x), "k string, v int")
    store.upsert("t", rows(("a", 1), ("a", 2), ("b", 1)), ["k"], ["v"])
    store.upsert("t", rows(("a", 0), ("c", 5)), ["k"], ["v"])
    assert sorted(map(tuple, store.read("t").collect())) == [("a", 0), ("b", 1), ("c", 5)]


def test_media_gate_records_and_flatten(spark):
    ok, bad = files.media_problems(spark.createDataFrame([("a", "application/pdf"), ("b", "text/html"), ("c", None)], "path string, content_type string"))
    assert [r["path"] for r in ok.collect()] == ["a"] and {r["status"] for r in bad.collect()} == {415}
    t = spark.createDataFrame([(1, ("x", (None,)))], "a int, s struct<b:string, t:struct<c:int>>")
    assert files.flatten(t).columns == ["a", "s.b", "s.t.c"]
    assert [json.loads(r[0]) for r in files.records(spark.createDataFrame([(1, None)], "a int, b string")).collect()] == [{"a": "1", "b": ""}]
    s = spark.createDataFrame([("f", 1, 1, True, "Head"), ("f", 1, 2, False, "x"), ("f", 1, 3, False, "y"), ("f", 1, 4, False, " ")], "path string, slide int, pos int, is_title boolean, text string")
    assert tuple(files.slides(s).first()) == ("f", 1, "Head", "x\ny")


def test_scan_takes_four_globs(spark, folder):
    assert sorted(r["suffix"] for r in files.scan(spark, f"file://{folder}").collect()) == ["xml"] * 3
    assert files.scan(spark, f"file://{folder}").select("doc_id").distinct().count() == 3
    paths = [r["path"] for r in files.scan(spark, f"file://{folder}", ordered=True).collect()]
    assert paths == sorted(paths)


def test_equation_text(spark):
    b = spark.createDataFrame([("d", 1, 2.0, 3.0, "plain"), ("d", 2, 2.0, 3.0, "other")], "doc_id string, page int, x0 double, y0 double, text string")
    o = spark.createDataFrame([("d", 1, 2.0, 3.0, "x^2")], "doc_id string, page int, x0 double, y0 double, latex string")
    assert {r["page"]: r["latex"] for r in providers.equation_text(b, o).collect()} == {1: "x^2", 2: "other"}


def test_metadata_two_tracks(spark):
    from docloom.operators import metadata

    rules = spark.createDataFrame([("a", "Title", None, "ko"), ("b", None, [("DOCKET", "AB-1")], "ko")], "doc_id string, title string, identifier array<struct<scheme:string,value:string>>, language string")
    model = spark.createDataFrame([("a", "Other", "en", [("odd", "CD-2"), ("DOI", "bad id")])], "doc_id string, dc_title string, dc_language string, dc_identifier array<struct<scheme:string,value:string>>")
    got = {r["doc_id"]: (r["dc_title"], [tuple(x) for x in r["dc_identifier"]], r["dc_language"]) for r in metadata.two_tracks(rules, model).collect()}
    assert got == {"a": ("Title", [("DOCKET", "CD-2")], "en"), "b": (None, [("DOCKET", "AB-1")], "ko")}
    assert F.lit(1) is not None


def test_spread_leaves_split_tables_alone(spark, tmp_path):
    from docloom.sources.tables import load, spread

    cores = spark.sparkContext.defaultParallelism
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one.parquet")
    one = load(spark, str(tmp_path), "one")
    assert spread(one, "id").rdd.getNumPartitions() == cores and spread(one, "id").count() == 100
    many = spark.range(100).repartition(cores + 3)
    assert spread(many, "id") is many


def test_shared_folder_is_required_on_a_cluster():
    """Only one process may fall back to a folder of its own; executors of a cluster do not see it."""
    from types import SimpleNamespace as N

    from docloom.sources import tables

    made = lambda master, folder=None: N(sparkContext=N(master=master, applicationId="a", getConf=lambda: N(get=lambda k: folder)), conf=N(get=lambda k, d: d))
    assert tables.shared_dir(made("yarn", "hdfs:///x/")) == "hdfs:///x" and tables.new_path(made("yarn", "hdfs:///x/"), "t").startswith("hdfs:///x/docloom/a/t-")
    assert tables.shared_dir(made("local[8]")).startswith("file:///")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:7077"):
        with pytest.raises(ValueError):
            tables.shared_dir(made(master))


def test_fragments_are_those_of_elementtree():
    from xml.etree import ElementTree as ET

    for text in ('<a b="1 &lt; &quot;2&quot;&#10;">x &amp; y<c/>tail &gt;<d>z<e f="g"/></d></a>', '<a xmlns:n="u"><n:b n:c="d">t</n:b><e n:f="g"/></a>', "<a></a>"):
        for el in ET.fromstring(text).iter():
            assert xml.fragment(el) == ET.tostring(el, encoding="unicode")
    deep = ET.fromstring("<a>" * 3000 + "</a>" * 3000)
    assert xml.fragment(deep).startswith("<a><a>") and xml.fragment(deep).count("</a>") == 2999


def test_paths_without_fragments():
    """What a query does not read is not made: fragments are as long as the document at every level of sections."""
    data = b"<article><body><sec><title>T</title><p>x</p></sec></body></article>"
    whole, some = (xml.parse("", "d", data, ("blocks", more))["blocks"] for more in ("lineage", "paths"))
    assert [b["source_xpath"] for b in some] == [b["source_xpath"] for b in whole] and all(b.get("xml_fragment") is None for b in some) and all(b["xml_fragment"] for b in whole)


def test_dealing_runs_nothing(spark):
    from docloom.sources.tables import dealt

    counted = spark.range(1000).groupBy(F.expr("id % 100").alias("k")).count()
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    rows = dealt(counted)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before
    assert rows.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


def test_pages_keep_blocks_without_text(spark, tmp_path):
    from docloom.plans import doc_queries

    spark.createDataFrame([(1, "<h1> </h1><p>a</p><li></li><p>b</p>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((r["pos"], r["block_type"], r["text"]) for r in doc_queries.html_blocks(spark, str(tmp_path)).collect())
    assert got == [(0, "title", ""), (1, "paragraph", "a"), (2, "listItem", ""), (3, "paragraph", "b")]


def test_rules_of_absent_elements_are_passed_over(monkeypatch):
    """A rule is worked out only where the document has an element it asks for; a deep applicability is walked without recursion."""
    from docloom.sources import xml

    tried = []
    value = xml.Rules.value
    monkeypatch.setattr(xml.Rules, "value", lambda self, rule: tried.append(rule.get("xpath", rule.get("dc_element"))) or value(self, rule))
    made = xml.parse("", "d", b"<dmodule><techName>A</techName><infoName/><b><skillLevel skillLevelCode='s'/></b></dmodule>", ("metadata",))["metadata"]
    assert (made["dc_title"], made["dc_description"]) == ("A", "Skill Level: s") and tried == [".//techName", ".//skillLevel"]
    deep = "<applic id='a'><displayText> x <simplePara> shown </simplePara></displayText>" + "<evaluate>" * 5000 + "<ASSERT applicPropertyIdent='i'/>" + "</evaluate>" * 5000 + "</applic>"
    tree = xml.applic_tree(xml.ET.fromstring(deep))
    assert (tree["applicId"], tree["displayText"]) == ("a", "shown")
    at, depth = tree["evaluateTree"], 1
    while at["children"][0]["type"] == "evaluate":
        at, depth = at["children"][0], depth + 1
    assert depth == 5000 and at["children"] == [{"type": "assert", "ident": "i", "propType": "", "values": ""}]


APPLIC = """<dmodule><status><applic id="a"><displayText><simplePara>"A" é</simplePara></displayText></applic><applic id="a"/><applic id="b"><evaluate><assert/></evaluate></applic></status>
<content><procedure><preliminaryRqmts><noConds/></preliminaryRqmts><mainProcedure><proceduralStep applicRefId="a"><para>1</para></proceduralStep><proceduralStep applicRefId="a"><para>2</para></proceduralStep>
<proceduralStep applicRefId="b"><torque><torqueValue>x</torqueValue><torqueUnit>Nm</torqueUnit></torque></proceduralStep><proceduralStep applicRefId="none"><para>3</para></proceduralStep></mainProcedure></procedure></content></dmodule>"""


def test_block_rows_are_the_blocks_of_the_columns_asked_for(spark, monkeypatch):
    """F16: only the columns named come back from Python, as rows, and an applicability is made once for all steps that refer to it."""
    import json

    from docloom.sources import xml

    files = spark.createDataFrame([("", "d", APPLIC.encode()), ("", "bad", b"<dmodule>"), ("", "plain", b"<x>t</x>")], "path string, doc_id string, content binary")
    columns = ("pos", "block_type", "text", "level", "parent_id", "structured_content")
    rows = xml.block_rows(files, columns)
    assert rows.columns == ["doc_id", *columns]
    want = xml.blocks(xml.shred(files, ("blocks",))).select("doc_id", *columns)
    assert rows.schema == want.schema and sorted(map(str, rows.collect())) == sorted(map(str, want.collect()))
    made = []
    tree = xml.applic_tree
    monkeypatch.setattr(xml, "applic_tree", lambda el: made.append(el.get("id")) or tree(el))
    held = [b["structured_content"] for b in xml.parse("", "d", APPLIC.encode(), ("blocks",))["blocks"] if b["block_type"] == "procedureStep"]
    assert made == ["a", "b"] and all(json.dumps(json.loads(h), ensure_ascii=False) == h for h in held)
    assert [json.loads(h).get("applicTree", {}).get("displayText") for h in held] == ['"A" é', '"A" é', None, None] and "evaluateTree" in held[2]


def test_titles_are_made_without_the_other_blocks(spark, monkeypatch):
    """what a query reads of title blocks is made of whole documents, but their other blocks are not."""
    from docloom.sources import xml

    module = '<dmodule><dmIdent><dmCode modelIdentCode="M"/></dmIdent><a><techName>T</techName></a><content><para>x</para></content></dmodule>'
    files = spark.createDataFrame([("", "d", module.encode()), ("", "cut", module[:-4].encode()), ("", "plain", b"<x>t</x>")], "path string, doc_id string, content binary")
    columns = ("pos", "block_type", "text", "block_id", "structured_content")
    got = [tuple(r) for r in xml.block_rows(files, columns, ("titles",)).collect()]
    assert got == [tuple(r) for r in xml.blocks(xml.shred(files, ("blocks",))).where("block_type = 'title'").select("doc_id", *columns).collect()] and len(got) == 1
    monkeypatch.setattr(xml.Shredder, "walk", lambda *a: 1 / 0)
    assert [b["text"] for b in xml.parse("", "d", module.encode(), ("titles",))["blocks"]] == ["T"]


def test_records_are_made_within_their_documents_rows(spark):
    """content, relations and mapping of a document's row are those that joins of blocks and relations give, without a shuffle."""
    parsed = xml.shred(spark.createDataFrame([("/a", "a", ARTICLE.encode()), ("/b", "b", b"<dmodule/>"), ("/c", "c", b"<broken")], "path string, doc_id string, content binary")).localCheckpoint()
    b, r = xml.blocks(parsed), xml.relations(parsed)
    renamed = r.select("doc_id", F.col("source_block_id").alias("sourceBlockId"), F.col("relation_type").alias("relationType"), "target", F.col("citation_text").alias("citationText"), "confidence")
    want = docs.assemble(xml.metadata(parsed), docs.content(b), renamed, docs.lineage(b), "t")
    rows = parsed.where("metadata is not null").select("doc_id", F.col("path").alias("source_path"), "metadata.*", *(v.alias(k) for k, v in docs.bodies(parsed).items()))
    got = docs.record(rows.withColumns(docs.fallbacks()), xml.metadata(parsed).columns, True, True, "t")
    assert got.schema.simpleString() == want.schema.simpleString() and got.orderBy("documentId").collect() == want.orderBy("documentId").collect()
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_records_beyond_doubt_have_the_errors_of_their_json(spark):
    """the check by types and values, and the JSON of what it leaves, find what the JSON alone does."""
    item = "struct<blockId: string, blockType: string, text: string, level: int, extractionConfidence: double, bbox: struct<x0: double, y0: double, x1: double, y1: double, page: int>, structuredContent: string>"
    ddl = f"documentId string, `$schema` string, version string, metadata struct<`dc:title`: string, `dc:type`: string, `dc:language`: string, `dc:date`: map<string, string>>, content array<{item}>, relations array<struct<relationType: string, target: string, confidence: double>>"
    good = ("a-1", "s", "1.0.0", ("T", "Code", "en", {"issued": "x"}), [("b", "note", "", 0, 0.5, (1.0, 1.0, 1.0, 1.0, 1), "{}")], [("custom:x", "t", 1.0)])
    put = lambda i, v: (*good[:i], v, *good[i + 1 :])
    rows = [
        good, put(5, None), put(4, []), put(0, "a b"), put(0, None), put(2, "1"), put(3, None), put(3, ("", "Code", "en", None)), put(3, ("T", "Odd", "e", {"issued": None})), put(4, None), put(4, [None]), put(4, [("b", "odd", "", 0, 0.5, None, "")]),
        put(4, [("b", "note", None, -1, 1.5, None, "")]), put(4, [("b", "note", "", 0, float("nan"), (float("inf"), 0.0, 0.0, 0.0, 1), "")]), put(5, [("CITES", "t", None)]), put(5, [("odd", None, 2.0)]), put(5, [None]),
    ]
    d = spark.createDataFrame(rows, ddl)
    fields = {c: F.col(f"`{c}`") for c in d.columns} | {"content": F.transform("content", lambda x: x.dropFields("structuredContent"))}
    alone = validate.json_errors("doc")(F.to_json(F.struct(*(v.alias(k) for k, v in fields.items()))))
    found = d.select(validate.record_errors("doc", d, fields, {"content": F.col("content")}).alias("a"), alone.alias("b")).collect()
    assert all(x["a"] == x["b"] for x in found) and [not x["a"] for x in found[:3]] == [True] * 3 and all(x["a"] for x in found[3:14])


def test_an_upsert_shuffles_its_rows_once(spark, tmp_path):
    """the ranges of the keys' hash find the last row of a key too; a second table gets a copy of the segment."""
    store, plans = Store(spark, f"file://{tmp_path}/s"), []
    rows = spark.range(300).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    plain = type(rows).sortWithinPartitions

    def seen(rows, *by):
        plans.append(plain(rows, *by))
        return plans[-1]

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(rows), "sortWithinPartitions", seen)
        store.upsert("t", rows, ["k"], ["v"], also=("u",))
    assert [p._jdf.queryExecution().executedPlan().toString().count("Exchange") for p in plans] == [1, 0]
    for t in ("t", "u"):
        assert {r["k"]: r["v"] for r in store.read(t).collect()} == {k: k + 200 for k in range(100)} and store.read(t).count() == 100
    assert store.lookup("u", spark.range(3).select(F.col("id").alias("k"))).count() == 3
    store.purge("t")
    store.upsert("u", spark.range(2).select("id", F.lit(0).alias("v")).toDF("k", "v"), ["k"], ["v"], alike=True)
    assert store.read("u").where("v = 0").count() == 2
