"""Queries that go through the whole of the library: XML of several shapes, the schema check, the store and the
ingestion plan; with the SQL that gives the same rows. Their documents are made of orders and their lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import validate
from ..operators.store import Store
from ..sources import xml
from ..sources.tables import dealt, load, new_path, spread
from . import catalogs, pipeline
from .doc_queries import modules


def _joined(column) -> F.Column:
    """Texts of an order's lines in the order of line numbers, which may repeat, and then of parts and suppliers."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", column.alias("x")))), lambda r: r["x"]), "")


def _files(xml_rows: DataFrame) -> DataFrame:
    """As files.scan gives them; the rows are of a table that was dealt, or of a shuffle."""
    return xml_rows.select(F.lit("").alias("path"), F.col("l_orderkey").cast("string").alias("doc_id"), F.encode("xml", "utf-8").alias("content"))


def _text(*parts) -> F.Column:
    return F.concat(*(p if isinstance(p, F.Column) else F.lit(p) for p in parts))


def _str(column: str) -> F.Column:
    return F.col(column).cast("string")


def articles(spark, sf_dir) -> DataFrame:
    """An article per order: a section of paragraphs with citations, an inner section, references."""
    n, part, supplier = _str("l_linenumber"), _str("l_partkey"), _str("l_suppkey")
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        _joined(_text("<p>Part ", part, ' <xref ref-type="bibr" rid="r', n, '">[', n, "]</xref></p>")).alias("p"), _joined(_text('<ref id="r', n, '">Supplier ', supplier, "</ref>")).alias("r")
    )
    key = _str("l_orderkey")
    body = _text("<article><front><article-meta><title-group><article-title>Order ", key, "</article-title></title-group></article-meta></front><body><sec><title>", (F.col("l_orderkey") % 7).cast("string"), ".2 Lines</title>", F.col("p"))
    return lines.select("l_orderkey", _text(body, "<sec><title>Inner</title><disp-formula>a = ", key, "</disp-formula><table-wrap>1 2</table-wrap></sec></sec></body><back><ref-list>", F.col("r"), "</ref-list></back></article>").alias("xml"))


def article_blocks(spark, sf_dir):
    """Sections in sections, paragraphs, formulas and tables of articles, with their lineage (TRE1, TRE5, TRE8)."""
    b = xml.blocks(xml.shred(_files(articles(spark, sf_dir)), ("blocks", "paths")))
    return b.select(F.col("doc_id").cast("long").alias("l_orderkey"), F.col("pos").cast("int").alias("pos"), "block_type", "text", F.col("level").cast("int").alias("level"), F.array_join("context_path", "/").alias("path"), F.col("parent_id").isNotNull().alias("has_parent"), "section_label", "source_xpath")


def article_relations(spark, sf_dir):
    """Citations in texts and the list of references as edges (TRE5, TRE6)."""
    r = xml.relations(xml.shred(_files(articles(spark, sf_dir)), ("relations",)))
    return r.select(F.col("doc_id").cast("long").alias("l_orderkey"), "relation_type", "target", "citation_text", "confidence", F.col("source_block_id").isNotNull().alias("in_text"))


def applic_join(spark, sf_dir):
    """Steps with the first applicability of their reference in document order (JOI3, TRE11)."""
    # an order's lines are gathered and sorted once, as they are, for both texts
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"))).alias("l"))
    all_of = lambda text: F.array_join(F.transform("l", text), "")
    applics = all_of(lambda r: _text('<applic id="app-', (r["l_suppkey"] % 5).cast("string"), '"><displayText><simplePara>', r["l_returnflag"], "</simplePara></displayText></applic>"))
    steps = all_of(lambda r: _text('<proceduralStep applicRefId="app-', (r["l_linenumber"] % 5).cast("string"), '"><para>', r["l_partkey"].cast("string"), "</para></proceduralStep>"))
    m = lines.select("l_orderkey", _text("<dmodule><status>", applics, "</status><content><procedure><mainProcedure>", steps, "</mainProcedure></procedure></content></dmodule>").alias("xml"))
    b = xml.block_rows(_files(m), ("text", "structured_content"))
    held = lambda path: F.get_json_object("structured_content", path)
    return b.select(F.col("doc_id").cast("long").alias("doc_id"), held("$.applicRefId").alias("applic_ref"), F.col("text").cast("long").alias("l_partkey"), held("$.applicTree.displayText").alias("tree"))


def module_steps(spark, sf_dir):
    """Requirement groups before and after the body, and steps in a step with conditions and torques (TRE3, TRE4)."""
    n = _str("l_linenumber")
    torque = F.when(F.col("l_linenumber") % 2 == 1, _text("<torque><torqueValue>", _str("l_suppkey"), "</torqueValue><torqueUnit>Nm</torqueUnit></torque>")).otherwise(_text("<para>part ", _str("l_partkey"), "</para>"))
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(_joined(_text('<proceduralStep><reqCondNo id="c', n, '">Lamp ', n, "</reqCondNo>", torque, "</proceduralStep>")).alias("s"))
    key = F.col("l_orderkey")
    before, after = F.when(key % 2 == 0, "<preliminaryRqmts><noConds/><noSafety/></preliminaryRqmts>").otherwise(""), F.when(key % 3 == 0, "<closeRqmts><noSupplies/></closeRqmts>").otherwise("")
    m = lines.select("l_orderkey", _text("<dmodule><content><procedure>", before, "<mainProcedure><proceduralStep><para>Order ", key.cast("string"), "</para>", F.col("s"), "</proceduralStep></mainProcedure>", after, "</procedure></content></dmodule>").alias("xml"))
    b = xml.blocks(xml.shred(_files(m), ("blocks",)))
    held = lambda path: F.get_json_object("structured_content", path)
    return b.select(
        F.col("doc_id").cast("long").alias("l_orderkey"), F.col("pos").cast("int").alias("pos"), "block_type", "text", F.col("level").cast("int").alias("level"), F.col("parent_id").isNotNull().alias("has_parent"),
        held("$.conditions[0].type").alias("first_condition"), held("$.conditions[1].type").alias("second_condition"), held("$.conditions[0].identifier").alias("condition_id"), held("$.actions[0].parameters.torqueUnit").alias("unit"),
    )


def generic_blocks(spark, sf_dir):
    """Documents of no known format are one paragraph, and what does not parse is a problem (TRE7, SRC3)."""
    o = dealt(load(spark, sf_dir, "orders"))
    body = F.when(F.col("o_orderkey") % 4 == 0, _text("<note>", F.col("o_orderpriority"))).otherwise(_text("<note>  ", F.col("o_orderpriority"), " <b>of</b> ", _str("o_orderkey"), "</note>"))
    p = xml.shred(_files(o.select(F.col("o_orderkey").alias("l_orderkey"), body.alias("xml"))), ("blocks",))
    return p.select(F.col("doc_id").cast("long").alias("o_orderkey"), "format", F.col("error").isNotNull().alias("failed"), F.size("blocks").cast("int").alias("n_blocks"), F.try_element_at("blocks", F.lit(1))["text"].alias("text"))


def record_errors(spark, sf_dir):
    """The record schema's validators on nested JSON, a row an error with its path (VAL1, FN23, LIM2)."""
    e = spread(load(spark, sf_dir, "events"))
    k = F.col("event_id")
    some = lambda n, bad, good: F.when(k % n == 0, bad).otherwise(good)
    item = _text('{"blockId":"b', some(3, '","blockType":"poem"', '","blockType":"paragraph"'), ',"text":"x","level":', some(4, "-1", "2"), some(5, ',"bbox":{"x0":"left","y0":1,"x1":2,"y1":3,"page":1.5}', ""), "}")
    relation = _text('{"relationType":"', some(6, "LIKES", "custom:a.b"), '","target":"t","confidence":', some(7, "1.5", "0.5"), "}")
    record = _text(
        '{"documentId":"', some(8, "a b", "a-b"), '","$schema":"s","version":"', some(9, "1.0", "1.0.0"), '","metadata":{"dc:title":"', some(10, "", "t"), '","dc:type":"Other"', some(11, "", ',"dc:language":"en"'),
        '},"content":[{"blockId":"a","blockType":"title","text":"t"},', item, '],"relations":[', relation, "]", some(13, ',"more":1', ""), "}",
    )
    out = e.select("event_id", validate.json_errors("doc")(record).alias("all")).select("event_id", F.posexplode("all").alias("n", "e"))
    return out.select("event_id", "n", F.col("e.target").alias("target"), F.col("e.validator").alias("validator"))


#: a user's catalog, as they would write it
MANUAL = """
format_id: manual
detect: {root_tag_contains: [manual]}
metadata:
  dc_title: {xpath: .//name, combine_with: .//maker, separator: " / "}
  dc_subject: {xpath: .//tags, split_by: ","}
  dc_language: {xpath: .//lang, truncate: 2}
  dc_description: [{xpath: .//grade, attribute: code, template: "Grade {value}"}, {xpath: .//brand, join_separator: " | "}]
  dc_rights: {xpath: .//access, dumb_down: {S: {accessRights: restricted}, _default: {accessRights: public}}}
  dc_contributor: {xpath: .//maker, role: reviewer, entity_type: person}
  dc_identifier: [{xpath: .//id, scheme: DOI}, {static: fixed}]
  dc_coverage: {xpath: .//place}
content:
  mappings: [{tag: hint, block_type: note, prefix: "Hint: "}, {tag: [danger], block_type_from_tag: true, prefix_template: "[{TAG}]"}]
"""


def _manuals(spark, sf_dir, *parts: str) -> DataFrame:
    p = dealt(load(spark, sf_dir, "part"))
    key = _str("p_partkey")
    body = _text(
        "<manual><name>", F.col("p_name"), "</name><maker>", F.col("p_type"), "</maker><tags>", F.regexp_replace("p_name", " ", " , "), "</tags><lang>", F.when(F.col("p_partkey") % 2 == 0, "ENG").otherwise("de-DE"), '</lang><grade code="', _str("p_size"), '"/><brand>', F.col("p_brand"),
        "</brand><access>", F.when(F.col("p_partkey") % 3 == 0, "S").otherwise("T"), "</access><id>", key, "</id><place>Hall ", _str("p_size"), "</place><content><hint>Look at ", key, "</hint><danger>Hot</danger></content></manual>",
    )
    formats = dict([catalogs.from_yaml(MANUAL), *catalogs.FORMATS.items()])
    return xml.shred(_files(p.select(F.col("p_partkey").alias("l_orderkey"), body.alias("xml"))), parts, formats)


def rule_options(spark, sf_dir):
    """Every option of metadata rules, by a catalog that comes as YAML (TRE9, SRC9, UDF2)."""
    m = xml.metadata(_manuals(spark, sf_dir, "metadata"))
    ids = F.array_join(F.transform("dc_identifier", lambda x: F.concat_ws(":", x["scheme"], x["value"])), ",")
    return m.select(
        F.col("doc_id").cast("long").alias("p_partkey"), "dc_title", F.array_join("dc_subject", "|").alias("subjects"), "dc_language", "dc_description", F.col("dc_rights")["accessRights"].alias("access"),
        F.concat_ws(":", F.col("dc_contributor")[0]["name"], F.col("dc_contributor")[0]["role"], F.col("dc_contributor")[0]["entityType"]).alias("contributor"), ids.alias("ids"), "dc_coverage",
    )


def prefixed_blocks(spark, sf_dir):
    """Prefixes of block rules (TRE12), by the same catalog."""
    b = xml.blocks(_manuals(spark, sf_dir, "blocks"))
    return b.where("block_type <> 'title'").select(F.col("doc_id").cast("long").alias("p_partkey"), "block_type", "text")


def _store(spark, label: str) -> Store:
    return Store(spark, new_path(spark, label))


def doc_store_upsert(spark, sf_dir):
    """Each customer's last order, upserted in two batches: rows of the first that the second does not replace stay (SNK4, STA1)."""
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    s = _store(spark, "orders")
    s.upsert("orders", o.where("o_orderstatus <> 'O'"), ["o_custkey"], ["o_orderkey"])
    s.upsert("orders", o.where("o_orderstatus = 'O'"), ["o_custkey"], ["o_orderkey"])
    return s.read("orders")


def fragment_lookup(spark, sf_dir):
    """Fragments by sanitised block id; null where there is none (SNK6, SRC13, JOI11)."""
    d = load(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("doc:"), "doc_id", F.lit("/é")).alias("block_id"), F.when(F.col("doc_id") % 3 == 0, F.col("source")).alias("xml_fragment"))
    s = _store(spark, "fragments")
    s.put_fragments(d)
    return s.fragments(d.select("doc_id", "block_id")).select("doc_id", "block_id", "xml_fragment")


def ingest_summary(spark, sf_dir):
    """The whole plan over modules and broken files into a store: what was kept, refused and landed (API1, API4, PRJ6, VAL3)."""
    m = modules(spark, sf_dir).select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 1, "<dmodule>").otherwise(F.col("xml")).alias("xml"))
    files = _files(m.withColumnRenamed("o_orderkey", "l_orderkey"))
    s = _store(spark, "ingest")
    result = pipeline.ingest(spark, files, "2024-01-01T00:00:00Z", target=s)
    landed = s.read("ssot_docs").agg(F.count("*").alias("stored"), F.sum(F.size("content")).alias("stored_blocks")).withColumn("_one", F.lit(1))
    broken = s.read("problems").where("type = 'xml-syntax'").agg(F.count("*").alias("broken")).withColumn("_one", F.lit(1))
    return result.summary().withColumn("_one", F.lit(1)).join(landed, "_one").join(broken, "_one").drop("_one")


_LINES = "SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n, l_orderkey % 7 AS m FROM lineitem"
SQL = {
    "article_blocks": f"""WITH l AS ({_LINES}), o AS (SELECT DISTINCT l_orderkey, n, m, concat(m, '.2 Lines') AS head FROM l)
        SELECT l_orderkey, CAST(1 AS INT) AS pos, 'title' AS block_type, concat('Order ', l_orderkey) AS text, CAST(0 AS INT) AS level, '' AS path, false AS has_parent, NULL AS section_label, NULL AS source_xpath FROM o
        UNION ALL SELECT l_orderkey, 2, 'section', head, 1, '', false, concat(m, '.2'), '/article/body/sec' FROM o
        UNION ALL SELECT l_orderkey, 2 + i, 'paragraph', concat('Part ', l_partkey, ' [', l_linenumber, ']'), 999, concat(m, '.2 Lines'), true, NULL, concat('/article/body/sec/p', CASE WHEN n > 1 THEN concat('[', i, ']') ELSE '' END) FROM l
        UNION ALL SELECT l_orderkey, 3 + n, 'section', 'Inner', 2, head, true, NULL, '/article/body/sec/sec' FROM o
        UNION ALL SELECT l_orderkey, 4 + n, 'equation', concat('a = ', l_orderkey), 999, concat(head, '/Inner'), true, NULL, '/article/body/sec/sec/disp-formula' FROM o
        UNION ALL SELECT l_orderkey, 5 + n, 'table', '1 2', 999, concat(head, '/Inner'), true, NULL, '/article/body/sec/sec/table-wrap' FROM o
        UNION ALL SELECT l_orderkey, 6 + n, 'section', 'References', 1, '', false, NULL, NULL FROM o""",
    "article_relations": """SELECT l_orderkey, 'CITES' AS relation_type, concat('#r', l_linenumber) AS target, concat('[', l_linenumber, ']') AS citation_text, CAST(0.9 AS DOUBLE) AS confidence, true AS in_text FROM lineitem
        UNION ALL SELECT l_orderkey, 'CITES', concat('#r', l_linenumber), concat('Supplier ', l_suppkey), CAST(1 AS DOUBLE), false FROM lineitem""",
    "applic_join": """WITH t AS (SELECT l_orderkey AS doc_id, concat('app-', l_suppkey % 5) AS applic_ref, arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_returnflag)) AS tree FROM lineitem GROUP BY ALL)
        SELECT l_orderkey AS doc_id, concat('app-', l_linenumber % 5) AS applic_ref, l_partkey, tree FROM lineitem LEFT JOIN t ON t.doc_id = l_orderkey AND t.applic_ref = concat('app-', l_linenumber % 5)""",
    "module_steps": f"""WITH l AS ({_LINES}), o AS (SELECT DISTINCT l_orderkey, n, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE 0 END AS p FROM l)
        SELECT l_orderkey, CAST(1 AS INT) AS pos, 'section' AS block_type, 'preliminaryRqmts' AS text, CAST(1 AS INT) AS level, false AS has_parent, 'condition' AS first_condition, 'safety' AS second_condition, NULL AS condition_id, NULL AS unit FROM o WHERE p = 1
        UNION ALL SELECT l_orderkey, p + 1, 'procedureStep', concat('Order ', l_orderkey), 1, false, NULL, NULL, NULL, NULL FROM o
        UNION ALL SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN 2 ELSE 1 END + i, 'procedureStep', CASE WHEN l_linenumber % 2 = 1 THEN concat('Torque: ', l_suppkey, ' Nm') ELSE concat('part ', l_partkey) END, 2, true, 'required_condition', NULL, concat('c', l_linenumber), CASE WHEN l_linenumber % 2 = 1 THEN 'Nm' END FROM l
        UNION ALL SELECT l_orderkey, p + 2 + n, 'section', 'closeRqmts', 1, false, 'supplies', NULL, NULL, NULL FROM o WHERE l_orderkey % 3 = 0""",
    "generic_blocks": """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'generic' END AS format, o_orderkey % 4 = 0 AS failed, CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS INT) AS n_blocks,
        CASE WHEN o_orderkey % 4 <> 0 THEN concat(o_orderpriority, ' of ', o_orderkey) END AS text FROM orders""",
    "record_errors": """WITH k AS (SELECT event_id, unnest([CASE WHEN event_id % 3 = 0 THEN 'content[1].blockType|enum' END, CASE WHEN event_id % 4 = 0 THEN 'content[1].level|minimum' END, CASE WHEN event_id % 5 = 0 THEN 'content[1].bbox.x0|type' END, CASE WHEN event_id % 5 = 0 THEN 'content[1].bbox.page|type' END,
            CASE WHEN event_id % 6 = 0 THEN 'relations[0].relationType|oneOf' END, CASE WHEN event_id % 7 = 0 THEN 'relations[0].confidence|maximum' END, CASE WHEN event_id % 8 = 0 THEN 'documentId|pattern' END, CASE WHEN event_id % 9 = 0 THEN 'version|pattern' END,
            CASE WHEN event_id % 10 = 0 THEN 'metadata.dc:title|minLength' END, CASE WHEN event_id % 11 = 0 THEN 'metadata|required' END, CASE WHEN event_id % 13 = 0 THEN '<record>|additionalProperties' END]) AS x FROM events)
        SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY replace(split_part(x, '|', 1), '<record>', '')) - 1 AS INT) AS n, split_part(x, '|', 1) AS target, split_part(x, '|', 2) AS validator FROM k WHERE x IS NOT NULL""",
    "rule_options": """SELECT p_partkey, concat(p_name, ' / ', p_type) AS dc_title, replace(p_name, ' ', '|') AS subjects, CASE WHEN p_partkey % 2 = 0 THEN 'en' ELSE 'de' END AS dc_language, concat('Grade ', p_size, ' | ', p_brand) AS dc_description,
        CASE WHEN p_partkey % 3 = 0 THEN 'restricted' ELSE 'public' END AS access, concat(p_type, ':reviewer:person') AS contributor, concat('DOI:', p_partkey, ',URI:fixed') AS ids, concat('{"spatialCoverage": "Hall ', p_size, '"}') AS dc_coverage FROM part""",
    "prefixed_blocks": "SELECT p_partkey, 'note' AS block_type, concat('Hint: Look at ', p_partkey) AS text FROM part UNION ALL SELECT p_partkey, 'danger', '[DANGER] Hot' FROM part",
    "doc_store_upsert": """SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'O' DESC, o_orderkey DESC) = 1""",
    "fragment_lookup": "SELECT doc_id, concat('doc:', doc_id, '/é') AS block_id, CASE WHEN doc_id % 3 = 0 THEN source END AS xml_fragment FROM documents",
    # a record each of 5 blocks; the one term that stands for no model's answer is never promoted
    "ingest_summary": """SELECT count(*) FILTER (o_orderkey % 10 <> 1) AS documents, CAST(0 AS BIGINT) AS promoted_terms, count(*) FILTER (o_orderkey % 10 = 1) + 1 AS problems, count(*) FILTER (o_orderkey % 10 <> 1) AS stored,
        5 * count(*) FILTER (o_orderkey % 10 <> 1) AS stored_blocks, count(*) FILTER (o_orderkey % 10 = 1) AS broken FROM orders""",
}
QUERIES = {f.__name__: f for f in (article_blocks, article_relations, applic_join, module_steps, generic_blocks, record_errors, rule_options, prefixed_blocks, doc_store_upsert, fragment_lookup, ingest_summary)}
