"""Queries of XML, metadata, records, validation and stores, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import transforms as X
from ..operators import docs, metadata, store, terms, validate
from ..sources import files, xml
from ..sources.tables import dealt, spread
from . import catalogs
from .term_queries import _CHECKED, load, merged

# a data module per order: its code, issue, date and security are the order's columns
MODULES = """
    SELECT o_orderkey, concat('<dmodule><identAndStatusSection><dmAddress><dmIdent><dmCode modelIdentCode="M', CAST(o_custkey AS VARCHAR(20)), '" systemDiffCode="A" systemCode="', substring(o_orderpriority, 1, 1), '0" subSystemCode="', CAST(o_orderkey % 9 AS VARCHAR(20)),
        '" subSubSystemCode="0" assyCode="00" disassyCode="00" disassyCodeVariant="AA" infoCode="', CASE WHEN o_orderkey % 3 = 0 THEN '040' WHEN o_orderkey % 3 = 1 THEN '520' ELSE '999' END, '" infoCodeVariant="A" itemLocationCode="A"/>',
        CASE WHEN o_orderkey % 2 = 0 THEN '<issueInfo issueNumber="001" inWork="00"/>' ELSE '' END, '</dmIdent><dmAddressItems><issueDate year="', CAST(year(o_orderdate) AS VARCHAR(9)), '" month="', CAST(month(o_orderdate) AS VARCHAR(9)), '" day="', CAST(day(o_orderdate) AS VARCHAR(9)),
        '"/><dmTitle><techName>Order ', CAST(o_orderkey AS VARCHAR(20)), '</techName><infoName>', o_orderpriority, '</infoName></dmTitle></dmAddressItems></dmAddress><dmStatus issueType="', CASE o_orderstatus WHEN 'O' THEN 'new' WHEN 'F' THEN 'changed' ELSE 'other' END,
        '"><security securityClassification="', CASE WHEN o_orderkey % 5 = 0 THEN '02' ELSE '01' END, '"', CASE WHEN o_orderkey % 4 = 0 THEN ' commercialClassification="cc1"' ELSE '' END, '/></dmStatus></identAndStatusSection>',
        '<content><procedure><mainProcedure><levelledPara><title>', CAST(o_orderkey % 7 AS VARCHAR(9)), '.1 Section</title><para>Total ', CAST(o_custkey AS VARCHAR(20)), '</para><proceduralStep><para>Step of ', o_orderstatus, '</para></proceduralStep>',
        '<proceduralStep><note>Only a note</note></proceduralStep></levelledPara></mainProcedure></procedure></content></dmodule>') AS xml, o_custkey, o_orderpriority, o_orderstatus, o_orderdate FROM {orders}"""


def modules(spark, sf_dir):
    return spark.sql(MODULES, orders=dealt(load(spark, sf_dir, "orders")))


def parsed_modules(spark, sf_dir):
    return modules(spark, sf_dir)


def dmc_assemble(spark, sf_dir):
    at = "identAndStatusSection/dmAddress/dmIdent"
    found = X.attributes_at(F.col("xml"), {"code": (f"{at}/dmCode", X.DMC_ATTRIBUTES), "issue": (f"{at}/issueInfo", ("issueNumber", "inWork"))})
    m = parsed_modules(spark, sf_dir).withColumns(found)
    return m.select("o_orderkey", X.dmc(F.col("code"), F.col("issue")).alias("dmc"))


def date_from_attrs(spark, sf_dir):
    m = parsed_modules(spark, sf_dir).withColumns(X.attributes_at(F.col("xml"), {"d": ("identAndStatusSection/dmAddress/dmAddressItems/issueDate", ("year", "month", "day"))}))
    return m.select("o_orderkey", X.date_from_attributes(F.col("d")).alias("issued"))


def security_rights(spark, sf_dir):
    at = {"a": ("identAndStatusSection/dmStatus/security", ("securityClassification", "commercialClassification", "caveat"))}
    m = parsed_modules(spark, sf_dir).withColumns(X.attributes_at(F.col("xml"), at)).withColumn("s", X.security(F.col("a")))
    return m.select("o_orderkey", F.col("s.accessRights").alias("access_rights"), F.col("s.license").alias("license"))


def info_code_type(spark, sf_dir):
    at = {"a": ("identAndStatusSection/dmAddress/dmIdent/dmCode", ("infoCode",))}
    return parsed_modules(spark, sf_dir).withColumns(X.attributes_at(F.col("xml"), at)).select("o_orderkey", X.info_code_type(F.col("a")).alias("doc_type"))


def shredded(spark, sf_dir, *parts: str):
    m = modules(spark, sf_dir).select(F.lit("").alias("path"), F.col("o_orderkey").cast("string").alias("doc_id"), F.encode("xml", "utf-8").alias("content"))
    return xml.shred(m, parts or xml.PARTS)


def xml_shred_roundtrip(spark, sf_dir):
    """Blocks of every module: their kinds, levels, paths and parents."""
    b = xml.blocks(shredded(spark, sf_dir, "blocks", "paths"))
    return b.select(F.col("doc_id").cast("long").alias("o_orderkey"), F.col("pos").cast("int").alias("pos"), "block_type", "text", "level", F.array_join("context_path", "/").alias("path"), F.col("parent_id").isNotNull().alias("has_parent"), "section_label", "source_xpath")


def xml_metadata(spark, sf_dir):
    m = xml.metadata(shredded(spark, sf_dir, "metadata"))
    return m.select(F.col("doc_id").cast("long").alias("o_orderkey"), "dc_title", "dc_type", F.col("dc_identifier")[0]["value"].alias("identifier"), F.col("dc_date")["issued"].alias("issued"), F.col("dc_rights")["accessRights"].alias("access_rights"))


def step_suppression(spark, sf_dir):
    """Steps per module and what hangs on their section: an empty step leaves its note to the section."""
    b = xml.blocks(shredded(spark, sf_dir, "blocks"))
    return b.groupBy(F.col("doc_id").cast("long").alias("o_orderkey")).agg(F.count_if(F.col("block_type") == "procedureStep").alias("steps"), F.count_if((F.col("block_type") == "note") & F.col("parent_id").endswith("-000002")).alias("notes_of_section"))


def catalog_detect(spark, sf_dir):
    """Page tags against the catalogs' parts; the first format by priority wins (JOI5)."""
    tags = load(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("html"), F.lit("<([a-z0-9]+)"), F.lit(1)))).alias("tag"))
    return catalogs.detected(tags).where("format is not null").select("page_id", "tag", "format")


#: a user's catalog of web pages
WEB = """
format_id: web
detect: {root_tag_contains: webpage}
relations: [{xpath: .//a, relation_type: RELATED_TO}]
content:
  mappings: [{tag: h1, block_type: title, keep_empty: true}, {tag: li, block_type: listItem, keep_empty: true}, {tag: p, block_type: paragraph, keep_empty: true}]
"""


def web_pages(spark, sf_dir, *parts: str):
    """Headings, items, paragraphs and anchors of pages as XML, through a user's catalog."""
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    piece = lambda h: F.concat(F.lit("<"), F.regexp_extract(h, "^(p|h1|li)", 1), F.lit(">"), escaped(F.trim(F.regexp_replace(F.regexp_replace(h, "^[^>]*>", ""), "[ \n\r\t]+", " "))), F.lit("</"), F.regexp_extract(h, "^(p|h1|li)", 1), F.lit(">"))
    found = F.regexp_extract_all("html", F.lit(r"<((?:p|h1|li)[^>]*>[^<]*)"), F.lit(1))
    links = F.transform(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)), lambda a: F.concat(F.lit("<a>"), escaped(a), F.lit("</a>")))
    text = F.concat(F.lit("<webpage><links>"), F.array_join(links, ""), F.lit("</links><content>"), F.array_join(F.transform(found, piece), ""), F.lit("</content></webpage>"))
    p = dealt(load(spark, sf_dir, "pages")).select(F.lit("").alias("path"), F.col("page_id").cast("string").alias("doc_id"), F.encode(text, "utf-8").alias("content"))
    return xml.shred(p, parts, dict([catalogs.from_yaml(WEB), *catalogs.FORMATS.items()]))


def html_blocks(spark, sf_dir):
    """Paragraphs, headings and items of pages, those without text too, in order, by a user's content rules (TRE1, JOI6)."""
    b = xml.blocks(web_pages(spark, sf_dir, "blocks"))
    return b.select(F.col("doc_id").cast("long").alias("page_id"), (F.col("pos") - 1).cast("int").alias("pos"), "block_type", "text")


def relation_edges(spark, sf_dir):
    """Anchors of pages as edges, by a user's relation rule (TRE6)."""
    r = xml.relations(web_pages(spark, sf_dir, "relations"))
    return r.groupBy(F.col("doc_id").cast("long").alias("page_id"), "target").agg(F.count("*").alias("n"))


def relation_vocab(spark, sf_dir):
    """Edges whose type is of the vocabulary, or a custom one."""
    e = load(spark, sf_dir, "events")
    kind = F.when(F.col("event_id") % 3 == 0, "CITES").when(F.col("event_id") % 3 == 1, F.concat(F.lit("custom:"), "event_type")).otherwise(F.upper("event_type"))
    return e.select("event_id", kind.alias("relation_type")).withColumn("ok", validate.relation_ok()).groupBy("relation_type", "ok").agg(F.count("*").alias("n"))


def structured_keys(spark, sf_dir):
    """Keys of the events' JSON that structured content does not allow."""
    e = load(spark, sf_dir, "events")
    return e.select("event_id", F.array_join(validate.unknown_keys(F.json_object_keys("props")), ",").alias("unknown"))


def content_mapping(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    b = e.select(
        F.col("user_id").alias("doc_id"), F.col("event_id").cast("int").alias("pos"), F.when(F.col("event_id") % 4 == 0, "equation").when(F.col("event_id") % 4 == 1, F.col("event_type")).otherwise("section").alias("block_type"), F.col("props").alias("text"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("b"), F.col("event_id"))).otherwise("").alias("block_id"), F.when(F.col("event_id") % 3 == 0, 999).otherwise(2).alias("level"), F.when(F.col("event_id") % 5 == 0, 0.8).otherwise(1.0).alias("confidence"),
        F.struct(F.col("props").alias("latex"), F.lit("1").alias("equationNumber")).alias("equation_data"), F.when(F.col("event_id") % 7 == 0, "<x/>").alias("xml_fragment"),
    )
    c = docs.content(b)
    return c.select("doc_id", "blockId", "blockType", "level", "extractionConfidence", F.col("equationData.latex").alias("latex"), "fragmentRef")


def layout_types(spark, sf_dir):
    p = load(spark, sf_dir, "part").select("p_partkey", F.element_at(F.array(*map(F.lit, ("page_header", "section_header", "Title", "table", "formula", "list_item", "text", "footnote"))), (F.col("p_partkey") % 8 + 1).cast("int")).alias("label"))
    return p.select("p_partkey", T.layout_type(F.col("label")).alias("block_type"))


def author_names(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    given = F.when(F.col("c_custkey") % 3 == 0, None).otherwise(F.col("c_mktsegment"))
    surname = F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_name"))
    return c.select("c_custkey", X.author_name(given, surname).alias("name"), X.join_text(F.array(given, surname, F.lit("  "))).alias("joined"))


def contributor_route(spark, sf_dir):
    c = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    pick = lambda col, *xs: F.element_at(F.array(*map(F.lit, xs)), (F.col(col) % len(xs) + 1).cast("int"))
    person = F.struct(F.when(F.col("c_custkey") % 9 == 0, "").otherwise(F.col("c_name")).alias("name"), pick("c_custkey", "person", "organization", "robot").alias("entityType"), pick("c_custkey", "creator", "sponsor", "reviewer", "chief").alias("role"), F.col("c_mktsegment").alias("affiliation"), pick("c_custkey", "vendor", "shop").alias("organizationType"))
    per = c.groupBy("n_name").agg(F.array_sort(F.collect_list(F.struct("c_custkey", person.alias("p")))).alias("all")).select("n_name", F.transform("all", lambda x: x["p"]).alias("contributors"))
    names = lambda a: F.coalesce(F.array_join(F.transform(a, lambda x: F.concat_ws("|", x["name"], x["entityType"], x["role"], x["affiliation"], x["organizationType"])), ";"), F.lit(""))
    return per.select("n_name", *(F.md5(names(v).cast("binary")).alias(k) for k, v in metadata.people().items()))


def role_accumulate(spark, sf_dir):
    s = load(spark, sf_dir, "supplier").select("s_nationkey", F.col("s_suppkey").alias("pos"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("joined"), F.array("s_name").alias("list"), F.create_map(F.concat(F.lit("k"), F.col("s_suppkey") % 3), "s_name").alias("entries"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")).alias("single"))
    out = metadata.accumulate(s, ["s_nationkey"])
    return out.select("s_nationkey", "joined", F.array_join("list", ",").alias("list"), "single", F.array_join(F.transform(F.array_sort(F.map_entries("entries")), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",").alias("entries"))


def metadata_two_track(spark, sf_dir):
    d = spread(load(spark, sf_dir, "documents"), "doc_id")
    rules = d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("text")).alias("title"), F.when(F.col("doc_id") % 4 == 0, F.array(F.struct(F.lit("DOCKET").alias("scheme"), F.lit("NUREG/CR-1").alias("value")))).alias("identifier"), T.language(F.col("text")).alias("language"))
    l = load(spark, sf_dir, "labels")
    model = l.select(
        "doc_id", F.concat(F.lit("Model title "), F.col("doc_id")).alias("dc_title"), F.when(F.col("quality") == 1, "en").otherwise("x").alias("dc_language"), F.when(F.col("toxic") == 1, "Rant").otherwise("TechnicalReport").alias("dc_type"),
        F.array(F.struct(F.lit("odd").alias("scheme"), F.concat(F.lit("AB-"), F.col("doc_id")).alias("value")), F.struct(F.lit("DOI").alias("scheme"), F.lit("not one").alias("value"))).alias("dc_identifier"),
        F.struct(F.lit("2024-01-02").alias("created"), F.lit("2024").alias("issued"), F.lit(None).cast("string").alias("modified"), F.lit("").alias("valid")).alias("dc_date"),
    )
    out = metadata.two_tracks(rules, model)
    return out.select("doc_id", "dc_title", "dc_language", "dc_type", F.array_join(F.transform("dc_identifier", lambda x: F.concat_ws(":", x["scheme"], x["value"])), ",").alias("identifier"), F.col("dc_date.created").alias("created"), F.col("dc_date.issued").alias("issued"))


def metadata_override(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("dc_title"), F.col("lang").alias("dc_language"), F.lit("draft").alias("doc_status"))
    o = load(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, F.concat(F.lit("t"), F.col("doc_id"))).otherwise("").alias("dc_title"), F.lit(None).cast("string").alias("dc_language"), F.lit("new").alias("doc_status"))
    return metadata.override(d, o)


def doc_assemble(spark, sf_dir):
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    m = d.select("doc_id", F.when(F.col("quality") == 1, F.col("source")).otherwise("").alias("dc_title"), F.when(F.col("toxic") == 1, F.lit("Other")).alias("dc_type"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("dc_language"), F.when(F.col("doc_id") % 3 == 0, "Changed").when(F.col("doc_id") % 3 == 1, "final").alias("doc_status"), F.lit("f").alias("source_path"))
    items = docs.content(load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text")).withColumn("block_type", F.lit("paragraph")))
    r = docs.assemble(m, items, now="2024-01-01T00:00:00Z")
    return r.select("documentId", F.col("metadata.`dc:title`").alias("title"), F.col("metadata.`dc:type`").alias("type"), F.col("metadata.`dc:language`").alias("language"), F.col("provenance.validationStatus").alias("status"), F.size("content").cast("long").alias("n_blocks"))


def json_props(spark, sf_dir):
    """The events' JSON as flat columns (SNK7)."""
    e = load(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").alias("props"))
    return files.flatten(e).select("event_id", F.col("`props.k`").alias("k"))


def json_records(spark, sf_dir):
    n = load(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("n_name"))
    return files.records(n)


def flatten_columns(spark, sf_dir):
    s = load(spark, sf_dir, "supplier").select(F.struct("s_suppkey", F.struct("s_name", "s_nationkey").alias("who")).alias("s"))
    return files.flatten(s, "_")


def schema_errors(spark, sf_dir):
    """Errors of content items, one row each."""
    e = spread(load(spark, sf_dir, "events"), "event_id")
    b = e.select("event_id", F.when(F.col("event_id") % 5 == 0, None).otherwise(F.concat(F.lit("b"), F.col("event_id"))).alias("blockId"), F.when(F.col("event_id") % 2 == 0, "paragraph").otherwise(F.col("event_type")).alias("blockType"), F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("props")).alias("text"))
    x = b.select("event_id", F.explode(validate.errors(validate.BLOCK_RULES, "DOC_SCHEMA_VALIDATION_FAILED")).alias("e"))
    return x.select("event_id", F.col("e.target").alias("target"), F.col("e.validator").alias("validator"), F.col("e.code").alias("code"))


def problem_summary(spark, sf_dir):
    p = validate.problems(validate.promotion(merged(spark, sf_dir)))
    return p.groupBy("problem_type", F.col("error.target").alias("target"), F.col("error.errorClass").alias("error_class")).agg(F.count("*").alias("n"))


_DMC = """concat('DMC-M', o_custkey, '-A-', substring(o_orderpriority, 1, 1), '0-', o_orderkey % 9, '0-00-00AA-', CASE o_orderkey % 3 WHEN 0 THEN '040' WHEN 1 THEN '520' ELSE '999' END, 'A-A', CASE WHEN o_orderkey % 2 = 0 THEN '_001-00' ELSE '' END)"""
_TYPE = "CASE WHEN o_orderkey % 3 = 0 THEN 'TechnicalReport' ELSE 'Procedure' END"
_ACCESS = "CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 4 = 0 THEN 'restricted' ELSE 'public' END"
_HEAD = "'/dmodule/content/procedure/mainProcedure/levelledPara"

SQL = {
    "dmc_assemble": f"SELECT o_orderkey, {_DMC} AS dmc FROM orders",
    "date_from_attrs": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS issued FROM orders",
    "security_rights": f"SELECT o_orderkey, {_ACCESS} AS access_rights, concat(CASE WHEN o_orderkey % 5 = 0 THEN '02' ELSE '01' END, CASE WHEN o_orderkey % 4 = 0 THEN '_cc1' ELSE '' END) AS license FROM orders",
    "info_code_type": f"SELECT o_orderkey, {_TYPE} AS doc_type FROM orders",
    "xml_shred_roundtrip": f"""WITH s AS (SELECT o_orderkey, concat(o_orderkey % 7, '.1 Section') AS head, o_orderkey % 7 AS n, o_custkey, o_orderstatus, o_orderpriority FROM orders)
        SELECT o_orderkey, CAST(1 AS INT) AS pos, 'title' AS block_type, concat('Order ', o_orderkey, ' - ', o_orderpriority) AS text, CAST(0 AS INT) AS level, '' AS path, false AS has_parent, NULL AS section_label, NULL AS source_xpath FROM s
        UNION ALL SELECT o_orderkey, 2, 'section', head, 1, '', false, concat(n, '.1'), {_HEAD}' FROM s UNION ALL SELECT o_orderkey, 3, 'paragraph', concat('Total ', o_custkey), 999, head, true, NULL, {_HEAD}/para' FROM s
        UNION ALL SELECT o_orderkey, 4, 'procedureStep', concat('Step of ', o_orderstatus), 2, head, true, NULL, {_HEAD}/proceduralStep[1]' FROM s UNION ALL SELECT o_orderkey, 5, 'note', 'Only a note', 999, head, true, NULL, {_HEAD}/proceduralStep[2]/note' FROM s""",
    "xml_metadata": f"SELECT o_orderkey, concat('Order ', o_orderkey, ' - ', o_orderpriority) AS dc_title, {_TYPE} AS dc_type, {_DMC} AS identifier, strftime(o_orderdate, '%Y-%m-%d') AS issued, {_ACCESS} AS access_rights FROM orders",
    "step_suppression": "SELECT o_orderkey, CAST(1 AS BIGINT) AS steps, CAST(1 AS BIGINT) AS notes_of_section FROM orders",
    "catalog_detect": """WITH t AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(lower(html), '<([a-z0-9]+)', 1)) AS tag FROM pages), r AS (SELECT * FROM (VALUES (0, 's1000d', 'dmodule'), (1, 'jats', 'article'), (1, 'jats', 'pm')) AS v(priority, format, part))
        SELECT page_id, tag, arg_min(format, priority) AS format FROM t JOIN r ON contains(tag, part) GROUP BY ALL""",
    "html_blocks": r"""WITH f AS (SELECT page_id, regexp_extract_all(html, '<((?:p|h1|li)[^>]*>[^<]*)', 1) AS hits FROM pages), u AS (SELECT page_id, unnest(hits) AS hit, generate_subscripts(hits, 1) - 1 AS pos FROM f)
        SELECT page_id, CAST(pos AS INT) AS pos, CASE regexp_extract(hit, '^(p|h1|li)', 1) WHEN 'h1' THEN 'title' WHEN 'li' THEN 'listItem' ELSE 'paragraph' END AS block_type, trim(regexp_replace(regexp_replace(hit, '^[^>]*>', ''), '[ \n\r\t]+', ' ', 'g')) AS text FROM u""",
    "relation_edges": """WITH u AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS target FROM pages) SELECT page_id, target, count(*) AS n FROM u GROUP BY ALL""",
    "relation_vocab": """WITH k AS (SELECT CASE event_id % 3 WHEN 0 THEN 'CITES' WHEN 1 THEN concat('custom:', event_type) ELSE upper(event_type) END AS relation_type FROM events)
        SELECT relation_type, relation_type IN ('CITES', 'REFERENCES', 'IS_CITED_BY', 'SUPERSEDES', 'IS_SUPERSEDED_BY', 'SUPPLEMENTS', 'IS_SUPPLEMENTED_BY', 'REQUIRES', 'IS_REQUIRED_BY', 'RELATED_TO', 'DERIVES_FROM', 'HAS_VERSION', 'IMPLEMENTS', 'CONTRADICTS')
            OR regexp_matches(relation_type, '^custom:[a-zA-Z0-9_.-]+$') AS ok, count(*) AS n FROM k GROUP BY ALL""",
    "structured_keys": "SELECT event_id, array_to_string(json_keys(props), ',') AS unknown FROM events",
    "content_mapping": """SELECT user_id AS doc_id, CASE WHEN event_id % 2 = 0 THEN concat('b', event_id) ELSE printf('block-%04d', event_id) END AS "blockId", CASE event_id % 4 WHEN 0 THEN 'equation' WHEN 1 THEN 'paragraph' ELSE 'section' END AS "blockType",
        CAST(CASE WHEN event_id % 3 <> 0 THEN 2 END AS INT) AS level, CAST(CASE WHEN event_id % 5 = 0 THEN 0.8 END AS DOUBLE) AS "extractionConfidence", CASE WHEN event_id % 4 = 0 THEN props END AS latex,
        CASE WHEN event_id % 7 = 0 THEN CASE WHEN event_id % 2 = 0 THEN concat('b', event_id) ELSE printf('block-%04d', event_id) END END AS "fragmentRef" FROM events""",
    "layout_types": "SELECT p_partkey, ['section', 'section', 'title', 'table', 'equation', 'list', 'paragraph', 'paragraph'][p_partkey % 8 + 1] AS block_type FROM part",
    "author_names": """WITH n AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS g, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS s FROM customer)
        SELECT c_custkey, nullif(trim(concat(coalesce(g, ''), ' ', s)), '') AS name, nullif(concat_ws('; ', g, nullif(s, '')), '') AS joined FROM n""",
    "contributor_route": """WITH c AS (SELECT n_name, c_custkey, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE c_name END AS name, ['person', 'organization', 'organization'][c_custkey % 3 + 1] AS kind, ['creator', 'sponsor', 'reviewer', 'chief'][c_custkey % 4 + 1] AS role, c_mktsegment, ['vendor', 'shop'][c_custkey % 2 + 1] AS org FROM customer JOIN nation ON c_nationkey = n_nationkey),
        s AS (SELECT *, concat_ws('|', name, kind, CASE WHEN role <> 'creator' THEN role END, CASE WHEN kind = 'person' THEN c_mktsegment END, CASE WHEN kind = 'organization' AND org = 'vendor' THEN org END) AS x FROM c)
        SELECT n_name, md5(coalesce(string_agg(x, ';' ORDER BY c_custkey) FILTER (role = 'creator' AND name <> ''), '')) AS dc_creator, md5(coalesce(string_agg(x, ';' ORDER BY c_custkey) FILTER (role = 'reviewer' AND name <> ''), '')) AS dc_contributor,
            md5(coalesce(string_agg(x, ';' ORDER BY c_custkey) FILTER (role = 'sponsor' AND name <> ''), '')) AS dc_publisher FROM s GROUP BY n_name""",
    "role_accumulate": """WITH e AS (SELECT s_nationkey, concat('k', s_suppkey % 3) AS k, arg_max(s_name, s_suppkey) AS v FROM supplier GROUP BY ALL), m AS (SELECT s_nationkey, string_agg(concat(k, '=', v), ',' ORDER BY k) AS entries FROM e GROUP BY ALL)
        SELECT s.s_nationkey, string_agg(s_name, '; ' ORDER BY s_suppkey) FILTER (s_suppkey % 2 = 0) AS joined, string_agg(s_name, ',' ORDER BY s_suppkey) AS list, arg_max(s_name, s_suppkey) FILTER (s_suppkey % 3 = 0) AS single, any_value(entries) AS entries
        FROM supplier s JOIN m ON m.s_nationkey = s.s_nationkey GROUP BY s.s_nationkey""",
    "metadata_two_track": """WITH h AS (SELECT doc_id, text, length(left(text, 2000)) - length(regexp_replace(left(text, 2000), '[A-Za-z]', '', 'g')) AS e FROM documents)
        SELECT d.doc_id, coalesce(CASE WHEN d.doc_id % 3 = 0 THEN nullif(text, '') END, CASE WHEN l.doc_id IS NOT NULL THEN concat('Model title ', l.doc_id) END) AS dc_title, CASE WHEN quality = 1 THEN 'en' ELSE CASE WHEN text = '' THEN 'ko' ELSE 'en' END END AS dc_language,
            CASE WHEN toxic = 0 THEN 'TechnicalReport' END AS dc_type, CASE WHEN d.doc_id % 4 = 0 THEN 'DOCKET:NUREG/CR-1' WHEN l.doc_id IS NOT NULL THEN concat('DOCKET:AB-', l.doc_id) END AS identifier, CASE WHEN l.doc_id IS NOT NULL THEN '2024-01-02' END AS created, CAST(NULL AS VARCHAR) AS issued
        FROM h d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "metadata_override": "SELECT d.doc_id, CASE WHEN quality = 1 THEN concat('t', d.doc_id) ELSE source END AS dc_title, lang AS dc_language, 'draft' AS doc_status FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
    "doc_assemble": """SELECT CAST(d.doc_id AS VARCHAR) AS "documentId", CASE WHEN quality = 1 THEN source ELSE 'Unknown title (from PDF)' END AS title, CASE WHEN toxic = 1 THEN 'Other' ELSE 'TechnicalReport' END AS type, CASE WHEN d.doc_id % 2 = 0 THEN lang ELSE 'ko' END AS language,
        CASE d.doc_id % 3 WHEN 0 THEN 'partial' WHEN 1 THEN 'validated' ELSE 'draft' END AS status, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_blocks FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "json_records": """SELECT concat('{"n_nationkey":"', n_nationkey, '","n_name":"', CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE '' END, '"}') AS record FROM nation""",
    "flatten_columns": "SELECT s_suppkey AS s_s_suppkey, s_name AS s_who_s_name, s_nationkey AS s_who_s_nationkey FROM supplier",
    "schema_errors": """SELECT event_id, 'blockId' AS target, 'required' AS validator, 'DOC_SCHEMA_VALIDATION_FAILED' AS code FROM events WHERE event_id % 5 = 0 UNION ALL SELECT event_id, 'blockType', 'enum', 'DOC_SCHEMA_VALIDATION_FAILED' FROM events WHERE event_id % 2 <> 0
        UNION ALL SELECT event_id, 'text', 'required', 'DOC_SCHEMA_VALIDATION_FAILED' FROM events WHERE event_id % 7 = 0""",
    "problem_summary": _CHECKED + """, e AS (SELECT 'term-missing-fields' AS problem_type, 'definition_en' AS target, 'user_input' AS error_class FROM p WHERE missing
        UNION ALL SELECT 'term-schema-validation', 'definition_en', 'system_bug' FROM p WHERE NOT missing AND e1 UNION ALL SELECT 'term-schema-validation', 'definition_ko', 'system_bug' FROM p WHERE NOT missing AND e2
        UNION ALL SELECT 'term-schema-validation', 'domain[0]', 'system_bug' FROM p WHERE NOT missing AND e3) SELECT problem_type, target, error_class, count(*) AS n FROM e GROUP BY ALL""",
}
QUERIES = {
    f.__name__: f
    for f in (
        dmc_assemble, date_from_attrs, security_rights, info_code_type, xml_shred_roundtrip, xml_metadata, step_suppression, catalog_detect, html_blocks, relation_edges, relation_vocab, structured_keys, content_mapping,
        layout_types, author_names, contributor_route, role_accumulate, metadata_two_track, metadata_override, doc_assemble, json_props, json_records, flatten_columns, schema_errors, problem_summary,
    )
}
