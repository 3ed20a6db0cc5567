"""Queries of layout, sections, trees and equations, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import equations, layout, sections, tree
from ..sources.tables import spread
from .term_queries import derive, duck, load

# layout blocks of a document per brand, out of parts
BLOCKS = """
    SELECT p_brand AS doc_id, CAST(p_partkey AS BIGINT) AS pos, CAST(1 + p_partkey % 9 AS INT) AS page,
           CASE WHEN p_size % 6 = 0 THEN concat(CAST(p_size AS VARCHAR(9)), '.', CAST(p_partkey % 7 AS VARCHAR(9)), ' ', p_name) WHEN p_size % 6 = 1 THEN upper(p_name) WHEN p_size % 6 = 2 THEN concat('Appendix B ', p_name)
                WHEN p_size % 6 = 3 THEN concat(p_name, ' NUREG/CR-', CAST(p_partkey AS VARCHAR(9)), ' and ANL-98/31.') WHEN p_size % 6 = 4 THEN p_name ELSE concat('A.', CAST(p_size AS VARCHAR(9)), ' ', p_name, '?') END AS text,
           CAST(10 + p_size % 8 AS DOUBLE) AS max_font, CAST(10 + p_size % 8 AS DOUBLE) AS font_size, p_partkey % 3 = 0 AS is_bold, CAST(p_size * 2 AS DOUBLE) AS x0, CAST(p_size * 2 + 300 AS DOUBLE) AS x1,
           CAST(p_partkey % 800 AS DOUBLE) AS y0, CAST(p_partkey % 800 + 12 AS DOUBLE) AS y1, CAST(400 AS DOUBLE) AS page_width, CAST(800 AS DOUBLE) AS page_height, CAST(10 AS DOUBLE) AS body_font
    FROM {part}"""
LABELLED = """SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 4 = 0 THEN p_name WHEN l_suppkey % 4 = 1 THEN concat(CAST(l_linenumber AS VARCHAR(9)), '.', CAST(l_suppkey % 10 AS VARCHAR(9)), ' ', p_name)
    WHEN l_suppkey % 4 = 2 THEN concat('appendix C  ', p_name) ELSE concat(CAST(l_linenumber AS VARCHAR(9)), '. ', p_name) END AS text FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"""
TURNS = """SELECT CAST(conv_id AS BIGINT) AS doc_id, CAST(turn AS BIGINT) AS pos, CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE CASE WHEN turn % 3 = 0 THEN 999 ELSE 2 END END AS level, text, role FROM {conversations}"""
# boxes of the lines of 256 order keys a document (of one, for supplement_sort)
BOXES = """SELECT CAST(floor(l_orderkey / 256.0) AS BIGINT) AS doc_id, CAST(1 + l_linenumber % 4 AS INT) AS page, l_partkey, CAST(l_partkey % 500 AS DOUBLE) AS x0, CAST(l_partkey % 500 + 20 AS DOUBLE) AS x1, CAST(l_suppkey % 97 * 8 AS DOUBLE) AS y0, CAST(l_suppkey % 97 * 8 + 6 AS DOUBLE) AS y1,
    CASE WHEN l_quantity < 10 THEN 'abcd' ELSE 'text of a box' END AS text, l_returnflag FROM {lineitem}"""
ORDER_BOXES = BOXES.replace("floor(l_orderkey / 256.0)", "l_orderkey")


def section_label(spark, sf_dir):
    t = derive(spark, sf_dir, LABELLED, "lineitem", "part").withColumn("s", T.section_label(F.col("text")))
    return t.select("l_orderkey", "l_linenumber", F.col("s.label").alias("label"), F.col("s.title").alias("title"), T.label_depth(F.col("s.label")).cast("int").alias("depth"))


def blocks(spark, sf_dir) -> DataFrame:
    return derive(spark, sf_dir, BLOCKS, "part")


def section_fasttrack(spark, sf_dir):
    """Sections by bookmark, contents entry or score."""
    b = blocks(spark, sf_dir)
    marks = b.where("pos % 5 = 0").select("doc_id", "pos", (F.col("pos") % 3 + 1).cast("int").alias("depth"), F.upper("text").alias("title"))
    toc = b.where("pos % 7 = 0").select("doc_id", "pos", F.when(F.col("pos") % 2 == 0, F.concat(F.lit("3."), F.col("page").cast("string"))).otherwise("").alias("label"), F.col("text").alias("title"))
    out = sections.classify(b, marks, toc)
    return out.select("doc_id", "pos", "level", "block_type", F.round("confidence", 6).alias("confidence"), "section_label", "section_title", "decision")


def section_score(spark, sf_dir):
    s = blocks(spark, sf_dir).withColumns(sections.score_columns())
    return s.select("doc_id", "pos", F.col("_points").cast("int").alias("points"), (F.col("_points") >= 70).alias("is_section"))


def body_font_mode(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_id", (F.floor("value") % 5 / 2 + 8).alias("size"))
    return layout.mode_first(e, ["user_id"], "size", "event_id").select("user_id", F.col("size").alias("body_font"))


def block_features(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("pos"), F.col("event_type").alias("text"), F.col("value").alias("size"), F.when(F.col("event_id") % 40 == 0, 16).otherwise(4).alias("flags"), F.concat(F.lit("font"), F.col("event_id") % 3).alias("font"))
    return layout.block_features(e, ["user_id"]).select("user_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "max_font", "is_bold", "font_name")


def title_argmax(spark, sf_dir):
    return layout.title(blocks(spark, sf_dir)).select("doc_id", "title")


def identifier_extract(spark, sf_dir):
    found = layout.document_identifiers(blocks(spark, sf_dir))
    return found.select("doc_id", F.size("dc_identifier").cast("long").alias("n"), F.array_join(F.transform("dc_identifier", lambda x: x["value"]), ",").alias("ids"))


def document_identifiers(spark, sf_dir):
    d = load(spark, sf_dir, "documents").select("doc_id", F.explode(T.identifiers(F.col("text"))).alias("value"))
    return d.groupBy("doc_id", "value").agg(F.count("*").alias("n"))


def scanned_route(spark, sf_dir):
    pages = load(spark, sf_dir, "documents").select(F.expr("doc_id div 2").alias("doc_id"), F.col("doc_id").alias("page"), "text")
    return layout.source_route(pages, F.col("page") % 11 == 0, True).select("doc_id", F.round("chars_per_page", 6).alias("chars_per_page"), "route")


def frontmatter_prune(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("page"))
    return layout.front_pages(c, "conv_id").select("conv_id", "page")


def language_detect(spark, sf_dir):
    d = spread(load(spark, sf_dir, "documents"), "doc_id")
    mixed = F.when(F.col("doc_id") % 4 == 0, F.translate("text", "aeiou", "가나다라마")).otherwise(F.col("text"))
    return d.select("doc_id", T.language(mixed).alias("language"), T.count_of(mixed, "가-힯").alias("hangul"), T.math_signs(F.col("text")).alias("signs"))


def toc_entries(spark, sf_dir):
    p = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), (F.col("o_orderkey") % 30).alias("page"), "o_orderkey", "o_orderpriority")
    lines = F.concat(F.lit("Table of Contents\n"), F.col("o_orderkey").cast("string"), F.lit(".1 Part "), F.col("o_orderpriority"), F.lit(" ....... 12\nA.2 Short\nno label here\n7 X"))
    pages = p.groupBy("doc_id", "page").agg(F.min("o_orderkey").alias("o_orderkey"), F.min("o_orderpriority").alias("o_orderpriority")).select("doc_id", "page", F.when(F.col("o_orderkey") % 2 == 0, lines).otherwise("plain page").alias("text"))
    return sections.toc_entries(pages).select("doc_id", F.col("pos").cast("int").alias("pos"), "label", "title")


def turns(spark, sf_dir) -> DataFrame:
    return derive(spark, sf_dir, TURNS, "conversations")


def context_parent(spark, sf_dir):
    return tree.context_stack(turns(spark, sf_dir), title="role", levels=(0, 1, 2)).select("doc_id", "pos", "parent_pos")


def context_path(spark, sf_dir):
    out = tree.context_fold(turns(spark, sf_dir).withColumn("title", F.concat_ws(":", "role", "pos")), title="title")
    return out.select("doc_id", "pos", F.array_join("context_path", "/").alias("path"))


def parent_integrity(spark, sf_dir):
    t = turns(spark, sf_dir).withColumn("block_id", F.concat_ws("-", "doc_id", "pos")).withColumn("parent_id", F.when(F.col("pos") > 0, F.concat_ws("-", "doc_id", F.col("pos") - F.when(F.col("pos") % 5 == 0, 100).otherwise(1))))
    return tree.orphans(t).select("doc_id", "pos", "parent_id")


def equation_flag(spark, sf_dir):
    s = spread(load(spark, sf_dir, "documents"), "doc_id").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where("line <> ''")
    return s.select("doc_id", "pos", T.is_equation(F.col("line")).alias("is_equation"), T.math_signs(F.col("line")).alias("signs"))


def _equation_turns(spark, sf_dir) -> DataFrame:
    t = turns(spark, sf_dir)
    text = F.when(F.col("pos") % 4 == 1, F.concat(F.lit("N = C / S ("), F.col("pos").cast("string"), F.lit(".1)"))).when(F.col("pos") % 4 == 0, F.concat("text", F.lit(" given by"))).when(F.col("pos") % 4 == 2, F.concat(F.lit("where "), "text")).otherwise(F.col("text"))
    return t.select("doc_id", "pos", F.lit("paragraph").alias("block_type"), text.alias("text"))


def equation_context(spark, sf_dir):
    out = equations.reclassify(_equation_turns(spark, sf_dir))
    return out.select("doc_id", "pos", "block_type", F.col("equation_data.equationNumber").alias("number"))


def overlap_anti(spark, sf_dir):
    b = derive(spark, sf_dir, BOXES, "lineitem")
    return equations.missed(b.where("l_returnflag = 'R'"), b.where("l_returnflag <> 'R'").withColumn("page_height", F.lit(800.0))).select("doc_id", "page", "l_partkey", "x0", "y0")


def supplement_sort(spark, sf_dir):
    b = derive(spark, sf_dir, ORDER_BOXES, "lineitem")
    have = b.where("l_returnflag <> 'R'").groupBy("doc_id", "page", "x0", "y0").agg((F.min("l_partkey") * 10000 + F.col("page") * 1000 + F.col("y0")).cast("long").alias("pos")).withColumn("text", F.lit("a paragraph")).withColumn("block_type", F.lit("paragraph"))
    extra = b.where("l_returnflag = 'R'").groupBy("doc_id", "page", "x0", "y0").agg((F.min("l_partkey") * 10000 + F.col("page") * 1000 + F.col("y0")).cast("long").alias("pos")).withColumn("text", F.concat(F.lit("a = b  c ("), F.col("pos").cast("string"), F.lit(".2)")))
    out = equations.supplement(have, extra.select("doc_id", "page", "x0", "y0", "pos", "text"))
    return out.select("doc_id", F.col("pos").cast("long").alias("pos"), "page", "y0", "block_type", F.col("equation_data.latex").alias("latex"), F.col("equation_data.equationNumber").alias("number"))


def inline_eq_split(spark, sf_dir):
    """Pieces of paragraphs with equations in them."""
    t = derive(spark, sf_dir, LABELLED, "lineitem", "part")
    text = F.concat(F.lit("The life of "), F.col("text"), F.lit(" is given by N = C / "), F.col("l_orderkey").cast("string"), F.lit(" ("), F.col("l_linenumber").cast("string"), F.lit(".1) and then more text as S = 2 ("), F.col("l_linenumber").cast("string"), F.lit("). End"))
    b = t.select("l_orderkey", "l_linenumber", F.lit("paragraph").alias("block_type"), F.when(F.col("l_linenumber") % 3 == 0, F.col("text")).otherwise(text).alias("text"))
    return equations.split_inline(b, "l_orderkey", "l_linenumber")


_LABEL = r"""CASE WHEN regexp_matches(text, '^\d+(\.\d+)*\.?\s+.+') THEN regexp_extract(text, '^(\d+(?:\.\d+)*)\.?\s+(.+)', 1) WHEN regexp_matches(text, '^[A-Z]\.\d*\s+.+') THEN regexp_extract(text, '^([A-Z]\.\d*)\s+(.+)', 1)
    WHEN regexp_matches(text, '(?i)^Appendix\s+[A-Z]\s+.+') THEN regexp_extract(text, '(?i)^(Appendix\s+[A-Z])\s+(.+)', 1) END"""
_TITLE = r"""CASE WHEN regexp_matches(text, '^\d+(\.\d+)*\.?\s+.+') THEN regexp_extract(text, '^(\d+(?:\.\d+)*)\.?\s+(.+)', 2) WHEN regexp_matches(text, '^[A-Z]\.\d*\s+.+') THEN regexp_extract(text, '^([A-Z]\.\d*)\s+(.+)', 2)
    WHEN regexp_matches(text, '(?i)^Appendix\s+[A-Z]\s+.+') THEN regexp_extract(text, '(?i)^(Appendix\s+[A-Z])\s+(.+)', 2) END"""
_DEPTH = "CAST(length(label) - length(replace(label, '.', '')) + 1 AS INT)"
_SCORED = f"""WITH b AS ({duck(BLOCKS)}), l AS (SELECT *, {_LABEL} AS label, {_TITLE} AS title, max_font / body_font AS ratio FROM b),
    s AS (SELECT *, CASE WHEN ratio >= 1.5 THEN 50 WHEN ratio >= 1.2 THEN 40 WHEN ratio >= 1.1 THEN 20 ELSE 0 END + CASE WHEN label IS NOT NULL THEN 30 ELSE 0 END + CASE WHEN is_bold THEN 20 ELSE 0 END
            + CASE WHEN abs((x0 + x1) / 2 - page_width / 2) < page_width * 0.1 THEN 10 ELSE 0 END + CASE WHEN text = upper(text) AND length(text) > 5 THEN 20 ELSE 0 END - CASE WHEN right(text, 1) IN ('.', '?', '!') THEN 50 ELSE 0 END
            - CASE WHEN len(string_split_regex(trim(text), '\\s+')) > 30 THEN 30 ELSE 0 END AS points FROM l)"""
_TURNS = duck(TURNS)
SQL = {
    "section_label": f"WITH t AS ({duck(LABELLED)}), l AS (SELECT *, {_LABEL} AS label, {_TITLE} AS title FROM t) SELECT l_orderkey, l_linenumber, label, title, {_DEPTH} AS depth FROM l",
    "section_score": _SCORED + " SELECT doc_id, pos, CAST(points AS INT) AS points, points >= 70 AS is_section FROM s",
    "section_fasttrack": _SCORED + f""", m AS (SELECT doc_id, lower(text) AS k, arg_max(CAST(pos % 3 + 1 AS INT), pos) AS mark FROM b WHERE pos % 5 = 0 GROUP BY ALL),
        t AS (SELECT doc_id, lower(text) AS k, arg_max(CASE WHEN pos % 2 = 0 THEN concat('3.', page) ELSE '' END, pos) AS toc FROM b WHERE pos % 7 = 0 GROUP BY ALL),
        j AS (SELECT s.*, mark, toc, CASE WHEN mark IS NOT NULL THEN mark WHEN toc IS NOT NULL THEN CASE WHEN toc <> '' THEN length(toc) - length(replace(toc, '.', '')) + 1 ELSE 1 END
                WHEN points >= 70 THEN CASE WHEN label IS NOT NULL THEN {_DEPTH} WHEN ratio >= 1.5 THEN 1 ELSE 2 END ELSE 999 END AS level
              FROM s LEFT JOIN m ON s.doc_id = m.doc_id AND lower(s.text) = m.k LEFT JOIN t ON s.doc_id = t.doc_id AND lower(s.text) = t.k)
        SELECT doc_id, pos, CAST(level AS INT) AS level, CASE WHEN mark IS NULL AND toc IS NULL AND points < 70 THEN 'paragraph' WHEN level = 0 THEN 'title' WHEN level = 1 THEN 'section' ELSE 'subsection' END AS block_type,
            round(CASE WHEN mark IS NOT NULL THEN 1.0 WHEN toc IS NOT NULL THEN 0.95 WHEN points >= 70 THEN least(points / 100.0, 0.95) ELSE greatest(0.0, 1 - greatest(points, 0) / 100.0) END::DOUBLE, 6) AS confidence,
            CASE WHEN mark IS NOT NULL THEN label WHEN toc IS NOT NULL THEN toc WHEN points >= 70 THEN label END AS section_label,
            CASE WHEN mark IS NOT NULL THEN coalesce(nullif(title, ''), text) WHEN toc IS NOT NULL THEN text WHEN points >= 70 THEN coalesce(title, text) END AS section_title,
            CASE WHEN mark IS NOT NULL THEN 'bookmark' WHEN toc IS NOT NULL THEN 'toc' WHEN points >= 70 THEN concat('score:', points) ELSE concat('body:', points) END AS decision FROM j""",
    "body_font_mode": """WITH e AS (SELECT user_id, event_id, floor(value) % 5 / 2 + 8 AS size FROM events), c AS (SELECT user_id, size, count(*) AS n, min(event_id) AS first FROM e GROUP BY ALL)
        SELECT user_id, size AS body_font FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) = 1""",
    "block_features": """WITH e AS (SELECT *, concat('font', event_id % 3) AS font FROM events), n AS (SELECT user_id, font, count(*) AS n, min(event_id) AS first FROM e GROUP BY ALL), f AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) = 1)
        SELECT e.user_id, md5(string_agg(event_type, ' ' ORDER BY event_id)) AS text_md5, max(value) AS max_font, bool_or(event_id % 40 = 0) AS is_bold, any_value(f.font) AS font_name FROM e JOIN f ON e.user_id = f.user_id GROUP BY e.user_id""",
    "title_argmax": f"""WITH b AS ({duck(BLOCKS)}), s AS (SELECT *, CASE WHEN font_size >= body_font * 1.4 THEN 3 ELSE 0 END + CASE WHEN is_bold THEN 2 ELSE 0 END
        + CASE WHEN x0 / page_width > 0.15 AND (page_width - x1) / page_width > 0.15 THEN 2 ELSE 0 END + CASE WHEN y0 < page_height * 0.5 THEN 1 ELSE 0 END + CASE WHEN length(text) BETWEEN 10 AND 200 THEN 1 ELSE 0 END AS score FROM b WHERE page = 1)
        SELECT doc_id, CASE WHEN score > 0 THEN text END AS title FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) = 1""",
    "identifier_extract": f"""WITH b AS ({duck(BLOCKS)}), f AS (SELECT doc_id, pos, unnest(regexp_extract_all(text, '[A-Z][A-Z0-9]{{1,}}[-/][A-Z0-9][-A-Z0-9/.-]*')) AS value, unnest(range(len(regexp_extract_all(text, '[A-Z][A-Z0-9]{{1,}}[-/][A-Z0-9][-A-Z0-9/.-]*')))) AS i
            FROM b WHERE page = 1 OR y0 < page_height * 0.1 OR y1 > page_height * 0.9), u AS (SELECT doc_id, value, min(pos * 1000 + i) AS k FROM f GROUP BY ALL)
        SELECT doc_id, count(*) AS n, string_agg(value, ',' ORDER BY k) AS ids FROM u GROUP BY doc_id""",
    "document_identifiers": """WITH f AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][A-Z0-9]{1,}[-/][A-Z0-9][-A-Z0-9/.-]*')) AS value FROM documents) SELECT doc_id, value, count(*) AS n FROM f GROUP BY ALL""",
    "scanned_route": """WITH p AS (SELECT doc_id // 2 AS d, doc_id AS page, text FROM documents),
        g AS (SELECT d AS doc_id, sum(length(text)) / count(DISTINCT page) AS per, bool_or(page % 11 = 0) AS s FROM p GROUP BY d) SELECT doc_id, round(per, 6) AS chars_per_page, CASE WHEN per < 50 THEN 'vision' WHEN s THEN 'structural' ELSE 'layout' END AS route FROM g""",
    "frontmatter_prune": """SELECT conv_id, turn AS page FROM conversations QUALIFY turn <= 4 OR turn > max(turn) OVER (PARTITION BY conv_id) - 2""",
    "language_detect": """WITH t AS (SELECT doc_id, text AS raw, CASE WHEN doc_id % 4 = 0 THEN translate(text, 'aeiou', '가나다라마') ELSE text END AS x FROM documents),
        c AS (SELECT *, length(x) - length(regexp_replace(x, '[가-힣]', '', 'g')) AS hangul, length(left(x, 2000)) - length(regexp_replace(left(x, 2000), '[가-힣]', '', 'g')) AS h, length(left(x, 2000)) - length(regexp_replace(left(x, 2000), '[A-Za-z]', '', 'g')) AS e FROM t)
        SELECT doc_id, CASE WHEN coalesce(x, '') = '' THEN 'ko' WHEN h >= 50 OR h > e THEN 'ko' ELSE 'en' END AS language, CAST(hangul AS INT) AS hangul,
            CAST(length(raw) - length(regexp_replace(raw, '[∑∫√±αβγδεζηθικλμνξοπρστυφχψωΔΓΘΛΞΠΣΦΨΩ=+*/<>≤≥≈≠-]', '', 'g')) AS INT) AS signs FROM c""",
    "toc_entries": r"""WITH p AS (SELECT o_custkey AS doc_id, o_orderkey % 30 AS page, min(o_orderkey) AS k, min(o_orderpriority) AS pr FROM orders GROUP BY ALL), f AS (SELECT doc_id, min(page) AS page FROM p WHERE k % 2 = 0 AND page <= 16 GROUP BY doc_id),
        j AS (SELECT p.* FROM p JOIN f USING (doc_id, page)) SELECT doc_id, CAST(1 AS INT) AS pos, concat(k, '.1') AS label, concat('Part ', pr) AS title FROM j UNION ALL SELECT doc_id, CAST(2 AS INT), 'A.2', 'Short' FROM j
        UNION ALL SELECT doc_id, CAST(4 AS INT), '7', 'X' FROM j""",
    "context_parent": f"""WITH t AS ({_TURNS}) SELECT a.doc_id, a.pos, (SELECT max(b.pos) FROM t b WHERE b.doc_id = a.doc_id AND b.pos < a.pos AND b.level < a.level AND b.level < 999) AS parent_pos FROM t a""",
    "context_path": f"""WITH RECURSIVE t AS ({_TURNS}), p AS (SELECT a.doc_id, a.pos, a.role, (SELECT max(b.pos) FROM t b WHERE b.doc_id = a.doc_id AND b.pos < a.pos AND b.level < a.level AND b.level < 999) AS up FROM t a),
        r AS (SELECT doc_id, pos, up, '' AS path FROM p UNION ALL SELECT r.doc_id, r.pos, p.up, concat(p.role, ':', p.pos, CASE WHEN r.path = '' THEN '' ELSE concat('/', r.path) END) FROM r JOIN p ON p.doc_id = r.doc_id AND p.pos = r.up)
        SELECT doc_id, pos, path FROM r WHERE up IS NULL""",
    "parent_integrity": f"""WITH t AS ({_TURNS}), k AS (SELECT doc_id, pos, concat_ws('-', doc_id, pos) AS id, CASE WHEN pos > 0 THEN concat_ws('-', doc_id, pos - CASE WHEN pos % 5 = 0 THEN 100 ELSE 1 END) END AS parent_id FROM t)
        SELECT doc_id, pos, parent_id FROM k WHERE parent_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k o WHERE o.doc_id = k.doc_id AND o.id = k.parent_id)""",
    "equation_flag": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
        c AS (SELECT *, length(line) - length(regexp_replace(line, '[∑∫√±αβγδεζηθικλμνξοπρστυφχψωΔΓΘΛΞΠΣΦΨΩ=+*/<>≤≥≈≠-]', '', 'g')) AS n FROM l WHERE line <> '')
        SELECT doc_id, CAST(pos AS INT) AS pos, regexp_matches(trim(line), '\(\d+(\.\d+)*\)$') OR (length(line) > 3 AND (n >= 3 OR n / length(line) > 0.1)) AS is_equation, CAST(n AS INT) AS signs FROM c""",
    "equation_context": rf"""WITH t AS ({_TURNS}), x AS (SELECT doc_id, pos, trim(CASE pos % 4 WHEN 1 THEN concat('N = C / S (', pos, '.1)') WHEN 0 THEN concat(text, ' given by') WHEN 2 THEN concat('where ', text) ELSE text END, ' ' || chr(10)) AS s FROM t),
        n AS (SELECT *, lower(coalesce(lag(s) OVER w, '')) AS p, lower(coalesce(lead(s) OVER w, '')) AS q, length(s) - length(regexp_replace(s, '[∑∫√±αβγδεζηθικλμνξοπρστυφχψωΔΓΘΛΞΠΣΦΨΩ=+*/<>≤≥≈≠-]', '', 'g')) AS g, contains(s, '=') AS eq FROM x WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
        k AS (SELECT *, CASE WHEN length(s) < 100 THEN 1 ELSE 0 END + CASE WHEN regexp_matches(s, '\(\d+(\.\d+)*[a-zA-Z]?\)\s*$') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(p, '(where|given by|defined as|as follows|expressed as|is|equation|equation:|식|다음과 같다)$') THEN 2 ELSE 0 END
            + CASE WHEN regexp_matches(q, '^(where|from|in which|here|여기서)') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(concat(p, ' ', q), '\b(eq\.|eqs\.|equation|수식)\b') THEN 1 ELSE 0 END + CASE WHEN eq OR g >= 2 THEN 2 ELSE 0 END
            - CASE WHEN regexp_matches(lower(s), '(where|given by|defined as|as follows|expressed as|is|equation|equation:|식|다음과 같다)$') THEN 3 ELSE 0 END - CASE WHEN length(s) > 200 AND g < 3 THEN 3 ELSE 0 END
            - CASE WHEN regexp_matches(s, '[\w.-]+@[\w.-]+') THEN 5 ELSE 0 END - CASE WHEN NOT eq AND regexp_matches(s, '\d{{2,3}}-\d{{3,4}}-\d{{4}}') THEN 5 ELSE 0 END AS score FROM n)
        SELECT doc_id, pos, CASE WHEN score >= 3 AND s <> '' THEN 'equation' ELSE 'paragraph' END AS block_type, CASE WHEN score >= 3 AND s <> '' THEN regexp_extract(s, '\((\d+(\.\d+)*[a-zA-Z]?)\)\s*$', 1) END AS number FROM k""",
    "overlap_anti": f"""WITH b AS ({duck(BOXES)}), r AS (SELECT *, CASE WHEN 800 - y1 < 0 OR 800 - y0 < 0 THEN y0 ELSE 800 - y1 END - 5 AS a, CASE WHEN 800 - y1 < 0 OR 800 - y0 < 0 THEN y1 ELSE 800 - y0 END + 5 AS z FROM b WHERE l_returnflag <> 'R' AND length(text) >= 5)
        SELECT doc_id, page, l_partkey, x0, y0 FROM b WHERE l_returnflag = 'R' AND NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = b.doc_id AND r.page = b.page AND NOT (b.x1 < r.x0 - 5 OR b.x0 > r.x1 + 5 OR b.y1 < r.a OR b.y0 > r.z))""",
    "supplement_sort": f"""WITH b AS ({duck(ORDER_BOXES)}), h AS (SELECT doc_id, page, x0, y0, min(l_partkey) AS p, 0 AS new FROM b WHERE l_returnflag <> 'R' GROUP BY ALL),
        e AS (SELECT doc_id, page, x0, y0, min(l_partkey) AS p, 1 AS new FROM b WHERE l_returnflag = 'R' GROUP BY ALL), u AS (SELECT *, CAST(p * 10000 + page * 1000 + y0 AS BIGINT) AS pos FROM (SELECT * FROM h UNION ALL SELECT * FROM e)), g AS (SELECT *, max(new) OVER (PARTITION BY doc_id) AS any_new FROM u)
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN any_new > 0 THEN page END, CASE WHEN any_new > 0 THEN y0 END, new, pos) AS pos, page, y0, CASE WHEN new = 1 THEN 'equation' ELSE 'paragraph' END AS block_type,
            CASE WHEN new = 1 THEN 'a = b c' END AS latex, CASE WHEN new = 1 THEN concat(g.pos, '.2') END AS number FROM g""",
    "inline_eq_split": f"""WITH t AS ({duck(LABELLED)}), w AS (SELECT * FROM t WHERE l_linenumber % 3 <> 0)
        SELECT l_orderkey, l_linenumber, 'paragraph' AS block_type, text, CAST(0 AS INT) AS part, NULL AS number FROM t WHERE l_linenumber % 3 = 0
        UNION ALL SELECT l_orderkey, l_linenumber, 'paragraph', concat('The life of ', text, ' is given by'), 0, NULL FROM w UNION ALL SELECT l_orderkey, l_linenumber, 'equation', concat('N = C / ', l_orderkey), 1, concat(l_linenumber, '.1') FROM w
        UNION ALL SELECT l_orderkey, l_linenumber, 'equation', 'and then more text as S = 2', 2, CAST(l_linenumber AS VARCHAR) FROM w UNION ALL SELECT l_orderkey, l_linenumber, 'paragraph', '. End', 3, NULL FROM w""",
}
QUERIES = {
    f.__name__: f
    for f in (
        section_label, section_score, section_fasttrack, body_font_mode, block_features, title_argmax, identifier_extract, document_identifiers, scanned_route, frontmatter_prune, language_detect, toc_entries,
        context_parent, context_path, parent_integrity, equation_flag, equation_context, overlap_anti, supplement_sort, inline_eq_split,
    )
}
