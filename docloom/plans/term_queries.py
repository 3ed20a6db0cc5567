"""Queries of the term path and of scalar functions, with the SQL that gives the same rows.

``DERIVED`` holds inputs that the driver tables lack, as SQL that both engines run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import store, terms, validate
from ..sources.tables import load

CANDIDATES = """
    SELECT 0 AS doc_id, CAST(p_partkey AS BIGINT) AS pos, p_name AS term, CASE WHEN p_size % 3 = 0 THEN 'TERM-REL' WHEN p_size % 3 = 1 THEN 'TERM-RULE' ELSE 'TERM-CLASS' END AS term_type,
           CASE WHEN p_size % 4 = 0 THEN concat(p_name, ' (SCC)') WHEN p_size % 4 = 1 THEN concat(p_name, '-β ', p_brand) WHEN p_size % 4 = 2 THEN '' ELSE p_type END AS headword_en, CAST(NULL AS VARCHAR(9)) AS headword_ko,
           CASE WHEN p_size % 5 = 0 THEN '[PENDING_DEFINITION]' WHEN p_size % 7 = 0 THEN 'short' ELSE concat('Definition of ', p_name, ' ', p_partkey) END AS definition_en,
           CASE WHEN p_size % 2 = 0 THEN '' WHEN p_size % 11 = 0 THEN 'ko' ELSE concat('Korean text ', p_partkey) END AS definition_ko,
           CASE WHEN p_size % 6 = 0 THEN '' ELSE concat('context ', p_partkey) END AS context, CASE WHEN p_size = 13 THEN 'mechanical' ELSE 'nuclear' END AS domain_name
    FROM {part}"""
_ID = """concat('term:', CASE term_type WHEN 'TERM-REL' THEN 'rel' WHEN 'TERM-RULE' THEN 'rule' ELSE 'class' END, ':',
    coalesce(nullif(replace(trim(regexp_replace(lower(regexp_replace(coalesce(nullif(trim(headword_en), ''), trim(term)), '[^a-zA-Z0-9 ]', ' ', 'g')), ' +', ' ', 'g')), ' ', '_'), ''), 'unknown'))"""


def derive(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    return spark.sql(sql, **{t: load(spark, sf_dir, t) for t in tables})


def duck(sql: str) -> str:
    """The derived input for the other engine: table names without braces."""
    return sql.replace("{", "").replace("}", "")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, CANDIDATES, "part").withColumn("domain", F.array("domain_name")).drop("domain_name")


def term_id_normalize(spark, sf_dir):
    c = candidates(spark, sf_dir)
    return c.select("pos", T.term_id(F.col("headword_en"), F.col("term"), F.col("term_type")).alias("term_id"))


def merged(spark, sf_dir):
    return terms.merge(terms.build(candidates(spark, sf_dir)))


def term_merge(spark, sf_dir):
    return merged(spark, sf_dir).select("term", "term_type", "pos", "term_id", "headword_en", "definition_en", "definition_ko", F.col("slots")["context_ko"].alias("context"))


def term_promotion(spark, sf_dir):
    c = validate.promotion(merged(spark, sf_dir))
    return c.select("term", "term_type", "problem_type", "problem_status", F.size("errors").alias("n_errors"), F.array_join(F.transform("errors", lambda e: e["target"]), ",").alias("targets"))


def term_status(spark, sf_dir):
    p = load(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 3 == 0).alias("expert_validated"), F.when(F.col("p_size") % 4 == 0, "[PENDING_DEFINITION]").when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_name")).alias("definition_en"), F.when(F.col("p_size") % 17 == 0, "rejected").otherwise("candidate").alias("status"))
    return p.select("p_partkey", terms.status().alias("new_status"))


def term_upsert_last_wins(spark, sf_dir):
    t = terms.build(candidates(spark, sf_dir)).withColumn("term_kind", store.term_kind()).withColumn("term_key", T.last_segment(F.col("term_id")))
    return store.last_wins(t, ["term_kind", "term_key"], [F.col("pos")]).select("term_kind", "term_key", "pos", "term")


def filename_rules(spark, sf_dir):
    t = terms.build(candidates(spark, sf_dir))
    status = F.element_at(F.array(*map(F.lit, ("candidate", "anchored", "mature", "rejected"))), (F.col("pos") % 4 + 1).cast("int"))
    return t.select("pos", T.landing_filename(F.col("headword_en"), F.col("term"), F.col("term_id")).alias("landing"), T.status_filename(status, F.col("term_id"), F.lit("1.1")).alias("by_status"))


def first_chunk(spark, sf_dir):
    lines = load(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    return terms.first_chunk(lines).select("doc_id", F.col("pos").cast("long").alias("pos"), "text")


def term_path_summary(spark, sf_dir):
    """The flagship: candidates -> ids -> merge -> checks, counted by outcome."""
    c = validate.promotion(merged(spark, sf_dir))
    return c.groupBy("term_type", F.coalesce("problem_type", F.lit("promoted")).alias("outcome")).agg(F.count("*").alias("n_terms"), F.min("term").alias("first_term"))


_BUILT = f"""
    WITH c AS ({duck(CANDIDATES)}),
    b AS (SELECT pos, term, term_type, {_ID} AS term_id, coalesce(nullif(headword_en, ''), term) AS headword_en, coalesce(nullif(definition_en, ''), '[PENDING_DEFINITION]') AS definition_en, definition_ko, context, domain_name FROM c)"""
_MERGED = _BUILT + """,
    g AS (SELECT term, term_type, min(pos) AS pos, arg_min(term_id, pos) AS term_id, arg_min(headword_en, pos) AS headword_en, arg_min(definition_en, pos) AS base,
                 arg_min(definition_en, pos) FILTER (definition_en <> '' AND NOT starts_with(definition_en, '[PENDING')) AS real_en, arg_max(definition_en, pos) FILTER (definition_en <> '') AS any_en,
                 coalesce(arg_min(definition_ko, pos) FILTER (definition_ko <> ''), '') AS definition_ko, coalesce(arg_min(context, pos) FILTER (context <> ''), '') AS context, arg_min(domain_name, pos) AS domain_name
          FROM b GROUP BY term, term_type),
    m AS (SELECT *, CASE WHEN starts_with(base, '[PENDING') THEN coalesce(real_en, any_en) ELSE base END AS definition_en FROM g)"""
_CHECKED = _MERGED + """,
    k AS (SELECT *, starts_with(definition_en, '[PENDING') OR trim(definition_en) = '' AS missing, length(definition_en) < 10 AS e1, length(definition_ko) < 10 AS e2, domain_name <> 'nuclear' AS e3 FROM m),
    p AS (SELECT *, CAST(e1 AS INT) + CAST(e2 AS INT) + CAST(e3 AS INT) AS bad FROM k)"""
_PROBLEM = "CASE WHEN missing THEN 'term-missing-fields' WHEN bad > 0 THEN 'term-schema-validation' END"

SQL = {
    "term_id_normalize": f"WITH c AS ({duck(CANDIDATES)}) SELECT pos, {_ID} AS term_id FROM c",
    "term_merge": _MERGED + " SELECT term, term_type, pos, term_id, headword_en, definition_en, definition_ko, context FROM m",
    "term_promotion": _CHECKED + f""" SELECT term, term_type, {_PROBLEM} AS problem_type, CAST(CASE WHEN missing THEN 422 WHEN bad > 0 THEN 400 END AS INT) AS problem_status, CASE WHEN missing THEN 1 ELSE bad END AS n_errors,
        CASE WHEN missing THEN 'definition_en' ELSE concat_ws(',', CASE WHEN e1 THEN 'definition_en' END, CASE WHEN e2 THEN 'definition_ko' END, CASE WHEN e3 THEN 'domain[0]' END) END AS targets FROM p""",
    "term_status": """SELECT p_partkey, CASE WHEN p_size % 17 = 0 THEN 'rejected' WHEN p_size % 3 = 0 AND p_size % 4 <> 0 AND p_size % 5 <> 0 THEN 'mature' WHEN p_size % 3 = 0 THEN 'anchored' ELSE 'candidate' END AS new_status FROM part""",
    "term_upsert_last_wins": _BUILT + """ SELECT CASE term_type WHEN 'TERM-REL' THEN 'rel' WHEN 'TERM-RULE' THEN 'rule' ELSE 'class' END AS term_kind, split_part(term_id, ':', 3) AS term_key, pos, term FROM b
        QUALIFY row_number() OVER (PARTITION BY term_kind, term_key ORDER BY pos DESC) = 1""",
    "filename_rules": _BUILT + """ SELECT pos, concat('C_', coalesce(nullif(upper(regexp_replace(headword_en, '[^a-zA-Z0-9_-]', '', 'g')), ''), nullif(upper(regexp_replace(term, '[^a-zA-Z0-9_-]', '', 'g')), ''), 'TEMP'), '_', split_part(term_id, ':', 3), '.json') AS landing,
        concat(CASE pos % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'A' WHEN 2 THEN 'M' ELSE 'X' END, '_', coalesce(nullif(upper(regexp_replace(split_part(term_id, ':', 3), '[^a-zA-Z0-9_-]', '', 'g')), ''), 'UNKNOWN'), '_v1.1.json') AS by_status FROM b""",
    "first_chunk": """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
        SELECT doc_id, CAST(pos AS BIGINT) AS pos, text FROM l WHERE length(text) > 20 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) = 1""",
    "term_path_summary": _CHECKED + f" SELECT term_type, coalesce({_PROBLEM}, 'promoted') AS outcome, count(*) AS n_terms, min(term) AS first_term FROM p GROUP BY ALL",
}
QUERIES = {f.__name__: f for f in (term_id_normalize, term_merge, term_promotion, term_status, term_upsert_last_wins, filename_rules, first_chunk, term_path_summary)}
