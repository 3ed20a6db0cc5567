"""Scalar functions and transforms on literal vectors."""

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import transforms as X


def apply(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_section_labels(spark):
    got = apply(spark, ["1.2.3 Background", "Abstract", "2. Scope", "제3장 서론", "A.1 Annex", "appendix B Data", "가. 첫째", "1.2", "A. Title", "3 NBSP", None], T.section_label)
    assert [None if g is None else (g["label"], g["title"]) for g in got] == [
        ("1.2.3", "Background"), None, ("2", "Scope"), ("제3장", "서론"), ("A.1", "Annex"), ("appendix B", "Data"), ("가.", "첫째"), None, ("A.", "Title"), ("3", "NBSP"), None,
    ]


def test_depths_and_types(spark):
    assert apply(spark, ["1", "1.2", "1.2.3", "가.", "A."], T.label_depth) == [1, 2, 3, 2, 2]
    assert apply(spark, [0, 1, 2, 7], T.depth_type, "int") == ["title", "section", "subsection", "subsection"]


def test_normalize_strip_words(spark):
    assert apply(spark, ["  A\t b  C\n", "", " "], T.normalize) == ["a b c", "", ""]
    assert apply(spark, ["  x  ", "\x1cy"], T.strip) == ["x", "y"]
    assert apply(spark, ["", "a", " a  b "], T.word_count) == [0, 1, 2]


@pytest.mark.parametrize("text,want", [("E = mc^2 (1.1)", True), ("∑ x_i = 100", True), ("∫ f(x) dx = F(x) + C", True), ("α + β = γ", True), ("Figure 1.2를 참조하십시오.", False), ("Section 3.1: Introduction", False), ("이것은 일반적인 문장입니다.", False), ("a-b", False)])
def test_is_equation(spark, text, want):
    assert apply(spark, [text], T.is_equation) == [want]


def test_equation_number(spark):
    assert apply(spark, ["x = 1 (3.1)", "x (12a) ", "none", "(4) x"], T.equation_number) == ["3.1", "12a", "", ""]


def test_language(spark):
    assert apply(spark, ["", None, "hello", "안녕하세요 abc", "가" * 50 + "a" * 500, "123", "x" * 2000 + "가" * 500], T.language) == ["ko", "ko", "en", "ko", "ko", "en", "en"]


def test_identifiers(spark):
    assert apply(spark, ["NUREG/CR-5704 and ANL-98/31.", "no", "ab-12 X-1 AB-1"], T.identifiers) == [["NUREG/CR-5704", "ANL-98/31."], [], ["AB-1"]]


def test_term_ids(spark):
    rows = spark.createDataFrame(
        [("Operating Temperature", "x", "TERM-CLASS"), ("Stress-Corrosion Cracking (SCC)", "x", "TERM-CLASS"), ("AMP 경년열화", "x", "TERM-CLASS"), ("피로", "", "TERM-CLASS"), (None, "Fatigue", "TERM-CLASS"), ("exceeds", "x", "TERM-REL"), ("  ", "A  b", "TERM-RULE"), ("x", "y", None)],
        "h string, f string, t string",
    )
    assert [r[0] for r in rows.select(T.term_id(F.col("h"), F.col("f"), F.col("t"))).collect()] == [
        "term:class:operating_temperature", "term:class:stress_corrosion_cracking_scc", "term:class:amp", "term:class:unknown", "term:class:fatigue", "term:rel:exceeds", "term:rule:a_b", "term:class:x",
    ]


def test_names_and_keys(spark):
    assert apply(spark, ["DOC:1/가 b-c_d"], T.fragment_key) == ["DOC_1_가_b-c_d"]
    rows = spark.createDataFrame([("Aging Plan", "t", "term:class:aging_plan"), ("피로", "Fatigue", "term:class:x"), ("피로", "피로", None)], "h string, t string, i string")
    assert [r[0] for r in rows.select(T.landing_filename(F.col("h"), F.col("t"), F.col("i"))).collect()] == ["C_AGINGPLAN_aging_plan.json", "C_FATIGUE_x.json", "C_TEMP_unknown.json"]
    rows = spark.createDataFrame([("mature", "term:class:amp", "1.1"), ("odd", "term:class:피로", None), (None, None, None)], "s string, i string, v string")
    assert [r[0] for r in rows.select(T.status_filename(F.col("s"), F.col("i"), F.col("v"))).collect()] == ["M_AMP_v1.1.json", "C_UNKNOWN_v1.0.json", "C_UNKNOWN_v1.0.json"]


def test_status_and_layout(spark):
    assert apply(spark, ["new", "Changed", "DELETED", "other", None, ""], T.doc_status) == ["draft", "partial", "deprecated", "validated", "draft", "draft"]
    assert apply(spark, ["page_header", "Title", "table", "formula", "list_item", "text"], T.layout_type) == ["section", "title", "table", "equation", "list", "paragraph"]


def test_toc_line_and_zfill(spark):
    assert apply(spark, ["1.2 Background ............. 45", "3 Plain", "a...b"], T.toc_line) == ["1.2 Background", "3 Plain", "ab"]
    assert apply(spark, ["5", "12", "123"], lambda c: T.zfill(c, 2)) == ["05", "12", "123"]


def attributes(spark, maps, fn):
    rows = spark.createDataFrame([(m,) for m in maps], "a map<string,string>")
    return [r[0] for r in rows.select(fn(F.col("a"))).collect()]


def test_transforms(spark):
    bike = {"modelIdentCode": "S1000DBIKE", "systemDiffCode": "AAA", "systemCode": "DA1", "subSystemCode": "20", "subSubSystemCode": "0", "assyCode": "00", "disassyCode": "00AA", "infoCode": "720A", "infoCodeVariant": "-A", "itemLocationCode": "A"}
    assert attributes(spark, [{}, bike], X.dmc) == ["DMC--------", "DMC-S1000DBIKE-AAA-DA1-200-00-00AA-720A-A-A"]
    assert attributes(spark, [{"year": "2023", "month": "5", "day": "9"}, {"year": "2024"}, {"month": "1"}], X.date_from_attributes) == ["2023-05-09", "2024-01-01", None]
    s = attributes(spark, [{"securityClassification": "02", "commercialClassification": "cc1", "caveat": "cv1"}, {"securityClassification": "01"}, {}], X.security)
    assert [tuple(x) for x in s] == [("restricted", "02_cc1_cv1"), ("public", "01"), ("restricted", "01")]
    assert attributes(spark, [{"infoCode": "040A"}, {"infoCode": "720"}, {"infoCode": "999X"}, {}], X.info_code_type) == ["TechnicalReport", "Procedure", "Procedure", "Procedure"]
    assert apply(spark, [["First ", "", None, "Second"], ["  "]], X.join_text, "array<string>") == ["First; Second", None]
    assert set(X.REGISTRY) >= {"dmc_assemble", "date_from_attrs", "text_extract", "jats_author_name", "join_text", "dmc_from_dmref", "s1000d_security", "s1000d_info_code_to_type", "dmc_raw_fields"}


def test_attributes_in_one_parse(spark):
    rows = spark.createDataFrame([("<m><a x='1'><b y='2'/></a></m>",), ("<m/>",)], "v string")
    got = rows.select(*(c.alias(k) for k, c in X.attributes_at(F.col("v"), {"a": ("a", ("x", "z")), "b": ("a/b", ("y",))}).items())).collect()
    assert [(r["a"], r["b"]) for r in got] == [({"x": "1", "z": ""}, {"y": "2"}), ({"x": "", "z": ""}, {"y": ""})]


def test_sql_functions(spark):
    X.register(spark)
    r = spark.sql("SELECT docloom_normalize(' A  B') AS a, docloom_label_depth('1.2') AS b, docloom_is_pending('[PENDING_X]') AS c").first()
    assert tuple(r) == ("a b", 2, True)
