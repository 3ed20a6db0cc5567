"""Named transforms of XML attribute values, as Column builders, and their registry.

Each takes a map column of an element's attributes (or an array of texts) and gives a Column, so that a rule
table can name them. ``element`` variants read the attributes of an XPath's first match.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .text import date_of, present, strip

# The attributes of a data module code in the order of its text.
DMC_PARTS = (("modelIdentCode",), ("systemDiffCode",), ("systemCode",), ("subSystemCode", "subSubSystemCode"), ("assyCode",), ("disassyCode", "disassyCodeVariant"), ("infoCode", "infoCodeVariant"), ("itemLocationCode",))
DMC_ATTRIBUTES = tuple(a for part in DMC_PARTS for a in part)
# Document types of information codes.
INFO_CODES = {"040": "TechnicalReport", "520": "Procedure", "720": "Procedure"}


def attribute(attributes: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(attributes, F.lit(name)), F.lit(""))


def dmc(attributes: Column, issue: Column | None = None) -> Column:
    """DMC-model-diff-system-..-location, and _issue-inwork where both are given."""
    body = F.concat_ws("-", F.lit("DMC"), *(F.concat(*(attribute(attributes, a) for a in part)) for part in DMC_PARTS))
    if issue is None:
        return body
    number, work = attribute(issue, "issueNumber"), attribute(issue, "inWork")
    return F.when((number != "") & (work != ""), F.concat(body, F.lit("_"), number, F.lit("-"), work)).otherwise(body)


def dmc_identifier(attributes: Column, issue: Column | None = None) -> Column:
    return F.array(F.struct(F.lit("URI").alias("scheme"), dmc(attributes, issue).alias("value")))


def date_from_attributes(attributes: Column) -> Column:
    get = lambda n: F.try_element_at(attributes, F.lit(n))
    return date_of(get("year"), get("month"), get("day"))


def text_extract(text: Column) -> Column:
    return present(strip(text))


def join_text(texts: Column) -> Column:
    """The texts that are not blank, joined by '; '; null without any."""
    return present(F.array_join(F.filter(F.transform(texts, strip), lambda x: x != ""), "; "))


def author_name(given: Column, surname: Column) -> Column:
    return present(strip(F.concat(F.coalesce(given, F.lit("")), F.lit(" "), F.coalesce(surname, F.lit("")))))


def security(attributes: Column) -> Column:
    """struct(accessRights, license): public only for class 01 with nothing beside it."""
    parts = [attribute(attributes, n) for n in ("securityClassification", "commercialClassification", "caveat")]
    access = F.when((parts[0] != "01") | (parts[1] != "") | (parts[2] != ""), "restricted").otherwise("public")
    licence = F.coalesce(present(F.concat_ws("_", *(present(p) for p in parts))), F.lit("01"))
    return F.struct(access.alias("accessRights"), licence.alias("license"))


def info_code_type(attributes: Column) -> Column:
    code = F.substring(attribute(attributes, "infoCode"), 1, 3)
    out = F.lit("Procedure")
    for k, v in INFO_CODES.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def raw_fields(attributes: Column) -> Column:
    return F.coalesce(attributes, F.create_map().cast("map<string,string>"))


#: name -> (builder, what it takes)
REGISTRY = {
    "dmc_assemble": (dmc_identifier, "attributes"), "dmc_from_dmref": (dmc, "attributes"), "date_from_attrs": (date_from_attributes, "attributes"), "text_extract": (text_extract, "text"),
    "jats_author_name": (author_name, "names"), "join_text": (join_text, "texts"), "s1000d_security": (security, "attributes"), "s1000d_info_code_to_type": (info_code_type, "attributes"),
    "dmc_raw_fields": (raw_fields, "attributes"),
}


def attributes_at(xml: Column, elements: dict[str, tuple[str, tuple[str, ...]]]) -> dict[str, Column]:
    """Maps of the attributes of elements, by name: (path under the root, attributes). The XML is parsed
    once for all of them; missing attributes are ''."""
    tree: dict = {}
    for path, names in elements.values():
        at = tree
        for step in path.split("/"):
            at = at.setdefault(step, {})
        at.update({f"_{n}": None for n in names})

    def ddl(node: dict) -> str:
        return ", ".join(f"`{k}`: {'string' if v is None else f'struct<{ddl(v)}>'}" for k, v in node.items())

    parsed = F.from_xml(xml, ", ".join(f"`{k}` struct<{ddl(v)}>" for k, v in tree.items()), {"inferSchema": "false"})
    out = {}
    for name, (path, names) in elements.items():
        at = parsed
        for step in path.split("/"):
            at = at[step]
        out[name] = F.create_map(*(x for n in names for x in (F.lit(n), F.coalesce(at[f"_{n}"], F.lit("")))))
    return out


def attributes_of(xml: Column, path: str, names: tuple[str, ...]) -> Column:
    """A map of one element's attributes by XPath over an XML string; missing ones are ''."""
    return F.create_map(*(x for n in names for x in (F.lit(n), F.xpath_string(xml, F.lit(f"{path}/@{n}")))))


def register(spark: SparkSession) -> None:
    """The scalar functions by name for SQL text, as SQL functions that the optimizer expands."""
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION docloom_normalize(s STRING) RETURNS STRING RETURN trim(regexp_replace(lower(s), '(?U)[\\s]+', ' '))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION docloom_label_depth(s STRING) RETURNS INT RETURN length(s) - length(replace(s, '.', '')) + 1")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION docloom_is_pending(s STRING) RETURNS BOOLEAN RETURN coalesce(startswith(s, '[PENDING'), false)")
