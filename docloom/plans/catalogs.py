"""Mapping catalogs: how a format is recognised and what its elements mean. Data, not code."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The namespaces of Dublin Core elements.
DC = ("http://purl.org/dc/elements/1.1/", "http://www.purl.org/dc/elements/1.1/")

# Rules of every format, in order. Keys of a metadata rule: static | xpath | dc_element, transform,
# attribute, combine_with, separator, split_by, truncate, template, target_field, dumb_down, join_separator,
# validate_enum, entity_type, role, organization_type, scheme.
BASE = {
    "dc_title": [{"dc_element": "title"}], "dc_creator": [{"dc_element": "creator", "entity_type": "organization"}], "dc_publisher": [{"dc_element": "publisher", "entity_type": "organization", "role": "publisher"}],
    "dc_contributor": [{"dc_element": "contributor", "entity_type": "organization", "role": "contributor"}], "dc_subject": [{"dc_element": "subject", "split_by": " - "}], "dc_date": [{"dc_element": "date", "target_field": "issued"}],
    "dc_identifier": [{"dc_element": "identifier", "scheme": "URI"}], "dc_language": [{"dc_element": "language"}], "dc_rights": [{"dc_element": "rights", "target_field": "accessRights"}], "dc_type": [{"dc_element": "type", "validate_enum": True}],
}
# Formats by descending priority, as a user's YAML catalog has them.
SHIPPED = (
    {
        "format_id": "s1000d", "detect": {"root_tag_contains": ["dmodule"]},
        "relations": [
            {"xpath": ".//applicCrossRefTableRef/dmRef", "relation_type": "custom:GOVERNED_BY_APPLIC", "transform": "dmc_from_dmref"}, {"xpath": ".//brexDmRef/dmRef", "relation_type": "custom:COMPLIES_WITH", "transform": "dmc_from_dmref"},
        ],
        "metadata": {
            "dc_title": {"xpath": ".//techName", "combine_with": ".//infoName", "separator": " - "}, "dc_creator": {"xpath": ".//responsiblePartnerCompany/enterpriseName", "entity_type": "organization"},
            "dc_contributor": {"xpath": ".//originator/enterpriseName", "entity_type": "organization", "role": "contributor"}, "dc_identifier": {"xpath": ".//dmIdent", "transform": "dmc_assemble"},
            "dc_date": {"xpath": ".//issueDate", "transform": "date_from_attrs"}, "dc_type": {"xpath": ".//dmIdent", "transform": "s1000d_info_code_to_type"},
            "dc_rights": [{"xpath": ".//security", "transform": "s1000d_security"}, {"xpath": ".//copyright/copyrightPara[1]/randomList/listItem/para", "transform": "join_text", "target_field": "rightsHolder"}],
            "dc_coverage": [{"xpath": ".//applic", "transform": "applic_tree", "target_field": "applicTree"}, {"xpath": ".//systemBreakdownCode", "target_field": "system"}],
            "dc_description": [{"xpath": ".//skillLevel", "attribute": "skillLevelCode", "template": "Skill Level: {value}"}, {"xpath": ".//qualityAssurance/firstVerification", "attribute": "verificationType", "template": "Verification: {value}"}],
            "doc_status": {"xpath": ".//dmStatus", "attribute": "issueType"},
        },
        "content": {
            "mappings": [
                {"tag": "levelledPara", "block_type": "section", "title_child": "title"}, {"tag": "para", "block_type": "paragraph"}, {"tag": ["warning", "caution"], "block_type_from_tag": True}, {"tag": ["note", "notePara"], "block_type": "note"},
                {"tag": "proceduralStep", "block_type": "procedureStep"},
            ]
        },
    },
    {
        "format_id": "jats", "detect": {"root_tag_contains": ["article", "pm"]},
        "metadata": {"dc_title": {"xpath": ".//article-title"}, "dc_creator": {"xpath": ".//contrib[@contrib-type='author']", "transform": "jats_author_name"}, "dc_identifier": {"xpath": ".//article-id[@pub-id-type='doi']", "scheme": "DOI"}, "dc_type": {"static": "JournalArticle"}},
        "content": {
            "traverse_strategy": "jats_body",
            "mappings": [{"tag": "sec", "block_type": "section", "title_child": "title"}, {"tag": "p", "block_type": "paragraph"}, {"tag": "table-wrap", "block_type": "table"}, {"tag": "disp-formula", "block_type": "equation"}],
        },
    },
)


def catalog(data: dict | None) -> tuple[str, dict] | None:
    """(format_id, rules) of a catalog as a user writes it; None without a format_id."""
    if not data or "format_id" not in data:
        return None
    content = data.get("content", {})
    as_list = lambda x: x if isinstance(x, list) else [x]
    rules = [
        {"tag": [t.lower() for t in as_list(m["tag"])], "block": None if m.get("block_type_from_tag") else m.get("block_type", "paragraph"), "title_child": m.get("title_child", "title"), **{k: m[k] for k in ("prefix", "prefix_template", "keep_empty") if k in m}}
        for m in content.get("mappings", [])
    ]
    relations = [{"xpath": r["xpath"], "type": r.get("relation_type", "RELATED_TO"), "transform": r.get("transform")} for r in data.get("relations", []) if r.get("xpath")]
    return data["format_id"], {
        "detect": as_list(data.get("detect", {}).get("root_tag_contains", [])), "traverse": content.get("traverse_strategy", "recursive"), "relations": relations, "metadata": {k: as_list(v) for k, v in data.get("metadata", {}).items()}, "content": rules,
    }


def from_yaml(text: str) -> tuple[str, dict] | None:
    """The same of a YAML text."""
    return catalog(yaml.safe_load(text))


FORMATS = dict(map(catalog, SHIPPED))


def content_rules(format_id: str, formats: dict | None = None) -> dict[str, dict]:
    return {tag: rule for rule in (formats or FORMATS)[format_id]["content"] for tag in rule["tag"]}


def detect(root_tag: str, formats: dict | None = None) -> str | None:
    """The first format one of whose parts the lower-cased root tag contains."""
    low = root_tag.lower()
    return next((name for name, f in (formats or FORMATS).items() if any(p in low for p in f["detect"])), None)


def detection_rows(formats: dict | None = None) -> list[tuple[int, str, str]]:
    """(priority, format, part) for a join."""
    return [(i, name, part) for i, (name, f) in enumerate((formats or FORMATS).items()) for part in f["detect"]]


def detected(tags: DataFrame, tag: str = "tag", formats: dict | None = None) -> DataFrame:
    """tags with ``format``: the first by priority one of whose parts the lower-cased tag contains, null if none. The rules
    are a fixed few, so the join is with a table of them that is sent along; each distinct tag is tried once."""
    spark = tags.sparkSession
    rules = spark.createDataFrame(detection_rows(formats), "priority int, format string, part string")
    each = tags.select(F.col(tag)).distinct()
    hits = each.join(F.broadcast(rules), F.lower(tag).contains(F.col("part"))).groupBy(tag).agg(F.min_by("format", "priority").alias("format"))
    return tags.join(hits, tag, "left")
