"""Row types and fixed vocabularies of the data model."""

from __future__ import annotations

# Vocabularies of the record formats.
BLOCK_TYPES = ("title", "abstract", "section", "subsection", "paragraph", "list", "listItem", "table", "figure", "equation", "code", "procedure", "procedureStep", "reference", "appendix", "footnote", "caption", "note", "warning", "caution")
DOC_TYPES = ("TechnicalReport", "RegulatoryDocument", "SafetyAnalysisReport", "PeriodicSafetyReview", "LicenseRenewalApplication", "Code", "Standard", "Procedure", "LicenseeEventReport", "RegulatoryAuditItem", "JournalArticle", "Patent", "Other")
ROLES = ("creator", "publisher", "sponsor", "project_manager", "reviewer", "approver", "contributor")
CREATOR_ROLES = ("creator",)
CONTRIBUTOR_ROLES = ("reviewer", "approver", "project_manager", "contributor")
PUBLISHER_ROLES = ("publisher", "sponsor")
ORG_TYPES = ("utility", "vendor", "regulator", "national_lab", "corporate_research")
IDENTIFIER_SCHEMES = ("DOI", "URI", "ISBN", "ISSN", "DOCKET")
RELATION_TYPES = ("CITES", "REFERENCES", "IS_CITED_BY", "SUPERSEDES", "IS_SUPERSEDED_BY", "SUPPLEMENTS", "IS_SUPPLEMENTED_BY", "REQUIRES", "IS_REQUIRED_BY", "RELATED_TO", "DERIVES_FROM", "HAS_VERSION", "IMPLEMENTS", "CONTRADICTS")
CUSTOM_RELATION = r"^custom:[a-zA-Z0-9_.-]+$"
VALIDATION_STATUSES = ("draft", "partial", "validated", "approved", "deprecated")
ACCESS_RIGHTS = ("public", "restricted", "confidential", "classified")
STRUCTURED_KEYS = ("conditions", "actions", "acceptanceCriteria", "applicRefId", "applicTree", "s1000d_dmCode")
TERM_TYPES = ("TERM-CLASS", "TERM-REL", "TERM-RULE")
TERM_KINDS = {"TERM-CLASS": "class", "TERM-REL": "rel", "TERM-RULE": "rule"}
TERM_DOMAINS = ("nuclear", "LTO", "safety", "materials", "inspection", "regulation", "engineering", "chemistry", "physics", "maintenance", "QA", "licensing", "TLAA", "AMP", "other")
TERM_ID_PATTERN = r"^term:(class|rel|rule):[a-zA-Z0-9][a-zA-Z0-9_.-]*$"
PENDING = "[PENDING_DEFINITION]"
PENDING_PREFIX = "[PENDING"
PARAGRAPH_LEVEL = 999

BOX = "struct<x0: double, y0: double, x1: double, y1: double, page: int>"
TABLE = "struct<headers: array<string>, rows: array<array<string>>>"
EQUATION = "struct<latex: string, equationNumber: string>"
BLOCK = (
    f"pos int, page int, block_type string, text string, bbox {BOX}, table_data {TABLE}, equation_data {EQUATION}, confidence double, level int, "
    "context_path array<string>, parent_id string, block_id string, section_label string, section_title string, structured_content string, "
    "source_xpath string, source_element_name string, xml_fragment string"
)
RELATION = "source_block_id string, relation_type string, target string, citation_text string, confidence double"
PROBLEM_ERROR = "struct<code: string, target: string, detail: string, meta: map<string, string>>"
PERSON = "struct<name: string, entityType: string, role: string, affiliation: string, organizationType: string>"
