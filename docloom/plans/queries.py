"""All queries of the core engine by name, and the SQL that gives the same rows."""

from __future__ import annotations

from . import doc_queries, layout_queries, reader_queries, term_queries, xml_queries

MODULES = (term_queries, layout_queries, doc_queries, xml_queries, reader_queries)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
FLAGSHIP = "term_path_summary"
