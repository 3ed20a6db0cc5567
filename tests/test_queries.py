"""Every core query against its SQL on the smallest tables, and the driver's contract."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

from docloom.plans import queries as core  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("<NA>", "NaT"):
        return None
    return str(int(v)) if isinstance(v, float) and v.is_integer() else repr(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_query_equals_sql(spark, duck, name):
    got = core.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    rel = duck.sql(core.SQL[name])
    assert cols == sorted(rel.columns)
    order = [rel.columns.index(c) for c in cols]
    want = sorted(([cell(r[i]) for i in order] for r in rel.fetchall()), key=str)
    assert sorted(([cell(r[c]) for c in cols] for r in got.collect()), key=str) == want


def test_every_query_has_sql():
    assert set(core.QUERIES) == set(core.SQL)


def test_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_without_a_library_of_the_optional_part(monkeypatch):
    """Where a library that only the optional subpackage needs is missing, the core's queries are still there."""
    import __spark_entry__ as e

    for m in [m for m in sys.modules if m.startswith("docloom.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setitem(sys.modules, "zstandard", None)
    assert set(e.queries()) == set(core.QUERIES) and set(e.oracle_sql()) == set(core.SQL)


def test_core_does_not_need_the_optional_parts():
    for p in (ROOT / "docloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert "docloom.llm" not in p.read_text() and "from ..llm" not in p.read_text()
