"""The corpus pipeline, stage by stage on the smallest tables, against plain versions on each stage's own input."""

import hashlib
import sys
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
from helpers import lower

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")

import corpus_pipeline  # noqa: E402

from docloom.llm import mixing, sentpiece  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """name -> (input rows, output rows), each stage on the written result of the one before."""
    root, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        before = docs.collect()
        result.write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        out[name] = before, docs.collect(), f"{root}/{i - 1}"
    return out


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near dedup", "mixing", "tokenisation"] and corpus_pipeline.ORACLE_SQL is None


def test_classifier_keeps_clean_documents(stages):
    before, after, _ = stages["quality classifier"]
    quality = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    kept = {r["doc_id"] for r in after}
    clean = [r["doc_id"] for r in before if quality.get(r["doc_id"]) == 1]
    junk = [r["doc_id"] for r in before if quality.get(r["doc_id"]) == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i in kept for i in junk) <= 0.1 * len(junk)


def test_exact_stage(stages):
    before, after, _ = stages["exact dedup"]
    best = {}
    for r in before:
        best[lower(r["text"])] = max(best.get(lower(r["text"]), -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(best.values())


def shingles(t):
    w = lower(t).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_stage(stages):
    before, after, _ = stages["near dedup"]
    grams, kept = {r["doc_id"]: shingles(r["text"]) for r in before}, {r["doc_id"] for r in after}
    similar = lambda a, b: len(grams[a] & grams[b]) / max(1, len(grams[a] | grams[b]))
    ids = sorted(grams)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if grams[a] and similar(a, b) >= 0.8]
    assert all(not (a in kept and b in kept) for a, b in pairs)
    near = {x for p in pairs for x in p}
    loose = {x for i, a in enumerate(ids) for b in ids[:i] if grams[a] and similar(a, b) >= 0.75 for x in (a, b)}
    assert set(ids) - loose <= kept and near <= loose


def test_mixing_stage(stages):
    before, after, path = stages["mixing"]
    documents = duckdb.sql(f"SELECT * FROM '{path}/*.parquet'")  # noqa: F841
    want = duckdb.sql(mixing.sql(numerator=9, denominator=10, max_epochs=1)).fetchall()
    assert sorted(r["doc_id"] for r in after) == sorted(r[0] for r in want if r[5])


def test_tokenisation_stage(stages):
    before, after, _ = stages["tokenisation"]
    sp = sentpiece.Codec.of(public_tokenizers.path("piece_bpe_32k.model")).sp
    text = {r["doc_id"]: r["text"] for r in before}
    assert len(after) == len(before)
    for r in after:
        ids = [*sp.encode(text[r["doc_id"]]), 2]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_run_is_the_stages(spark, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert got == sorted(map(tuple, stages["tokenisation"][1]))


def test_queries_of_the_subpackage(spark):
    """Each opN query over its whole table: a row per document, ten per query vector, or one per word."""
    from docloom.llm import queries

    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert [k.split("_")[0] for k in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    for name, q in queries.QUERIES.items():
        rows = q(spark, SF).count()
        assert rows > n if name.startswith("op12_") else rows == (50 if name.startswith("op6_") else n)


def test_sweep(spark):
    from docloom.llm import common, packing

    packing.assign(spark.read.parquet(f"{SF}/documents.parquet"), 4).count()
    where = Path(common.own_dir(spark).removeprefix("file://"))
    assert any(where.iterdir())
    common.sweep(spark)
    assert not where.exists()
