"""SimHash near-duplicates and exact deduplication against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from helpers import BASE, CLASHING, TEXTS, docs, empty, lower, saved, sha
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import exact, simhash


def plain_fingerprint(text, k=4):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0


def plain_components(fps, radius=4):
    up = {f: f for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    fps = list(set(fps))
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                up[root(a)] = root(b)
    return {f: root(f) for f in fps}


def test_fingerprints_and_components(spark):
    got = {r["doc_id"]: r for r in simhash.component_ids(docs(spark)).collect()}
    want = {i: plain_fingerprint(t) for i, t in enumerate(TEXTS)}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == want
    roots = plain_components(list(want.values()))
    least = defaultdict(lambda: 10**9)
    for i, f in want.items():
        least[roots[f]] = min(least[roots[f]], i)
    assert {i: r["component_id"] for i, r in got.items()} == {i: least[roots[f]] for i, f in want.items()}
    assert got[0]["fingerprint"] == "0" * 16 and got[0]["component_id"] == 0


@pytest.mark.parametrize("piece,chosen", [(3, 2), (2048, 2), (3, 3), (2048, 4)])
def test_links_survive_pieces(spark, piece, chosen):
    """A chain of fingerprints 4 bits apart is one component, whatever the pieces of a hot shard."""
    rng = random.Random(1)
    fps, f = [], rng.getrandbits(64)
    for _ in range(40):
        fps.append(f)
        for b in rng.sample(range(64), 4):
            f ^= 1 << b
    rows = spark.createDataFrame([(simhash._signed(x), simhash._signed(x)) for x in fps], "node long, fp long")
    from pyspark.sql import functions as F

    dealt = rows.select(F.explode(F.array(*simhash.block_keys(F.col("fp"), 4 + chosen, chosen))).alias("shard"), "node", "fp")
    from docloom.llm.common import components

    roots = {r["node"]: r["root"] for r in components(simhash._linked(dealt, simhash._forest(4), piece)).collect()}
    assert len({roots.get(simhash._signed(x), simhash._signed(x)) for x in fps}) == len(set(plain_components(fps).values()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.integers(0, 2**64 - 1), st.integers(0, 40))
def test_bk_tree(keys, q, radius):
    keys = [*keys, *(k ^ 5 for k in keys[:5])]
    tree = simhash.BKTree()
    for k in keys:
        tree.add(k)
    assert {tree.keys[i] for i in tree.within(q, radius)} == {k for k in keys if (k ^ q).bit_count() <= radius}
    near = tree.nearest(q, radius)
    best = min((k ^ q).bit_count() for k in keys)
    assert (near is None) == (best > radius) and (near is None or (tree.keys[near] ^ q).bit_count() == best)


def jaccard(a, b, k=5):
    grams = lambda t: {tuple(t[i : i + k]) for i in range(max(1, len(t) - k + 1))}
    x, y = grams(lower(a).split()), grams(lower(b).split())
    return len(x & y) / len(x | y)


def test_near_duplicates_at_08(spark, tmp_path):
    """Pairs of similarity 0.8 and more are found, clean documents stay, copies of a hot text go."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    texts, family = [], []
    for g in range(60):
        base = [rng.choice(words) for _ in range(120)]
        texts.append(" ".join(base))
        family.append(g)
        for changes in (1, 2):
            t = list(base)
            for i in rng.sample(range(120), changes):
                t[i] = rng.choice(words)
            texts.append(" ".join(t))
            family.append(g)
    texts += [" ".join(rng.choice(words) for _ in range(120)) for _ in range(60)]
    family += range(1000, 1060)
    texts += [texts[0]] * 50
    family += [0] * 50
    kept = {r["doc_id"] for r in simhash.keep_one(saved(docs(spark, texts), tmp_path)).collect()}
    want = set()
    for i, f in enumerate(family):
        if f not in {family[j] for j in want}:
            want.add(i)
    pairs = [(i, j) for i in range(180) for j in range(i) if family[i] == family[j] and jaccard(texts[i], texts[j]) >= 0.8]
    assert want <= kept and len(kept - want) <= 0.02 * len(pairs)
    assert all(i in kept for i in range(180, 240))


def found_groups(spark, texts):
    from pyspark.sql import functions as F

    rows = simhash.near_groups(docs(spark, texts, extra=False).select(F.col("doc_id").alias("uid"), "doc_id", "text")).collect()
    groups = defaultdict(set)
    for r in rows:
        groups[r["group_uid"]].add(r["uid"])
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def test_the_tree_gives_the_pairs_that_are_verified(monkeypatch):
    """Links of a shard are those the tree finds: none without it, all within the reach of their sets."""
    rng = np.random.default_rng(5)
    sets = []
    for n in (5, 9, 20, 60, 400):
        base = np.unique(rng.integers(0, 2**64, n, "u8"))
        sets += [base, base[: -(n // 5)], np.unique(np.append(base, rng.integers(0, 2**64, n // 4, "u8")))]
    counts = [simhash.bit_counts(x) for x in sets]
    fps = list(map(simhash.fingerprint, sets))
    reach = [simhash._reach(c, len(x), 0.8) for c, x in zip(counts, sets)]
    alike = lambda a, b: (both := len(np.intersect1d(sets[a], sets[b]))) / (len(sets[a]) + len(sets[b]) - both) >= 0.8
    pairs = [(i, j) for i in range(15) for j in range(i) if alike(i, j)]
    assert len(pairs) == 10 and all((fps[i] ^ fps[j]).bit_count() <= min(reach[i], reach[j]) for i, j in pairs) and min(reach) < 32
    found = simhash._verified(0.8)(list(range(15)), fps, reach, sets)
    assert {tuple(sorted(p, reverse=True)) for p in found} == set(pairs)
    monkeypatch.setattr(simhash.BKTree, "nearest", lambda *_: None)
    monkeypatch.setattr(simhash.BKTree, "within", lambda *_: [])
    assert simhash._verified(0.8)(list(range(15)), fps, reach, sets) == []


def test_near_groups_of_a_driver_table(spark):
    """All pairs of the driver's documents by brute force: no link at 0.8 is lost, and none is made up."""
    from pyspark.sql import functions as F

    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {}
    for r in df.collect():
        t = lower(r["text"]).split()
        sets[r["doc_id"]] = frozenset(tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))) if t else frozenset()
    owners = defaultdict(list)
    for d, x in sets.items():
        for g in x:
            owners[g].append(d)
    shared = defaultdict(int)
    for ds in owners.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                shared[a, b] += 1
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            links += 1
            root[find(a)] = find(b)
    empty = [d for d, x in sets.items() if not x]
    for d in empty:
        root[find(d)] = find(empty[0])
    want = defaultdict(set)
    for d in sets:
        want[find(d)].add(d)
    got = defaultdict(set)
    for r in simhash.near_groups(df.select(F.col("doc_id").alias("uid"), "doc_id", "text")).collect():
        got[r["group_uid"]].add(r["doc_id"])
    assert links > 100 and {frozenset(x) for x in got.values()} == {frozenset(x) for x in want.values()}


def test_near_pair_among_alike_texts(spark):
    """Texts that share a long passage are nearer to one another by chance than partners at 0.8 are."""
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.getrandbits(40):x}" for _ in range(n)]
    shared = fresh(262)
    texts = [" ".join(shared + fresh(38)) for _ in range(200)]
    for _ in range(20):
        base = shared + fresh(38)
        texts += [" ".join(base), " ".join(base[:272] + fresh(28))]
    pairs = [(i, i + 1) for i in range(200, 240, 2)]
    assert all(0.8 <= jaccard(texts[i], texts[j]) < 0.84 for i, j in pairs) and 0.7 < jaccard(texts[0], texts[1]) < 0.8
    assert found_groups(spark, texts) == {frozenset(p) for p in pairs}


def test_long_texts_are_judged_exactly(spark):
    """Texts of over 512 shingles just above and just below 0.8, decided as by brute force."""
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.getrandbits(40):x}" for _ in range(n)]
    texts = []
    for i in range(60):
        base = fresh(1800)
        texts += [" ".join(base), " ".join(base[: 1596 + i % 2 * 18] + fresh(204 - i % 2 * 18))]
    alike = [jaccard(texts[i], texts[i + 1]) for i in range(0, 120, 2)]
    assert all(0.78 < s < 0.82 for s in alike) and sum(s >= 0.8 for s in alike) == 30
    assert found_groups(spark, texts) == {frozenset((2 * i, 2 * i + 1)) for i, s in enumerate(alike) if s >= 0.8}


def test_repeated_passages_hide_no_pair(spark):
    """Texts with nearly the same shingle set are near duplicates however often a passage is pasted."""
    rng = random.Random(10)
    fresh = lambda n: [f"w{rng.getrandbits(40):x}" for _ in range(n)]
    texts = []
    for _ in range(20):
        passage, rest = fresh(44), fresh(360)
        texts += [" ".join(passage + rest), " ".join(passage * 30 + rest)]
    assert all(jaccard(texts[i], texts[i + 1]) > 0.95 for i in range(0, 40, 2))
    assert found_groups(spark, texts) == {frozenset((i, i + 1)) for i in range(0, 40, 2)}


def test_near_edges(spark, tmp_path):
    out = simhash.keep_one(saved(docs(spark), tmp_path))
    assert out.columns == docs(spark).columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(r[c] == c for r in rows.values() for c in CLASHING)
    assert {0, 3, 7, 12} <= set(rows) and not {1, 2, 8, 9, 13, 20, 21} & set(rows)
    assert simhash.keep_one(saved(empty(spark), tmp_path, "none")).count() == 0
    assert simhash.component_ids(empty(spark)).count() == 0


def plain_groups(texts):
    g = defaultdict(list)
    for i, t in enumerate(texts):
        g[lower(t)].append(i)
    return {i: (max(v), len(v), i == max(v), sha(k)) for k, v in g.items() for i in v}


def test_exact_groups(spark):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact.exact_groups(docs(spark)).collect()}
    assert got == plain_groups(TEXTS)
    assert exact.exact_groups(empty(spark)).count() == 0


def test_exact_repeats_and_null_ids(spark, tmp_path):
    d = docs(spark, ["x", "x", "x", "X", "y", "y"], [5, 5, None, 3, None, None])
    rows = exact.exact_groups(d).collect()
    assert sum(r["kept"] for r in rows) == 2 and {r["keep_id"] for r in rows} == {5, None}
    kept = exact.keep_largest(saved(d, tmp_path)).collect()
    assert sorted((r["doc_id"] or -1, r["text"], r["uid"]) for r in kept) == [(-1, "y", "uid"), (5, "x", "uid")]


def test_chunks_depend_on_nearby_content():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 400_000, dtype="u1").tobytes()
    a = exact.cut_points(data)
    b = exact.cut_points(data[:100] + b"inserted" + data[100:])
    assert a[-1] == len(data) and all(exact.LEAST <= y - x <= exact.MOST for x, y in zip([0, *a], a[:-1]))
    assert len({x + 8 for x in a} & set(b)) > 0.9 * len(a)
    assert exact.cut_points(b"") == [] and exact.cut_points(b"ab") == [2]


def test_collisions_are_told_apart(spark):
    """Chunks of one identifier but different content are reported; none are in real data."""
    rows = spark.createDataFrame([(b"i", b"one"), (b"i", b"two"), (b"j", b"same"), (b"j", b"same")], "id binary, blob binary")
    assert [bytes(r["id"]) for r in exact.collided(rows).collect()] == [b"i"]


def test_base_text_is_long_enough():
    assert len(BASE.split()) > 20


def test_components_do_not_depend_on_the_blocks(spark):
    """More blocks to a key, as for large corpora, link the same."""
    rows = [sorted(tuple(r) for r in simhash.component_ids(docs(spark), chosen=c).collect()) for c in (None, 3)]
    assert rows[0] == rows[1]


def test_grouped_runs():
    """Runs over any number of batches come whole and once."""
    import pyarrow as pa

    from docloom.llm.common import grouped_runs

    rng = random.Random(1)
    for _ in range(30):
        keys = sorted(rng.choice([1, 2, 3, 4, 5, 60]) for _ in range(rng.randrange(1, 60)))
        edges = sorted({0, len(keys), *(rng.randrange(len(keys) + 1) for _ in range(5))})
        batches = [pa.RecordBatch.from_pydict({"k": pa.array(keys[i:j], pa.int64()), "v": list(range(i, j))}) for i, j in zip(edges, edges[1:])]
        runs = [t.slice(i, j - i).to_pydict() for t, starts, ends in grouped_runs(batches, ["k"]) for i, j in zip(starts.tolist(), ends.tolist())]
        assert [x for r in runs for x in r["v"]] == list(range(len(keys))) and [set(r["k"]) for r in runs] == [{k} for k in sorted(set(keys))]
