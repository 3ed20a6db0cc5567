"""Suffix arrays, spelling variants and the alignment of tokenizers, against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import LONG, TEXTS, docs, empty, lower, saved, sha
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import align, common, spelling, suffix

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

# ---------------------------------------------------------------- suffix arrays

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_report(texts, items):
    windows = defaultdict(set)
    for item_id, t in items:
        w = WORD.findall(lower(t))
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[i : i + 10])].add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for t in texts:
        w, hit, met = WORD.findall(lower(t)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    met |= found
        ids = sorted(str(x) for x in met if x is not None)
        out.append((len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def report_rows(df):
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r["doc_id"])]


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as uid", "'x' as doc_id")


def leaky(seed=5, n=60):
    rng = np.random.default_rng(seed)
    vocabulary = ["w%d" % i for i in range(30)] + ["été", "naïve", "日本"]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 30)))) for i in range(25)]
    items += [(25, items[3][1]), (3, items[3][1]), (26, None), (27, "short one"), (28, "!!!"), (None, items[4][1].upper()), (29, " ".join([*items[5][1].split()[-6:], *items[6][1].split()[:9]]))]
    texts = []
    for i in range(n):
        w = list(rng.choice(vocabulary, rng.integers(0, 60)))
        for _ in range(rng.integers(0, 3)):
            source = (items[rng.integers(0, 25)][1] or "").split()
            a = int(rng.integers(0, len(source) + 1))
            k = int(rng.integers(0, len(w) + 1))
            w[k:k] = source[a : a + int(rng.integers(5, 30))]
        texts.append(rng.choice([" ", ", ", "\n"]).join(w))
    return [*texts, "a Short-ONE.", "short", None, "", items[7][1] * 2, " ".join(["w1"] * 40)], items


def test_suffix_report_against_plain(spark):
    texts, items = leaky()
    assert report_rows(suffix.report(docs(spark, texts), items_table(spark, items))) == plain_report(texts, items)
    more = [(i, t) for i, t in enumerate(TEXTS)]
    got = report_rows(suffix.report(docs(spark).repartition(3), items_table(spark, more)))
    assert got == plain_report(TEXTS, more)
    assert all(r[1] == r[0] for r in got)  # every document is an item


def test_suffix_shards_pieces_and_blocks_change_nothing(spark, monkeypatch):
    texts, items = leaky(6, 200)
    want = plain_report(texts, items)
    for piece, at_once in ((64, 7), (1 << 22, 3)):
        monkeypatch.setattr(suffix, "PIECE", piece)
        monkeypatch.setattr(suffix, "AT_ONCE", at_once)
        block = suffix.Block(items)
        text, begin = suffix.numbered(texts, block)
        hit = np.zeros(len(text), bool)
        for at, _, _, size in suffix.matches_in(text, block):
            for i, n in zip(at, size):
                hit[i : i + n] = True
        assert [int(hit[i:j].sum()) for i, j in zip(begin, begin[1:])] == [r[1] for r in want]
    monkeypatch.undo()
    found = suffix.hits(suffix.narrow(docs(spark, texts)), items_table(spark, items), block_size=300, shard=500)
    from pyspark.sql import functions as F

    got = {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["items"])) for r in found.withColumn("n_hit", F.expr(suffix.COVERED)).collect()}
    assert got == {i: r[:3] for i, r in enumerate(want)}


def test_longest_matches_are_verbatim_and_maximal(spark):
    texts, items = leaky(7)
    split = lambda t: WORD.findall(lower(t))
    by_id = {str(i): split(t) for i, t in items}
    found = {tuple(r) for r in suffix.matches(docs(spark, texts), items_table(spark, items)).collect() if r["item_id"] is not None}
    for doc, i, item, j, n in found:
        a, b = split(texts[doc]), by_id[item]
        assert a[i : i + n] == b[j : j + n] and n >= min(10, len(b))
        assert i == 0 or j == 0 or a[i - 1] != b[j - 1]
        assert i + n == len(a) or j + n == len(b) or a[i + n] != b[j + n]
    want = set()
    for doc, t in enumerate(texts):
        a = split(t)
        for item, b in by_id.items():
            if item == "None":
                continue
            for i in range(len(a)):
                for j in range(len(b)):
                    if a[i] == b[j] and (i == 0 or j == 0 or a[i - 1] != b[j - 1]):
                        n = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
                        if n >= min(10, len(b)):
                            want.add((doc, i, item, j, n))
    assert found == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=80), st.integers(1, 20))
def test_suffix_array_is_sorted(numbers, depth):
    text = np.array([*numbers, 0], "i4")
    found = suffix.suffix_array(text, depth).tolist()
    line = lambda i: text[i : i + text[i:].tolist().index(0)].tolist()[:depth]
    assert sorted(found) == np.flatnonzero(text).tolist()
    assert [line(i) for i in found] == sorted(line(i) for i in found)


def test_suffix_empty_tables_and_clean(spark, tmp_path):
    texts, items = leaky()
    none = spark.createDataFrame([], "item_id long, text string")
    assert suffix.report(empty(spark), items_table(spark, items)).count() == 0
    assert not any(r[4] for r in report_rows(suffix.report(docs(spark, texts), none)))
    table = saved(docs(spark, texts), tmp_path)
    left = suffix.clean(table, items_table(spark, items))
    assert left.columns == table.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, r in enumerate(plain_report(texts, items)) if not r[4]}


# ---------------------------------------------------------------- spelling variants


def plain_variants(texts, ids):
    counts = Counter()
    for i, t in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}

    def one_apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def misspelt(seed=3):
    rng = np.random.default_rng(seed)
    letters = list("abcdeéÀß×÷")
    stems = ["".join(rng.choice(letters, rng.integers(4, 9))) for _ in range(40)]
    words = []
    for s in stems:
        words += [s] * int(rng.integers(3, 60))
        for _ in range(6):
            i, kind = int(rng.integers(0, len(s))), rng.integers(0, 3)
            words += [s[:i] + (str(rng.choice(letters)) if kind else "") + s[i + (kind < 2) :]] * int(rng.integers(1, 12))
    rng.shuffle(words)
    return [" ".join(words[i : i + 25]) for i in range(0, len(words), 25)]


def test_variants_against_plain(spark):
    texts = [*misspelt(), None, "", "HELLO Hello hello, hallo hallo hallo; hullo", "aaaaa aaaaa aaaaa aaaa aaaa aaaa aaaaaa aaaaaa aaaaaa", "日本語étéétéétéé😀étéété", "abcdef " * 40 + "abcdeg " * 18 + "abcdgg " * 8]
    got = {tuple(r) for r in spelling.variants(docs(spark, texts).repartition(3)).collect()}
    want = plain_variants(texts, range(len(texts)))
    assert got == want and any(f for _, f, *_ in want) and any(r != f and f for _, f, r, *_ in want)


def test_no_vocabulary_is_broadcast(spark):
    words = common.cut(spark.createDataFrame([("hello", 9), ("hallo", 3)], "word string, n long"), "words")
    plan = spelling.near_pairs(words)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2


def test_variants_of_the_shared_table_and_empty(spark):
    assert {tuple(r) for r in spelling.variants(docs(spark)).collect()} == plain_variants(TEXTS, range(len(TEXTS)))
    assert spelling.variants(empty(spark)).count() == 0


def test_long_texts_are_counted_in_stretches(monkeypatch):
    whole, parts = Counter(), Counter()
    spelling.count_words(7, LONG + " été " * 50, whole)
    monkeypatch.setattr(spelling, "STRETCH", 11)
    spelling.count_words(7, LONG + " été " * 50, parts)
    assert whole == parts


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(37)] + [("x", "w005")]
    assert {tuple(r) for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()} == {(w, "w037") for w, _ in chain}


# ---------------------------------------------------------------- alignment of tokenizers


class Plain:
    """Both tokenizers over a whole text, and groups by end offsets."""

    def __init__(self):
        self.aligner = align.Aligner(BYTE, PIECE)

    def groups(self, text):
        if not text:
            return []
        a = self.aligner.tok.encode(" " + text, add_special_tokens=False).ids
        b = self.aligner.sp.encode(text)
        pieces = [self.aligner.sp.id_to_piece(i) for i in b]
        spelt_b = b"".join(bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces)
        # the byte-level decoder of the library itself, for valid text
        if self.aligner.tok.decode(a, skip_special_tokens=False) != " " + text or spelt_b != (" " + text).encode():
            return []
        end = lambda ids, size: np.cumsum([size[i] for i in ids]).tolist()
        ends_a, ends_b = end(a, self.aligner.a_len), end(b, self.aligner.b_len)
        out, i, j = [], 0, 0
        place_a, place_b = ({e: n for n, e in enumerate(ends, 1)} for ends in (ends_a, ends_b))
        for stop in sorted(place_a.keys() & place_b.keys()):
            k, m = place_a[stop], place_b[stop]
            out.append((a[i:k], b[j:m]))
            i, j = k, m
        return out

    def rows(self, texts):
        all_groups = [self.groups(t) for t in texts]
        count = Counter()
        for gs in all_groups:
            count.update({(x, y) for a, b in gs for x in a for y in b})
        best = defaultdict(int)
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        out = []
        for gs in all_groups:
            links = [(x, y) for a, b in gs for x in a for y in b]
            text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in gs)
            out.append((sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if gs else ""))
        return out


ODD = [
    " leading", "trailing ", "two  spaces", "three   spaces here", "tab\t here", "line\n\n  and more\n", "mark ▁ in text", "ends in mark▁", "<|endoftext|> <s> </s> <unk> <0x0A>", "it's I'll we've", "x  y 　z",
    "\x1c \x85 sep", " ", "  ", "\n", "😀😀 👩‍👩‍👧 é", "日本語 テキスト", "a" * 300, "ab " * 200, "1234567890 " * 20, "!?!?!?!? ---- ====", "Ωμέγα слово", "᠎ x", "word  wide", "a ▁b c",
]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_alignment_against_plain(spark, plain):
    texts = [*TEXTS, *ODD]
    for size in (1 << 24, 200):
        got = [tuple(r)[1:] for r in sorted(align.alignments(docs(spark, texts).repartition(3), BYTE, PIECE, size).collect(), key=lambda r: r["doc_id"])]
        assert got == plain.rows(texts)
    assert align.alignments(empty(spark), BYTE, PIECE).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab eé,.'sS1 \n\t▁ 　😀日-<|>"), max_size=40), min_size=1, max_size=6))
def test_segments_change_nothing(plain, texts):
    scan, flat, doc, spelt = plain.aligner.texts(texts)
    for i, t in enumerate(texts):
        want = plain.groups(t)
        assert bool(want) == bool(spelt[i])
        text = b"".join(scan.text[k] for k in flat[doc == i].tolist())
        assert text == "".join(f"{','.join(map(str, a))}|{','.join(map(str, b))};" for a, b in want).encode()


def test_large_groups_are_linked_by_distinct_ids(plain, monkeypatch):
    texts = ["one two, three four", "abcdefgh ijklmnop " * 5]
    pairs = lambda: Counter({int(p): int(n) for p, n in zip(s.pair, s.times)} if len(set((s := plain.aligner.scan(texts)[0]).pair.tolist())) == len(s.pair) else [int(p) for p, n in zip(s.pair, s.times) for _ in range(n)])
    usual = pairs()
    monkeypatch.setattr(align, "MANY", 0)
    assert pairs() == usual


def test_links_and_groups(spark, plain):
    texts = ["the cat sat", "the cat ran", None]
    found = {(r["a"], r["b"]): (r["count"], r["best"]) for r in align.links(docs(spark, texts), BYTE, PIECE).collect()}
    all_pairs = [{(x, y) for a, b in plain.groups(t) for x in a for y in b} for t in texts]
    assert {p: n for p, (n, _) in found.items()} == Counter(p for s in all_pairs for p in s)
    rows = align.groups(docs(spark, texts), BYTE, PIECE).collect()
    for i, t in enumerate(texts):
        mine = sorted((r["start"], r["end"], r["a"], r["b"]) for r in rows if r["doc_id"] == i)
        assert [(a, b) for *_, a, b in mine] == plain.groups(t)
        assert not t or [s for s, *_ in mine[1:]] == [e for _, e, *_ in mine[:-1]]
