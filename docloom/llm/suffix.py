"""Benchmark decontamination by suffix arrays over the training documents.

Words are runs of letters and digits after lower-casing A-Z; a window is 10 consecutive words of an item,
or the whole of a shorter one. Documents are taken in shards of about ``SHARD`` bytes of text. A shard's
words become numbers (words that no item has become 0, where every match ends), its suffixes are sorted by
prefix doubling up to the length of the longest item, and every suffix of every item is binary-searched in
it. The interval found holds all places where the item's window occurs verbatim; each is extended to its
longest match, whose location in document and item is known. A document's hit words are those of its matches.

Shards need no shuffle: a row of documents is read once and summed up in its task. Items come in blocks of
at most ``BLOCK`` bytes, which alone are broadcast, one at a time; only if the benchmark needs several are
documents read once a block, and what was found put together by row. Words are compared as bytes, through a
block's dictionary, so no match rests on a digest.

Defined cases: a null text has no words, an item without words no window. Repeated items count once by
item_id; an item whose id is null hits words but is in no list. Repeated documents are reported each. An
empty benchmark leaves every document clean; extra columns are ignored. A document longer than a shard is
one by itself, its suffixes sorted in pieces that overlap by the longest item.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UID, arrow_map, chunks, cut, trim

#: bytes of text to a shard; words to a piece of a long one; bytes of item texts to a block; occurrences handled at once
SHARD, PIECE, BLOCK, AT_ONCE = 16 << 20, 1 << 22, 16 << 20, 1 << 20
WINDOW = 10


def _plain() -> bytes:
    """Bytes as words are made of: A-Z lower-cased, blanks for all ASCII but letters and digits."""
    keep = lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
    low = [b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)]
    return bytes(b if keep(b) else 0x20 for b in low)


PLAIN = _plain()


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()


class Block:
    """Items of a block: their words as numbers, each item's suffixes that begin a window."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW) -> None:
        known: dict[tuple[bytes, ...], set] = {}
        for item_id, text in items:
            if w := tuple(words(text)):
                known.setdefault(w, set()).add(item_id)
        self.ids = [sorted(x for x in ids if x is not None) for ids in known.values()]
        self.vocabulary: dict[bytes, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        size = np.array([len(w) for w in known], "i8")
        self.text = np.array([x for w in known for x in (*map(number, w), 0)], "i4")
        self.start = np.cumsum(size + 1) - size - 1
        self.longest = int(size.max()) if len(size) else 0
        n = np.maximum(size - window, 0) + 1  # windows of each item
        self.item = np.repeat(np.arange(len(size)), n)
        self.at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - self.start, n)
        self.width = np.minimum(size, window)[self.item]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` (numbers; 0 ends a line, and the text) where a word stands, ordered by the words
    from there to the line's end, of which ``depth`` at least are compared."""
    at = np.flatnonzero(text)
    if not len(at):
        return at
    stops = np.flatnonzero(text == 0)
    reach = stops[np.searchsorted(stops, at)] - at  # words to the line's end
    bits = int(text.max()).bit_length()
    h = max(1, min(depth, 62 // bits))
    head = np.zeros(len(text) + 1, "i8")
    for _ in range(h):  # as many words as fit a number
        head[:-1] = np.where(text > 0, text.astype("i8") << bits * (h - 1) | head[1:] >> bits, 0)
    order = np.argsort(head[at])
    found, reach, key = at[order], reach[order], head[at][order]
    group = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), np.arange(len(key)), 0))
    rank = np.zeros(len(text), "i8")
    rank[found] = group + 1
    while h < depth:
        alone = np.append(True, group[1:] != group[:-1]) & np.append(group[1:] != group[:-1], True)
        open_ = np.flatnonzero(~alone & (reach >= h))  # equal so far, and not yet at their lines' ends
        if not len(open_):
            break
        key = group[open_] * (len(text) + 1) + rank[found[open_] + h]
        order = np.argsort(key)
        key, found[open_], reach[open_] = key[order], found[open_][order], reach[open_][order]
        group[open_] = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), open_, 0))
        rank[found[open_]] = group[open_] + 1
        h *= 2
    return found


def _order(text: np.ndarray, at: np.ndarray, block: Block, which: np.ndarray) -> np.ndarray:
    """-1, 0, 1: the suffixes at ``at`` against the windows ``which``, word by word."""
    out, left = np.zeros(len(at), "i1"), np.arange(len(at))
    j = 0
    while len(left):
        a, b = text[at[left] + j], block.text[block.at[which[left]] + j]
        out[left] = np.sign(a.astype("i8") - b)
        j += 1
        left = left[(a == b) & (block.width[which[left]] > j)]
    return out


def interval(text: np.ndarray, found: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Of every window of the block, the first and last place + 1 in the suffix array that begin with it."""
    out = []
    for after in (False, True):
        low, high = np.zeros(len(block.at), "i8"), np.full(len(block.at), len(found), "i8")
        left = np.flatnonzero(low < high)
        while len(left):
            mid = (low[left] + high[left]) >> 1
            c = _order(text, found[mid], block, left)
            right = c <= 0 if after else c < 0
            low[left] = np.where(right, mid + 1, low[left])
            high[left] = np.where(right, high[left], mid)
            left = left[low[left] < high[left]]
        out.append(low)
    return out[0], out[1]


def matches_in(text: np.ndarray, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Longest matches of ``text`` and the block's items, in parts: place in the text, item, place in the
    item, words. A match can be extended on neither side."""
    if not len(block.at):
        return
    for begin in range(0, len(text), PIECE):
        piece = text[begin : begin + PIECE + block.longest]
        piece = piece if piece[-1] == 0 else np.append(piece, np.int32(0))
        found = suffix_array(piece, block.longest)
        low, high = interval(piece, found, block)
        some = np.flatnonzero(high > low)
        total = np.append(0, np.cumsum(high[some] - low[some]))
        for first in range(0, int(total[-1]), AT_ONCE):  # a window that is very frequent is taken in parts
            nth = np.arange(first, min(first + AT_ONCE, int(total[-1])))
            k = np.searchsorted(total, nth, side="right") - 1
            which = some[k]
            at, there = found[low[which] + nth - total[k]], block.at[which]
            own = at < PIECE
            at, there, which = at[own] + begin, there[own], which[own]
            before = np.where(there > 0, block.text[there - 1], 0)
            begins = (before == 0) | (np.where(at > 0, text[at - 1], 0) != before)
            at, there, which = at[begins], there[begins], which[begins]
            size, left = block.width[which].copy(), np.arange(len(at))
            while len(left):
                a, b = text[at[left] + size[left]], block.text[there[left] + size[left]]
                left = left[(a == b) & (a > 0)]
                size[left] += 1
            yield at, block.item[which], there - block.start[block.item[which]], size


def numbered(texts: list[str | None], block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words as the block's numbers, with a 0 after each text, and where each text begins."""
    parts, at, n = [], [0], 0
    get = block.vocabulary.get
    for t in texts:
        w = words(t)
        ids = np.zeros(len(w) + 1, "i4")
        ids[:-1] = np.fromiter(map(get, w, repeat(0)), "i4", len(w))
        parts.append(ids)
        n += len(ids)
        at.append(n)
    return np.concatenate([*parts, np.zeros(0, "i4")]), np.array(at, "i8")


def narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def blocks(benchmark: DataFrame, size: int = BLOCK) -> tuple[int, Iterator[Block]]:
    """The benchmark's items, dealt by a digest to as many blocks as hold ``size`` bytes each on average:
    how many, and each when it is asked for."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // size))
    part = lambda i: items.where(F.expr(f"pmod(xxhash64(item_id, text), {n}) = {i}")).collect()
    return n, (Block([tuple(r) for r in part(i)]) for i in range(n))


HITS = "uid long, doc_id long, n_words long, spans array<struct<start: long, end: long>>, items array<string>"


def _hits(table: pa.Table, block: Block) -> pa.RecordBatch:
    text, begin = numbered(table.column("text").to_pylist(), block)
    n = table.num_rows
    step, met = np.zeros(len(text) + 1, "i4"), [np.zeros(0, "i8")]
    for at, item, _, size in matches_in(text, block):
        np.add.at(step, at, 1)
        np.add.at(step, at + size, -1)
        met.append(np.unique((np.searchsorted(begin, at, side="right") - 1) << 32 | item))
    hit = np.cumsum(step[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype("i1")))
    start, end = edge[::2], edge[1::2]
    doc = np.searchsorted(begin, start, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array(start - begin[doc]), pa.array(end - begin[doc])], names=["start", "end"])
    met = np.unique(np.concatenate(met))
    of = np.searchsorted(met >> 32, np.arange(n + 1)).tolist()
    ids = [sorted({x for k in (met[i:j] & 0xFFFFFFFF).tolist() for x in block.ids[k]}) for i, j in zip(of, of[1:])]
    offsets = np.searchsorted(doc, np.arange(n + 1)).astype("i4")
    return pa.RecordBatch.from_arrays(
        [table.column("uid").combine_chunks(), table.column("doc_id").combine_chunks(), pa.array(np.diff(begin) - 1), pa.ListArray.from_arrays(pa.array(offsets), spans), pa.array(ids, pa.list_(pa.string()))],
        names=["uid", "doc_id", "n_words", "spans", "items"],
    )


def hits(docs: DataFrame, benchmark: DataFrame, block_size: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(uid, doc_id, n_words, spans, items) of docs (uid, doc_id, text): the word spans of each document
    that matches cover, and the ids of the items with an occurring window, sorted."""
    n, each = blocks(benchmark, block_size)
    several: DataFrame | None = None
    for block in each:
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            for table in chunks(batches, shard):
                yield _hits(table, sent.value)
                trim()

        found = arrow_map(docs, run, HITS)
        if n == 1:
            return found
        found = cut(found if several is None else found.where("size(spans) > 0"), "hits")
        several = found if several is None else several.unionByName(found)
        sent.unpersist()
    flat = lambda c: F.flatten(F.collect_list(c))
    return several.groupBy("uid", "doc_id", "n_words").agg(F.array_sort(flat("spans")).alias("spans"), F.array_sort(F.array_distinct(flat("items"))).alias("items"))


#: words under spans that are sorted and may overlap
COVERED = (
    "aggregate(spans, named_struct('n', 0L, 'upto', 0L), (s, x) -> named_struct('n', s.n + greatest(0L, x.end - greatest(x.start, s.upto)), 'upto', greatest(s.upto, x.end)), s -> s.n)"
)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = hits(narrow(docs), benchmark)
    return out.select(
        "doc_id", "n_words", F.expr(COVERED).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def matches(docs: DataFrame, benchmark: DataFrame, block_size: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """(doc_id, doc_start, item_id, item_start, n_words): every longest verbatim match, in words."""
    n, each = blocks(benchmark, block_size)
    out: DataFrame | None = None
    for block in each:
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            block = sent.value
            for table in chunks(batches, shard):
                text, begin = numbered(table.column("text").to_pylist(), block)
                doc_ids = table.column("doc_id").combine_chunks()
                for at, item, there, size in matches_in(text, block):
                    doc = np.searchsorted(begin, at, side="right") - 1
                    names = [block.ids[k] or [None] for k in item.tolist()]
                    rows = np.repeat(np.arange(len(at)), [len(x) for x in names])
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.take(pa.array(doc[rows])), pa.array((at - begin[doc])[rows]), pa.array([y for x in names for y in x], pa.string()), pa.array(there[rows]), pa.array(size[rows])],
                        names=["doc_id", "doc_start", "item_id", "item_start", "n_words"],
                    )

        found = arrow_map(narrow(docs), run, "doc_id long, doc_start long, item_id string, item_start long, n_words long")
        if n > 1:
            found = cut(found, "matches")
            sent.unpersist()
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (a table on disk) without the documents that any window of the benchmark occurs in."""
    told = docs.withColumn(UID, F.monotonically_increasing_id())
    found = hits(told.select(F.col(UID).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), benchmark)
    gone = found.where("size(spans) > 0").select(F.col("uid").alias(UID))
    return told.join(gone, UID, "left_anti").select(*docs.columns)


SQL = r"""
    WITH doc AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    item AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    win AS (
        SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS t
        FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
    place AS (
        SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS t
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
    met AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM place p JOIN win ON p.t = win.t AND p.n = win.n),
    hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM met) GROUP BY doc_id),
    found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM met) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)"""
