"""Language-model scores by prediction by partial matching (PPM).

A text is a row of bytes: its words (A-Z lower-cased), each closed by a blank, and one more blank, the end;
before it stand blanks. The model is a byte-context trie that is pretrained on all texts outside of the
held-out fold (crc32 of the doc_id as text, mod 5, is 1). A byte is predicted from the longest context
that the trie has:

* the long context, for the first ``REACH`` bytes of a token: the ``HISTORY`` bytes before the token and the
  bytes of the token so far. It crosses two or three words, so it tells passages apart.
* then the ``ORDER``, .., 1, 0 bytes before, across words, and last a uniform choice.

Where a context has not seen the byte, an escape is paid (estimator D: half a count for the escape, taken
from each symbol) and the next context predicts with the symbols of the longer ones excluded. Every
context is a suffix of the one before it, so its symbols include those of the longer ones, and exclusion
is a subtraction: of the counts that a context's symbols have one order below.

How it is spread out: one pass turns each slice of a partition into a chunk: its distinct words and its
documents as rows of word numbers; texts are not read again. A chunk sends three kinds of packed requests,
each item once: long contexts, dealt by digest into shards; short contexts with their symbol (``grams``),
dealt by digest to be summed first, so that a frequent gram is one row a chunk and then one row; and word digests.
Costs of short contexts are computed once for each distinct gram, grouped by the last two bytes of the
context, and dealt back by digest. Answers come back packed by chunk. The number of shards follows the size of
the text, so that what a task holds stays the same; counts of orders 0 and 1 are the only shared ones (65,536).
Long contexts are told apart within a shard by 40 bits of their digest, words by 64.

Defined cases: null and empty texts are one end token; a null doc_id is of the training fold and is
returned as null; repeated rows count, and are scored, each; without any training document, N and V are 0
and the trie is empty (uniform bytes); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, discard, slices, trim

ORDER, HISTORY, REACH = 5, 16, 4
CHUNK_BYTES = 8 << 20
#: bytes of text to a shard of long contexts, grams or words
SHARD_BYTES = 4 << 20
PART = 2 << 20
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9)]
U8 = np.uint64
CHUNK_COLUMNS = ("data", "sizes", "doc_ids")


def is_held_out(doc_id: int | None, folds: int = 5) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 1


def _pack(a: np.ndarray) -> bytes:
    """Byte planes, compressed: what varies little packs well."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(np.ascontiguousarray(a).view("u1").reshape(len(a), a.dtype.itemsize).T).tobytes())


def _unpack(b: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), "u1")
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _pack_sorted(a: np.ndarray) -> bytes:
    return _pack(np.diff(a, prepend=U8(0)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, "<u8"), dtype="u8")


def _starts(changed: np.ndarray) -> np.ndarray:
    """Places where runs begin; ``changed`` tells whether a place differs from the one before it."""
    return np.concatenate(([0], np.flatnonzero(changed) + 1))


def chunks(docs: DataFrame) -> DataFrame:
    """chunk, data (for every document HISTORY blanks, its words, each with a blank after it, and one more
    blank; compressed), sizes (bytes of each in data), doc_ids, bytes (of data)."""

    def flush(parts, doc_ids):
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(parts))
        sizes = np.fromiter(map(len, parts), "<u4", len(parts))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((uuid.uuid4().int >> 65, data, _pack(sizes), doc_ids, int(sizes.sum())), kinds)], names=["chunk", *CHUNK_COLUMNS, "bytes"])

    def run(batches):
        parts, doc_ids, held = [], [], 0
        for b in batches:
            for s in slices(b, "text"):
                for i, t in zip(s.column("doc_id").to_pylist(), s.column("text").to_pylist()):
                    words = b" ".join((t or "").encode("utf-8", "surrogatepass").lower().split())
                    parts.append(b" " * HISTORY + (words + b"  " if words else b" "))
                    doc_ids.append(i)
                    held += len(parts[-1])
                    if held >= CHUNK_BYTES:
                        yield flush(parts, doc_ids)
                        parts, doc_ids, held = [], [], 0
        if doc_ids:
            yield flush(parts, doc_ids)
        parts = None
        trim()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(narrow, run, "chunk long, data binary, sizes binary, doc_ids array<long>, bytes long")


class Chunk:
    """A chunk's bytes in a row, where each document begins (doc_at) and how many tokens it has (sizes), and of
    each token where it starts (at), its first bytes (head) and their number with the closing blank (reach)."""

    def __init__(self, data: bytes, sizes: bytes, doc_ids: list) -> None:
        self.raw = zstandard.ZstdDecompressor().decompress(data)
        self.data, self.doc_ids, self.docs = np.frombuffer(self.raw, "u1"), doc_ids, len(doc_ids)
        self.held_out = np.fromiter(map(is_held_out, doc_ids), bool, self.docs)
        length = _unpack(sizes, "<u4").astype("i8")
        self.doc_at = np.cumsum(length) - length
        # a token follows a blank, but for those before a document and the last one
        before = self.data == 32
        before[(self.doc_at[:, None] + np.arange(HISTORY - 1)).ravel()] = False
        before[self.doc_at + length - 1] = False
        self.at = np.flatnonzero(before) + 1
        self.sizes = np.diff(np.append(np.searchsorted(self.at, self.doc_at), len(self.at)))
        self.head, self.reach, over = np.zeros(len(self.at), "u4"), np.full(len(self.at), REACH, "i1"), np.zeros(len(self.at), bool)
        for j in range(REACH):
            byte = self.data[np.minimum(self.at + j, len(self.data) - 1)]
            self.head |= np.where(over, 32, byte).astype("u4") << np.uint32(8 * (REACH - 1 - j))
            closing = ~over & (byte == 32)
            self.reach[closing] = j + 1
            over |= closing

    def per_token(self, of_docs: np.ndarray) -> np.ndarray:
        return np.repeat(of_docs, self.sizes)

    def per_byte(self, of_docs: np.ndarray) -> np.ndarray:
        return np.repeat(of_docs, np.diff(np.append(self.doc_at, len(self.data))))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Digests of the distinct words, and for every token the number of its word (the end has the last one)."""
        texts = [self.raw[i + HISTORY : j - 1] for i, j in zip(self.doc_at.tolist(), [*self.doc_at[1:].tolist(), len(self.raw)])]
        # a text's words and, since a blank closes each, an empty one for its end
        coded = pc.dictionary_encode(pc.split_pattern(pa.array(texts, pa.binary()), pattern=" ").flatten())
        found, of = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype("i8")
        digest = np.fromiter(map(xxhash.xxh64_intdigest, found), "u8", len(found))
        end = found.index(b"") if b"" in found else -1
        number = np.cumsum(np.arange(len(found)) != end) - 1
        if end >= 0:
            number[end] = len(found) - 1
        return np.delete(digest, end) if end >= 0 else digest, number[of]

    def grams(self, i: int, j: int) -> np.ndarray:
        """Of the bytes i to j (i at least HISTORY): the context, its nearest byte highest, and the byte itself lowest."""
        g = self.data[i:j].astype("u8")
        for k in range(1, ORDER + 1):
            g |= self.data[i - k : j - k].astype("u8") << U8(8 * (ORDER + 1 - k))
        return g

    def parts(self):
        for i in range(HISTORY, len(self.data), PART):
            yield i, min(i + PART, len(self.data))

    def base_places(self, depth: np.ndarray) -> np.ndarray:
        """Marks the bytes that short contexts predict: those of tokens from ``depth`` on."""
        mark = np.ones(len(self.data), bool)
        mark[(self.doc_at[:, None] + np.arange(HISTORY)).ravel()] = False
        for j in range(REACH):
            mark[self.at[depth > j] + j] = False
        return mark

    def asked(self) -> np.ndarray:
        """Bytes that may need short contexts: all of held-out texts, and of others what long contexts do not reach."""
        return self.base_places(np.where(self.per_token(self.held_out), 0, self.reach))

    def long_items(self, shards: int):
        """Long contexts with the token's head, by shard: shard, digest, head, and the item of every token. Equal
        ones are one item where they come together in an order by shard and some bits of digest and head."""
        n = len(self.at)
        digest = np.empty(n, "u8")
        view = np.lib.stride_tricks.sliding_window_view(self.data, HISTORY)
        for i in range(0, n, 500_000):
            two = np.ascontiguousarray(view[self.at[i : i + 500_000] - HISTORY]).view("<u8")
            m = (two[:, 0] * MIX[0]) ^ (two[:, 1] * MIX[1])
            m = (m ^ (m >> U8(29))) * MIX[2]
            digest[i : i + 500_000] = m ^ (m >> U8(32))
        shard = (digest & U8(0xFFFFFF)) % U8(shards)
        digest >>= U8(24)
        # one sort of numbers: shard, high bits of the digest, 8 bits of the head, and the token in the low bits
        low, high = max(1, n.bit_length()), max(1, shards.bit_length())
        bits = max(0, 64 - low - high - 8)
        key = (shard << U8(bits)) | (digest >> U8(max(0, 40 - bits)))
        key = (key << U8(8)) | ((self.head * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype("u8")
        key = np.sort((key << U8(low)) | np.arange(n, dtype="u8"))
        order = (key & U8((1 << low) - 1)).astype("i8")
        k, h = digest[order], self.head[order]
        new = np.ones(n, bool)
        new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1]) | ((key[1:] >> U8(64 - high)) != (key[:-1] >> U8(64 - high)) if bits else True)
        item = np.empty(n, "i8")
        item[order] = np.cumsum(new) - 1
        return shard[order][new].astype("i8"), k[new], h[new], item


def _shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    m = grams * MIX[0]
    return (((m ^ (m >> U8(31))) * MIX[1] >> U8(40)) % U8(shards)).astype("i8")


def _edges(shard: np.ndarray):
    """(shard, from, to) of the runs of a sorted array."""
    at = np.flatnonzero(np.diff(shard, prepend=-1))
    return zip(shard[at].tolist(), at.tolist(), [*at[1:].tolist(), len(shard)])




def _per_chunk(table: DataFrame, make, names: list[str], schema: str) -> DataFrame:
    """Rows (shard, chunk, names..: binary) that ``make(Chunk)`` gives for every chunk."""

    def run(batches):
        for b in batches:
            for chunk, *row in zip(*(b.column(c).to_pylist() for c in ("chunk", *CHUNK_COLUMNS))):
                rows = list(make(Chunk(*row)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), *(pa.array([r[k + 1] for r in rows], pa.binary()) for k in range(len(names)))], names=["shard", "chunk", *names]
                )
                rows = None
        trim()

    return arrow_map(table.select("chunk", *CHUNK_COLUMNS), run, schema)


def _long_requests(table: DataFrame, shards: int) -> DataFrame:
    def make(c: Chunk):
        shard, digest, head, item = c.long_items(shards)
        n = np.bincount(item, c.per_token(~c.held_out), len(shard)).astype("<u4")
        # the bytes before a token, for items of held-out texts alone: those before any one of its tokens
        one = np.empty(len(shard), "i8")
        one[item] = c.at
        tail = np.zeros(len(shard), "u8")
        for k in range(1, ORDER + 1):
            tail |= c.data[one - k].astype("u8") << U8(8 * (ORDER - k))
        for s, i, j in _edges(shard):
            yield s, _pack_sorted(digest[i:j]), _pack(head[i:j]), _pack(n[i:j]), _pack(tail[i:j][n[i:j] == 0])

    return _per_chunk(table, make, ["digest", "head", "n", "tail"], "shard int, chunk long, digest binary, head binary, n binary, tail binary")


def _by_two(digest: np.ndarray, head: np.ndarray) -> np.ndarray:
    """The order by digest (40 bits) and head. Most digests are alone, so the first sort is of one number each."""
    low = len(digest).bit_length()
    if low > 24:
        return np.lexsort((head, digest))
    order = (np.sort((digest << U8(low)) | np.arange(len(digest), dtype="u8")) & U8((1 << low) - 1)).astype("i8")
    d, h = digest[order], head[order]
    same = d[1:] == d[:-1]
    some = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    order[some] = order[some][np.lexsort((h[some], d[some]))]
    return order


def _closed(head: np.ndarray) -> np.ndarray:
    """Bytes of a head up to the blank that closes the token, REACH at most."""
    out = np.full(len(head), REACH)
    for j in range(REACH - 1, -1, -1):
        out[(head >> np.uint32(8 * (REACH - 1 - j)) & np.uint32(255)) == 32] = j + 1
    return out


def long_costs(digest: np.ndarray, head: np.ndarray, n: np.ndarray, tail: np.ndarray):
    """For items of a shard: log10 cost by long contexts, depth (bytes that they predict), and misses as
    (item, gram, symbols seen): the context knew other symbols than the byte that follows."""
    order = _by_two(digest, head)
    d = digest[order]
    same = d[1:] == d[:-1]
    alone = ~(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    out, deep = np.zeros(len(order), "<f4"), np.zeros(len(order), "u1")
    # a context with one item is certain of it, or was never seen
    one = order[alone]
    one = one[n[one] > 0]
    deep[one] = _closed(head[one])
    out[one] = deep[one] * np.log10((n[one] - 0.5) / n[one])
    order = order[~alone]
    cost, depth, misses = _shared_contexts(digest[order], head[order], n[order].astype("i8"), tail[order])
    out[order], deep[order] = cost, depth
    return out, deep, [(order[i], g, seen) for i, g, seen in misses]


def _shared_contexts(digest: np.ndarray, head: np.ndarray, n: np.ndarray, tail: np.ndarray):
    """long_costs for items in the order of digest and head."""
    size = len(digest)
    if not size:
        return np.zeros(0), np.zeros(0, "i8"), []
    sums = np.concatenate(([0], np.cumsum(n)))
    other = digest[1:] != digest[:-1]
    starts = [_starts(other)] + [_starts(other | (head[1:] >> np.uint32(8 * (REACH - 1 - j)) != head[:-1] >> np.uint32(8 * (REACH - 1 - j)))) for j in range(REACH)]
    counts = [sums[np.append(s[1:], size)] - sums[s] for s in starts]
    group = [np.repeat(np.arange(len(s)), np.diff(np.append(s, size))) for s in starts]
    symbol = [(head >> np.uint32(8 * (REACH - 1 - j)) & np.uint32(255)).astype("i8") for j in range(REACH)]
    closed = _closed(head)
    cost, depth, alive = np.zeros(size), closed.copy(), np.ones(size, bool)
    misses = []
    for j in range(REACH):
        now = alive & (j < closed)
        kids = group[j][starts[j + 1]]  # the group of every group one byte longer
        seen = np.bincount(kids, counts[j + 1] > 0, len(starts[j])).astype("i8")
        total, distinct, mine = counts[j][group[j]], seen[group[j]], counts[j + 1][group[j + 1]]
        hit, miss = now & (mine > 0), now & (total > 0) & (mine == 0)
        full = distinct[hit] >= 256
        cost[hit] += np.log10(np.where(full, mine[hit], mine[hit] - 0.5) / total[hit])
        cost[miss] += np.log10(distinct[miss] / (2 * total[miss]))
        depth[now & ~hit] = j
        alive &= ~(now & ~hit)
        at = np.flatnonzero(miss)
        if len(at):
            first = np.searchsorted(kids, group[j][at], "left")
            last = np.searchsorted(kids, group[j][at], "right")
            context = tail[at]
            for k in range(j):
                context = (symbol[k][at].astype("u8") << U8(8 * (ORDER - 1))) | (context >> U8(8))
            gram = (context << U8(8)) | symbol[j][at].astype("u8")
            trained, of = counts[j + 1] > 0, symbol[j][starts[j + 1]]
            misses += [(i, g, of[a:b][trained[a:b]].tolist()) for i, g, a, b in zip(at.tolist(), gram.tolist(), first.tolist(), last.tolist())]
    return cost, depth, misses


def _by_shard(batches, columns):
    """Rows of equal shard, one list a column, of partitions sorted by shard."""
    shard, held = None, [[] for _ in columns]
    for b in batches:
        values = [b.column(c).to_pylist() for c in columns]
        for k, s in enumerate(b.column("shard").to_pylist()):
            if s != shard and held[0]:
                yield shard, held
                held = [[] for _ in columns]
            shard = s
            for x, v in zip(held, values):
                x.append(v[k])
    if held[0]:
        yield shard, held


def _long_answers(requests: DataFrame) -> DataFrame:
    """(chunk, shard, cost, depth) packed, and (chunk, shard, idx, gram, seen) of misses."""
    kinds = {"chunk": pa.int64(), "shard": pa.int32(), "cost": pa.binary(), "depth": pa.binary(), "idx": pa.int32(), "gram": pa.int64(), "seen": pa.list_(pa.int32())}

    def out(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in kinds.items()], names=list(kinds))

    def run(batches):
        for shard, (chunk, digest, head, n, tail) in _by_shard(batches, ("chunk", "digest", "head", "n", "tail")):
            counts = [_unpack(x, "<u4") for x in n]
            tails = []
            for c, x in zip(counts, tail):
                t = np.zeros(len(c), "u8")
                t[c == 0] = _unpack(x, "<u8")
                tails.append(t)
            edge = np.concatenate(([0], np.cumsum([len(c) for c in counts])))
            cost, depth, misses = long_costs(np.concatenate([_unpack_sorted(x) for x in digest]), np.concatenate([_unpack(x, "<u4") for x in head]), np.concatenate(counts), np.concatenate(tails))
            counts = tails = None
            yield out(len(chunk), chunk=chunk, shard=[shard] * len(chunk), cost=[_pack(cost[i:j]) for i, j in zip(edge, edge[1:])], depth=[_pack(depth[i:j]) for i, j in zip(edge, edge[1:])])
            for k in range(0, len(misses), 20_000):
                some = misses[k : k + 20_000]
                of = np.searchsorted(edge, [m[0] for m in some], "right") - 1
                yield out(len(some), chunk=[chunk[x] for x in of], shard=[shard] * len(some), idx=[int(m[0] - edge[x]) for m, x in zip(some, of)], gram=[m[1] for m in some], seen=[m[2] for m in some])
        trim()

    return arrow_map(requests.repartition("shard").sortWithinPartitions("shard"), run, "chunk long, shard int, cost binary, depth binary, idx int, gram long, seen array<int>")


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    u, inv = np.unique(k, return_inverse=True)
    return u, np.bincount(inv, c, len(u)).astype("i8")


def _gram_requests(table: DataFrame, shards: int) -> DataFrame:
    """The grams of every chunk with their counts in training texts: those whose cost it needs, and others."""

    def make(c: Chunk):
        need, train = c.asked(), c.per_byte(~c.held_out)
        inside = c.base_places(np.zeros(len(c.at), "i8"))
        keys, counts, needs = [], [], []
        for i, j in c.parts():
            # a gram has 48 bits; two flags below it are sorted along
            g = (c.grams(i, j) << U8(2)) | (train[i:j].astype("u8") << U8(1)) | need[i:j].astype("u8")
            g = np.sort(g[inside[i:j]])
            if not len(g):
                continue
            at = _starts(g[1:] >> U8(2) != g[:-1] >> U8(2))
            keys.append(g[at] >> U8(2))
            counts.append(np.add.reduceat((g >> U8(1) & U8(1)).astype("i8"), at))
            needs.append(np.add.reduceat((g & U8(1)).astype("i8"), at))
        u, inv = np.unique(np.concatenate(keys), return_inverse=True)
        n, asked = np.bincount(inv, np.concatenate(counts), len(u)).astype("<u4"), np.bincount(inv, np.concatenate(needs), len(u)) > 0
        shard = _shard_of(u, shards)
        by = np.lexsort((u, ~asked, shard))
        u, n, asked, shard = u[by], n[by], asked[by], shard[by]
        for s, i, j in _edges(shard):
            m = i + int(asked[i:j].sum())
            yield s, _pack_sorted(u[i:m]), _pack(n[i:m]), _pack_sorted(u[m:j]), _pack(n[m:j])

    return _per_chunk(table, make, ["keys", "n", "more_keys", "more_n"], "shard int, chunk long, keys binary, n binary, more_keys binary, more_n binary")


def _gram_sums(requests: DataFrame) -> DataFrame:
    """(gram, n) of all chunks; n is 0 for grams of held-out texts alone."""

    def run(batches):
        def flush(keys, counts):
            u, n = _summed(keys, counts)
            for i in range(0, len(u), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(u[i : i + 50_000].view("i8")), pa.array(n[i : i + 50_000])], names=["gram", "n"])

        shard, keys, counts, size = None, [], [], 0
        for b in batches:
            for s, *row in zip(*(b.column(c).to_pylist() for c in ("shard", "keys", "n", "more_keys", "more_n"))):
                if s != shard and keys:
                    yield from flush(keys, counts)
                    keys, counts, size = [], [], 0
                shard = s
                keys += [_unpack_sorted(row[0]), _unpack_sorted(row[2])]
                counts += [_unpack(row[1], "<u4"), _unpack(row[3], "<u4")]
                size += len(keys[-1]) + len(keys[-2])
                if size > 4_000_000:  # distinct grams alone stay
                    u, n = _summed(keys, counts)
                    keys, counts, size = [u], [n], len(u) // 2
        if keys:
            yield from flush(keys, counts)
        trim()

    return arrow_map(requests.repartition("shard").sortWithinPartitions("shard"), run, "gram long, n long")


def short_costs(gram: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of each gram's probability by its context's orders ORDER to 0. ``gram`` is sorted and holds all grams
    of its contexts' last two bytes; ``pairs`` (256 x 256) are the counts of symbols after one byte."""
    trained = n > 0
    keys, counts, levels = gram[trained], n[trained].astype("f8"), {}
    one, zero = pairs.astype("f8"), pairs.sum(0).astype("f8")
    for k in range(ORDER, 1, -1):  # a level: grams, counts, contexts, their totals, symbols and counts one order below
        context = keys >> U8(8)
        at = np.flatnonzero(np.diff(context, prepend=~context[:1])) if len(context) else np.empty(0, "i8")
        of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(context))))
        if k > 2:
            short = ((keys >> U8(16)) << U8(8)) | (keys & U8(255))
            below, inv = np.unique(short, return_inverse=True)
            lower = np.bincount(inv, counts, len(below))
            under = lower[inv]
        else:
            below = lower = None
            under = one[(keys >> U8(16)).astype("i8"), (keys & U8(255)).astype("i8")]
        levels[k] = keys, counts, context[at], np.bincount(of, counts, len(at)), np.bincount(of, minlength=len(at)), np.bincount(of, under, len(at))
        keys, counts = below, lower
    symbol = (gram & U8(255)).astype("i8")
    first = (gram >> U8(8 * ORDER)).astype("i8")
    cost, done = np.zeros(len(gram)), np.zeros(len(gram), bool)
    gone, spent = np.zeros(len(gram)), np.zeros(len(gram))  # excluded symbols, and their counts at the level below

    def step(mine, total, distinct, under):
        nonlocal gone, spent
        left, kinds = total - spent, distinct - gone
        here = ~done & (kinds > 0)
        hit, miss = here & (mine > 0), here & (mine == 0)
        cost[hit] += np.log10(np.where(distinct[hit] >= 256, mine[hit], mine[hit] - 0.5) / left[hit])
        cost[miss] += np.log10(kinds[miss] / (2 * left[miss]))
        done[hit] = True
        gone, spent = np.where(distinct > 0, distinct, gone), np.where(distinct > 0, under, spent)

    def found(where, what):
        at = np.minimum(np.searchsorted(where, what), max(0, len(where) - 1))
        return at, (where[at] == what) if len(where) else np.zeros(len(what), bool)

    for k in range(ORDER, 1, -1):
        keys, counts, contexts, total, distinct, under = levels[k]
        mine = ((gram >> U8(8 * (ORDER + 1 - k))) << U8(8)) | (gram & U8(255))
        at, ok = found(keys, mine)
        on, seen = found(contexts, mine >> U8(8))
        take = lambda x, i, m: np.where(m, x[i], 0) if len(x) else np.zeros(len(gram))
        step(take(counts, at, ok), take(total, on, seen), take(distinct, on, seen), take(under, on, seen))
    under = (np.where(one > 0, zero[None, :], 0)).sum(1)
    step(one[first, symbol], one.sum(1)[first], (one > 0).sum(1)[first], under[first])
    step(zero[symbol], np.full(len(gram), zero.sum()), np.full(len(gram), float((zero > 0).sum())), np.zeros(len(gram)))
    rest = ~done
    cost[rest] -= np.log10(256 - gone[rest])
    return cost


def _gram_costs(grams: DataFrame, pairs: np.ndarray, shards: int) -> DataFrame:
    """(shard, gram, cost) of every gram; a task holds whole groups of contexts with the same last two bytes."""

    def run(batches):
        def flush(g, n):
            cost = short_costs(g.view("u8"), n, pairs)
            return pa.RecordBatch.from_arrays([pa.array(_shard_of(g.view("u8"), shards).astype("i4")), pa.array(g), pa.array(cost.astype("f4"))], names=["shard", "gram", "cost"])

        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size < 300_000:
                continue
            t = pa.Table.from_batches(held)
            g, n = t.column("gram").to_numpy(), t.column("n").to_numpy()
            last = int(np.searchsorted(g, g[-1] >> (8 * (ORDER - 1)) << (8 * (ORDER - 1))))
            held, size = t.slice(last).combine_chunks().to_batches(), (0 if last else size - 300_000)
            if last:
                yield flush(g[:last], n[:last])
        if held:
            t = pa.Table.from_batches(held)
            yield flush(t.column("gram").to_numpy(), t.column("n").to_numpy())
        trim()

    dealt = grams.repartition(F.shiftright("gram", 8 * (ORDER - 1))).sortWithinPartitions("gram")
    return arrow_map(dealt, run, "shard int, gram long, cost float")


def _gram_answers(costs: DataFrame, requests: DataFrame) -> DataFrame:
    """(chunk, shard, keys, cost) packed: a shard's costs come first and stay, its requests stream by."""

    def run(batches):
        shard, grams, cost, ready = None, [], [], None
        for b in batches:
            shards, kind = b.column("shard").to_numpy(), b.column("kind").to_numpy()
            edges = np.flatnonzero(np.diff(shards, prepend=-1) | np.diff(kind, prepend=-1))
            for i, j in zip(edges.tolist(), [*edges[1:].tolist(), b.num_rows]):
                part = b.slice(i, j - i)
                if shards[i] != shard:
                    shard, grams, cost, ready = shards[i], [], [], None
                if kind[i] == 0:
                    grams.append(part.column("gram").to_numpy())
                    cost.append(part.column("cost").to_numpy())
                    continue
                if ready is None:
                    g, c = np.concatenate(grams), np.concatenate(cost)
                    by = np.argsort(g)
                    ready = g[by].view("u8"), c[by]
                vals = [_pack(ready[1][np.searchsorted(ready[0], _unpack_sorted(k))].astype("<f4")) for k in part.column("keys").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("chunk"), part.column("shard"), part.column("keys"), pa.array(vals, pa.binary())], names=["chunk", "shard", "keys", "cost"])
        trim()

    left = costs.select("shard", F.lit(0).alias("kind"), "gram", "cost", F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("binary").alias("keys"))
    right = requests.select("shard", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("gram"), F.lit(None).cast("float").alias("cost"), "chunk", "keys")
    return arrow_map(left.union(right).repartition("shard").sortWithinPartitions("shard", "kind"), run, "chunk long, shard int, keys binary, cost binary")


def exclusion(gram: np.ndarray, seen: np.ndarray, of: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What leaving out the symbols of the long context adds to the log10 cost of each miss (``gram``; its symbols are
    those of ``seen`` where ``of`` has its number, ascending). ``grams`` (sorted) and ``counts`` are the training texts'.

    The cost of its gram was computed without; exclusion at order ORDER changes the total there, and the
    number of symbols that an escape is shared among, or leaves that order out if no symbol is left."""
    context = gram >> U8(8)
    low, high = np.searchsorted(grams, context << U8(8)), np.searchsorted(grams, (context << U8(8)) | U8(255), "right")
    sums = np.concatenate(([0], np.cumsum(counts)))
    total, kinds = (sums[high] - sums[low]).astype("f8"), (high - low).astype("f8")
    gone = np.bincount(of, minlength=len(gram))
    spent = np.bincount(of, counts[np.searchsorted(grams, (context[of] << U8(8)) | seen.astype("u8"))], len(gram))
    hit = grams[np.minimum(np.searchsorted(grams, gram), len(grams) - 1)] == gram
    less = total / np.maximum(total - spent, 1)
    return np.log10(np.where(hit, less, np.where(kinds > gone, less * np.maximum(kinds - gone, 1) / kinds, 2 * total / kinds)))


def _corrections(misses: DataFrame, grams: DataFrame, most: int = 500_000) -> DataFrame:
    """(chunk, shard, idx, more) of all misses, by ``exclusion``. Misses are dealt by their context's last two bytes; where
    more than ``most`` have the same, they are dealt over several tasks, each with the grams of those bytes."""
    pair = F.shiftright("gram", 8 * (ORDER - 1)).cast("int")
    told = misses.select(pair.alias("pair"), "gram", "chunk", "shard", "idx", "seen")
    many = told.groupBy("pair").agg(F.ceil(F.count("*") / most).cast("int").alias("k")).collect()  # at most 256 x 256 rows
    parts = misses.sparkSession.createDataFrame([(r["pair"], r["k"]) for r in many], "pair int, k int")
    left = (
        grams.where("n > 0").select(pair.alias("pair"), "gram", "n").join(F.broadcast(parts), "pair").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("pair", "part", F.lit(0).alias("kind"), "gram", "n", F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("int").alias("shard"), F.lit(None).cast("int").alias("idx"), F.lit(None).cast("array<int>").alias("seen"))
    )
    right = told.join(F.broadcast(parts), "pair").select("pair", F.pmod(F.xxhash64("chunk", "shard", "idx"), F.col("k")).cast("int"), F.lit(1), "gram", F.lit(None).cast("long"), "chunk", "shard", "idx", "seen")

    def run(batches):
        key, held, ready = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(c).to_numpy().astype("i8") for c in ("pair", "part", "kind")], axis=1)
            edges = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(1))))
            for i, j in zip(edges.tolist(), [*edges[1:].tolist(), b.num_rows]):
                part = b.slice(i, j - i)
                if tuple(k[i, :2]) != key:
                    key, held, ready = tuple(k[i, :2]), [], None
                if k[i, 2] == 0:
                    held.append((part.column("gram").to_numpy(), part.column("n").to_numpy()))
                    continue
                if ready is None:
                    g, n = (np.concatenate(x) for x in zip(*held))
                    by = np.argsort(g)
                    ready = g[by].view("u8"), n[by]
                seen = part.column("seen")
                more = exclusion(part.column("gram").to_numpy().view("u8"), seen.flatten().to_numpy(), np.repeat(np.arange(part.num_rows), pc.list_value_length(seen).to_numpy()), *ready)
                yield pa.RecordBatch.from_arrays([part.column("chunk"), part.column("shard"), part.column("idx"), pa.array(more)], names=["chunk", "shard", "idx", "more"])
        trim()

    dealt = left.union(right).repartition("pair", "part").sortWithinPartitions("pair", "part", "kind")
    return arrow_map(dealt, run, "chunk long, shard int, idx int, more double")


def _word_requests(table: DataFrame, shards: int) -> DataFrame:
    def make(c: Chunk):
        digest, of = c.words()
        n = np.bincount(of, c.per_token(~c.held_out), len(digest) + 1)[:-1].astype("<u4")
        shard = (digest >> U8(40)).astype("i8") % shards
        by = np.lexsort((digest, shard))
        for s, i, j in _edges(shard[by]):
            yield s, _pack_sorted(digest[by][i:j]), _pack(n[by][i:j])

    return _per_chunk(table, make, ["keys", "n"], "shard int, chunk long, keys binary, n binary")


def _word_answers(requests: DataFrame) -> DataFrame:
    """(chunk, shard, n) packed: the counts of a chunk's words in all training texts; and (tokens, types)."""

    def run(batches):
        for shard, (chunk, keys, n) in _by_shard(batches, ("chunk", "keys", "n")):
            keys = [_unpack_sorted(x) for x in keys]
            u, c = _summed(keys, [_unpack(x, "<u4") for x in n])
            m = len(chunk)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*chunk, None], pa.int64()), pa.array([shard] * (m + 1), pa.int32()), pa.array([*(_pack(c[np.searchsorted(u, k)]) for k in keys), None], pa.binary()),
                    pa.array([*([None] * m), int(c.sum())], pa.int64()), pa.array([*([None] * m), int((c > 0).sum())], pa.int64()),
                ],
                names=["chunk", "shard", "n", "tokens", "types"],
            )
        trim()

    return arrow_map(requests.repartition("shard").sortWithinPartitions("shard"), run, "chunk long, shard int, n binary, tokens long, types long")


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    table = cut(chunks(docs), "chunks")
    shards = max(8, -(-(table.agg(F.sum("bytes")).first()[0] or 0) // SHARD_BYTES))
    words = cut(_word_answers(_word_requests(table, shards)), "words")
    total = words.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    texts = table.select(F.explode("doc_ids").alias("doc_id")).where(~F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False)))
    n_train = texts.count()
    n_all, v_all = int(total[0]) + n_train, int(total[1]) + (n_train > 0)
    long = cut(_long_answers(_long_requests(table, shards)), "long")
    asked = cut(_gram_requests(table, shards), "gram-requests")
    grams = cut(_gram_sums(asked), "grams")
    pairs = np.zeros((256, 256), "i8")
    low = grams.groupBy(F.shiftright("gram", 8 * ORDER).cast("int").alias("a"), F.col("gram").bitwiseAND(255).cast("int").alias("b")).agg(F.sum("n").alias("n"))
    for r in low.collect():  # at most 256 x 256 rows
        pairs[r["a"], r["b"]] = r["n"]
    short = cut(_gram_answers(_gram_costs(grams, pairs, shards), asked), "short")
    more = cut(_corrections(long.where("gram is not null"), grams), "exclusions")
    discard(asked, grams)
    none = lambda kind: F.lit(None).cast(kind)
    answers = (
        long.where("cost is not null").select("chunk", F.lit(0).alias("kind"), "shard", F.col("cost").alias("a"), F.col("depth").alias("b"), none("int").alias("idx"), none("double").alias("more"))
        .union(short.select("chunk", F.lit(1), "shard", "cost", "keys", none("int"), none("double")))
        .union(words.where("chunk is not null").select("chunk", F.lit(2), "shard", "n", none("binary"), none("int"), none("double")))
        .union(more.select("chunk", F.lit(3), "shard", none("binary"), none("binary"), "idx", "more"))
    )
    base_of = lambda c: np.log10((c + 0.5) / (n_all + 0.5 * (v_all + 1)))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        c = Chunk(*(left.column(k)[0].as_py() for k in CHUNK_COLUMNS))
        kind, shard = right.column("kind").to_numpy(), right.column("shard").to_numpy()

        def blobs(k: int, column: str, read) -> np.ndarray:
            at = np.flatnonzero(kind == k)
            at = at[np.argsort(shard[at])]
            return np.concatenate([np.empty(0, "u1"), *(read(x) for x in right.column(column).take(pa.array(at)).to_pylist())])

        # tokens by long contexts
        item_shard, _, _, item = c.long_items(shards)
        cost, depth = blobs(0, "a", lambda x: _unpack(x, "<f4")).astype("f8"), blobs(0, "b", lambda x: _unpack(x, "u1"))
        miss = np.flatnonzero(kind == 3)
        first = np.searchsorted(item_shard, shard[miss])
        np.add.at(cost, first + right.column("idx").take(pa.array(miss)).to_numpy(), right.column("more").take(pa.array(miss)).to_numpy())
        token_at = np.cumsum(c.sizes) - c.sizes
        result = np.add.reduceat(cost[item], token_at)
        # the other bytes by short ones
        need = c.base_places(depth[item])
        item = item_shard = None
        grams, price = blobs(1, "b", _unpack_sorted), blobs(1, "a", lambda x: _unpack(x, "<f4"))
        by = np.argsort(grams)
        grams, price = grams[by], price[by].astype("f8")
        for i, j in c.parts():
            g = pc.dictionary_encode(pa.array(c.grams(i, j)[need[i:j]]))
            of = np.zeros(j - i)
            if len(g.dictionary):
                of[need[i:j]] = price[np.searchsorted(grams, g.dictionary.to_numpy())][g.indices.to_numpy()]
            first, last = np.searchsorted(c.doc_at, [i, j - 1], "right") - 1
            result[first : last + 1] += np.add.reduceat(of, np.maximum(c.doc_at[first : last + 1] - i, 0))
        # words; the last number is the end of a text
        digest, of = c.words()
        n = np.empty(len(digest) + 1)
        n[np.lexsort((digest, (digest >> U8(40)).astype("i8") % shards))] = blobs(2, "a", lambda x: _unpack(x, "<i8"))
        n[-1] = n_train
        add = lambda x: np.add.reduceat(x[of].astype("f8"), token_at)
        out = pa.table(
            [
                pa.array(c.doc_ids, pa.int64()), pa.array(c.held_out), pa.array(c.sizes), pa.array(add(n > 0).astype("i8")), pa.array(np.full(c.docs, n_all, "i8")),
                pa.array(add(base_of(n))), pa.array(result),
            ],
            schema=schema,
        )
        c = None
        trim()
        return out

    return table.select("chunk", *CHUNK_COLUMNS).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
