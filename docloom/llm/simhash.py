"""SimHash near-duplicates, linked by BK-trees.

A fingerprint has 64 bits; bit i is 1 where more than half of a text's word-shingle hashes have it.
Distinct fingerprints are dealt into *shards* and every shard holds a BK-tree: a node's children are
keyed by their integer Hamming distance to it, and a search of radius r follows only the edges whose
key differs from the query's distance by r at most (triangle inequality).

Trees are not sent to every executor whole, since they grow with the corpus. Instead a shard's tree
goes only to the fingerprints that can match in it:

* ``component_ids`` (radius links, exact): 64 bits are cut into 6 blocks. Two fingerprints at 4 or
  fewer differing bits agree on at least 2 blocks, so the 15 pairs of blocks are the shard keys and
  each link meets in at least one shard. Beyond some 4 billion fingerprints it is 3 of 7 blocks, and so on,
  so that shards stay small.
* ``near_groups`` (similarity links): MinHash bands of the same shingles are the shard keys, the
  BK-tree gives the pairs of a shard, by a radius that no pair as similar can pass, and those it gives are verified
  on whole shingle sets.

A shard over ``piece`` fingerprints is cut into pieces, and each pair of pieces is a task of bounded
size. A shard returns a spanning forest of its links, never all pairs.

Defined cases: null and empty texts have no shingles and fingerprint 0; repeated rows keep their own
row; extra columns are ignored; an empty table gives an empty result; a null doc_id is grouped but
never is a component's id unless all of its ids are null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UID, arrow_map, components, cut, grouped_runs, slices

MASK = (1 << 64) - 1


class BKTree:
    """Integers under Hamming distance; children keyed by integer distance to the parent."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, key: int) -> int:
        """Adds a key and returns its node; an equal key keeps its first node."""
        if not self.keys:
            self.keys.append(key)
            self.children.append({})
            return 0
        at = 0
        while True:
            d = (self.keys[at] ^ key).bit_count()
            if d == 0:
                return at
            after = self.children[at].get(d)
            if after is None:
                self.children[at][d] = len(self.keys)
                self.keys.append(key)
                self.children.append({})
                return len(self.keys) - 1
            at = after

    def within(self, key: int, radius: int) -> list[int]:
        """Nodes at ``radius`` or nearer."""
        found, todo = [], [0] if self.keys else []
        while todo:
            at = todo.pop()
            d = (self.keys[at] ^ key).bit_count()
            if d <= radius:
                found.append(at)
            kids = self.children[at]
            if len(kids) <= 2 * radius + 1:
                todo += [c for e, c in kids.items() if -radius <= e - d <= radius]
            else:
                todo += [kids[e] for e in range(d - radius, d + radius + 1) if e in kids]
        return found

    def nearest(self, key: int, radius: int) -> int | None:
        """The nearest node at ``radius`` or nearer; the radius shrinks to the best one found."""
        best, limit, todo = None, radius, [0] if self.keys else []
        while todo:
            at = todo.pop()
            d = (self.keys[at] ^ key).bit_count()
            if d <= limit and (best is None or d < limit):
                best, limit = at, d
                if d == 0:
                    return best
            todo += [c for e, c in self.children[at].items() if -limit <= e - d <= limit]
        return best


def words(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lower-cased; bytes.split() cuts at x20 and x09-x0D."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(w: list[bytes], k: int) -> np.ndarray:
    """XXH64 (seed 42) of every k-word shingle, repeats included; of all words if fewer than k."""
    if not w:
        return np.empty(0, "u8")
    if len(w) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), 42)], "u8")
    joined = b" ".join(w)
    length = np.fromiter(map(len, w), "i8", len(w)) + 1
    start = np.concatenate(([0], np.cumsum(length)))
    a, b = start[: len(w) - k + 1].tolist(), (start[k:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[i:j], 42) for i, j in zip(a, b)), "u8", len(a))


def bit_counts(h: np.ndarray) -> np.ndarray:
    """In how many of the hashes each of the 64 bits is set."""
    count = np.zeros(64, "i8")
    for i in range(0, len(h), 1 << 16):
        part = np.ascontiguousarray(h[i : i + (1 << 16)])
        count += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return count


def _majority(count: np.ndarray, n: int) -> int:
    return int(np.packbits(count * 2 > n, bitorder="little").view("u8")[0])


def fingerprint(h: np.ndarray) -> int:
    """Bit i is 1 if set in over half of the hashes."""
    return _majority(bit_counts(h), len(h))


def _reach(count: np.ndarray, n: int, similarity: float) -> int:
    """At how many bits at most the fingerprint of a set of n hashes differs from that of any set with a Jaccard similarity
    of ``similarity`` or more. Such a set has at most n (1 - s) / s elements more or less, each of which moves a bit's majority by one."""
    apart = int(n * (1 - similarity) / similarity + 1e-6)
    ahead = count * 2 - n
    return int(np.count_nonzero(np.where(ahead > 0, ahead, 1 - ahead) <= apart))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp: the fingerprint as a signed long) for every row."""

    def run(batches):
        for b in batches:
            for s in slices(b, "text"):
                fp = [_signed(fingerprint(shingle_hashes(words(t), shingle))) for t in s.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(narrow, run, "doc_id long, fp long")


def _in_pieces(rows: DataFrame, piece: int) -> DataFrame:
    """rows (shard, node, fp) with pair: 0 for a shard of at most ``piece`` rows. A larger one is cut
    into k pieces by hash, and each row goes to the k - 1 pairs of pieces that hold its own."""
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > piece)
    k = F.expr(f"cast(ceil(n / {piece}) as int) + 1")
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("k")).cast("int")
    out = rows.join(sizes.select("shard", k.alias("k")), "shard", "left")
    whole = out.where("k is null").select("shard", F.lit(0).alias("pair"), "node", "fp")
    cut_up = (
        out.where("k is not null").withColumn("p", mine).withColumn("q", F.explode(F.expr("sequence(0, k - 1)"))).where("p <> q")
        .select("shard", (F.least("p", "q") * F.col("k") + F.greatest("p", "q")).alias("pair"), "node", "fp")
    )
    return whole.union(cut_up)


def _linked(rows: DataFrame, link, piece: int) -> DataFrame:
    """Edges (a, b) that ``link(nodes, fps)`` returns for each shard's rows."""

    def run(batches):
        for table, starts, ends in grouped_runs(batches, ["shard", "pair"]):
            node, fp = table.column("node").to_numpy(), table.column("fp").to_numpy()
            some = np.flatnonzero(ends - starts > 1)
            edges: list[tuple[int, int]] = []
            for i, j in zip(starts[some].tolist(), ends[some].tolist()):
                edges += link(node[i:j].tolist(), [x & MASK for x in fp[i:j].tolist()])
            a, b = zip(*edges) if edges else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = _in_pieces(rows, piece).repartition("shard", "pair").sortWithinPartitions("shard", "pair", "node")
    return arrow_map(dealt, run, "a long, b long")


def _forest(radius: int):
    """Links of a shard as a spanning forest: (member, its root) of every component found."""

    def link(nodes: list[int], fps: list[int]) -> list[tuple[int, int]]:
        if len(fps) == 2:
            return [(nodes[0], nodes[1])] if (fps[0] ^ fps[1]).bit_count() <= radius else []
        tree, up = BKTree(), list(range(len(fps)))

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for i, key in enumerate(fps):  # distinct keys, so node i of the tree is row i
            for j in tree.within(key, radius):
                up[root(i)] = root(j)
            tree.add(key)
        return [(nodes[i], nodes[r]) for i in range(len(fps)) if (r := root(i)) != i]

    return link


def block_keys(fp, blocks: int, chosen: int):
    """A shard key for every choice of ``chosen`` of ``blocks`` bit blocks of the column fp."""
    edge = [round(i * 64 / blocks) for i in range(blocks + 1)]
    keys = []
    for n, combo in enumerate(combinations(range(blocks), chosen)):
        key = F.lit(n).cast("long")
        for b in combo:
            width = edge[b + 1] - edge[b]
            part = F.shiftrightunsigned(fp, edge[b]).bitwiseAND((1 << width) - 1)
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return keys


def component_ids(docs: DataFrame, shingle: int = 4, radius: int = 4, piece: int = 2048, chosen: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row, exactly: fingerprints link at ``radius`` or
    fewer differing bits and component_id is the smallest doc_id that links reach. Shard keys are ``chosen`` of
    radius + chosen bit blocks: 2, and more where shards of random fingerprints would pass ``piece``."""
    rows = cut(fingerprints(docs, shingle), "fingerprints")
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    if chosen is None:
        n, chosen = distinct.count(), 2
        while n / 2 ** (64 * chosen // (radius + chosen)) > piece:
            chosen += 1
    # radius + chosen blocks: the differing bits spoil at most radius of them
    keys = block_keys(F.col("fp"), radius + chosen, chosen)
    dealt = distinct.select(F.explode(F.array(*keys)).alias("shard"), F.col("fp").alias("node"), "fp")
    roots = components(_linked(dealt, _forest(radius), piece))
    linked = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    least = (
        linked.join(distinct, linked.node == distinct.fp).groupBy("root").agg(F.min("least_id").alias("component_id"))
    )
    of = linked.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    every = distinct.join(of, "fp", "left").select("fp", F.coalesce("component_id", "least_id").alias("component_id"))
    every = cut(every, "components")  # so that both sides of the join are shuffled, and AQE can split a hot fingerprint
    return rows.join(every, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- similarity links -----------------------------------------------------------------------------

#: 15 bands of 4 MinHashes: a pair of Jaccard similarity 0.8 shares a band with probability 0.9996.
BANDS, BAND_ROWS = 15, 4
#: bytes of shingle sets that a piece of a shard holds; a single set may by itself hold more
PIECE_BYTES = 16 << 20


def _multipliers(n: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(b"minhash%d" % i) | 1 for i in range(n)], "u8")


def banded(docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(uid, doc_id, node, check, fp, reach, bands, size) of a text's distinct shingles: node and check, two digests of
    64 bits, stand for equal sets of their hashes, fp is the set's fingerprint, reach the radius that holds those of all sets at
    ``similarity``, size its number."""

    def run(batches):
        mult = _multipliers(BANDS * BAND_ROWS)
        for b in batches:
            for s in slices(b, "text"):
                node, check, fps, reach, bands, size = [], [], [], [], [], []
                for t in s.column("text").to_pylist():
                    h = shingle_hashes(words(t), shingle)
                    h = np.unique(h)
                    count = bit_counts(h)
                    least = np.full(len(mult), MASK, "u8")
                    for i in range(0, len(h), 4096):
                        least = np.minimum(least, (h[i : i + 4096, None] * mult).min(0))
                    parts = least.reshape(BANDS, BAND_ROWS)
                    fps.append(_signed(_majority(count, len(h))))
                    reach.append(_reach(count, len(h), similarity))
                    node.append(_signed(xxhash.xxh64_intdigest(h.tobytes())))
                    check.append(_signed(xxhash.xxh64_intdigest(h.tobytes(), 1)))
                    bands.append([_signed(xxhash.xxh64_intdigest(p.tobytes(), i)) for i, p in enumerate(parts)] if len(h) else [])
                    size.append(len(h))
                yield pa.RecordBatch.from_arrays(
                    [s.column("uid"), s.column("doc_id"), *(pa.array(x, pa.int64()) for x in (node, check, fps, reach)), pa.array(bands, pa.list_(pa.int64())), pa.array(size, pa.int64())],
                    names=["uid", "doc_id", "node", "check", "fp", "reach", "bands", "size"],
                )

    return arrow_map(docs, run, "uid long, doc_id long, node long, check long, fp long, reach long, bands array<long>, size long")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(node, set: the sorted distinct shingle hashes, 8 bytes each) of ``docs`` (node, text)."""

    def run(batches):
        for b in batches:
            for s in slices(b, "text"):
                sets = [np.unique(shingle_hashes(words(t), shingle)).tobytes() for t in s.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([s.column("node"), pa.array(sets, pa.binary())], names=["node", "set"])

    return arrow_map(docs, run, "node long, set binary")


def _verified(similarity: float):
    """Spanning forest of a shard's pairs with a Jaccard similarity of ``similarity`` or more. A row is compared with the rows
    that the BK-tree finds within its reach, the nearest first, and with no others; where the nearest leaves rows in other components, the
    rest are compared at once, by the owners of its shingles."""

    def link(nodes: list[int], fps: list[int], reach: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        tree, at, out = BKTree(), [], []
        size = np.fromiter(map(len, sets), "i8", len(sets))
        label = np.arange(len(sets))
        lookup = None

        def union(i: int, j: int) -> None:
            if label[i] != label[j]:
                out.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]

        for i, key in enumerate(fps):
            near = tree.nearest(key, reach[i])
            if near is not None:
                j = at[near][0]
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both / (size[i] + size[j] - both) >= similarity:
                    union(i, j)
                if i > 1 and (label[:i] != label[i]).any():
                    rows = np.array([x for n in tree.within(key, reach[i]) for x in at[n]])
                    rows = rows[label[rows] != label[i]]
                    if len(rows):
                        lookup = lookup or _Owners(sets)
                        both = lookup.shared(i)[rows]
                        for j in rows[both / (size[i] + size[rows] - both) >= similarity].tolist():
                            union(i, j)
            node = tree.add(key)
            if node == len(at):
                at.append([])
            at[node].append(i)
        return out

    return link


class _Owners:
    """For sets of a shard: how many elements a set shares with each set before it."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        size = np.fromiter(map(len, sets), "i8", len(sets))
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")  # equal hashes stand in the order of their sets
        self.owner = np.repeat(np.arange(len(sets)), size)[order]
        flat = flat[order]
        new = np.ones(len(flat), bool)
        new[1:] = flat[1:] != flat[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(flat)), 0))
        #: of every element: the first place of its hash and its own
        self.first, self.place = np.empty(len(flat), "i8"), np.empty(len(flat), "i8")
        self.first[order], self.place[order] = first, np.arange(len(flat))
        self.edge = np.concatenate(([0], np.cumsum(size)))

    def shared(self, i: int) -> np.ndarray:
        a, b = self.edge[i], self.edge[i + 1]
        first, n = self.first[a:b], self.place[a:b] - self.first[a:b]
        start = np.repeat(first - np.cumsum(n) + n, n)
        return np.bincount(self.owner[start + np.arange(len(start))], minlength=i)


def _shared_shards(first: DataFrame, piece: int) -> DataFrame:
    """(shard, pair, node, fp, reach) of the bands that two or more nodes share. Of shards with the same nodes
    one is kept. One over ``piece`` rows or PIECE_BYTES is cut into k pieces by hash, and each row goes
    to the k - 1 pairs of pieces that hold its own."""
    dealt = first.select(F.explode("bands").alias("shard"), "node", "fp", "reach", "size")
    shards = dealt.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    shards = shards.where("n > 1").groupBy("n", "size", "x", "y").agg(F.min("shard").alias("shard"))
    k = F.expr(f"cast(greatest(ceil(n / {piece}), ceil(size * 8 / {PIECE_BYTES})) as int)")
    shards = shards.select("shard", F.when(k > 1, k + 1).alias("k"))
    out = dealt.join(shards, "shard")
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("k")).cast("int")
    whole = out.where("k is null").select("shard", F.lit(0).alias("pair"), "node", "fp", "reach")
    cut_up = (
        out.where("k is not null").withColumn("p", mine).withColumn("q", F.explode(F.expr("sequence(0, k - 1)"))).where("p <> q")
        .select("shard", (F.least("p", "q") * F.col("k") + F.greatest("p", "q")).alias("pair"), "node", "fp", "reach")
    )
    return whole.union(cut_up)


def near_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, piece: int = 2048) -> DataFrame:
    """(uid, doc_id, group_uid) of every row of ``docs`` (uid, doc_id, text; a table on disk): group_uid
    is the uid of the row with the smallest doc_id in the row's group. Links are pairs that share a band
    and have a Jaccard similarity of ``similarity`` or more, by their whole shingle sets. A text without
    words is alone unless repeated."""
    narrow = docs.select("uid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = cut(banded(narrow, shingle, similarity), "banded")
    # equal sets are one node, known by the uid of its first row
    sets_of = ["node", "check"]
    nodes = rows.groupBy(*sets_of).agg(F.min_by("uid", F.coalesce("doc_id", F.lit(MASK >> 1))).alias("uid"), F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    first = cut(rows.join(nodes.select("uid"), "uid", "left_semi").select(F.col("uid").alias("node"), "fp", "reach", "bands", "size"), "distinct-banded")
    dealt = cut(_shared_shards(first, piece), "shared-shards")
    needed = dealt.select("node").distinct()
    sets = cut(shingle_sets(narrow.select(F.col("uid").alias("node"), "text").join(needed, "node", "left_semi"), shingle), "shingle-sets")
    link = _verified(similarity)

    def verify(batches):
        for table, starts, ends in grouped_runs(batches, ["shard", "pair"]):
            node, fp, reach, held = *(table.column(n).to_numpy() for n in ("node", "fp", "reach")), table.column("set")
            some = np.flatnonzero(ends - starts > 1)
            edges: list[tuple[int, int]] = []
            for i, j in zip(starts[some].tolist(), ends[some].tolist()):
                found = [np.frombuffer(x.as_buffer(), "<u8") for x in held.slice(i, j - i)]
                edges += link(node[i:j].tolist(), [x & MASK for x in fp[i:j].tolist()], reach[i:j].tolist(), found)
            a, b = zip(*edges) if edges else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    told = dealt.join(sets, "node").select("shard", "pair", "node", "fp", "reach", "set")
    links = arrow_map(told.repartition("shard", "pair").sortWithinPartitions("shard", "pair", "node"), verify, "a long, b long")
    roots = components(links)
    every = nodes.join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    every = cut(every, "groups")
    best = every.groupBy("root").agg(F.min_by("uid", F.coalesce("doc_id", F.lit(MASK >> 1))).alias("group_uid"), F.sum("n").alias("n"))
    many = every.select("root", *sets_of).join(best.where("n > 1"), "root").select(*sets_of, "group_uid")
    return rows.select("uid", "doc_id", *sets_of).join(many, sets_of, "left").select("uid", "doc_id", F.coalesce("group_uid", "uid").alias("group_uid"))


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` (a table on disk) with one document of each near-duplicate group: the smallest doc_id."""
    told = docs.withColumn(UID, F.monotonically_increasing_id())
    found = near_groups(told.select(F.col(UID).alias("uid"), "doc_id", "text"), shingle, similarity)
    gone = found.where("uid <> group_uid").select(F.col("uid").alias(UID))
    return told.join(gone, UID, "left_anti").select(*docs.columns)
