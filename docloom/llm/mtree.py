"""Exact top-k inner products by best-first search in M-trees.

Components become integers, floor(1024 * x). Largest inner products are nearest neighbours once every
vector is lifted by a coordinate sqrt(m^2 - |x|^2), m being the largest length of all, and the query by
0: then d(q, x)^2 = |q|^2 + m^2 - 2 q.x.

Vectors are dealt to the nearest of at most ``PIVOTS`` sampled pivots; such a shard is a page of the top level,
with its covering radius, and one over ``SHARD`` vectors is cut into pieces by hash, so that a hot vector is
no single task. Each piece is an M-tree: pages of routing objects with covering radii and distances to their
parents, and leaf pages of vectors with distances to theirs. A search takes the page with the least
possible distance first, skips children and vectors by the stored parent distances without computing
their own, and stops at the first page that cannot reach the k-th best. Queries of a piece are searched
together: a page is computed at once for those that need it. A query is searched in its own piece first; its k-th score
there is the bound with which it visits other shards, and only those whose covering radius lets them beat it.
Pieces are visited in groups of ``GROUP``: a query travels once to a group, with the pieces it needs as bits, and vectors
travel as the narrowest whole numbers that hold them.
Bounds have a margin for rounding; scores are exact integers.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part; vectors of
other lengths than the query's are no candidates; rows with the query's vec_id that are not its own row are
candidates, and a repeated query row is a query of its own; a null vec_id is no query and, as a candidate,
ties after all others; ties go to the smaller vec_id; an empty table gives an empty result; extra columns
are ignored. Components saturate at the range of a long; where products could pass 2^53 they are computed
in whole numbers without bounds, and scores saturate at the range of a long.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut

SHARD, PIVOTS = 8192, 4096
#: pieces that a task holds together, so that a query is sent to it once
GROUP = 16
#: shards of vectors whose length no pivot has
OTHERS = 64
LEAF, FANOUT = 64, 16
QUERY_BLOCK = 2048
LOWEST, LAST = -(1 << 63), (1 << 63) - 1


class MTree:
    """Over integer vectors x (n x d) with ids; ``m2`` is the square of the largest length of all. Pages are
    (leaf flag, rows (routing objects or vectors), parent distances, radii, children)."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, m2: float | None = None, seed: int = 11) -> None:
        self.whole, self.x, self.ids = x, x.astype("f8"), ids
        norms = (self.x * self.x).sum(1)
        self.m2 = float(norms.max(initial=0)) if m2 is None else m2
        self.lift = np.sqrt(np.maximum(self.m2 - norms, 0))
        self.rng = np.random.default_rng(seed)
        self.pages: list[tuple] = []
        self.top = float(np.abs(self.x).max(initial=0))
        self.root = self._build(np.arange(len(x)), None) if len(x) else None

    def _apart(self, rows: np.ndarray, pivot: int) -> np.ndarray:
        d = self.x[rows] - self.x[pivot]
        return np.sqrt((d * d).sum(1) + (self.lift[rows] - self.lift[pivot]) ** 2)

    def _build(self, rows: np.ndarray, parent: int | None) -> int:
        if len(rows) <= LEAF:
            far = self._apart(rows, parent) if parent is not None else np.zeros(len(rows))
            self.pages.append((True, rows, far, None, None))
            return len(self.pages) - 1
        pivots = self.rng.choice(rows, FANOUT, replace=False)
        apart = np.stack([self._apart(rows, p) for p in pivots])
        near = apart.argmin(0)
        if np.bincount(near, minlength=FANOUT).max() == len(rows):  # all alike: deal them out evenly
            near = np.arange(len(rows)) % FANOUT
        routing, radii, kids = [], [], []
        for k in np.unique(near):
            mine = near == k
            routing.append(pivots[k])
            radii.append(apart[k][mine].max())
            kids.append(self._build(rows[mine], pivots[k]))
        routing = np.array(routing)
        far = self._apart(routing, parent) if parent is not None else np.zeros(len(routing))
        self.pages.append((False, routing, far, np.array(radii), kids))
        return len(self.pages) - 1

    def search(self, q: np.ndarray, k: int, skip: np.ndarray | None = None, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For queries q (m x d): scores and rows (m x k) of the k highest inner products, ties to the smaller
        id; a row of -1 is none. ``skip`` is a row that a query leaves out (-1: none), ``floor`` a score under which
        it wants none."""
        m = len(q)
        score, row = np.full((m, k), LOWEST, "i8"), np.full((m, k), -1, "i8")
        skip = np.full(m, -1, "i8") if skip is None else skip
        floor = np.full(m, LOWEST, "i8") if floor is None else floor
        if self.root is None or not m:
            return score, row

        def merge(at: np.ndarray, rows: np.ndarray, dots: np.ndarray, use: np.ndarray) -> None:
            """Takes dots (queries at x rows) that are marked in ``use`` into the k best."""
            use = use & (rows[None, :] != skip[at][:, None]) & (dots >= np.maximum(score[at, -1], floor[at])[:, None])
            some = np.flatnonzero(use.any(1))
            if not len(some):
                return
            at, all_rows = at[some], np.concatenate((row[at[some]], np.where(use[some], rows[None, :], -1)), axis=1)
            all_scores = np.concatenate((score[at], dots[some]), axis=1)
            order = np.lexsort((self.ids[all_rows], np.invert(all_scores), all_rows < 0), axis=-1)[:, :k]
            row[at] = np.take_along_axis(all_rows, order, 1)
            score[at] = np.where(row[at] < 0, LOWEST, np.take_along_axis(all_scores, order, 1))

        if self.top * float(np.abs(q.astype("f8")).max(initial=0)) * max(1, q.shape[1]) >= 2**53:
            every = np.arange(len(self.x))
            for i in range(m):
                dots = np.array([[min(max(int(s), LOWEST), LAST) for s in self.whole.astype(object) @ q[i].astype(object)]], "i8").reshape(1, -1)
                merge(np.array([i]), every, dots, np.ones((1, len(every)), bool))
            return score, row
        q = q.astype("f8")
        base = (q * q).sum(1) + self.m2

        def reach(at: np.ndarray) -> np.ndarray:
            """The distance beyond which a query needs nothing."""
            least = np.maximum(score[at, -1], floor[at])
            d = np.sqrt(np.maximum(base[at] - 2 * least.astype("f8"), 0)) * (1 + 1e-9) + 1e-6
            return np.where(least == LOWEST, np.inf, d)

        todo = [(0.0, 0, self.root, np.arange(m), np.zeros(m), None)]
        pushed = 1
        while todo:
            _, _, page, at, bound, near = heapq.heappop(todo)
            limit = reach(at)
            some = bound <= limit
            if not some.any():
                continue
            at, limit = at[some], limit[some]
            leaf, rows, far, radii, kids = self.pages[page]
            if near is None:
                use, cols = np.ones((len(at), len(rows)), bool), np.arange(len(rows))
            else:
                use = np.abs(near[some][:, None] - far[None, :]) - (0 if leaf else radii[None, :]) <= limit[:, None]
                cols = np.flatnonzero(use.any(0))
                use = use[:, cols]
            if not len(cols):
                continue
            dots = q[at] @ self.x[rows[cols]].T
            if leaf:
                merge(at, rows[cols], dots.astype("i8"), use)
                continue
            d = np.sqrt(np.maximum(base[at][:, None] - 2 * dots, 0))
            low = np.maximum(d - radii[cols][None, :], 0)
            need = use & (low <= limit[:, None])
            for c in np.flatnonzero(need.any(0)).tolist():
                on = np.flatnonzero(need[:, c])
                heapq.heappush(todo, (float(low[on, c].min()), pushed, kids[cols[c]], at[on], low[on, c], d[on, c]))
                pushed += 1
        return score, row


def _matrix(column) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).reshape(len(a), -1) if len(a) else np.empty((0, 0), "i8")


def _packed(x: np.ndarray) -> pa.Array:
    """Rows as bytes, in the narrowest whole numbers that hold them all."""
    top = int(np.abs(x.astype("f8")).max(initial=0))
    raw = x.astype("<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8")
    n, size = len(raw), raw.shape[1] * raw.itemsize if raw.ndim == 2 else 0
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * size).astype("i4").tobytes()), pa.py_buffer(raw.tobytes())])


def _unpacked(column, d: int) -> np.ndarray:
    """Rows of d numbers each out of their bytes; rows of one width at once."""
    if not d:
        return np.empty((len(column), 0), "i8")
    rows = column.to_pylist()
    width = np.array([len(r) // d for r in rows])
    out = np.empty((len(rows), d), "i8")
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        out[at] = np.frombuffer(b"".join([rows[i] for i in at.tolist()]), f"<i{w}").reshape(-1, d)
    return out


def _by_length(table: pa.Table):
    """(dim, rows of that length) of a table."""
    dim = table.column("dim").to_numpy()
    for d in np.unique(dim).tolist():
        yield d, table.take(pa.array(np.flatnonzero(dim == d)))


def _ids(table: pa.Table) -> np.ndarray:
    return np.array([LAST if i is None else i for i in table.column("vec_id").to_pylist()], "i8")


class _Pivots:
    """Pivots by length of vector; ``m2`` as in MTree."""

    def __init__(self, rows: list, m2: float) -> None:
        self.m2, self.of = m2, {}
        for d in {len(r) for r in rows}:
            mine = [i for i, r in enumerate(rows) if len(r) == d]
            x = np.array([rows[i] for i in mine], "f8").reshape(len(mine), d)
            self.of[d] = np.array(mine), x, np.sqrt(np.maximum(m2 - (x * x).sum(1), 0))

    def apart(self, d: int, x: np.ndarray, lifted: bool) -> np.ndarray:
        """Distances of vectors (lifted, or queries) to the pivots of length d."""
        x = x.astype("f8")
        _, p, lift = self.of[d]
        norm = (x * x).sum(1)
        own = np.sqrt(np.maximum(self.m2 - norm, 0)) if lifted else np.zeros(len(x))
        full = norm + own * own
        return np.sqrt(np.maximum(full[:, None] + self.m2 - 2 * (x @ p.T + own[:, None] * lift[None, :]), 0))


def _assigned(rows: DataFrame, pivots: _Pivots) -> DataFrame:
    """rows with shard (number of the nearest pivot, or one for lengths without) and far, the distance to it."""

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            for d, part in _by_length(t):
                if d in pivots.of:
                    shard, far = [], []
                    x = _matrix(part.column("v"))
                    for i in range(0, len(x), 1024):
                        apart = pivots.apart(d, x[i : i + 1024], True)
                        near = apart.argmin(1)
                        shard.append(pivots.of[d][0][near])
                        far.append(apart[np.arange(len(near)), near])
                    shard, far = np.concatenate(shard), np.concatenate(far)
                else:
                    shard, far = np.full(part.num_rows, PIVOTS + d % OTHERS), np.full(part.num_rows, np.inf)
                part = part.set_column(part.column_names.index("v"), "v", _packed(_matrix(part.column("v"))))
                part = part.append_column("shard", pa.array(shard, pa.int32())).append_column("far", pa.array(far, pa.float64()))
                yield from part.combine_chunks().to_batches()

    return arrow_map(rows, run, "uid long, vec_id long, dim int, v binary, shard int, far double")


def _pieces(batches, columns: tuple[str, ...]):
    """(columns.., table) of a partition sorted by those: vectors (kind 0, where kind is the last) of a key whole,
    queries (kind 1) as they come, in blocks."""
    held, key = [], None

    def out():
        t = pa.Table.from_batches(held)
        return (*key, t)

    for b in batches:
        if not b.num_rows:
            continue
        ks = np.stack([b.column(c).to_numpy() for c in columns], axis=1)
        edges = np.flatnonzero(np.concatenate(([True], (ks[1:] != ks[:-1]).any(1))))
        for i, j in zip(edges.tolist(), [*edges[1:].tolist(), b.num_rows]):
            k = tuple(ks[i].tolist())
            if held and (k != key or (len(columns) > 1 and key[-1] == 1 and sum(x.num_rows for x in held) >= QUERY_BLOCK)):
                yield out()
                held = []
            key = k
            held.append(b.slice(i, j - i))
    if held:
        yield out()


HITS = "q_uid long, query_id long, vec_id long, score long"


def _hits(q_uid, q_id, ids, score, row) -> pa.RecordBatch:
    at, col = np.nonzero(row >= 0)
    found = ids[row[at, col]]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(q_uid)[at], pa.int64()), pa.array(np.asarray(q_id)[at], pa.int64()), pa.array(found, pa.int64(), mask=found == LAST), pa.array(score[at, col], pa.int64())], names=["q_uid", "query_id", "vec_id", "score"]
    )


def _home(dealt: DataFrame, k: int, every: int, m2: float) -> DataFrame:
    """Every query's best in its own piece."""

    def run(batches):
        for *_, table in _pieces(batches, ("number",)):
            for d, part in _by_length(table):
                ids = _ids(part)
                known = part.column("vec_id").is_valid().to_numpy()
                mine = np.flatnonzero(known & (ids % every == 0))
                if not len(mine):
                    continue
                x = _unpacked(part.column("v"), d)
                tree = MTree(x, ids, m2)
                uid = part.column("uid").to_numpy()
                for i in range(0, len(mine), QUERY_BLOCK):
                    at = mine[i : i + QUERY_BLOCK]
                    yield _hits(uid[at], ids[at], ids, *tree.search(x[at], k, at))

    return arrow_map(dealt, run, HITS)


def _visits(queries: DataFrame, pivots: _Pivots, shards: dict[int, tuple[int, float, int]]) -> DataFrame:
    """(grp, uid, vec_id, dim, v, floor, slots): a query once for each group of pieces in which any may hold one of its
    k best; those pieces are the bits of ``slots``. ``shards``: pieces, covering radius, number of the first piece."""

    def run(batches):
        for b in batches:
            for d, part in _by_length(pa.Table.from_batches([b])):
                x, floor = _unpacked(part.column("v"), d), part.column("floor").to_numpy()
                f = x.astype("f8")
                reach = np.sqrt(np.maximum((f * f).sum(1) + pivots.m2 - 2 * floor.astype("f8"), 0)) * (1 + 1e-9) + 1e-6
                reach[floor == LOWEST] = np.inf
                own = part.column("number").to_numpy()
                if d in pivots.of:
                    numbers = pivots.of[d][0]
                    low = pivots.apart(d, x, False) - np.array([shards.get(s, (0, -np.inf))[1] for s in numbers.tolist()])[None, :]
                    # distances are rounded: a margin of what the squares can lose
                    need = low <= reach[:, None] + 1e-6 * (1 + np.sqrt(pivots.m2))
                else:
                    numbers, need = np.array([PIVOTS + d % OTHERS]), np.ones((len(x), 1), bool)
                slots: dict[int, np.ndarray] = {}
                for c, s in enumerate(numbers.tolist()):
                    pieces, _, first = shards.get(s, (0, 0.0, 0))
                    for p in range(first, first + pieces):
                        bits = slots.setdefault(p // GROUP, np.zeros(len(x), "i8"))
                        bits |= (need[:, c] & (own != p)).astype("i8") << (p % GROUP)
                for g, bits in slots.items():
                    at = np.flatnonzero(bits)
                    if len(at):
                        t = part.select(["uid", "vec_id", "dim", "v", "floor"]).take(pa.array(at))
                        t = t.append_column("grp", pa.array(np.full(len(at), g, "i4"))).append_column("slots", pa.array(bits[at]))
                        yield from t.combine_chunks().to_batches()

    return arrow_map(queries, run, "uid long, vec_id long, dim int, v binary, floor long, grp int, slots long")


def _abroad(dealt: DataFrame, visits: DataFrame, k: int, m2: float) -> DataFrame:
    """What queries find in other pieces. A group's vectors are held as bytes and a piece's tree is built once; queries
    stream by in blocks, and what a block found in one piece is its bound in the next."""

    def run(batches):
        key, held, trees = None, {}, {}
        for group, kind, table in _pieces(batches, ("grp", "kind")):
            if kind == 0:
                key, held, trees = group, {}, {}
                slot = table.column("slots").to_numpy()
                for i in np.unique(slot).tolist():
                    held[i] = dict(_by_length(table.take(pa.array(np.flatnonzero(slot == i)))))
                continue
            if key != group:
                continue
            for d, part in _by_length(table):
                q, floor, bits = _unpacked(part.column("v"), d), part.column("floor").to_numpy().copy(), part.column("slots").to_numpy()
                uid, ids = part.column("uid").to_numpy(), part.column("vec_id").to_numpy()
                for i in [i for i in held if d in held[i]]:
                    at = np.flatnonzero(bits >> i & 1)
                    if not len(at):
                        continue
                    if (i, d) not in trees:
                        trees[i, d] = MTree(_unpacked(held[i][d].column("v"), d), _ids(held[i][d]), m2)
                    score, row = trees[i, d].search(q[at], k, floor=floor[at])
                    yield _hits(uid[at], ids[at], trees[i, d].ids, score, row)
                    full = row[:, -1] >= 0
                    floor[at[full]] = np.maximum(floor[at[full]], score[full, -1])

    columns = ("grp", "kind", "slots", "uid", "vec_id", "dim", "v", "floor")
    number = F.expr(f"cast(number div {GROUP} as int)"), F.expr(f"cast(number % {GROUP} as long)")
    left = dealt.select(number[0].alias("grp"), F.lit(0).alias("kind"), number[1].alias("slots"), "uid", "vec_id", "dim", "v", F.lit(None).cast("long").alias("floor"))
    both = left.union(visits.withColumn("kind", F.lit(1)).select(*columns))
    return arrow_map(both.repartition("grp").sortWithinPartitions("grp", "kind"), run, HITS)


def top_k(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query, a row whose vec_id is divisible by ``every``."""
    fine = "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024).cast("long"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(fine)
    rows = cut(rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.size("embedding").alias("dim"), scaled.alias("v")), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, m2 = rows.agg(F.count("*"), F.coalesce(F.max(square), F.lit(0.0))).first()
    # pivots: a sample of bounded size, those with the smallest digests, so the same for any partitioning
    n_pivots = min(PIVOTS, max(1, n // SHARD))
    sample = cut(rows.orderBy(F.md5(F.concat_ws(",", F.col("v").cast("array<string>")).cast("binary")), "vec_id").select("v").limit(n_pivots), "pivots").collect()
    pivots = _Pivots([r["v"] for r in sample], m2)
    placed = cut(_assigned(rows, pivots), "placed")
    # at most PIVOTS + OTHERS rows
    counted = sorted((r["shard"], int(r["k"]), r["radius"]) for r in placed.groupBy("shard").agg(F.ceil(F.count("*") / SHARD).alias("k"), F.max("far").alias("radius")).collect())
    first = np.append(0, np.cumsum([n for _, n, _ in counted])).tolist()
    sizes = {s: (n, radius, f) for (s, n, radius), f in zip(counted, first)}
    several = placed.sparkSession.createDataFrame([(s, n, f) for s, (n, _, f) in sizes.items()], "shard int, k int, first int")
    number = F.col("first") + F.pmod(F.xxhash64("uid"), F.col("k")).cast("int")
    dealt = placed.join(F.broadcast(several), "shard").select("uid", "vec_id", "dim", "v", number.alias("number"))
    home = cut(_home(dealt.repartition("number").sortWithinPartitions("number"), k, every, m2), "home")
    floor = home.groupBy(F.col("q_uid").alias("uid")).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(LOWEST)).alias("floor"))
    queries = dealt.where(f"vec_id % {every} = 0").join(floor, "uid", "left").withColumn("floor", F.coalesce("floor", F.lit(LOWEST).cast("long")))
    found = home.union(_abroad(dealt, _visits(queries, pivots, sizes), k, m2))
    order = Window.partitionBy("q_uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
    WITH v AS (SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    p AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score
          FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id)
    SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM p
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10"""
