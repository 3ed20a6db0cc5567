"""Quality classifier: a factorisation machine.

Features of a text are hashed words (log term frequencies, scaled to length 1), structure statistics
(each as a soft one-hot over quarter-octave bins) and the metadata column n_chars, binned likewise.
The score is the sigmoid of bias + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j, and the pairwise sum is
computed in linear time as half of |sum x_i v_i|^2 - sum x_i^2 |v_i|^2. Labels, lang, source and doc_id are
never inputs of a score.

The machine is fitted on the driver on at most ``sample`` labelled rows outside of the held-out fold
(crc32 of the doc_id as text, mod 3, is 1): those with the smallest md5 of the id, which is a uniform
sample that does not depend on order or partitions. Only features of those rows come to the driver; words of one
hash are one feature, so a text of any length has (2^15 + bins) of them at most.
The fitted arrays have a fixed size (2^15 + bins) x (rank + 1), whatever the corpus.

Defined cases: null and empty texts get the score of a text without words; a null n_chars has a bin of
its own; labels that are null, or whose documents are missing, are ignored; with labels of one class or
none, every score is that class' share (0.5 without labels); repeated rows are scored each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, slices

WORDS = 1 << 15
BINS = 64
STATS = ("words", "word_bytes", "other_share", "upper_share", "digit_share", "bars", "shouts", "marks", "distinct", "top_share", "repeated_lines", "line_words", "stops", "commas", "short_words", "n_chars", "longest", "code", "ats", "spread", "repeats")
SIZE = WORDS + len(STATS) * BINS
RANK = 8
_cache: dict[bytes, int] = {}


def _bin(stat: int, value: float | None, ids: list[int], xs: list[float]) -> None:
    """Soft one-hot: bin 0 for none or zero, 63 for null, quarter octaves from 2^-10 to 2^5 between."""
    base = WORDS + stat * BINS
    if value is None:
        ids.append(base + BINS - 1)
        xs.append(1.0)
        return
    at = min(max(4 * math.log2(value) + 41, 1.0), 61.0) if value > 0 else 0.0
    low = int(at)
    part = at - low
    ids.append(base + low)
    xs.append(1.0 - part)
    if part:
        ids.append(base + low + 1)
        xs.append(part)


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    data = (text or "").encode("utf-8", "surrogatepass")
    w = data.split()
    n = max(1, len(w))
    h = np.bincount(np.frombuffer(data, "u1"), minlength=256).tolist()
    many = Counter(data.lower().split())
    upper, lower, wide = sum(h[65:91]), sum(h[97:123]), sum(h[128:])
    size = max(1, len(data))
    white = h[32] + sum(h[9:14])
    letters = max(1, upper + lower + wide)
    lines = [x for x in data.split(b"\n") if x.strip()]
    top = max(many.values(), default=0)
    count = lambda chars: sum(h[c] for c in chars)
    stats = (
        n / 1024, sum(map(len, w)) / n / 32, (size - white - letters) / size, upper / letters, count(b"0123456789") / size, h[124] / n, h[33] / n, count(b"#$%&*^~") / n,
        len(many) / n, top / n, 1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)) / 64, h[46] / n, h[44] / n, sum(len(x) <= 3 for x in w) / n,
        None if n_chars is None else max(0, n_chars) / 4096, max(map(len, w), default=0) / 64, count(b"<>{}=/;_") / n, h[64] / n, sum(1 for x in h if x) / 128, 1 - len(many) / n,
    )
    ids: list[int] = []
    xs: list[float] = []
    if many:
        if len(_cache) > 300_000:
            _cache.clear()
        held, crc = _cache, zlib.crc32
        for k in many:
            i = held.get(k)
            if i is None:
                i = held[k] = crc(k) & (WORDS - 1)
            ids.append(i)
        x = 1 + np.log(np.fromiter(many.values(), "f4", len(many)))
        xs += (x / np.sqrt((x * x).sum())).tolist()
    for k, v in enumerate(stats):
        _bin(k, v, ids, xs)
    # words of one hash are one feature, so they do not meet each other in the pair term, and a row has SIZE at most
    found, of = np.unique(np.array(ids, "i4"), return_inverse=True)
    return found, np.bincount(of, np.array(xs, "f4"), len(found)).astype("f4")


class Machine:
    """bias, w (SIZE), v (SIZE x RANK)."""

    def __init__(self, bias: float = 0.0, w: np.ndarray | None = None, v: np.ndarray | None = None) -> None:
        self.bias, self.w, self.v = bias, w, v

    def raw(self, ids: np.ndarray, x: np.ndarray) -> float:
        if self.w is None:
            return self.bias
        xv = self.v[ids] * x[:, None]
        return float(self.bias + self.w[ids] @ x + 0.5 * ((xv.sum(0) ** 2).sum() - (xv * xv).sum()))

    def score(self, ids: np.ndarray, x: np.ndarray) -> float:
        return 1 / (1 + math.exp(-min(max(self.raw(ids, x), -40), 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, batch: int = 32, seed: int = 5) -> Machine:
    """Logistic loss by mini-batches with per-coordinate (AdaGrad) steps."""
    share = sum(y for *_, y in rows) / len(rows) if rows else 0.5
    if share in (0, 1) or not rows:
        return Machine(40.0 if share == 1 else -40.0 if share == 0 and rows else 0.0)
    rng = np.random.default_rng(seed)
    w, v, bias = np.zeros(SIZE, "f4"), rng.normal(0, 0.02, (SIZE, RANK)).astype("f4"), math.log(share / (1 - share))
    gw, gv = np.full(SIZE, 1e-2, "f4"), np.full((SIZE, RANK), 1e-2, "f4")
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = [rows[i] for i in order[at : at + batch]]
            ids, x = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part])
            of = np.repeat(np.arange(len(part)), [len(p[0]) for p in part])
            starts = np.concatenate(([0], np.cumsum([len(p[0]) for p in part])[:-1]))
            xv = v[ids] * x[:, None]
            s = np.add.reduceat(xv, starts)
            z = bias + np.add.reduceat(w[ids] * x, starts) + 0.5 * ((s * s).sum(1) - np.add.reduceat((xv * xv).sum(1), starts))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - np.array([p[2] for p in part])).astype("f4")
            e = err[of] * x
            uniq, inv = np.unique(ids, return_inverse=True)
            dw = np.bincount(inv, e, len(uniq)).astype("f4") + 1e-4 * w[uniq]
            dv = np.zeros((len(uniq), RANK), "f4")
            np.add.at(dv, inv, e[:, None] * (s[of] - xv))
            dv += 1e-3 * v[uniq]
            gw[uniq] += dw * dw
            gv[uniq] += dv * dv
            w[uniq] -= 0.1 * dw / np.sqrt(gw[uniq])
            v[uniq] -= 0.03 * dv / np.sqrt(gv[uniq])
            bias -= 0.05 * float(err.mean())
    return Machine(bias, w, v)


def held_out(doc_id, folds: int = 3):
    """The fold that labels are never learned from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 1


def _inputs(docs: DataFrame) -> list:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return [F.col("text").cast("string").alias("text"), n_chars.alias("n_chars")]


def learn(docs: DataFrame, labels: DataFrame, sample: int = 4096) -> Machine:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    first = known.where(~held_out(F.col("doc_id"))).withColumn("h", F.md5(F.col("doc_id").cast("string").cast("binary"))).orderBy("h", "doc_id", "y").limit(sample)
    first = cut(first.select("doc_id", "y"), "labelled")  # at most `sample` rows, so it may be broadcast

    def run(batches):
        for b in batches:
            f = [features(t, n) for t, n in zip(b.column("text").to_pylist(), b.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array([i.tobytes() for i, _ in f], pa.binary()), pa.array([x.tobytes() for _, x in f], pa.binary())], names=["doc_id", "y", "i", "x"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_inputs(docs)).join(F.broadcast(first), "doc_id").select("doc_id", "y", "text", "n_chars")
    # an id may be repeated: equal rows count once, and the bound holds for rows as well
    digest = F.sha2(F.concat("i", "x"), 256)
    found = arrow_map(rows, run, "doc_id long, y int, i binary, x binary").groupBy("doc_id", "y", digest.alias("d")).agg(F.first("i").alias("i"), F.first("x").alias("x"))
    got = found.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id", "y", "d").limit(sample).collect()
    got.sort(key=lambda r: (r["doc_id"], r["y"], bytes(r["i"]), bytes(r["x"])))
    return fit([(np.frombuffer(r["i"], "i4"), np.frombuffer(r["x"], "f4"), r["y"]) for r in got])


def _scored(docs: DataFrame, machine: Machine, schema: str, make, large: str = "text", inputs=lambda s: (s.column("text"), s.column("n_chars"))) -> DataFrame:
    """What ``make`` returns for slices of docs (cut by the column ``large``) and their scores."""
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.w, machine.v))  # of fixed size

    def run(batches):
        m = Machine(*shared.value)
        for b in batches:
            for s in slices(b, large):
                got = [m.score(*features(t, n)) for t, n in zip(*(c.to_pylist() for c in inputs(s)))]
                yield make(s, got)

    return arrow_map(docs, run, schema)


def scores(docs: DataFrame, labels: DataFrame, sample: int = 4096) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    machine = learn(docs, labels, sample)

    def make(s, got):
        y = pa.array([int(x >= 0.5) for x in got], pa.int32())
        return pa.RecordBatch.from_arrays([s.column("doc_id"), s.column("held_out"), pa.array(got, pa.float64()), y], names=["doc_id", "held_out", "score", "predicted"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), *_inputs(docs))
    return _scored(narrow, machine, "doc_id long, held_out boolean, score double, predicted int", make)


def accepted(docs: DataFrame, labels: DataFrame, sample: int = 4096) -> DataFrame:
    """``docs`` without the documents whose score is under 0.5; all columns pass through unchanged."""
    machine = learn(docs, labels, sample)
    columns = docs.columns
    at = columns.index("text")
    told = docs.select(F.struct(*[(F.col(f"`{c}`").cast("string") if c == "text" else F.col(f"`{c}`")).alias(c) for c in columns]).alias("row"), _inputs(docs)[1])

    def make(s, got):
        return s.select(["row"]).filter(pa.array([x >= 0.5 for x in got], pa.bool_()))

    kept = _scored(told, machine, f"row {told.schema['row'].dataType.simpleString()}", make, "row", lambda s: (s.column("row").field(at), s.column("n_chars")))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in columns])
