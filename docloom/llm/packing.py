"""Sharding by vector bin packing.

Equal texts are a group, and its vector is (bytes, tokens, rows). A group that has over 1 / ``FINE`` of a
shard's share of any of the three is packed by itself; there are at most 3 * FINE * shards of them, whatever the
input. All smaller groups are dealt by hash into ``UNITS`` units, each packed as one. Units and groups are placed on the
driver, largest first, each into the shard whose residual capacity has the highest dot product with its
vector; then moves and exchanges level the bytes. A group stays whole unless it alone has more bytes than
an equal share: only then is it cut, by its rows, over as few shards as hold it.
The law is ``bytes``: shards' sizes are near equal; tokens and rows are balanced beside it.

Defined cases: a null text has no bytes, no tokens, CRC 0 and groups with empty ones; repeated rows
are placed each; an empty table gives an empty result; extra columns are ignored. A single document larger
than a shard stays whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, cut

UNITS = 4096
FINE = 64
#: slots are counted in parts of about this share of all rows, so no task counts a large group's alone
PARTS = 8192
#: weight of bytes, tokens and rows in the dot product; bytes carry the law
WEIGHT = np.array([1.0, 0.25, 0.25])


def pack(vectors: np.ndarray, shards: int, hot: np.ndarray | None = None) -> np.ndarray:
    """Shard of each unit (rows of ``vectors``). Pieces of hot groups (numbered in ``hot``, -1 for the rest) come first
    and fill one shard after another, the emptiest first. Others go by descending weight to the highest dot
    product with the residual capacity; ties go to the lower shard. Then single moves and swaps from the fullest to the
    emptiest shard while they lower the spread of the first component."""
    total = vectors.sum(0)
    unit = vectors / np.where(total > 0, total / shards, 1)  # in shards' capacities
    residual = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), "i4")
    hot = np.full(len(vectors), -1) if hot is None else hot
    for g in np.unique(hot[hot >= 0]).tolist():
        at = -1
        for i in np.flatnonzero(hot == g).tolist():
            if at < 0 or residual[at, 0] < unit[i, 0] / 2:
                at = int(residual[:, 0].argmax())
            out[i] = at
            residual[at] -= unit[i]
    for i in np.argsort(-(unit * WEIGHT).sum(1), kind="stable"):
        if hot[i] < 0:
            at = int(np.argmax(np.round(residual @ (unit[i] * WEIGHT), 12) if unit[i].any() else residual[:, -1]))
            out[i] = at
            residual[at] -= unit[i]
    load = np.bincount(out, vectors[:, 0], shards)
    _level(out, load, vectors[:, 0], hot < 0)
    if len(load) and load.max() - load.min() > vectors[:, 0].sum() / shards / FINE:  # parts of cut groups move only where the rest cannot level
        _level(out, load, vectors[:, 0], np.ones(len(out), bool))
    return out


def _level(out: np.ndarray, load: np.ndarray, size: np.ndarray, may: np.ndarray) -> None:
    """Moves and exchanges units that ``may`` move from the fullest shard to the emptiest while the gap shrinks."""
    for _ in range(20 * len(load)):
        hi, lo = int(load.argmax()), int(load.argmin())
        gap = load[hi] - load[lo]
        a, b = np.flatnonzero((out == hi) & may), np.flatnonzero((out == lo) & may)
        if gap <= 1 or not len(a):
            break
        va, vb = size[a], np.append(size[b], 0)  # 0: a move without return
        order = np.argsort(vb)
        # for each unit of the fullest shard, the partner whose exchange is nearest to half the gap
        want = va - gap / 2
        near = np.clip(np.searchsorted(vb[order], want), 0, len(vb) - 1)
        near = np.where((near > 0) & (np.abs(vb[order[near - 1]] - want) < np.abs(vb[order[near]] - want)), near - 1, near)
        shift = va - vb[order[near]]
        left = np.where((shift > 0) & (shift < gap), np.abs(gap - 2 * shift), gap)
        k = int(left.argmin())
        if left[k] >= gap:
            break
        other = int(order[near[k]])
        out[a[k]] = lo
        if other < len(b):
            out[b[other]] = hi
        load[hi] -= shift[k]
        load[lo] += shift[k]


def assign(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.regexp_count(text, F.lit(WORD_RE)).cast("long").alias("tokens"), F.xxhash64(text, F.lit("group")).alias("key"),
    )
    rows = cut(rows.withColumn("uid", F.monotonically_increasing_id()), "packing")
    names = ("size", "tokens", "rows")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*sums).first()
    share = [(total[c] or 0) / shards for c in names]
    over = " OR ".join(f"{c} > {x / FINE!r}" for c, x in zip(names, share))
    table = []  # (key, unit, parts of its slots, whether it is cut)
    for r in sorted(rows.groupBy("key").agg(*sums).where(over).collect(), key=lambda r: (-r["size"], r["key"])):  # at most 3 * FINE * shards
        is_hot = r["size"] > share[0] and r["rows"] > 1
        parts = max(-(-r["rows"] * PARTS // total["rows"]), int(np.ceil(FINE * r["size"] / share[0])) if is_hot else 1)
        table.append((r["key"], UNITS + len(table), min(r["rows"], parts), is_hot))
    large = spark.createDataFrame(table, "key long, unit int, k int, hot boolean")
    rows = rows.join(F.broadcast(large), "key", "left").select(
        "doc_id", "size", "text_crc32", "tokens", "uid", F.coalesce("unit", F.pmod("key", F.lit(UNITS)).cast("int")).alias("unit"),
        F.coalesce(F.pmod(F.xxhash64("doc_id", "uid"), F.col("k")).cast("int"), F.lit(0)).alias("part"),
    )
    parts = sorted((r["unit"], r["part"], r["size"], r["tokens"], r["rows"]) for r in rows.groupBy("unit", "part").agg(*sums).collect())  # bounded as the units are
    hot_units = {u for _, u, _, is_hot in table if is_hot}
    packed: dict[tuple[int, int], list] = {}  # what is placed: a unit, or a part of a hot one
    for u, p, *v in parts:
        of = packed.setdefault((u, p if u in hot_units else -1), [0, 0, 0])
        packed[u, p if u in hot_units else -1] = [a + b for a, b in zip(of, v)]
    vectors = np.array(list(packed.values()), "f8").reshape(-1, 3)
    hot = np.array([u if u in hot_units else -1 for u, _ in packed], "i8")
    shard = dict(zip(packed, pack(vectors, shards, hot).tolist())) if packed else {}
    begun, plan = [0] * shards, []
    for u, p, _, _, n in parts:
        s = shard[u, p if u in hot_units else -1]
        plan.append((u, p, s, begun[s]))
        begun[s] += n
    order = Window.partitionBy("unit", "part").orderBy(F.asc_nulls_first("doc_id"), "uid")
    placed = rows.select("doc_id", "size", "text_crc32", "unit", "part", F.row_number().over(order).alias("n"))
    return placed.join(F.broadcast(spark.createDataFrame(plan, "unit int, part int, shard int, begin long")), ["unit", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("begin") + F.col("n") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
