"""Exact deduplication by content-defined chunk recipes.

A text is lower-cased (A-Z only), cut into chunks where a rolling gear hash of its last 16 bytes has
zero low bits, and turned into its *recipe*: the ordered list of its chunks' identifiers. Chunks move
once, compressed, to be deduplicated: an identifier is the chunk's SHA-256 prefix, and all chunks with
the same prefix are compared by content. Where they differ, the recipes of the documents that hold such a chunk get
the SHA-256 of the whole text as a suffix, so equal recipes mean equal texts. Documents are then equal
when their recipes are; from there on only recipes and ids move, not texts.

Defined cases: a null text counts as empty, and all empty texts are equal; of repeated rows (same
doc_id, same text) exactly one stays; null doc_ids stay only if the group has no other id; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UID, arrow_map, cut, slices

#: chunk lengths in bytes: cuts come at every 4,096th byte on average, within these bounds
LEAST, MASK_BITS, MOST = 1024, 12, 65536
ID_BYTES = 16
WINDOW = 16
PLAIN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _gear() -> np.ndarray:
    return np.array([int.from_bytes(hashlib.sha256(b"gear%d" % i).digest()[:4], "little") for i in range(256)], "u4")


GEAR = _gear()


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; they depend on nearby content only, so that an insertion
    moves the cuts around it and no others."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = GEAR[np.frombuffer(data, "u1")]
    for shift in (1, 2, 4, 8):  # after these, h[i] = sum of GEAR[data[i - j]] << j over j < WINDOW
        h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift))
    # a byte reaches the bits from its own shift up, so all of the window reaches bits 15 and higher
    hits = np.flatnonzero((h >> np.uint32(WINDOW)) & np.uint32((1 << MASK_BITS) - 1) == 0) + 1
    ends, last = [], 0
    for x in hits.tolist():
        while x - last > MOST:
            last += MOST
            ends.append(last)
        if x - last >= LEAST and x < n:
            ends.append(x)
            last = x
    while n - last > MOST:
        last += MOST
        ends.append(last)
    ends.append(n)
    return ends


def _parts(docs: DataFrame) -> DataFrame:
    """One pass over the texts. A row per document (doc_id, sha, recipe), and a row per chunk that
    its batch had not yet (id, blob: the chunk compressed, which is equal exactly for equal chunks)."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1, write_checksum=False)
        for b in batches:
            for s in slices(b, "text"):
                sha, recipe, seen = [], [], {}
                for t in s.column("text").to_pylist():
                    data = (t or "").encode("utf-8", "surrogatepass").lower()
                    whole = hashlib.sha256(data)
                    sha.append(whole.hexdigest())
                    ends = cut_points(data)
                    ids = []
                    for i, j in zip([0, *ends], ends):
                        chunk = data[i:j]
                        k = (whole if len(ends) == 1 else hashlib.sha256(chunk)).digest()[:ID_BYTES]
                        ids.append(k)
                        if k not in seen:
                            seen[k] = chunk
                        elif seen[k] != chunk:  # a collision within the slice: sent too, to be told apart
                            seen[k + chunk] = chunk
                    recipe.append(b"".join(ids))
                n, m = s.num_rows, len(seen)
                null = lambda size, kind: pa.nulls(size, kind)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([s.column("uid"), null(m, pa.int64())]), pa.concat_arrays([s.column("doc_id"), null(m, pa.int64())]),
                        pa.concat_arrays([pa.array(sha, pa.string()), null(m, pa.string())]), pa.concat_arrays([pa.array(recipe, pa.binary()), null(m, pa.binary())]),
                        pa.concat_arrays([null(n, pa.binary()), pa.array([k[:ID_BYTES] for k in seen], pa.binary())]),
                        pa.concat_arrays([null(n, pa.binary()), pa.array([packer.compress(x) for x in seen.values()], pa.binary())]),
                    ],
                    names=["uid", "doc_id", "sha", "recipe", "id", "blob"],
                )

    return arrow_map(docs, run, "uid long, doc_id long, sha string, recipe binary, id binary, blob binary")


def collided(chunks: DataFrame) -> DataFrame:
    """Identifiers (id) that stand for chunks of different content; none, but for a broken digest."""
    return chunks.groupBy("id").agg(F.min("blob").alias("lo"), F.max("blob").alias("hi")).where("lo <> hi").select("id")


def recipes(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, sha, recipe) of docs (uid, doc_id, text), recipes being of verified identifiers."""
    parts = cut(_parts(docs), "recipes")
    chunks = parts.where("id is not null").select("id", "blob")
    rows = parts.where("id is null").select("uid", "doc_id", "sha", "recipe")
    bad = cut(collided(chunks), "collided")
    if bad.isEmpty():
        return rows
    # documents with such a chunk are told apart by a digest of the whole text beside their recipe
    ids = F.expr(f"transform(sequence(1, length(recipe), {ID_BYTES}), i -> substring(recipe, i, {ID_BYTES}))")
    hit = rows.where(F.length("recipe") > 0).select("uid", F.explode(ids).alias("id")).join(bad, "id").select("uid").distinct().withColumn("hit", F.lit(True))
    return rows.join(hit, "uid", "left").select("uid", "doc_id", "sha", F.when(F.col("hit"), F.concat("recipe", F.unhex("sha"))).otherwise(F.col("recipe")).alias("recipe"))


def groups(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, sha, keep_id, keep_uid, group_size) for every row of docs (uid, doc_id, text).

    Sizes are summed before the shuffle; only groups of two or more are joined back, and a hot group
    is the one key of a plain sort-merge join that AQE splits."""
    rows = cut(recipes(docs), "rows")
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    many = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.max_by("uid", order).alias("keep_uid"), F.count("*").alias("group_size")).where("group_size > 1")
    many = cut(many, "groups")  # so that both sides of the join are shuffled, and AQE can split a hot group
    out = rows.join(many, "recipe", "left")
    return out.select("uid", "doc_id", "sha", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("keep_uid", "uid").alias("keep_uid"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))


def narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    g = groups(narrow(docs))
    return g.select("doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_largest(docs: DataFrame) -> DataFrame:
    """``docs`` (a table on disk) with one row, that of the largest doc_id, of each set of equal texts."""
    told = docs.withColumn(UID, F.monotonically_increasing_id())
    found = groups(told.select(F.col(UID).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    gone = found.where("uid <> keep_uid").select(F.col("uid").alias(UID))
    return told.join(gone, UID, "left_anti").select(*docs.columns)
