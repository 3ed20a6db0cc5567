"""Alignment of two tokenizers' tokens over the bytes of whole texts.

Both tokenizers encode " " + text (the second adds the space itself). Every byte of that string gets a
label: no token ends there, one of A ends, one of B ends, or both. A regular expression scans the label
string for the spans up to each "both"; a span's labels, counted, say how many tokens of A and of B make
up one group. Links are all pairs of an A and a B token of one group, by ids; the count of a pair of ids
is the number of documents of the corpus in which it is linked.

Work is done for chunks of about ``CHUNK`` bytes of text. Neither tokenizer ever joins a space to the
character before it (checked of the two files; otherwise texts are encoded whole), so a text is cut
before spaces into segments, both tokenizers end a token at every segment's end, and each distinct
segment of a chunk is encoded and scanned once. A chunk asks for each of its distinct pairs once: counts
are summed over chunks by a shuffle, joined back to the chunks that asked, and a chunk's answers meet its
documents again in one cogroup. No document's pairs are exploded into rows, and nothing is broadcast.

Defined cases: a text that is null or empty, or that either tokenizer's tokens do not spell (a text with
U+2581, say), has no tokens: zeros and ''. Repeated rows are documents of their own, also for the counts.
Extra columns are ignored; an empty table gives an empty result. A group of very many tokens is linked
through its distinct ids with their multiplicities.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, chunks, cut, ship, slices, trim

#: bytes of text to a chunk, and of joined segments to one call of a tokenizer
CHUNK, BLOCK = 4 << 20, 32 << 10
#: segments of documents whose pairs are told apart at once
AT_ONCE = 200_000
#: pairs of tokens of a group beyond which its distinct ids are paired
MANY = 1 << 16

#: a space after a visible ASCII or Latin character, but not at the text's end: tokens never cross into it
CUT_RE = re.compile(r"(?<=[!-~À-ɏ]) (?!\Z)")
#: what keeps str.split from giving the same parts
UNLIKE_RE = re.compile(r"[^!-~À-ɏ] | \Z|\A ")
END_RE = re.compile(r"[!-~À-ɏ]\Z")
#: labels: no end, A ends, B ends, both end
NONE, A_END, B_END, BOTH = b".", b"A", b"B", b"="
GROUP_RE = re.compile(rb"[.AB]*=")
LABELS = np.frombuffer(NONE + A_END + B_END + BOTH, "u1")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 bytes stand for
    themselves, the others for the letters from U+0100 up, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counts(dict):
    """Label counts (A tokens, B tokens) of a span, remembered; spans are short and few kinds."""

    def __missing__(self, span: bytes) -> tuple[int, int]:
        found = (span.count(A_END) + 1, span.count(B_END) + 1)
        if len(span) < 64 and len(self) < 100_000:
            self[span] = found
        return found


@dataclass
class Scan:
    """Tokens, groups and pairs of segments laid end to end; all arrays but ``a`` and ``b`` have a value a
    segment, or are offsets of segments into what follows them."""

    a: np.ndarray  # ids
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    text: list[bytes]  # each group as "a1,a2|b1;"
    pair_at: np.ndarray  # offsets of a segment's pairs
    pair: np.ndarray
    times: np.ndarray


class Aligner:
    """Two tokenizer files, and the scan of texts that both encode."""

    _by_path: dict[tuple[str, str], "Aligner"] = {}

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece as spm
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(a_path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tok.no_padding()
        self.tok.no_truncation()
        self.sp = spm.SentencePieceProcessor(model_file=b_path)
        spec, letter = json.loads(self.tok.to_str()), byte_letters()
        names = {i: t for t, i in self.tok.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(letter[c] for c in names.get(i, "") if c in letter) for i in range(max(names) + 1)]
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], "i8") for t in (self.a_bytes, self.b_bytes))
        # ids as decimal text, followed by what may stand after one
        said = lambda n, marks: np.array([f"{i}{m}".encode() for m in marks for i in range(n)])
        self.a_text, self.b_text = said(len(self.a_bytes), ",|"), said(len(self.b_bytes), ",;")
        if self.a_text.itemsize > self.b_text.itemsize:
            self.b_text = self.b_text.astype(self.a_text.dtype)
        pre = spec.get("pre_tokenizer") or {}
        self.by_segment = (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not any(re.search("[^▁]▁", p) for p in pieces)
        )
        self.counts = Counts()

    @classmethod
    def of(cls, a_path: str, b_path: str) -> "Aligner":
        """One for each worker process and pair of files."""
        if (a_path, b_path) not in cls._by_path:
            cls._by_path[a_path, b_path] = cls(a_path, b_path)
        return cls._by_path[a_path, b_path]

    def segments(self, text: str) -> list[str]:
        """The text without the spaces that it is cut at: each part stands for itself after a space."""
        if not self.by_segment:
            return [text]
        return CUT_RE.split(text) if UNLIKE_RE.search(text) else text.split(" ")

    def _encoded(self, blocks: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B for each block after a space; None where either's bytes are not the block's. The
        libraries are given a few blocks at a time: what they return is many times the size of the ids."""
        for i in range(0, len(blocks), 8):
            few = blocks[i : i + 8]
            for block, a, b in zip(few, self.tok.encode_batch_fast([" " + x for x in few], add_special_tokens=False), self.sp.encode(few, num_threads=1)):
                data = b" " + block.encode()
                same = b"".join(map(self.a_bytes.__getitem__, a.ids)) == data and b"".join(map(self.b_bytes.__getitem__, b)) == data
                yield (np.array(a.ids, "i8"), np.array(b, "i8")) if same else None

    def scan(self, parts: list[str]) -> tuple[Scan, np.ndarray]:
        """The scan of all parts, and which of them both tokenizers spell; the others are empty in it."""
        order, blocks, members, block, size = [], [], [], [], 0
        for i, p in enumerate(parts):
            if not self.by_segment or not END_RE.search(p):  # what follows could change its tokens
                blocks.append(p)
                members.append([i])
                continue
            block.append(i)
            size += len(p) + 1
            if size > BLOCK:
                blocks.append(" ".join([parts[k] for k in block]))
                members.append(block)
                block, size = [], 0
        if block:
            blocks.append(" ".join([parts[k] for k in block]))
            members.append(block)
        good = np.ones(len(parts), bool)
        a_ids, b_ids, lengths = [], [], []
        for m, text, found in zip(members, blocks, self._encoded(blocks)):
            singly = [(m, text, found)]
            if found is None and len(m) > 1:
                singly = [([k], parts[k], f) for k, f in zip(m, self._encoded([parts[k] for k in m]))]
            for ks, t, f in singly:
                if f is None:
                    good[ks] = False
                    continue
                a_ids.append(f[0])
                b_ids.append(f[1])
                order += ks
                lengths += [len(parts[k].encode()) + 1 for k in ks]
        flat = lambda x: np.concatenate([*x, np.empty(0, "i8")]).astype("i8")
        return self._groups(len(parts), np.array(order, "i8"), np.cumsum(np.array(lengths, "i8")), flat(a_ids), flat(b_ids)), good

    def spans(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each group: its end in bytes, its tokens of A and of B."""
        labels = np.zeros(int(self.a_len[a].sum()), "u1")
        labels[np.cumsum(self.a_len[a]) - 1] |= 1
        labels[np.cumsum(self.b_len[b]) - 1] |= 2
        found = GROUP_RE.findall(LABELS[labels].tobytes())
        n = np.array([self.counts[s] for s in found], "i8").reshape(-1, 2)
        return np.cumsum(np.array([len(s) for s in found], "i8")), n[:, 0], n[:, 1]

    def _groups(self, n: int, order: np.ndarray, seg_end: np.ndarray, a: np.ndarray, b: np.ndarray) -> Scan:
        """order: the part that each laid segment is; seg_end: its end in bytes."""
        end, g_a, g_b = self.spans(a, b)
        laid = np.searchsorted(seg_end, end)  # the segment of each group
        part = order[laid] if len(laid) else laid
        total = lambda x: np.bincount(part, x, n).astype("i8")
        n_a, n_b = total(g_a), total(g_b)
        at_a, at_b = np.cumsum(g_a) - g_a, np.cumsum(g_b) - g_b
        of_a, of_b = np.repeat(np.arange(len(g_a)), g_a), np.repeat(np.arange(len(g_b)), g_b)
        # text: a group's A ids, then its B ids, each with the mark that follows it
        out = np.empty(len(a) + len(b), self.a_text.dtype)
        last_a, last_b = np.zeros(len(a), "i8"), np.zeros(len(b), "i8")
        last_a[at_a + g_a - 1] = 1
        last_b[at_b + g_b - 1] = 1
        out[np.arange(len(a)) + at_b[of_a]] = self.a_text[a + last_a * len(self.a_bytes)]
        out[np.arange(len(b)) + (at_a + g_a)[of_b]] = self.b_text[b + last_b * len(self.b_bytes)]
        raw = out.tobytes()
        width = out.dtype.itemsize
        tokens = np.append(0, np.cumsum(np.bincount(laid, g_a + g_b, len(order)).astype("i8"))) * width
        text = [b""] * n
        for k, i, j in zip(order.tolist(), tokens[:-1].tolist(), tokens[1:].tolist()):
            text[k] = raw[i:j].translate(None, b"\0")
        # pairs
        large = g_a * g_b > MANY
        reps = np.where(large, 0, g_b)[of_a]
        upto = np.cumsum(reps)
        step = np.arange(int(reps.sum())) - np.repeat(upto - reps, reps)
        pair = np.repeat(a, reps) * len(self.b_bytes) + b[np.repeat(at_b[of_a], reps) + step]
        where, times = np.repeat(part[of_a], reps), np.ones(len(pair), "i8")
        if large.any():
            more = [(pair, where, times)]
            for g in np.flatnonzero(large).tolist():
                ia, ca = np.unique(a[at_a[g] : at_a[g] + g_a[g]], return_counts=True)
                ib, cb = np.unique(b[at_b[g] : at_b[g] + g_b[g]], return_counts=True)
                more.append(((ia[:, None] * len(self.b_bytes) + ib).ravel(), np.full(len(ia) * len(ib), part[g]), np.outer(ca, cb).ravel()))
            pair, where, times = (np.concatenate(x) for x in zip(*more))
        by = np.argsort(where, kind="stable")
        pair_at = np.append(0, np.cumsum(np.bincount(where, minlength=n)))
        return Scan(a, b, n_a, n_b, total(np.ones(len(end))), total(g_a * g_b), text, pair_at, pair[by], times[by])

    def texts(self, texts: list[str]) -> tuple[Scan, np.ndarray, np.ndarray, np.ndarray]:
        """The scan of the texts' distinct segments; the segments of all texts in a row, the text of
        each, and whether a text has tokens. A text with a segment that is not spelt is tried whole."""
        number = defaultdict(itertools.count().__next__)
        lists = [[number[p] for p in self.segments(t)] if t else [] for t in texts]
        parts = list(number)
        scan, good = self.scan(parts)
        bad = set(np.flatnonzero(~good).tolist())
        spelt = np.array([bool(x) and bad.isdisjoint(x) for x in lists], bool) if bad else np.array([bool(x) for x in lists], bool)
        for i in [i for i, (x, ok) in enumerate(zip(lists, spelt)) if x and not ok]:
            if len(lists[i]) > 1 and next(self._encoded([texts[i]])) is not None:  # spelt whole, though not in parts
                held, self.by_segment = self.by_segment, False
                try:
                    return self.texts(texts)
                finally:
                    self.by_segment = held
            lists[i] = []
        sizes = [len(x) for x in lists]
        return scan, np.fromiter(itertools.chain.from_iterable(lists), "i8", sum(sizes)), np.repeat(np.arange(len(texts)), sizes), spelt


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, size of them."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)


def _planes(x: np.ndarray) -> bytes:
    """Small numbers, compressed: their bytes by place, so that the high ones vanish."""
    return zstandard.ZstdCompressor(level=1, write_checksum=False).compress(x.astype("<u4").view("u1").reshape(-1, 4).T.tobytes())


def _unplaned(blob: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, 4 * n))
    return np.frombuffer(raw, "u1").reshape(4, n).T.copy().view("<u4").ravel().astype("i8")


def _distinct(doc: np.ndarray, seg: np.ndarray, scan: Scan) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of documents, as document << 32 | pair, with the number of their links; from the segments of
    each, counted first."""
    seg, seen = np.unique(doc << 32 | seg, return_counts=True)
    which = seg & 0xFFFFFFFF
    size = np.diff(scan.pair_at)[which]
    take = _ranges(scan.pair_at[which], size)
    key = np.repeat(seg >> 32, size) << 32 | scan.pair[take]
    order = np.argsort(key)
    key, weight = key[order], (np.repeat(seen, size) * scan.times[take])[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, "i8")
    return key[first], np.add.reduceat(weight, first) if len(first) else weight


DIGESTS = "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs int, at binary, times binary, pair int, docs int"


def _passed(aligner: Aligner, table: pa.Table) -> list[pa.RecordBatch]:
    """A chunk's documents, with their distinct pairs as places in the chunk's sorted list of pairs, and
    that list, with the number of documents that hold each."""
    n = table.num_rows
    scan, flat, doc, spelt = aligner.texts([t or "" for t in table.column("text").to_pylist()])
    per_doc = lambda x: np.bincount(doc, x[flat], n).astype("i8")
    at = np.append(0, np.cumsum(np.bincount(doc, minlength=n)))
    sha = [hashlib.sha256(b"".join([scan.text[k] for k in flat[i:j].tolist()])[:-1]).hexdigest() if ok else "" for i, j, ok in zip(at.tolist(), at[1:].tolist(), spelt.tolist())]
    keys, weights = [np.empty(0, "i8")], [np.empty(0, "i8")]
    edges = [0]
    while edges[-1] < n:  # a few documents at a time
        edges.append(max(edges[-1] + 1, int(np.searchsorted(at, at[edges[-1]] + AT_ONCE))))
    for i, j in zip(edges, edges[1:]):
        k, w = _distinct(doc[at[i] : at[min(j, n)]], flat[at[i] : at[min(j, n)]], scan)
        keys.append(k)
        weights.append(w)
    key, weight = np.concatenate(keys), np.concatenate(weights)
    pairs, place, docs = np.unique(key & 0xFFFFFFFF, return_inverse=True, return_counts=True)
    bound = np.searchsorted(key >> 32, np.arange(n + 1)).tolist()
    places = [_planes(np.diff(place[i:j], prepend=0)) for i, j in zip(bound, bound[1:])]
    times = [_planes(weight[i:j]) for i, j in zip(bound, bound[1:])]
    chunk, m = table.column("uid")[0].as_py(), len(pairs)
    null = lambda k, kind: pa.nulls(k, kind)
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    documents = pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, chunk)), table.column("doc_id").combine_chunks(), *(pa.array(per_doc(x)) for x in (scan.n_a, scan.n_b, scan.n_groups, scan.n_links)), pa.array(sha, pa.string()),
            pa.array(np.diff(bound).astype("i4")), pa.array(places, pa.binary()), pa.array(times, pa.binary()), null(n, pa.int32()), null(n, pa.int32()),
        ],
        names=names,
    )
    asked = pa.RecordBatch.from_arrays(
        [pa.array(np.full(m, chunk)), *(null(m, pa.int64()) for _ in range(5)), null(m, pa.string()), null(m, pa.int32()), null(m, pa.binary()), null(m, pa.binary()), pa.array(pairs.astype("i4")), pa.array(docs.astype("i4"))],
        names=names,
    )
    return [documents, asked]


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _answered(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """One chunk: its documents, with what is known of its pairs summed up for each."""
    order = np.argsort(answers.column("pair").to_numpy())
    count = answers.column("count").to_numpy()[order]
    best = answers.column("best").to_numpy(zero_copy_only=False)[order].astype("i8")
    n_best, count_sum = [], []
    for n, at, times in zip(*(docs.column(c).to_pylist() for c in ("n_pairs", "at", "times"))):
        place, weight = np.cumsum(_unplaned(at, n)), _unplaned(times, n)
        n_best.append(int((best[place] * weight).sum()))
        count_sum.append(int((count[place] * weight).sum()))
    return pa.table({"doc_id": docs["doc_id"], "n_a": docs["n_a"], "n_b": docs["n_b"], "n_groups": docs["n_groups"], "n_links": docs["n_links"], "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()), "groups_sha256": docs["groups_sha256"]})


def narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _pass(docs: DataFrame, a_path: str, b_path: str, chunk: int) -> DataFrame:
    def run(batches):
        aligner = Aligner.of(a_path, b_path)
        for table in chunks(batches, chunk):
            yield from _passed(aligner, table)
            trim()

    return cut(arrow_map(narrow(docs), run, DIGESTS), "aligned")


def pair_counts(asked: DataFrame, b_size: int) -> DataFrame:
    """(pair, count, best): documents that link a pair, and whether that is the most of its A id."""
    counts = cut(asked.groupBy("pair").agg(F.sum(F.col("docs").cast("long")).alias("count")), "pairs").withColumn("a", F.expr(f"pair div {b_size}"))
    top = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    ship(docs.sparkSession)
    rows = _pass(docs, a_path, b_path, chunk)
    asked = rows.where("pair is not null").select("chunk", "pair", "docs")
    known = cut(pair_counts(asked, len(Aligner.of(a_path, b_path).b_bytes)), "known")
    answers = asked.select(F.col("chunk").alias("of"), "pair").join(known, "pair").select("of", "pair", "count", "best")
    held = rows.where("pair is null").drop("pair", "docs")
    return held.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(_answered, RESULT)


def links(docs: DataFrame, a_path: str, b_path: str, chunk: int = CHUNK) -> DataFrame:
    """The corpus's links between ids: a, b, count (documents), best (the most of a's)."""
    rows = _pass(docs, a_path, b_path, chunk)
    b_size = len(Aligner.of(a_path, b_path).b_bytes)
    return pair_counts(rows.where("pair is not null").select("pair", "docs"), b_size).select(F.expr(f"cast(pair div {b_size} as int)").alias("a"), F.expr(f"pair % {b_size}").alias("b"), "count", "best")


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, start, end, a array<int>, b array<int>): a row for each token group, its byte span in
    " " + text and the ids of both tokenizers; texts without tokens have no rows."""

    def run(batches):
        aligner = Aligner.of(a_path, b_path)
        for b in batches:
            for s in slices(b, "text", 1 << 20):
                for doc_id, text in zip(s.column("doc_id").to_pylist(), s.column("text").to_pylist()):
                    ids = next(aligner._encoded([text])) if text else None
                    if ids is None:
                        continue
                    end, *sizes = aligner.spans(*ids)
                    lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(i.astype("i4"))) for i, n in zip(ids, sizes)]
                    yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(end), pa.int64()), pa.array(np.append(0, end[:-1])), pa.array(end), *lists], names=["doc_id", "start", "end", "a", "b"])

    return arrow_map(narrow(docs), run, "doc_id long, start long, end long, a array<int>, b array<int>")
