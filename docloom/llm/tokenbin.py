"""Token ids in binary files of independent zstandard frames.

A file is a row of zstandard frames, each of whole documents' ids (little-endian unsigned 32-bit),
then a skippable frame with the document index (ids, token counts, documents of each frame), then the
seek table of the public seekable format: a skippable frame with each frame's compressed size, size
and the low 32 bits of its content's XXH64, and a footer. A reader takes the tail, finds the frames of
the documents that it wants, and decompresses and verifies those alone. Any zstandard decoder reads
the frames as they are.

Documents are range-partitioned and sorted by doc_id, encoded and written in one pass. A task writes
files of bounded size and of its own names and reports them; only reported files count, so a lost or repeated
task leaves nothing wrong behind.

Defined cases: a null text counts as empty (the end id alone); repeated rows are written each, beside
one another; a null doc_id sorts first; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, new_path, slices

#: fixed values of the seekable format
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A51, 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 1 << 20
#: bytes of ids and documents at which a file ends: what a writer and a reader's index hold is bounded by them
FILE_BYTES, FILE_DOCS = 256 << 20, 1_000_000
NO_ID = -(1 << 63)
TAILS = b".,;:!?"
#: the model lowers A-Z and drops line ends as it drops blanks
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\n", b"abcdefghijklmnopqrstuvwxyz ")


class Encoder:
    """The tokenizers library behind a cache of space-free pieces.

    Whatever the model does to a text, it does to each run between blanks alone: its pre-tokenizer
    never joins characters across a blank and drops the blank itself, so a text's ids are its pieces'
    ids in a row. The constructor checks that the model file is of that kind (else texts go to the
    library whole). Punctuation after an ASCII letter is a pre-token of its own, and A-Z are lowered by
    the model, so both are taken off before the cache is asked."""

    #: entries of a generation of the cache; two are held
    LIMIT = 400_000
    _by_path: dict[str, "Encoder"] = {}

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        spec = json.loads(self.tok.to_str())
        norm = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        split = pre[0].get("pattern", {}).get("Regex", "") if pre else ""
        self.by_piece = (
            norm == ["NFC", "Replace", "Lowercase"] and pre[0].get("behavior") == "Removed" and pre[0].get("invert") is True and split.endswith("|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
            and spec["post_processor"] is None and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.young: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}
        suffix = spec["model"].get("end_of_word_suffix")
        self.closed = bool(suffix)
        self.closes = np.zeros(self.tok.get_vocab_size(), bool)
        for token, i in self.tok.get_vocab().items():
            self.closes[i] = self.closed and token.endswith(suffix)

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, stems: list[bytes]) -> list[bytes]:
        """Ids of words of letters alone. Each is one pre-token, the last id of which, and no other, is
        of a token that closes a word, so many can be encoded as one text and told apart after. The
        words of a text that does not close one a word are encoded singly."""
        groups = [stems[i : i + 200] for i in range(0, len(stems), 200)]
        out: list[bytes] = []
        for g, e in zip(groups, self.tok.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            raw, ends = ids.tobytes(), ((np.flatnonzero(self.closes[ids]) + 1) * 4).tolist()
            if len(ends) == len(g) and ends[-1] == len(raw):
                out += [raw[i:j] for i, j in zip([0, *ends], ends)]
            else:
                out += self.whole([x.decode() for x in g])
        return out

    def _fill(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces that the cache does not have."""
        young, letters, others, split = self.young, {}, {}, []
        for p in pieces:
            if p[-1] in TAILS and len(p) > 1 and 97 <= p[-2] <= 122:
                stem, tail = p[:-1], p[-1:]
                split.append((p, stem, tail))
                if tail not in young:
                    others[tail] = None
                if stem in young:
                    continue
            else:
                stem = p
            # words that the model takes apart in spite of it are found by _letters
            if self.closed and (stem.isalpha() or (not stem.isascii() and stem.decode("utf-8", "surrogatepass").isalpha())):
                letters[stem] = None
            else:
                others[stem] = None
        letters, others = list(letters), list(others)
        fresh = dict(zip(letters, self._letters(letters)))
        fresh.update(zip(others, self.whole([x.decode("utf-8", "surrogatepass") for x in others])))
        get = lambda x: fresh[x] if x in fresh else young[x]
        fresh.update([(p, get(s) + get(t)) for p, s, t in split])
        return fresh

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return self.whole(texts)
        if len(self.young) > self.LIMIT:  # what is asked for again comes back from the old generation
            self.old, self.young = self.young, {b"": b""}
        raw = [t.encode() for t in texts]
        odd = [b"<" in r and any(s in r for s in self.special) for r in raw]  # their strings are matched before lower-casing
        parts = pc.split_pattern(pa.array([b"" if o else r.translate(LOWER) for r, o in zip(raw, odd)], pa.binary()), pattern=" ")
        coded = pc.dictionary_encode(parts.flatten())
        pieces, young, old = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.young, self.old
        missing = []
        for p in pieces:
            if p not in young:
                ids = old.get(p)
                if ids is None:
                    missing.append(p)
                else:
                    young[p] = ids
        if missing:
            young.update(self._fill(missing))
        blobs = [young[p] for p in pieces]
        # every piece's ids in a row, then gathered in the order of the pieces
        size = np.fromiter(map(len, blobs), "i8", len(blobs)) // 4
        at, of = np.cumsum(size) - size, coded.indices.to_numpy()
        n = size[of]
        ends = np.concatenate(([0], np.cumsum(n)))
        flat = np.frombuffer(b"".join(blobs), "<u4")[np.repeat(at[of] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        edge = (ends[parts.offsets.to_numpy()] * 4).tolist()
        out = [flat[i:j] for i, j in zip(edge, edge[1:])]
        for i, o in enumerate(odd):
            if o:
                out[i] = self.whole([texts[i]])[0]
        for p in missing:
            if len(p) > 64:
                del young[p]
        return out


class Writer:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, sink) -> None:
        self.sink, self.packer = sink, zstandard.ZstdCompressor(level=1)
        self.held, self.held_bytes, self.frames = [], 0, []
        self.ids, self.tokens, self.per_frame = [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.tokens.append(len(ids) // 4)
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= FRAME_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            data = b"".join(self.held)
            packed = self.packer.compress(data)
            self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            self.per_frame.append(len(self.held))
            self.sink.write(packed)
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self._flush()
        index = struct.pack("<QQ", len(self.ids), len(self.per_frame)) + np.array(self.ids, "<i8").tobytes() + np.array(self.tokens, "<u4").tobytes() + np.array(self.per_frame, "<u4").tobytes()
        index = self.packer.compress(index)
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + 9) + table + struct.pack("<IBI", len(self.frames), 0x80, SEEK_MAGIC))


class Reader:
    """Reads a file's seek table and index, and frames as they are asked for."""

    def __init__(self, source) -> None:
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        source.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_MAGIC or flags != 0x80:
            raise ValueError("not a file of this format")
        self.at = size - 9 - 12 * count - 8
        source.seek(self.at + 8)
        self.frames = [struct.unpack_from("<III", t, 0) for t in [source.read(12) for _ in range(count)]]
        self.offsets = np.concatenate(([0], np.cumsum([f[0] for f in self.frames]))).astype("i8")
        source.seek(int(self.offsets[-1]))
        mark, length = struct.unpack("<II", source.read(8))
        if mark != SKIPPABLE_INDEX:
            raise ValueError("the document index is not where it should be")
        index = zstandard.ZstdDecompressor().decompress(source.read(length))
        n, f = struct.unpack_from("<QQ", index)
        self.ids = np.frombuffer(index, "<i8", n, 16)
        self.tokens = np.frombuffer(index, "<u4", n, 16 + 8 * n)
        self.per_frame = np.frombuffer(index, "<u4", f, 16 + 12 * n)

    def frame(self, k: int) -> bytes:
        packed, size, check = self.frames[k]
        self.source.seek(int(self.offsets[k]))
        data = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return data

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids) of the documents wanted (all if None); other frames stay compressed."""
        first = 0
        for k, n in enumerate(self.per_frame.tolist()):
            ids, tokens = self.ids[first : first + n].tolist(), self.tokens[first : first + n].tolist()
            first += n
            if wanted is None or not wanted.isdisjoint(ids):
                data, at = self.frame(k), 0
                for i, t in zip(ids, tokens):
                    if wanted is None or i in wanted:
                        yield None if i == NO_ID else i, data[at : at + 4 * t]
                    at += 4 * t


def write(docs: DataFrame, model_path: str, folder: str, end_id: int = 2, file_bytes: int = FILE_BYTES, file_docs: int = FILE_DOCS) -> DataFrame:
    """Writes the files into ``folder`` (any URI that pyarrow's file systems open) in ascending doc_id
    order and returns their manifest: path, first_id, first_uid, n_docs, n_tokens. A file ends with the document
    at which it has ``file_bytes`` of ids or ``file_docs`` documents, however many there are in a partition."""

    def run(batches: Iterable[pa.RecordBatch]):
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        enc = Encoder.of(model_path)
        end = np.array([end_id], "<u4").tobytes()
        writer = sink = None

        def closed():
            writer.close()
            sink.close()
            return pa.RecordBatch.from_pydict({"path": [name], "first_id": pa.array([first[0]], pa.int64()), "first_uid": [first[1]], "n_docs": [len(writer.ids)], "n_tokens": [sum(writer.tokens)]})

        for b in batches:
            for s in slices(b, "text", 4 << 20):
                texts = [t or "" for t in s.column("text").to_pylist()]
                for i, uid, ids in zip(s.column("doc_id").to_pylist(), s.column("uid").to_pylist(), enc.encode(texts) if texts else ()):
                    if writer is None:
                        name, first, size = f"{base}/{uuid.uuid4().hex}.zst", (i, uid), 0
                        fs.create_dir(base, recursive=True)
                        sink = fs.open_output_stream(name, compression=None)
                        writer = Writer(sink)
                    writer.add(i, ids + end)
                    size += len(ids) + 4
                    if size >= file_bytes or len(writer.ids) >= file_docs:
                        yield closed()
                        writer = None
        if writer is not None:
            yield closed()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("uid"))
    ordered = narrow.repartitionByRange("doc_id", "uid").sortWithinPartitions("doc_id", "uid")
    return cut(arrow_map(ordered, run, "path string, first_id long, first_uid long, n_docs long, n_tokens long"), "manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files. The manifest is a row a file
    and comes to the driver as any table's file list does, to lay the files end to end."""
    spark = manifest.sparkSession
    files = sorted(manifest.collect(), key=lambda r: (NO_ID if r["first_id"] is None else r["first_id"], r["first_uid"]))
    begin, table = 0, []
    for f in files:
        table.append((f["path"], begin))
        begin += f["n_tokens"]

    def run(batches: Iterable[pa.RecordBatch]):
        fs, _ = pyarrow.fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("begin").to_pylist()):
                with fs.open_input_file(path) as source:
                    each = Reader(source).documents()
                    while rows := list(islice(each, 10_000)):
                        tokens = np.array([len(data) // 4 for _, data in rows], "i8")
                        ends = start + np.cumsum(tokens)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([i for i, _ in rows], pa.int64()), pa.array(ends - tokens), pa.array(tokens), pa.array([zlib.crc32(data) for _, data in rows], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                        )
                        start = int(ends[-1])

    frame = spark.createDataFrame(table, "path string, begin long").repartition(max(1, len(table)))
    return arrow_map(frame, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    folder = new_path(docs.sparkSession, "tokens")
    return read(write(docs, model_path, folder), folder)
