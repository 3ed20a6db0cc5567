"""SentencePiece encoding and decoding with offsets into the original text.

The model file is read for its *normaliser*: a compiled character map (a double-array trie over UTF-8
and a block of replacement strings), the space marks and the dummy prefix. ``Normalizer`` takes the
longest prefix that the map knows at each place and records, for every byte it writes, the source byte
it stands for; every piece's bytes then project to a span of the original text. The sentencepiece
library does the segmentation itself, so that ids are its own.

Defined cases: a null text counts as empty (the end id alone); the end id spans nothing; repeated
rows are encoded each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices

SPACE = "▁".encode()


class CharMap:
    """A compiled character map: 4 bytes of the trie's size, the trie's units, then replacements that
    end in a zero byte. A unit is of the public double-array layout: bit 31 marks a value, bit 8 says
    that a value follows, bits 10-30 are the offset (times 256 if bit 9 is set), the low byte the label."""

    def __init__(self, blob: bytes) -> None:
        self.units, self.strings = [], b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of data[at:]."""
        if not self.units:
            return None
        offset = lambda u: (u >> 10) << ((u & 0x200) >> 6)
        node, found = offset(self.units[0]), None
        for i in range(at, len(data)):
            byte = data[i]
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.strings[start : self.strings.index(b"\0", start)]
        return found


class Normalizer:
    def __init__(self, charsmap: bytes = b"", add_dummy_prefix: bool = True, remove_extra_whitespaces: bool = False, escape_whitespaces: bool = True) -> None:
        self.map = CharMap(charsmap)
        self.prefix, self.squeeze, self.mark = add_dummy_prefix, remove_extra_whitespaces, SPACE if escape_whitespaces else b" "

    def _units(self, data: bytes):
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit:
                size, new = hit
            else:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                new = data[at : at + size]
            yield at, size, new
            at += size

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them and the end the source byte it stands for."""
        if not data:
            return b"", np.zeros(1, "i8")
        if not self.map.units and not self.squeeze:
            return self._plain(data)
        out, src, end = bytearray(), [], len(data)
        units = list(self._units(data))
        if self.squeeze:
            while units and units[0][2].strip(b" ") == b"":
                units.pop(0)
            while units and units[-1][2].strip(b" ") == b"":
                end = units.pop()[0]
        if not units:
            return b"", np.zeros(1, "i8")
        if self.prefix:
            out += self.mark
            src += [units[0][0]] * len(self.mark)
        after_space = self.squeeze
        for at, size, new in units:
            for j in range(len(new)):
                byte = new[j : j + 1]
                if byte == b" ":
                    if self.squeeze and after_space:
                        continue
                    out += self.mark
                    src += [at] * len(self.mark)
                else:
                    out += byte
                    src.append(at)
                after_space = byte == b" " and self.squeeze
        return bytes(out), np.array([*src, end], "i8")

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """An empty map without squeezing: only spaces change, so alignment is a running sum."""
        raw = np.frombuffer(data, "u1")
        width = np.where(raw == 32, len(self.mark), 1)
        src = np.repeat(np.arange(len(raw)), width)
        head = np.zeros(len(self.mark) if self.prefix else 0, "i8")
        return (self.mark if self.prefix else b"") + data.replace(b" ", self.mark), np.concatenate((head, src, [len(raw)]))


class Codec:
    """A model file's encoder, decoder and span projection."""

    _by_path: dict[str, "Codec"] = {}

    def __init__(self, path: str) -> None:
        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.sp = spm.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        model.ParseFromString(self.sp.serialized_model_proto())
        spec = model.normalizer_spec
        self.normalizer = Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        #: bytes of normalised text that each id covers; the unknown id (-1) covers what is left over
        kind = model.SentencePiece if hasattr(model, "SentencePiece") else pb.ModelProto.SentencePiece
        self.size = np.array([1 if p.type == kind.BYTE else -1 if p.type == kind.UNKNOWN else 0 if p.type == kind.CONTROL else len(p.piece.encode()) for p in model.pieces], "i8")
        #: and of the source, where the map is empty and the text has no space mark itself: a mark is one byte there
        self.plain = np.array([len(p.piece.encode()) - 2 * p.piece.count("▁") if s > 1 else s for p, s in zip(model.pieces, self.size.tolist())], "i8")
        self.eos = self.sp.eos_id()

    @classmethod
    def of(cls, path: str) -> "Codec":
        """One for each worker process and path."""
        held = sys.modules[__name__].Codec._by_path
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def spans(self, data: bytes, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Byte spans [start, end) in ``data`` of every id."""
        n = self.normalizer
        size = self.size[ids]
        if not n.map.units and not n.squeeze and (size >= 0).all() and SPACE not in data:
            ends = np.cumsum(self.plain[ids]) - (1 if n.prefix and data else 0)
            ends = np.maximum(ends, 0)
            return np.concatenate(([0], ends[:-1])), ends
        norm, align = n(data)
        if (size < 0).any():  # an unknown piece's length is not in its id: read it from the library
            pieces = self.sp.encode(data.decode("utf-8"), out_type=str)
            size = np.array([*(len(p.encode()) if s else s for p, s in zip(pieces, size)), *([0] * (len(ids) - len(pieces)))])
        at = np.minimum(np.cumsum(size), len(norm))
        ends = align[at]
        return np.concatenate((align[:1] * 0, ends[:-1])), ends


def encode(docs: DataFrame, model_path: str, add_eos: bool = True) -> DataFrame:
    """(doc_id, ids array<int>, starts array<int>, ends array<int>, decoded string): ids of the whole
    text, each id's byte span in the text, and the library's decoding of the ids."""

    def run(batches):
        codec = Codec.of(model_path)
        for b in batches:
            for s in slices(b, "text", 4 << 20):
                texts = [t or "" for t in s.column("text").to_pylist()]
                ids = codec.sp.encode(texts, add_eos=add_eos, num_threads=1)
                spans = [codec.spans(t.encode(), i) for t, i in zip(texts, ids)]
                flat = lambda parts: pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum([len(x) for x in parts]))), pa.int32()), pa.array(np.concatenate([*parts, []]).astype("i4"), pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), flat([np.array(i, "i4") for i in ids]), flat([x for x, _ in spans]), flat([y for _, y in spans]), pa.array(codec.sp.decode(ids, num_threads=1), pa.string())],
                    names=["doc_id", "ids", "starts", "ends", "decoded"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(narrow, run, "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32): ``encode`` summed up in the task
    that encodes, so that ids and spans need not leave it. spans_crc32 is of the spans' ends as
    little-endian unsigned 32-bit integers."""

    def run(batches):
        codec = Codec.of(model_path)
        for b in batches:
            for s in slices(b, "text", 4 << 20):
                texts = [t or "" for t in s.column("text").to_pylist()]
                ids = codec.sp.encode(texts, add_eos=True, num_threads=1)
                decoded = codec.sp.decode(ids, num_threads=1)
                crc = [zlib.crc32(codec.spans(t.encode(), i)[1].astype("<u4").tobytes()) for t, i in zip(texts, ids)]
                yield pa.RecordBatch.from_arrays(
                    [
                        s.column("doc_id"), pa.array(map(len, ids), pa.int64()), pa.array([hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest() for i in ids], pa.string()),
                        pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()), pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(narrow, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")
