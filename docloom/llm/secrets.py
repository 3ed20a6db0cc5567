"""Secret scans: fixed patterns, and a linear-chain conditional random field beside them.

Base spans are of three kinds, each leftmost and not overlapping within its kind: ``assign`` (a password-like
name, = or :, and a value of 6 or more characters), ``access`` (AKIA and at least 16 of A-Z0-9) and ``hex`` (24
or more of 0-9a-f). The field tags tokens as begin, inside or outside of a secret from their shape,
their neighbours and features of the file, and Viterbi finds the best tags. Its spans are of kind ``crf``;
one that overlaps a base span is left out, and base spans always stay.

Begin can only stand on a candidate token: 6 or more of A-Za-z0-9+/_- that hold a digit, change from a small
to a capital letter, or follow a sign (= : or a quote) or, within two words, a credential's name. That is a constraint of
the field: outside is then certain in every run without white space that holds none, the chain falls apart
there, and decoding the other runs alone gives the best tags of the whole text. (A word of small letters
after neither sign nor name is no candidate.) A long run is decoded as it streams: tags are given out once all
ways that are left agree on them, so memory does not grow with the run.

The field is fitted on the driver to stretches of runs, labelled by the base spans: at most ``sample`` that hold
one and twice as many that hold none, those with the smallest md5 of doc_id and place. A stretch ends at the first token
outside of a secret after ``STRETCH`` tokens. Only feature numbers and tags come to the driver, no text. The secrets'
values are never weights of their own: a token's text is a feature only where it is a short word or a single sign.

Defined cases: a null text counts as empty (no spans, digest of the empty string); repeated rows are
scanned each; a corpus without base spans adds none; offsets are code points, end exclusive; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, slices

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("passw", "passwd", "secret", "token", "api_key", "apikey")
KINDS = ("assign", "access", "hex", "crf")

LEAST = 6
STRETCH = 200
MARK = re.compile(r"[0-9]|[a-z][A-Z]")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{6,}")
#: a sign, or a credential's name and at most one short word, before a token
SIGNED = re.compile(r"[=:\"'`]\x20*[\"'`]?(?=[A-Za-z0-9+/_-]{6})")
NAMED = re.compile(r"(?:passw|passphrase|passcode|pwd|secret|token|api_?key|credential|bearer|auth)[A-Za-z_]{0,12}[^A-Za-z0-9+/_-]{1,4}(?:[A-Za-z]{1,5}[^A-Za-z0-9+/_-]{1,4})?(?=[A-Za-z0-9+/_-]{6})", re.IGNORECASE)
SPACE = re.compile(r"\s")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]+|.", re.DOTALL)
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
WIDTH = 1 << 14
Span = tuple[int, str, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the fixed patterns, ordered by start and then kind as listed."""
    out: list[Span] = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def candidates(text: str) -> set[int]:
    """Starts of the tokens on which a secret may begin."""
    found = {m.start() for m in CANDIDATE.finditer(text) if MARK.search(text, m.start(), m.end())}
    for pattern in (SIGNED, NAMED):
        found.update(m.end() for m in pattern.finditer(text))
    return found


def _word_before(text: str, at: int) -> tuple[int, str]:
    """Start and text of the last word before ``at``; (0, "") if none."""
    while at > 0 and text[at - 1].isspace():
        at -= 1
    end = at
    while at > 0 and not text[at - 1].isspace():
        at -= 1
    return at, text[at:end]


class Run:
    """A stretch of text without white space that holds a candidate: its place, the two words before it and the one after."""

    def __init__(self, text: str, start: int, end: int, begins: set[int]) -> None:
        self.text, self.start, self.end, self.begins = text, start, end, begins
        at, one = _word_before(text, start)
        self.before = [_word(w) if w else "<s>" for w in (_word_before(text, at)[1], one)]
        after = re.compile(r"\S+").search(text, end)
        self.after = _word(after.group()) if after else "</s>"

    def tokens(self):
        """(start, end, candidate) of every token."""
        for m in TOKEN.finditer(self.text, self.start, self.end):
            yield m.start(), m.end(), m.start() in self.begins and m.end() - m.start() >= LEAST


def runs(text: str):
    begins, done = candidates(text), -1
    for at in sorted(begins):
        if at < done:
            continue
        start = at
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        stop = SPACE.search(text, at)
        done = stop.start() if stop else len(text)
        yield Run(text, start, done, begins)


def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) & (WIDTH - 1)


def _shape(w: str) -> str:
    s = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "0", w)))
    return s if len(s) <= 4 else s[:2] + "~" + s[-2:] + str(min(9, len(s) // 4))


def _word(w: str) -> str:
    """A neighbour as a feature: short words and signs by themselves, anything else by its shape."""
    return _known_word(w) if len(w) <= 64 else _shape(w[:64])


@lru_cache(50_000)
def _known_word(w: str) -> str:
    low = w.lower().strip("\"'`,;()[]{}<>")
    return low if low.isalpha() and len(low) <= 10 else _shape(w)


def _file(text: str) -> list[str]:
    n = max(1, len(text))
    digits = sum(text.count(c) for c in "0123456789") / n
    signs = sum(text.count(c) for c in "=:\"'{}[]_/") / n
    low = text.lower()
    return [f"digits{min(9, int(digits * 100))}", f"signs{min(9, int(signs * 100))}", f"length{min(20, n.bit_length())}", f"names{any(k in low for k in NAMES)}"]


def _token_names(w: str, candidate: bool) -> list[str]:
    """Features of a token by itself."""
    kinds = Counter("0" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else "-" for c in w)
    entropy = -sum(n / len(w) * math.log2(n / len(w)) for n in Counter(w).values())
    f = ["bias", f"c{candidate}", "s" + _shape(w), f"l{min(12, len(w) // 4)}", "k" + "".join(sorted(kinds)), f"e{int(entropy * 2)}", f"x{all(c in '0123456789abcdef' for c in w)}"]
    return f + [f"d{kinds['0'] * 5 // len(w)}", f"u{w[:4]}" if w[:4].isupper() and len(w) > 8 else f"s1{_shape(w[:3])}"]


def _around_names(two: str, one: str, after: str, candidate: bool) -> list[str]:
    """Features of the words beside a token: two before and one after it."""
    return ["p" + one, "q" + two, "n" + after, f"pq{two}|{one}", f"cp{candidate}{one}"]


def _line(run: Run):
    """Of every token: its place, itself, and the words beside it. Only one token is looked ahead."""
    two, one, held = *run.before, None
    for a, b, candidate in run.tokens():
        if held:
            yield *held, _word(run.text[a:b])
            two, one = one, _word(held[3])
        held = a, b, candidate, run.text[a:b], two, one
    if held:
        yield *held, run.after


def emissions(run: Run, file: list[str]) -> list[tuple[int, int, bool, list[int]]]:
    """Place, candidacy and feature ids of every token of a run."""
    return [
        (a, b, c, [_hash(x) for x in [*_token_names(w, c), *_around_names(two, one, after, c), *(f"{x}c{c}" for x in file)]])
        for a, b, c, w, two, one, after in _line(run)
    ]


def _allowed(candidate: bool) -> np.ndarray:
    return np.array([0.0, 0.0 if candidate else -np.inf, 0.0])


#: inside follows begin or inside only; a run begins and ends beside certain outside tags
START = np.array([0.0, 0.0, -np.inf])
STEP = np.array([[0.0, 0.0, -np.inf], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]])


class Field:
    """weights (WIDTH x 3) of token features and trans (3 x 3) of tag pairs."""

    def __init__(self, weights: np.ndarray | None = None, trans: np.ndarray | None = None) -> None:
        self.weights = np.zeros((WIDTH, 3)) if weights is None else weights
        self.trans = np.zeros((3, 3)) if trans is None else trans
        self.held: dict[tuple, tuple] = {}

    def potentials(self, features: list[list[int]], candidate: list[bool]) -> np.ndarray:
        return np.stack([self.weights[f].sum(0) + _allowed(c) for f, c in zip(features, candidate)])

    def rows(self, run: Run, file: list[str], places: array):
        """The potentials of a run's tokens, one after another; their places are added to ``places``. Sums of a
        token's and of its neighbours' weights are remembered."""
        held = self.held
        if len(held) > 50_000:
            held.clear()
        tuples = lambda names: tuple(self.weights[[_hash(x) for x in names]].sum(0).tolist())
        of_file = {c: tuples([f"{x}c{c}" for x in file]) for c in (False, True)}
        for a, b, c, w, two, one, after in _line(run):
            own = held.get((w, c))
            if own is None:
                own = tuples(_token_names(w, c))
                if len(w) <= 64:
                    held[w, c] = own
            near = held.get((two, one, after, c))
            if near is None:
                near = held[two, one, after, c] = tuples(_around_names(two, one, after, c))
            f = of_file[c]
            places.append(a)
            places.append(b)
            yield own[0] + near[0] + f[0], own[1] + near[1] + f[1] if c else -math.inf, own[2] + near[2] + f[2]

    def viterbi(self, rows, block: int = 1024):
        """The best tags of rows of potentials, given out as soon as all ways agree on them."""
        step = (self.trans + STEP).tolist()
        rows, back = iter(rows), bytearray()  # of each row the best ways into its tags, as one number
        first = next(rows, None)
        if first is None:
            return
        at = [x + y for x, y in zip(first, START.tolist())]

        def way(tag: int) -> bytearray:
            tags = bytearray([tag])
            for b in reversed(back):
                tag = b // (1, 3, 9)[tag] % 3
                tags.append(tag)
            tags.reverse()
            return tags

        limit = block
        for row in rows:
            code, now = 0, []
            for tag in (OUTSIDE, BEGIN, INSIDE):
                ways = [at[k] + step[k][tag] for k in (OUTSIDE, BEGIN, INSIDE)]
                best = max(ways)
                code += ways.index(best) * (1, 3, 9)[tag]
                now.append(best + row[tag])
            back.append(code)
            at = now
            if len(back) >= limit:
                every = [way(tag) for tag in (OUTSIDE, BEGIN, INSIDE) if at[tag] > -math.inf]
                agreed = next((k for k in range(len(back), -1, -1) if len({w[k] for w in every}) == 1), -1)
                if agreed > 0:  # the tag at ``agreed`` stays, as the beginning of all ways that are left
                    yield from every[0][:agreed]
                    del back[:agreed]
                    top = max(at)
                    at = [x - top for x in at]
                limit = max(block, 2 * len(back))
        yield from way(at.index(max(at)))

    def gradient(self, e: np.ndarray, tags: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Expected minus observed: token marginals (n x 3) and pair marginals (3 x 3)."""
        step, n = self.trans + STEP, len(e)
        fw, bw = np.empty((n, 3)), np.zeros((n, 3))
        fw[0] = e[0] + START
        for i in range(1, n):
            fw[i] = np.logaddexp.reduce(fw[i - 1][:, None] + step, axis=0) + e[i]
        for i in range(n - 2, -1, -1):
            bw[i] = np.logaddexp.reduce(step + (e[i + 1] + bw[i + 1])[None, :], axis=1)
        z = np.logaddexp.reduce(fw[-1])
        one = np.exp(fw + bw - z)
        pair = np.zeros((3, 3))
        for i in range(1, n):
            pair += np.exp(fw[i - 1][:, None] + step + (e[i] + bw[i])[None, :] - z)
        one[np.arange(n), tags] -= 1
        for a, b in zip(tags, tags[1:]):
            pair[a, b] -= 1
        return one, pair


def secret_values(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Places of the base spans' values, in order."""
    return sorted([(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST] + [(a, b) for a, k, b in spans if k != "assign"])


def gold(tokens: list[tuple[int, int, bool]], values: list[tuple[int, int]]) -> list[int]:
    """Tags by the secrets' values: begin on a value's first candidate, inside after it."""
    tags, open_, k, widest = [], -1, 0, max((b - a for a, b in values), default=0)
    starts = [a for a, _ in values]
    for a, b, candidate in tokens:
        k = bisect_right(starts, a)
        hit = None
        while k > 0 and starts[k - 1] >= a - widest:
            k -= 1
            if values[k][0] <= a and b <= values[k][1]:
                hit = values[k]
        if hit is None:
            open_ = -1
            tags.append(OUTSIDE)
        elif open_ == hit[1]:
            tags.append(INSIDE)
        elif candidate:
            open_ = hit[1]
            tags.append(BEGIN)
        else:
            tags.append(OUTSIDE)
    return tags


Stretch = tuple[list[list[int]], list[bool], list[int]]


def stretches(text: str) -> list[tuple[int, Stretch]]:
    """(start, (features, candidacy, tags)) of a text's runs; long ones in parts that end outside of secrets."""
    out, values, file = [], None, None
    for run in runs(text):
        if file is None:
            file, values = _file(text), secret_values(text, base_spans(text))
        e = emissions(run, file)
        tags = gold([x[:3] for x in e], values)
        first = 0
        for i, tag in enumerate(tags):
            if i == len(tags) - 1 or (i - first >= STRETCH and tag == OUTSIDE):
                part = e[first : i + 1]
                out.append((part[0][0], ([x[3] for x in part], [x[2] for x in part], tags[first : i + 1])))
                first = i + 1
    return out


def fit(data: list[Stretch], epochs: int = 8, seed: int = 3) -> Field:
    """Maximum likelihood with a quadratic penalty, by stochastic steps (AdaGrad)."""
    field, rng = Field(), np.random.default_rng(seed)
    gw, gt = np.full((WIDTH, 3), 1e-2), np.full((3, 3), 1e-2)
    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            features, candidate, tags = data[i]
            one, pair = field.gradient(field.potentials(features, candidate), tags)
            ids, inv = np.unique(np.concatenate(features), return_inverse=True)
            g = np.zeros((len(ids), 3))
            np.add.at(g, inv, np.repeat(one, [len(f) for f in features], axis=0))
            g += 1e-4 * field.weights[ids]
            gw[ids] += g * g
            field.weights[ids] -= 0.2 * g / np.sqrt(gw[ids])
            gt += pair * pair
            field.trans -= 0.1 * pair / np.sqrt(gt)
    return field


def crf_spans(text: str, field: Field) -> list[Span]:
    out: list[Span] = []
    file = None
    for run in runs(text):
        file = file or _file(text)
        places, k = array("q"), 0
        for tag in field.viterbi(field.rows(run, file, places)):
            a, b = places[k], places[k + 1]
            k += 2
            if k >= 1 << 16:
                del places[:k]
                k = 0
            if tag == BEGIN:
                out.append((a, "crf", b))
            elif tag == INSIDE:
                out[-1] = (out[-1][0], "crf", b)
    return out


def spans(text: str, field: Field | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans)."""
    base = base_spans(text)
    if field is None:
        return base, base
    # base spans by start, with the furthest end so far: one that overlaps starts before a span's end and reaches beyond its start
    starts, ends = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
    extra = [s for s in crf_spans(text, field) if (k := bisect_left(starts, s[2])) == 0 or ends[k - 1] <= s[0]]
    return base, ordered(base + extra) if extra else base


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def learn(docs: DataFrame, sample: int = 256) -> Field | None:
    """The field, or None without base spans. Two bounded samples of stretches come to the driver, as numbers."""

    def run(batches):
        for b in batches:
            for s in slices(b, "text"):
                rows = []
                for i, t in zip(s.column("doc_id").to_pylist(), s.column("text").to_pylist()):
                    for at, (features, candidate, tags) in stretches(t or ""):
                        h = hashlib.md5(f"{'' if i is None else i}:{at}".encode()).hexdigest()
                        flat = np.array([x for f in features for x in f], "<i4")
                        rows.append((h, any(tags), flat.tobytes(), np.array([len(f) for f in features], "<i4").tobytes(), np.array(candidate, "u1").tobytes(), np.array(tags, "u1").tobytes()))
                kinds = (pa.string(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["h", "has", "ids", "sizes", "candidate", "tags"])

    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    total = docs.count()
    # documents are held under a bound of their digest that 64 * sample of them fall below; should they not have enough secrets, all take part
    share = min(1.0, 64 * sample / max(1, total))
    for bound in dict.fromkeys((share, 1.0)):
        some = _narrow(docs)
        if bound < 1.0:
            some = some.where(digest < format(int(bound * 2**32), "08x"))
        rows = cut(arrow_map(some, run, "h string, has boolean, ids binary, sizes binary, candidate binary, tags binary"), "secret-stretches")
        got = [r for kind, n in (("has", sample), ("not has", 2 * sample)) for r in rows.where(kind).orderBy("h", "ids", "tags").limit(n).collect()]
        if sum(r["has"] for r in got) >= sample // 2:
            break
    if not any(r["has"] for r in got):
        return None
    data = []
    for r in got:
        ids, edge = np.frombuffer(r["ids"], "<i4"), np.cumsum(np.frombuffer(r["sizes"], "<i4"))
        data.append(([x.tolist() for x in np.split(ids, edge[:-1])], [bool(x) for x in r["candidate"]], list(r["tags"])))
    return fit(data)


def find(docs: DataFrame, sample: int = 256) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row."""
    field = learn(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast(None if field is None else (field.weights, field.trans))  # of fixed size

    def run(batches):
        model = None if shared.value is None else Field(*shared.value)
        for b in batches:
            for s in slices(b, "text"):
                counts, digest, every = {k: [] for k in KINDS[:3]}, [], []
                for t in s.column("text").to_pylist():
                    base, both = spans(t or "", model)
                    for k, c in counts.items():
                        c.append(sum(x[1] == k for x in base))
                    digest.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    every.append(joined(both))
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts.values()), pa.array(digest, pa.string()), pa.array(every, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return arrow_map(_narrow(docs), run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
