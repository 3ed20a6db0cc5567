"""Spelling variants: words one edit apart, found by bands of letter-parity bitmasks.

Words are runs of Latin letters, lower-cased (A-Z), of five letters or more that occur three times or more
in the corpus. A word's mask has a bit for each letter: whether the letter occurs an odd number of times. A
replaced letter flips two bits at most, an inserted or deleted one exactly one. Masks are split into three
bands of letters, so after a replacement at least one band is as it was, and after an insertion or deletion two
are. Words of equal length are joined on one equal band, words whose lengths differ by one on two; in both
cases also on an equal half, since one edit leaves the letters before or after the middle as they were, which
keeps the lists behind a key short. What a key brings together is verified by edit distance, and a pair that
several keys bring together is taken at the first.

Counts are summed in the tasks that read the texts before they are shuffled, so a frequent word is one row a
task. All that follows works on the vocabulary. A word's form is its near word of largest count, if that is at
least twice its own; roots follow forms by pointer doubling, and as counts double at every step a chain
is no longer than the logarithm of the corpus. Vocabularies are joined by sorting: a table of words is small on
disk, and Spark, which does not count a word's keys, would collect and broadcast them from the driver.

Defined cases: null and empty texts have no words; repeated rows count again; a null doc_id stands as '' in the
digest; ties of counts go to the smaller word in code-point order. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, slices

LEAST_LETTERS, LEAST_COUNT, RATIO = 5, 3, 2
#: one run in so many, by digest, loses a letter
SLIP = 97
#: bytes of text whose words are listed at once, and words counted before they are handed on
STRETCH, HELD = 1 << 20, 200_000


def _plain() -> bytes:
    """Latin-1 letters as they are, A-Z lower-cased, blanks for all else."""
    low = [b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)]
    return bytes(b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in low)


PLAIN = _plain()


def runs(text: str):
    """Lists of the text's runs in Latin-1, a stretch at a time."""
    data = text.encode("latin-1", "replace").translate(PLAIN)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + STRETCH)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def count_words(doc_id: int | None, text: str | None, into: Counter) -> None:
    """Adds a document's words, a letter taken from the runs that the digest picks."""
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for stretch in runs(text or ""):
        for run, n in Counter(stretch).items():
            if len(run) < LEAST_LETTERS:
                continue
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
            if h % SLIP == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
                if len(run) < LEAST_LETTERS:
                    continue
            into[run] += n


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that occur often enough."""

    def run(batches):
        held: Counter = Counter()
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        for b in batches:
            for s in slices(b, "text"):
                for doc_id, text in zip(s.column("doc_id").to_pylist(), s.column("text").to_pylist()):
                    count_words(doc_id, text, held)
                    if len(held) > HELD:
                        yield batch()
                        held.clear()
        yield batch()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(narrow, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


#: a letter's number: a-z, then U+00C0 to U+00FF; letters are dealt to the three bands in turn
LETTERS = "transform(regexp_extract_all(word, '(?s).', 0), c -> if(ascii(c) < 128, ascii(c) - 97, ascii(c) - 166))"


def band(k: int) -> Column:
    return F.expr(f"aggregate(letters, 0, (m, i) -> if(i % 3 = {k}, m ^ shiftleft(1, int(i / 3)), m))")


def _keys(words: DataFrame, length: Column, bands: list[tuple[int, ...]]) -> DataFrame:
    """A row for each of a word's keys: which bands, their masks, the length (of the shorter word), which half and its letters."""
    half = (length / 2).cast("int")
    halves = [(0, F.substring("word", F.lit(1), half)), (1, F.substring("word", F.length("word") - (length - half) + 1, length - half))]
    keys = F.array(*(F.struct(F.lit(i).alias("which"), *(F.element_at("masks", b[j % len(b)] + 1).alias(f"mask{j}") for j in range(2)), F.lit(h).alias("side"), text.alias("half")) for i, b in enumerate(bands) for h, text in halves))
    return words.select("word", "n", "masks", length.alias("length"), F.explode(keys).alias("key")).select("word", "n", "masks", "length", "key.*")


KEY = ["which", "mask0", "mask1", "length", "side", "half"]


def _sorted(words: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast."""
    return words.hint("merge")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): both directions of every pair of words (word, n) that are one edit apart."""
    told = words.withColumn("letters", F.expr(LETTERS)).withColumn("masks", F.array(band(0), band(1), band(2))).drop("letters")
    told = cut(told, "masks")
    other = lambda d: d.select(*KEY, F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("masks").alias("near_masks"))
    one_apart = F.levenshtein("word", "near", 1) == 1
    # a letter replaced: one band at least is equal; taken at the first equal one
    same = _keys(told, F.length("word"), [(0,), (1,), (2,)])
    first = F.expr("which = int(array_position(zip_with(masks, near_masks, (x, y) -> x = y), true)) - 1")
    replaced = same.join(_sorted(other(same)), KEY).where((F.col("word") != F.col("near")) & first & one_apart).select("word", "n", "near", "near_n")
    # a letter more: two bands are equal, and only two; taken at the first half if both are equal
    pairs = [(0, 1), (0, 2), (1, 2)]
    short, long = _keys(told, F.length("word"), pairs), _keys(told, F.length("word") - 1, pairs)
    half = F.expr("int(length / 2)")
    once = (F.col("side") == 0) | (F.substring("word", F.lit(1), half) != F.substring("near", F.lit(1), half))
    inserted = short.join(_sorted(other(long)), KEY).where(once & one_apart).select("word", "n", "near", "near_n")
    both = F.explode(F.array(F.struct("word", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return replaced.select("word", "near", "near_n").unionByName(inserted.select(both.alias("p")).select("p.*"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form): where following forms ends. Every round doubles the steps."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = cut(now.join(_sorted(further), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = cut(vocabulary(docs), "words")
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    large = -F.col("best.less") >= RATIO * F.col("n")
    told = words.join(_sorted(best), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n"))
    told = cut(told, "forms")
    ends = roots(told.where("form is not null"))
    return told.join(_sorted(ends), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The digest (CRC-32, reflected, polynomial EDB88320) a byte at a time, then words, their deletions as keys of near pairs, and forms followed to the last.
SQL = r"""
    WITH RECURSIVE crc_row AS (
        SELECT b, list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM (SELECT unnest(range(0, 256)) AS b)),
    crc AS (SELECT list(v ORDER BY b) AS t FROM crc_row),
    raw AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS w
        FROM documents),
    run AS (SELECT doc_id, w, count(*) AS n, concat(doc_id, ':', w) AS s FROM raw GROUP BY doc_id, w),
    bytes AS (
        SELECT doc_id, w, n, flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bs
        FROM run),
    digest AS (
        SELECT doc_id, w, n, xor(list_reduce(list_prepend(4294967295, bs), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h
        FROM bytes, crc),
    word AS (
        SELECT w, sum(n)::BIGINT AS n
        FROM (SELECT CASE WHEN h % 97 = 0 THEN concat(left(w, (h % length(w))::INT), substr(w, (h % length(w))::INT + 2)) ELSE w END AS w, n FROM digest)
        WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3),
    cut AS (SELECT w, n, i, concat(left(w, i - 1), substr(w, i + 1)) AS rest FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM word)),
    near AS (
        SELECT a.w, b.w AS o, b.n AS m FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.w <> b.w
        UNION SELECT c.w, s.w, s.n FROM cut c JOIN word s ON c.rest = s.w
        UNION SELECT s.w, c.w, c.n FROM cut c JOIN word s ON c.rest = s.w),
    best AS (SELECT w, count(*) AS n_near, arg_min(o, (-m, o)) AS o, max(m) AS m FROM near GROUP BY w),
    told AS (
        SELECT word.w, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * word.n THEN o END AS form, CASE WHEN m >= 2 * word.n THEN m END AS form_n
        FROM word LEFT JOIN best USING (w)),
    follow AS (
        SELECT w, w AS place, 0 AS step FROM told
        UNION ALL SELECT f.w, t.form, f.step + 1 FROM follow f JOIN told t ON f.place = t.w WHERE t.form IS NOT NULL),
    ends AS (SELECT w, arg_max(place, step) AS root FROM follow GROUP BY w)
    SELECT w AS word, form, root, n, n_near, form_n FROM told JOIN ends USING (w)"""
