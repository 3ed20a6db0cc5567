"""Scalar text functions as Columns; everything stays in the JVM.

Patterns carry (?U) where white space and digits are to be Unicode's, and (?s) where a dot is any character.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PENDING_PREFIX

# Label patterns in order of precedence, as (label, rest) groups.
LABEL_PATTERNS = (
    r"(?sU)^(\d+(?:\.\d+)*)\.?\s+(.+)",
    r"(?sU)^(제\d+[장절항목])\s+(.+)",
    r"(?sU)^([A-Z]\.\d*)\s+(.+)",
    r"(?siU)^(Appendix\s+[A-Z])\s+(.+)",
    r"(?sU)^([가-힣]\.\s*)(.+)",
)
# Mathematical signs, and the identifier's form.
MATH_SIGNS = "∑∫√±αβγδεζηθικλμνξοπρστυφχψωΔΓΘΛΞΠΣΦΨΩ=+-*/<>≤≥≈≠"
IDENTIFIER = r"[A-Z][A-Z0-9]{1,}[-/][A-Z0-9][-A-Z0-9/.-]*"
IDENTIFIER_WHOLE = r"^[A-Z][A-Z0-9]{1,}[-/][A-Z0-9][-A-Z0-9/.-]*$"
DATE = r"^\d{4}-\d{2}-\d{2}$"
WHITE = r"(?U)[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    """Without white space (Unicode's) at either end."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def present(c: Column) -> Column:
    """The string, or null where it is empty."""
    return F.nullif(c, F.lit(""))


def normalize(c: Column) -> Column:
    """Lower case, with single spaces and none at the ends."""
    return F.trim(F.regexp_replace(F.lower(c), WHITE, " "))


def word_count(c: Column) -> Column:
    n = normalize(c)
    return F.when(n == "", F.lit(0)).otherwise(F.size(F.split(n, " ")))


def first_match(c: Column, patterns: tuple[str, ...], make: Callable[[Column, str], Column]) -> Column:
    """``make`` of the first pattern that matches, else null."""
    out = F.when(c.rlike(patterns[0]), make(c, patterns[0]))
    for p in patterns[1:]:
        out = out.when(c.rlike(p), make(c, p))
    return out


def section_label(c: Column) -> Column:
    """struct(label, title) of a numbered heading, or null."""
    part = lambda x, p: F.struct(strip(F.regexp_extract(x, p, 1)).alias("label"), strip(F.regexp_extract(x, p, 2)).alias("title"))
    return first_match(c, LABEL_PATTERNS, part)


def count_of(c: Column, characters: str) -> Column:
    """How many characters of c are in a class body such as A-Z."""
    return F.length(c) - F.length(F.regexp_replace(c, f"[{characters}]", ""))


def math_signs(c: Column) -> Column:
    return count_of(c, MATH_SIGNS.replace("-", r"\-"))


def label_depth(label: Column) -> Column:
    """Dots and one; a dot at the end counts."""
    return F.length(label) - F.length(F.replace(label, F.lit("."), F.lit(""))) + 1


def depth_type(depth: Column) -> Column:
    return F.when(depth == 0, "title").when(depth == 1, "section").otherwise("subsection")


def is_equation(c: Column) -> Column:
    """A number in parentheses at the end, 3 or more mathematical signs, or over a tenth of them."""
    n = math_signs(c)
    return strip(c).rlike(r"\((?U:\d+(\.\d+)*)\)\z") | ((F.length(c) > 3) & ((n >= 3) | (n / F.length(c) > 0.1)))


def equation_number(c: Column) -> Column:
    """The number in parentheses at the end (a letter may follow), or ''."""
    return F.regexp_extract(c, r"(?U)\((\d+(\.\d+)*[a-zA-Z]?)\)\s*\z", 1)


def language(c: Column, most: int = 2000, enough: int = 50) -> Column:
    """ko or en by the letters of the first ``most`` characters; ko where there is no text."""
    head = F.substring(c, 1, most)
    hangul, latin = count_of(head, "가-\ud7af"), count_of(head, "A-Za-z")
    return F.when(F.coalesce(c, F.lit("")) == "", "ko").when((hangul >= enough) | (hangul > latin), "ko").otherwise("en")


def identifiers(c: Column) -> Column:
    """All identifier-like parts, in order."""
    return F.regexp_extract_all(c, F.lit(IDENTIFIER), F.lit(0))


def toc_line(c: Column) -> Column:
    """A table-of-contents line without leaders and page number."""
    return strip(F.regexp_replace(strip(F.regexp_replace(strip(c), r"(?U)[.\s]{3,}\d+\s*\z", "")), r"\.{3,}", ""))


def zfill(c: Column, width: int) -> Column:
    """Zeros before a short value; a long one stays whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def date_of(year: Column, month: Column, day: Column) -> Column:
    """year-month-day; month and day default to 01, no year gives null."""
    return F.when(F.coalesce(year, F.lit("")) == "", None).otherwise(F.concat_ws("-", year, zfill(F.coalesce(month, F.lit("01")), 2), zfill(F.coalesce(day, F.lit("01")), 2)))


def term_id(headword: Column, fallback: Column, term_type: Column) -> Column:
    """term:class|rel|rule:normalised headword (else the fallback); 'unknown' where no ASCII is left."""
    source = F.coalesce(present(strip(headword)), strip(fallback), F.lit(""))
    name = F.trim(F.regexp_replace(F.lower(F.regexp_replace(source, "[^a-zA-Z0-9 ]", " ")), " +", " "))
    kind = F.when(term_type == "TERM-REL", "rel").when(term_type == "TERM-RULE", "rule").otherwise("class")
    return F.concat(F.lit("term:"), kind, F.lit(":"), F.coalesce(present(F.replace(name, F.lit(" "), F.lit("_"))), F.lit("unknown")))


def is_pending(c: Column) -> Column:
    return F.coalesce(c.startswith(PENDING_PREFIX), F.lit(False))


def last_segment(c: Column) -> Column:
    return F.element_at(F.split(c, ":"), -1)


def landing_filename(headword: Column, term: Column, id_: Column) -> Column:
    """C_{HEADWORD or TERM, upper case, of [A-Za-z0-9_-]}_{last segment of the id}.json."""
    clean = lambda c: present(F.upper(F.regexp_replace(c, "[^a-zA-Z0-9_-]", "")))
    return F.concat(F.lit("C_"), F.coalesce(clean(headword), clean(term), F.lit("TEMP")), F.lit("_"), last_segment(F.coalesce(id_, F.lit("unknown"))), F.lit(".json"))


def status_filename(status: Column, id_: Column, version: Column) -> Column:
    """{C|A|M|X}_{ID}_v{version}.json by status."""
    code = F.when(status == "anchored", "A").when(status == "mature", "M").when(status == "rejected", "X").otherwise("C")
    clean = F.upper(F.regexp_replace(last_segment(F.coalesce(id_, F.lit("unknown"))), "[^a-zA-Z0-9_-]", ""))
    return F.concat(code, F.lit("_"), F.coalesce(present(clean), F.lit("UNKNOWN")), F.lit("_v"), F.coalesce(version, F.lit("1.0")), F.lit(".json"))


def fragment_key(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}_-]", "_")


def doc_status(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", "draft").when(F.lower(c) == "new", "draft").when(F.lower(c) == "changed", "partial").when(F.lower(c) == "deleted", "deprecated").otherwise("validated")


def layout_type(label: Column) -> Column:
    """The block type of a layout label; the first that is contained wins."""
    low = F.lower(label)
    return (
        F.when(low.contains("title"), "title").when(low.contains("header"), "section").when(low.contains("table"), "table")
        .when(low.contains("formula") | low.contains("equation"), "equation").when(low.contains("list"), "list").otherwise("paragraph")
    )


def stable_id(prefix: str, *parts: Column) -> Column:
    """A deterministic id of the parts, so that a repeated run gives the same rows."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 32))
