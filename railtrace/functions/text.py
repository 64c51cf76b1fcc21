"""Station-name text rules as native Column expressions (no Python per row).

normalize_text      SCL1  lower, NFKD, drop non-ASCII, [^a-z0-9 ] -> space, collapse
simplify_station    SCL2  drop filler words, capitalize words except small ones
title_case_station  SCL6  Python ``str.title`` on stripped text
strip_stars         SCL8  remove literal '*', strip
to_number           SCL9  text -> double, bad text -> null
py_strip                  Python ``str.strip`` (Unicode white space)

The NFKD folding table is derived from :mod:`unicodedata` at first use, so it
follows the running Python's Unicode version and covers every code point.
Single-character foldings go into one ``translate`` call.  Characters that fold
to several (``½`` -> ``12``, ``ĳ`` -> ``ij``, ``⑩`` -> ``10``) are
looked up one by one in a literal map, which only runs on strings that hold
such a character.
"""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from railtrace.functions._memo import memo_column

# Fixed values (must equal the reference's rules).
SIMPLIFY_REMOVED_WORDS = ["bf", "hbf", "tief", "bad", "gare", "routiere"]
SIMPLIFY_SMALL_WORDS = ["de", "du", "des", "la", "le", "les", "d'", "l'", "à"]
ROUTE_ARROW = " → "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode white space."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


# Characters of these blocks that fold to nothing (``ß``, ``ø``, combining
# marks, curly quotes, dashes) are deleted by the same ``translate`` call; any
# other non-ASCII character is dropped by a regex that only runs on strings
# still holding one.  Kept small: the table is a literal in every plan.
_DELETE_BLOCKS = [(0x80, 0x36F), (0x1E00, 0x1EFF), (0x2000, 0x206F)]


def _ranges_class(chars) -> str:
    """A Java regex character class for ``chars``, written as ranges."""
    cps = sorted(ord(c) for c in chars)
    parts, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        lo, hi = cps[i], cps[j]
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
        i = j + 1
    return "[" + "".join(parts) + "]"


@functools.lru_cache(maxsize=1)
def _fold_tables():
    """Per code point: ASCII residue of NFKD(lower(ch)) after the class rule.

    Returns (translate_from, translate_to, multi, multi_class):
    ``translate_from`` lists single-character foldings (mapped to
    ``translate_to``) followed by characters to delete; ``multi`` maps the
    characters that fold to several, and ``multi_class`` matches them.
    """
    src, dst, delete = [], [], []
    multi: dict[str, str] = {}
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if cp < 0x80:
            out = ch.lower()
        else:
            out = "".join(c for c in unicodedata.normalize("NFKD", ch.lower()) if c < "\x80")
            if not out:
                if any(lo <= cp <= hi for lo, hi in _DELETE_BLOCKS):
                    delete.append(ch)
                continue  # anything else non-ASCII is dropped by the regex step
        out = re.sub(r"[^a-z0-9 ]", " ", out)
        out = re.sub(r" +", " ", out)  # runs of spaces collapse later anyway
        if len(out) == 1:
            if out != ch:
                src.append(ch)
                dst.append(out)
        else:
            multi[ch] = out
    return "".join(src + delete), "".join(dst), multi, _ranges_class(multi)


@memo_column
def normalize_text(c) -> Column:
    """SCL1: lower case, compatibility folding to ASCII, anything but letters
    and digits to a space, spaces collapsed.  null/blank -> ''.

    One ``translate`` does the case folding, accent stripping, punctuation ->
    space and the deletion of common non-ASCII characters; the multi-character
    expansions and the final non-ASCII drop only run on strings that still
    hold a non-ASCII character afterwards."""
    src, dst, multi, multi_class = _fold_tables()
    s = F.translate(_col(c), src, dst)
    folded = F.create_map(*[F.lit(x) for pair in multi.items() for x in pair])
    characters = F.regexp_extract_all(s, F.lit("(?s)."), 0)
    expanded = F.array_join(F.transform(characters, lambda x: F.coalesce(F.element_at(folded, x), x)), "")
    rare = F.when(s.rlike(multi_class), expanded).otherwise(s)
    rare = F.regexp_replace(rare, r"[^\x00-\x7F]+", "")
    s = F.when(s.rlike(r"[^\x00-\x7F]"), rare).otherwise(s)
    s = F.trim(F.regexp_replace(s, r" {2,}", " "))
    return F.coalesce(s, F.lit(""))


@memo_column
def simplify_station(c) -> Column:
    """SCL2: for display.  Input is normalized text."""
    s = F.lower(py_strip(c))
    s = F.regexp_replace(s, r"(?U)\b(" + "|".join(SIMPLIFY_REMOVED_WORDS) + r")\b", "")
    s = py_strip(F.regexp_replace(s, r"(?U)\s+", " "))
    small = F.array(*[F.lit(w) for w in SIMPLIFY_SMALL_WORDS])
    words = F.transform(
        F.split(s, " "),
        lambda w: F.when(F.array_contains(small, w), w).otherwise(F.initcap(w)),
    )
    return F.coalesce(F.array_join(words, " "), F.lit(""))


_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"


@memo_column
def title_case_station(c) -> Column:
    """SCL6: ``'' if not s else s.strip().title()`` -- a letter is upper-cased
    when it follows a non-cased character (``2b`` -> ``2B``), unlike initcap."""
    runs = F.regexp_extract_all(py_strip(c), F.lit(f"[{_CASED}]+|[^{_CASED}]+"), 0)
    return F.coalesce(F.array_join(F.transform(runs, F.initcap), ""), F.lit(""))


def strip_stars(c) -> Column:
    """SCL8: remove every literal '*' and strip."""
    return py_strip(F.replace(_col(c), F.lit("*"), F.lit("")))


_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(c) -> Column:
    """SCL9: numeric text -> double; anything else (``n/a``, ``1,5``) -> null."""
    t = py_strip(_col(c).cast("string"))
    return F.when(t.rlike(_NUMBER), t.try_cast("double"))


def route_label(a, b) -> Column:
    """``a → b`` (U+2192 with spaces), as in route names."""
    if isinstance(a, str) and isinstance(b, str):
        return F.expr(f"concat(`{a}`, '{ROUTE_ARROW}', `{b}`)")
    return F.concat(_col(a), F.lit(ROUTE_ARROW), _col(b))


def is_blank(c) -> Column:
    """null, or empty after Spark ``trim`` (spaces only)."""
    if isinstance(c, str):
        return F.expr(f"`{c}` IS NULL OR trim(`{c}`) = ''")
    return c.isNull() | (F.trim(c) == "")
