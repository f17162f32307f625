"""Text normalisation as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.fixed import LABEL_HIGH, LABEL_LOW, MIN_CHARS, SPACE, WORD

_HANGUL = "가-힣"


@functools.cache
def fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Canonical decompositions without their marks, from the Unicode database.

    Returns the one-to-one part as two aligned strings and the rest as pairs.
    Hangul syllables are left out, they follow a formula.
    """
    src, dst, longer = [], [], []
    for cp in range(0x80, 0x110000):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        d = unicodedata.normalize("NFD", c)
        if d == c:
            continue
        base = "".join(x for x in d if unicodedata.category(x) != "Mn")
        if len(base) == 1:
            src.append(c)
            dst.append(base)
        elif base:
            longer.append((c, base))
    return "".join(src), "".join(dst), tuple(longer)


def _hangul_to_jamo(c: Column) -> Column:
    def jamo(cp):
        return F.decode(F.unhex(F.hex(cp.cast("long"))), "UTF-16BE")

    def one(ch):
        s = F.conv(F.hex(F.encode(ch, "UTF-16BE")), 16, 10).cast("int") - 0xAC00
        tail = s % 28
        return F.when(
            ch.rlike(f"[{_HANGUL}]"),
            F.concat(
                jamo(F.lit(0x1100) + F.floor(s / 588)),
                jamo(F.lit(0x1161) + F.floor((s % 588) / 28)),
                F.when(tail > 0, jamo(F.lit(0x11A7) + tail)).otherwise(""),
            ),
        ).otherwise(ch)

    chars = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    return F.array_join(F.transform(chars, one), "")


def fold_marks(c: Column) -> Column:
    """NFD without non-spacing marks.  ASCII rows pass through untouched."""
    src, dst, longer = fold_tables()

    def simple(x):
        return F.regexp_replace(F.translate(x, src, dst), r"\p{Mn}+", "")

    spelled_out = _hangul_to_jamo(c)
    for one, many in longer:
        spelled_out = F.replace(spelled_out, F.lit(one), F.lit(many))
    singles = "".join(one for one, _ in longer)
    special = f"[{_HANGUL}{singles}]"
    # Most rows are settled by the two range tests, which are cheap.
    first_special = min(singles)
    return (
        F.when(~c.rlike(r"[^\x00-\x7f]"), c)
        .when(~c.rlike(f"[{first_special}-\U0010ffff]"), simple(c))
        .when(c.rlike(special), simple(spelled_out))
        .otherwise(simple(c))
    )


def strip_space(c: Column) -> Column:
    """Strip white space of every kind, not only U+0020, at both ends."""
    # Most texts begin and end with something else and are not searched.
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    return F.when(ends.rlike(rf"[{SPACE}]"), F.regexp_replace(c, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")).otherwise(c)


def collapse_space(c: Column) -> Column:
    """Runs of white space become one blank; blanks that already stand alone are not touched."""
    return F.trim(F.regexp_replace(c, rf" [{SPACE}]+|[{SPACE}&&[^ ]][{SPACE}]*", " "))


def strip_punctuation(c: Column) -> Column:
    # Letters, digits and blanks of ASCII come first because the test stops there.
    return F.regexp_replace(c, rf"[^a-zA-Z0-9 {WORD}{SPACE}]+", "")


def normalize_text(c: Column) -> Column:
    """Fold marks, lower case, drop punctuation, collapse white space."""
    return collapse_space(strip_punctuation(F.lower(fold_marks(c))))


def flatten_lines(c: Column) -> Column:
    return strip_space(F.translate(c, "\n\r", "  "))


def not_blank(c: Column) -> Column:
    return c.rlike(rf"[^{SPACE}]")


def long_enough(c: Column, chars: int = MIN_CHARS) -> Column:
    return F.length(c) >= chars


def label_of(c: Column) -> Column:
    """``high`` or ``low`` for a labelled line, null for a plain one."""
    s = strip_space(c)
    return F.when(s.startswith(LABEL_HIGH), "high").when(s.startswith(LABEL_LOW), "low")


def strip_label(c: Column) -> Column:
    prefix = rf"\A(?:{re.escape(LABEL_HIGH)}|{re.escape(LABEL_LOW)})"
    s = strip_space(c)
    return F.when(label_of(c).isNotNull(), F.regexp_replace(s, prefix, "")).otherwise(s)


def one_line(c: Column) -> Column:
    """Form a document takes in a one-document-per-line file."""
    return F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))
