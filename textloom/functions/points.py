"""Normalisation and quality statistics of texts by a table of code points, as Arrow kernels.

The tables are what the JVM expressions say of each code point (``normalize_text``,
the character classes), asked once for a process.  Regular expressions look at
every character several times; a kernel looks each one up once.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from textloom.fixed import SPACE
from textloom.functions.text import fold_tables, normalize_text

POINTS = 0x110000
# What a normalised text holds for a code point: nothing, itself or another one, or several (from MANY on).
NOTHING, MANY = 0, POINTS
# Classes of code points for tokens, in this order.
BLANK, OTHER, JOINER, DOT, NUMBER, LETTER = range(6)
# The only letter whose lower case depends on those around it.
SIGMA = "Σ"


@functools.cache
def _tables() -> tuple[bytes, tuple[str, ...], bytes]:
    """Packed code points of normalised texts, the longer ones, and packed classes."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()

    def asked(texts: list[str], **columns: Column) -> dict[str, list[str]]:
        rows = spark.createDataFrame(pa.table({"id": range(len(texts)), "text": texts}))
        return rows.select("id", *[c.alias(name) for name, c in columns.items()]).toArrow().sort_by("id").to_pydict()

    def only(chars: str) -> Column:
        return F.regexp_replace("text", rf"[^{chars}]+", "")

    points = [p for p in range(POINTS) if not 0xD800 <= p <= 0xDFFF]
    blocks = ["".join(map(chr, points[at:at + 4096])) for at in range(0, len(points), 4096)]
    found = asked(blocks, blanks=only(SPACE), letters=only(r"\p{L}"), numbers=only(r"\p{N}_"))
    kinds = np.full(POINTS, OTHER, np.uint8)
    for kind, chars in ((BLANK, found["blanks"]), (LETTER, found["letters"]), (NUMBER, found["numbers"]), (JOINER, "-,'’"), (DOT, ".")):
        kinds[[ord(c) for c in "".join(chars)]] = kind
    # Others are dropped, but those that become something else before.
    singles, _, longer = fold_tables()
    folded = {*map(ord, singles), *[ord(one) for one, _ in longer]}
    others = [p for p in points if OTHER <= kinds[p] < NUMBER]
    lines = [" ".join(map(chr, others[at:at + 4096])) for at in range(0, len(others), 4096)]
    lower = " ".join(asked(lines, lower=F.lower("text"))["lower"]).split(" ")
    kept = [p for p in points if kinds[p] >= NUMBER] + [
        p for p, low in zip(others, lower, strict=True) if p in folded or low != chr(p)]
    # A word for each, so that it stands between two letters.
    lines = [" ".join(f"a{chr(p)}a" for p in kept[at:at + 1024]) for at in range(0, len(kept), 1024)]
    words = " ".join(asked(lines, normal=normalize_text(F.col("text")))["normal"]).split(" ")
    to, several = np.zeros(POINTS, np.int32), []
    to[kinds == BLANK] = ord(" ")
    for point, word in zip(kept, words, strict=True):
        many = word[1:-1]
        if len(many) > 1:
            to[point] = MANY + len(several)
            several.append(many)
        elif many:
            to[point] = ord(many)
    # Most letters stand for themselves, so differences are packed well.
    moved = np.where(to == NOTHING, -POINTS, to - np.arange(POINTS, dtype=np.int32))
    return zlib.compress(moved.astype("<i4").tobytes()), tuple(several), zlib.compress(kinds.tobytes())


def normalize_by_table(c: Column) -> Column:
    """``normalize_text`` as an Arrow kernel.

    Texts with a capital sigma are left to the expression.
    """
    packed, longer, _ = _tables()
    points, many, held = POINTS, MANY, []

    def tables():
        # Unpacked once by each task.
        if not held:
            moved = np.frombuffer(zlib.decompress(packed), "<i4")
            to = np.where(moved == -points, 0, moved + np.arange(points, dtype=np.int32)).astype(np.uint32)
            ascii_to = bytes(int(t) if t < 128 else 0 for t in to[:256])
            held.append((to, ascii_to, bytes(i for i in range(128) if not to[i])))
        return held[0]

    def normal(line, to, ascii_to, dropped):
        if line.isascii():
            return b" ".join(line.translate(ascii_to, dropped).split())
        found = to[np.frombuffer(line.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)]
        found = found[found > 0]
        if len(found) and found.max() >= many:
            text = "".join([longer[p - many] if p >= many else chr(p) for p in found.tolist()])
        else:
            text = found.tobytes().decode("utf-32-le")
        return " ".join(text.split()).encode()

    @F.arrow_udf("string")
    def kernel(texts: pa.Array) -> pa.Array:
        # One text at a time is a Python object, not those of a whole batch.
        to, ascii_to, dropped = tables()
        out, ends = bytearray(), np.zeros(len(texts) + 1, np.int32)
        for at, text in enumerate(texts.cast(pa.large_binary()), 1):
            line = text.as_py()
            if line:
                out += normal(line, to, ascii_to, dropped)
            ends[at] = len(out)
        valid = pc.is_valid(texts).buffers()[1] if texts.null_count else None
        return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(out), valid)

    return F.when(F.contains(c, F.lit(SIGMA)), normalize_text(c)).otherwise(kernel(c))


def token_statistics(c: Column) -> Column:
    """``n_words, chars, ellipses, lines, alpha``: numbers of tokens, of their characters, of lines
    ending in an ellipsis, of lines, and of tokens with a letter.

    Tokens are those of ``fixed.WORD_TOKEN``: letters and numbers, which a single
    joiner between two of them does not part, three dots, or any other character.
    """
    packed, held = _tables()[2], []
    blank, joiner, dot, number, letter = BLANK, JOINER, DOT, NUMBER, LETTER

    def count(line, kinds):
        at = np.frombuffer(line if line.isascii() else line.decode("utf-8", "replace").encode("utf-32-le"),
                           np.uint8 if line.isascii() else np.uint32)
        kind = kinds[at]
        word = kind >= number
        if len(kind) > 2:
            mid = kind[1:-1]
            parts = np.flatnonzero((mid == joiner) | (mid == dot)) + 1
            word[parts[(kind[parts - 1] >= number) & (kind[parts + 1] >= number)]] = True
        starts = word.copy()
        starts[1:] &= ~word[:-1]
        starts = np.flatnonzero(starts)
        chars = np.count_nonzero(kind != blank)
        others = chars - np.count_nonzero(word)
        dots = np.flatnonzero((kind == dot) & ~word) if others else ()
        if len(dots):
            runs = np.diff(np.flatnonzero(np.diff(dots, prepend=-2, append=dots[-1] + 2) > 1))
            others -= int((runs // 3 * 2).sum())
        alpha = np.count_nonzero(np.maximum.reduceat(kind, starts) == letter) if len(starts) else 0
        return len(starts) + others, chars, line.count(b"...\n") + line.endswith(b"..."), line.count(b"\n") + 1, alpha

    @F.arrow_udf("n_words long, chars long, ellipses long, lines long, alpha long")
    def kernel(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(np.frombuffer(zlib.decompress(packed), np.uint8))
        out = np.zeros((len(texts), 5), np.int64)
        for row, text in zip(out, texts.cast(pa.large_binary())):
            line = text.as_py()
            row[:] = count(line, held[0]) if line else (0, 0, 0, 1, 0)
        missing = pc.is_null(texts).to_numpy(zero_copy_only=False)
        names = ["n_words", "chars", "ellipses", "lines", "alpha"]
        return pa.StructArray.from_arrays([pa.array(v, mask=missing) for v in out.T], names=names)

    return kernel(c)
