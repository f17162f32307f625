"""Operator 7: removal of repeated byte strings with suffixes sorted block by block.

Every string of ``LENGTH`` bytes belongs to the bucket named by the smallest hash
of the k-grams inside it, so equal strings are in the same bucket wherever they
stand.  Neighbouring strings of a document with the same bucket form a context.

1. Contexts that are equal as a whole are settled by their hash: all but the
   first are covered.  Each task does so for what it has read before anything is
   shuffled, so a passage found everywhere reaches a bucket once for each task.
2. Where a bucket has several contexts, or one that may repeat within itself, the
   suffixes at its strings are sorted.  Buckets are sorted one block at a time:
   by a short prefix, and long ties by the ranks of a difference-cover sample of
   the block's suffixes, which are computed first.  Neighbours in this order that
   agree in ``LENGTH`` bytes are the same string.
3. A bucket with very many contexts is split by the whole string.

Memory is bounded by the block, not by the bucket, the corpus or the ties.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.chunks import give_back
from textloom.session import BROADCAST_ROWS, materialize

LENGTH = 100
GRAM = 24
# Strings of one context, at most; a longer run is several contexts.
CONTEXT = 512
# Contexts a task settles among themselves at a time, and bytes of text sorted at a time.
TASK_CONTEXTS = 40_000
BLOCK_BYTES = 1_000_000
# A bucket with more contexts than this is split by the whole string.
CROWDED = 2000
# All differences modulo 13 occur between two of these.
PERIOD, COVER = 13, (0, 1, 3, 9)
SORT, COVERED, SPLIT = 0, 1, 2
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


# --- contexts -------------------------------------------------------------------------


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * _B
    h ^= h >> np.uint64(32)
    h += b
    h *= _C
    return h


def gram_hashes(x: np.ndarray, k: int = GRAM) -> np.ndarray:
    """A hash of every k-gram of bytes, put together from those of powers of two."""
    h, size = (x.astype(np.uint64) + np.uint64(1)) * _A, 1
    out, done = None, 0
    while size <= k:
        if k & size:
            n = len(h) - done
            out = h if out is None else _joined(out[:n], h[done:done + n])
            done += size
        h = _joined(h[:-size], h[size:])
        size *= 2
    out = out[:len(x) - k + 1]
    return out ^ out >> np.uint64(29)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (n - size)], x[n - size:]) if n > size else x


def contexts(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, content hash, first string, number of strings and "may repeat within" of each context."""
    x = np.frombuffer(raw, np.uint8)
    width = LENGTH - GRAM + 1
    gram = gram_hashes(x)
    low = sliding_min(gram, width)
    begin = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    size = np.diff(np.r_[begin, len(low)])
    if size.max() > CONTEXT:
        pieces = -(-size // CONTEXT)
        part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(begin, pieces) + part * CONTEXT
        size = np.minimum(np.repeat(size, pieces) - part * CONTEXT, CONTEXT)
    bucket = low[begin]
    # The smallest grams of all strings; two equal ones close by mean that a string may repeat nearby.
    spread = np.r_[np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]
    best = ~sliding_min(~spread, width)
    at = np.flatnonzero(gram == best)
    twice = (gram[at[1:]] == gram[at[:-1]]) & (np.diff(at) <= width)
    again = np.isin(bucket, gram[at[1:][twice]]) if twice.any() else np.zeros(len(bucket), bool)
    digest = xxhash.xxh3_64_intdigest
    content = np.fromiter((digest(raw[a:a + n + LENGTH - 1]) for a, n in zip(begin.tolist(), size.tolist())), np.uint64, len(begin))
    return bucket.view(np.int64), content.view(np.int64), begin, size, again


CONTEXTS = "kind int, bucket long, content long, doc_id long, start int, n int, again boolean"
_NAMES = ("kind", "bucket", "content", "doc_id", "start", "n", "again")
_KINDS = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())


def _batch(kind, bucket, content, doc, start, n, again) -> pa.RecordBatch:
    columns = (np.full(len(doc), kind, np.int32) if np.isscalar(kind) else kind, bucket, content, doc, start, n, again)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], list(_NAMES))


def _text_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        for i, t in zip(batch.column(0), batch.column(1)):
            raw = (t.as_py() or "").encode("utf-8", "replace")
            if len(raw) >= LENGTH:
                c = contexts(raw)
                held.append((*c, np.full(len(c[0]), i.as_py(), np.int64)))
                n += len(c[0])
            if n >= TASK_CONTEXTS:
                yield _settled(held)
                held, n = [], 0
    if held:
        yield _settled(held)
    held.clear()
    give_back()


def _settled(held: list[tuple]) -> pa.RecordBatch:
    """All contexts of a task; those equal to an earlier one are covered."""
    bucket, content, start, n, again, doc = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((start, doc, content, bucket))
    bucket, content, start, n, again, doc = (c[order] for c in (bucket, content, start, n, again, doc))
    same = np.r_[False, (bucket[1:] == bucket[:-1]) & (content[1:] == content[:-1])]
    # Rows that stand there twice are the same occurrence; it is kept once.
    once = ~(same & np.r_[False, (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])])
    bucket, content, start, n, again, doc, same = (c[once] for c in (bucket, content, start, n, again, doc, same))
    # What is settled is dealt out by document.
    bucket = np.where(same, doc, bucket)
    return _batch(np.where(same, COVERED, SORT).astype(np.int32), bucket, content, doc, start, n, again)


def _crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts in order of bucket and content: what is covered, and what must be sorted.

    Only the contexts of the bucket that a batch ends in are carried on, up to
    ``CROWDED`` of them; then they are sent on and one stays to compare with.
    """
    carry, sent = None, False
    for batch in batches:
        c = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
        done = c[0] == COVERED
        if done.any():
            yield _batch(COVERED, *(x[done] for x in c[1:]))
        rows = [x[~done] for x in c[1:]]
        if not len(rows[0]):
            continue
        kept = 0 if carry is None else len(carry[0])
        rows = rows if carry is None else [np.concatenate(x) for x in zip(carry, rows)]
        bucket, content, doc, start = rows[:4]
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (content[1:] != content[:-1])]
        # Rows that stand there twice are the same occurrence and cover nothing.
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        repeated = ~new & ((doc != doc[first]) | (start != start[first]))
        if repeated.any():
            yield _batch(COVERED, *(x[repeated] for x in rows))
        fresh = np.ones(len(new), bool)
        fresh[:kept] = not sent
        fresh, rows = fresh[new], [x[new] for x in rows]
        last = rows[0][-1]
        carried_on = sent and rows[0][0] == last
        yield from _to_sort([x[rows[0] != last] for x in rows], fresh[rows[0] != last], rows[0][0] if sent else None)
        tail = rows[0] == last
        carry, fresh, sent = [x[tail] for x in rows], fresh[tail], carried_on
        if sent or len(carry[0]) > CROWDED:
            if fresh.any():
                yield _batch(SPLIT, *(x[fresh] for x in carry))
            carry, sent = [x[-1:] for x in carry], True
    if carry is not None and not sent:
        yield from _to_sort(carry, np.ones(len(carry[0]), bool), None)


def _to_sort(rows: list[np.ndarray], fresh: np.ndarray, split_bucket) -> Iterator[pa.RecordBatch]:
    """Whole buckets with anything to compare."""
    if not len(fresh):
        return
    begin = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
    size = np.diff(np.r_[begin, len(fresh)])
    many = np.repeat((size > 1) | np.logical_or.reduceat(rows[5], begin), size) & fresh
    split = np.repeat(size > CROWDED, size)
    if split_bucket is not None:
        split |= rows[0] == split_bucket
    for kind, which in ((SORT, many & ~split), (SPLIT, fresh & split)):
        if which.any():
            yield _batch(kind, *(x[which] for x in rows))


# --- text of the contexts -------------------------------------------------------------

SEGMENTS = "kind int, bucket long, doc_id long, start int, n int, segment binary"
_SEGMENT_NAMES = ("kind", "bucket", "doc_id", "start", "n", "segment")


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted contexts; those to be split give a row for each string, equal ones once."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            yield _segments(batch.slice(at, 500))


def _segments(batch: pa.RecordBatch) -> pa.RecordBatch:
    out, strings = [], []
    for i, t, wanted in zip(*(batch.column(k) for k in range(3))):
        i, raw = i.as_py(), (t.as_py() or "").encode("utf-8", "replace")
        for w in wanted.as_py():
            a, n = w["start"], w["n"]
            if w["kind"] == SORT:
                out.append((SORT, w["bucket"], i, a, n, raw[a:a + n + LENGTH - 1]))
            else:
                for p in range(a, a + n):
                    s = raw[p:p + LENGTH]
                    key = xxhash.xxh3_64_intdigest(s)
                    strings.append((key - (1 << 64) if key >> 63 else key, s, i, p))
    before = None
    # A document read twice gives the same strings again; each occurrence counts once.
    for key, s, i, p in sorted(set(strings)):
        same = before is not None and before == s
        out.append((COVERED, i, i, p, 1, b"") if same else (SORT, key, i, p, 1, s))
        before = s
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*out)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(_SEGMENT_NAMES))


# --- sorting a block ------------------------------------------------------------------


def cover_shifts(period: int = PERIOD, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """For two residues, a shift that brings both into the cover."""
    inside = np.isin(np.arange(2 * period) % period, cover)
    a, b = np.indices((period, period))
    both = np.stack([inside[a + d] & inside[b + d] for d in range(period)])
    assert both.any(axis=0).all(), "not a difference cover"
    return both.argmax(axis=0)


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks by the keys, the first counting most; equal ones have the same."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def sort_block(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions ``at`` of a text of bytes in the order of their suffixes.

    The text must end in ``PERIOD`` * 16 bytes of padding.  Order and ties are
    those of the first ``LENGTH`` bytes or more.
    """
    words = _words(text)
    where = np.arange(len(words))
    sample = np.flatnonzero(np.isin(where % PERIOD, COVER))
    # Ranks of the sample suffixes by their first PERIOD bytes, doubled until they reach LENGTH.
    rank = _dense(words[sample], words[np.minimum(sample + PERIOD - 8, len(words) - 1)])
    number = np.full(len(words) + PERIOD * 32, -1)
    number[sample] = np.arange(len(sample))
    reach = PERIOD
    while reach < LENGTH:
        after = number[sample + reach]
        rank = _dense(rank << 32 | np.where(after >= 0, rank[after] + 1, 0))
        reach *= 2
    # All suffixes by a prefix as long as the period; then ties by a pivot and the sample's ranks.
    first, second = words[at], words[at + PERIOD - 8]
    order = np.lexsort((second, first))
    at, first, second = at[order], first[order], second[order]
    group = np.cumsum(np.r_[False, (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
    shifts, open_at = cover_shifts(), _in_company(group, np.ones(len(at), bool))
    out = at.copy()
    while len(open_at):
        some, g = out[open_at], group[open_at]
        begin = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        size = np.diff(np.r_[begin, len(g)])
        pivot = np.repeat(some[begin + size // 2], size)
        shift = shifts[pivot % PERIOD, some % PERIOD]
        sign = np.sign(rank[number[some + shift]] - rank[number[pivot + shift]])
        order = np.lexsort((sign, g))
        out[open_at], sign = some[order], sign[order]
        # Numbers of groups only have to differ between neighbours; equal ones are settled.
        parts = np.cumsum(np.r_[False, (g[1:] != g[:-1]) | (sign[1:] != sign[:-1])])
        group[open_at] = parts
        open_at = open_at[_in_company(parts, sign != 0)]
    return out


def _in_company(group: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Indices of chosen elements whose group has more than one."""
    same = group[1:] == group[:-1]
    return np.flatnonzero(which & (np.r_[False, same] | np.r_[same, False]))


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, first byte highest."""
    n = len(text) - 8
    w = np.zeros(n, np.uint64)
    for k in range(8):
        w |= text[k:k + n].astype(np.uint64) << np.uint64(56 - 8 * k)
    return w


def repeated_strings(segments: list[bytes], doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and start of every string of the segments that also starts earlier."""
    size = np.array([len(s) for s in segments], np.int64)
    text = np.frombuffer(b"".join(segments) + bytes(PERIOD * 16), np.uint8)
    offset = np.cumsum(size) - size
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(offset, n) + inner
    owner = np.full(len(text), -1)
    owner[place] = np.repeat(np.arange(len(segments)), n)
    at = sort_block(text, place)
    words = _words(text)
    new = np.zeros(len(at), bool)
    new[:1] = True
    for k in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        w = words[at + k]
        new[1:] |= w[1:] != w[:-1]
    seg = owner[at]
    d, p, group = doc[seg], start[seg] + at - offset[seg], np.cumsum(new)
    order = np.lexsort((p, d, group))
    d, p, group = d[order], p[order], group[order]
    first = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], np.arange(len(group)), 0))
    later = (d != d[first]) | (p != p[first])
    return d[later], p[later]


COVERS = "doc_id long, start int, stop int"


def _covers(doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Runs of covered strings as spans."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)] if len(doc) else np.zeros(0, bool)
    end = np.r_[new[1:], True] if len(doc) else new
    return pa.RecordBatch.from_arrays([pa.array(doc[new], pa.int64()), pa.array(start[new], pa.int32()),
                                       pa.array(start[end] + LENGTH, pa.int32())], ["doc_id", "start", "stop"])


def _sorted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of buckets; whole buckets are gathered to a block and sorted."""
    held, size = [], 0
    for batch in batches:
        rows = list(zip(*(batch.column(k).to_pylist() for k in range(6))))
        done = [r for r in rows if r[0] == COVERED]
        if done:
            doc, start = (np.array([r[k] for r in done], np.int64) for k in (2, 3))
            yield _covers(doc, start)
        for r in rows:
            if r[0] == COVERED:
                continue
            if size >= BLOCK_BYTES and held[-1][1] != r[1]:
                yield _block(held)
                held, size = [], 0
            held.append(r)
            size += len(r[5])
    if held:
        yield _block(held)


def _block(held: list[tuple]) -> pa.RecordBatch:
    doc, start, n = (np.array([r[k] for r in held], np.int64) for k in (2, 3, 4))
    return _covers(*repeated_strings([r[5] for r in held], doc, start, n))


# --- the whole ------------------------------------------------------------------------


def covered_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: the byte spans covered by strings that also start earlier, merged, by document."""
    docs = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    crowds = materialize(
        docs.mapInArrow(_text_contexts, CONTEXTS).repartition("bucket")
        .sortWithinPartitions("bucket", "content", "doc_id", "start").mapInArrow(_crowds, CONTEXTS), "contexts")
    wanted = crowds.filter(F.col("kind") != COVERED).groupBy("doc_id").agg(
        F.collect_list(F.struct("kind", "bucket", "start", "n")).alias("wanted"))
    segments = docs.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(_cut_out, SEGMENTS)
    found = segments.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "start").mapInArrow(_sorted_blocks, COVERS)
    whole = crowds.filter(F.col("kind") == COVERED).select(
        "doc_id", "start", (F.col("start") + F.col("n") + LENGTH - 1).alias("stop"))
    spans = found.unionByName(whole).groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return materialize(spans.mapInArrow(_merged, "doc_id long, spans array<struct<start:int,stop:int>>"), "spans")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans in order with those that overlap or touch made one; all documents of a batch in one sort."""
    for batch in batches:
        lists = batch.column(1)
        doc = np.repeat(np.arange(len(lists), dtype=np.int64), lists.value_lengths().to_numpy(zero_copy_only=False))
        # Places of different documents lie further apart than a text is long.
        start, stop = ((doc << 32) + c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
        order = np.argsort(start, kind="stable")
        start, stop = start[order], np.maximum.accumulate(stop[order])
        first, last = np.ones(len(start), bool), np.ones(len(start), bool)
        first[1:] = last[:-1] = start[1:] > stop[:-1]
        start, stop = start[first], stop[last]
        ends = np.searchsorted(start >> 32, np.arange(len(lists) + 1)).astype(np.int32)
        places = [pa.array((c & 0xFFFFFFFF).astype(np.int32)) for c in (start, stop)]
        spans = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(places, ["start", "stop"]))
        yield pa.RecordBatch.from_arrays([batch.column(0), spans], ["doc_id", "spans"])


def _with_spans(docs: DataFrame) -> DataFrame:
    spans = covered_spans(docs)
    size = spans.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("spans")).alias("spans")).first()
    # Sent to all only below a number of documents and of spans, of eight bytes each.
    few = size["docs"] <= BROADCAST_ROWS and (size["spans"] or 0) <= 4 * BROADCAST_ROWS
    return docs.join(F.broadcast(spans) if few else spans, "doc_id", "left")


def kept_bytes(raw: bytes, spans: list[dict]) -> bytes:
    stops = [0, *(s["stop"] for s in spans)]
    return b"".join(raw[a:b] for a, b in zip(stops, [*(s["start"] for s in spans), len(raw)]))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each row.

    Null and empty texts have no bytes.  A document is known by its id: rows that
    repeat one must be equal and get equal results.  Rows without an id neither
    cover anything nor lose anything; an empty table gives no rows; other columns
    are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, s in zip(batch.column(1), batch.column(2)):
                raw, spans = (t.as_py() or "").encode("utf-8", "replace"), s.as_py() or []
                kept = kept_bytes(raw, spans)
                rows.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_spans(docs.select("doc_id", "text")).select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame) -> DataFrame:
    """``docs`` with the covered bytes cut out of ``text``; halves of cut characters go too, null texts stay null."""
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, s in zip(batch.column(at), batch.column(len(names))):
                text, spans = t.as_py(), s.as_py()
                texts.append(text if not spans else kept_bytes(text.encode("utf-8", "replace"), spans).decode("utf-8", "ignore"))
            columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return _with_spans(docs).select(*names, "spans").mapInArrow(run, docs.schema)
