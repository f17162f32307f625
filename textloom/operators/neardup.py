"""Near-duplicate removal: shingles, MinHash, LSH buckets, exact Jaccard.

Two documents are linked when they share an LSH bucket and the Jaccard similarity
of their shingle sets reaches the threshold; clusters are the connected components
of the links, and the smallest id of a cluster is kept.

Clusters are found without listing the pairs of a bucket:

1. Documents with the same words in the same order have the same shingles.  One
   grouping, partially aggregated, leaves one representative for each text, so
   a third of the corpus being copies of one page is one row from here on.
2. In each bucket some members are drawn as hubs, about ``hubs`` of them, and
   every member is compared with the hubs only.  Verified links join components.
3. A hub has then met every member, and leaves.  A bucket whose members are all
   in one component is finished.  The others go on with new hubs, twice as many
   each time, until nobody is left, so every pair that could still join two
   components is compared in the end and the result is exact.
4. Buckets that are still large after a round are divided, again and again as
   long as that halves the pairs: two sets that reach the threshold share one of
   their rarest shingles (prefix filtering), the fewer the closer their sizes are,
   so only members of two length classes that share such a shingle stay together.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from hashlib import md5
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom import fixed
from textloom.functions.text import collapse_space
from textloom.operators.components import connected_components
from textloom.operators.keep import keep
from textloom.operators.lookup import join_by_count, leave_out, lookup, pick
from textloom.session import materialize

HUBS = 32
EMPTY_HASH = 2**63 - 1
ROWS_PER_TASK = 1_000_000
CLASSES = 8    # length classes from a set to the smallest that can reach the threshold with it


# --- shingles and signatures --------------------------------------------------

def word_ngrams(c: Column, n: int = fixed.NGRAM) -> Column:
    """Distinct word n-grams; all words as one when there are fewer than n."""
    words = F.filter(F.split(collapse_space(c), " "), lambda w: w != "")

    def grams(w):
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1)))
        every = F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(every))

    # Going through a one-element array binds the words to a variable; named in the
    # inner function directly, they would be split again for every n-gram.
    return F.transform(F.array(words), grams)[0]


def _cutter(n: int) -> Callable[[str | None], set[bytes]]:
    """Function for ``word_ngrams`` of a text whose white space is collapsed: its parts from one blank to the n-th after it.

    It is made here, so that workers get it with the kernel that uses it.
    """
    def cut(text):
        if not text:
            return set()
        line = text.encode()
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()
        if len(blanks) < n:
            return {line}
        return {line[at:to] for at, to in zip([0, *[b + 1 for b in blanks]], [*blanks, len(line)][n - 1:])}

    return cut


def _first_bits() -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Function for the first 32 bits of the MD5 of many pieces of ``data`` at once.

    ``data`` goes on for 64 bytes after the last piece.  A piece of up to 55 bytes is
    one block of MD5, and the steps of the blocks are done side by side; longer pieces go one by one.
    """
    steps = np.array([int(abs(math.sin(i + 1)) * 2**32) for i in range(64)], np.uint32)
    turns = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
    order = [*range(16), *[(5 * i + 1) % 16 for i in range(16)], *[(3 * i + 5) % 16 for i in range(16)], *[7 * i % 16 for i in range(16)]]
    start, most = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476), 55
    inside = np.where(np.arange(64) < np.arange(most + 1)[:, None], 255, 0).astype(np.uint8)
    single = md5

    def first_bits(data, starts, ends):
        sizes = ends - starts
        short = np.minimum(sizes, most)
        blocks = np.lib.stride_tricks.sliding_window_view(data, 64)[starts]
        blocks &= inside[short]
        blocks[np.arange(len(blocks)), short] = 128
        words = np.ascontiguousarray(blocks.view("<u4").T)
        words[14] = short * 8
        a, b, c, d = (np.full(len(starts), v, np.uint32) for v in start)
        f, t = np.empty_like(a), np.empty_like(a)
        for i in range(64):
            if i < 16:
                f = np.bitwise_xor(np.bitwise_and(np.bitwise_xor(c, d, out=f), b, out=f), d, out=f)
            elif i < 32:
                f = np.bitwise_xor(np.bitwise_and(np.bitwise_xor(b, c, out=f), d, out=f), c, out=f)
            elif i < 48:
                f = np.bitwise_xor(np.bitwise_xor(b, c, out=f), d, out=f)
            else:
                f = np.bitwise_xor(np.bitwise_or(np.invert(d, out=f), b, out=f), c, out=f)
            for term in (a, steps[i], words[order[i]]):
                np.add(f, term, out=f)
            np.left_shift(f, np.uint32(turns[i]), out=t)
            np.bitwise_or(np.right_shift(f, np.uint32(32 - turns[i]), out=f), t, out=f)
            np.add(f, b, out=f)
            a, d, c, b, f = d, c, b, f, a
        out = (a + np.uint32(start[0])).byteswap()
        for at in np.flatnonzero(sizes > most).tolist():
            out[at] = int.from_bytes(single(data[starts[at]:ends[at]]).digest()[:4], "big")
        return out

    return first_bits


def shingle_hash(shingle: Column) -> Column:
    """The first 32 bits of MD5 as a number."""
    return F.conv(F.substring(F.md5(shingle.cast("binary")), 1, 8), 16, 10).cast("long")


def hash_family(k: int = fixed.NUM_HASHES, seed: int = fixed.HASH_SEED) -> tuple[list[int], list[int]]:
    """Factors and offsets of k hash functions, reproducible from the seed."""
    draw = random.Random(seed)
    p = fixed.HASH_PRIME
    factors = [draw.randint(1, p - 1) for _ in range(k)]
    return factors, [draw.randint(0, p - 1) for _ in range(k)]


def minhash(c: Column, k: int = fixed.NUM_HASHES, n: int = fixed.NGRAM, seed: int = fixed.HASH_SEED) -> Column:
    """MinHash signature of the shingles of a text, as an Arrow kernel.

    Only the text travels to Python, and only the signature comes back.
    """
    return _signatures(collapse_space(c), k, n, seed)


def _signatures(words: Column, k: int, n: int, seed: int = fixed.HASH_SEED) -> Column:
    """``minhash`` of texts whose white space is collapsed."""
    factors, offsets = hash_family(k, seed)
    exact_a, exact_b = (np.array(v, dtype=np.uint64) for v in (factors, offsets))
    prime, block, part, room = fixed.HASH_PRIME, 256, 16384, 1 << 17
    empty, below, first_bits = EMPTY_HASH, np.uint64(1 << 35), _first_bits()
    # (a x + b) / p as a fraction of 2**64, wrong by less than 2**33 once the products wrap.
    # Odd factors have an inverse, so that x is got back from the fraction.
    share = [(a << 64) // prime | 1 for a in factors]
    share_a = np.array(share, np.uint64)
    share_b = np.array([((b << 64) // prime + (1 << 33)) % (1 << 64) for b in offsets], np.uint64)
    inverse = np.array([pow(a, -1, 1 << 64) for a in share], np.uint64)

    def cut(line):
        """Where the shingles of a text begin and end."""
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        if len(blanks) < n:
            return np.zeros(1, np.int64), np.array([len(line)])
        return np.append(0, blanks + 1)[:len(blanks) + 2 - n], np.append(blanks, len(line))[n - 1:]

    def lowest(x, v):
        """Smallest (a x + b) mod p of each hash function over distinct x.

        The smallest fraction tells which x it is, unless another one is as near as
        the fractions are wrong, or one may have wrapped around.  Then all are computed.
        """
        best, slack = None, np.uint64(1 << 34)
        for at in range(0, len(x), block):
            some = x[at:at + block]
            w = v[:len(some)]
            np.multiply(some[:, None], share_a, out=w)
            np.add(w, share_b, out=w)
            low = w.min(axis=0)
            least = low if best is None else np.minimum(best, low)
            if least.min() < below or least.max() > ~below:
                break
            limit = least + slack
            near = low <= limit
            if np.count_nonzero(w <= limit) != np.count_nonzero(near) or (best is not None and (near & (best <= limit)).any()):
                break
            best = least
        else:
            return ((best - share_b) * inverse * exact_a + exact_b) % np.uint64(prime)
        return np.min([((some[:, None] * exact_a + exact_b) % np.uint64(prime)).min(axis=0)
                       for some in (x[at:at + block] for at in range(0, len(x), block))], axis=0)

    def sign_texts(lines, rows, v):
        """Fill the signatures of a few texts, whose shingles are hashed together."""
        places, at = [cut(line) for line in lines], 0
        shift = np.cumsum([0, *[len(line) for line in lines]])
        starts = np.concatenate([s + o for (s, _), o in zip(places, shift)])
        ends = np.concatenate([e + o for (_, e), o in zip(places, shift)])
        text, x = b"".join(lines), np.empty(len(starts), np.uint64)
        data = np.frombuffer(text + bytes(64), np.uint8)
        for lo in range(0, len(starts), part):
            x[lo:lo + part] = first_bits(data, starts[lo:lo + part], ends[lo:lo + part])
        for row, (s, _) in zip(rows, places):
            row[:] = lowest(np.unique(x[at:at + len(s)]), v)
            at += len(s)

    @F.arrow_udf("array<long>")
    def signatures(texts: pa.Array) -> pa.Array:
        # A few texts at a time are Python objects, not those of a whole batch.
        v = np.empty((block, k), np.uint64)
        out = np.full((len(texts), k), empty, np.int64)
        lines, rows, held = [], [], 0
        for row, text in zip(out, texts.cast(pa.large_binary())):
            line = text.as_py()
            if line:
                lines.append(line)
                rows.append(row)
                held += len(line)
            if held > room:
                sign_texts(lines, rows, v)
                lines, rows, held = [], [], 0
        if lines:
            sign_texts(lines, rows, v)
        pa.default_memory_pool().release_unused()
        starts = np.arange(len(texts) + 1, dtype=np.int32) * k
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(out.ravel()))

    return signatures(words)


def minhash_native(c: Column, k: int = fixed.NUM_HASHES, n: int = fixed.NGRAM,
                   seed: int = fixed.HASH_SEED) -> Column:
    """The same signature from built-in functions only; slower, kept as a cross-check.

    The factor is split into halves of 16 bits so that no product leaves 64 bits.
    """
    p = fixed.HASH_PRIME

    def lowest(x, a, b):
        hashed = F.transform(x, lambda v: ((v * (a >> 16) % p) * 65536 + v * (a & 65535) + b) % p)
        return F.coalesce(F.array_min(hashed), F.lit(EMPTY_HASH))

    hashes = F.array(F.transform(word_ngrams(c, n), shingle_hash))
    return F.transform(hashes, lambda x: F.array(*[lowest(x, a, b) for a, b in zip(*hash_family(k, seed))]))[0]


def band_slices(signature: Column, bands: int = fixed.NUM_BANDS, k: int = fixed.NUM_HASHES) -> Column:
    rows = k // bands
    return F.array(*[F.slice(signature, i * rows + 1, rows) for i in range(bands)])


def lsh_bands(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, band, band_key``: the signature cut into bands."""
    signed = df.select(key, minhash(F.col(text)).alias("signature"))
    return signed.select(key, F.posexplode(band_slices(F.col("signature"))).alias("band", "band_key"))


# --- candidate pairs ------------------------------------------------------------

def bucket_sizes(bands: DataFrame, key: str = "doc_id") -> DataFrame:
    """Buckets with several members: size, smallest member, number of pairs in them."""
    n = F.col("n")
    return (
        bands.groupBy("band", "band_key").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
        .filter(n > 1).withColumn("pairs", F.expr("n * (n - 1) div 2"))
    )


def bucket_links(bands: DataFrame, key: str = "doc_id", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Distinct pairs ``i < j`` of each bucket's smallest member with its other members.

    One pair for a member of a bucket, so the output is linear in the input
    however large a bucket is, and it connects the same documents as all pairs do.
    Once pairs are verified that no longer holds: two similar members lose each
    other where the smallest is unlike both.  ``NearDuplicates`` finds all classes.
    """
    bands = materialize(bands, "bands")
    keyed = bands.withColumn("bucket", F.struct("band", "band_key"))
    sizes = bucket_sizes(bands, key).select(F.struct("band", "band_key").alias("bucket"), "first", "n")
    met = join_by_count(keyed.select("bucket", key), sizes.select("bucket", "first"), "bucket",
                        sizes.select("bucket", "n"), rows_per_task)
    return met.filter(F.col("first") < F.col(key)).select(
        F.col("first").alias("i"), F.col(key).alias("j")).distinct()


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two sets given as arrays of distinct values; two empty sets are equal."""
    def share(common):
        total = F.size(a) + F.size(b) - common
        return F.when(total == 0, 1.0).otherwise(common / F.nullif(total, F.lit(0)))

    # The array binds the intersection, which is used twice.
    return F.transform(F.array(F.size(F.array_intersect(a, b))), share)[0]


def text_jaccard(a: Column, b: Column, n: int = fixed.NGRAM) -> Column:
    """``jaccard`` of the ``word_ngrams`` of two texts, as an Arrow kernel.

    A text is cut where it is, without an array of its shingles for each pair.
    Without a text there is one shingle, which is null, as in ``word_ngrams``.
    """
    cut = _cutter(n)

    @F.arrow_udf("double")
    def similarity(left: pa.Array, right: pa.Array) -> pa.Array:
        # One pair at a time is Python objects, not those of a whole batch.
        out = np.empty(len(left))
        for at, pair in enumerate(zip(left, right)):
            x, y = ({None} if t is None else cut(t) for t in (v.as_py() for v in pair))
            common = len(x & y)
            total = len(x) + len(y) - common
            out[at] = common / total if total else 1.0
        pa.default_memory_pool().release_unused()
        return pa.array(out)

    return similarity(collapse_space(a), collapse_space(b))


def verify_pairs(pairs: DataFrame, docs: DataFrame, threshold: float = fixed.JACCARD,
                 text: str = "text", key: str = "doc_id", n: int = fixed.NGRAM,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Pairs ``i, j`` whose documents reach the threshold, with ``similarity``.

    Texts, which are smaller than their shingle sets, are what is joined.  A
    document that occurs in very many pairs has them dealt out over tasks.
    """
    pairs = materialize(pairs.select("i", "j"), "pairs")
    ids = pairs.select(F.col("i").alias(key)).union(pairs.select(F.col("j").alias(key))).distinct()
    texts = materialize(pick(docs.select(key, F.col(text).alias("text")), ids, key), "texts")
    return _verified(pairs, texts, key, threshold, n, rows_per_task)


def _verified(pairs: DataFrame, texts: DataFrame, key: str, threshold: float, n: int, rows_per_task: int) -> DataFrame:
    joined = pairs
    for end in ("i", "j"):
        side = texts.select(F.col(key).alias(end), F.col("text").alias(f"text_{end}"))
        degree = pairs.groupBy(end).agg(F.count(F.lit(1)).alias("n"))
        joined = join_by_count(joined, side, end, degree, rows_per_task)
    scored = joined.select("i", "j", text_jaccard(F.col("text_i"), F.col("text_j"), n).alias("similarity"))
    return keep(scored, F.col("similarity") >= threshold)


# --- all links ----------------------------------------------------------------------

def _prefixes(members: DataFrame, texts: DataFrame, key: str, threshold: float, n: int) -> DataFrame:
    """``at, key, size, place, buckets``: the rarest shingles of each document in each of its buckets.

    Shingles are in one order for all documents, the rarest among the members first.
    Two sets that reach the threshold share one of the first |x| - ceil(t |x|) + 1.
    """
    shingles = materialize(texts.select(key, F.explode(word_ngrams(F.col("text"), n)).alias("g")).select(
        key, F.xxhash64("g").alias("s")), "shingles")
    freq = materialize(shingles.groupBy("s").agg(F.count(F.lit(1)).alias("f")), "shingle-counts")
    ordered = lookup(shingles, freq, "s", "f").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("set"))
    size = F.size("set")
    # The small allowance keeps rounding from shortening the prefix.
    rare = F.slice("set", F.lit(1), size - F.ceil(size * threshold - 1e-6).cast("int") + 1)
    buckets = members.groupBy(key).agg(F.array_sort(F.collect_set("bucket")).alias("buckets"))
    rows = ordered.select(key, size.alias("size"), F.posexplode(F.transform(rare, lambda x: x["s"])).alias("place", "s"))
    return rows.join(buckets, key).withColumn("bucket", F.explode("buckets")).select(
        F.struct("bucket", "s").alias("at"), key, "size", "place", "buckets")


def _candidates(members: DataFrame, texts: DataFrame, key: str, threshold: float, n: int, rows_per_task: int) -> DataFrame:
    """Distinct pairs ``i < j`` of a bucket that could reach the threshold.

    They share one of their rarest shingles, their sizes are close enough, and so
    are the numbers of shingles left after the shared one.  A pair is looked at in
    the first bucket it shares only.
    """
    rows = materialize(_prefixes(members, texts, key, threshold, n), "prefixes")
    held = materialize(rows.groupBy("at").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "prefix-groups")
    left = rows.select("at", *[F.col(c).alias(f"{c}_i") for c in (key, "size", "place", "buckets")])
    right = rows.select("at", *[F.col(c).alias(f"{c}_j") for c in (key, "size", "place", "buckets")])
    # Rows alone in their group meet nobody and need no shuffle of their own.
    met = join_by_count(left, right, "at", held, rows_per_task).filter(F.col(f"{key}_i") < F.col(f"{key}_j"))
    first = F.array_min(F.array_intersect("buckets_i", "buckets_j")) == F.col("at.bucket")
    small, large = F.least("size_i", "size_j"), F.greatest("size_i", "size_j")
    left_over = F.least(F.col("size_i") - F.col("place_i"), F.col("size_j") - F.col("place_j"))
    needed = (F.col("size_i") + F.col("size_j")) * (threshold / (1 + threshold)) - 1e-6
    close = met.filter((small >= large * threshold - 1e-6) & (left_over >= needed) & first)
    return close.select(F.col(f"{key}_i").alias("i"), F.col(f"{key}_j").alias("j")).distinct()


def all_links(docs: DataFrame, text: str = "text", key: str = "doc_id", scope: list[str] | None = None,
              threshold: float = fixed.JACCARD, n: int = fixed.NGRAM, k: int = fixed.NUM_HASHES,
              bands: int = fixed.NUM_BANDS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``i, j, similarity``: every pair of different texts of a bucket that reaches the threshold.

    Texts with the same words in the same order are one class; links are between the
    smallest ids of classes, and each further document of a class has one row with
    its smallest id and similarity 1.  Documents without words are such a class.
    """
    scope = scope or []
    signed = materialize(sign(docs, text, key, scope, n, k, bands), "signed")
    reps = materialize(representatives(signed, key, scope), "representatives")
    sizes = reps.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.filter("n > 1"), "buckets")
    members = materialize(join_by_count(reps.select(key, F.explode("buckets").alias("bucket")), sizes.select("bucket"),
                                        "bucket", sizes, rows_per_task).select("bucket", key), "members")
    texts = materialize(pick(docs.select(key, F.col(text).alias("text")).dropDuplicates([key]),
                             members.select(key).distinct(), key), "member-texts")
    pairs = materialize(_candidates(members, texts, key, threshold, n, rows_per_task), "pairs")
    by_print = F.struct(*scope, "print").alias("p")
    classes = reps.filter("copies > 1").select(by_print, F.col(key).alias("i"), F.col("copies").alias("n"))
    copies = join_by_count(signed.select(by_print, F.col(key).alias("j")), classes.select("p", "i"), "p",
                           classes.select("p", "n"), rows_per_task)
    return _verified(pairs, texts, key, threshold, n, rows_per_task).unionByName(
        copies.filter("i < j").select("i", "j", F.lit(1.0).alias("similarity")))


# --- clusters ---------------------------------------------------------------------

def sign(docs: DataFrame, text: str, key: str, scope: list[str], n: int, k: int, bands: int) -> DataFrame:
    """One narrow row for a document: id, fingerprint of its words, bucket ids.

    Bucket ids are 64-bit hashes of (scope, band, band key).  Should two buckets
    share an id, unrelated documents are compared and found different; links are
    decided by the exact similarity alone.
    """
    words = collapse_space(F.col(text))
    scoped = docs.select(key, *scope, words.alias("__words"))
    parts = band_slices(F.col("__sig"), bands, k)
    return (
        scoped.select(key, *scope, F.sha2("__words", 256).alias("print"),
                      _signatures(F.col("__words"), k, n).alias("__sig"))
        .select(key, *scope, "print",
                F.transform(parts, lambda p, i: F.xxhash64(*scope, i, p)).alias("buckets"))
    )


def representatives(signed: DataFrame, key: str, scope: list[str]) -> DataFrame:
    """One row for each distinct text: smallest id, number of copies, buckets."""
    return signed.groupBy(*scope, "print", "buckets").agg(
        F.min(key).alias(key), F.count(F.lit(1)).alias("copies"))


def shingle_sets(texts: DataFrame, key: str, n: int) -> DataFrame:
    """``key, set``: the hashed shingles of each text."""
    hashed = F.array_distinct(F.transform(word_ngrams(F.col("text"), n), lambda g: F.xxhash64(g)))
    return texts.select(key, hashed.alias("set"))


def undivided(members: DataFrame) -> DataFrame:
    """Members of buckets that were not divided yet: of no side, with any partner, no shingle used."""
    return members.select(
        "*", F.lit(0).alias("side"), F.lit(None).cast("double").alias("least"),
        F.lit(None).cast("double").alias("need"), F.array().cast("array<long>").alias("used"))


def divisible() -> Column:
    """A bucket whose members may lack a further shingle in common stays whole; the same for all of them."""
    return F.col("need").isNull() | (F.col("need") > F.size("used"))


def _divide(members: DataFrame, sets: DataFrame, key: str, threshold: float, rows_per_task: int) -> DataFrame:
    """``parent, bucket, key, side, least, need, used``: buckets divided by rare shingles and length classes.

    Two sets that reach the threshold t have at least t / (1 + t) of the sum of
    their sizes in common.  With the shingles in one order, the rarest in the
    bucket first, they share one of the first |x| - common + 1 of each.  A new bucket
    is for a shingle and two length classes, so that the size of a partner is known
    from below (``least``) and no more shingles than needed are looked at.  Members
    of one class are compared among themselves (``side`` 0), those of two classes
    across (1 the smaller, 2 the larger).  ``used`` are the shingles that all members
    of a bucket are known to share; dividing it again leaves them out, as in the
    remaining sets the same number of shingles decides.  That holds while linked
    members need more shingles in common (``need``, from the classes) than were used.
    """
    held = members.join(sets, key).withColumn("size", F.size("set"))
    every = materialize(
        held.select("bucket", key, F.explode(F.array_except("set", "used")).alias("s"))
        .select(F.struct("bucket", "s").alias("at"), key), "held")
    # A shingle of one member brings nobody together; only the number of these is needed.
    freq = materialize(every.groupBy("at").agg(F.count(F.lit(1)).alias("f")).filter("f > 1"), "held-counts")
    counts = freq.withColumnRenamed("f", "n")
    shared = join_by_count(every, freq, "at", counts, rows_per_task).groupBy(F.col("at.bucket").alias("bucket"), key).agg(
        F.array_sort(F.collect_list(F.struct("f", F.col("at.s").alias("s")))).alias("shared"))
    rows = held.drop("set").join(shared, ["bucket", key])

    size, step, share = F.col("size"), float(-np.log(threshold) / CLASSES), threshold / (1 + threshold)
    own = F.floor(F.log(size) / step).cast("int")

    def partner(d):
        return F.struct(
            F.when(d == 0, 0).when(d > 0, 1).otherwise(2).alias("side"), F.least(own, own + d).alias("low"),
            F.greatest(own, own + d).alias("high"), F.greatest(F.exp((own + d) * step), size * threshold).alias("least"),
            ((F.exp(own * step) + F.exp((own + d) * step)) * share - 1e-6).alias("need"))

    # One class more on each side makes up for rounding.
    classes = F.transform(F.sequence(F.lit(-CLASSES - 1), F.lit(CLASSES + 1)), partner)
    known = F.array(F.struct("side", F.lit(-1).alias("low"), F.lit(-1).alias("high"), "least", "need"))
    met = rows.withColumn("p", F.explode(F.when(F.col("least").isNull(), classes).otherwise(known)))
    # The small allowance keeps rounding from shortening the prefix.
    common = F.ceil((size + F.col("p.least")) * share - 1e-6)
    alone = size - F.size("used") - F.size("shared")
    prefix = F.greatest(size - common + 1 - alone, F.lit(0)).cast("int")
    return met.withColumn("x", F.explode(F.slice("shared", F.lit(1), prefix))).select(
        F.col("bucket").alias("parent"), F.xxhash64("bucket", "x.s", "p.low", "p.high").alias("bucket"), key,
        "p.side", "p.least", "p.need", F.array_append("used", F.col("x.s")).alias("used"))


def _divided(large: DataFrame, sets: DataFrame, key: str, threshold: float, rows_per_task: int) -> DataFrame:
    """The members of ``large(bucket, size, …)`` in smaller buckets, where that at least halves the pairs."""
    parts = materialize(_divide(large.drop("size"), sets, key, threshold, rows_per_task), "parts")
    on = lambda side: F.sum(F.when(F.col("side") == side, 1).otherwise(0))
    pairs = F.expr("own * (own - 1) / 2 + small * big")
    work = materialize(
        parts.groupBy("parent", "bucket").agg(on(0).alias("own"), on(1).alias("small"), on(2).alias("big"))
        .select("parent", "bucket", pairs.alias("pairs"), (F.col("own") + F.col("small") + F.col("big")).alias("n"))
        .filter("pairs > 0"), "parts-work")
    sums = work.groupBy("parent").agg(F.sum("pairs").alias("pairs"))
    whole = large.select(F.col("bucket").alias("parent"), "size").distinct()
    stuck = materialize(
        sums.join(whole, "parent").filter("pairs * 4 > size * (size - 1)").select("parent"), "undivided")
    useful = work.join(stuck, "parent", "left_anti").select("bucket", "n")
    columns = ["bucket", key, "side", "least", "need", "used"]
    split = join_by_count(parts.select(*columns), useful.select("bucket"), "bucket", useful, rows_per_task)
    kept = large.join(stuck.withColumnRenamed("parent", "bucket"), "bucket", "left_semi")
    return kept.select(*columns).unionByName(split.select(*columns))


def find_links(reps: DataFrame, docs: DataFrame, text: str, key: str, threshold: float, n: int,
               hubs: int, rows_per_task: int, settled: DataFrame | None = None) -> DataFrame | None:
    """Links whose components are those of all linked pairs, or None without any.

    ``settled(key, label)`` names members that were compared among themselves before,
    with the components found then.  They are not compared with each other again, and
    the links hold one from each of them to its label.
    """
    sizes = reps.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.filter("n > 1"), "buckets")
    members = join_by_count(reps.select(key, F.explode("buckets").alias("bucket")), sizes.select("bucket"),
                            "bucket", sizes, rows_per_task)
    members = materialize(undivided(members.select("bucket", key)), "members")
    texts = materialize(
        pick(docs.select(key, F.col(text).alias("text")), members.select(key).distinct(), key), "member-texts")

    links, labels, sets, round_no, divided = None, None, None, 0, 0
    if settled is not None:
        labels = settled = materialize(settled.select(key, "label"), "settled")
        links = settled.filter(F.col(key) != F.col("label")).select(F.col("label").alias("i"), F.col(key).alias("j"))
    active = sizes
    while True:
        if labels is None:
            labelled = members.withColumn("label", F.col(key))
        else:
            labelled = materialize(
                members.join(labels, key, "left").withColumn("label", F.coalesce("label", key)), "labelled")
            active = materialize(
                labelled.groupBy("bucket").agg(
                    F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"),
                    F.min("side").alias("from"), F.max("side").alias("to"))
                .filter((F.col("lo") < F.col("hi")) & ((F.col("from") == 0) | (F.col("from") < F.col("to"))))
                .select("bucket", "n"), "active")
        largest = active.agg(F.max("n")).first()[0]
        if largest is None:
            return links
        sized = join_by_count(labelled, active.withColumnRenamed("n", "size"), "bucket", active, rows_per_task)
        if largest > hubs and round_no > divided:
            is_large = (F.col("size") > hubs) & divisible()
            small = sized.filter(~is_large)
            large = materialize(sized.filter(is_large).select(*members.columns, "size"), "large")
            if sets is None:
                # Large buckets of later rounds are parts of these.
                sets = materialize(shingle_sets(pick(texts, large.select(key).distinct(), key), key, n), "sets")
            parts = _divided(large, sets, key, threshold, rows_per_task)
            members, divided = materialize(small.select(*members.columns).unionByName(parts), "divided"), round_no
            continue

        # A member is a hub with probability hubs/size; in a small bucket everyone is.
        # The draw is the document's, so that it meets the same hubs in all its buckets.
        draw = F.pmod(F.xxhash64(key, F.lit(round_no)), F.lit(1 << 30)) * F.col("size")
        dealt = sized.withColumn("is_hub", draw < F.lit(hubs << 30))
        if settled is None:
            dealt = dealt.withColumn("new", F.lit(True))
        else:
            dealt = dealt.join(settled.select(key, F.lit(False).alias("new")), key, "left").withColumn(
                "new", F.coalesce("new", F.lit(True)))
        drawn = materialize(dealt, "drawn")
        hub_rows = drawn.filter("is_hub").select(
            "bucket", F.col(key).alias("hub"), F.col("label").alias("hub_label"), F.col("new").alias("hub_new"),
            F.col("side").alias("hub_side"))
        met = join_by_count(drawn, hub_rows, "bucket", active, rows_per_task).filter(
            (F.col("label") != F.col("hub_label")) & (F.col("new") | F.col("hub_new"))
            & ((F.col("side") == 0) | (F.col("side") != F.col("hub_side")))
            & (~F.col("is_hub") | (F.col("hub") < F.col(key))))
        pairs = materialize(
            met.select(F.least("hub", key).alias("i"), F.greatest("hub", key).alias("j")).distinct(), "pairs")
        found = materialize(_verified(pairs, texts, key, threshold, n, rows_per_task).select("i", "j"), "links")
        links = found if links is None else links.unionByName(found)
        if largest <= hubs:
            return links
        members = drawn.filter(~F.col("is_hub")).select(*members.columns)
        labels = materialize(
            connected_components(links, rows_per_task=rows_per_task)
            .select(F.col("node").alias(key), F.col("component").alias("label")), "labels")
        hubs, round_no = hubs * 2, round_no + 1


class NearDuplicates:
    """Clusters of near-duplicate documents of ``docs``.

    ``scope`` names columns that documents must agree in to be compared, such as
    a chunk number; by default the whole corpus is one scope.
    """

    def __init__(self, docs: DataFrame, text: str = "text", key: str = "doc_id", scope: list[str] | None = None,
                 threshold: float = fixed.JACCARD, n: int = fixed.NGRAM, k: int = fixed.NUM_HASHES,
                 bands: int = fixed.NUM_BANDS, hubs: int = HUBS, rows_per_task: int = ROWS_PER_TASK):
        scope = scope or []
        self.docs, self.text, self.key, self.n = docs, text, key, n
        self.scope, self.rows_per_task = scope, rows_per_task
        self.signed = materialize(sign(docs, text, key, scope, n, k, bands), "signed")
        self.reps = materialize(representatives(self.signed, key, scope), "representatives")
        links = find_links(self.reps.select(key, "buckets"), docs, text, key, threshold, n, hubs, rows_per_task)
        if links is None:
            links = docs.sparkSession.createDataFrame([], "i long, j long")
        # Representatives that belong to a smaller one.
        self.merged = materialize(
            connected_components(links, rows_per_task=rows_per_task)
            .select(F.col("node").alias(key), F.col("component").alias("cluster_id")), "clusters")

    def _labelled_reps(self) -> DataFrame:
        return self.reps.join(self.merged, self.key, "left").withColumn(
            "cluster_id", F.coalesce("cluster_id", self.key))

    def clusters(self) -> DataFrame:
        """``key, cluster_id`` for every document; copies follow their representative."""
        by_print = [*self.scope, "print"]
        reps = self._labelled_reps().select(F.struct(*by_print).alias("p"), "cluster_id", F.col("copies").alias("n"))
        rows = self.signed.select(self.key, F.struct(*by_print).alias("p"))
        return join_by_count(rows, reps.select("p", "cluster_id"), "p", reps.select("p", "n"),
                             self.rows_per_task).select(self.key, "cluster_id")

    def kept_ids(self) -> DataFrame:
        """The smallest id of each cluster."""
        lost = self.merged.filter(F.col(self.key) != F.col("cluster_id")).select(self.key)
        return self.reps.select(self.key).join(lost, self.key, "left_anti")

    def kept(self) -> DataFrame:
        """The documents that stay, all columns."""
        ids = self.signed.select(self.key)
        lost = materialize(ids.join(self.kept_ids(), self.key, "left_anti"), "lost")
        return leave_out(self.docs, lost, self.key)

    def similarities(self) -> DataFrame:
        """``key, cluster_id, similarity``: each document that goes, with the one kept and their exact similarity.

        Every such document has one row, whether it was linked to the kept one
        directly or through others.
        """
        gone = self.clusters().filter(F.col(self.key) != F.col("cluster_id"))
        pairs = gone.select(F.col("cluster_id").alias("i"), F.col(self.key).alias("j"))
        found = verify_pairs(pairs, self.docs, 0.0, self.text, self.key, self.n, self.rows_per_task)
        return found.select(F.col("j").alias(self.key), F.col("i").alias("cluster_id"), "similarity")

    def sizes(self) -> DataFrame:
        """``cluster_id, size`` of clusters with several documents.

        Sums the copies of representatives, so no list of members is built.
        """
        return (
            self._labelled_reps().groupBy("cluster_id").agg(
                F.sum("copies").alias("size"), F.count(F.lit(1)).alias("texts"))
            .filter("size > 1")
        )


def dedup(docs: DataFrame, **options) -> DataFrame:
    """Documents without near duplicates, the smallest id of each cluster kept."""
    return NearDuplicates(docs, **options).kept()
