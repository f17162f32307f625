"""Byte-level BPE: word counting, merge training, encoding, decoding.

A word under training is a string of symbols, each written as a dot, the hex
digits of its bytes and a blank: ``.6C .6F77 ``.  The dot and the blank keep
symbols apart, so a merge is one left-to-right string replacement, and because
both sort before the hex digits, comparing two such strings compares the byte
strings they stand for.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom import fixed
from textloom.operators.merging import Forecast, Pair, Ranking, merge_symbols, merge_words
from textloom.session import materialize

# Pairs and words that the driver holds in training, and symbols of such a word.
TOP_PAIRS = 10_000
FIRST_SAMPLE, SAMPLE_WORDS, SAMPLE_SYMBOLS = 20_000, 100_000, 100
# Merges tried in the first and in the largest round, and merges taken before the words are written again.
FIRST_BATCH, LARGEST_BATCH, PENDING_MERGES = 64, 1024, 256
# Counts a task holds before it passes them on.
HELD_PAIRS = 300_000
# Words whose ids a worker remembers.
MEMO_WORDS = 500_000
# Rows of a batch whose words a worker holds as objects.
HELD_ROWS = 64


@dataclass
class Tokenizer:
    """A model of at most ``vocab_size`` entries, with its tables."""

    spark: SparkSession
    tokens: dict[int, bytes] = field(
        default_factory=lambda: {i: bytes([i]) for i in range(fixed.BYTE_TOKENS)})
    merges: dict[tuple[bytes, bytes], int] = field(default_factory=dict)
    specials: dict[str, int] = field(default_factory=dict)

    def vocab(self) -> DataFrame:
        rows = [(i, bytearray(t)) for i, t in self.tokens.items()]
        return self.spark.createDataFrame(rows, "id int, token binary")

    def merge_table(self) -> DataFrame:
        rows = [(rank, bytearray(a), bytearray(b)) for (a, b), rank in self.merges.items()]
        return self.spark.createDataFrame(rows, "rank int, left binary, right binary")

    def register_specials(self, specials: Sequence[str]) -> None:
        """Give new special tokens the next free ids, in list order."""
        for token in specials:
            if token not in self.specials:
                self.specials[token] = self.next_id()
                self.tokens[self.specials[token]] = token.encode()

    def next_id(self) -> int:
        return max(self.tokens) + 1

    def next_rank(self) -> int:
        return max(self.merges.values(), default=-1) + 1


# --- text to words ----------------------------------------------------------

def _any_of(specials: Sequence[str]) -> str:
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", s, flags=re.ASCII) for s in specials)


def split_specials(c: Column, specials: Sequence[str]) -> Column:
    """Ordinary pieces between special tokens, empty ones left out."""
    pieces = F.split(c, _any_of(specials), -1) if specials else F.array(c)
    return F.filter(pieces, lambda p: p != "")


def pretokenize(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(fixed.PRETOKEN), F.lit(0))


def words_of(c: Column, specials: Sequence[str] = ()) -> Column:
    """Pre-tokens in order, special tokens kept whole."""
    if not specials:
        return pretokenize(c)
    found = F.regexp_extract_all(c, F.lit(f"({_any_of(specials)})"), F.lit(1))
    pieces = F.split(c, _any_of(specials), -1)
    parts = F.arrays_zip(pieces.alias("piece"), found.alias("special"))
    words = F.transform(
        parts, lambda p: F.concat(pretokenize(p["piece"]), F.array_compact(F.array(p["special"]))))
    has_special = F.regexp_count(c, F.lit(_any_of(specials))) > 0
    return F.when(has_special, F.flatten(words)).otherwise(pretokenize(c))


def word_counts(df: DataFrame, specials: Sequence[str] = (), text: str = "text") -> DataFrame:
    """``word, n`` over all pieces."""
    return (
        df.select(F.explode(split_specials(F.col(text), specials)).alias("piece")).select(F.explode(pretokenize(F.col("piece"))).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )


# --- training ---------------------------------------------------------------

def to_symbols(word: Column) -> Column:
    return F.regexp_replace(F.hex(F.encode(word, "UTF-8")), "(..)", ".$1 ")


def _symbol(token: bytes) -> str:
    return f".{token.hex().upper()} "


def apply_merge(symbols: Column, left: bytes, right: bytes) -> Column:
    """Join neighbours left, right from left to right, without overlap."""
    return F.replace(symbols, F.lit(_symbol(left) + _symbol(right)), F.lit(_symbol(left + right)))


def pair_counts(words: DataFrame) -> DataFrame:
    """``pair, n`` from ``symbols, n``; every occurrence counts, overlaps too."""
    pairs = F.regexp_extract_all("symbols", F.lit(r"(?=(\.[0-9A-F]+ \.[0-9A-F]+ ))\."), F.lit(1))
    return (
        words.select(F.explode(pairs).alias("pair"), "n")
        .groupBy("pair").agg(F.sum("n").alias("n"))
    )


def best_pairs(pairs: DataFrame, k: int = 1) -> DataFrame:
    """The k most frequent pairs; among equals the larger byte pair goes first."""
    return pairs.orderBy(F.desc("n"), F.desc("pair")).limit(k)


def _binary_pairs(words: DataFrame, names: list[bytes]) -> DataFrame:
    """``left, right, n`` of the pairs in ``symbols array<int>, n``, as bytes; tasks add up first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def passed() -> pa.RecordBatch:
            sides = [pa.array([names[p[k]] for p in sums], pa.binary()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([*sides, pa.array(sums.values(), pa.int64())], ["left", "right", "n"])

        for b in batches:
            for s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for p in zip(s, s[1:]):
                    sums[p] += n
            if len(sums) > HELD_PAIRS:
                yield passed()
                sums.clear()
        yield passed()

    return words.mapInArrow(run, "left binary, right binary, n long").groupBy("left", "right").agg(F.sum("n").alias("n"))


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols one word after the other, lengths and counts of the words of ``symbols, n``."""
    lists = batch.column(0)
    return lists.flatten().to_numpy(zero_copy_only=False).copy(), np.diff(lists.offsets.to_numpy()), batch.column(1).to_numpy()


def _merged_words(words: DataFrame, steps: list[tuple[Pair, int]]) -> DataFrame:
    """``symbols, n`` after the merges, each in its turn; a word of one symbol has no pairs left and goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            symbols, lengths, n = _flat(b)
            merged, sizes, _ = merge_words(symbols, lengths, steps)
            kept = sizes > 1
            merged, sizes = merged[np.repeat(kept, sizes)], sizes[kept]
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(merged, pa.int32()))
            yield pa.RecordBatch.from_arrays([lists, pa.array(n[kept], pa.int64())], ["symbols", "n"])

    return words.mapInArrow(run, "symbols array<int>, n long")


def _pair_changes(words: DataFrame, steps: list[tuple[Pair, int]], since: int) -> DataFrame:
    """``step, left, right, d``: how each merge from ``since`` on changes the count of each pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            symbols, lengths, n = _flat(b)
            changes = merge_words(symbols, lengths, steps, n, since)[2]
            kinds = [pa.int32()] * 3 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(changes, kinds)], ["step", "left", "right", "d"])

    rows = words.mapInArrow(run, "step int, left int, right int, d long")
    return rows.groupBy("step", "left", "right").agg(F.sum("d").alias("d")).filter("d <> 0")


class _Training:
    """The words as a table, the leading pairs with their exact counts on the driver.

    The driver forecasts the next merges on a bounded sample of frequent words.  One
    job replays them on all words and sums how every step changes the count of each
    pair.  From these sums the driver goes through the steps again with exact counts
    and takes those that were forecast right.  The first one always is, so a poor
    forecast costs rounds, never results.

    Pairs outside the list are below ``bound``: (negative count, key) of the last pair
    of the list.  Their counts do not grow but when a merge builds bytes that a
    symbol has already; then the bound is raised by what they gained.  A new pair
    that could reach the bound is listed with its first change.
    """

    def __init__(self, counted: DataFrame, merges: list[tuple[bytes, bytes]], listed: int, sample: int):
        self.names = [bytes([b]) for b in range(fixed.BYTE_TOKENS)]
        self.number = {name: i for i, name in enumerate(self.names)}
        self.live = set(range(fixed.BYTE_TOKENS))
        self.listed, self.batch = listed, FIRST_BATCH
        self.sample, self.largest = min(FIRST_SAMPLE, sample), sample
        self.pending: list[tuple[Pair, int]] = []
        cores = counted.sparkSession.sparkContext.defaultParallelism

        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                symbols = [list(w) for w in b.column(0).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(symbols, pa.list_(pa.int32())), b.column(1)], ["symbols", "n"])

        spelled = counted.select("word", "n").mapInArrow(spell, "symbols array<int>, n long")
        if spelled.rdd.getNumPartitions() < cores or counted.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            spelled = spelled.repartition(max(cores, spelled.rdd.getNumPartitions()))
        self.words = materialize(spelled, "words")
        for left, right in merges:
            self.accept((self.numbered(left), self.numbered(right)))
        self.refresh()

    def numbered(self, name: bytes) -> int:
        if name not in self.number:
            self.number[name] = len(self.names)
            self.names.append(name)
        return self.number[name]

    def joined(self, pair: Pair) -> int:
        return self.numbered(self.names[pair[0]] + self.names[pair[1]])

    def accept(self, pair: Pair) -> None:
        self.live.add(self.joined(pair))
        self.pending.append((pair, self.joined(pair)))

    def write(self) -> None:
        if self.pending:
            self.words, self.pending = materialize(_merged_words(self.words, self.pending), "words"), []

    def refresh(self) -> None:
        """List the leading pairs anew."""
        self.write()
        pairs = _binary_pairs(self.words, self.names)
        rows = pairs.orderBy(F.desc("n"), F.desc("left"), F.desc("right")).limit(self.listed).collect()
        counts = {(self.number[bytes(r["left"])], self.number[bytes(r["right"])]): r["n"] for r in rows}
        self.exact = Ranking(counts, self.names)
        full = len(rows) == self.listed
        last = next(reversed(counts), None)
        self.bound = self.exact.key(last, counts[last]) if full else (0, (), ())
        self.draw()

    def draw(self) -> None:
        """Sample the words: half of the sample are the most frequent ones, the others stand for all rarer ones."""
        self.write()
        short, half = self.words.filter(F.size("symbols") <= SAMPLE_SYMBOLS), self.sample // 2
        some = [(r["symbols"], r["n"]) for r in short.orderBy(F.desc("n"), "symbols").limit(half).collect()]
        if len(some) == half:
            known, held = {tuple(s) for s, _ in some}, sum(n for _, n in some)
            rows = short.filter(F.col("n") <= some[-1][1]).orderBy(F.xxhash64("symbols"), "symbols").limit(half).collect()
            rarer = [(r["symbols"], r["n"]) for r in rows if tuple(r["symbols"]) not in known]
            times = (short.agg(F.sum("n")).first()[0] - held) / max(1, sum(n for _, n in rarer))
            some += [(s, n * max(1.0, times)) for s, n in rarer]
        self.forecast = Forecast(some)

    def leads(self, pair: Pair | None) -> bool:
        """Whether no pair outside the list can come before this one."""
        return pair is not None and self.exact.key(pair, self.exact.counts[pair]) <= self.bound

    def guess(self, limit: int) -> list[tuple[Pair, int]]:
        """The merges expected next; the first one is certain."""
        likely, out = Ranking(self.exact.counts, self.names), []
        while len(out) < limit:
            pair = likely.best()
            if pair is None or likely.key(pair, likely.counts[pair]) > self.bound:
                break
            n, in_sample, joined = likely.counts[pair], self.forecast.counts[pair], self.joined(pair)
            out.append((pair, joined))
            scale = n / in_sample if in_sample > 0 else 1
            likely.add(pair, -n)
            for p, d in self.forecast.merge(pair, joined).items():
                if p != pair and (p in likely.counts or joined in p):
                    likely.add(p, round(d * scale))
        return out

    def steps(self, limit: int) -> list[Pair]:
        """The next merges, as many as this round makes sure of; none when no pair is left."""
        if not self.leads(self.exact.best()):
            self.refresh()
            if not self.leads(self.exact.best()):
                return []
        tried = self.guess(min(limit, self.batch))
        known, again = set(self.live), set()
        for k, (_, joined) in enumerate(tried):
            if joined in known:
                again.add(k)
            known.add(joined)
        base = len(self.pending)
        changes = _pair_changes(self.words, self.pending + tried, base)
        spark = self.words.sparkSession
        # As many rows as pairs are listed on the driver.
        here = spark.createDataFrame(pd.DataFrame(list(self.exact.counts), columns=["left", "right"]), "left int, right int")
        gains = F.sum(F.greatest("d", F.lit(0)))
        repeats = F.max(F.col("step").isin([base + k for k in again]) & (F.col("d") > 0)) if again else F.lit(False)
        by_pair = changes.groupBy("left", "right").agg(
            F.collect_list(F.struct("step", "d")).alias("steps"), gains.alias("gains"), repeats.alias("repeats"))
        wanted = by_pair.join(F.broadcast(here.withColumn("here", F.lit(True))), ["left", "right"], "left").filter(
            F.col("here") | F.col("repeats") | (F.col("gains") >= max(1, -self.bound[0])))
        by_step = defaultdict(list)
        for r in wanted.collect():
            for s in r["steps"]:
                by_step[s["step"] - base].append(((r["left"], r["right"]), s["d"]))
        taken: list[Pair] = []
        for k, (pair, joined) in enumerate(tried):
            if self.exact.best() != pair or not self.leads(pair):
                break
            gained = 0
            for p, d in by_step[k]:
                if p in self.exact.counts or (joined in p and k not in again):
                    self.exact.add(p, d)
                else:
                    gained = max(gained, d)
            if gained:
                self.bound = (self.bound[0] - gained, (), ())
            self.accept(pair)
            taken.append(pair)
        self.forecast.keep(len(taken))
        self.batch = min(LARGEST_BATCH, 2 * self.batch) if len(taken) == len(tried) else max(FIRST_BATCH, 2 * len(taken))
        if 2 * len(taken) < len(tried) and self.sample < self.largest:
            # Later merges touch few words, so more of them can be tried on.
            self.sample = min(self.largest, 4 * self.sample)
            self.draw()
        elif len(self.pending) >= PENDING_MERGES:
            self.write()
        return taken


def train_bpe(df: DataFrame, vocab_size: int, specials: Sequence[str] = (fixed.END_OF_TEXT,),
              model: Tokenizer | None = None, text: str = "text", replay: bool = True,
              top_pairs: int = TOP_PAIRS, sample_words: int = SAMPLE_WORDS) -> Tokenizer:
    """Train to ``vocab_size`` entries, or go on from ``model``.

    Counting words is one aggregation over the corpus.  After it, each round is one
    pass over the distinct words that makes sure of as many merges as the driver
    forecast right (``_Training``); the driver holds the leading ``top_pairs`` and
    ``sample_words`` words.  The merges are those of one-at-a-time training.

    ``replay=False`` leaves the merges of ``model`` out of the words, so that
    training starts from single bytes again under new ids and ranks.
    """
    out = Tokenizer(df.sparkSession)
    if model is not None:
        out = Tokenizer(df.sparkSession, dict(model.tokens), dict(model.merges), dict(model.specials))
    out.register_specials(specials)
    if len(out.tokens) >= vocab_size:
        return out
    before = sorted(out.merges, key=out.merges.get) if replay else []
    training = _Training(word_counts(df, specials, text), before, top_pairs, sample_words)
    rank, new_id = out.next_rank(), out.next_id()
    while len(out.tokens) < vocab_size:
        taken = training.steps(vocab_size - len(out.tokens))
        if not taken:
            break
        for pair in taken:
            left, right = (training.names[s] for s in pair)
            out.merges[left, right], out.tokens[new_id] = rank, left + right
            rank, new_id = rank + 1, new_id + 1
    return out


# --- encoding and decoding --------------------------------------------------

def _encode_words(model: Tokenizer):
    """Arrow function: ids of a list of words, lowest-ranked merge first; a worker remembers words."""
    number = {bytes([b]): b for b in range(fixed.BYTE_TOKENS)}
    options = {}
    for (left, right), rank in model.merges.items():
        a, b, joined = (number.setdefault(t, len(number)) for t in (left, right, left + right))
        options[a, b] = [(rank, joined)]
    ids = {number[t]: i for i, t in model.tokens.items() if t in number}
    specials = dict(model.specials)

    def encode(word: str) -> bytes:
        if word in specials:
            found = [specials[word]]
        else:
            found = [ids[s] for s in merge_symbols(list(word.encode()), options)]
        return np.array(found, np.int32).tobytes()

    memo: dict[str, bytes] = {}

    def ids_of(words) -> bytes:
        out = []
        for w in () if words is None else words:
            found = memo.get(w)
            if found is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                found = memo[w] = encode(w)
            out.append(found)
        return b"".join(out)

    @F.arrow_udf("array<int>")
    def encode_words(rows: pa.Array) -> pa.Array:
        # The words of some rows at a time are Python objects, not those of a whole batch.
        coded, sizes = [], [0]
        for at in range(0, len(rows), HELD_ROWS):
            texts = [ids_of(words) for words in rows.slice(at, HELD_ROWS).to_pylist()]
            coded.append(b"".join(texts))
            sizes += [len(t) // 4 for t in texts]
        flat = np.frombuffer(b"".join(coded), np.int32)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat, pa.int32()))

    return encode_words


def encode(df: DataFrame, model: Tokenizer, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, input_ids``; a null text has no ids.

    Row by row, without a shuffle: the vocabulary bounds the merge table that
    every task gets.
    """
    words = words_of(F.col(text), tuple(model.specials))
    return df.select(key, _encode_words(model)(words).alias("input_ids"))


def count_ids(c: Column, model: Tokenizer) -> Column:
    """Number of ids of a text, 0 for null; row by row, like ``encode``."""
    return F.coalesce(F.size(_encode_words(model)(words_of(c, tuple(model.specials)))), F.lit(0))


def token_hex(ids: Column, model: Tokenizer) -> Column:
    """Hex bytes of each id; an id outside the vocabulary is an error.

    The vocabulary becomes one constant array indexed by id, so there is no join.
    """
    by_id = [model.tokens[i].hex() if i in model.tokens else "?" for i in range(max(model.tokens) + 1)]
    table = F.split(F.lit(",".join(by_id)), ",")

    def one(i):
        unknown = F.raise_error(F.concat(F.lit("token id outside the vocabulary: "), i.cast("string")))
        return F.coalesce(F.nullif(F.get(table, i), F.lit("?")), unknown)

    return F.transform(ids, one)


def decode(ids: Column, model: Tokenizer) -> Column:
    """Text of the ids, invalid UTF-8 replaced."""
    return F.make_valid_utf8(F.unhex(F.array_join(token_hex(ids, model), "")).cast("string"))


def token_stats(tokens: DataFrame, model: Tokenizer, ids: str = "input_ids") -> DataFrame:
    """Documents, tokens, bytes, bytes per token and the share of the vocabulary in use."""
    per_doc = tokens.agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.size(ids)).cast("long").alias("tokens"),
        F.sum(F.length(F.array_join(token_hex(F.col(ids), model), "")) / 2).cast("long").alias("bytes"))
    used = tokens.select(F.explode(ids).alias("id")).agg(F.count_distinct("id").alias("used_ids")).first()[0]
    return per_doc.withColumns({
        "bytes_per_token": F.round(F.col("bytes") / F.nullif(F.col("tokens"), F.lit(0)), 6),
        "used_ids": F.lit(used).cast("long"),
        "vocab_share": F.round(F.lit(used) / F.lit(len(model.tokens)), 6),
    })
