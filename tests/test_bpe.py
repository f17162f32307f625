import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from textloom import fixed
from textloom.operators import bpe, merging
from textloom.sources import tokens as token_io

SPLIT = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def one_at_a_time(words, merges_wanted):
    """Merges of a word-count table, recounting after each; written for clarity."""
    words = {tuple(bytes([b]) for b in w.encode()): n for w, n in words.items()}
    merges = []
    while len(merges) < merges_wanted:
        pairs = Counter()
        for symbols, n in words.items():
            for pair in zip(symbols, symbols[1:]):
                pairs[pair] += n
        if not pairs:
            break
        best = max(pairs, key=lambda p: (pairs[p], p))
        merges.append(best)
        changed = {}
        for symbols, n in words.items():
            i, joined = 0, []
            while i < len(symbols):
                if symbols[i:i + 2] == best:
                    joined.append(best[0] + best[1])
                    i += 2
                else:
                    joined.append(symbols[i])
                    i += 1
            changed[tuple(joined)] = changed.get(tuple(joined), 0) + n
        words = changed
    return merges


def counts_of(texts):
    return Counter(m for t in texts for m in SPLIT.findall(t))


def test_pretokens(column_of):
    got = column_of(["I'll go  to wörld 12!\n", "I'LL  x", "", "a\x1cb \n\n c", "x²  ٣a's"], bpe.pretokenize(F.col("text")))
    assert got[0] == ["I", "'ll", " go", " ", " to", " wörld", " 12", "!", "\n"]
    assert got[1] == ["I", "'", "LL", " ", " x"]
    assert got == [SPLIT.findall(t) for t in ["I'll go  to wörld 12!\n", "I'LL  x", "", "a\x1cb \n\n c", "x²  ٣a's"]]


def test_specials(column_of):
    sp = ["<|a|>", "<|a|>b", "x.y"]
    texts = ["p<|a|>b q<|a|>", "x.yxzy", "<|a|>", "plain"]
    assert column_of(texts, bpe.split_specials(F.col("text"), sp)) == [["p", "b q"], ["xzy"], [], ["plain"]]
    assert column_of(texts, bpe.words_of(F.col("text"), sp)) == [
        ["p", "<|a|>", "b", " q", "<|a|>"], ["x.y", "xzy"], ["<|a|>"], ["plain"]]


def test_word_counts(docs_of):
    df = docs_of(["a<s>b", "a a", "zz"])
    assert {r.word: r.n for r in bpe.word_counts(df, ["<s>"]).collect()} == {"a": 2, "b": 1, " a": 1, "zz": 1}


GOLDEN = ["low low lower<|endoftext|>newest newest\n", "widest aaa\n"]


def test_train_golden(docs_of):
    model = bpe.train_bpe(docs_of(GOLDEN), 265, [fixed.END_OF_TEXT])
    assert list(model.merges) == [(b"w", b"e"), (b"s", b"t"), (b"l", b"o"), (b"we", b"st"), (b"n", b"e"),
                                  (b"ne", b"west"), (b"lo", b"w"), (b"a", b"a")]
    assert list(model.merges.values()) == list(range(8))
    assert model.specials == {fixed.END_OF_TEXT: 256} and max(model.tokens) == 264


def plain_merges(symbols, steps):
    """Each step in its turn, from left to right."""
    for pair, joined in steps:
        out, i = [], 0
        while i < len(symbols):
            hit = tuple(symbols[i:i + 2]) == pair
            out.append(joined if hit else symbols[i])
            i += 2 if hit else 1
        symbols = out
    return symbols


@pytest.mark.parametrize("seed", range(40))
def test_merges_in_turn_and_their_changes(seed):
    rnd = random.Random(seed)
    steps = [((rnd.randint(0, 5), rnd.randint(0, 5)), rnd.choice([0, 1, 6, 7, 8])) for _ in range(12)]
    options = {}
    for order, (pair, joined) in enumerate(steps):
        options.setdefault(pair, []).append((order, joined))
    changes, since = {}, rnd.randint(0, 4)
    before, after = Counter(), Counter()
    for _ in range(10):
        word, n = [rnd.randint(0, 3) for _ in range(rnd.randint(0, 30))], rnd.randint(1, 5)
        got = merging.merge_symbols(word, options, True, n, since, changes)
        assert got == plain_merges(word, steps)
        for counts, s in ((before, plain_merges(word, steps[:since])), (after, got)):
            for p in zip(s, s[1:]):
                counts[p] += n
    by_pair = Counter()
    for (step, left, right), d in changes.items():
        assert step >= since
        by_pair[left, right] += d
    assert {p: d for p, d in by_pair.items() if d} == {p: after[p] - before[p] for p in {*before, *after} if after[p] != before[p]}


def test_forecast_takes_merges_back():
    rnd = random.Random(1)
    words = [([rnd.randint(0, 4) for _ in range(rnd.randint(1, 12))], rnd.randint(1, 9)) for _ in range(50)]
    steps = [((0, 1), 5), ((5, 2), 6), ((3, 3), 7), ((6, 7), 8)]
    tried, wanted = merging.Forecast(words), merging.Forecast(words)
    for pair, joined in steps:
        tried.merge(pair, joined)
    tried.keep(2)
    for pair, joined in steps[:2]:
        wanted.merge(pair, joined)
    assert tried.words == wanted.words and +tried.counts == +wanted.counts
    assert tried.merge(*steps[2]) == wanted.merge(*steps[2])


def test_ranking_is_by_count_then_bytes():
    names = [b"a", b"ab", b"b", b"abc"]
    r = merging.Ranking({(0, 0): 5, (1, 0): 5, (0, 2): 5, (3, 0): 5, (2, 2): 4}, names)
    order = []
    while pair := r.best():
        order.append(pair)
        r.add(pair, -r.counts[pair])
    assert order == [(3, 0), (1, 0), (0, 2), (0, 0), (2, 2)]


def test_same_bytes_built_twice(spark):
    # "abc" is built from a+bc and from ab+c.
    words = {"abc": 50, "abx": 30, "bcy": 45, "abcd": 20, "zab": 60, "cq": 3}
    df = spark.createDataFrame([(0, " ".join(w for w, n in words.items() for _ in range(n)))], "doc_id int, text string")
    counts = counts_of([df.first()["text"]])
    for top, sample in ((4, 2), (1000, 1000)):
        model = bpe.train_bpe(df, 256 + 40, [], top_pairs=top, sample_words=sample)
        # A pair may come twice; the later rank holds.
        want = one_at_a_time(counts, 40)
        assert model.merges == {p: k for k, p in enumerate(want)} and list(model.tokens.values())[256:] == [a + b for a, b in want]


@pytest.mark.parametrize("docs,merges,top,sample", [(9, 1000, 10_000, 100_000), (20, 100, 60, 50), (1, 10**6, 300, 100)])
def test_train_on_documents_equals_one_at_a_time(spark, data, docs, merges, top, sample):
    df = spark.read.parquet(f"{data}/documents.parquet").filter(f"doc_id < {docs}")
    texts = [r.text for r in df.collect()]
    model = bpe.train_bpe(df, 256 + merges, [], top_pairs=top, sample_words=sample)
    want = one_at_a_time(counts_of(texts), merges)
    assert model.merges == {p: k for k, p in enumerate(want)}
    assert list(model.tokens.values())[256:] == [a + b for a, b in want]


def test_long_words_take_n_log_n(docs_of):
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcd") for _ in range(200_000))
    model = bpe.train_bpe(docs_of([long[:3000]]), 256 + 60, [])
    start = time.perf_counter()
    ids = bpe.encode(docs_of([long]), model).first()["input_ids"]
    assert time.perf_counter() - start < 20
    assert b"".join(model.tokens[i] for i in ids) == long.encode()
    assert bpe.encode(docs_of([long[:4000]]), model).first()["input_ids"] == plain_encode(long[:4000], model)


def test_resume(docs_of):
    df = docs_of(GOLDEN)
    first = bpe.train_bpe(df, 260, [fixed.END_OF_TEXT])
    whole = bpe.train_bpe(df, 265, [fixed.END_OF_TEXT])
    more = bpe.train_bpe(df, 265, [fixed.END_OF_TEXT], model=first)
    assert more.merges == whole.merges and more.tokens == whole.tokens
    again = bpe.train_bpe(df, 262, [fixed.END_OF_TEXT], model=first, replay=False)
    # the same pair is found again and takes a new id and rank
    assert again.tokens[260] == b"we" and again.merges[(b"w", b"e")] == 3


def plain_encode(text, model):
    parts = regex.split("(" + "|".join(map(regex.escape, model.specials)) + ")", text) if model.specials else [text]
    inverse, out = {t: i for i, t in model.tokens.items()}, []
    for part in parts:
        if part in model.specials:
            out.append(model.specials[part])
            continue
        for word in SPLIT.findall(part):
            s = [bytes([b]) for b in word.encode()]
            while True:
                options = [(model.merges[p], i) for i, p in enumerate(zip(s, s[1:])) if p in model.merges]
                if not options:
                    break
                i = min(options)[1]
                s = s[:i] + [s[i] + s[i + 1]] + s[i + 2:]
            out += [inverse[x] for x in s]
    return out


TEXTS = ["low lower newest<|endoftext|>\n", "", "  ", "widesté 中 aaa\x00", "<|endoftext|><|endoftext|>", "<|endof"]


@pytest.mark.parametrize("memo_words", [1, 500_000])
def test_encode_decode(docs_of, monkeypatch, memo_words):
    model = bpe.train_bpe(docs_of(GOLDEN), 265, [fixed.END_OF_TEXT])
    monkeypatch.setattr(bpe, "MEMO_WORDS", memo_words)
    assert "Exchange" not in bpe.encode(docs_of(TEXTS), model)._jdf.queryExecution().executedPlan().toString()
    coded = bpe.encode(docs_of(TEXTS), model).orderBy("doc_id")
    rows = coded.select("*", bpe.decode(F.col("input_ids"), model).alias("text")).collect()
    assert [r.input_ids for r in rows] == [plain_encode(t, model) for t in TEXTS]
    assert [r.text for r in rows] == TEXTS


def test_decode_replaces_and_raises(spark):
    model = bpe.Tokenizer(spark)
    rnd = random.Random(3)
    rows = [[rnd.choice([65, 0xC3, 0xA9, 0xE4, 0xB8, 0xAD, 0xF0, 0x9F, 0xFF, 0xED, 0xA0]) for _ in range(12)] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, ids array<int>")
    got = [r.t for r in df.select("i", bpe.decode(F.col("ids"), model).alias("t")).orderBy("i").collect()]
    assert got == [bytes(r).decode("utf-8", errors="replace") for r in rows]
    with pytest.raises(Exception, match="outside the vocabulary"):
        spark.createDataFrame([([256],)], "ids array<int>").select(bpe.decode(F.col("ids"), model)).collect()



def test_model_round_trip(spark, docs_of, tmp_path):
    model = bpe.train_bpe(docs_of(GOLDEN), 262, [fixed.END_OF_TEXT])
    token_io.save_tokenizer(model, f"{tmp_path}/m")
    back = token_io.load_tokenizer(spark, f"{tmp_path}/m")
    assert (back.tokens, back.merges, back.specials) == (model.tokens, model.merges, model.specials)
    (tmp_path / "n.json").write_text('{"vocab": {"0": "00"}, "merges": {"61|62": 0}}')
    bare = token_io.load_tokenizer(spark, f"{tmp_path}/n.json")
    assert bare.specials == {} and bare.merges == {(b"a", b"b"): 0}


def test_token_stats(docs_of):
    model = bpe.Tokenizer(docs_of([""]).sparkSession)
    row = bpe.token_stats(bpe.encode(docs_of(["aab", "é", ""]), model), model).first()
    assert (row.docs, row.tokens, row.bytes, row.bytes_per_token, row.used_ids) == (3, 5, 5, 1.0, 4)


def test_many_words_merge_like_one_at_a_time():
    rnd = random.Random(4)
    for _ in range(100):
        words = [[rnd.randrange(3) for _ in range(rnd.randrange(12))] for _ in range(rnd.randrange(20))]
        times, steps, known = [rnd.randrange(1, 9) for _ in words], [], [0, 1, 2]
        for joined in range(3, 3 + rnd.randrange(1, 8)):
            steps.append(((rnd.choice(known), rnd.choice(known)), joined))
            known.append(joined)
        options, changes, since = {}, {}, rnd.randrange(len(steps) + 1)
        for order, (pair, joined) in enumerate(steps):
            options.setdefault(pair, []).append((order, joined))
        want = [merging.merge_symbols(w, options, True, n, since, changes) for w, n in zip(words, times)]
        flat = np.array([s for w in words for s in w], np.int32)
        got, sizes, sums = merging.merge_words(flat, np.array([len(w) for w in words], int), steps, np.array(times, int), since)
        assert got.tolist() == [s for w in want for s in w] and sizes.tolist() == [len(w) for w in want]
        net = Counter()
        for *key, d in zip(*(c.tolist() for c in sums)):
            net[tuple(key)] += d
        assert {k: d for k, d in net.items() if d} == {k: d for k, d in changes.items() if d}


def test_a_worker_holds_the_words_of_few_rows(spark, monkeypatch):
    made = []
    real = F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda fn: made.append(fn) or real(kind)(fn))
    bpe.count_ids(F.col("text"), bpe.Tokenizer(spark))
    rows = pa.array([[f"w{i % 50}"] * 500 for i in range(3000)] + [None, []])
    tracemalloc.start()
    got = made[0](rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[7].as_py() == list(b"w7") * 500 and got[-1].as_py() == got[-2].as_py() == []
    # The words alone would be 1.5 million strings.
    assert peak < 50 << 20
