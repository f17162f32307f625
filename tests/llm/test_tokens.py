"""Operators 1, 8 and 9 against the tokenizers library."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import bpe_rounds, packing, queries, token_trees
from textloom.llm.chunks import ChunkMemo, byte_bpe, byte_bpe_keys, literal

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "B", "é", "É", "Σ", "ΑΣ", "İ", "ß", "'s", "'T", " ", "  ", "\n", "\n\n", " \n", "\t", "\x1c", "\x85", "\xa0", "　",
         "1", "²", "Ⅷ", "!", "?!", "<|endoftext|>", "<|startoftext|>", "中文", "😀", "́", "hello", "aaaa", "ﬁ", "\x00", " word", " x"]
EDGE = [None, "", " ", "\n", "a", "the the the", "x" * 30_000, "a\n\nb", "tail ", " head", "<|endoftext|>", "hi <|endoftext|> there"]


def texts(seed, n=400):
    rng = random.Random(seed)
    return EDGE + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def lib(path, ordinary=False):
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = ordinary
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def table(spark, values, name="text"):
    rows = [(i, t, "extra", i) for i, t in enumerate(values)]
    return spark.createDataFrame(rows, f"doc_id long, {name} string, ids string, score long")


def test_word_bpe_equals_the_library(spark):
    values, want = texts(1), lib(WORDS)
    docs = table(spark, values)
    got = {r.doc_id: r.ids for r in bpe_rounds.encode(docs, WORDS).collect()}
    assert all(got[i] == want(t) for i, t in enumerate(values))
    tok = Tokenizer.from_file(WORDS)
    back = {r.doc_id: r.text for r in bpe_rounds.decode(bpe_rounds.encode(docs, WORDS), WORDS).collect()}
    assert all(back[i] == tok.decode(got[i], skip_special_tokens=False) for i in got)
    for r in bpe_rounds.digests(docs, WORDS).collect():
        assert r.n_tokens == len(got[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(got[r.doc_id], "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back[r.doc_id].encode()).hexdigest()


def test_merge_of_repeats():
    bpe, want = bpe_rounds.WordBpe(WORDS), lib(WORDS)
    words = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 20)]
    ids, size = bpe.merge(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [want(w) for w in words]


@pytest.mark.parametrize("fn", [lambda d: bpe_rounds.digests(d, WORDS), lambda d: bpe_rounds.encode(d, WORDS),
                                lambda d: token_trees.build_trees(d, BYTES)])
def test_empty_tables_and_repeated_rows(spark, fn):
    docs = table(spark, ["a b"])
    assert fn(docs.limit(0)).count() == 0
    assert fn(docs.unionByName(docs)).count() == 2


def test_a_full_memory_starts_afresh():
    bpe, _ = byte_bpe(BYTES)
    memo, want = ChunkMemo(bpe.encode, limit=5), lib(BYTES)
    for t in texts(4, 50):
        got = memo.ids(next(memo.encoded([bpe.keys(t or "")])))
        assert got.tolist() == want(t)


def test_keys_spell_the_text():
    for t in texts(5):
        assert "".join(map(literal, byte_bpe_keys(t or ""))) == (t or "")


# --- packing --------------------------------------------------------------------------

def check_packing(rows, want, window):
    """Every id in one piece, sequences gapless and within the window, hardly any padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == want.keys()
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        assert [x for p in pieces for x in p.ids] == want[i] and {p.doc_tokens for p in pieces} == {len(want[i])}
        assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and p.length == len(p.ids) for p in pieces)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        fill = sum(p.length for p in pieces)
        assert fill == window or fill < window and fill & (fill - 1) == 0


def test_packing_keeps_every_id(spark):
    values, want = texts(2) + ["word " * 5000], lib(BYTES)
    docs = table(spark, values).repartition(3)
    ids = {i: want(t) + [1] for i, t in enumerate(values)}
    check_packing(packing.pack(docs, BYTES).collect(), ids, 2048)
    check_packing(packing.pack(docs, BYTES, window=64).collect(), ids, 64)


def test_packing_of_no_and_repeated_rows(spark):
    docs = table(spark, ["a b"])
    assert packing.pack(docs.limit(0), BYTES).count() == 0
    assert packing.pack(docs.unionByName(docs), BYTES).agg(F.sum("length")).first()[0] == 2 * len(lib(BYTES)("a b") + [1])


def test_sum_of_squares_takes_the_best_level():
    rng, rule, window = random.Random(3), packing.SumOfSquares(32), 32
    fill = {}
    for _ in range(3000):
        size = rng.randint(1, 31)
        levels = rule.levels.copy()

        def squares(level):
            after = levels.copy()
            if level:
                after[level] -= 1
            if level + size < window:
                after[level + size] += 1
            return int((after[1:window] ** 2).sum())

        best = min(squares(h) for h in range(window - size + 1) if h == 0 or levels[h])
        where, level = rule.place(size)
        assert fill.get(where, 0) == level and squares(level) == best
        fill[where] = level + size
        counts = np.bincount([f for f in fill.values() if f < window], minlength=window + 1)
        assert (rule.levels[1:window] == counts[1:window]).all()


# --- token trees ----------------------------------------------------------------------

def test_edits_keep_the_count_of_the_whole_text(monkeypatch):
    memo, want, rng = token_trees.counting_memo(BYTES), lib(BYTES, ordinary=True), random.Random(6)
    for _ in range(400):
        monkeypatch.setattr(token_trees, "LEAF_WORDS", rng.choice([1, 2, 3, 32]))
        tree = token_trees.TokenTree("".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))), memo)
        assert tree.n_tokens == len(want(tree.text))
        for _ in range(4):
            a = rng.randint(0, len(tree.text))
            b = rng.randint(a, min(len(tree.text), a + 8))
            new, old = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 4))), tree.text
            tree.edit(a, b, new)
            assert tree.text == old[:a] + new + old[b:]
            assert tree.n_tokens == len(want(tree.text)) and tree.chars[1] == len(tree.text)


def test_many_edits_at_once(monkeypatch):
    memo, want, rng = token_trees.counting_memo(BYTES), lib(BYTES, ordinary=True), random.Random(8)
    parts = PARTS + ["。", "，", "…", "line\n", "\x1d", "_", "x.y", "'", "ab\tc"]
    for _ in range(300):
        monkeypatch.setattr(token_trees, "LEAF_WORDS", rng.choice([1, 2, 8]))
        monkeypatch.setattr(token_trees, "LONG_CHUNK", rng.choice([1, 4, 48]))
        trees = [token_trees.TokenTree("".join(rng.choice(parts) for _ in range(rng.randint(0, 60))), memo) for _ in range(3)]
        assert all(t.n_tokens == len(want(t.text)) for t in trees)
        for _ in range(2):
            work, texts_ = [], []
            for t in trees:
                edits = [(a, min(len(t.text), a + rng.randint(0, 6)), "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))))
                         for a in (rng.randint(0, len(t.text)) for _ in range(rng.randint(0, 6)))]
                edits, out, at = token_trees.usable(edits, len(t.text)), [], 0
                for a, z, new in edits:
                    out += [t.text[at:a], new]
                    at = z
                work.append((t, edits))
                texts_.append("".join(out) + t.text[at:])
            token_trees.edit_all(work, memo)
            assert [t.text for t in trees] == texts_
            assert all(t.n_tokens == len(want(t.text)) and t.chars[1] == len(t.text) for t in trees)


@pytest.mark.parametrize("text", ["".join(chr(0x4e00 + i * 37 % 9000) + ("。" if i % 11 == 0 else "") for i in range(20_000)),
                                  "\n".join(f"line{i}without-spaces" for i in range(2_000)), "a,b;" * 5000])
def test_text_without_spaces_is_cut(text):
    memo, want = token_trees.counting_memo(BYTES), lib(BYTES, ordinary=True)
    tree = token_trees.TokenTree(text, memo)
    leaves = tree.chars[tree.width:]
    edits = [(i, i + 1, "!") for i in range(0, len(text), len(text) // 10)]
    bound = 3 * len(edits) * int(leaves.max())
    assert len(leaves) > 50 and bound < len(text) * 3
    token_trees.edit_all([(tree, edits)], memo)
    assert tree.encoded <= min(bound, len(text) + len(edits)) and tree.n_tokens == len(want(tree.text))
    one = token_trees.TokenTree(text, memo)
    one.edit(len(text) // 2, len(text) // 2 + 1, "X")
    assert one.encoded <= 3 * int(leaves.max()) + 1 and one.n_tokens == len(want(one.text))


def test_one_edit_encodes_little():
    memo = token_trees.counting_memo(BYTES)
    tree = token_trees.TokenTree("some words of a long text " * 4000, memo)
    tree.edit(50_000, 50_004, "other")
    assert tree.encoded < 1000


def test_trees_are_kept_and_edited(spark):
    docs = table(spark, ["one two three", None, "x " * 500])
    edits = spark.createDataFrame([(0, 4, 7, "2"), (0, 5, 9, "overlaps"), (0, 0, 0, "so "), (1, 0, 0, "new"), (2, 0, 4, None),
                                   (2, 5000, 5001, "outside"), (9, 0, 1, "unknown"), (None, 0, 1, "x")],
                                  "doc_id long, start int, stop int, text string")
    want = lib(BYTES, ordinary=True)
    got = {r.doc_id: r for r in token_trees.edit_trees(token_trees.build_trees(docs, BYTES), edits, BYTES).collect()}
    assert {i: r.text for i, r in got.items()} == {0: "so one 2 three", 1: "new", 2: "x " * 498}
    assert all(r.tokens[1] == len(want(r.text)) for r in got.values())


def test_registered_count_equals_encoding_the_edited_text(spark, data):
    import re

    def edited(text):
        spans = sorted((m.start(), m.end(), new) for pattern, new, _ in queries.EDITED for m in re.finditer(pattern, text))
        out, at = [], 0
        for a, b, new in spans:
            if a >= at:
                out += [text[at:a], new]
                at = b
        return "".join(out) + text[at:]

    want = lib(BYTES, ordinary=True)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = queries.op1_token_counts(spark, data).collect()
    assert len(rows) == len(docs) and sum(r.n_edits for r in rows) > 0
    for r in rows:
        assert r.n_tokens_before == len(want(docs[r.doc_id])) and r.n_tokens == len(want(edited(docs[r.doc_id])))


def test_registered_packing_and_bpe(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    want, words = lib(BYTES), lib(WORDS)
    local = {r.doc_id: r.text for r in docs.collect()}
    got = packing.pack(docs, BYTES)
    check_packing(got.collect(), {i: want(t) + [1] for i, t in local.items()}, 2048)
    def listed(df):
        return sorted(map(tuple, df.drop("ids").collect()))

    assert listed(queries.op8_packing(spark, data)) == listed(got)
    for r in queries.op9_bpe(spark, data).collect():
        assert r.n_tokens == len(words(local[r.doc_id]))
    assert docs.filter(F.col("text").isNull()).count() == 0
