"""Duplicates across batches of a stream, and scoring with models too large to send."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import safety
from textloom.operators.neardup import NearDuplicates
from textloom.streaming.history import TEXTS, History


def chained_texts(rnd, families=6, length=60):
    """Texts that drift a word at a time, so that the ends of a family are linked only through others."""
    texts = []
    for f in range(families):
        words = [f"f{f}w{rnd.randint(0, 10**6)}" for _ in range(length)]
        for step in range(5):
            texts += [" ".join(words)] * rnd.choice([1, 1, 3])
            words[step * 11 + rnd.randint(0, 5)] = f"x{rnd.randint(0, 10**6)}"
    return texts + ["", None, "", "one two", "one two"]


def test_batches_keep_what_one_run_keeps(spark, tmp_path):
    rnd = random.Random(2)
    texts = chained_texts(rnd)
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {r.doc_id for r in NearDuplicates(docs).kept_ids().collect()}
    assert 1 < len(expected) < len(rows)
    # Ids come in any order, so smaller ids of older texts and links between older ones occur.
    rnd.shuffle(rows)
    history, emitted = History(spark, str(tmp_path / "h"), hubs=1), set()
    half = len(rows) // 2
    for n, part in enumerate([rows[:half], [], rows[half:]]):
        history.extend(spark.createDataFrame(part, "doc_id long, text string"), n)
        kept = {r.doc_id for r in history.kept_ids().collect()}
        emitted |= kept & {i for i, _ in part}
    # What stays in the end was written with its batch.
    assert kept == expected and kept <= emitted


def test_batch_left_half_written_is_replaced(spark, tmp_path):
    history = History(spark, str(tmp_path / "h"))
    text = " ".join(f"w{i}" for i in range(40))
    history.extend(spark.createDataFrame([(5, text), (6, "other words")], "doc_id long, text string"), 0)
    second = spark.createDataFrame([(3, text), (7, text + " more")], "doc_id long, text string")
    history.extend(second, 1)
    # As if the batch had stopped before its last tables.
    half = History(spark, str(tmp_path / "h"))
    half._write(spark.createDataFrame([], "node long, label long"), "labels", 1)
    half.extend(second, 1)
    assert sorted(r.doc_id for r in half.kept_ids().collect()) == [3, 6]


def test_scores_by_join_equal_scores_in_the_row(spark, docs_of):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["the"] * 6 + [f"w{i}" for i in range(40)]) for _ in range(rnd.randint(1, 60)))
             for _ in range(60)] + ["", None, "unknown only here"]
    docs = docs_of(texts)
    labels = docs.filter("doc_id < 40").select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"),
                                               (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = safety.nb_fit(docs, labels)
    in_row = {r.doc_id: r for r in safety.nb_odds(docs, model).collect()}
    for hot_keys in (4, 100_000):
        odds = safety.nb_odds(docs, model, broadcast_rows=1, hot_keys=hot_keys)
        by_join = {r.doc_id: r for r in odds.collect()}
        assert in_row.keys() == by_join.keys() and len(by_join) == len(texts)
        for i, r in in_row.items():
            assert r.odds_toxic == pytest.approx(by_join[i].odds_toxic, abs=1e-9)
            assert r.odds_nsfw == pytest.approx(by_join[i].odds_nsfw, abs=1e-9)
    assert by_join[len(texts) - 1].odds_toxic == pytest.approx(model.priors["toxic"])
    whole = safety.score_harmful(docs, model, broadcast_rows=1)
    assert whole.columns == safety.score_harmful(docs, model).columns and whole.count() == len(texts)
    # No text is exploded twice, and empty documents form no key of the join.
    plan = odds._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_only_words_that_are_not_sent_are_joined(spark, docs_of, monkeypatch):
    """Words beyond the weights that are sent are listed once a text; rows that repeat a key have their own scores."""
    texts = ["the the a b", "the a a c", "the b rare", "the the rare new", "the", None]
    docs = docs_of(texts).unionByName(spark.createDataFrame([(0, "a a a"), (None, "the b")], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, i % 2, i // 2 % 2) for i in range(4)], "doc_id long, quality int, toxic int")
    model = safety.nb_fit(docs_of(texts), labels)
    written, write = {}, safety.materialize
    monkeypatch.setattr(safety, "materialize", lambda df, tag: written.setdefault(tag, write(df, tag)))
    by_join = safety.nb_odds(docs, model, broadcast_rows=2)
    same = lambda df: sorted((r.doc_id is None, r.doc_id or 0, round(r.odds_nsfw, 9), round(r.odds_toxic, 9)) for r in df.collect())
    assert same(by_join) == same(safety.nb_odds(docs, model))
    assert sorted(r.token for r in written["met-weights"].collect()) == ["b", "c", "new", "rare"]
    assert "document-words" not in written


def test_nothing_is_read_before_the_first_batch(spark, docs_of, tmp_path):
    old = History(spark, str(tmp_path))._before("texts", TEXTS, 0)
    assert old.dtypes == [("node", "bigint"), ("print", "string"), ("buckets", "array<bigint>"), ("text", "string")]
    new = docs_of(["a"]).withColumnRenamed("doc_id", "node").join(old.select("node"), "node", "left_anti")
    assert "Join" not in new._jdf.queryExecution().optimizedPlan().toString() and new.count() == 1
