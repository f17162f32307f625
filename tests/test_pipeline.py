import gzip
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom import fixed
from textloom.operators import bigram, bpe, chat, dataset, safety
from textloom.operators.ranking import nth_key, rank_ordered, rank_shuffled
from textloom.plans import clean as clean_plan
from textloom.plans import collect
from textloom.sources import lines, pages, tokens
from textloom.streaming import jobs


@pytest.fixture(scope="module")
def tables(spark, data):
    return {t: spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels", "pages", "conversations")}


@pytest.fixture(scope="module")
def model(tables):
    return safety.nb_fit(clean_plan.normalized(tables["documents"]), tables["labels"])


# --- sources ------------------------------------------------------------------

def test_line_sources(spark, tmp_path):
    (tmp_path / "u.txt.gz").write_bytes(gzip.compress(b"http://a \n\n  \nhttp://b\n"))
    got = lines.read_urls(spark, str(tmp_path / "u.txt.gz")).collect()
    assert [(r.url_rank, r.url) for r in got] == [(0, "http://a"), (3, "http://b")]
    (tmp_path / "l.txt").write_text("__label__high good text\n\n__label__low bad\nplain\n")
    assert [tuple(r) for r in lines.read_labelled_lines(spark, str(tmp_path / "l.txt")).collect()] == [
        ("high", "good text"), ("low", "bad"), (None, "plain")]
    df = spark.createDataFrame([("a\nb\r",)], "text string")
    lines.write_labelled_lines(df, str(tmp_path / "out"))
    assert [r.text for r in lines.read_lines(spark, str(tmp_path / "out")).collect()] == ["__label__high a b"]
    lines.export_split(df.select(F.lit("first").alias("text")), str(tmp_path / "e"))
    lines.export_split(df.select(F.lit("second").alias("text")), str(tmp_path / "e"))
    assert [r.text for r in lines.read_lines(spark, str(tmp_path / "e")).collect()] == ["first"]


def test_lines_of_several_files(spark, tmp_path):
    """Numbers follow the paths, not the sizes."""
    for name, n in (("c", 3), ("a", 1), ("b", 5000), ("d", 0)):
        (tmp_path / name).write_text("".join(f"http://{name}/{i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    got = sorted(map(tuple, lines.read_urls(spark, str(tmp_path)).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [u for _, u in got] == [f"http://{name}/{i}" for name, n in (("a", 1), ("b", 5000), ("c", 3)) for i in range(n)]
    assert [n for n, _ in got] == list(range(5004))


def test_one_capture_of_a_page(spark):
    urls = spark.createDataFrame([(0, "http://a")], "url_rank long, url string")
    crawled = spark.createDataFrame([(3, "http://a", "later"), (1, "http://a", "first"), (1, "http://a", "first"), (0, "http://b", "other")], "page_id long, url string, html string")
    assert [(r.url_rank, r.page_id, r.html) for r in pages.fetch_pages(urls, crawled).collect()] == [(0, 1, "first")]


def test_scratch_tables_go(spark):
    import os

    from textloom.session import materialize, scratch, shared_dir

    def tables():
        root = shared_dir(spark).removeprefix("file:") + "/textloom"
        return sum(len(os.listdir(f"{root}/{app}")) for app in os.listdir(root)) if os.path.isdir(root) else 0

    before = tables()
    with scratch(spark):
        materialize(spark.range(5), "a")
        with scratch(spark):
            materialize(spark.range(5), "b")
            assert tables() == before + 2
        assert tables() == before + 1
    assert tables() == before


def test_fetch_pages_from_bytes(spark):
    urls = spark.createDataFrame([(0, " http://a "), (1, "http://gone"), (2, "")], "url_rank long, url string")
    crawled = spark.createDataFrame([(1, "http://a", bytearray(b"<meta charset=utf-8>\xff"))], "page_id long, url string, html binary")
    assert [(r.url_rank, r.html) for r in pages.fetch_pages(urls, crawled).collect()] == [(0, "<meta charset=utf-8>�")]


def test_token_dataset(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2], "train"), (2, [3], "valid")], "doc_id long, input_ids array<int>, split string")
    tokens.write_token_dataset(df, str(tmp_path / "t"))
    back = tokens.read_token_dataset(spark, str(tmp_path / "t"), "valid")
    assert back.columns == ["input_ids"] and [r.input_ids for r in back.collect()] == [[3]]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "doc_id" not in plan and "PartitionFilters: [isnotnull(split" in plan


# --- ranking and training sets --------------------------------------------------

def test_ranks(spark):
    rnd = random.Random(2)
    ids = rnd.sample(range(10**12), 400) + list(range(300))
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(5)
    assert [r["rank"] for r in rank_ordered(df, "doc_id", bucket_rows=20).orderBy("doc_id").collect()] == list(range(1, 701))
    wide = df.withColumn("many", F.array_repeat("doc_id", 3))
    for found in (rank_ordered(wide, "doc_id", bucket_rows=100), rank_shuffled(wide, "doc_id", 7, bucket_rows=100)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert all("many" not in line for line in plan.splitlines() if "Window" in line or "Sort" in line)
    ranked = rank_shuffled(df, "doc_id", 7).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 701))
    assert {r.doc_id: r["rank"] for r in ranked} == {
        r.doc_id: r["rank"] for r in rank_shuffled(df.repartition(2), "doc_id", 7).collect()}
    split = dataset.split_sets(df, 0.1, 7).filter("split = 'valid'").collect()
    assert {r.doc_id for r in split} == {r.doc_id for r in ranked if r["rank"] <= 70}
    assert dataset.split_sets(df.limit(0)).count() == 0


def test_examples_and_batches(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, list(range(1, 10))), (3, [])], "doc_id long, input_ids array<int>")
    rows = dataset.training_examples(df, 4).orderBy("doc_id").collect()
    assert [(r.x, r.y) for r in rows] == [([1, 2, 0, 0], [2, 0, 0, 0]), ([1, 2, 3, 4], [2, 3, 4, 5]), ([0] * 4, [0] * 4)]
    assert [r.m for r in dataset.training_examples(df, 4).orderBy("doc_id").select(dataset.loss_mask(F.col("y")).alias("m")).collect()][0] == [True, False, False, False]
    assert [r.batch for r in dataset.make_batches(df, 2).orderBy("doc_id").collect()] == [0, 0, 1]
    assert sorted(r.batch for r in dataset.make_batches(df, 2, seed=1).collect()) == [0, 0, 1]


# --- evaluation -----------------------------------------------------------------

def test_bigram_losses(spark):
    rnd = random.Random(5)
    seqs = [[rnd.randrange(0, 5) for _ in range(rnd.randint(1, 9))] for _ in range(30)]
    ex = dataset.training_examples(
        spark.createDataFrame(list(enumerate(seqs)), "doc_id long, input_ids array<int>"), 6)
    rows = {r.doc_id: (r.x, r.y) for r in ex.collect()}
    train = {i for i in rows if i < 20}
    n, tot = Counter(), Counter()
    for i in train:
        for a, b in zip(*rows[i]):
            if b:
                n[a, b] += 1
                tot[a] += 1
    nll = {i: (sum(-math.log((n[a, b] + 1) / (tot[a] + 5)) for a, b in zip(x, y) if b), sum(b != 0 for b in y))
           for i, (x, y) in rows.items()}
    fitted = bigram.fit_bigram(ex.filter("doc_id < 20"), 5)
    scored = bigram.token_nll(ex, fitted)
    for r in scored.collect():
        assert (r.nll, r.targets) == (pytest.approx(nll[r.doc_id][0]), nll[r.doc_id][1])
    losses = bigram.batch_loss(scored.withColumn("batch", F.floor(F.col("doc_id") / 4)))
    by_batch = {}
    for i, (s, c) in nll.items():
        t = by_batch.setdefault(i // 4, [0, 0])
        t[0] += s
        t[1] += c
    expected = [s / c for _, (s, c) in sorted(by_batch.items()) if c]
    assert [r.loss for r in losses.orderBy("batch").collect()] == pytest.approx(expected)
    assert bigram.perplexity(losses).first().perplexity == pytest.approx(math.exp(sum(expected) / len(expected)))
    assert bigram.mean_loss(losses.filter("false")).first().loss == 0.0
    running = bigram.running_loss(losses, chunk=3).orderBy("batch").collect()
    assert [r.running for r in running] == pytest.approx(
        [sum(expected[:i + 1]) / (i + 1) for i in range(len(expected))])


def test_topk_keeps_ties(spark):
    pairs = spark.createDataFrame([(0, i, 1, p) for i, p in enumerate([0.3, 0.2, 0.2, 0.1])], "prev int, next int, n long, p double")
    m = bigram.Bigram(pairs, None, 4)
    top = bigram.next_token_topk(m, 2).orderBy("next").collect()
    assert [r.next for r in top] == [0, 1, 2] and [r.p for r in top] == pytest.approx([3 / 7, 2 / 7, 2 / 7])
    assert bigram.next_token_topk(m, 0).count() == 4
    assert bigram.next_token_topk(m, 4, 0.0).orderBy("next").first().p == pytest.approx(1.0)
    ids = spark.createDataFrame([([1, 2, 3],), ([1],)], "i array<int>").select(bigram.clip_context(F.col("i"), 2).alias("c"))
    assert [r.c for r in ids.collect()] == [[2, 3], [1]]


# --- conversations ----------------------------------------------------------------

TURNS = [(1, 0, "system", "s"), (1, 1, "user", "hi "), (1, 2, "assistant", " yo\n"), (1, 3, "user", "  "),
         (1, 4, "user", "QUIT"), (1, 5, "assistant", "late"), (2, 0, "user", "quit now"), (2, 1, "assistant", "ok")]


def test_turns(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    for limit in (1, 1_000_000):
        kept = chat.filter_turns(df, limit)
        assert [(r.conv_id, r.turn) for r in kept.orderBy("conv_id", "turn").collect()] == [
            (1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]
    rendered = chat.render_conversation(kept).orderBy("conv_id", "turn").collect()
    assert "".join(r.piece for r in rendered if r.conv_id == 1) == "\nUser: hi \nBot: yo"


def test_context_budget_of_many_chunks(spark):
    """User turns never clear, so every chunk starts with all before it."""
    turns = [(1, t, "user", 3) for t in range(3000)] + [(2, t, ("user", "assistant")[t % 2], 1 + t % 5) for t in range(3000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, tokens long")
    got = {(r.conv_id, r.turn): (r.held, r.cleared) for r in chat.context_budget(df, 20, chunk_turns=1).collect()}
    held, conv = 0, None
    for c, t, role, n in turns:
        held = (held if c == conv else 0) + n
        conv, clear = c, role == "assistant" and held > 20
        assert got[c, t] == (held, clear)
        held = 0 if clear else held


@pytest.mark.parametrize("chunk", [1, 3, 1024])
def test_context_budget(spark, chunk):
    rnd = random.Random(11)
    rows, expected = [], []
    for conv in range(6):
        held = 0
        for turn in range(rnd.randint(1, 25)):
            if rnd.random() < 0.1:
                continue
            role, n = ("user", "assistant")[turn % 2], rnd.randint(1, 9)
            rows.append((conv, turn, role, n))
            held += n
            clear = role == "assistant" and held > 20
            expected.append((conv, turn, held, clear))
            held = 0 if clear else held
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, tokens int")
    got = chat.context_budget(df, 20, chunk_turns=chunk).orderBy("conv_id", "turn").collect()
    assert [tuple(r) for r in got] == expected


def test_budget_counts_what_the_encoder_gives(spark):
    """Counts of pieces add up to the count of the whole context, also after empty replies and specials."""
    said = ["hi there, hi", " ", "", "a  b\n\nc ", "<|endoftext|>x", "it's  ", "\u00e9\u4e2d!?", "12 ", "end"]
    rows = [(1, t, ("user", "assistant")[t % 2], x) for t, x in enumerate(said)]
    pieces = chat.render_conversation(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    model = bpe.train_bpe(pieces, fixed.BYTE_TOKENS + 1 + 12, [fixed.END_OF_TEXT], text="piece")
    counted = pieces.withColumn("tokens", bpe.count_ids(F.col("piece"), model)).orderBy("turn").collect()
    whole = spark.createDataFrame([(0, "".join(r.piece for r in counted))], "doc_id long, text string")
    assert sum(r.tokens for r in counted) == len(bpe.encode(whole, model).first().input_ids)
    null = spark.createDataFrame([(None,)], "piece string").select(bpe.count_ids(F.col("piece"), model).alias("n"))
    assert null.first().n == 0


# --- safety -------------------------------------------------------------------------

def test_naive_bayes(spark, docs_of):
    texts = ["good good fine", "bad awful", "fine day", "bad day", "", "unknown words bad"]
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1), (2, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    m = safety.nb_fit(docs_of(texts), labels)
    pos, neg = Counter("bad awful bad day".split()), Counter("good good fine fine day".split())
    size = len(set(pos) | set(neg))
    w = {t: math.log((pos[t] + 1) / (sum(pos.values()) + size)) - math.log((neg[t] + 1) / (sum(neg.values()) + size))
         for t in set(pos) | set(neg)}
    rows = safety.nb_score(docs_of(texts), m).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        odds = sum(w.get(x, 0) for x in t.split())
        p = 1 / (1 + math.exp(-odds))
        assert r.toxic_label == ("toxic" if odds > 0 else "non-toxic")
        assert r.toxic_score == pytest.approx(max(p, 1 - p), abs=1e-6)
    with pytest.raises(ValueError):
        safety.nb_fit(docs_of(texts), labels.filter("toxic = 0"))


def test_gates(spark):
    rows = [(0, "non-nsfw", "non-toxic", 0.75, 0.9), (1, "non-nsfw", "non-toxic", 0.76, 0.75),
            (2, "nsfw", "non-toxic", 0.9, 0.9), (3, "non-nsfw", "non-toxic", 0.9, 0.74)]
    df = spark.createDataFrame(rows, "k int, nsfw_label string, toxic_label string, nsfw_score double, toxic_score double")
    assert [r.k for r in safety.gate_label_only(df).collect()] == [0, 1, 3]
    assert [r.k for r in safety.gate_threshold(df).collect()] == [1]


def test_ml_classifier_is_reproducible(tables):
    docs = clean_plan.normalized(tables["documents"])
    def scores(d):
        m = safety.train_text_classifier(d, tables["labels"], "toxic", features=1 << 10)
        return sorted((r.doc_id, r.toxic_label, r.toxic_score) for r in safety.classify(docs, m, "toxic").collect())
    first = scores(docs)
    assert len(first) == 200 and scores(docs.repartition(3)) == first


@pytest.mark.parametrize("query", ["ml_nsfw_score", "ml_toxic_score", "ml_score_domain"])
def test_ml_queries_normalise_a_text_once(spark, monkeypatch, query):
    import __spark_entry__ as entry
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    rows = [(i, "kind words here" if i % 3 else "vile words there") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text", counted("text"))
    flags = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(entry, "_normal", lambda spark, sf: docs)
    monkeypatch.setattr(entry, "labels", lambda spark, sf: flags)
    out = entry.queries()[query](spark, "").collect()
    assert len(out) == 60 and seen.value == 60
    if query != "ml_score_domain":
        name = query[3:-6]
        assert [r[f"{name}_label"] for r in sorted(out)] == [f"non-{name}" if i % 3 else name for i in range(60)]


# --- pipelines ----------------------------------------------------------------------

def test_collect(spark, tables, model):
    urls = tables["pages"].select(F.col("page_id").alias("url_rank"), "url")
    all_rows = collect.collect_samples(urls, tables["pages"], model).orderBy("url_rank").collect()
    some = collect.collect_samples(urls, tables["pages"], model, 5).collect()
    assert sorted(map(tuple, some)) == [tuple(r) for r in all_rows[:5]]
    assert all(r.text.startswith("__label__high ") and "\n" not in r.text and len(r.text) >= 90 for r in all_rows)


def test_clean_drop_reasons_agree(tables, model):
    reasons = {r.doc_id: r.drop_reason for r in clean_plan.judge_pages(tables["documents"], model).collect()}
    kept = {r.doc_id for r in clean_plan.clean_pages(tables["documents"], model).collect()}
    assert kept == {i for i, r in reasons.items() if r is None} and len(reasons) == 200
    assert {"nsfw", "toxic"} & set(reasons.values())


def test_process_corpus_and_stream(spark, tables, model, tmp_path):
    docs = tables["documents"].select("doc_id", "text")
    lines.write_lines(docs.orderBy("doc_id").coalesce(1), str(tmp_path / "in"))
    clean_plan.process_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), model)
    written = [r.text for r in lines.read_lines(spark, str(tmp_path / "out")).collect()]
    batch = [r.text for r in clean_plan.clean(docs, model).orderBy("doc_id").collect()]
    assert sorted(written) == sorted(batch) and batch
    clean_plan.process_corpus(spark, str(tmp_path / "in"), str(tmp_path / "chunks"), model, chunk_size=50)
    chunked = [r.text for r in lines.read_lines(spark, str(tmp_path / "chunks")).collect()]
    assert sorted(chunked) == sorted(r.text for r in clean_plan.clean_chunked(docs, model, 50).collect())
    docs.repartition(1).write.parquet(str(tmp_path / "files"))
    q = jobs.stream_clean(jobs.stream_files(spark, str(tmp_path / "files")), model, str(tmp_path / "s"), str(tmp_path / "c"))
    assert q.awaitTermination(600)
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "s")).collect()) == sorted(batch)


def test_stream_counts_and_collect(spark, tables, tmp_path):
    docs = tables["documents"].select("doc_id", "text")
    docs.repartition(3).write.parquet(str(tmp_path / "files"))
    from textloom.operators.bpe import word_counts
    q = jobs.stream_word_counts(jobs.stream_files(spark, str(tmp_path / "files"), files_per_batch=1), str(tmp_path / "w"), str(tmp_path / "cw"))
    assert q.awaitTermination(600)
    assert sorted(map(tuple, jobs.read_word_counts(spark, str(tmp_path / "w")).collect())) == sorted(map(tuple, word_counts(docs).collect()))
    jobs.stream_collect(jobs.stream_files(spark, str(tmp_path / "files"), files_per_batch=1), lambda d: d.select("doc_id"),
                        90, str(tmp_path / "k"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "k")).count() == 90


@pytest.mark.parametrize("settled", [1, 10_000])
def test_nth_key_and_first_rows(spark, monkeypatch, settled):
    rnd = random.Random(2)
    values = [rnd.choice([rnd.randint(-10**15, 10**15), rnd.randint(0, 30), 7]) for _ in range(500)] + [None] * 5
    df = spark.createDataFrame([(v, "x" * 5) for v in values], "k long, t string").repartition(3)
    there = sorted(v for v in values if v is not None)
    for n in (1, 2, 100, 250, 499, 500):
        assert nth_key(df.select("k"), "k", n, 10, settled) == (there[n - 1], sum(v < there[n - 1] for v in there))
    assert nth_key(df.select("k"), "k", 501) is None
    for n in (0, 1, 180, 500, 900):
        got = collect.top_n(df, n, "k")
        assert sorted(r.k for r in got.collect()) == there[:n]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "TakeOrdered" not in plan
    assert collect.top_n(df.limit(0), 3, "k").count() == 0


def test_collect_stops_early(spark, model, monkeypatch):
    page = "<p>" + " ".join(f"word{i} some more text here" for i in range(30)) + "</p>"
    crawled = spark.createDataFrame([(i, f"http://p/{i}", page if i % 2 else "<p>short</p>") for i in range(400)], "page_id long, url string, html string")
    urls = crawled.select((F.col("page_id") * 10).alias("url_rank"), "url")
    judged = []
    real = collect.page_samples
    monkeypatch.setattr(collect, "page_samples", lambda pages, model: (judged.append(pages.count()), real(pages, model))[1])
    monkeypatch.setattr(collect, "FIRST_STEP", 10)
    whole = sorted(map(tuple, collect.collect_samples(urls, crawled, model).collect()))
    for n, steps in ((2, [10]), (6, [24]), (50, [200]), (130, [400]), (1000, [400])):
        judged.clear()
        got = sorted(map(tuple, collect.collect_samples(urls, crawled, model, n).collect()))
        assert got == whole[:n] and judged == steps
    monkeypatch.setattr(collect, "STEP_PER_SAMPLE", 1)
    judged.clear()
    assert len(collect.collect_samples(urls, crawled, model, 30).collect()) == 30 and judged == [30, 120]


def test_pages_are_neither_sorted_nor_grouped(spark):
    crawled = spark.createDataFrame([(1, "http://a", "x"), (2, "http://a", "y")], "page_id long, url string, html string")
    got = pages.fetch_pages(spark.createDataFrame([(0, "http://a")], "url_rank long, url string"), crawled)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("html" in line for line in plan.splitlines() if "Aggregate" in line or "Sort" in line)
    assert [r.html for r in got.collect()] == ["x"]


@pytest.mark.parametrize("query", ["stream_collect", "stream_word_counts"])
def test_parts_of_a_stream_are_several_files(spark, tmp_path, monkeypatch, query):
    import __spark_entry__ as entry

    rows = 400
    spark.range(rows).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    at, path = {}, entry.scratch_path
    monkeypatch.setattr(entry, "scratch_path", lambda s, tag: at.setdefault(tag, path(s, tag)))
    got = entry.queries()[query](spark, str(tmp_path))
    assert query == "stream_collect" or got.agg(F.sum("n")).first()[0] >= rows
    read = spark.read.parquet(at["stream-in"])
    sizes = [r["count"] for r in read.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == rows and max(sizes) < 0.3 * rows


def test_parts_of_lines_are_several_files(spark):
    import __spark_entry__ as entry

    rows = 400
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.concat(F.lit("line "), "id").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = entry._in_three_files(docs, "text", "doc_id")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in lines.read_lines(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == rows and max(sizes) < 0.4 * rows
    assert {r.doc_id: r.text for r in lines.number_lines(spark, path).collect()} == {i: f"line {i}" for i in range(rows)}
