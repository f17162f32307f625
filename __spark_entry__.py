
from __future__ import annotations

import re
from collections.abc import Callable
from importlib.util import find_spec

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

import oracle as O
from textloom import fixed
from textloom.functions import html, pii
from textloom.functions import text as T
from textloom.operators import bigram, bpe, chat, dataset, neardup, quality, safety
from textloom.operators.keep import keep
from textloom.plans import clean as clean_plan
from textloom.plans import collect
from textloom.session import materialize, read_table, scratch_path
from textloom.sources import lines, pages, tokens
from textloom.streaming import jobs

# The operators for training data and their pipeline are there or not as a whole.
_found = find_spec("textloom.llm")
if _found and _found.origin and find_spec("corpus_pipeline"):
    import corpus_pipeline
    from textloom.llm import queries as llm
else:
    llm = None

LENGTH, BATCH, MERGES, BUDGET, CHUNK = 512, 16, 200, 400, 250


def _table(name: str, key: str):
    return lambda spark, sf: read_table(spark, f"{sf}/{name}.parquet", key)


documents, labels = _table("documents", "doc_id"), _table("labels", "doc_id")
page_table, conversations = _table("pages", "page_id"), _table("conversations", "conv_id")


def _t():
    return F.col("text")


def _normal(spark, sf):
    return clean_plan.normalized(documents(spark, sf))


def _model(spark, sf):
    return clean_plan.fit_gates(documents(spark, sf), labels(spark, sf))


def _urls(spark, sf):
    return page_table(spark, sf).select(F.col("page_id").alias("url_rank"), F.concat(F.lit(" "), "url").alias("url"))


def _joined(c, sep=","):
    return F.array_join(c, sep)


def _digest(c):
    return F.md5(_joined(c).cast("binary"))


# --- sources and sinks ---------------------------------------------------------------


def q_read_urls(spark, sf):
    return lines.trim_urls(_urls(spark, sf)).select("url_rank", "url")


def _in_three_files(df, column, key):
    """A folder of three parts of uneven size, in the order of ``key``; a part is as many files as its rows ask for."""
    path = scratch_path(df.sparkSession, "three-files")
    most = df.agg(F.max(key)).first()[0] or 0
    part = F.when(F.col(key) < most / 50, 0).when(F.col(key) < most / 2, 1).otherwise(2)
    rows = df.select(part.alias("part"), F.col(column).alias("value"), key).repartitionByRange("part", key)
    rows.sortWithinPartitions("part", key).drop(key).write.partitionBy("part").text(path)
    return path


def q_read_url_files(spark, sf):
    return lines.read_urls(spark, _in_three_files(_urls(spark, sf), "url", "url_rank"))


def q_process_corpus(spark, sf):
    docs = documents(spark, sf).select("doc_id", T.one_line(_t()).alias("text"))
    out = scratch_path(spark, "processed")
    clean_plan.process_corpus(spark, _in_three_files(docs, "text", "doc_id"), out, _model(spark, sf))
    return lines.read_lines(spark, out)


def q_fetch_captures(spark, sf):
    crawled = page_table(spark, sf)
    again = crawled.select((F.col("page_id") + (1 << 40)).alias("page_id"), "url", F.lit("<p>later</p>").alias("html"))
    got = pages.fetch_pages(_urls(spark, sf), crawled.select("page_id", "url", "html").unionByName(again))
    return got.select("url_rank", "url", F.md5(F.col("html").cast("binary")).alias("page"))


CHARSETS = ("windows-1252", "gb2312", "shift_jis", "windows-1251", "iso-8859-1", "utf-8", "koi8-r")


@F.pandas_udf(BinaryType())
def _declared(pages: pd.Series, number: pd.Series) -> pd.Series:
    """Pages in several charsets, which they declare; other characters become entities."""
    return pd.Series([f"<meta charset='{c}'>{p}".encode(c, "xmlcharrefreplace") for p, c in zip(pages, number.map(lambda n: CHARSETS[n % len(CHARSETS)]))])


def q_decode_charsets(spark, sf):
    raw = page_table(spark, sf).select("page_id", _declared("html", "page_id").alias("html"))
    return html.extract_text(raw.select("page_id", html.decode_html(F.col("html")).alias("html")))


UNDECLARED = ("windows-1252", "gb18030", "shift_jis", "windows-1251", "koi8-r")


@F.pandas_udf(BinaryType())
def _undeclared(pages: pd.Series, number: pd.Series) -> pd.Series:
    """Pages in several charsets that declare none."""
    return pd.Series([re.sub("<meta[^>]*>", "", p).encode(UNDECLARED[n % len(UNDECLARED)], "xmlcharrefreplace") for p, n in zip(pages, number)])


def q_decode_undeclared(spark, sf):
    raw = page_table(spark, sf).select("page_id", _undeclared("html", "page_id").alias("html"))
    return html.extract_text(raw.select("page_id", html.decode_html(F.col("html")).alias("html")))


def q_fetch_pages(spark, sf):
    got = pages.fetch_pages(_urls(spark, sf), page_table(spark, sf))
    return got.select("url_rank", "url", F.md5(F.col("html").cast("binary")).alias("page"))


def _labelled_lines(spark, sf):
    high = F.when(F.col("quality") == 1, fixed.LABEL_HIGH).otherwise(fixed.LABEL_LOW)
    return documents(spark, sf).join(labels(spark, sf), "doc_id").select(
        "doc_id", F.concat(high, T.one_line(_t())).alias("text"))


def q_read_labelled_lines(spark, sf):
    path = scratch_path(spark, "labelled")
    lines.write_lines(_labelled_lines(spark, sf), path)
    return lines.read_labelled_lines(spark, path)


def q_strip_label(spark, sf):
    return _labelled_lines(spark, sf).select("doc_id", T.strip_label(_t()).alias("text"))


def q_write_lines(spark, sf):
    path = scratch_path(spark, "lines")
    lines.write_lines(documents(spark, sf), path)
    return lines.read_lines(spark, path)


def q_write_labelled_lines(spark, sf):
    path = scratch_path(spark, "labelled")
    lines.write_labelled_lines(documents(spark, sf), path)
    return lines.read_lines(spark, path)


def q_read_text_dataset(spark, sf):
    path = scratch_path(spark, "corpus")
    lines.export_split(documents(spark, sf), path)
    return lines.read_lines(spark, path)


def q_export_split(spark, sf):
    path = scratch_path(spark, "export")
    lines.export_split(conversations(spark, sf), path)
    lines.export_split(documents(spark, sf), path)  # the target exists: skipped
    return lines.read_lines(spark, path)


def _byte_tokens(spark, sf):
    return documents(spark, sf).select("doc_id", dataset.byte_ids(_t()).alias("input_ids"))


def q_token_dataset(spark, sf):
    path = scratch_path(spark, "token-sets")
    tokens.write_token_dataset(dataset.split_sets(_byte_tokens(spark, sf)), path)
    return tokens.read_token_dataset(spark, path, "valid").select(_digest(F.col("input_ids")).alias("ids"))


# --- HTML, text, personal data, quality ---------------------------------------------------


def q_extract_text(spark, sf):
    return html.extract_text(page_table(spark, sf)).select("page_id", "text")


def q_decode_html(spark, sf):
    raw = page_table(spark, sf).select("page_id", F.encode("html", "UTF-8").alias("html"))
    return raw.select("page_id", html.decode_html(F.col("html")).alias("html"))


def q_flatten_min_length(spark, sf):
    return keep(documents(spark, sf).select("doc_id", T.flatten_lines(_t()).alias("text")), T.long_enough(_t()))


def _each(fn):
    return lambda spark, sf: documents(spark, sf).select("doc_id", fn(_t()).alias("text"))


def _mask(kind):
    return lambda spark, sf: pii.mask_column(documents(spark, sf).select("doc_id", "text"), kind).withColumn(
        f"{kind}s", F.col(f"{kind}s").cast("long"))


def q_mask_pii(spark, sf):
    return pii.mask_pii(documents(spark, sf)).select(
        "doc_id", "text", *[F.col(k).cast("long").alias(k) for k in ("emails", "phones", "ips")])


def q_word_tokens(spark, sf):
    words = quality.word_tokens(_t())
    return documents(spark, sf).select("doc_id", F.size(words).cast("long").alias("n"), _joined(words, " ").alias("words"))


def q_quality_metrics(spark, sf):
    m = quality.quality_metrics(documents(spark, sf))
    return m.select("doc_id", "n_words", *[F.round(c, 6).alias(c) for c in ("mean_word_len", "ellipsis_ratio", "alpha_ratio")])


def q_quality_pass(spark, sf):
    return quality.judge_quality(documents(spark, sf)).select("doc_id", "passed", "drop_reason")


def q_quality_by_lang(spark, sf):
    judged = quality.judge_quality(_normal(spark, sf))
    return judged.groupBy("lang", F.coalesce("drop_reason", F.lit("kept")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("docs"))


# --- safety ---------------------------------------------------------------------------------


def q_nb_fit(spark, sf):
    return _model(spark, sf).weights.select("token", "n", F.round("w_nsfw", 6).alias("w_nsfw"), F.round("w_toxic", 6).alias("w_toxic"))


def q_nb_score(spark, sf):
    return safety.nb_score(_normal(spark, sf), _model(spark, sf))


def q_gate_label_only(spark, sf):
    return safety.gate_label_only(q_nb_score(spark, sf)).select("doc_id")


def q_gate_threshold(spark, sf):
    return safety.gate_threshold(q_nb_score(spark, sf)).select("doc_id")


def q_ml_score_domain(spark, sf):
    scored = _ml("toxic")(spark, sf)
    return scored.select("doc_id", F.col("toxic_label").isin("toxic", "non-toxic").alias("known_label"),
                         F.col("toxic_score").between(0.5, 1).alias("in_range"))


def _ml(target):
    def run(spark, sf):
        docs = materialize(_normal(spark, sf).select("doc_id", "text"), "normal")
        model = safety.train_text_classifier(docs, labels(spark, sf), target)
        return safety.classify(docs, model, target).select("doc_id", f"{target}_label", f"{target}_score")
    return run


# --- pipelines --------------------------------------------------------------------------------


def q_collect_samples(spark, sf):
    return collect.collect_samples(_urls(spark, sf), page_table(spark, sf), _model(spark, sf))


def q_collect_first(spark, sf):
    return collect.collect_samples(_urls(spark, sf), page_table(spark, sf), _model(spark, sf), 40)


def q_clean_pages(spark, sf):
    return clean_plan.clean_pages(documents(spark, sf), _model(spark, sf)).select("doc_id", "text")


def q_drop_reasons(spark, sf):
    return clean_plan.judge_pages(documents(spark, sf), _model(spark, sf))


def q_clean_corpus(spark, sf):
    return clean_plan.clean(documents(spark, sf), _model(spark, sf)).select("doc_id", "text")


def q_clean_chunked(spark, sf):
    return clean_plan.clean_chunked(documents(spark, sf), _model(spark, sf), CHUNK).select("doc_id", "text")


def q_top_n(spark, sf):
    return collect.top_n(documents(spark, sf).select("doc_id", "text"), 50, "doc_id")


# --- near duplicates ---------------------------------------------------------------------------


def q_word_ngrams(spark, sf):
    grams = _normal(spark, sf).select("doc_id", neardup.word_ngrams(_t()).alias("g"))
    return grams.select("doc_id", F.size("g").cast("long").alias("n"),
                        F.md5(_joined(F.array_sort("g"), "|").cast("binary")).alias("shingles"))


def q_shingle_hash(spark, sf):
    each = _normal(spark, sf).select("doc_id", F.explode(neardup.word_ngrams(_t())).alias("s"))
    x = neardup.shingle_hash(F.col("s"))
    return each.select("doc_id", x.alias("x")).groupBy("doc_id").agg(
        F.min("x").alias("lowest"), F.max("x").alias("highest"), F.sum("x").alias("total"))


def q_minhash(spark, sf):
    return _normal(spark, sf).select("doc_id", _joined(neardup.minhash(_t())).alias("signature"))


def q_lsh_bands(spark, sf):
    return neardup.lsh_bands(_normal(spark, sf)).select("doc_id", "band", _joined(F.col("band_key")).alias("band_key"))


def q_bucket_sizes(spark, sf):
    return neardup.bucket_sizes(neardup.lsh_bands(_normal(spark, sf))).select(
        "band", _joined(F.col("band_key")).alias("band_key"), "n", "first", "pairs")


def q_candidate_pairs(spark, sf):
    return neardup.bucket_links(neardup.lsh_bands(_normal(spark, sf)))


def q_jaccard_verify(spark, sf):
    docs = materialize(_normal(spark, sf).select("doc_id", "text"), "normal")
    return neardup.all_links(docs).select("i", "j", F.round("similarity", 6).alias("similarity"))


def _near(spark, sf):
    return neardup.NearDuplicates(materialize(_normal(spark, sf).select("doc_id", "text"), "normal"))


def q_duplicate_similarity(spark, sf):
    return _near(spark, sf).similarities().withColumn("similarity", F.round("similarity", 6))


def q_components(spark, sf):
    return _near(spark, sf).clusters()


def q_dedup(spark, sf):
    return _near(spark, sf).kept()


def q_duplicate_report(spark, sf):
    return _near(spark, sf).sizes().select("cluster_id", F.col("size").cast("long").alias("size"))


# --- tokenizer -----------------------------------------------------------------------------------


def q_split_specials(spark, sf):
    marked = documents(spark, sf).withColumn("text", F.replace(_t(), F.lit("\n"), F.lit(fixed.END_OF_TEXT)))
    pieces = bpe.split_specials(_t(), [fixed.END_OF_TEXT])
    return marked.select("doc_id", F.size(pieces).cast("long").alias("n"), _joined(pieces, "|").alias("pieces"))


def q_pretokenize(spark, sf):
    return documents(spark, sf).select("doc_id", _joined(bpe.pretokenize(_t()), "|").alias("words"))


def q_word_counts(spark, sf):
    return bpe.word_counts(documents(spark, sf))


def _symbols(spark, sf):
    return bpe.word_counts(documents(spark, sf)).select("word", bpe.to_symbols(F.col("word")).alias("symbols"), "n")


def q_pair_counts(spark, sf):
    return bpe.pair_counts(_symbols(spark, sf))


def q_best_pair(spark, sf):
    return bpe.best_pairs(bpe.pair_counts(_symbols(spark, sf)))


def q_apply_merge(spark, sf):
    words = materialize(_symbols(spark, sf), "symbols")
    pair = bpe.best_pairs(bpe.pair_counts(words)).first().pair.split()
    return words.select("word", bpe.apply_merge(F.col("symbols"), *[bytes.fromhex(p[1:]) for p in pair]).alias("symbols"), "n")


def _tokenizer(spark, sf, merges=MERGES):
    return bpe.train_bpe(documents(spark, sf), fixed.BYTE_TOKENS + 1 + merges, [fixed.END_OF_TEXT])


def _merges(model):
    return model.merge_table().select("rank", F.lower(F.hex("left")).alias("left_hex"), F.lower(F.hex("right")).alias("right_hex"))


def q_bpe_train(spark, sf):
    return _merges(_tokenizer(spark, sf))


def q_bpe_resume(spark, sf):
    first = _tokenizer(spark, sf, MERGES // 2)
    return _merges(bpe.train_bpe(documents(spark, sf), fixed.BYTE_TOKENS + 1 + MERGES, [fixed.END_OF_TEXT], model=first))


def q_bpe_restart(spark, sf):
    first = _tokenizer(spark, sf, MERGES // 2)
    size = fixed.BYTE_TOKENS + 1 + MERGES
    return _merges(bpe.train_bpe(documents(spark, sf), size, [fixed.END_OF_TEXT], model=first, replay=False))


def q_tokenizer_merges(spark, sf):
    path = scratch_path(spark, "tokenizer")
    tokens.save_tokenizer(_tokenizer(spark, sf), path)
    model = tokens.load_tokenizer(spark, path)
    # Special tokens come after the merges, without a right side.
    rows = [(model.next_rank() + k, t.encode().hex(), str(i)) for k, (t, i) in enumerate(model.specials.items())]
    return _merges(model).unionByName(spark.createDataFrame(rows, "rank int, left_hex string, right_hex string"))


def q_trained_perplexity(spark, sf):
    """From texts to the perplexity over the ids of a tokenizer trained on them."""
    model = _tokenizer(spark, sf)
    coded = bpe.encode(documents(spark, sf), model)
    ex = materialize(dataset.training_examples(dataset.split_sets(coded), LENGTH), "examples")
    counts = bigram.fit_bigram(ex.filter("split = 'train'"), len(model.tokens))
    valid = dataset.make_batches(ex.filter("split = 'valid'"), BATCH)
    p = bigram.perplexity(bigram.batch_loss(bigram.token_nll(valid, counts, keep=("doc_id", "batch"))))
    return p.select(F.round("loss", 6).alias("loss"), F.round("perplexity", 6).alias("perplexity"))


def q_tokenizer_tables(spark, sf):
    path = scratch_path(spark, "tokenizer")
    tokens.save_tokenizer(_tokenizer(spark, sf), path)
    return tokens.load_tokenizer(spark, path).vocab().select("id", F.hex("token").alias("hex"))


def q_bpe_encode(spark, sf):
    coded = bpe.encode(documents(spark, sf), _tokenizer(spark, sf))
    return coded.select("doc_id", F.size("input_ids").cast("long").alias("n"), _joined(F.col("input_ids")).alias("ids"))


def q_bpe_decode(spark, sf):
    model = _tokenizer(spark, sf)
    return bpe.encode(documents(spark, sf), model).select("doc_id", bpe.decode(F.col("input_ids"), model).alias("text"))


def q_token_stats(spark, sf):
    model = _tokenizer(spark, sf)
    return bpe.token_stats(materialize(bpe.encode(documents(spark, sf), model), "coded"), model)


# --- training sets ----------------------------------------------------------------------------------


def _examples(spark, sf):
    return dataset.training_examples(dataset.split_sets(_byte_tokens(spark, sf)), LENGTH)


def q_split(spark, sf):
    return dataset.split_sets(documents(spark, sf).select("doc_id"))


def q_pad_truncate(spark, sf):
    return _byte_tokens(spark, sf).select("doc_id", _digest(dataset.pad_or_truncate(F.col("input_ids"), LENGTH)).alias("ids"))


def q_shift_xy(spark, sf):
    return dataset.training_examples(_byte_tokens(spark, sf), LENGTH).select(
        "doc_id", _digest(F.col("x")).alias("x"), _digest(F.col("y")).alias("y"))


def q_loss_mask(spark, sf):
    m = F.transform(dataset.loss_mask(F.col("y")), lambda b: b.cast("int").cast("string"))
    return dataset.training_examples(_byte_tokens(spark, sf), LENGTH).select("doc_id", _joined(m, "").alias("mask"))


def q_batches_shuffled(spark, sf):
    return dataset.make_batches(documents(spark, sf).select("doc_id"), BATCH, seed=1)


def q_batches_ordered(spark, sf):
    return dataset.make_batches(documents(spark, sf).select("doc_id"), BATCH)


def q_dataset_summary(spark, sf):
    return dataset.dataset_summary(q_split(spark, sf))


# --- evaluation ---------------------------------------------------------------------------------------


def _fitted(spark, sf):
    ex = materialize(_examples(spark, sf), "examples")
    return ex, bigram.fit_bigram(ex.filter("split = 'train'"), fixed.BYTE_TOKENS)


def q_bigram_fit(spark, sf):
    return _fitted(spark, sf)[1].pairs.withColumn("p", F.round("p", 6))


def q_token_nll(spark, sf):
    return bigram.token_nll(*_fitted(spark, sf)).withColumn("nll", F.round("nll", 6))


def _losses(spark, sf):
    ex, model = _fitted(spark, sf)
    valid = dataset.make_batches(ex.filter("split = 'valid'"), BATCH)
    return bigram.batch_loss(bigram.token_nll(valid, model, keep=("doc_id", "batch")))


def q_batch_loss(spark, sf):
    return _losses(spark, sf).withColumn("loss", F.round("loss", 6))


def q_mean_loss(spark, sf):
    return bigram.mean_loss(_losses(spark, sf)).select(F.round("loss", 6).alias("loss"))


def q_perplexity(spark, sf):
    p = bigram.perplexity(_losses(spark, sf))
    return p.select(F.round("loss", 6).alias("loss"), F.round("perplexity", 6).alias("perplexity"))


def q_running_loss(spark, sf):
    r = bigram.running_loss(materialize(_losses(spark, sf), "losses"))
    return r.select("batch", F.round("loss", 6).alias("loss"), F.round("running", 6).alias("running"))


def q_next_token_topk(spark, sf):
    return bigram.next_token_topk(_fitted(spark, sf)[1], 5, 0.7).withColumn("p", F.round("p", 6))


# --- conversations ---------------------------------------------------------------------------------------


def q_filter_turns(spark, sf):
    return chat.filter_turns(conversations(spark, sf)).select("conv_id", "turn", "role", "text")


def q_render_conversation(spark, sf):
    return chat.render_conversation(chat.filter_turns(conversations(spark, sf)))


def q_context_budget(spark, sf):
    counted = q_render_conversation(spark, sf).withColumn("tokens", F.size(bpe.pretokenize(F.col("piece"))))
    return chat.context_budget(counted, BUDGET)


def q_context_budget_ids(spark, sf):
    """The budget in ids of a vocabulary trained on the rendered turns."""
    pieces = materialize(q_render_conversation(spark, sf), "pieces")
    model = bpe.train_bpe(pieces, fixed.BYTE_TOKENS + 1 + MERGES, [fixed.END_OF_TEXT], text="piece")
    return chat.context_budget(pieces.withColumn("tokens", bpe.count_ids(F.col("piece"), model)), BUDGET)


def q_clip_context(spark, sf):
    return _byte_tokens(spark, sf).select("doc_id", _digest(bigram.clip_context(F.col("input_ids"), LENGTH)).alias("ids"))


# --- streams -----------------------------------------------------------------------------------------------


def _three_batches(spark, sf, job, falling=False):
    """Run a job on a stream of the documents, which arrive in three parts of uneven size, in the order of their ids or against it.

    The job runs once for each part, which is a batch of as many files as its rows were read in.
    """
    path = scratch_path(spark, "stream-in")
    docs = documents(spark, sf).select("doc_id", "text")
    most = docs.agg(F.max("doc_id")).first()[0] or 0
    part = F.when(F.col("doc_id") < most / 50, 0).when(F.col("doc_id") < most / 2, 1).otherwise(2)
    for n in (2, 1, 0) if falling else range(3):
        docs.filter(part == n).write.mode("append").parquet(path)
        job(jobs.stream_files(spark, path)).awaitTermination()


def q_stream_clean(spark, sf):
    out, state, model = scratch_path(spark, "stream-clean"), scratch_path(spark, "state"), _model(spark, sf)
    _three_batches(spark, sf, lambda stream: jobs.stream_clean(stream, model, out, state))
    return spark.read.parquet(out).select("doc_id", "text")


def q_stream_clean_all(spark, sf):
    """Near duplicates over all batches; the batches come in falling order of their ids."""
    out, history = scratch_path(spark, "stream-clean"), scratch_path(spark, "history")
    state, model = scratch_path(spark, "state"), _model(spark, sf)
    _three_batches(spark, sf, lambda stream: jobs.stream_clean(stream, model, out, state, history), falling=True)
    return jobs.read_clean(spark, out, history)


def q_stream_word_counts(spark, sf):
    out, state = scratch_path(spark, "stream-words"), scratch_path(spark, "state")
    _three_batches(spark, sf, lambda stream: jobs.stream_word_counts(stream, out, state))
    return jobs.read_word_counts(spark, out)


def q_stream_collect(spark, sf):
    out, state = scratch_path(spark, "stream-samples"), scratch_path(spark, "state")
    good = lambda d: pii.mask_text(quality.keep_quality(d))
    _three_batches(spark, sf, lambda stream: jobs.stream_collect(stream, good, 100, out, state))
    return spark.read.parquet(out).select("doc_id", "text")


def entry(spark: SparkSession) -> DataFrame:
    """The whole cleaning pipeline on the smallest tables."""
    return q_clean_corpus(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    out |= {f"mask_{kind}": _mask(kind) for kind in ("email", "phone", "ip")}
    out |= {
        "normalize_text": _each(T.normalize_text),
        "fold_marks": _each(T.fold_marks),
        "pii_report": lambda spark, sf: pii.pii_report(documents(spark, sf), "lang"),
        "ml_nsfw_score": _ml("nsfw"),
        "ml_toxic_score": _ml("toxic"),
    }
    if llm:
        out |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    q = O.query
    lines_of = "SELECT unnest(string_split(text, chr(10))) AS text FROM {}"
    joined = "array_to_string({}, ',')".format
    labelled = ("SELECT doc_id, CASE quality WHEN 1 THEN 'high' ELSE 'low' END AS label, "
                f"{O.strip(O.one_line('text') + '')} AS text, {O.one_line('text')} AS raw FROM documents JOIN labels USING (doc_id)")
    split_of = "SELECT doc_id, split FROM sets"
    batch = "CAST((row_number() OVER (ORDER BY {}) - 1) // " + str(BATCH) + " AS BIGINT) AS batch"
    words_sql = (f"SELECT doc_id, CAST(len(w) AS BIGINT) AS n, array_to_string(w, ' ') AS words "
                 f"FROM (SELECT doc_id, regexp_extract_all(text, '{O.TOKEN}') AS w FROM documents)")
    trained = O.training(MERGES)
    vocab = O.vocabulary(fixed.END_OF_TEXT)
    coded = [*trained, vocab, O.encoded()]
    out = {
        "read_urls": "SELECT page_id AS url_rank, url FROM pages WHERE trim(url) <> ''",
        "read_url_files": "SELECT row_number() OVER (ORDER BY page_id) - 1 AS url_rank, url FROM pages WHERE trim(url) <> ''",
        "process_corpus": q(O.CLEAN_PAGE, O.clusters("cleaned"), "SELECT text FROM cleaned JOIN clustered USING (doc_id) WHERE doc_id = cluster_id"),
        "fetch_captures": "SELECT page_id AS url_rank, url, md5(html) AS page FROM pages",
        "decode_charsets": f"SELECT page_id, {O.html_text('html')} AS text FROM pages",
        "duplicate_similarity": q(O.NORMAL, O.clusters("normal"), f"s AS (SELECT c.doc_id, c.cluster_id, {O.JACCARD} AS similarity FROM clustered c "
                                  "JOIN grams a ON a.doc_id = c.cluster_id JOIN grams b ON b.doc_id = c.doc_id WHERE c.doc_id <> c.cluster_id)",
                                  "SELECT doc_id, cluster_id, round(similarity, 6) AS similarity FROM s"),
        "decode_undeclared": f"SELECT page_id, {O.html_text('html')} AS text FROM pages",
        "ml_score_domain": "SELECT doc_id, true AS known_label, true AS in_range FROM documents",
        "fetch_pages": "SELECT page_id AS url_rank, url, md5(html) AS page FROM pages",
        "read_labelled_lines": q(f"l AS ({labelled})", f"SELECT label, regexp_replace(raw, '[{O.S}]+$', '') AS text FROM l"),
        "strip_label": q(f"l AS ({labelled})", f"SELECT doc_id, regexp_replace(raw, '[{O.S}]+$', '') AS text FROM l"),
        "write_lines": f"SELECT {O.one_line('text')} AS text FROM documents",
        "write_labelled_lines": f"SELECT '__label__high ' || {O.one_line('text')} AS text FROM documents",
        "read_text_dataset": lines_of.format("documents"),
        "export_split": lines_of.format("conversations"),
        "token_dataset": q(O.BYTES, O.SPLIT, f"SELECT md5({joined('ids')}) AS ids FROM byte_tokens JOIN sets USING (doc_id) WHERE split = 'valid'"),
        "extract_text": f"SELECT page_id, {O.html_text('html')} AS text FROM pages",
        "decode_html": "SELECT page_id, html FROM pages",
        "flatten_min_length": q(f"f AS (SELECT doc_id, {O.flat('text')} AS text FROM documents)", "SELECT * FROM f WHERE length(text) >= 100"),
        "normalize_text": q(O.NORMAL, "SELECT doc_id, text FROM normal"),
        "fold_marks": "SELECT doc_id, strip_accents(text) AS text FROM documents",
        **{f"mask_{kind}": O.mask_one(kind) for kind in O.MASKS},
        "mask_pii": q(O.MASKED, "SELECT doc_id, text, emails, phones, ips FROM counted"),
        "pii_report": q(O.MASKED, "SELECT lang, count(*) AS docs, count(*) FILTER (emails + phones + ips > 0) AS docs_with_pii, "
                        + ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}" for k in ("emails", "phones", "ips")) + " FROM counted GROUP BY lang"),
        "word_tokens": words_sql,
        "quality_metrics": q(O.quality("documents"), "SELECT doc_id, n_words, round(mean_word_len, 6) AS mean_word_len, "
                             "round(ellipsis_ratio, 6) AS ellipsis_ratio, round(alpha_ratio, 6) AS alpha_ratio FROM metrics"),
        "quality_pass": q(O.quality("documents"), "SELECT doc_id, drop_reason IS NULL AS passed, drop_reason FROM judged"),
        "quality_by_lang": q(O.NORMAL, O.quality("normal"), "SELECT lang, coalesce(drop_reason, 'kept') AS outcome, count(*) AS docs "
                             "FROM judged JOIN documents USING (doc_id) GROUP BY ALL"),
        "nb_fit": q(O.NB, "SELECT token, n, round(w_nsfw, 6) AS w_nsfw, round(w_toxic, 6) AS w_toxic FROM weights"),
        "nb_score": q(O.NB, O.nb_scores("normal"), "SELECT * FROM scored"),
        "gate_label_only": q(O.NB, O.nb_scores("normal"), f"SELECT doc_id FROM scored WHERE {O.LABEL_GATE}"),
        "gate_threshold": q(O.NB, O.nb_scores("normal"), f"SELECT doc_id FROM scored WHERE {O.SCORE_GATE}"),
        "collect_samples": q(O.COLLECT, "SELECT * FROM samples"),
        "collect_first": q(O.COLLECT, "SELECT * FROM samples ORDER BY url_rank LIMIT 40"),
        "clean_pages": q(O.CLEAN_PAGE, "SELECT doc_id, text FROM cleaned"),
        "drop_reasons": q(O.CLEAN_PAGE, "SELECT doc_id, CASE WHEN nsfw_label <> 'non-nsfw' OR nsfw_score <= 0.75 THEN 'nsfw' "
                          "WHEN toxic_label <> 'non-toxic' OR toxic_score < 0.75 THEN 'toxic' ELSE drop_reason END AS drop_reason "
                          "FROM judged JOIN scored USING (doc_id)"),
        "clean_corpus": q(O.CLEAN_PAGE, O.clusters("cleaned"), "SELECT doc_id, text FROM cleaned JOIN clustered USING (doc_id) WHERE doc_id = cluster_id"),
        "clean_chunked": q(O.CLEAN_PAGE, O.clusters("cleaned", f"doc_id // {CHUNK}"),
                           "SELECT doc_id, text FROM cleaned JOIN clustered USING (doc_id) WHERE doc_id = cluster_id"),
        "top_n": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 50",
        "word_ngrams": q(O.NORMAL, O.shingles("normal"), "SELECT doc_id, CAST(len(g) AS BIGINT) AS n, md5(array_to_string(list_sort(g), '|')) AS shingles FROM grams"),
        "shingle_hash": q(O.NORMAL, O.shingles("normal"), "SELECT doc_id, min(x) AS lowest, max(x) AS highest, CAST(sum(x) AS BIGINT) AS total FROM shingle GROUP BY doc_id"),
        "minhash": q(O.NORMAL, O.signatures("normal"), f"SELECT doc_id, {joined('sig')} AS signature FROM signed"),
        "lsh_bands": q(O.NORMAL, O.signatures("normal"), "SELECT doc_id, band, band_key FROM bands"),
        "bucket_sizes": q(O.NORMAL, O.signatures("normal"), "SELECT band, band_key, count(*) AS n, min(doc_id) AS first, "
                          "count(*) * (count(*) - 1) // 2 AS pairs FROM bands GROUP BY band, band_key HAVING count(*) > 1"),
        "candidate_pairs": q(O.NORMAL, O.signatures("normal"), "f AS (SELECT doc_id AS j, min(doc_id) OVER (PARTITION BY band, band_key) AS i FROM bands)",
                             "SELECT DISTINCT i, j FROM f WHERE i < j"),
        "jaccard_verify": q(O.NORMAL, O.signatures("normal"), "class AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first FROM normal)",
                            "b AS (SELECT bands.* FROM bands JOIN class USING (doc_id) WHERE doc_id = first)",
                            "c AS (SELECT DISTINCT x.doc_id AS i, y.doc_id AS j FROM b AS x JOIN b AS y USING (band, band_key) WHERE x.doc_id < y.doc_id)",
                            f"s AS (SELECT i, j, {O.JACCARD} AS similarity FROM c JOIN grams a ON a.doc_id = i JOIN grams b ON b.doc_id = j)",
                            f"SELECT i, j, round(similarity, 6) AS similarity FROM s WHERE similarity >= {fixed.JACCARD} "
                            "UNION ALL SELECT first, doc_id, 1.0::DOUBLE FROM class WHERE first < doc_id"),
        "components": q(O.NORMAL, O.clusters("normal"), "SELECT doc_id, cluster_id FROM clustered"),
        "dedup": q(O.NORMAL, O.clusters("normal"), "SELECT doc_id, text FROM normal JOIN clustered USING (doc_id) WHERE doc_id = cluster_id"),
        "duplicate_report": q(O.NORMAL, O.clusters("normal"), "SELECT cluster_id, count(*) AS size FROM clustered GROUP BY cluster_id HAVING count(*) > 1"),
        "split_specials": "SELECT doc_id, CAST(len(p) AS BIGINT) AS n, array_to_string(p, '|') AS pieces FROM (SELECT doc_id, "
                          "list_filter(string_split(text, chr(10)), lambda x: x <> '') AS p FROM documents)",
        "pretokenize": q(O.WORDS, "SELECT doc_id, array_to_string(words, '|') AS words FROM tok"),
        "word_counts": q(O.WORDS, "SELECT word, n FROM word_counts"),
        "pair_counts": q(O.WORDS, O.W0, O.pairs("w0", "p0"), "SELECT pair, n FROM p0"),
        "best_pair": q(O.WORDS, O.W0, O.pairs("w0", "p0"), O.best("p0", "b0"), "SELECT pair, n FROM b0"),
        "apply_merge": q(*O.training(1), "SELECT word, s AS symbols, n FROM trained"),
        "bpe_train": q(*trained, O.merge_rows()),
        "bpe_restart": q(*O.training(MERGES // 2), O.merge_rows(MERGES // 2)),
        "tokenizer_merges": q(*trained, f"{O.merge_rows()} UNION ALL SELECT {MERGES}, '{fixed.END_OF_TEXT.encode().hex()}', '{fixed.BYTE_TOKENS}'"),
        "trained_perplexity": q(*coded, O.losses(LENGTH, BATCH, fixed.BYTE_TOKENS + 1 + MERGES, "byte_tokens AS (SELECT doc_id, ids FROM coded)"),
                                "SELECT round(avg(loss), 6) AS loss, round(exp(avg(loss)), 6) AS perplexity FROM loss"),
        "bpe_resume": q(*trained, O.merge_rows()),
        "tokenizer_tables": q(*trained, vocab, "SELECT id, hex FROM vocab"),
        "bpe_encode": q(*coded, f"SELECT doc_id, CAST(len(ids) AS BIGINT) AS n, {joined('ids')} AS ids FROM coded"),
        "bpe_decode": "SELECT doc_id, text FROM documents",
        "token_stats": q(*coded, "u AS (SELECT count(DISTINCT id) AS used FROM (SELECT unnest(ids) AS id FROM coded))",
                         "b AS (SELECT CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM documents)",
                         "t AS (SELECT count(*) AS docs, CAST(sum(len(ids)) AS BIGINT) AS tokens FROM coded)",
                         "SELECT docs, tokens, bytes, round(bytes / tokens, 6) AS bytes_per_token, used AS used_ids, "
                         f"round(used / {fixed.BYTE_TOKENS + 1 + MERGES}, 6) AS vocab_share FROM t, b, u"),
        "split": q(O.SPLIT, split_of),
        "pad_truncate": q(O.windows(LENGTH), f"SELECT doc_id, md5({joined('ids')}) AS ids FROM win"),
        "shift_xy": q(O.windows(LENGTH), f"SELECT doc_id, md5({joined('x')}) AS x, md5({joined('y')}) AS y FROM xy"),
        "loss_mask": q(O.windows(LENGTH), "SELECT doc_id, array_to_string(list_transform(y, lambda t: CAST(CAST(t <> 0 AS INTEGER) AS VARCHAR)), '') AS mask FROM xy"),
        "batches_shuffled": f"SELECT doc_id, {batch.format(O.HASHED.format(seed=1) + ', doc_id')} FROM documents",
        "batches_ordered": f"SELECT doc_id, {batch.format('doc_id')} FROM documents",
        "dataset_summary": q(O.SPLIT, "SELECT split, count(*) AS examples FROM sets GROUP BY split"),
        "bigram_fit": q(O.bigrams(LENGTH), "SELECT prev, next, n, round(p, 6) AS p FROM model"),
        "token_nll": q(O.bigrams(LENGTH), "SELECT doc_id, round(nll, 6) AS nll, targets FROM nll"),
        "batch_loss": q(O.losses(LENGTH, BATCH), "SELECT batch, round(loss, 6) AS loss FROM loss"),
        "mean_loss": q(O.losses(LENGTH, BATCH), "SELECT round(coalesce(avg(loss), 0), 6) AS loss FROM loss"),
        "perplexity": q(O.losses(LENGTH, BATCH), "SELECT round(avg(loss), 6) AS loss, round(exp(avg(loss)), 6) AS perplexity FROM loss"),
        "running_loss": q(O.losses(LENGTH, BATCH), "SELECT batch, round(loss, 6) AS loss, round(avg(loss) OVER (ORDER BY batch), 6) AS running FROM loss"),
        "next_token_topk": q(O.bigrams(LENGTH), "r AS (SELECT prev, next, ln(p) / 0.7 AS s, rank() OVER (PARTITION BY prev ORDER BY ln(p) / 0.7 DESC) AS k FROM model)",
                             "e AS (SELECT prev, next, exp(s - max(s) OVER (PARTITION BY prev)) AS e FROM r WHERE k <= 5)",
                             "SELECT prev, next, round(e / sum(e) OVER (PARTITION BY prev), 6) AS p FROM e"),
        "filter_turns": q(O.TURNS, "SELECT conv_id, turn, role, text FROM kept"),
        "render_conversation": q(O.TURNS, "SELECT conv_id, turn, role, piece FROM piece"),
        "context_budget": q(O.budget(BUDGET), "SELECT conv_id, turn, held, cleared FROM held"),
        "context_budget_ids": q(O.budget(BUDGET, O.counted_ids(MERGES)), "SELECT conv_id, turn, held, cleared FROM held"),
        "clip_context": q(O.BYTES, f"SELECT doc_id, md5({joined(f'ids[greatest(len(ids) - {LENGTH}, 0) + 1:len(ids)]')}) AS ids FROM byte_tokens"),
        "stream_clean": q(O.CLEAN_PAGE, O.clusters("cleaned", "CASE WHEN doc_id < (SELECT max(doc_id) FROM documents) / 50 THEN 0 "
                                                   "WHEN doc_id < (SELECT max(doc_id) FROM documents) / 2 THEN 1 ELSE 2 END"), "SELECT doc_id, text FROM cleaned JOIN clustered USING (doc_id) WHERE doc_id = cluster_id"),
        "stream_clean_all": q(O.CLEAN_PAGE, O.clusters("cleaned"), "SELECT doc_id, text FROM cleaned JOIN clustered USING (doc_id) WHERE doc_id = cluster_id"),
        "stream_word_counts": q(O.WORDS, "SELECT word, n FROM word_counts"),
        "stream_collect": q(O.quality("documents"), f"SELECT doc_id, {O.mask_all('text')} AS text FROM judged WHERE drop_reason IS NULL ORDER BY doc_id LIMIT 100"),
    }
    return out | (llm.oracle_sql() if llm else {})
