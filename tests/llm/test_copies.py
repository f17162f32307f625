"""Operators 4 and 7 and the pipeline against brute force."""
import hashlib
import random
import zlib

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import packing, pu_toxicity, queries, secret_index, simhash_grid, suffix_blocks

# --- SimHash --------------------------------------------------------------------------


def plain_fingerprint(text, k=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, linked):
    parent = {i: i for i in values}

    def root(i):
        while parent[i] != i:
            i = parent[i] = parent[parent[i]]
        return i

    ids = sorted(values)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if linked(values[i], values[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}


def near(a, b):
    return (a ^ b).bit_count() <= 2


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", ["", None, " \n", "one", "One TWO", "a b c d", "É é\x0bz \x1c x\xa0y", "the " * 500, "w " * 70_000])
def test_fingerprints(text):
    assert simhash_grid.fingerprint(text) == plain_fingerprint(text)


def test_nibble_counts(spark):
    rng = random.Random(4)
    fps = [0, (1 << 64) - 1, 1 << 63, *(rng.getrandbits(64) for _ in range(50))]
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for (fp, counts), x in zip(df.select("fp", simhash_grid.nibble_counts(F.col("fp"))).collect(), fps):
        assert fp == signed(x) and [counts >> 4 * i & 15 for i in range(16)] == [(x >> 4 * i & 15).bit_count() for i in range(16)]


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_connect_all_near_fingerprints(spark, bits):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1, 1, 3, 7, 1 << 63}
    for base in list(fps)[:8]:
        for _ in range(25):
            x = base
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
            fps.add(x)
    values = {i: x for i, x in enumerate(sorted(fps))}
    want = components(values, lambda a, b: (a ^ b).bit_count() <= bits)
    number = {signed(x): i for i, x in values.items()}
    found = simhash_grid.links(spark.createDataFrame([(x,) for x in number], "fp long"), bits).collect()
    edges = {frozenset((number[r.a], number[r.b])) for r in found}
    assert all((values[i] ^ values[j]).bit_count() <= bits for i, j in map(tuple, edges))
    assert components({i: i for i in values}, lambda i, j: frozenset((i, j)) in edges) == want
    # Crowded cells are linked through one member; pairs are not listed.
    assert len(found) <= 65 * len(fps)


def test_classes_of_documents(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choices(words, k=300) for _ in range(4)]
    texts = [None, "", " "]
    for b in base:
        for _ in range(12):
            copy = list(b)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(300)] = "changed"
            texts.append(" ".join(copy))
    rows = [(i * 7 % 101, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[:5] + [(None, "no id", "x")], "doc_id long, text string, fp string")
    want = components({i: plain_fingerprint(t) for i, t, _ in rows}, near)
    got = simhash_grid.classes(docs).collect()
    assert len(got) == len(rows) + 5
    assert all(r.component_id == want[r.doc_id] for r in got) and len(set(want.values())) < len(want)
    kept = simhash_grid.representatives(docs)
    assert {r.doc_id for r in kept.collect()} == set(want.values()) | {None} and kept.columns == docs.columns
    assert simhash_grid.classes(docs.limit(0)).count() == 0


def test_registered_classes(spark, data):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    fps = {i: plain_fingerprint(t) for i, t in docs.items()}
    want = components(fps, near)
    rows = queries.op4_simhash(spark, data).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{fps[i]:016x}", want[i]) for i in docs}


# --- repeated strings -----------------------------------------------------------------


def plain_covered(docs):
    seen, hit = set(), {i: set() for i in docs}
    for i in sorted(docs):
        raw = (docs[i] or "").encode()
        for p in range(len(raw) - 99):
            if raw[p:p + 100] in seen:
                hit[i].update(range(p, p + 100))
            seen.add(raw[p:p + 100])
    return hit


def passages(rng):
    def gen(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    pool = [gen(rng.choice(["ab", "a", "abcdefghij é", "the of and "]), rng.randint(20, 300)) for _ in range(5)]

    def piece():
        return rng.choice([rng.choice(pool), gen("abcdefghij ", rng.randint(0, 150)), rng.choice(pool)[rng.randint(0, 50):]])

    return {3 * i: "".join(piece() for _ in range(rng.randint(0, 5))) for i in range(rng.randint(2, 12))}


def check_digests(docs, rows):
    want = plain_covered(docs)
    assert {r.doc_id for r in rows} == docs.keys()
    for r in rows:
        raw, hit = (docs[r.doc_id] or "").encode(), want[r.doc_id]
        kept = bytes(c for p, c in enumerate(raw) if p not in hit)
        runs = sum(p - 1 not in hit for p in hit)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(raw), len(hit), runs, hashlib.sha256(kept).hexdigest())


def test_suffix_order():
    import numpy as np

    rng = random.Random(7)
    for alphabet in (b"a", b"ab", bytes(range(97, 110))):
        body = bytes(rng.choice(alphabet) for _ in range(700)) * 2
        text = np.frombuffer(body + bytes(suffix_blocks.PERIOD * 16), np.uint8)
        at = suffix_blocks.sort_block(text, np.array(rng.sample(range(len(body)), 900)))
        keys = [text[p:p + 100].tobytes() for p in at]
        assert keys == sorted(keys) and len(set(at)) == 900


def test_cover_reaches_all_differences():
    d = suffix_blocks.cover_shifts()
    cover = set(suffix_blocks.COVER)
    assert all({(a + d[a, b]) % 13, (b + d[a, b]) % 13} <= cover for a in range(13) for b in range(13))
    with pytest.raises(AssertionError):
        suffix_blocks.cover_shifts(13, (0, 1, 3))


@pytest.mark.parametrize("seed", range(60))
def test_blocks_equal_brute_force(monkeypatch, seed):
    """The functions of the tasks without Spark, in all combinations of small limits."""
    import pyarrow as pa

    rng = random.Random(seed)
    for name, choices in (("CROWDED", [0, 1, 2, 5, 2000]), ("BLOCK_BYTES", [100, 1000, 10**6]), ("TASK_CONTEXTS", [1, 30, 10**6]), ("CONTEXT", [1, 7, 512])):
        monkeypatch.setattr(suffix_blocks, name, rng.choice(choices))
    docs, want = passages(rng), {}
    spans = {i: set() for i in docs}

    def batches(parts, keys, rows):
        parts = list(parts)
        return pa.Table.from_batches(parts).sort_by([(k, "ascending") for k in keys]).to_batches(max_chunksize=rows) if parts else []

    def table(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "text", "wanted"][:len(columns)])

    found = suffix_blocks._text_contexts([table(list(docs), list(docs.values()))])
    for b in suffix_blocks._crowds(batches(found, suffix_blocks._NAMES[1:5], rng.choice([7, 100, 10**6]))):
        for r in b.to_pylist():
            if r["kind"] == suffix_blocks.COVERED:
                spans[r["doc_id"]].update(range(r["start"], r["start"] + r["n"] + 99))
            else:
                want.setdefault(r["doc_id"], []).append({k: r[k] for k in ("kind", "bucket", "start", "n")})
    if want:
        cut = suffix_blocks._cut_out([table(list(want), [docs[i] for i in want], list(want.values()))])
        for b in suffix_blocks._sorted_blocks(batches(cut, ("bucket", "doc_id", "start"), 50)):
            for r in b.to_pylist():
                spans[r["doc_id"]].update(range(r["start"], r["stop"]))
    assert spans == plain_covered(docs)


def test_merged_spans():
    rnd = random.Random(4)
    rows = [(i, [(a, a + rnd.randint(1, 9)) for a in (rnd.randint(0, 120) for _ in range(rnd.choice([0, 1, 3, 30])))]) for i in range(40)]
    rows.append((99, [(2**31 - 200, 2**31 - 1), (0, 5)]))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    lists = pa.array([[{"start": a, "stop": b} for a, b in spans] for _, spans in rows], kind)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), lists], ["doc_id", "spans"])
    for part in (batch, batch.slice(3, 20), batch.slice(0, 0)):
        got = [row for out in suffix_blocks._merged([part]) for row in out.to_pylist()]
        assert [r["doc_id"] for r in got] == part.column(0).to_pylist()
        for r, spans in zip(got, part.column(1).to_pylist()):
            expected = []
            for s in sorted((x["start"], x["stop"]) for x in spans):
                if expected and s[0] <= expected[-1][1]:
                    expected[-1][1] = max(expected[-1][1], s[1])
                else:
                    expected.append(list(s))
            assert [[x["start"], x["stop"]] for x in r["spans"]] == expected


def test_repeats_in_spark(spark):
    docs = {**passages(random.Random(99)), 1000: None, 1001: "", 1002: "a" * 5000, 1003: "a" * 99, 1004: "é" * 60, 1005: "x" + "é" * 60}
    rows = [(i, t, 1) for i, t in docs.items()]
    table = spark.createDataFrame(rows, "doc_id long, text string, spans int").repartition(3)
    check_digests(docs, suffix_blocks.digests(table).collect())
    out = {r.doc_id: r.text for r in suffix_blocks.remove(table.select("doc_id", "text", F.lit("e").alias("extra"))).collect()}
    hit = plain_covered(docs)
    assert out == {i: t if t is None else bytes(c for p, c in enumerate(t.encode()) if p not in hit[i]).decode(errors="ignore") for i, t in docs.items()}
    assert suffix_blocks.digests(table.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "abc" * 50)] * 2 + [(None, "abc" * 50)] * 2, "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in suffix_blocks.digests(twice).collect()) == [(0, 0), (0, 0), (1, 147), (1, 147)]


@pytest.mark.parametrize("crowded", [0, 2000])
def test_repeated_rows_of_one_task_do_not_cover_each_other(monkeypatch, crowded):
    import pyarrow as pa

    monkeypatch.setattr(suffix_blocks, "CROWDED", crowded)
    rng = random.Random(8)
    own = "".join(rng.choice("abcdefghij ") for _ in range(400))
    ids, texts = [5, 5, 5, 9, 9], [own] * 3 + [own[100:350] + "x" * 150] * 2
    found = suffix_blocks._settled([(*(c := suffix_blocks.contexts(t.encode())), [i] * len(c[0])) for i, t in zip(ids, texts)]).to_pylist()
    assert len({(r["doc_id"], r["start"]) for r in found}) == len(found)
    assert not [r for r in found if r["doc_id"] == 5 and r["kind"] == suffix_blocks.COVERED]
    wanted = [[{"kind": suffix_blocks.SPLIT, "bucket": 0, "start": 0, "n": 301}]] * 5
    cut = suffix_blocks._segments(pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts), pa.array(wanted)], ["doc_id", "text", "wanted"])).to_pylist()
    assert len(cut) == len({(r["doc_id"], r["start"]) for r in cut}) == 602
    hit = plain_covered({5: own, 9: texts[3]})
    assert {(r["doc_id"], r["start"]) for r in cut if r["kind"] == suffix_blocks.COVERED} == {(9, p) for p in range(301) if set(range(p, p + 100)) <= hit[9]}


def test_repeated_rows_of_one_partition(spark):
    rng = random.Random(10)
    docs = {i: "".join(rng.choice("abcdefghij ") for _ in range(300)) for i in range(3)}
    docs[3] = docs[1] + docs[0][:150]
    table = spark.createDataFrame([(i, t) for i, t in docs.items()] * 2, "doc_id long, text string").coalesce(1)
    rows = suffix_blocks.digests(table).collect()
    assert len(rows) == 8
    check_digests(docs, rows)


def test_periods_within_a_document(spark):
    rng = random.Random(12)

    def gen(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))

    kinds = [(p, 2 + p % 7) for p in range(1, 201)] + [(p, n) for p in (76, 77, 78) for n in range(2, 9)]
    docs = {i: gen(130) + gen(p) * n + gen(130) for i, (p, n) in enumerate(kinds)}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    check_digests(docs, suffix_blocks.digests(table).collect())


def test_registered_repeats(spark, data):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    check_digests(docs, queries.op7_suffix_dedup(spark, data).collect())


# --- pipeline -------------------------------------------------------------------------


def test_stages_equal_their_restatements(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    out = corpus_pipeline.run(spark, data).collect()
    # Scores come from the operator; its held-out accuracy is tested by itself.
    taught = labels.filter(F.col("doc_id").isin([r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]))
    scores = {r.doc_id: r.score for r in pu_toxicity.score(docs, pu_toxicity.fit(docs, taught)).collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if scores[r.doc_id] < 0.3}
    classes = components({i: plain_fingerprint(t) for i, t in texts.items()}, near)
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    hit = plain_covered(texts)
    texts = {i: bytes(c for p, c in enumerate(t.encode()) if p not in hit[i]).decode(errors="ignore") for i, t in texts.items()}
    texts = {r.doc_id: r.text for r in secret_index.redact(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    want = {r.doc_id: r.doc_tokens for r in packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"),
                                                         queries.public_tokenizers.path("byte_bpe_50k.json")).collect()}
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want and 0 < len(got) < docs.count()


def test_stages_keep_the_columns_and_bear_odd_rows(spark, data, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, spans int"
    rows = [(1, None, None, None, None, "x", 1), (2, "", "en", "s", 0, "x", 1), (None, "no id", "en", "s", 5, "x", 1), (3, "w " * 30_000, "en", "s", 60_000, "x", 1)]
    for table in (spark.createDataFrame(rows + rows[:1], schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, data).columns == list(corpus_pipeline.COLUMNS)
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, table, data).collect()
