import random
import tracemalloc
from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom import fixed
from textloom.operators import neardup as N
from textloom.operators.components import connected_components
from textloom.operators.lookup import join_by_count, lookup


def grams(text, n=4):
    w = text.split()
    return {" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_signature(text, k=128):
    a, b = N.hash_family(k)
    xs = [int(md5(g.encode()).hexdigest()[:8], 16) for g in grams(text)]
    return [min(((a[i] * x + b[i]) % fixed.HASH_PRIME for x in xs), default=N.EMPTY_HASH) for i in range(k)]


def brute_clusters(texts, scope=None):
    """All pairs of all buckets, one after the other."""
    sigs = [brute_signature(t) for t in texts]
    sets = [grams(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if scope and scope[i] != scope[j]:
                continue
            if any(sigs[i][b * 8:b * 8 + 8] == sigs[j][b * 8:b * 8 + 8] for b in range(16)):
                u = len(sets[i] | sets[j])
                if u == 0 or len(sets[i] & sets[j]) / u >= 0.8:
                    old, new = max(label[i], label[j]), min(label[i], label[j])
                    label = [new if x == old else x for x in label]
    return label


def test_hash_family():
    a, b = N.hash_family()
    assert a[:2] == [2746317214, 1181241944] and a[127] == 311570308
    assert b[:2] == [4278201677, 1139027119] and b[127] == 1503068227


def test_shingles_and_signature(column_of):
    texts = ["a b c d", "a b c", "", " \n", "x  y\tz a b c d x y z a", "é ü ñ ö ä"]
    got = column_of(texts, N.word_ngrams(F.col("text")))
    assert [set(g) for g in got] == [grams(t) for t in texts] and all(len(g) == len(set(g)) for g in got)
    assert column_of(["a b c d"], N.shingle_hash(F.col("text"))) == [1899977003]
    expected = [brute_signature(t) for t in texts]
    assert column_of(texts, N.minhash(F.col("text"))) == expected
    assert column_of(texts, N.minhash_native(F.col("text"))) == expected
    assert [expected[0][i] for i in (0, 1, 127)] == [2663766899, 2759887216, 3303737401]


def test_pairs_are_compared_without_arrays_of_shingles(spark):
    texts = [None, "", " \n", "a", "a b c", "a b c d", "a  b\tc d e", "a b c d e f a b c d e f", "é ü ñ ö ä 你好 x"]
    both = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    sets = [N.word_ngrams(F.col(c)) for c in "ab"]
    for r in both.select(N.jaccard(*sets).alias("x"), N.text_jaccard(F.col("a"), F.col("b")).alias("y")).collect():
        assert r.x == r.y
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = N.verify_pairs(spark.createDataFrame([(4, 5), (5, 6), (1, 2)], "i long, j long"), docs, 0.0)
    assert "array_intersect" not in found._jdf.queryExecution().toString()
    assert sorted(map(tuple, found.collect())) == [(1, 2, 1.0), (4, 5, 0.0), (5, 6, 0.5)]


def test_jaccard_edges(spark):
    rows = [(["a", "b", "c", "d"], ["a", "b", "c", "d", "e"]), ([], []), ([], ["a"])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "k int, a array<string>, b array<string>")
    assert [r[0] for r in df.orderBy("k").select(N.jaccard(F.col("a"), F.col("b"))).collect()] == [0.8, 1.0, 0.0]


def family(rnd, base, size, change):
    """Variants of a base text with a share of the words replaced."""
    words = base.split()
    out = []
    for _ in range(size):
        w = list(words)
        for _ in range(int(len(w) * change)):
            w[rnd.randrange(len(w))] = f"w{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    """Copies, close variants, look-alikes below the threshold, chains, empties."""
    rnd = random.Random(seed)
    page = lambda n: " ".join(f"p{rnd.randrange(10**6)}" for _ in range(n))
    one, two, three = page(120), page(200), page(150)
    texts = [one] * 25 + family(rnd, one, 12, 0.01) + family(rnd, two, 20, 0.04) + family(rnd, three, 20, 0.1)
    chain = page(160).split()
    for step in range(8):
        texts.append(" ".join(chain[step * 6:step * 6 + 100]))
    # one frame around different, fairly long insertions: many shared buckets, few links
    frame = page(110).split()
    texts += [" ".join(frame[:55] + page(14).split() + frame[55:]) for _ in range(30)]
    texts += ["", " ", "a b", "a  b", "a b c", page(60)]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed,options", [
    (1, {}), (2, {"hubs": 2, "rows_per_task": 5}), (3, {"hubs": 1, "rows_per_task": 1000})])
def test_clusters_equal_brute_force(docs_of, seed, options):
    texts = corpus(seed)
    expected = brute_clusters(texts)
    found = N.NearDuplicates(docs_of(texts), **options)
    assert [r.cluster_id for r in found.clusters().orderBy("doc_id").collect()] == expected
    assert sorted(r.doc_id for r in found.kept().collect()) == sorted(set(expected))
    sizes = {c: expected.count(c) for c in set(expected) if expected.count(c) > 1}
    assert {r.cluster_id: r["size"] for r in found.sizes().collect()} == sizes


def test_division_keeps_every_link(docs_of):
    texts = corpus(5)[:60] + ["one", " one", "a b c d e", "a b c  d e", "a b c d"]
    docs = docs_of(texts)
    members = N.undivided(docs.select(F.lit(7).cast("long").alias("bucket"), "doc_id"))
    sets = N.shingle_sets(docs, "doc_id", 4)
    once = N._divide(members, sets, "doc_id", 0.8, 10)
    once = once.select(*members.columns).persist()
    twice = N._divide(once.filter(N.divisible()), sets, "doc_id", 0.8, 1000).select(*members.columns)
    twice = twice.unionByName(once.filter(~N.divisible()))
    linked = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts))
              if grams(texts[i]) and len(grams(texts[i]) & grams(texts[j])) / len(grams(texts[i]) | grams(texts[j])) >= 0.8}
    assert len(linked) > 50
    for parts in (once, twice):
        by_bucket = {}
        for r in parts.collect():
            by_bucket.setdefault(r.bucket, []).append((r.doc_id, r.side))
        together = {(i, j) for ids in by_bucket.values() for i, a in ids for j, b in ids if i < j and (a == 0 or a != b)}
        assert linked <= together


@pytest.mark.parametrize("kind", ["linked", "look-alikes", "of many lengths"])
def test_compared_pairs_grow_with_the_texts(docs_of, monkeypatch, kind):
    rnd = random.Random(12)
    page = lambda n: [f"p{rnd.randrange(10**7)}" for _ in range(n)]
    frame, verified, compared = page(150), N._verified, []

    def counted(pairs, *rest):
        compared[-1] += pairs.count()
        return verified(pairs, *rest)

    monkeypatch.setattr(N, "_verified", counted)

    def variant():
        if kind == "linked":
            at = rnd.randrange(150)
            return frame[:at] + page(1) + frame[at:]
        # Neighbours share 147 of 147 + 2 (m + 3) shingles: 0.77 for m = 19.
        return frame[:75] + page(19 if kind == "look-alikes" else rnd.randrange(21, 40)) + frame[75:]

    for size in (300, 1200):
        compared.append(0)
        texts = [" ".join(variant()) for _ in range(size)]
        links = N.find_links(
            docs_of(texts).select("doc_id", F.array(F.lit(5).cast("long")).alias("buckets")), docs_of(texts),
            "text", "doc_id", 0.8, 4, 8, 1000)
        found = connected_components(links)
        assert found.count() == (size if kind == "linked" else 0)
    # Eight hubs on average, drawn by chance.
    assert 0 < compared[1] < 6 * compared[0] and compared[1] < 1200 * 24


def test_scope_order_and_partitioning(docs_of):
    texts = corpus(4)[:50]
    scoped = docs_of(texts).withColumn("chunk", F.floor(F.col("doc_id") / 20))
    expected = brute_clusters(texts, [i // 20 for i in range(50)])
    got = N.NearDuplicates(scoped, scope=["chunk"]).clusters().orderBy("doc_id").collect()
    assert [r.cluster_id for r in got] == expected
    whole = sorted(set(brute_clusters(texts)))
    again = N.dedup(docs_of(texts).orderBy(F.desc("doc_id")).repartition(7))
    assert sorted(r.doc_id for r in again.collect()) == whole
    assert sorted(r.doc_id for r in N.dedup(again).collect()) == whole


def test_nothing_to_do(docs_of):
    assert N.dedup(docs_of(["only one text here"])).count() == 1
    assert N.dedup(docs_of(["x"]).filter("false")).count() == 0


def test_candidate_and_verified_pairs(docs_of):
    texts = corpus(6)[:40]
    docs = docs_of(texts)
    pairs = N.bucket_links(N.lsh_bands(docs), rows_per_task=3)
    got = {(r.i, r.j) for r in pairs.collect()}
    sigs = [brute_signature(t) for t in texts]
    expected = set()
    for b in range(16):
        first = {}
        for i, s in enumerate(sigs):
            f = first.setdefault(tuple(s[b * 8:b * 8 + 8]), i)
            if f != i:
                expected.add((f, i))
    assert got == expected
    for r in N.verify_pairs(pairs, docs, rows_per_task=3).collect():
        a, b = grams(texts[r.i]), grams(texts[r.j])
        assert r.similarity == (len(a & b) / len(a | b) if a | b else 1.0) >= 0.8


@pytest.mark.parametrize("rows_per_task", [4, 1_000_000])
def test_components(spark, rows_per_task):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [
        (rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)] + [(500, 500)]
    label = {}
    for a, b in edges:
        if a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(60):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(edges, "i long, j long")
    assert {r.node: r.component for r in connected_components(df, rows_per_task=rows_per_task).collect()} == label


def test_balanced_joins(spark):
    left = spark.createDataFrame([(i % 3 if i % 2 else 0, i) for i in range(200)], "k int, v int")
    right = spark.createDataFrame([(0, "a", 150), (1, "b", 40), (3, "c", 1)], "k int, w string, n long")
    expected = sorted(map(tuple, left.join(right, "k").select("k", "v", "w").collect()))
    for limits in ({}, {"broadcast_rows": 0, "hot_keys": 2}):
        assert sorted(map(tuple, lookup(left, right, "k", "n", **limits).select("k", "v", "w").collect())) == expected
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = join_by_count(left, right.drop("n"), "k", counts, 20)
    assert sorted(map(tuple, got.select("k", "v", "w").collect())) == expected


def test_no_cartesian_product(docs_of):
    found = N.NearDuplicates(docs_of(corpus(8)[:30]))
    for df in (found.clusters(), found.kept(), N.bucket_links(N.lsh_bands(docs_of(["a b", "c"])))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("rows_per_task", [7, 1_000_000])
def test_all_links_equal_brute_force(docs_of, rows_per_task):
    texts = corpus(9)
    got = {(r.i, r.j): r.similarity for r in N.all_links(docs_of(texts), rows_per_task=rows_per_task).collect()}
    first, expected = {}, {}
    for i, t in enumerate(texts):
        rep = first.setdefault(" ".join(t.split()), i)
        if rep != i:
            expected[rep, i] = 1.0
    reps = sorted(first.values())
    sigs, sets = {i: brute_signature(texts[i]) for i in reps}, {i: grams(texts[i]) for i in reps}
    for i in reps:
        for j in reps:
            if i < j and any(sigs[i][b * 8:b * 8 + 8] == sigs[j][b * 8:b * 8 + 8] for b in range(16)):
                share = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
                if share >= 0.8:
                    expected[i, j] = share
    assert got == expected
    assert len(expected) > 100


def test_all_links_of_few_documents(docs_of):
    assert N.all_links(docs_of(["one two", "", " "])).collect() == [(1, 2, 1.0)]
    assert N.all_links(docs_of(["x"]).limit(0)).count() == 0


def test_a_worker_holds_one_text_at_a_time(monkeypatch, spark):
    made, real = [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda fn: made.append(fn) or real(kind)(fn))
    N.minhash(F.col("text"))
    texts = pa.array([f"{i} " + "word " * 4000 for i in range(1000)])
    tracemalloc.start()
    got = made[0](texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The texts are 20 MB.
    assert len(got) == 1000 and peak < 8 << 20


def test_shingles_hashed_side_by_side():
    rnd = random.Random(3)
    pieces = [bytes(rnd.randrange(256) for _ in range(size)) for size in [*range(70), 119, 200]]
    ends = np.cumsum([len(p) for p in pieces])
    data = np.frombuffer(b"".join(pieces) + bytes(64), np.uint8)
    got = N._first_bits()(data, ends - [len(p) for p in pieces], ends)
    assert got.tolist() == [int(md5(p).hexdigest()[:8], 16) for p in pieces]


def test_least_values_that_lie_close_are_exact(monkeypatch, spark):
    p, grams4 = fixed.HASH_PRIME, ["a b c d", "b c d e", "c d e f"]
    x = [int(md5(g.encode()).hexdigest()[:8], 16) for g in grams4]
    families = [(a, (low - a * x[0]) % p) for a in (1, 77, 2**32 - 1) for low in (0, 1, 3, 9, p - 1, p - 2, p - 3, p - 9)]
    for low in (0, 5, 10**6, 2**31):
        for gap in (1, 2, 3, 5, p - 1, p - 2):
            # The second shingle's value is the first one's and the gap.
            a = gap * pow(x[1] - x[0], -1, p) % p
            families.append((a, (low - a * x[0]) % p))
    families += [(1, 0)] * (128 - len(families))
    monkeypatch.setattr(N, "hash_family", lambda k, seed: tuple(zip(*families)))
    made, real = [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda fn: made.append(fn) or real(kind)(fn))
    N.minhash(F.col("text"))
    got = made[0](pa.array(["a b c d", "a b c d e", "a b c d e f"])).to_pylist()
    for row, some in zip(got, (x[:1], x[:2], x)):
        assert row == [min((a * v + b) % p for v in some) for a, b in families]
