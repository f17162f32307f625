"""Operators 11 to 13 against plain restatements."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from textloom.llm import divergence, resample, url_filter

UPPER = {c: c + 32 for c in range(65, 91)}


# --- source divergence ----------------------------------------------------------------

def plain_audit(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER)))
            for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= min_docs)
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if seen[t] >= min_docs) for s in {d[1] for d in own}}
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            found = [(-f(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(found)[:top])):
                out += [(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(items, 1)]
    return sorted(out)


def audit_rows(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Ünï", "ÜNÏ", "x\x85y", "中文", "K", "é"]
    rows = [(None, None, None), ("en", "empty", ""), ("fr", "lone", "a a a"), ("zz", "a", "1 2 3"), ("zz", "b", None)]
    for _ in range(n):
        # One source has a third of the rows.
        source = rng.choice(["hot", "hot", "hot", "b", "c", "é", None, "a, \"b\"", "~"])
        words = [rng.choice(vocab[: rng.randint(1, len(vocab))]) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice(["en", "en", "de", ""]), source, rng.choice([" ", "\n", "9", "_", "\x00"]).join(words).swapcase()))
    return rows + rows[:20]


@pytest.mark.parametrize("held,cells", [(300_000, 500_000), (40, 30)])
def test_audit_equals_plain_one(spark, monkeypatch, held, cells):
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    monkeypatch.setattr(divergence.pair_sums, "__defaults__", (cells,))
    rows = audit_rows(400, 1)
    docs = spark.createDataFrame([(*r, 7, 1) for r in rows], "lang string, source string, text string, value long, block int").repartition(3)
    got = sorted(tuple(r) for r in divergence.audit(docs, 5, 4).collect())
    assert got == plain_audit(rows, 5, 4)
    assert {r[2] for r in got} == {"pair", "term"}


def test_audit_of_nothing_kept_and_of_no_rows(spark):
    docs = spark.createDataFrame([("en", "a", "x y"), ("en", "b", "z"), ("fr", "a", "x")], "lang string, source string, text string")
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence.audit(docs.limit(0)).count() == 0


def test_runs_and_pieces():
    rng = np.random.default_rng(5)
    for size in (1, 2, 30, 200):
        for _ in range(30):
            cols = []
            for _ in range(2):
                dense = rng.integers(0, 4, size) * rng.integers(0, 2, size)
                at = np.flatnonzero(dense)
                start, n = divergence.runs(at, at + 1, dense[at], size)
                assert start[0] == 0 and (n[1:] != n[:-1]).all() and (np.repeat(n, np.diff(np.r_[start, size])) == dense).all()
                cols.append((dense + 5, (start, n + 5)))
            (a, x), (b, y) = cols
            assert divergence.pair_sum(x, y, size) == int(((a - b) ** 2 // (a + b)).sum())


def test_shares_of_huge_counts_are_exact(spark):
    counts, total, v = [0, 3, 10**12 + 7, 9 * 10**17], 10**18, 10**6
    want = [1 + 10**9 * (c + 2) // (total + 2 * v) for c in counts]
    assert divergence.shares(np.array(counts), total, v).tolist() == want
    df = spark.createDataFrame([(c, total, v) for c in counts], "n long, total long, v long")
    F = pytest.importorskip("pyspark.sql.functions")
    assert [r.p for r in df.select(divergence.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).collect()] == want


# --- resampling -----------------------------------------------------------------------

def plain_rank(docs, target, s):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        runs = [" ".join(words[i:i + n]) for n in range(s.shortest, s.longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % s.buckets for r in runs]

    found = [(i, *features(t)) for i, t in docs]
    have, want = (Counter(b for f in x for b in f) for x in ([f for _, _, f in found], [features(t)[1] for t in target]))
    n, m = sum(have.values()), sum(want.values())
    gain = {b: math.floor(s.scale * math.log((want[b] + 1) * (n + s.buckets) / ((have[b] + 1) * (m + s.buckets)))) for b in have}
    rows = []
    for i, words, f in found:
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, len(f), weight, weight + math.floor(-s.scale * math.log(-math.log((h + 0.5) / 2**32))), words >= s.min_words])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    place = {id(r): k for k, r in enumerate(able[: s.percent * len(able) // 100], 1)}
    return sorted([(*r[:4], place.get(id(r))) for r in rows], key=repr)


@pytest.mark.parametrize("s", [resample.DEFAULT, resample.Settings(1, 3, 50, 3, 37, "7"), resample.Settings(2, 2, 1000, 0, 100)])
def test_rank_equals_plain_one(spark, s):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)] + ["Ünï", "x-y", "it's", "日本", "\x85", "A", "7"]
    texts = [rng.choice([" ", "  ", ", ", "\n", "@"]).join(rng.choices(vocab, k=rng.randint(0, 70))) for _ in range(300)]
    docs = [*enumerate(texts), (900, None), (901, ""), (902, " ., "), (None, texts[5]), (7, texts[7]), (7, texts[7])]
    target = [texts[3], None, "W1 w2 w3 w4"] * 4
    table = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, weight int, buckets string").repartition(3)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted((tuple(r) for r in resample.rank(table, wanted, s).collect()), key=repr)
    assert got == plain_rank(docs, target, s)
    assert len(resample.draw(table.filter("doc_id < 300 AND doc_id <> 7"), wanted, s).columns) == 4


def test_rank_of_few_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = docs.limit(0)
    assert resample.rank(none, docs).count() == 0
    assert resample.rank(docs, none).first()["rank"] is None
    assert resample.draw(docs, none).count() == 0


def test_spans_are_found_in_linear_time_in_one_long_word():
    words = resample.spaced(b"A" * 300_000 + b" - " + b"b " * 1000)
    assert list(resample.spans(words))[:2] == [(0, 300_000), (300_001, 300_002)]
    assert len(list(resample.spans(words, resample.Settings(3, 3)))) == 999


# --- URL filters ----------------------------------------------------------------------

def plain_verdict(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(UPPER)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


URLS = [None, "", "no scheme.com/", "http://", "http:///en/", "http://com/", "HTTP://COM", "x://a.COM/?q#f", "x://a.com?en/", "x://.com/", "x://xcom/",
        "https://www.example.com/en/a", "https://m.www.EXAMPLE.com/en/", "http://example.com/en", "http://example.com/en/?x", "http://a.net/es/1",
        "http://a.net/fr/#", "http://net/fr/", "http://a.net/en/", "a://b://c.com/d", "x://éx.com/é/ü", "x://a.com\n/en/", "x://" + "a." * 3000 + "com/" + "p" * 100_000]


@pytest.mark.parametrize("blocks", [1, url_filter.MAX_BLOCKS])
def test_verdicts_equal_plain_ones(spark, blocks):
    rng = random.Random(4)
    rules = [*url_filter.RULES, ("é.org", "/é", "block"), ("a.net", "", "allow"), *((f"h{i}.org", f"/{i}/", rng.choice(["allow", "block"])) for i in range(400))]
    urls = URLS * 2 + ["http://hot.com/x"] * 200 + [f"http://{rng.choice(['', 'a.', 'b.c.'])}h{rng.randint(0, 500)}.org/{rng.randint(0, 500)}/x" for _ in range(300)]
    urls += [f"http://h{i}.org/{i}/y" for i in range(400)] + ["http://x.é.org/éa"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("x", "/", None)], "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, table, max_blocks=blocks).collect()}
    assert len(got) == len(urls)
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}


def test_verdicts_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    table = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    assert [tuple(r) for r in url_filter.judge(pages, table.limit(0), "block").collect()] == [(1, "http://a.com/", "a.com", "/", None, "block")]
    assert url_filter.judge(pages.limit(0), table).count() == 0


def test_filter_misses_nothing_and_passes_little(spark):
    F = pytest.importorskip("pyspark.sql.functions")
    keys = spark.range(4000).select(F.col("id").cast("string").alias("key"))
    blocks = 1 + 2000 // url_filter.ENTRIES
    made = url_filter.bloom(keys.filter("int(key) < 2000"), blocks)
    hits = [int(r.key) for r in url_filter.possible(keys, made, blocks).collect()]
    assert set(range(2000)) <= set(hits) and len(hits) < 2060


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    table = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    plan = url_filter.judge(pages, table)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
