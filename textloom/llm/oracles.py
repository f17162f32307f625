"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from textloom.llm import cascade, chat_states, divergence, resample, secret_index, url_filter

_WORD, _SPACE = r"[^\x20\x09-\x0D]+", r"\x20\x09-\x0D"


def quality_rules() -> str:
    return rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    d AS (SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS w, string_split(text, chr(10)) AS lines FROM t),
    e AS (SELECT *, list_filter(lines, lambda x: regexp_matches(x, '{_WORD}')) AS l FROM d),
    p AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
    c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM p),
    r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM c, (VALUES (0), (1), (2)) AS s(k) WHERE n > 1 GROUP BY doc_id),
    o AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest(w) AS x FROM d) GROUP BY ALL) GROUP BY doc_id),
    m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
            CAST(len(regexp_extract_all(text, '[{cascade.SYMBOLS}]')) AS BIGINT) AS n_symbols,
            CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines,
            coalesce(o.n, 0) AS most, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS lettered,
            len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[{_SPACE}]*$'))) AS dots
          FROM e LEFT JOIN r USING (doc_id) LEFT JOIN o USING (doc_id)),
    f AS (SELECT *, n_words < {cascade.MIN_WORDS} OR 100 * n_repeat_words > {cascade.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT (word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
        OR 2 * n_dup_lines > n_lines OR 2 * lettered < n_words OR 10 * most > 3 * n_words OR 10 * dots > 3 * greatest(1, n_lines)) AS kept
    FROM f"""


def secret_scans() -> str:
    parts = []
    for n, rule in enumerate(secret_index.RULES):
        p = rule.pattern.replace("'", "''")
        parts.append(f"""
        SELECT doc_id, {n} AS n, '{rule.kind}' AS kind, g, m, part, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id,
          list_transform(string_split_regex(text, '{p}'), lambda x: length(x)) AS g,
          list_transform(regexp_extract_all(text, '{p}', 0), lambda x: length(x)) AS m,
          list_transform(regexp_extract_all(text, '{p}', {rule.group}), lambda x: length(x) >= {rule.least}) AS part FROM t)""")
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    f AS ({' UNION ALL '.join(parts)}),
    s AS (SELECT doc_id, n, kind, CAST(list_sum(g[1:i]) + coalesce(list_sum(m[1:i - 1]), 0) AS BIGINT) AS a, m[i] AS size FROM f WHERE part[i]),
    x AS (SELECT *, kind || ':' || a || ':' || (a + size) AS span FROM s)
    SELECT doc_id, {', '.join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secret_index.BASE)},
      sha256(coalesce(string_agg(span, ',' ORDER BY a, n) FILTER (WHERE n < {len(secret_index.BASE)}), '')) AS base_sha256,
      coalesce(string_agg(span, ',' ORDER BY a, n), '') AS spans
    FROM t LEFT JOIN x USING (doc_id) GROUP BY doc_id"""


def suffix_dedup() -> str:
    return """
    WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM t)),
    c AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM p) WHERE k > 1),
    b AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM c),
    r AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b),
    s AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM r GROUP BY doc_id, run),
    g AS (SELECT doc_id, z AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), -1) AS z FROM s
          UNION ALL SELECT doc_id, 0, coalesce((SELECT min(s.a) FROM s WHERE s.doc_id = t.doc_id), -1) FROM t),
    k AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (CASE WHEN z < 0 THEN length(h) // 2 ELSE z END - a)), '' ORDER BY a) AS kept
          FROM g JOIN t USING (doc_id) GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
    SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST((length(h) - length(kept)) // 2 AS BIGINT) AS n_removed,
      coalesce(n, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
    FROM t JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def divergence_audit() -> str:
    def share(n: str, total: str) -> str:
        return f"1 + CAST({divergence.UNIT} AS HUGEINT) * ({n} + 2) // ({total} + 2 * v)"

    return rf"""
    WITH t AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    w AS (SELECT id, lang, source, unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM t),
    k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {divergence.MIN_DOCS}),
    l AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM k GROUP BY lang),
    c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
    g AS (SELECT DISTINCT lang, source FROM t),
    s AS (SELECT g.lang, g.source, coalesce(any_value(v), 0) AS v, coalesce(any_value(lang_n), 0) AS lang_n, coalesce(sum(c.n), 0) AS group_n
          FROM g LEFT JOIN l USING (lang) LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
    p AS (SELECT s.lang, s.source, term, coalesce(n, 0) AS n, {share('coalesce(n, 0)', 'group_n')} AS p, {share('total', 'lang_n')} AS q
          FROM s JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
    d AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p AS a JOIN p AS b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
    r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
          UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q)
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM r
    QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def resampling() -> str:
    """For features of one word.  The CRC-32 goes byte by byte, four bits at a time."""
    s = resample.DEFAULT
    nibbles = ", ".join(str(_crc_of_nibble(i)) for i in range(16))
    return rf"""
    WITH t AS (SELECT row_number() OVER () AS id, doc_id, 0 AS part, text FROM documents
               UNION ALL SELECT row_number() OVER (), NULL, 1, text FROM benchmark),
    w AS (SELECT part, id, unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM t),
    n AS (SELECT part, id, word, count(*) AS n FROM w GROUP BY ALL),
    h AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM n)),
    y AS (SELECT word, list_transform(range(0, length(h), 2), lambda i: CAST('0x' || substr(h, i + 1, 2) AS BIGINT)) AS bytes FROM h),
    x AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
            xor(xor(xor(c, b) >> 4, [{nibbles}][1 + (xor(c, b) & 15)]) >> 4,
                [{nibbles}][1 + (xor(xor(c, b) >> 4, [{nibbles}][1 + (xor(c, b) & 15)]) & 15)])), 4294967295::BIGINT) % {s.buckets} AS bucket FROM y),
    b AS (SELECT bucket, sum(n) FILTER (WHERE part = 0) AS s, sum(n) FILTER (WHERE part = 1) AS t FROM n JOIN x USING (word) GROUP BY bucket),
    z AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM b),
    g AS (SELECT bucket, CAST(floor({s.scale} * ln((coalesce(b.t, 0) + 1)::DOUBLE * (z.s + {s.buckets})
            / ((coalesce(b.s, 0) + 1)::DOUBLE * (z.t + {s.buckets})))) AS BIGINT) AS gain FROM b, z),
    d AS (SELECT id, sum(n) AS n_features, sum(n * gain) AS weight FROM n JOIN x USING (word) JOIN g USING (bucket) WHERE part = 0 GROUP BY id),
    e AS (SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
            CAST('0x' || substr(sha256('{s.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
          FROM t LEFT JOIN d USING (id) WHERE part = 0),
    f AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-{s.scale} * ln(-ln((h + 0.5) / 4294967296.0))) AS BIGINT) AS score,
            n_features >= {s.min_words} AS able FROM e),
    r AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE able) OVER () AS many FROM f)
    SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= {s.percent} * many // 100 THEN place END AS rank FROM r"""


def _crc_of_nibble(i: int) -> int:
    for _ in range(4):
        i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
    return i


def url_verdicts() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)
    return rf"""
    WITH r(rule_host, rule_path, verdict) AS (VALUES {rules}),
    u AS (SELECT row_number() OVER () AS id, page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT id, page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1)")} AS host,
            regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM u)
    SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(verdict, 'allow') AS verdict
    FROM h LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY length(rule_host) + length(rule_path) DESC, length(rule_host) DESC) = 1"""


def chat(say: str) -> str:
    # By the default template, for roles that need no escape.
    follows = ", ".join(f"('{a}', '{b}')" for a, roles in chat_states.DEFAULT.follows.items() for b in sorted(roles))
    marks = len(chat_states.DEFAULT.before.format(role="") + chat_states.DEFAULT.after)
    return rf"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1, 0, 'user', '{say}'), (-1, 1, 'assistant', '{say}')),
    v AS (SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
      sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
      CAST(sum({marks} + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars,
      bool_and((before, role) IN ({follows})) AS valid
    FROM v GROUP BY conv_id"""
