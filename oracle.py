"""DuckDB statements that define the expected result of each registered query.

Fragments are plain SQL; RE2 has no look-around, so patterns that need it are
written with captured neighbours or a marker character.
"""

from __future__ import annotations

from textloom import fixed
from textloom.operators.neardup import EMPTY_HASH, hash_family

S, W = fixed.SPACE, fixed.WORD

# Entities of the test pages (fixed values); &amp; is replaced after them.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "),
    ("&middot;", "·"), ("&copy;", "©"), ("&reg;", "®"), ("&hellip;", "…"),
    ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"),
    ("&ldquo;", "“"), ("&rdquo;", "”"), ("&euro;", "€"),
)


def norm(c: str) -> str:
    bare = f"regexp_replace(lower(strip_accents({c})), '[^{W}{S}]+', '', 'g')"
    return f"trim(regexp_replace({bare}, '[{S}]+', ' ', 'g'))"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{S}]+|[{S}]+$', '', 'g')"


def flat(c: str) -> str:
    return strip(f"translate({c}, chr(10) || chr(13), '  ')")


def one_line(c: str) -> str:
    return f"replace(replace({c}, chr(10), ' '), chr(13), '')"


def query(*ctes_and_select: str) -> str:
    *ctes, select = ctes_and_select
    return (f"WITH RECURSIVE {', '.join(ctes)} " if ctes else "") + select


NORMAL = f"normal AS (SELECT doc_id, lang, source, {norm('text')} AS text FROM documents)"

# --- HTML -------------------------------------------------------------------------


def html_text(c: str) -> str:
    for region in ("<!--.*?-->", r"<script\b.*?</script\s*>", r"<style\b.*?</style\s*>", r"<head\b.*?</head\s*>"):
        c = f"regexp_replace({c}, '(?is){region}', '', 'g')"
    c = rf"regexp_replace({c}, '(?i)</?(?:p|div|li|h[1-6]|br|tr|article|nav|footer|ul)\b[^>]*>', chr(10), 'g')"
    c = f"regexp_replace({c}, '(?s)<[a-zA-Z/!][^>]*>', '', 'g')"
    for name, char in ENTITIES:
        c = "replace({}, '{}', '{}')".format(c, name, char.replace("'", "''"))
    c = f"replace({c}, '&amp;', '&')"
    c = rf"regexp_replace({c}, '[ \t\r\f\x0b]+', ' ', 'g')"
    c = rf"regexp_replace({c}, ' ?\n[ \n]*', chr(10), 'g')"
    return rf"regexp_replace({c}, '\A[ \n]+|[ \n]+\z', '', 'g')"


# --- personal data: patterns are fixed values -----------------------------------------
EMAIL = r"\b[a-zA-Z0-9._%+-]+@(?:[a-zA-Z0-9-]+\.)+[a-zA-Z]{2,}\b"
_SEP = rf"[{S}\-.]?"
PHONE = rf"(?:\+?\p{{Nd}}{{1,3}}{_SEP})?(?:\(?\p{{Nd}}{{2,4}}\)?{_SEP})\p{{Nd}}{{3,4}}{_SEP}\p{{Nd}}{{4}}"
_OCTET = r"(?:25[0-5]|2[0-4]\p{Nd}|1?\p{Nd}?\p{Nd})"
IP = r"\.".join([_OCTET] * 4)


def _guarded(c: str, pattern: str, mask: str) -> str:
    """Not next to a digit; twice, since a match takes the neighbour with it."""
    once = rf"regexp_replace({c}, '(^|[^\p{{Nd}}])(?:{pattern})([^\p{{Nd}}]|$)', '\1{mask}\2', 'g')"
    return rf"regexp_replace({once}, '(^|[^\p{{Nd}}])(?:{pattern})([^\p{{Nd}}]|$)', '\1{mask}\2', 'g')"


def mask(c: str, kind: str) -> str:
    if kind == "email":
        return f"regexp_replace({c}, '{EMAIL}', '{fixed.EMAIL_MASK}', 'g')"
    return _guarded(c, PHONE, fixed.PHONE_MASK) if kind == "phone" else _guarded(c, IP, fixed.IP_MASK)


MASKS = {"email": fixed.EMAIL_MASK, "phone": fixed.PHONE_MASK, "ip": fixed.IP_MASK}


def mask_all(c: str) -> str:
    return mask(mask(mask(c, "email"), "phone"), "ip")


def masks_in(c: str, kind: str) -> str:
    m = MASKS[kind]
    return f"CAST((length({c}) - length(replace({c}, '{m}', ''))) / {len(m)} AS BIGINT)"


def mask_one(kind: str) -> str:
    return query(f"m AS (SELECT doc_id, text AS t, {mask('text', kind)} AS text FROM documents)",
                 f"SELECT doc_id, text, {masks_in('text', kind)} - {masks_in('t', kind)} AS {kind}s FROM m")


MASKED = (f"masked AS (SELECT doc_id, lang, text AS t, {mask_all('text')} AS text FROM documents), "
          "counted AS (SELECT doc_id, lang, text, "
          + ", ".join(f"{masks_in('text', k)} - {masks_in('t', k)} AS {k}s" for k in MASKS) + " FROM masked)")

# --- quality ------------------------------------------------------------------------
TOKEN = fixed.WORD_TOKEN.replace("'", "''").replace("*+", "*")


def quality(source: str, key: str = "doc_id") -> str:
    """CTEs metrics and judged over source(key, text)."""
    return f"""
    worded AS (SELECT {key}, text, regexp_extract_all(text, '{TOKEN}') AS w FROM {source}),
    metrics AS (SELECT {key}, text, CAST(len(w) AS BIGINT) AS n_words,
      length(array_to_string(w, '')) / nullif(len(w), 0) AS mean_word_len,
      len(list_filter(string_split(text, chr(10)), lambda l: right(l, 3) = '...'))
        / len(string_split(text, chr(10))) AS ellipsis_ratio,
      len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) / nullif(len(w), 0) AS alpha_ratio FROM worded),
    judged AS (SELECT *, CASE WHEN n_words < 50 OR n_words > 100000 THEN 'word_count'
      WHEN mean_word_len < 3 OR mean_word_len > 10 THEN 'word_length'
      WHEN ellipsis_ratio > 0.3 THEN 'ellipsis_lines'
      WHEN alpha_ratio < 0.8 THEN 'alpha_words' END AS drop_reason FROM metrics)"""


# --- naive Bayes ----------------------------------------------------------------------

NB = NORMAL + """,
    flags AS (SELECT doc_id, CAST(quality = 0 AS BIGINT) AS is_nsfw, CAST(toxic = 1 AS BIGINT) AS is_toxic FROM labels),
    labelled AS (SELECT f.* FROM flags f SEMI JOIN documents USING (doc_id)),
    nb_tokens AS (SELECT unnest(list_filter(string_split(text, ' '), lambda x: x <> '')) AS token, is_nsfw, is_toxic
      FROM normal JOIN flags USING (doc_id)),
    nb_counts AS (SELECT token, count(*) AS n, CAST(sum(is_nsfw) AS BIGINT) AS pos_nsfw,
      CAST(sum(is_toxic) AS BIGINT) AS pos_toxic FROM nb_tokens GROUP BY token),
    nb_total AS (SELECT count(*) AS size, sum(n) AS n, sum(pos_nsfw) AS t_nsfw, sum(pos_toxic) AS t_toxic FROM nb_counts),
    weights AS (SELECT token, c.n, """ + ", ".join(
    f"ln((pos_{t} + 1) / CAST(t_{t} + size AS DOUBLE)) "
    f"- ln((c.n - pos_{t} + 1) / CAST(o.n - t_{t} + size AS DOUBLE)) AS w_{t}" for t in ("nsfw", "toxic")) + """
      FROM nb_counts c, nb_total o),
    prior AS (SELECT ln(sum(is_nsfw) / (count(*) - sum(is_nsfw))) AS p_nsfw,
      ln(sum(is_toxic) / (count(*) - sum(is_toxic))) AS p_toxic FROM labelled)"""


def nb_scores(source: str, key: str = "doc_id") -> str:
    """CTE scored over source(key, text)."""
    odds = ", ".join(f"coalesce(sum(w_{t}), 0) + any_value(p_{t}) AS o_{t}" for t in ("nsfw", "toxic"))
    cols = ", ".join(
        f"CASE WHEN o_{t} > 0 THEN '{t}' ELSE 'non-{t}' END AS {t}_label, "
        f"round(CASE WHEN o_{t} > 0 THEN 1 / (1 + exp(-o_{t})) ELSE 1 - 1 / (1 + exp(-o_{t})) END, 6) AS {t}_score"
        for t in ("nsfw", "toxic"))
    return f"""
    score_tokens AS (SELECT {key}, unnest(CASE WHEN text = '' THEN [''] ELSE string_split(text, ' ') END) AS token FROM {source}),
    odds AS (SELECT {key}, {odds} FROM score_tokens LEFT JOIN weights USING (token), prior GROUP BY {key}),
    scored AS (SELECT {key}, {cols} FROM odds)"""


LABEL_GATE = "nsfw_label = 'non-nsfw' AND toxic_label = 'non-toxic'"
SCORE_GATE = f"{LABEL_GATE} AND nsfw_score > 0.75 AND toxic_score >= 0.75"

CLEAN_PAGE = (NB + "," + nb_scores("normal") + "," + quality("normal") + f""",
    cleaned AS (SELECT doc_id, {mask_all('text')} AS text FROM judged JOIN scored USING (doc_id)
      WHERE drop_reason IS NULL AND {SCORE_GATE})""")

COLLECT = (NB + f""",
    flat AS (SELECT page_id AS url_rank, url, {flat(html_text('html'))} AS text FROM pages),
    long_flat AS (SELECT * FROM flat WHERE length(text) >= 100),
    """ + quality("long_flat", "url_rank") + f""",
    page_words AS (SELECT url_rank, {norm('text')} AS text FROM judged WHERE drop_reason IS NULL),
    """ + nb_scores("page_words", "url_rank") + f""",
    samples AS (SELECT url_rank, url, '__label__high ' || {mask_all('text')} AS text
      FROM flat JOIN scored USING (url_rank) WHERE {LABEL_GATE})""")

# --- near duplicates --------------------------------------------------------------------


def shingles(source: str) -> str:
    return f"""
    split_words AS (SELECT doc_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS w FROM {source}),
    grams AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g
      FROM split_words),
    shingle AS (SELECT doc_id, s, CAST('0x' || substr(md5(s), 1, 8) AS BIGINT) AS x
      FROM (SELECT doc_id, unnest(g) AS s FROM grams))"""


def signatures(source: str) -> str:
    p = fixed.HASH_PRIME
    mins = ", ".join(
        f"coalesce(min(((x * {a >> 16} % {p}) * 65536 + x * {a & 65535} + {b}) % {p}), {EMPTY_HASH})"
        for a, b in zip(*hash_family()))
    return shingles(source) + f""",
    signed AS (SELECT doc_id, [{mins}] AS sig FROM grams LEFT JOIN shingle USING (doc_id) GROUP BY doc_id),
    bands AS (SELECT doc_id, band, array_to_string(sig[band * 8 + 1:band * 8 + 8], ',') AS band_key
      FROM signed, (SELECT CAST(unnest(range(16)) AS INTEGER) AS band))"""


JACCARD = ("CASE WHEN len(a.g) + len(b.g) = 0 THEN 1.0 ELSE len(list_intersect(a.g, b.g)) / "
           "(len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) END")


def clusters(source: str, scope: str | None = None) -> str:
    """CTE clustered(doc_id, cluster_id) over source(doc_id, text[, scope])."""
    chunks = f", scopes AS (SELECT doc_id, {scope} AS scope FROM {source})" if scope else (
        f", scopes AS (SELECT doc_id, 0 AS scope FROM {source})")
    return signatures(source) + chunks + f""",
    scoped AS (SELECT doc_id, scope, band, band_key FROM bands JOIN scopes USING (doc_id)),
    met AS (SELECT DISTINCT l.doc_id AS i, r.doc_id AS j FROM scoped l JOIN scoped r
      ON l.band = r.band AND l.band_key = r.band_key AND l.scope = r.scope AND l.doc_id < r.doc_id),
    edge AS (SELECT i, j FROM met JOIN grams a ON a.doc_id = i JOIN grams b ON b.doc_id = j WHERE {JACCARD} >= 0.8),
    arc AS (SELECT i, j FROM edge UNION ALL SELECT j, i FROM edge),
    reach AS (SELECT doc_id, doc_id AS other FROM {source} UNION SELECT r.doc_id, a.j FROM reach r JOIN arc a ON a.i = r.other),
    clustered AS (SELECT doc_id, min(other) AS cluster_id FROM reach GROUP BY doc_id)"""


# --- tokenizer ------------------------------------------------------------------------------
_T = fixed.SPLIT_SPACE
# chr(1) goes before the last white space in front of other text; what is left of
# a run of white space then needs no look-ahead.
PRETOKEN = (rf"''(?:[sdmt]|ll|ve|re)|(?:\x01 )?\p{{L}}+|(?:\x01 )?\p{{N}}+|(?:\x01 )?[^{_T}\x01\p{{L}}\p{{N}}]+"
            rf"|\x01[{_T}]|[{_T}]+")


def pretokens(c: str) -> str:
    marked = rf"regexp_replace({c}, '([{_T}])([^{_T}])', chr(1) || '\1\2', 'g')"
    return f"list_transform(regexp_extract_all({marked}, '{PRETOKEN}'), lambda t: replace(t, chr(1), ''))"


WORDS = f"""tok AS (SELECT doc_id, {pretokens('text')} AS words FROM documents),
    word_counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM tok) GROUP BY word)"""
SYMBOLS = r"regexp_replace(hex(encode(word)), '(..)', '.\1 ', 'g')"
W0 = f"w0 AS MATERIALIZED (SELECT word, {SYMBOLS} AS s, n FROM word_counts)"


def pairs(source: str, name: str) -> str:
    return f"""{name} AS (SELECT '.' || l[i] || ' .' || l[i + 1] || ' ' AS pair, CAST(sum(n) AS BIGINT) AS n
      FROM (SELECT l, n, unnest(range(1, len(l))) AS i
        FROM (SELECT string_split(replace(trim(s), '.', ''), ' ') AS l, n FROM {source} WHERE contains(s, ' .')))
      GROUP BY 1)"""


def best(source: str, name: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT pair, n FROM {source} ORDER BY n DESC, pair DESC LIMIT 1)"


def training(merges: int) -> list[str]:
    """CTEs rounds(k, word, s, n, pair), the words after k merges with the last one, and trained(word, s, n)."""
    return [WORDS, W0, f"""rounds AS (
      SELECT 0 AS k, word, s, n, CAST(NULL AS VARCHAR) AS pair FROM w0 WHERE contains(s, ' .')
      UNION ALL SELECT r.k + 1, r.word, replace(r.s, b.pair, replace(b.pair, ' .', '')), r.n, b.pair
      FROM rounds AS r, (SELECT pair FROM (SELECT '.' || l[i] || ' .' || l[i + 1] || ' ' AS pair, n
          FROM (SELECT l, n, unnest(range(1, len(l))) AS i FROM (SELECT string_split(replace(trim(s), '.', ''), ' ') AS l, n FROM rounds)))
        GROUP BY pair ORDER BY sum(n) DESC, pair DESC LIMIT 1) AS b WHERE r.k < {merges})""",
            "merged AS MATERIALIZED (SELECT k, any_value(pair) AS pair FROM rounds WHERE k > 0 GROUP BY k)",
            "trained AS MATERIALIZED (SELECT word, s, n FROM rounds WHERE k = (SELECT max(k) FROM rounds) "
            "UNION ALL SELECT word, s, n FROM w0 WHERE NOT contains(s, ' .'))"]


def merge_rows(first_rank: int = 0) -> str:
    """rank, left, right as hex, from the CTEs of training()."""
    return (rf"SELECT CAST({first_rank} + k - 1 AS INTEGER) AS rank, lower(regexp_extract(pair, '^\.([0-9A-F]+) \.([0-9A-F]+) $', 1)) AS left_hex, "
            r"lower(regexp_extract(pair, '^\.([0-9A-F]+) \.([0-9A-F]+) $', 2)) AS right_hex FROM merged")


def vocabulary(special: str) -> str:
    """CTE vocab(id, hex): bytes, the special token, then merges."""
    return ("vocab AS (SELECT CAST(id AS INTEGER) AS id, hex FROM (SELECT unnest(range(256)) AS id, "
            "upper(printf('%02x', unnest(range(256)))) AS hex UNION ALL SELECT 256, hex(encode('" + special + "')) "
            "UNION ALL SELECT 256 + k, regexp_replace(pair, '[. ]', '', 'g') FROM merged))")


def encoded() -> str:
    """CTE coded(doc_id, ids): words spelled in final symbols, looked up, put in order."""
    return """
    word_ids AS (SELECT word, list(id ORDER BY p) AS ids FROM (
      SELECT word, unnest(l) AS hex, unnest(range(len(l))) AS p
      FROM (SELECT word, string_split(replace(trim(s), '.', ''), ' ') AS l FROM trained)) JOIN vocab USING (hex) GROUP BY word),
    coded AS (SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM (
      SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM tok) JOIN word_ids USING (word) GROUP BY doc_id)"""


# --- training sets: bytes as tokens -------------------------------------------------------------
BYTES = """spelled AS MATERIALIZED (SELECT doc_id, hex(encode(text)) AS h FROM documents),
    byte_tokens AS MATERIALIZED (SELECT doc_id, list_transform(regexp_extract_all(h, '..'), lambda d: CAST('0x' || d AS INTEGER)) AS ids FROM spelled)"""
HASHED = "md5(doc_id || ':{seed}')"
SPLIT = f"""ranked AS (SELECT doc_id, row_number() OVER (ORDER BY {HASHED.format(seed=42)}, doc_id) AS r, count(*) OVER () AS c FROM documents),
    sets AS (SELECT doc_id, CASE WHEN r <= ceil(0.1 * c) THEN 'valid' ELSE 'train' END AS split FROM ranked)"""


def windows(length: int, tokens: str = BYTES) -> str:
    """``tokens`` defines byte_tokens(doc_id, ids)."""
    return tokens + f""",
    win AS (SELECT doc_id, list_concat(ids, list_transform(range({length} + 1), lambda z: CAST(0 AS INTEGER)))[1:{length} + 1] AS ids FROM byte_tokens),
    xy AS (SELECT doc_id, ids[1:{length}] AS x, ids[2:{length} + 1] AS y FROM win)"""


def bigrams(length: int, vocab: int = 256, tokens: str = BYTES) -> str:
    return windows(length, tokens) + "," + SPLIT + f""",
    pos_xy AS (SELECT doc_id, unnest(x) AS prev, unnest(y) AS next FROM xy),
    big AS (SELECT prev, next, count(*) AS n FROM pos_xy JOIN sets USING (doc_id) WHERE split = 'train' AND next <> 0 GROUP BY prev, next),
    prev_total AS (SELECT prev, sum(n) AS total FROM big GROUP BY prev),
    model AS (SELECT prev, next, n, (n + 1) / CAST(total + {vocab} AS DOUBLE) AS p FROM big JOIN prev_total USING (prev)),
    nll AS (SELECT doc_id, sum(CASE WHEN s.next <> 0 THEN -ln(coalesce(p, 1.0 / (total + {vocab}), 1.0 / {vocab})) ELSE 0 END) AS nll,
      count(*) FILTER (s.next <> 0) AS targets FROM pos_xy s LEFT JOIN model m ON s.prev = m.prev AND s.next = m.next
      LEFT JOIN prev_total t ON s.prev = t.prev GROUP BY doc_id)"""


def losses(length: int, size: int, vocab: int = 256, tokens: str = BYTES) -> str:
    return bigrams(length, vocab, tokens) + f""",
    placed AS (SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // {size} AS BIGINT) AS batch
      FROM sets WHERE split = 'valid'),
    loss AS (SELECT batch, sum(nll) / sum(targets) AS loss FROM nll JOIN placed USING (doc_id) GROUP BY batch HAVING sum(targets) > 0)"""


# --- conversations ---------------------------------------------------------------------------------
TURNS = f"""ends AS (SELECT conv_id, min(turn) AS quit_turn FROM conversations WHERE role = 'user' AND lower(text) IN ('quit', 'exit') GROUP BY conv_id),
    kept AS (SELECT c.* FROM conversations c LEFT JOIN ends USING (conv_id)
      WHERE (quit_turn IS NULL OR turn < quit_turn) AND NOT (role = 'user' AND {strip('text')} = '')),
    piece AS (SELECT conv_id, turn, role, CASE role WHEN 'user' THEN chr(10) || 'User: ' || text || chr(10) || 'Bot:'
      WHEN 'assistant' THEN ' ' || {strip('text')} END AS piece FROM kept WHERE role IN ('user', 'assistant'))"""


COUNTED = f"counted AS (SELECT conv_id, turn, role, CAST(len({pretokens('piece')}) AS BIGINT) AS tokens FROM piece)"


def counted_ids(merges: int) -> str:
    """CTE counted(conv_id, turn, role, tokens): ids of each piece, by a vocabulary trained on all pieces."""
    return ", ".join([f"""tok AS (SELECT conv_id, turn, role, {pretokens('piece')} AS words FROM piece),
    word_counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM tok) GROUP BY word)""", *training(merges)[1:], """
    word_size AS MATERIALIZED (SELECT word, len(string_split(trim(s), ' ')) AS size FROM trained),
    counted AS (SELECT conv_id, turn, role, CAST(sum(size) AS BIGINT) AS tokens FROM (
      SELECT conv_id, turn, role, unnest(words) AS word FROM tok) JOIN word_size USING (word) GROUP BY conv_id, turn, role)"""])


def budget(limit: int, counted: str = COUNTED) -> str:
    return TURNS + f""",
    {counted},
    numbered AS MATERIALIZED (SELECT conv_id, turn, role, tokens, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM counted),
    held AS (SELECT conv_id, turn, k, tokens AS held, role = 'assistant' AND tokens > {limit} AS cleared FROM numbered WHERE k = 1
      UNION ALL
      SELECT n.conv_id, n.turn, n.k, CASE WHEN cleared THEN 0 ELSE held END + n.tokens,
        n.role = 'assistant' AND CASE WHEN cleared THEN 0 ELSE held END + n.tokens > {limit}
      FROM held h JOIN numbered n ON n.conv_id = h.conv_id AND n.k = h.k + 1)"""
