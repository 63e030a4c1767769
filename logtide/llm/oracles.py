"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from logtide.llm.licenses import HINT, RULES, SENTENCES
from logtide.llm.quality_rules import STOP_FORMS

SPACE = "[ \\t\\n\\x0b\\f\\r]+"


def _listed(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


QUALITY = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS w
  FROM documents),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, word, w2, w3) AS times
  FROM (SELECT r, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3
        FROM words WINDOW o AS (PARTITION BY r ORDER BY i))
  WHERE w3 IS NOT NULL),
repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) t(k) WHERE times > 1 GROUP BY r),
lines AS (
  SELECT r, sum(times) AS n, count(*) AS n_distinct, sum(times * length(line))::BIGINT AS chars,
    sum((times - 1) * length(line))::BIGINT AS dup_chars
  FROM (SELECT r, line, count(*) AS times FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE NOT regexp_full_match(line, '[ \\t\\n\\x0b\\f\\r]*') GROUP BY r, line) GROUP BY r),
c AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lines.n - lines.n_distinct, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
    coalesce(lines.chars, 0) AS n_line_chars, coalesce(lines.dup_chars, 0) AS n_dup_line_chars, len(list_filter(w, lambda x: x IN ({_listed(STOP_FORMS)}))) AS n_stop_words
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
  AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words AND 100 * n_symbols <= 10 * n_words
  AND 100 * n_dup_line_chars <= 30 * n_line_chars AND 100 * n_stop_words >= n_words AS kept
FROM c"""

TOPK = """
WITH v AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT vec_id, i, floor(1024 * x)::BIGINT AS w FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.w * c.w)::BIGINT AS score
  FROM w q JOIN w c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10"""

_SENTENCE = " ".join(f"WHEN regexp_matches(s, '{pattern}') THEN '{name}'" for name, pattern in SENTENCES)


def _licenses() -> str:
    found = "SELECT doc_id, ids, concat(array_to_string(ids, ' '), ' ') AS seq, []::VARCHAR[] AS names FROM found"
    for rule in RULES:
        test = f"'\\b({rule.sequence})'"
        found = (
            f"SELECT doc_id, ids, regexp_replace(seq, {test}, '| ', 'g') AS seq, "
            f"CASE WHEN regexp_matches(seq, {test}) THEN list_append(names, '{rule.name}') ELSE names END AS names FROM ({found})"
        )
    return found


LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT r, unnest(string_split(regexp_replace(text, '[.!?]([ \\t\\n\\x0b\\f\\r])', chr(10) || '\\1', 'g'), chr(10))) AS s,
    generate_subscripts(string_split(regexp_replace(text, '[.!?]([ \\t\\n\\x0b\\f\\r])', chr(10) || '\\1', 'g'), chr(10)), 1) AS i
  FROM d),
plain AS (
  SELECT r, i, trim(regexp_replace(regexp_replace(lower(s), '[^a-z0-9.(),-]+', ' ', 'g'), '[.(), -]+$', ''), ' ') AS s FROM cut),
known AS (
  SELECT r, i, CASE {_SENTENCE} END AS id FROM plain WHERE s <> '' AND regexp_matches(s, '{HINT}')),
found AS (
  SELECT doc_id, coalesce(ids, []) AS ids
  FROM d LEFT JOIN (SELECT r, list(id ORDER BY i) AS ids FROM known WHERE id IS NOT NULL GROUP BY r) USING (r))
SELECT doc_id, len(ids) AS n_sentences, array_to_string(ids, ' ') AS sentence_ids,
  array_to_string(list_sort(list_distinct(names)), ',') AS licenses
FROM ({_licenses()})"""

AUDIT = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS w
  FROM documents),
marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
bits AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {{
    'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(doc_id > low, low IS NOT NULL)}} AS b
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS low FROM d) LEFT JOIN marks USING (doc_id)),
cells AS (
  SELECT part, MAP {{'A': b.A, 'B': b.B, 'C': b.C, 'D': b.D, 'E': b.E}} AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM bits GROUP BY ALL),
letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, step, filter_order[step] AS f, string_split(filter_order[1:step - 1], '') AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
tested AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS fail,
    coalesce(list_bool_or(list_transform(list_filter(earlier, lambda x: x <> ''), lambda x: fails[x])), false) AS gone,
    list_sum(list_transform(map_values(fails), lambda x: x::INT)) = 1 AS only_one
  FROM cells, steps),
counted AS (
  SELECT part, filter_order, step::INT AS step, f, coalesce(sum(n) FILTER (NOT gone AND NOT fail), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fail), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND fail), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fail AND only_one), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND fail), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND fail), 0)::BIGINT AS toxic_lost
  FROM tested GROUP BY ALL)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counted"""

# CRC-32 bit by bit over the digits of an id.
_BITS = "list_transform(range(0, 8 * length(conv_id::VARCHAR)), lambda i: (ascii(substr(conv_id::VARCHAR, (i // 8 + 1)::INT, 1)) >> (i % 8)::INT) & 1)"
_CRC = (
    f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform({_BITS}, lambda x: x::BIGINT)), "
    "lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"
)
TRIE = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
parts AS (
  SELECT c.conv_id, 0 AS own, pos, said FROM convs c JOIN t ON t.conv_id = base AND pos <= h
  UNION ALL SELECT conv_id, 1, pos, said FROM convs JOIN t USING (conv_id) WHERE pos > h),
rebuilt AS (
  SELECT conv_id, coalesce(turns, []) AS turns
  FROM convs LEFT JOIN (SELECT conv_id, list(said ORDER BY own, pos) AS turns FROM parts GROUP BY conv_id) USING (conv_id)),
paths AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT k, len(k) AS depth, k[1:len(k) - 1] AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ends
  FROM (SELECT conv_id, turns[1:depth] AS k, len(turns) = depth AS last FROM paths) GROUP BY k),
children AS (SELECT up AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up),
own AS (
  SELECT k, depth, coalesce(n_children, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0
      ELSE (n_convs - 1) * len(list_filter(regexp_split_to_array(k[depth].text, '{SPACE}'), lambda x: x <> '')) END AS saved
  FROM nodes LEFT JOIN children USING (k)),
subtrees AS (
  SELECT top AS k, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT k[1:d] AS top, n_children, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM own)) GROUP BY top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, o.n_children, s.n_leaves, s.saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN own o USING (k) JOIN subtrees s USING (k) LEFT JOIN nodes p ON n.depth > 0 AND p.k = n.up"""

PHRASES = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS w
  FROM documents),
words AS (SELECT r, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM d),
windows AS (
  SELECT r, doc_id, i, md5(s) AS s
  FROM (SELECT r, doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS s FROM words)
  WHERE i + 19 <= n),
gone AS (
  SELECT r, i FROM (
    SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS low, min(i) OVER (PARTITION BY s, r) AS first_here FROM windows)
  WHERE i > first_here OR coalesce(low < doc_id, low IS NOT NULL AND doc_id IS NULL)),
removed AS (SELECT DISTINCT r, i + k AS i FROM gone, (SELECT unnest(range(0, 20)) AS k)),
kept AS (
  SELECT w.r, count(g.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY w.i) FILTER (g.i IS NULL), '') AS kept
  FROM words w LEFT JOIN removed g ON g.r = w.r AND g.i = w.i GROUP BY w.r)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""

ORACLES = {
    "op2_exact_topk": TOPK,
    "op5_quality_rules": QUALITY,
    "op9_license_scan": LICENSES,
    "op11_filter_audit": AUDIT,
    "op12_substring_dedup": PHRASES,
    "op13_prefix_trie": TRIE,
}
