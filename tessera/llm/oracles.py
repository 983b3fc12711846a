"""DuckDB SQL of the registered queries (over the same tables)."""

from __future__ import annotations

from tessera.llm.secrets import ASSIGN, COPIED_OWNERS, KINDS

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
twice AS (SELECT r, g FROM g GROUP BY r, g HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (
          SELECT g.r, unnest([i, i + 1, i + 2]) AS p FROM g JOIN twice USING (r, g)) GROUP BY r),
f AS (SELECT doc_id, t, ls, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (
         n_symbols * 10 > n_words
         OR (length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g'))) * 10 > word_chars * 3
         OR (length(t) - length(replace(t, '!', ''))) * 2 > n_words
         OR n_dup_lines * 2 > len(ls)
         OR word_chars < n_words * 2 OR word_chars > n_words * 12
         OR (length(t) - length(regexp_replace(t, '\p{{L}}', '', 'g'))) * 2 < word_chars
         OR len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) * 2 > len(ls)) AS kept
FROM b"""


OP11 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS least FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> least THEN least END AS refers_to
FROM f"""

# crc32 bit by bit: a byte is nine steps, one that mixes it in and eight shifts.
OP13 = """
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT c, s, 0 AS i, 4294967295::BIGINT AS v FROM ids UNION ALL
        SELECT c, s, i + 1, CASE WHEN i % 9 = 0 THEN xor(v, ascii(substr(s, i // 9 + 1, 1))::BIGINT)
                                 WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END
        FROM crc WHERE i < 9 * length(s)),
turns AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS n,
                 coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, xor(v, 4294967295::BIGINT) % 4 AS h, c - c % 20 AS base FROM crc WHERE i = 9 * length(s)),
lens AS (SELECT c, count(*) AS own FROM turns GROUP BY c),
rebuilt AS (
  SELECT k.c, b.n AS place, b.role, b.t FROM convs k JOIN turns b ON b.c = k.base AND b.n <= k.h UNION ALL
  SELECT o.c, o.n - k.h + least(k.h, coalesce(l.own, 0)), o.role, o.t
  FROM turns o JOIN convs k ON k.c = o.c LEFT JOIN lens l ON l.c = k.base WHERE o.n > k.h),
paths AS (
  SELECT c, place AS depth, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words,
         string_agg(md5(strlen(role) || ':' || role || t), '') OVER (PARTITION BY c ORDER BY place) AS path FROM rebuilt UNION ALL
  SELECT c, 0, 0, '' FROM ids),
nodes AS (SELECT path, max(depth) AS depth, min(c) AS conv, count(*) AS n_convs, max(words) AS words FROM paths GROUP BY path),
kids AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
below AS (SELECT DISTINCT a.path, d.path AS under FROM paths a JOIN paths d ON a.c = d.c AND d.depth >= a.depth),
subs AS (SELECT below.path, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
         FROM below JOIN full_nodes n ON n.path = below.under GROUP BY below.path),
finals AS (SELECT c, max(depth) AS depth FROM paths GROUP BY c),
ended AS (SELECT p.path, sha256(string_agg(p.c::VARCHAR, ',' ORDER BY p.c)) AS sha FROM paths p JOIN finals USING (c, depth) GROUP BY p.path)
SELECT n.conv AS conv_id, n.depth::BIGINT AS depth, u.conv AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM full_nodes n JOIN subs s USING (path) LEFT JOIN ended e USING (path)
LEFT JOIN nodes u ON n.depth > 0 AND u.path = left(n.path, length(n.path) - 32)"""


def _either_case(pattern: str) -> str:
    """ASCII letters of the keyword group in either case, spelt out."""
    words, rest = pattern.split(")", 1)
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words) + ")" + rest


def _op7() -> str:
    parts = []
    for i, k in enumerate(KINDS):
        p = (_either_case(ASSIGN) if k.name == "assign" else k.pattern).replace("'", "''")
        parts.append(f"""
SELECT r, owner, repo, {i} AS k, '{k.name}' AS kind, m.n, length(m.f) AS len, m.v AS v,
       (list_sum(list_transform(pieces[1:m.n], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:m.n - 1], lambda x: length(x))), 0))::BIGINT AS start
FROM (SELECT r, owner, repo, f, pieces, unnest(list_transform(range(1, len(f) + 1), lambda j: {{'n': j, 'f': f[j], 'v': v[j]}})) AS m
      FROM (SELECT r, owner, repo, regexp_extract_all(t, '{p}', 0) AS f, regexp_extract_all(t, '{p}', {k.group}) AS v,
                   string_split_regex(t, '{p}') AS pieces FROM d WHERE regexp_matches(t, '{p}')))
WHERE length(m.v) >= {k.least}""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
                  coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM documents),
s AS ({' UNION ALL '.join(parts)}),
held AS (SELECT v, count(DISTINCT owner) AS owners FROM s GROUP BY v),
l AS (SELECT s.*, length(v) >= 12 AND regexp_matches(v, '[0-9]') AND len(list_distinct(string_split(v, ''))) >= 8
             AND owners < {COPIED_OWNERS} AS live FROM s JOIN held USING (v)),
shown AS (SELECT r, k, kind, start, start + len AS stop FROM l
          UNION SELECT r, {len(KINDS)}, 'live', start + len - length(v), start + len FROM l WHERE live),
a AS (SELECT r, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < 3) AS base FROM shown GROUP BY r),
c AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied FROM l GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r) LEFT JOIN c USING (r)"""


OP9 = rf"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       coalesce(doc_id = min(doc_id) OVER (PARTITION BY t), min(doc_id) OVER (PARTITION BY t) IS NULL) AS kept,
       sha256(t) AS text_sha256
FROM n"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1(rules, sites) -> str:
    """``rules``: the prefix rules; ``sites``: those whose pages are listed."""
    ranked = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))
    rule = " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'" for r in ranked)
    verdict = " ".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in ranked)
    return rf"""
WITH a AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM a),
k AS (SELECT page_id, host, path, CASE WHEN host = '' THEN '' ELSE
        regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') || CASE WHEN q = '' THEN '' ELSE '?' || q END END AS key
      FROM (SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'),
              lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS q FROM b)),
l AS (SELECT DISTINCT key FROM k WHERE regexp_matches(host, '(^|\.)({'|'.join(sites)})\.') AND key <> ''),
r AS (SELECT page_id, host, path, CASE {rule} END AS rule, l.key IS NOT NULL AS listed FROM k LEFT JOIN l USING (key))
SELECT page_id, host, path, rule, CASE {verdict} WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed FROM r"""


OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS k,
                  regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
g AS (SELECT r, k, i, array_to_string(w[i:i + 12], ' ') AS g
      FROM (SELECT r, k, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(k) AS first FROM g GROUP BY g),
p AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM g JOIN f USING (g) WHERE first < k),
gone AS (SELECT r, count(*) AS n FROM p GROUP BY r),
left_ AS (SELECT r, string_agg(v.x, ' ' ORDER BY v.p) AS t
          FROM (SELECT r, unnest(list_transform(range(1, len(w) + 1), lambda j: {{'p': j, 'x': w[j]}})) AS v FROM d) AS u
          ANTI JOIN p ON p.r = u.r AND p.p = u.v.p GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone.n, 0) AS n_removed, sha256(coalesce(left_.t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN left_ USING (r)"""

SQL: dict[str, str] = {"op2_quality_rules": OP2, "op6_substring_dedup": OP6, "op7_secret_scan": _op7(), "op9_exact_dedup": OP9,
                       "op11_warc": OP11, "op13_prefix_trie": OP13}
