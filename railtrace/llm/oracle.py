"""DuckDB twins of the operator queries that SQL can express.

Constants are stated here again rather than imported, so that a wrong one in
the operators shows.
"""

from __future__ import annotations

OP7 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
)
SELECT page_id, host, path,
  CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
  CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'allow'
       WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'block'
       WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'allow'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'block'
       ELSE 'allow' END AS verdict
FROM p
"""

OP9 = r"""
WITH d AS (SELECT doc_id, text, source, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM l),
c AS (SELECT source, key, count(DISTINCT doc_id) AS n FROM k WHERE key <> '' GROUP BY ALL),
t AS (SELECT source, count(DISTINCT doc_id) + count(*) FILTER (doc_id IS NULL) AS pages FROM documents GROUP BY ALL),
hot AS (SELECT c.source, key FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source WHERE n >= 3 AND n > 0.05 * pages),
kept AS (
  SELECT k.doc_id, count(*) FILTER (hot.key IS NOT NULL) AS n_dropped,
         string_agg(line, chr(10) ORDER BY pos) FILTER (hot.key IS NULL) AS text
  FROM k LEFT JOIN hot ON k.source IS NOT DISTINCT FROM hot.source AND k.key = hot.key GROUP BY ALL
)
SELECT d.doc_id, d.source, CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(d.lines) END AS BIGINT) AS n_lines,
       CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM d LEFT JOIN kept USING (doc_id)
"""

_KINDS = [
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+", 0, 0),
    ("hub", r"gh[opsu]_[A-Za-z0-9]{36,}", 0, 0),
]


def _op10() -> str:
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(_KINDS):
        parts.append(f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, s, e FROM (
    SELECT doc_id, len(part) AS n, len(whole) AS w,
           sum(len(gap) + len(whole)) OVER (PARTITION BY doc_id ORDER BY i) AS e,
           e - len(whole) AS s
    FROM (SELECT doc_id, unnest(gaps[1:len(ms)]) AS gap, unnest(ms) AS whole, unnest(ps) AS part, generate_subscripts(ms, 1) AS i
          FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS ms,
                       regexp_extract_all(t, '{pattern}', {group}) AS ps FROM d)))
  WHERE n >= {least}""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({' UNION ALL '.join(parts)}),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, rank) FILTER (kind IN ('assign', 'access', 'hex')) AS base,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, rank) AS spans
  FROM f GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


OP3 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
overlap AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM overlap JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.n + nb.n - i)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON reach.r = edge.a
)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id,
       CAST(coalesce(any_value(e.n), 0) AS BIGINT) AS n_links
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM edge GROUP BY a) e USING (doc_id)
GROUP BY d.doc_id
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n >= 2),
repw AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
l AS (
  SELECT doc_id, source, line, own, array_to_string(own, ' ') AS joined FROM (
    SELECT doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS own
    FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM d)) WHERE len(own) > 0
), dup AS (SELECT doc_id, sum(n - 1) AS n FROM (SELECT doc_id, line, count(*) AS n FROM l GROUP BY ALL) GROUP BY doc_id),
k AS (SELECT doc_id, source, len(own) AS n, translate(joined, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hosts AS (SELECT source, count(DISTINCT doc_id) AS n FROM documents GROUP BY ALL),
hot AS (
  SELECT c.source, key FROM (SELECT source, key, count(DISTINCT doc_id) AS n FROM k GROUP BY ALL) c
  JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source WHERE c.n >= 4 AND 1000 * c.n > 5 * h.n
),
gone AS (SELECT doc_id, sum(n) AS n FROM k JOIN hot ON k.source IS NOT DISTINCT FROM hot.source AND k.key = hot.key GROUP BY doc_id),
s AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repw.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN repw USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * n_removed_words <= n_words AS kept
FROM s
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)
), g AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hit AS (SELECT doc_id, i, g.n, item FROM g JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce([xor(c, b)] || [0::BIGINT for i in range(8)], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"[CAST(unicode(c) AS BIGINT) for c in string_split({text}, '')]"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {bits}), 4294967295)"


def _leaf(n_chars: str) -> str:
    texts = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


# Phase 0 climbs each language's leaves, phase 1 the subroots.
OP11 = f"""
WITH RECURSIVE f AS (
  SELECT doc_id, coalesce(strlen(lang) || ':' || lang, '-') AS g, lang, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} END AS claimed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot, count(*) OVER (PARTITION BY g) AS n FROM f
), low(level, g, slot, n, h) AS (
  SELECT 0::BIGINT, g, slot, n, leaf FROM placed
  UNION ALL
  SELECT level + 1, g, slot // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY slot)) FROM low WHERE n > 1
  GROUP BY level, g, slot // 2, n
), subs AS (
  SELECT g, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS slot, count(*) OVER () AS n
  FROM low JOIN (SELECT DISTINCT g, lang FROM f) USING (g) WHERE low.n = 1
), high(level, slot, n, h) AS (
  SELECT 0::BIGINT, slot, n, h FROM subs
  UNION ALL
  SELECT level + 1, slot // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY slot)) FROM high WHERE n > 1 GROUP BY level, slot // 2, n
), steps AS (
  SELECT p.doc_id, p.leaf, 0 AS phase, a.level, (p.slot >> a.level) % 2 = 1 AS at_right, b.h AS other
  FROM placed p JOIN low a ON a.g = p.g AND a.slot = p.slot >> a.level AND a.n > 1
  LEFT JOIN low b ON b.g = a.g AND b.level = a.level AND b.slot = xor(a.slot, 1::BIGINT)
  UNION ALL
  SELECT p.doc_id, p.leaf, 1, a.level, (s.slot >> a.level) % 2 = 1, b.h
  FROM placed p JOIN subs s USING (g) JOIN high a ON a.slot = s.slot >> a.level AND a.n > 1
  LEFT JOIN high b ON b.level = a.level AND b.slot = xor(a.slot, 1::BIGINT)
), paths AS (
  SELECT doc_id, leaf, sha256(string_agg(coalesce(other, ''), '' ORDER BY phase, level)) AS proof,
         list({{'r': at_right, 'h': coalesce(other, '')}} ORDER BY phase, level) AS path
  FROM steps GROUP BY doc_id, leaf
), folded(doc_id, leaf, k, path, h) AS (
  SELECT p.doc_id, p.leaf, 1, coalesce(path, []), coalesce(claimed, p.leaf)
  FROM placed p LEFT JOIN paths q ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.leaf = p.leaf
  UNION ALL
  SELECT doc_id, leaf, k + 1, path, sha256(CASE WHEN path[k].r THEN path[k].h || h ELSE h || path[k].h END) FROM folded WHERE k <= len(path)
)
SELECT p.doc_id, p.leaf, subs.h AS subroot, root.h AS root, coalesce(proof, sha256('')) AS proof_sha256, o.h AS folded_root, o.h = root.h AS verified
FROM placed p JOIN subs USING (g) LEFT JOIN paths q ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.leaf = p.leaf
JOIN folded o ON o.doc_id IS NOT DISTINCT FROM p.doc_id AND o.leaf = p.leaf AND o.k = len(o.path) + 1, (SELECT h FROM high WHERE n = 1) root
"""


# Ways from state to state (0 nothing, 1 system, 2 user, 3 assistant) over inserted rows ('I') and one
# row: its kind (k: kept by its initial, r: given a role, d: deleted), edits, cost and what is put before it.
_WAYS = """
  SELECT f, t, kind, repeat('I', n) || upper(kind) AS e, 2 * n + CASE kind WHEN 'r' THEN 2 WHEN 'd' THEN 3 ELSE 0 END AS c, put,
         CASE WHEN kind = 'd' THEN NULL WHEN t = 1 THEN 's' WHEN t = 2 THEN 'u' ELSE 'a' END AS initial
  FROM (SELECT p.f, p.n, p.put, x.t, x.kind FROM (
    VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 1, 'u'), (1, 2, 1, 'u'), (3, 2, 1, 'u'), (2, 3, 1, 'a'),
           (0, 3, 2, 'ua'), (1, 3, 2, 'ua'), (2, 2, 2, 'au'), (3, 3, 2, 'ua')
  ) p(f, m, n, put) JOIN (
    VALUES (0, 0, 'd'), (1, 1, 'd'), (2, 2, 'd'), (3, 3, 'd'), (0, 1, 'k'), (0, 2, 'k'), (1, 2, 'k'), (3, 2, 'k'), (2, 3, 'k'),
           (0, 2, 'r'), (1, 2, 'r'), (3, 2, 'r'), (2, 3, 'r')
  ) x(f, t, kind) ON x.f = p.m)
"""

OP12 = rf"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) FROM o WHERE kind <> 0)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged
), r AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^ 	-
]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
), faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
         count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
         count(*) FILTER (i > 1 AND (before || initial) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY conv_id
), ways AS ({_WAYS}), dp(conv_id, i, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {{'c': 0::BIGINT, 'e': '', 'text': ''}} FROM faults
  UNION ALL
  SELECT conv_id, i, state, min(best) FROM (
    SELECT dp.conv_id, r.i, w.t AS state, {{
      'c': best.c + w.c + CASE WHEN kind <> 'd' AND cut THEN 1 ELSE 0 END, 'e': best.e || w.e,
      'text': best.text || replace(replace(w.put, 'u', chr(10) || 'user:'), 'a', chr(10) || 'assistant:')
        || CASE kind WHEN 'd' THEN '' ELSE chr(10) || CASE WHEN kind = 'k' THEN role WHEN w.t = 2 THEN 'user' ELSE 'assistant' END || ':' || text END
    }} AS best
    FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1
    JOIN ways w ON w.f = dp.state AND (kind = 'd' OR NOT (blank OR again) AND (kind = 'r' OR w.initial = r.initial))
  ) GROUP BY conv_id, i, state
), done AS (
  SELECT conv_id, min({{'c': best.c + 2 * length(put), 'e': best.e || repeat('I', length(put)),
                       'text': best.text || replace(replace(put, 'u', chr(10) || 'user:'), 'a', chr(10) || 'assistant:')}}) AS best
  FROM dp JOIN faults USING (conv_id) JOIN (VALUES (0, ''), (3, ''), (2, 'a'), (0, 'ua'), (1, 'ua')) e(state, put) USING (state)
  WHERE dp.i = faults.n GROUP BY conv_id
)
SELECT x.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.e, '') AS audit, sha256(coalesce(substr(best.text, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN faults USING (conv_id) LEFT JOIN done USING (conv_id)
"""


ORACLE_SQL = {
    "op3_ngram_join": OP3,
    "op4_line_frequency": OP4,
    "op8_fm_decontamination": OP8,
    "op7_url_filter": OP7,
    "op9_line_dedup": OP9,
    "op10_secret_ledger": _op10(),
    "op11_merkle_manifest": OP11,
    "op12_conversation_repair": OP12,
}
