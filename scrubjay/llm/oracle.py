"""DuckDB SQL for the queries that SQL can express. Each states the result by definition, not by the operator's method."""

from __future__ import annotations

def classes_sql(size: int, link: int, columns: str) -> str:
    """Documents as sets of distinct shingles, all links between distinct sets, then classes by reachability."""
    return rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' ')))) END AS s
  FROM words),
reps AS MATERIALIZED (SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS MATERIALIZED (SELECT rep, n, unnest(s) AS item FROM reps),
pairs AS MATERIALIZED (
  SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.item = b.item AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= {link} * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT a AS u, b AS v FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(id, low) AS (
  SELECT rep, rep FROM reps
  UNION SELECT e.v, r.low FROM reach r JOIN edges e ON e.u = r.id WHERE r.low < e.v),
classes AS (SELECT id, min(low) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id{columns}
FROM sets d LEFT JOIN reps r ON r.s = d.s LEFT JOIN classes c ON c.id = r.rep
"""


NEAR_DEDUP_SQL = classes_sql(5, 75, ", d.doc_id = coalesce(c.component_id, d.doc_id) AS kept")
JACCARD_SQL = classes_sql(3, 90, "")

#: Base32 of a digest: four letters for each five hexadecimal digits (20 bits).
WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, strlen(body) AS size, hex, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
          (CAST('0x' || substr(hex, 1 + 5 * CAST(floor(i / 4) AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) % 32
          AS INTEGER), 1)), '') AS base32 FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM d)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, base32 AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM m
"""

CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(role, '([<\[])(\^*)(\||/?s>|/?INST\])', '\1^\2\3', 'g') AS role_out,
             regexp_replace(text, '([<\[])(\^*)(\||/?s>|/?INST\])', '\1^\2\3', 'g') AS text_out FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text_out)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text_out) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length(role_out) + length(text_out) + 23) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

#: The given pages hold their main text in one article element, whose tags all stand between words.
HTML_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1),
                                               '<[^>]*>', ' ', 'g') AS raw FROM pages),
d AS (SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'),
        '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""

def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII text expression: eight shifts for each character."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1), lambda i:
    ascii(substr({text}, i, 1))::BIGINT)), lambda c, x: list_reduce(list_prepend(xor(c, x), [0,0,0,0,0,0,0,0]::BIGINT[]),
    lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT)"""


def merkle_sql(height: int = 8, crown: int = 4) -> str:
    """The manifest by definition: ``height`` levels of runs of eight for each language, ``crown`` over the subroots.

    A group of one node passes through a level unchanged, so more levels than needed do no harm.
    """
    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def level(k: str, up: str) -> list[str]:
        run = "PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN"
        return [f"""s{k} AS MATERIALIZED (SELECT g, pos, n, digest,
  coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
  coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM l{k})""",
                f"""l{up} AS MATERIALIZED (SELECT g, pos // 8 AS pos, (n + 7) // 8 AS n,
  CASE WHEN n = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM l{k} GROUP BY g, pos // 8, n)"""]

    def climb(k: str, up: str, which: str) -> str:
        return f"""f{up} AS MATERIALIZED (SELECT f.* REPLACE (
  CASE WHEN s.n = 1 THEN f.folded ELSE sha256(s.lft || f.folded || s.rgt) END AS folded,
  CASE WHEN s.n = 1 THEN f.proof ELSE f.proof || s.lft || s.rgt END AS proof, f.{which} // 8 AS {which})
  FROM f{k} f JOIN s{k} s ON s.g IS NOT DISTINCT FROM {'f.lang' if which == 'pos' else '0'} AND s.pos = f.{which})"""

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    offered = (f"CASE WHEN crc % 3 = 0 THEN translate(text, '{upper}', '{upper.lower()}') ELSE text END")
    parts = [f"""crc AS (SELECT doc_id, {crc32_sql('CAST(doc_id AS VARCHAR)')} AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
rows AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf(f'({offered})')} AS offered
  FROM documents LEFT JOIN crc USING (doc_id))""",
             """l0 AS MATERIALIZED (SELECT *, lang AS g, leaf AS digest,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM rows)"""]
    for k in range(height):
        parts += level(str(k), str(k + 1))
    parts.append(f"""lc0 AS MATERIALIZED (SELECT 0 AS g, g AS lang, digest, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos,
  count(*) OVER () AS n FROM l{height})""")
    for k in range(crown):
        parts += level(f"c{k}", f"c{k + 1}")
    parts.append("f0 AS (SELECT doc_id, lang, leaf, pos, offered AS folded, '' AS proof FROM l0)")
    parts += [climb(str(k), str(k + 1), "pos") for k in range(height)]
    parts.append(f"""fc0 AS (SELECT f.*, c.pos AS place, c.digest AS subroot FROM f{height} f
  JOIN lc0 c ON c.lang IS NOT DISTINCT FROM f.lang)""")
    parts += [climb(f"c{k}", f"c{k + 1}", "place") for k in range(crown)]
    return "WITH " + ",\n".join(parts) + f"""
SELECT f.doc_id, f.leaf, f.subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root,
       f.folded = r.digest AS verified FROM fc{crown} f, lc{crown} r"""


#: The cheapest edits by dynamic programming over the rows; then the repaired turns, whose roles follow from their places.
REPAIR_SQL = rf"""
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id FROM conversations),
base AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS MATERIALIZED (SELECT *, {crc32_sql('k')} % 20 AS f FROM base),
after AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
  CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE f <> 0),
r AS MATERIALIZED (SELECT *, left(role, 1) AS ini,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
  NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS empty,
  NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut FROM after),
faults AS MATERIALIZED (SELECT *, empty OR seen AS must, CASE WHEN cut AND NOT empty AND NOT seen THEN 3 ELSE 0 END AS fine,
  coalesce(lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini, 'ua') AS pair FROM r),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (empty) AS blank, count(*) FILTER (seen AND NOT empty) AS duplicate, count(*) FILTER (fine = 3) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
ins(st, pre, c, mid) AS (VALUES ('0', '', 0, '0'), ('0', 'I', 3, 'u'), ('0', 'II', 6, 'b'), ('s', '', 0, 's'),
  ('s', 'I', 3, 'u'), ('s', 'II', 6, 'b'), ('u', '', 0, 'u'), ('u', 'I', 3, 'b'), ('u', 'II', 6, 'u'),
  ('b', '', 0, 'b'), ('b', 'I', 3, 'u'), ('b', 'II', 6, 'b')),
act(mid, ini, edit, c, nxt) AS (VALUES ('0', NULL, 'D', 4, '0'), ('s', NULL, 'D', 4, 's'), ('u', NULL, 'D', 4, 'u'),
  ('b', NULL, 'D', 4, 'b'), ('0', 's', 'K', 0, 's'), ('0', 'u', 'K', 0, 'u'), ('s', 'u', 'K', 0, 'u'),
  ('u', 'a', 'K', 0, 'b'), ('b', 'u', 'K', 0, 'u'), ('0', NULL, 'R', 3, 'u'), ('s', NULL, 'R', 3, 'u'),
  ('u', NULL, 'R', 3, 'b'), ('b', NULL, 'R', 3, 'u')),
walk(conv_id, i, st, best) AS (
  SELECT conv_id, 0::BIGINT, '0', struct_pack(cost := 0::BIGINT, audit := '') FROM ids
  UNION ALL
  SELECT w.conv_id, f.i, act.nxt, min(struct_pack(
    cost := w.best.cost + ins.c + act.c + CASE WHEN act.edit = 'D' THEN 0 ELSE f.fine END,
    audit := w.best.audit || ins.pre || act.edit))
  FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN ins ON ins.st = w.st
  JOIN act ON act.mid = ins.mid AND (act.ini IS NULL OR act.ini = f.ini) AND (act.edit = 'D' OR NOT f.must)
  GROUP BY w.conv_id, f.i, act.nxt),
tail(st, pre, c) AS (VALUES ('0', '', 0), ('s', 'II', 6), ('u', 'I', 3), ('b', '', 0)),
best AS MATERIALIZED (SELECT ids.conv_id, min(struct_pack(cost := w.best.cost + tail.c, audit := w.best.audit || tail.pre))
  AS b FROM ids LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
  JOIN walk w ON w.conv_id IS NOT DISTINCT FROM ids.conv_id AND w.i = coalesce(c.n, 0) JOIN tail ON tail.st = w.st
  GROUP BY ids.conv_id),
edits AS (SELECT conv_id, unnest(range(1, length(b.audit) + 1)) AS p, b.audit AS audit FROM best),
done AS (SELECT conv_id, p, substr(audit, p, 1) AS edit, length(replace(substr(audit, 1, p), 'I', '')) AS i FROM edits),
kept AS (SELECT d.conv_id, d.p, d.edit, f.role, f.text, f.ini,
  row_number() OVER (PARTITION BY d.conv_id ORDER BY d.p) AS e FROM done d
  LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i AND d.edit <> 'I' WHERE d.edit <> 'D'),
named AS (SELECT *, e - max(CASE WHEN e = 1 AND edit = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)
  AS place FROM kept),
lines AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role ELSE CASE WHEN place % 2 = 1 THEN 'user' ELSE
  'assistant' END END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS whole FROM named GROUP BY conv_id)
SELECT b.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, b.b.cost AS cost, b.b.audit AS audit,
  sha256(coalesce(l.whole, '')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM b.conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op3_warc": WARC_SQL,
    "op7_chat_format": CHAT_SQL,
    "op8_html_main_text": HTML_SQL,
    "op10_minhash_near_dedup": NEAR_DEDUP_SQL,
    "op11_ngram_jaccard_join": JACCARD_SQL,
    "op12_conversation_repair": REPAIR_SQL,
    "op13_merkle_manifest": merkle_sql(),
}
