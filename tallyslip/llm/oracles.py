"""DuckDB SQL with the same rows, where SQL can express them."""

#: States of the role pattern (0 nothing yet, 1 after system, 2 after user, 3 after assistant): the next one, and its role.
_NEXT, _ROLE = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}


def _edge(cost: int | str, letter: str, then: str, line: str | None = None) -> str:
    turns = f"{then}.t" if line is None else f"list_prepend({line}, {then}.t)"
    return f"{{c: {then}.c + {cost}, a: '{letter}' || {then}.a, t: {turns}}}"


def _least(ways: list[str]) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]"


def _row_edge(q: int) -> str:
    then, role = f"w{_NEXT[q]}", _ROLE[_NEXT[q]]
    keep = f"CASE WHEN stays AND ini = '{role[0]}' THEN {_edge('more', 'K', then, 'own')} END"
    turn = f"CASE WHEN stays THEN {_edge('3 + more', 'R', then, f"'{role}:' || text")} END"
    first = [f"CASE WHEN stays AND ini = 's' THEN {_edge('more', 'K', 'w1', 'own')} END"] if q == 0 else []
    return _least([_edge(4, "D", f"w{q}"), turn, keep, *first])


def _with_insert(q: int, before: str) -> str:
    return _least([f"e{q}", _edge(3, "I", f"{before}{_NEXT[q]}", f"'{_ROLE[_NEXT[q]]}:'")])


#: Row by row from the end: per state the cheapest (cost, letters) and its turns, compared as they are. crc32 is made from its polynomial.
_REPAIR = f"""WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
src AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS k, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
crc AS (SELECT src.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(name, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), lambda acc, b: xor(acc // 256, t[CAST(xor(acc, b) % 256 AS INT) + 1])), 4294967295) % 20 AS f FROM src, tab),
hurt AS (SELECT k, conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy FROM crc WHERE f <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS p, row_number() OVER (PARTITION BY k, role, text ORDER BY turn NULLS FIRST, copy) AS again, regexp_replace(text, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS bare FROM hurt),
fault AS (SELECT *, bare = '' AS blank, bare <> '' AND again > 1 AS dup, bare <> '' AND again = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY k ORDER BY p) AS ini0 FROM placed),
rows_ AS (SELECT k, p, role || ':' || text AS own, text, ini, NOT (blank OR dup) AS stays, CASE WHEN cut THEN 3 ELSE 0 END AS more FROM fault),
counts AS (SELECT k, max(p) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE dup) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
  count(*) FILTER (WHERE ini0 IS NOT NULL AND ini0 || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM fault GROUP BY k),
dp AS (SELECT k, n + 1 AS p, {{c: 0, a: '', t: CAST([] AS VARCHAR[])}} AS w0, {{c: 6, a: 'II', t: ['user:', 'assistant:']}} AS w1, {{c: 3, a: 'I', t: ['assistant:']}} AS w2, {{c: 0, a: '', t: CAST([] AS VARCHAR[])}} AS w3 FROM counts
  UNION ALL SELECT k, p, {', '.join(f"{_with_insert(q, 'i')} AS w{q}" for q in range(4))} FROM (SELECT *, {', '.join(f"{_with_insert(q, 'e')} AS i{q}" for q in range(4))}
    FROM (SELECT r.k, r.p, {', '.join(f"{_row_edge(q)} AS e{q}" for q in range(4))} FROM dp JOIN rows_ r ON r.k = dp.k AND r.p = dp.p - 1)))
SELECT s.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(w0.c, 0) AS BIGINT) AS cost, coalesce(w0.a, '') AS audit, sha256(coalesce(array_to_string(w0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT k, conv_id FROM src) s LEFT JOIN counts ON counts.k = s.k LEFT JOIN dp ON dp.k = s.k AND dp.p = 1"""

ORACLES = {
    "op10_url_filter": r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
""",
    "op13_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
r AS (SELECT k.doc_id, k.line, k.pos, s.key IS NOT NULL AND k.doc_id != s.top AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM r GROUP BY doc_id
""",
    "op12_conversation_repair": _REPAIR,
}
