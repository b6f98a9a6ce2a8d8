"""SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

OP9 = """
WITH v AS (
  SELECT vec_id, embedding, row_number() OVER () AS n FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
a AS (SELECT vec_id, n, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM v),
c AS (
  SELECT * FROM a
  WHERE n NOT IN (SELECT n FROM a WHERE x IS NULL OR NOT isfinite(x))),
w AS (SELECT vec_id, n, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS w FROM c),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, d.n, CAST(sum(q.w * d.w) AS BIGINT) AS score
  FROM w q JOIN w d ON q.i = d.i AND q.vec_id <> d.vec_id
  WHERE q.vec_id % 50 = 0
  GROUP BY ALL),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
         vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_TERMS = r"""regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP12 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS terms FROM documents),
i AS (SELECT item_id, row_number() OVER () AS i, list_distinct({_TERMS}) AS terms FROM benchmark),
n AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
s AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total FROM n),
q AS (SELECT i, item_id, unnest(terms) AS term FROM i),
t AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term,
         CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM t, s GROUP BY term),
c AS (
  SELECT t.r, t.term,
         w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // total))) AS c
  FROM t JOIN w USING (term) JOIN n USING (r), s),
p AS (
  SELECT i, item_id, r, CAST(sum(c) AS BIGINT) AS score FROM q JOIN c USING (term) GROUP BY ALL),
k AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM p JOIN n USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""


#: The places of the pattern ``(s?(ua)+)?`` before a row, as in a left-to-right search: cost, audit
#: and text so far of the best edits that lead to each; null where none do.
_PLACES = range(4)


def _on(place: str, cost: str, letter: str, turn: str | None = None, only: str = "true") -> str:
    """The best edits up to ``place`` with one more edit."""
    text = f"{place}.t" if turn is None else f"{place}.t || chr(10) || {turn}"
    return (
        f"CASE WHEN {place} IS NOT NULL AND {only} THEN "
        f"{{'c': {place}.c + {cost}, 'a': {place}.a || '{letter}', 't': {text}}} END"
    )


def _put(place: str, role: str) -> str:
    return _on(place, "2", "I", f"'{role}:'")


def _row(place: int) -> str:
    """The best edits that lead to a place, with one more row."""
    stay, keep, other = "fault IN (0, 3)", "role || ':' || text", "CAST(fault = 3 AS BIGINT)"
    ways = [_on(f"e{place}", "3", "D")]
    for before, initial, after in ((0, "s", 1), (0, "u", 2), (1, "u", 2), (3, "u", 2), (2, "a", 3)):
        if after == place:
            only = f"{stay} AND initial = '{initial}'"
            ways.append(_on(f"e{before}", other, "K", keep, only))
            if initial != "s":
                role = {"u": "user", "a": "assistant"}[initial]
                ways.append(_on(f"e{before}", f"2 + {other}", "R", f"'{role}:' || text", stay))
    return f"list_min([{', '.join(ways)}]) AS s{place}"


OP13 = f"""
WITH RECURSIVE bits(b, k, v) AS (
  SELECT range, 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL
  SELECT b, k + 1, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END::BIGINT)
  FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS tab FROM bits WHERE k = 8),
o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(
             string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
             lambda x: ord(x)::BIGINT)),
           lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 20 AS kind
  FROM conversations, crc),
g AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
d AS (
  SELECT g, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                   ELSE text END AS text
  FROM o JOIN g ON o.conv_id IS NOT DISTINCT FROM g.conv_id,
       unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS u(copy)
  WHERE kind <> 0),
n AS (
  SELECT g, turn, role, text, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body
  FROM d),
r AS (
  SELECT g, i, turn, role, text, initial, lag(initial) OVER (PARTITION BY g ORDER BY i) AS before,
         CASE WHEN body = '' THEN 1
              WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 2
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM n),
p AS (
  SELECT g, 0 AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0,
         CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s1,
         CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s2,
         CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s3
  FROM g
  UNION ALL
  SELECT g, i, {", ".join(_row(place) for place in _PLACES)}
  FROM (
    SELECT *, list_min([s3, {_put("e2", "assistant")}]) AS e3
    FROM (
      SELECT p.g, r.i, role, text, initial, fault, s0 AS e0, s1 AS e1, s2, s3,
             list_min([s2, {_put("s0", "user")}, {_put("s1", "user")}, {_put("s3", "user")}]) AS e2
      FROM p JOIN r ON p.g = r.g AND r.i = p.i + 1))),
z AS (
  SELECT g, list_min([s0, s3, {_put("s2", "assistant")},
         {_put("x1", "assistant")}]) AS best
  FROM (SELECT *, {_put("s1", "user")} AS x1 FROM p) AS y
  WHERE i = coalesce((SELECT max(r.i) FROM r WHERE r.g = y.g), 0)),
t AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY g)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(substr(best.t, 2)) AS repaired_sha256
FROM g JOIN z USING (g) LEFT JOIN t USING (g)
"""


def oracle_sql() -> dict[str, str]:
    """For some of the queries, SQL for DuckDB over the same tables."""
    return {"op9_maxscore": OP9, "op12_lexical": OP12, "op13_dialogue": OP13}
