"""DuckDB texts of operators 11 and 13."""

from __future__ import annotations

# The usual reflected polynomial, a byte and a bit at a time.
_BIT = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END"
_BYTE = f"list_reduce(list_prepend(xor(c, b), range(8)::BIGINT[]), lambda x, i: {_BIT})"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text of ASCII characters."""
    codes = f"[ascii(z)::BIGINT FOR z IN string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {_BYTE}), 4294967295::BIGINT)"


OP11_SQL = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {crc32("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)
), built AS (
  SELECT c.conv_id, 0 AS part, i, r, t FROM convs c JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100 AND b.i <= c.h
  UNION ALL SELECT c.conv_id, 1, i, r, t FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h
), prefixes AS (
  SELECT conv_id, count(*) OVER so_far AS depth, list(r || chr(10) || t) OVER so_far AS seq, length(t) AS chars
  FROM built WINDOW so_far AS (PARTITION BY conv_id ORDER BY part, i)
  UNION ALL SELECT conv_id, 0, [], 0 FROM convs
), members AS (
  SELECT *, max(depth) OVER (PARTITION BY conv_id) AS whole FROM prefixes
), nodes AS (
  SELECT depth, seq, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = whole), '')) AS ends_sha256
  FROM members GROUP BY depth, seq
), above AS (
  SELECT a AS depth, seq[1:a] AS seq, depth - a AS below, n_convs, chars,
    NOT EXISTS (SELECT 1 FROM nodes k WHERE k.depth = u.depth + 1 AND k.seq[1:u.depth] = u.seq) AS leaf
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM nodes) u
), sums AS (
  SELECT depth, seq, count(*) FILTER (below = 1) AS n_children, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens
  FROM above GROUP BY depth, seq
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.depth = n.depth AND s.seq = n.seq LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.seq = n.seq[1:n.depth - 1]
"""


def _best(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _way(state: str, price: str, letter: str) -> str:
    """A path that goes on from a state, as (cost, letters)."""
    return f"{{'c': {state}.c + {price}, 'a': {state}.a || '{letter}'}}"


def _inserted(row: str) -> list[str]:
    """The four states after insertions: an empty turn of the user behind any state but the user's, of the assistant behind the user's."""
    user = _best(f"{row}.u", *[_way(f"{row}.{s}", "5", "I") for s in "esa"])
    assistant = _best(f"{row}.a", _way(f"{row}.u", "5", "I"), *[f"{{'c': {row}.{s}.c + 10, 'a': {row}.{s}.a || 'II'}}" for s in "es"])
    return [f"{row}.e AS e", f"{row}.s AS s", f"{user} AS u", f"{assistant} AS a"]


def _after_row() -> list[str]:
    """The four states behind a row with `initial`, `fault`: deleted, kept or with another role."""
    more = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
    out = []
    for state, before in (("e", ""), ("s", "e"), ("u", "esa"), ("a", "u")):
        ways = [_way(f"x.{state}", "2", "D")]
        for b in before:
            kept = f"CASE WHEN initial = '{state}' AND fault IN ('', 'truncated') THEN {more} ELSE 1000000 END"
            ways.append(_way(f"x.{b}", kept, "K"))
            if state != "s":
                ways.append(_way(f"x.{b}", f"CASE WHEN fault IN ('', 'truncated') THEN 1 + {more} ELSE 1000000 END", "R"))
        out.append(f"{_best(*ways)} AS {state}")
    return out


_FAR = "{'c': 1000000::BIGINT, 'a': ''}"

OP13_SQL = f"""
WITH RECURSIVE drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE k WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) FROM drawn)
), placed AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed
), convs AS (
  SELECT DISTINCT conv_id FROM conversations
), facts AS (
  SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(i) AS n
  FROM convs c LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id
), paths AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS e, {_FAR} AS s, {_FAR} AS u, {_FAR} AS a FROM convs
  UNION ALL
  SELECT x.conv_id, j.i, {', '.join(_after_row())}
  FROM (SELECT paths.conv_id, paths.i, {', '.join(_inserted("paths"))} FROM paths) x
  JOIN judged j ON j.conv_id IS NOT DISTINCT FROM x.conv_id AND j.i = x.i + 1
), ends AS (
  SELECT x.conv_id, x.i, {', '.join(_inserted("x"))} FROM paths x
), best AS (
  SELECT f.*, list_min([ends.e, ends.a]) AS b FROM facts f JOIN ends ON ends.conv_id IS NOT DISTINCT FROM f.conv_id AND ends.i = f.n
), letters AS (
  SELECT conv_id, p, b.a[p:p] AS letter, length(regexp_replace(b.a[1:p], 'I', '', 'g')) AS i,
    length(regexp_replace(b.a[1:p], 'D', '', 'g')) AS place
  FROM (SELECT *, unnest(range(1, length(b.a) + 1)) AS p FROM best)
), turns AS (
  SELECT l.conv_id, l.place, l.letter, j.role, j.initial, CASE WHEN letter = 'I' THEN '' ELSE j.text END AS text,
    max(CASE WHEN l.place = 1 AND letter = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS system
  FROM letters l LEFT JOIN judged j ON letter <> 'I' AND j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.i = l.i
  WHERE letter <> 'D'
), said AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY place) AS s
  FROM turns GROUP BY conv_id
)
SELECT best.conv_id, gaps, blank, duplicate, truncated, illegal, b.c AS cost, b.a AS audit, sha256(coalesce(s, '')) AS repaired_sha256
FROM best LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM best.conv_id
"""
