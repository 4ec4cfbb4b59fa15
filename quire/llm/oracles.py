"""DuckDB SQL of the queries that SQL can express, written on its own terms."""

from __future__ import annotations

FILL_IN_MIDDLE = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, n, [('0x' || substr(h, 1 + 8 * i, 8))::BIGINT FOR i IN range(4)] AS v FROM hashed),
cut AS (
  SELECT doc_id, t, n, least(v[1] % (n + 1), v[2] % (n + 1)) AS a, greatest(v[1] % (n + 1), v[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR v[3] % 100 >= 90 THEN 'plain'
              WHEN v[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
pieces AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM pieces
"""

# A state's value is its cost in twelve digits followed by its edits, so the least text is the cheapest, then ASCII-least repair.
CONVERSATION_REPAIR = """
WITH RECURSIVE filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
summed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(k, '')]),
      LAMBDA crc, byte: list_reduce([xor(crc, byte), 0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
          LAMBDA x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS kind FROM filled),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM summed WHERE kind <> 0),
placed AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, CASE WHEN trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN 1
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                 WHEN right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         CASE WHEN lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS jump FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, sum(jump)::BIGINT AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000000' AS v0, NULL::VARCHAR AS vs, NULL::VARCHAR AS vu, NULL::VARCHAR AS va FROM counted
  UNION ALL
  SELECT conv_id, i, grow(v0, 2, 'D'),
         least(grow(vs, 2, 'D'), CASE WHEN fault IN (0, 3) AND initial = 's' THEN grow(v0, more, 'K') END),
         least(grow(vu, 2, 'D'), CASE WHEN fault IN (0, 3) THEN least(grow(v0, more + rerole_u, edit_u), grow(vs, more + rerole_u, edit_u), grow(wa, more + rerole_u, edit_u)) END),
         least(grow(va, 2, 'D'), CASE WHEN fault IN (0, 3) THEN grow(wu, more + rerole_a, edit_a) END)
  FROM (
    SELECT *, least(va, grow(wu, 5, 'I')) AS wa FROM (
      SELECT dp.conv_id, judged.i, judged.fault, judged.initial, v0, vs, vu, va, least(vu, grow(v0, 5, 'I'), grow(vs, 5, 'I'), grow(va, 5, 'I')) AS wu,
             CASE judged.fault WHEN 3 THEN 5 ELSE 0 END AS more,
             CASE judged.initial WHEN 'u' THEN 0 ELSE 1 END AS rerole_u, CASE judged.initial WHEN 'u' THEN 'K' ELSE 'R' END AS edit_u,
             CASE judged.initial WHEN 'a' THEN 0 ELSE 1 END AS rerole_a, CASE judged.initial WHEN 'a' THEN 'K' ELSE 'R' END AS edit_a
      FROM dp JOIN judged ON dp.conv_id IS NOT DISTINCT FROM judged.conv_id AND judged.i = dp.i + 1) x) y),
least_repair AS (
  SELECT dp.conv_id, least(v0, va, grow(vs, 10, 'II'), grow(vu, 5, 'I')) AS v
  FROM dp JOIN counted ON dp.conv_id IS NOT DISTINCT FROM counted.conv_id AND dp.i = counted.n),
edits AS (
  SELECT conv_id, unnest(string_split(substr(v, 13), '')) AS e, generate_subscripts(string_split(substr(v, 13), ''), 1) AS j FROM least_repair WHERE length(v) > 12),
aligned AS (
  SELECT conv_id, j, e, sum(CASE WHEN e = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY j) AS i FROM edits),
made AS (
  SELECT a.conv_id, a.j, a.e, b.role, b.text, b.initial, row_number() OVER (PARTITION BY a.conv_id ORDER BY a.j) AS place_no,
         first_value(a.e = 'K' AND b.initial = 's') OVER (PARTITION BY a.conv_id ORDER BY a.j) AS led
  FROM aligned a LEFT JOIN judged b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.i = b.i AND a.e <> 'I' WHERE a.e <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role || ':' || text
      ELSE CASE WHEN (place_no + CASE WHEN led THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'R' THEN text ELSE '' END END, chr(10) ORDER BY j) AS body
  FROM made GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(left(v, 12)::BIGINT, 0) AS cost, coalesce(substr(v, 13), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted k ON c.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN least_repair r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
LEFT JOIN texts t ON c.conv_id IS NOT DISTINCT FROM t.conv_id
"""


def _expanded(sql: str) -> str:
    """``grow(value, cost, edits)`` written out: DuckDB has no function of the kind."""
    out, at = [], 0
    while (i := sql.find("grow(", at)) >= 0:
        depth, j, marks = 1, i + 5, []
        while depth:
            c = sql[j]
            depth += (c == "(") - (c == ")")
            if c == "," and depth == 1:
                marks.append(j)
            j += 1
        value, cost, edits = sql[i + 5:marks[0]], sql[marks[0] + 1:marks[1]], sql[marks[1] + 1:j - 1]
        out.append(f"{sql[at:i]}(lpad((left({value}, 12)::BIGINT + {cost.strip()})::VARCHAR, 12, '0') || substr({value}, 13) ||{edits})")
        at = j
    return "".join(out) + sql[at:]


ORACLES = {"op11_fill_in_middle": FILL_IN_MIDDLE, "op12_conversation_repair": _expanded(CONVERSATION_REPAIR)}
