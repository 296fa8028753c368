"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""

OP6 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (
  SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.doc_id, k.i, k.line, r.key IS NULL OR k.doc_id = r.keeper AS stays FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


#: Levels spelt out in the SQL below: enough for 16 to that power of documents of a source, and of sources.
MERKLE_LEVELS = 6


def _merkle(levels: int = MERKLE_LEVELS) -> str:
    """Leaves, trees level by level, and each leaf's way up; a tree of one node stays as it is."""
    def field(x):
        return f"coalesce(strlen(({x})::VARCHAR) || ':' || ({x})::VARCHAR, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))""",
             f"""docs AS (
  SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(lower)} AS other, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM documents, crc_table)""",
             """leaves AS (
  SELECT doc_id, leaf, CASE WHEN crc % 5 = 0 THEN other ELSE leaf END AS own,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs)""",
             "a0 AS (SELECT tree, pos, leaf AS d, count(*) OVER (PARTITION BY tree) AS size FROM leaves)",
             "way0 AS (SELECT doc_id, leaf, tree, pos, own AS cur, '' AS proof, NULL::VARCHAR AS subroot FROM leaves)"]
    step = 0

    def climb(kind):
        nonlocal step
        for level in range(1, levels + 1):
            parts.append(f"{kind}run{level} AS (SELECT tree, pos // 16 AS pos, list(d ORDER BY pos) AS ch, any_value(size) AS size "
                         f"FROM {kind}{level - 1} WHERE size > 1 GROUP BY tree, pos // 16)")
            parts.append(f"{kind}{level} AS (SELECT tree, pos, sha256(array_to_string(ch, '')) AS d, (size + 15) // 16 AS size "
                         f"FROM {kind}run{level} UNION ALL SELECT tree, pos, d, size FROM {kind}{level - 1} WHERE size = 1)")
            parts.append(f"way{step + 1} AS (SELECT doc_id, leaf, w.tree, w.pos // 16 AS pos, CASE WHEN ch IS NULL THEN cur ELSE "
                         "sha256(array_to_string(list_concat(list_concat(ch[:w.pos % 16], [cur]), ch[w.pos % 16 + 2:]), '')) END AS cur, "
                         "proof || coalesce(array_to_string(list_concat(ch[:w.pos % 16], ch[w.pos % 16 + 2:]), ''), '') AS proof, subroot "
                         f"FROM way{step} w LEFT JOIN {kind}run{level} r ON w.tree = r.tree AND w.pos // 16 = r.pos)")
            step += 1

    climb("a")
    parts.append(f"b0 AS (SELECT 0 AS tree, tree AS pos, d, count(*) OVER () AS size FROM a{levels})")
    parts.append(f"way{step + 1} AS (SELECT doc_id, leaf, 0 AS tree, w.tree AS pos, cur, proof, d AS subroot "
                 f"FROM way{step} w JOIN a{levels} r ON w.tree = r.tree)")
    step += 1
    climb("b")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, w.subroot, d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = d AS verified
FROM way{step} w, b{levels}
""")


OP12 = _merkle()


def _crc32(text: str, table: str = "t") -> str:
    """CRC-32 of an ASCII text by a 256-entry table."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), "
            f"lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])))")


def _repair() -> str:
    """Damage, faults, the least (cost, audit) from each state by a recursion from the last row, the repaired rows."""
    def after(cost, letter, state):
        return f"{{'c': {cost} + w{state}.c, 's': '{letter}' || w{state}.s}}"

    following = [2, 2, 3, 2]
    kept = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    consume = []
    for state in range(4):
        ways = [after(3, "D", state)]
        free = [f"CASE WHEN NOT gone THEN {after('2 + cut', 'R', following[state])} END"]
        free += [f"CASE WHEN NOT gone AND ini = '{x}' THEN {after('cut', 'K', to)} END" for x, to in kept[state].items()]
        consume.append(f"list_min(list_filter([{', '.join(ways + free)}], lambda x: x IS NOT NULL)) AS k{state}")

    def inserted(own, state, column):
        return f"list_min([{own}, {{'c': 2 + {column}.c, 's': 'I' || {column}.s}}]) AS {state}"

    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS how
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d, range(2) r(copy) WHERE how <> 0 AND (copy = 0 OR how = 3)),
r AS (
  SELECT *, coalesce(conv_id::VARCHAR, '-') AS conv, substring(role, 1, 1) AS ini,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM damaged),
f AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'b' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'd' WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         coalesce(lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au'), false) AS illegal FROM r),
n AS (
  SELECT conv, any_value(conv_id) AS conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (illegal) AS illegal FROM f GROUP BY conv),
dp AS (
  SELECT conv, n AS i, {{'c': 0, 's': ''}} AS w0, {{'c': 4, 's': 'II'}} AS w1, {{'c': 2, 's': 'I'}} AS w2, {{'c': 0, 's': ''}} AS w3 FROM n
  UNION ALL
  SELECT conv, i, {inserted('k0', 'w0', 'x2')}, {inserted('k1', 'w1', 'x2')}, x2 AS w2, x3 AS w3 FROM (
    SELECT *, {inserted('k2', 'x2', 'k3')}, {inserted('k3', 'x3', 'k2')} FROM (
      SELECT f.conv, f.i - 1 AS i, {", ".join(consume)}
      FROM dp JOIN (SELECT conv, i, ini, fault IN ('b', 'd') AS gone, (fault = 't')::INT AS cut FROM f) f
      ON f.conv = dp.conv AND f.i = dp.i))),
best AS (SELECT n.*, w0.c AS cost, w0.s AS audit FROM dp JOIN n ON dp.conv = n.conv WHERE dp.i = 0),
letters AS (
  SELECT conv, p, substring(audit, p, 1) AS letter,
         count(*) FILTER (substring(audit, p, 1) <> 'I') OVER w AS i, count(*) FILTER (substring(audit, p, 1) <> 'D') OVER w AS e
  FROM (SELECT conv, audit, unnest(range(1, length(audit) + 1)) AS p FROM best)
  WINDOW w AS (PARTITION BY conv ORDER BY p ROWS UNBOUNDED PRECEDING)),
kept AS (
  SELECT l.conv, l.p, l.letter, l.e, f.role, f.text, f.ini FROM letters l LEFT JOIN f ON f.conv = l.conv AND f.i = l.i AND l.letter <> 'I'
  WHERE l.letter <> 'D'),
lead AS (SELECT conv, bool_or(e = 1 AND letter = 'K' AND ini = 's')::INT AS s FROM kept GROUP BY conv),
text AS (
  SELECT k.conv, string_agg(CASE letter WHEN 'K' THEN role ELSE CASE WHEN (e - s) % 2 = 1 THEN 'user' ELSE 'assistant' END END
         || ':' || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS text FROM kept k JOIN lead ON k.conv = lead.conv GROUP BY k.conv)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(text.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN best ON every.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN text ON best.conv = text.conv
"""


OP11 = _repair()


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1,
        "op6_line_dedup": OP6,
        "op11_conversation_repair": OP11,
        "op12_merkle_manifest": OP12,
    }
