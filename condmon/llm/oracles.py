"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from condmon.llm import chat, linededup, mixing, sharding

_WORD = "[^\\x20\\x09-\\x0D]+"


def mix_sql() -> str:
    """Closed form of the mix: words taken from a stream prefix that wraps."""
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
         coalesce('0' || source, '1') AS g,
         md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
s AS (
  SELECT g, sum(size)::BIGINT AS source_size,
         ([{weights}])[((row_number() OVER (ORDER BY g) - 1) % {len(mixing.WEIGHTS)}) + 1] AS w
  FROM d GROUP BY g),
o AS (  -- sources by the level at which they are full: the capped ones are a prefix
  SELECT *, sum({mixing.MAX_PASSES} * source_size) OVER u - {mixing.MAX_PASSES} * source_size AS full_before,
         sum(w) OVER () - (sum(w) OVER u - w) AS weight_left, sum(source_size) OVER () AS total
  FROM s WINDOW u AS (ORDER BY {mixing.MAX_PASSES} * source_size / w, g ROWS UNBOUNDED PRECEDING)),
l AS (  -- the first source that its level does not fill ends the prefix
  SELECT arg_min(lv, nth) FILTER (WHERE w * lv <= {mixing.MAX_PASSES} * source_size) AS level
  FROM (SELECT *, (total::DOUBLE - full_before::DOUBLE) / weight_left::DOUBLE AS lv,
               row_number() OVER (ORDER BY {mixing.MAX_PASSES} * source_size / w, g) AS nth FROM o)),
t AS (
  SELECT g, source_size, least(w * level, ({mixing.MAX_PASSES} * source_size)::DOUBLE) AS target,
         floor(least(w * level, ({mixing.MAX_PASSES} * source_size)::DOUBLE) + 0.5)::BIGINT AS want
  FROM s, l),
p AS (
  SELECT d.*, t.source_size, t.target, t.want,
         (sum(size) OVER (PARTITION BY g ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS a
  FROM d JOIN t USING (g))
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE (want // source_size) * size + greatest(0, least(a + size, want % source_size) - a) END)::BIGINT AS taken
FROM p"""


def shard_sql() -> str:
    n = sharding.SHARDS
    # CRC-32 of the UTF-8 bytes, reflected polynomial 0xEDB88320, built from its rule
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""
WITH RECURSIVE bits(b, i, c) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL SELECT b, i + 1, {step} FROM bits WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE i = 8),
d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, coalesce('0' || source, '1') AS g,
         md5('{sharding.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k,
         hex(encode(coalesce(text, ''))) AS h
  FROM documents),
c AS (
  SELECT d.*, xor(list_reduce(
           list_prepend(4294967295::BIGINT,
             list_transform(range(strlen(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
           lambda a, b: xor(a >> 8, crc.tab[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, crc),
r AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY k, doc_id, size, text_crc32) - 1 AS r,
         count(*) OVER (PARTITION BY g) AS n
  FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY (r + 0.5::DOUBLE) / n, g, r) - 1 AS pos, count(*) OVER () AS total FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, (pos * {n} // total)::INTEGER AS shard,
       (pos - ((pos * {n} // total) * total + {n - 1}) // {n})::BIGINT AS slot, NULL::DOUBLE AS grown_shard
FROM p"""


def chat_sql() -> str:
    """Prefixes compared as lists of whole turns."""
    safe = "replace(coalesce({0}, ''), '<|im_', '<| im_')"
    line = f"'{chat.BEGIN}' || {safe.format('role')} || chr(10) || {safe.format('text')} || '{chat.END}' || chr(10)"
    return f"""
WITH t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, md5(coalesce(text, '')), text IS NULL) AS pos
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
p AS (
  SELECT conv_id, pos, md5(string_agg(md5(coalesce(turn::VARCHAR, '-')) || md5(coalesce('r' || role, '-')) || md5(coalesce('t' || text, '-')), '')
           OVER (PARTITION BY conv_id ORDER BY pos)) AS h,
         max(pos) OVER (PARTITION BY conv_id) AS n_turns
  FROM t),
f AS (
  SELECT min(conv_id) AS conv_id, n_turns, h, count(*) AS n_copies FROM p WHERE pos = n_turns GROUP BY n_turns, h),
k AS (
  SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos = f.n_turns AND p.h = f.h AND p.n_turns > f.n_turns))
SELECT conv_id, ((pos - 1) // {chat.PART_TURNS})::INTEGER AS part, n_turns, n_copies, count(*) AS part_turns,
       string_agg({line}, '' ORDER BY pos) AS text
FROM t JOIN k USING (conv_id) GROUP BY ALL"""


def line_dedup_sql() -> str:
    """Windows of whole lines compared as text."""
    w = linededup.WORDS
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ln,
         unnest(string_split(text, chr(10))) AS raw
  FROM documents),
n AS (
  SELECT doc_id, ln, trim(raw, {space}) AS line, row_number() OVER (PARTITION BY doc_id ORDER BY ln) - 1 AS pos,
         greatest(len(regexp_extract_all(raw, '{_WORD}')), length(trim(raw, {space})) // {linededup.WORD_CHARS}) AS words
  FROM l WHERE trim(raw, {space}) <> ''),
c AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto, sum(words) OVER (PARTITION BY doc_id) AS total,
         count(*) OVER (PARTITION BY doc_id) AS n_lines FROM n),
e AS (  -- the line with which the words from each line on suffice
  SELECT a.doc_id, a.pos, b.pos AS last FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.pos < a.pos + {w}
    AND b.upto - (a.upto - a.words) >= {w} AND b.upto - b.words - (a.upto - a.words) < {w}
  UNION ALL SELECT doc_id, 0, n_lines - 1 FROM c WHERE pos = 0 AND total < {w}),
v AS (
  SELECT e.doc_id, e.pos, e.last, string_agg(n.line, chr(10) ORDER BY n.pos) AS content
  FROM e JOIN n ON e.doc_id = n.doc_id AND n.pos BETWEEN e.pos AND e.last GROUP BY ALL),
r AS (
  SELECT doc_id, pos, last FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, pos) AS nth FROM v) WHERE nth > 1),
g AS (
  SELECT DISTINCT n.doc_id, n.ln FROM n JOIN r ON n.doc_id = r.doc_id AND n.pos BETWEEN r.pos AND r.last),
a AS (
  SELECT doc_id, count(*) AS n_removed, string_agg(ln::VARCHAR, ',' ORDER BY ln) AS removed_lines FROM g GROUP BY doc_id),
k AS (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY ln) AS text
  FROM l WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.doc_id = l.doc_id AND g.ln = l.ln) GROUP BY doc_id)
SELECT d.doc_id, (SELECT count(*) FROM n WHERE n.doc_id = d.doc_id) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_lines, '') AS removed_lines,
       CASE WHEN n_removed > 0 THEN coalesce(k.text, '') ELSE d.text END AS text
FROM documents d LEFT JOIN a USING (doc_id) LEFT JOIN k USING (doc_id)"""


def repair_sql() -> str:
    """The cheapest edits row by row, scripts and repaired lines as text."""
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    far = 1 << 40  # cost of a state that cannot be reached
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

    def cell(frm: str, cost: str, letter: str, line: str | None = None) -> str:
        lines = f"list_append({frm}.r, {line})" if line else f"{frm}.r"
        return f"{{'c': {frm}.c + {cost}, 'a': {frm}.a || '{letter}', 'r': {lines}}}"

    def off(cond: str, made: str) -> str:
        return f"CASE WHEN {cond} THEN {made} ELSE {{'c': {far}::BIGINT, 'a': '', 'r': []::VARCHAR[]}} END"

    own = "f.role || ':' || f.text"
    stay = "NOT f.forced AND f.initial = "
    keep = lambda s, i: off(f"{stay}'{i}'", cell(s, "f.extra", "K", own))
    turn = lambda s, r: off("NOT f.forced", cell(s, "f.extra + 3", "R", f"'{r}:' || f.text"))
    gone = lambda s: cell(s, "4", "D")
    new = lambda s, r: cell(s, "3", "I", f"'{r}:'")
    least = lambda *x: f"list_min([{', '.join(x)}])"
    unreached = f"{{'c': {far}::BIGINT, 'a': '', 'r': []::VARCHAR[]}}"
    return f"""
WITH RECURSIVE bits(b, i, c) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL SELECT b, i + 1, {step} FROM bits WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS tab FROM bits WHERE i = 8),
h AS (
  SELECT *, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS x FROM conversations),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(strlen(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT)),
           lambda a, b: xor(a >> 8, crc.tab[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS fault
  FROM h, crc),
d AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END))
  FROM k WHERE fault <> 0),
o AS (
  SELECT conv_id, turn, role, text, rtrim(text, {spaces}) AS t, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM d),
s AS (
  SELECT *, CASE WHEN t = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                 WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair
  FROM o),
f AS (
  SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS forced, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM s),
ids AS (SELECT DISTINCT conv_id FROM conversations),
dp AS (
  SELECT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS s0, {unreached} AS s1,
         {{'c': 3::BIGINT, 'a': 'I', 'r': ['user:']}} AS s2, {{'c': 6::BIGINT, 'a': 'II', 'r': ['user:', 'assistant:']}} AS s3
  FROM ids
  UNION ALL
  SELECT conv_id, pos, n0, n1, i2, {least('n3', new('i2', 'assistant'))}
  FROM (
    SELECT *, {least('n2', new('n0', 'user'), new('n1', 'user'), new('n3', 'user'))} AS i2
    FROM (
      SELECT f.conv_id, f.pos, {gone('s0')} AS n0, {least(gone('s1'), keep('s0', 's'))} AS n1,
             {least(gone('s2'), *[keep(s, 'u') for s in ('s0', 's1', 's3')], *[turn(s, 'user') for s in ('s0', 's1', 's3')])} AS n2,
             {least(gone('s3'), keep('s2', 'a'), turn('s2', 'assistant'))} AS n3
      FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.pos = dp.pos + 1))),
z AS (
  SELECT conv_id, arg_max({least('s0', 's3')}, pos) AS best FROM dp GROUP BY conv_id),
q AS (
  SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id)
SELECT z.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(array_to_string(best.r, chr(10))) AS repaired_sha256
FROM z LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM z.conv_id"""
