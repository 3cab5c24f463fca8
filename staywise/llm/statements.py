"""SQL that must give the rows of some of the registered queries, for the engine that the results are compared with."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = rf"coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"


def _nibble_table() -> list[int]:
    """The CRC-32 register's change by four bits."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ 0xEDB88320 if value & 1 else value >> 1
        table.append(value)
    return table


def crc32_sql(text: str) -> str:
    """The CRC-32 of a text's UTF-8 bytes, four bits at a time, the low ones of each byte first."""
    digits = f"hex(encode({text}))"
    nibbles = f"list_transform(range(0, length({digits})), lambda i: instr('0123456789ABCDEF', substr({digits}, xor(i, 1::bigint) + 1, 1)) - 1)"
    step = f"lambda c, v: xor(c >> 4, ({_nibble_table()}::bigint[])[(xor(c, v) & 15::bigint) + 1])"
    return f"xor(list_reduce({nibbles}::bigint[], {step}, 4294967295::bigint), 4294967295::bigint)"


IMPORTANCE_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT {WORDS} AS w FROM benchmark),
fd AS MATERIALIZED (
  SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
fb AS MATERIALIZED (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
x AS MATERIALIZED (SELECT f, {crc32_sql("f")} % 10000 AS bucket FROM (FROM fd SELECT f UNION FROM fb SELECT f)),
s AS (SELECT bucket, count(*) AS s FROM fd JOIN x USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM fb JOIN x USING (f) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((SELECT count(*) FROM fd) + 10000)
                                 / ((coalesce(s, 0) + 1)::double * ((SELECT count(*) FROM fb) + 10000))))::bigint AS gain
  FROM (SELECT DISTINCT bucket FROM x) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
w AS (SELECT r, floor(sum(gain)::double / count(*))::bigint AS weight FROM fd JOIN x USING (f) JOIN g USING (bucket) GROUP BY r),
h AS (
  SELECT r, doc_id, len(w) AS n_words, (2 * len(w) - (len(w) > 0)::int)::bigint AS n_features, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint AS h
  FROM d LEFT JOIN w USING (r)),
c AS (
  SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296.0::double))))::bigint AS score FROM h),
k AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place, 25 * count(*) OVER () // 100 AS drawn
  FROM c WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM c LEFT JOIN k USING (r)
"""

EMBEDDING_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding::double[] AS e FROM embeddings),
n AS MATERIALIZED (
  SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b, b.vec_id AS other FROM n a JOIN n b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
w(r, id) AS (SELECT r, vec_id FROM v UNION SELECT l.a, w.id FROM w JOIN l ON l.b = w.r),
c AS (SELECT r, min(id) AS component_id FROM w GROUP BY r)
SELECT vec_id, coalesce((SELECT count(*) FROM l WHERE l.a = v.r), 0)::bigint AS n_links, component_id,
       coalesce(vec_id = component_id, false) AS kept
FROM v JOIN c USING (r)
"""


def _least(*options: str) -> str:
    """The cheapest option, of equal ones the one with the least audit; an option is a struct or null."""
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"


def _edit(then: str, cost: str, letter: str, row: str | None, when: str) -> str:
    rows = f"list_prepend({row}, {then}.rows)" if row else f"{then}.rows"
    return f"CASE WHEN {when} THEN {{'cost': {then}.cost + {cost}, 'audit': '{letter}' || {then}.audit, 'rows': {rows}}} END"


def _row_edits(state: str, kept: dict[str, str], forced: str, role: str) -> str:
    """The edits of a row from one state on, as structs."""
    keep = [_edit(f"b.{to}", "extra", "K", "f.shown", f"fault > 1 AND initial = '{first}'") for first, to in kept.items()]
    rerole = _edit(f"b.{forced}", "3 + extra", "R", f"'{role}:' || f.text", "fault > 1")
    return _least(_edit(f"b.{state}", "4", "D", None, "true"), rerole, *keep)


def _insert(to: str, role: str) -> str:
    return f"{{'cost': {to}.cost + 3, 'audit': 'I' || {to}.audit, 'rows': list_prepend('{role}:', {to}.rows)}}"


#: Faults: 0 blank, 1 duplicate, 2 truncated, 3 none. States: z before any row, s, u, a after a row of that initial.
REPAIR_SQL = rf"""
WITH RECURSIVE g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' '))")} % 20 AS part
  FROM conversations),
h AS (
  SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN part = 1 THEN '' WHEN part = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN part = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM g WHERE part <> 0),
i AS (
  SELECT *, substr(role, 1, 1) AS initial, role || ':' || text AS shown, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS tail,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM h),
j AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS again FROM i),
f AS MATERIALIZED (
  SELECT *, CASE WHEN tail = '' THEN 0 WHEN again > 1 THEN 1 WHEN tail NOT IN ('.', '!', '?') THEN 2 ELSE 3 END AS fault,
         CASE WHEN tail IN ('.', '!', '?') THEN 0 ELSE 3 END AS extra,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM j),
n AS (
  SELECT conv_id, count(*) AS last, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 0) AS blank, count(*) FILTER (fault = 1) AS duplicate, count(*) FILTER (fault = 2) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
b AS (
  SELECT conv_id, last AS place,
         {{'cost': 0::bigint, 'audit': '', 'rows': []::varchar[]}} AS z,
         {{'cost': 6::bigint, 'audit': 'II', 'rows': ['user:', 'assistant:']}} AS s,
         {{'cost': 3::bigint, 'audit': 'I', 'rows': ['assistant:']}} AS u,
         {{'cost': 0::bigint, 'audit': '', 'rows': []::varchar[]}} AS a FROM n
  UNION ALL
  SELECT conv_id, place, {_least("z", _insert("u", "user"))}, {_least("s", _insert("u", "user"))}, u, a
  FROM (
    SELECT conv_id, place, z, s, {_least("u", _insert("a", "assistant"))} AS u, {_least("a", _insert("u", "user"))} AS a
    FROM (
      SELECT b.conv_id, b.place - 1 AS place,
             {_row_edits("z", {"s": "s", "u": "u"}, "u", "user")} AS z,
             {_row_edits("s", {"u": "u"}, "u", "user")} AS s,
             {_row_edits("u", {"a": "a"}, "a", "assistant")} AS u,
             {_row_edits("a", {"u": "u"}, "u", "user")} AS a
      FROM b JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.place = b.place))),
e AS (SELECT conv_id, z FROM b WHERE place = 0)
SELECT o.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank, coalesce(duplicate, 0)::bigint AS duplicate,
       coalesce(truncated, 0)::bigint AS truncated, coalesce(illegal, 0)::bigint AS illegal, coalesce(z.cost, 0)::bigint AS cost,
       coalesce(z.audit, '') AS audit, sha256(coalesce(array_to_string(z.rows, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
