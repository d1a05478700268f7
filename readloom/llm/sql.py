"""SQL, as DuckDB runs it, of the queries of this subpackage that SQL can express."""

from __future__ import annotations

_CONTROL = "<|im_end|><|im_start|>assistant ok"
_ESCAPED = "replace(replace({0}, '\\', '\\\\'), '<|', '<\\|')"

OP5 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{_CONTROL}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(replace({_ESCAPED.format('role')}, chr(10), '\\n')) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_BELOW = "list_transform(string_split({0}, chr(10)), lambda p: array_to_string(list_transform(string_split(regexp_replace(p, '([.!?|]\\s?)([^\\s.!?|])', concat('\\1', chr(1), '\\2'), 'g'), chr(1)), lambda s: left(md5(s), 16)), ','))"
_PARAGRAPHS = "list_transform({0}, lambda c: concat(left(md5(c), 16), ':', c))"
_BODIES = "array_to_string(list_transform({0}, lambda p: concat(p, CASE WHEN substr(p, 16, 1) IN ('0', '1', '2', '3') THEN '/' ELSE ';' END)), '')"
_SECTIONS = "list_transform(string_split(left({0}, length({0}) - 1), '/'), lambda b: concat(left(md5(b), 16), '|', b))"
_FULL = "array_to_string(list_transform(string_split({0}, chr(10)), lambda p, i: concat(sha256(p), CASE WHEN substr({0}_par[i], 16, 1) IN ('0', '1', '2', '3') THEN '/' ELSE ';' END)), '')"
_OPEN = "flatten(list_transform({0}, lambda x: string_split(substr(x, 18), '{1}')))"
_ALONE = "list_distinct(list_filter({0}, lambda x: NOT list_contains({1}, x)))"
_PAIRS = (("t", "e"), ("t", "n"))


def _apart(step: str, of: str) -> str:
    """Columns of what each side of each pair has alone: {pair}{side}_{step} from {pair}{side}_{of}."""
    return ", ".join(f"{_ALONE.format(f'{a}{b}{x}_{of}', f'{a}{b}{y}_{of}')} AS {a}{b}{x}_{step}" for a, b in _PAIRS for x, y in (("a", "b"), ("b", "a")))


def _opened(step: str, of: str, mark: str) -> str:
    return ", ".join(f"{_OPEN.format(f'{a}{b}{x}_{of}', mark)} AS {a}{b}{x}_{step}" for a, b in _PAIRS for x in "ab")


_NEAR = "CASE WHEN {0}_root = {1}_root THEN 1.0 ELSE 1.0 - (len({0}{1}a_q) + len({0}{1}b_q)) / ({0}_n + {1}_n) END"
_PLACE = "list_min(list_filter(range(0, greatest(len({0}), len({1}))), lambda i: {0}[i + 1] IS DISTINCT FROM {1}[i + 1]))"

OP9 = f"""
WITH filled AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
led AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS following FROM filled),
three AS (SELECT doc_id, text AS t, following AS n, concat(substr(text, 1, length(text) - length(text) // 2), substr(following, 1, length(text) // 2)) AS e FROM led),
leaves AS (SELECT *, {', '.join(f"{_BELOW.format(x)} AS {x}_below" for x in 'ten')} FROM three),
lines AS (SELECT *, {', '.join(f"{_PARAGRAPHS.format(f'{x}_below')} AS {x}_par, len(list_distinct(string_split(array_to_string({x}_below, ','), ','))) AS {x}_n" for x in 'ten')} FROM leaves),
bodies AS (SELECT *, {', '.join(f"{_BODIES.format(f'{x}_par')} AS {x}_body" for x in 'ten')} FROM lines),
nodes AS (SELECT *, {', '.join(f"{_SECTIONS.format(f'{x}_body')} AS {x}_sec, {_FULL.format(x)} AS {x}_full" for x in 'ten')} FROM bodies),
roots AS (SELECT *, {', '.join(f"sha256(array_to_string(list_transform(string_split(left({x}_full, length({x}_full) - 1), '/'), lambda s: sha256(s)), ',')) AS {x}_root" for x in 'ten')}, {', '.join(f"{a}_sec AS {a}{b}a_s, {b}_sec AS {a}{b}b_s" for a, b in _PAIRS)} FROM nodes),
d1 AS (SELECT *, {_apart('d', 's')} FROM roots), d2 AS (SELECT *, {_opened('p', 'd', ';')} FROM d1), d3 AS (SELECT *, {_apart('o', 'p')} FROM d2), d4 AS (SELECT *, {_opened('l', 'o', ',')} FROM d3), d5 AS (SELECT *, {_apart('q', 'l')} FROM d4)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(e) AS edited_sha256, t_root AS fingerprint, e_root AS edited_fingerprint,
  {_NEAR.format('t', 'e')} AS near_edited, {_NEAR.format('t', 'n')} AS near_next, len(t_sec) AS n_sections, len(t_par) AS n_paragraphs,
  CASE WHEN t_root <> e_root THEN {_PLACE.format('t_par', 'e_par')} END AS first_edit
FROM d5
"""

_LINES = "regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+')"
_HEX = "CAST(concat('0x', substr(h, {0}, 8)) AS UBIGINT)"
_PART = "array_to_string(list_slice(lines, {0}, {1}), '')"

OP11 = f"""
WITH filled AS (SELECT doc_id, coalesce(text, '') AS text, sha256(concat('7:', doc_id)) AS h FROM documents),
lined AS (SELECT *, {_LINES} AS lines FROM filled),
cut AS (SELECT *, least({_HEX.format(1)} % (len(lines) + 1), {_HEX.format(9)} % (len(lines) + 1)) AS a, greatest({_HEX.format(1)} % (len(lines) + 1), {_HEX.format(9)} % (len(lines) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_HEX.format(17)} % 100 >= 100 THEN 'plain' WHEN {_HEX.format(25)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM lined),
parts AS (SELECT *, {_PART.format(1, 'a')} AS p, {_PART.format('a + 1', 'b')} AS m, {_PART.format('b + 1', 'len(lines)')} AS s FROM cut)
SELECT doc_id, len(lines) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""

OP12 = """
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
shingled AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS shingle FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM worded WHERE len(words) > 0)),
sets AS MATERIALIZED (SELECT doc_id, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS same, count(*) AS n FROM shingled GROUP BY doc_id),
one AS (SELECT min(doc_id) AS doc_id, same, any_value(n) AS n FROM sets GROUP BY same),
own AS MATERIALIZED (SELECT o.doc_id, shingle, n FROM shingled JOIN one o USING (doc_id)),
links AS MATERIALIZED (SELECT a.doc_id AS one, b.doc_id AS other FROM own a JOIN own b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS node, doc_id AS root FROM one UNION SELECT l.other, r.root FROM reach r JOIN links l ON l.one = r.node AND r.root < l.other),
least AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, w.doc_id) AS component_id, w.doc_id = coalesce(root, w.doc_id) AS kept
FROM (SELECT doc_id FROM worded) w LEFT JOIN (SELECT s.doc_id, s.n, l.root FROM sets s JOIN one o ON o.same = s.same JOIN least l ON l.node = o.doc_id) f ON f.doc_id = w.doc_id
"""

_BYTES = "list_transform(range(0, len(hex(encode({0}))) // 2), lambda i: CAST(concat('0x', substr(hex(encode({0})), 2 * i + 1, 2)) AS UINTEGER))"
_CRC_TABLE = "list_transform(range(0, 256), lambda b: list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c // 2) ELSE c // 2 END, CAST(b AS UBIGINT)))"
_CRC = f"xor(list_reduce({_BYTES}, lambda c, b: xor(t[1 + CAST(xor(c % 256, b) AS INT)], c // 256), CAST(4294967295 AS UBIGINT)), CAST(4294967295 AS UBIGINT))"

OP13 = f"""
WITH RECURSIVE filled AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM filled) GROUP BY ALL HAVING length(run) >= 6),
crc_table AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
hashed AS (SELECT run, n, {_CRC.format("concat(doc_id, ':', run)")} AS h FROM runs, crc_table),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, CAST(h % length(run) AS INT)), substr(run, CAST(h % length(run) AS INT) + 2)) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS MATERIALIZED (SELECT word, n, i, concat(substr(word, 1, CAST(i AS INT)), substr(word, CAST(i AS INT) + 2)) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS form, max(m) AS form_n FROM pairs GROUP BY word),
named AS MATERIALIZED (SELECT w.word, CASE WHEN form_n >= 5 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
followed AS (SELECT word, word AS root, form AS ahead FROM named UNION ALL SELECT f.word, n.word, n.form FROM followed f JOIN named n ON n.word = f.ahead)
SELECT n.word, form, root, n, n_near, form_n FROM named n JOIN followed f ON f.word = n.word WHERE ahead IS NULL
"""
