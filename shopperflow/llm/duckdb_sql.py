"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from .license_rules import RULES, SENTENCES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str) -> str:
    """key, ws: the words of every text."""
    return (
        f"SELECT {key}, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
        f"'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM {table}"
    )


OP3 = f"""
WITH items AS ({_words("benchmark", "item_id")}),
wins AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM items WHERE len(ws) > 0)),
docs AS ({_words("documents", "doc_id")}),
places AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM wins) WHERE len(ws) >= n)),
found AS (SELECT doc_id, p.n, i, item_id FROM places p JOIN wins USING (n, w)),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN names USING (doc_id)
"""

_RULES = ", ".join("('{}', '{}')".format(name, "\n" + "\n\n".join(ids) + "\n") for name, ids in RULES)
#: A known sentence fills lines that follow one another; of those that begin at a line the longest counts, and the next begins after it.
OP9 = f"""
WITH RECURSIVE known(id, s) AS (VALUES {", ".join(f"('{i}', '{s}')" for i, s in SENTENCES.items())}),
rules(license, seq) AS (VALUES {_RULES}),
cut AS (
  SELECT doc_id, regexp_split_to_array(regexp_replace(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '([^.!?\\n][.!?])(?:[ \\t\\r]+\\n?|\\n)', '\\1' || chr(10) || chr(10), 'g'), '[^a-z0-9\\n]+', ' ', 'g'), '\\n') AS l FROM documents),
lines AS (SELECT doc_id, trim(unnest(l)) AS s, generate_subscripts(l, 1) AS i FROM cut),
begun AS (
  SELECT doc_id, i, i AS j, s FROM lines
  WHERE s <> '' AND EXISTS (SELECT 1 FROM known k WHERE k.s = lines.s OR starts_with(k.s, lines.s || ' '))
  UNION ALL
  SELECT b.doc_id, b.i, n.i, b.s || ' ' || n.s FROM begun b JOIN lines n ON n.doc_id = b.doc_id AND n.i = b.j + 1
  WHERE n.s <> '' AND EXISTS (SELECT 1 FROM known k WHERE k.s = b.s || ' ' || n.s OR starts_with(k.s, b.s || ' ' || n.s || ' '))),
longest AS (SELECT doc_id, i, max(j) AS j, arg_max(id, j) AS id FROM begun JOIN known USING (s) GROUP BY doc_id, i),
chained AS (
  SELECT a.doc_id, a.i, any_value(a.id) AS id, min(b.i) AS after
  FROM longest a LEFT JOIN longest b ON b.doc_id = a.doc_id AND b.i > a.j GROUP BY a.doc_id, a.i),
taken AS (
  SELECT * FROM chained WHERE (doc_id, i) IN (SELECT doc_id, min(i) FROM longest GROUP BY doc_id)
  UNION ALL
  SELECT c.* FROM taken t JOIN chained c ON c.doc_id = t.doc_id AND c.i = t.after),
ids AS (
  SELECT doc_id, count(*) AS n_known, string_agg(id, ',' ORDER BY i) AS sentence_ids,
    chr(10) || string_agg(id, chr(10) || chr(10) ORDER BY i) || chr(10) AS seq
  FROM taken GROUP BY doc_id),
found AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
  FROM ids, rules WHERE contains(ids.seq, rules.seq) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_known, 0) AS BIGINT) AS n_known, coalesce(sentence_ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN ids USING (doc_id) LEFT JOIN found USING (doc_id)
"""

#: Prefixes of the words of each text, by number of words: shingles of five, or the whole shorter sequence.
OP1 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM docs WHERE len(ws) > 0),
tokens AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS w FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM tokens a JOIN tokens b ON a.w = b.w AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM docs UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x) USING (doc_id)
"""

_ZERO_BITS = "[0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]"


def _crc32(text: str) -> str:
    """Of a text of ASCII characters, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    bits = f"list_reduce(list_prepend(xor(a, b), {_ZERO_BITS}), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {bits}), 4294967295)"


def _added(way: str, cost: str, letter: str) -> str:
    """A way is its cost in eight digits and its audit; null if there is none."""
    return f"(lpad(CAST(CAST(left({way}, 8) AS INTEGER) + {cost} AS VARCHAR), 8, '0') || substr({way}, 9) || '{letter}')"


def _step() -> str:
    """The best ways to the four states of the role grammar after an insert ('I') or a row ([initial, extra cost or 'x'])."""
    dropped = [_added(f"a[{s}]", "4", "D") for s in range(1, 5)]
    closed = f"least(a[3], {', '.join(_added(f'a[{s}]', '3', 'I') for s in (1, 2, 4))})"

    def kept(s: int) -> str:
        return _added(f"a[{s}]", "CAST(r[2] AS INTEGER)", "K")

    def turned(s: int) -> str:
        return _added(f"a[{s}]", "3 + CAST(r[2] AS INTEGER)", "R")

    second = f"least({dropped[1]}, CASE WHEN r[1] = 's' THEN {kept(1)} END)"
    third = f"least({dropped[2]}, {', '.join(turned(s) for s in (1, 2, 4))}, CASE WHEN r[1] = 'u' THEN least({', '.join(kept(s) for s in (1, 2, 4))}) END)"
    fourth = f"least({dropped[3]}, {turned(3)}, CASE WHEN r[1] = 'a' THEN {kept(3)} END)"
    return (
        f"CASE WHEN r[1] = 'I' THEN [a[1], a[2], {closed}, least(a[4], {_added(closed, '3', 'I')})] "
        f"WHEN r[2] = 'x' THEN [{', '.join(dropped)}] ELSE [{dropped[0]}, {second}, {third}, {fourth}] END"
    )


OP12 = f"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
spoilt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS time
  FROM raw WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial FROM spoilt),
told AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal,
    list_concat([['00000000', NULL, NULL, NULL], ['I', '']], flatten(list(
      [[initial, CASE fault WHEN '' THEN '0' WHEN 'truncated' THEN '3' ELSE 'x' END], ['I', '']] ORDER BY i))) AS steps
  FROM told GROUP BY conv_id),
ways AS (SELECT *, list_reduce(steps, lambda a, r: {_step()}) AS w FROM sums),
best AS (SELECT *, least(w[1], w[4]) AS way FROM ways),
letters AS (
  SELECT conv_id, unnest(string_split(substr(way, 9), '')) AS letter, generate_subscripts(string_split(substr(way, 9), ''), 1) AS j FROM best
  WHERE length(way) > 8),
taken AS (SELECT conv_id, letter, j, sum(CAST(letter <> 'I' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY j) AS i FROM letters),
stays AS (
  SELECT t.conv_id, t.letter, row_number() OVER (PARTITION BY t.conv_id ORDER BY j) AS m, role, text,
    first_value(t.letter = 'K' AND initial = 's') OVER (PARTITION BY t.conv_id ORDER BY j) AS led
  FROM taken t LEFT JOIN placed p ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i AND t.letter <> 'I' WHERE t.letter <> 'D'),
made AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN letter = 'K' THEN role WHEN (m - CAST(coalesce(led, false) AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY m)) AS digest
  FROM stays GROUP BY conv_id)
SELECT o.conv_id, {", ".join(f"CAST(coalesce({n}, 0) AS BIGINT) AS {n}" for n in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
  coalesce(CAST(left(way, 8) AS BIGINT), 0) AS cost, coalesce(substr(way, 9), '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN made d ON o.conv_id IS NOT DISTINCT FROM d.conv_id
"""

OP13 = f"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS i, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, count(*) AS own, {_crc32("CAST(c AS VARCHAR)")} % 6 AS heads, c - c % 100 AS base FROM turns GROUP BY c),
placed AS (
  SELECT c.c, t.i, t.role, t.text FROM convs c JOIN turns t ON t.c = c.base WHERE t.i < c.heads
  UNION ALL SELECT c.c, t.i, t.role, t.text FROM convs c JOIN turns t ON t.c = c.c WHERE t.i >= c.heads),
paths AS (
  SELECT c, row_number() OVER w AS depth, string_agg(role || chr(31) || text || chr(30), '') OVER w AS prefix, length(text) AS chars
  FROM placed WINDOW w AS (PARTITION BY c ORDER BY i)),
members AS (
  SELECT c, 0 AS depth, '' AS prefix, 0 AS chars, NULL AS parent FROM convs
  UNION ALL SELECT c, depth, prefix, chars, coalesce(lag(prefix) OVER (PARTITION BY c ORDER BY depth), '') FROM paths),
ended AS (SELECT *, depth = max(depth) OVER (PARTITION BY c) AS ends FROM members),
nodes AS (
  SELECT depth, prefix, min(c) AS conv_id, count(*) AS n_convs, min(parent) AS parent, (count(*) - 1) * min(chars) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM ended GROUP BY depth, prefix),
counted AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.parent = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.parent),
totals AS (
  SELECT m.depth, m.prefix, sum(CAST(n.n_children = 0 AS BIGINT)) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM counted n JOIN members m ON m.c = n.conv_id AND m.depth <= n.depth GROUP BY m.depth, m.prefix)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN totals USING (depth, prefix)
"""

QUERIES = {"op12_conversation_repair": OP12, "op13_prefix_trie": OP13, "op1_ngram_join": OP1, "op3_decontamination": OP3, "op9_license_rules": OP9}
