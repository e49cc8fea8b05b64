"""The operators' queries in SQL for DuckDB, where SQL can express them on whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
WITH sized AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
    (3 * source_size)::DOUBLE AS cap FROM sources
), levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER r, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER r, 0)) AS level
  FROM weighed WINDOW r AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), first_free AS (
  SELECT level AS settled FROM levels WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1
), goals AS (
  SELECT source, source_size, CASE WHEN level * weight <= cap THEN (SELECT settled FROM first_free) * weight ELSE cap END AS target FROM levels
), measured AS (
  SELECT s.doc_id, s.source, s.size, length(bin(s.size)) AS bits,
    (('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '') || ':' || coalesce(s.text, '')), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u FROM sized s
), classes AS (
  SELECT source, bits, sum(size)::BIGINT AS words FROM measured GROUP BY ALL
), levelled AS (
  SELECT c.source, bits, words, source_size, target,
    (target - 3 * coalesce(sum(words) OVER (PARTITION BY c.source ORDER BY bits DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / nullif(sum(bits * words) OVER (PARTITION BY c.source ORDER BY bits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE, 0) AS rate
  FROM classes c JOIN goals g ON c.source IS NOT DISTINCT FROM g.source
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN coalesce(least(3.0::DOUBLE, (arg_max(rate, bits) FILTER (rate * bits <= 3) OVER (PARTITION BY source)) * bits), 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rated
  FROM levelled
), drawn AS (
  SELECT m.*, r.source_size, r.target, floor(rated) AS whole, rated - floor(rated) AS fraction
  FROM measured m JOIN rates r ON m.source IS NOT DISTINCT FROM r.source AND m.bits = r.bits
), ranked AS (
  SELECT *, CASE WHEN fraction > 0 AND size > 0 THEN (u / (1.0::DOUBLE - u)) / (fraction / (1.0::DOUBLE - fraction)) END AS q FROM drawn
), units AS (
  SELECT source, q, sum(size)::BIGINT AS size, max(size) AS one FROM ranked WHERE q IS NOT NULL GROUP BY ALL
), gap1 AS (
  SELECT source, any_value(target) - sum(words * floor(rated))::DOUBLE AS gap, 0.0::DOUBLE AS above, 'inf'::DOUBLE AS most FROM rates GROUP BY source
), {{passes}}
SELECT doc_id, size, source_size, target, (size * (whole + extra))::BIGINT AS taken, source, (whole + extra)::INT AS copies
FROM (SELECT *, CASE WHEN {{taken}} THEN 1 ELSE 0 END AS extra FROM ranked r {{joined}})
"""


def _op1_pass(n: int) -> str:
    """One pass of the documents that fit, in order of q, and what is missing after it."""
    return f"""run{n} AS (
  SELECT u.source, u.q, u.size, g.gap, sum(u.size) OVER (PARTITION BY u.source ORDER BY u.q ROWS UNBOUNDED PRECEDING) AS running
  FROM units u JOIN gap{n} g ON u.source IS NOT DISTINCT FROM g.source AND u.q > g.above AND u.one <= g.most
), end{n} AS (
  SELECT g.source, g.above, g.most, min(q) FILTER (running > r.gap) AS until, g.gap - coalesce(sum(size) FILTER (running <= r.gap), 0)::DOUBLE AS rest
  FROM gap{n} g LEFT JOIN run{n} r ON r.source IS NOT DISTINCT FROM g.source GROUP BY g.source, g.above, g.most, g.gap
), gap{n + 1} AS (SELECT source, rest AS gap, until AS above, rest AS most FROM end{n} WHERE until IS NOT NULL)"""


_PASSES = range(1, 5)
OP1 = _OP1.format(
    passes=", ".join(map(_op1_pass, _PASSES)),
    taken=" OR ".join(f"(r.q > e{n}.above AND r.size <= e{n}.most AND r.q < coalesce(e{n}.until, 'inf'::DOUBLE))" for n in _PASSES),
    joined=" ".join(f"LEFT JOIN end{n} e{n} ON r.source IS NOT DISTINCT FROM e{n}.source" for n in _PASSES),
)

OP2 = rf"""
WITH base AS (
  SELECT doc_id, source, text, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM base WHERE len(words) >= 3
), spelt AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w FROM windows
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM spelt) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM base WHERE text IS NOT NULL
), normal AS (
  SELECT doc_id, source, text, line, trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM lines
), counted AS (
  SELECT *, len(regexp_extract_all(norm, '[^ ]+')) AS n FROM normal
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM counted WHERE n > 0 GROUP BY doc_id
), freq AS (
  SELECT source, norm, count(DISTINCT text) AS texts FROM counted WHERE n > 0 GROUP BY ALL
), hosts AS (
  SELECT source, count(DISTINCT text) AS all_texts FROM base WHERE text IS NOT NULL GROUP BY source
), common AS (
  SELECT f.source, f.norm FROM freq f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE texts >= 25 AND texts >= 0.05 * all_texts
), removed AS (
  SELECT c.doc_id, sum(c.n) AS n FROM counted c JOIN common m ON c.norm = m.norm AND c.source IS NOT DISTINCT FROM m.source
  WHERE c.n > 0 GROUP BY c.doc_id
), told AS (
  SELECT b.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(d.n, 0)::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(r.n, 0)::BIGINT AS removed_words
  FROM base b LEFT JOIN dup d USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN removed r USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_words - removed_words < 0.3 * n_words) AS kept FROM told
"""

OP3 = """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), named AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM sized
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM named
"""

OP4 = rf"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(words[i : i + 4], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM base WHERE len(words) >= 5)
    UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM base WHERE len(words) BETWEEN 1 AND 4)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS node, a AS seen FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a
), named AS (
  SELECT node, min(seen) AS low FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, doc_id)::BIGINT AS component_id, coalesce(low, doc_id) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN named ON node = doc_id
"""

OP6 = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
    '<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS line,
    coalesce('r' || role, '-') || chr(31) || coalesce('t' || text, '-') AS spelt FROM turns
), prefixes AS (
  SELECT *, string_agg(spelt, chr(30)) OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS prefix,
    max(place) OVER (PARTITION BY conv_id) AS n_turns, sum(length(line)) OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) - length(line) AS before
  FROM placed
), ends AS (
  SELECT conv_id, n_turns, prefix FROM prefixes WHERE place = n_turns
), kept AS (
  SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies FROM ends e
  WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.place < p.n_turns AND p.prefix = e.prefix) GROUP BY n_turns, prefix
)
SELECT p.conv_id, k.n_turns, k.n_copies, (before // 1048576)::BIGINT AS part, string_agg(line, '' ORDER BY place) AS text
FROM prefixes p JOIN kept k USING (conv_id) GROUP BY ALL
"""

OP7 = rf"""
WITH items AS (
  SELECT item_id, words, least(len(words), 10)::BIGINT AS size FROM (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS words FROM benchmark)
  WHERE len(words) > 0
), item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i : i + size - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM items)
), docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS words FROM documents
), windows AS (
  SELECT doc_id, i, s.size, array_to_string(words[i : i + s.size - 1], ' ') AS w
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM items) WHERE len(words) >= size) s
), hits AS (
  SELECT DISTINCT doc_id, i, d.size, item_id FROM windows d JOIN item_windows t ON d.w = t.w AND d.size = t.size
), words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id
), placed AS (
  SELECT DISTINCT h.doc_id, h.item_id, h.i, j.j, h.size FROM hits h JOIN (
    SELECT item_id, unnest(range(1, len(words) - size + 2)) AS j, words, size FROM items) j ON j.item_id = h.item_id
  JOIN docs d ON d.doc_id = h.doc_id WHERE d.words[h.i : h.i + h.size - 1] = j.words[j.j : j.j + j.size - 1]
), longest AS (
  SELECT doc_id, max(n) AS longest FROM (SELECT doc_id, max(size) + count(*) - 1 AS n FROM (
    SELECT doc_id, item_id, i - j AS diagonal, size, i - row_number() OVER (PARTITION BY doc_id, item_id, i - j ORDER BY i) AS run FROM placed)
    GROUP BY doc_id, item_id, diagonal, run) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(w.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items,
  sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(w.n, 0) > 0 AS contaminated, coalesce(l.longest, 0)::BIGINT AS longest
FROM docs LEFT JOIN words_hit w USING (doc_id) LEFT JOIN found f USING (doc_id) LEFT JOIN longest l USING (doc_id)
"""

_LONG = "[A-Za-z\\x{C0}-\\x{FF}]+"

#: CRC-32 byte by byte, with its table made from the polynomial; near words share what is left when one code point is masked or left out.
OP12 = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '{_LONG}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS x FROM found WHERE length(run) >= 6 GROUP BY doc_id, run
), drawn AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM counted, crc
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n FROM drawn GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), places AS (
  SELECT word, n, unnest(range(length(word))) AS i FROM words
), masked AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM places
), pairs AS (
  SELECT a.word AS a, a.n AS n_a, b.word AS b, b.n AS n_b FROM masked a JOIN masked b ON a.i = b.i AND a.rest = b.rest AND a.word < b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM masked a JOIN words b ON a.rest = b.word
), near AS (
  SELECT a AS word, b AS other, n_b AS n FROM pairs UNION ALL SELECT b, a, n_a FROM pairs
), best AS (
  SELECT word, count(*)::BIGINT AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL SELECT f.word, r.root FROM forms f JOIN followed r ON f.form = r.word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN followed USING (word)
"""

ORACLE_SQL = {
    "op1_pareto_mix": OP1,
    "op2_line_frequency": OP2,
    "op3_transaction_assembly": OP3,
    "op4_chosen_path_join": OP4,
    "op6_snapshot_collapse": OP6,
    "op7_suffix_decontamination": OP7,
    "op12_spelling_variants": OP12,
}
