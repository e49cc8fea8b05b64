"""Named queries over the test tables: each applies operators of the library to whole tables, beside the same in SQL.

Stand-ins: html of ``pages`` is raw text, ``documents`` are full texts, turns of ``conversations`` are ordered lines with a level
by role, ``labels`` are sparse metadata and an earlier run's status, ``events`` are the log (user_id the document, event_type the
kind), ``embeddings`` are vectors.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import attempts, discovery, embedding, fragments, indexes, metrics, packing, structure
from textloom.plans import ingestion
from textloom.sources import files, parsers, sinks, upserts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None):
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- texts ---------------------------------------------------------------------------------------------------------

_S = r"[ \t\n\x0B\f\r\x1C-\x1F]"


def _clean(c: str) -> str:
    c = f"replace(replace(replace(regexp_replace({c}, '<[^>]+>', '', 'g'), '''', ', '), '（', '('), '）', ')')"
    for a, b in ((f"{_S}*/{_S}*", "/"), (rf"\({_S}+", "("), (rf"{_S}+\)", ")"), (f",{_S}+,", ",")):
        c = f"regexp_replace({c}, '{a}', '{b}', 'g')"
    return f"trim(regexp_replace(replace({c}, '－', '-'), '{_S}+', ' ', 'g'), ' ')"


@_query(f"SELECT page_id, {_clean('html')} AS cleaned FROM pages")
def clean_text_pages(t):
    return t("pages").select("page_id", X.clean(F.col("html")).alias("cleaned"))


@_query(f"""
WITH c AS (SELECT html, {_clean("html")} AS x FROM pages), m AS (SELECT length(x) AS n, (length(x) + 1) // 2 AS tokens, length(html) - length(replace(html, '|', '')) > 2 AS is_table FROM c)
SELECT CASE WHEN n < 10 THEN 'short' WHEN n <= 1500 THEN 'paragraph' WHEN n <= 14000 THEN 'long' ELSE 'over' END AS class, is_table,
  count(*)::BIGINT AS pages, sum(n)::BIGINT AS chars, sum(tokens)::BIGINT AS tokens, max(n)::INT AS longest FROM m GROUP BY ALL""")
def clean_page_classes(t):
    return ingestion.page_classes(t("pages"))


@_query("SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g'))::BIGINT AS n FROM pages")
def strip_tags_length(t):
    return t("pages").select("page_id", F.length(F.regexp_replace("html", "<[^>]+>", "")).cast("long").alias("n"))


@_query("SELECT doc_id, (length(text) - length(replace(text, '|', '')) > 2) AS is_table FROM documents")
def table_flag(t):
    return t("documents").select("doc_id", X.is_table(F.col("text")).alias("is_table"))


@_query("SELECT doc_id, ((length(text) + 1) // 2)::INT AS tokens FROM documents")
def token_estimate(t):
    return t("documents").select("doc_id", X.tokens(F.col("text")).alias("tokens"))


@_query(f"""SELECT doc_id, CASE WHEN length(x) <= 14000 THEN x ELSE '' END AS full_text, ((length(x) + 1) // 2)::INT AS token_count
FROM (SELECT doc_id, trim(regexp_replace(text, '{_S}+', ' ', 'g'), ' ') AS x FROM documents)""")
def fulltext_eligibility(t):
    rows = t("documents").select(F.col("doc_id").alias("doc"), F.lit(1).alias("chunk_seq"), "text")
    return fragments.full_texts(rows).withColumnRenamed("doc", "doc_id")


def _spelt(sql: str, boundary: str, keep: bool = True) -> str:
    """A list of stripped pieces that are not blank, in SQL; the mark is put after the boundary, as SQL's patterns do not look back."""
    mark = rf"regexp_replace({sql}, '({boundary})', '\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({mark}, chr(1)), lambda x: regexp_replace(x, '^{_S}+|{_S}+$', '', 'g')), lambda x: x <> '')"


@_query(f"SELECT doc_id, (i - 1)::INT AS sentence_index, s[i] AS sentence FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {_spelt('text', '[。！？.!?]')} AS s FROM documents)) WHERE length(s[i]) >= 2")
def sentences(t):
    rows = t("documents").select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("sentence_index", "sentence"))
    return rows.filter(F.length("sentence") >= X.MIN_SENTENCE)


@_query(f"""
WITH s AS (SELECT doc_id, CASE WHEN length(t) > 1500 THEN list_transform({_spelt("replace(t, '。', '。' || chr(10))", chr(10))}, lambda x: CASE WHEN x[-1] = '。' THEN x ELSE x || '。' END)
  ELSE [t] END AS s FROM (SELECT doc_id, replace(text, '. ', '。') AS t FROM documents))
SELECT doc_id, (i - 1)::INT AS at, s[i] AS piece FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM s)""")
def long_paragraph_split(t):
    text = F.replace("text", F.lit(". "), F.lit("。"))
    return t("documents").select("doc_id", F.posexplode(X.split_long(text)).alias("at", "piece"))


_SMALL = 400


@_query(f"""
WITH c AS (SELECT doc_id, text, unnest(range(0, greatest(length(text), 1), {_SMALL})) AS o FROM documents)
SELECT doc_id, (o // {_SMALL})::INT AS n, piece FROM (SELECT doc_id, o, regexp_replace(substr(text, o + 1, {_SMALL}), '^{_S}+|{_S}+$', '', 'g') AS piece FROM c) WHERE piece <> ''""")
def hard_cut(t):
    return t("documents").select("doc_id", F.posexplode(X.hard_cut(F.col("text"), _SMALL)).alias("n", "piece"))


def _cascade(size: int) -> str:
    parts = f"[regexp_replace(text, '^{_S}+|{_S}+$', '', 'g')]"
    for boundary in (r"\n\n", "[。！？.!?]", "[；;：:，,、]", _S):
        parts = f"flatten(list_transform({parts}, lambda p: CASE WHEN length(p) <= {size} THEN [p] ELSE {_spelt('p', boundary)} END))"
    windows = f"list_filter(list_transform(range(0, greatest(length(p), 1), {size}), lambda k: regexp_replace(substr(p, k + 1, {size}), '^{_S}+|{_S}+$', '', 'g')), lambda x: x <> '')"
    return f"flatten(list_transform({parts}, lambda p: CASE WHEN length(p) <= {size} THEN [p] ELSE {windows} END))"


@_query(f"""
WITH RECURSIVE p AS (SELECT doc_id, {_cascade(_SMALL)} AS parts FROM documents), l AS (SELECT doc_id, i, parts[i] AS x FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM p)),
g AS (
  SELECT doc_id, i, 0 AS n, length(x) AS used FROM l WHERE i = 1
  UNION ALL SELECT l.doc_id, l.i, CASE WHEN used + length(x) > {_SMALL} THEN n + 1 ELSE n END, CASE WHEN used + length(x) > {_SMALL} THEN length(x) ELSE used + length(x) END FROM g JOIN l ON l.doc_id = g.doc_id AND l.i = g.i + 1
)
SELECT doc_id, n::INT AS fragment_index, regexp_replace(string_agg(x, '' ORDER BY i), '^{_S}+|{_S}+$', '', 'g') AS fragment FROM g JOIN l USING (doc_id, i) GROUP BY doc_id, n""")
def safe_fragments(t):
    return t("documents").select("doc_id", F.posexplode(X.safe_fragments(F.col("text"), _SMALL)).alias("fragment_index", "fragment"))


@_query(f"""SELECT item_id, doc_id, CASE WHEN length(x) <= 14000 THEN x ELSE '' END AS both
FROM (SELECT item_id, doc_id, regexp_replace(coalesce(b.text, '') || ' ' || coalesce(d.text, ''), '^{_S}+|{_S}+$', '', 'g') AS x FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id)""")
def bilingual_concat(t):
    rows = t("documents").join(t("benchmark").select("item_id", F.col("text").alias("title")), F.col("item_id") == F.col("doc_id"), "left")
    return rows.select("item_id", "doc_id", fragments.two_languages(F.col("title"), F.col("text")).alias("both"))


_NAME = "'/data/' || source || '/temp_a1b2c3_' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.PDF' ELSE '.pdf' END"


def _named(docs: DataFrame) -> DataFrame:
    end = F.when(F.col("doc_id") % 2 == 0, ".PDF").otherwise(".pdf")
    return docs.withColumn("path", F.concat(F.lit("/data/"), F.col("source"), F.lit("/temp_a1b2c3_"), F.col("doc_id").cast("string"), end))


@_query(f"SELECT doc_id, doc_id::VARCHAR AS lngid, substr(sha256(substr({_NAME}, 7)), 1, 20) AS key FROM documents")
def doc_keys(t):
    rows = _named(t("documents"))
    return discovery.identified(rows, root="/data").join(rows.select("path", "doc_id"), "path").select("doc_id", "lngid", "key")


# --- structure -----------------------------------------------------------------------------------------------------


@_query(f"""SELECT doc_id, (i - 1)::INT AS pos, l[i] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
WHERE regexp_replace(l[i], '^{_S}+|{_S}+$', '', 'g') <> ''""")
def line_explode(t):
    return structure.lines(t("documents"), "doc_id", "text").withColumnRenamed("doc", "doc_id")


@_query(f"""SELECT count(*)::BIGINT AS lines, min(length(line))::INT AS shortest, max(length(line))::INT AS longest, sum(length(line))::BIGINT AS chars
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_replace(line, '^{_S}+|{_S}+$', '', 'g') <> ''""")
def nonblank_line_stats(t):
    n = F.length("line")
    return structure.lines(t("documents"), "doc_id", "text").agg(F.count(F.lit(1)).alias("lines"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.sum(n.cast("long")).alias("chars"))


_WORDS = ["Methods ( a / b )", "Results", "Author's introduction", "Latest <i>news</i>", "References", "Appendix , , A", "Related work", "Conclusion"]
_TITLES = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in _WORDS) + "]"


def _title(place):
    return F.element_at(F.array(*map(F.lit, _WORDS)), (place % len(_WORDS) + 1).cast("int"))


def _turns(t) -> DataFrame:
    """Turns as lines of Markdown: a heading of the role's level, with a title in turn, and a page tag on every third turn."""
    level = F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2).otherwise(3)
    tag = F.when(F.col("turn") % 3 == 0, F.concat(F.lit(" (p."), F.col("turn").cast("string"), F.lit(")"))).otherwise("")
    line = F.concat(F.repeat(F.lit("#"), level), F.lit(" "), _title(F.col("conv_id") + F.col("turn")), tag)
    return t("conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("pos"), line.alias("line"), "text")


_TURNS = f"""turns AS (
  SELECT conv_id, turn, text, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 END AS level, {_TITLES}[(conv_id + turn) % {len(_WORDS)} + 1] AS title FROM conversations
)"""


@_query(f"WITH {_TURNS} SELECT conv_id, turn, level::INT AS level, {_clean('title')} AS title, CASE WHEN turn % 3 = 0 THEN turn ELSE 1 END::INT AS page_num FROM turns")
def heading_lines(t):
    rows = structure.headings(_turns(t))
    return rows.select(F.col("doc").alias("conv_id"), F.col("pos").alias("turn"), "level", "title", "page_num")


_UP = f"""WITH {_TURNS}, last AS (
  SELECT *, max(CASE WHEN level = 1 THEN turn END) OVER w AS a, max(CASE WHEN level = 2 THEN turn END) OVER w AS b, max(CASE WHEN level = 3 THEN turn END) OVER w AS c
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)
), up AS (
  SELECT conv_id, turn, level, list_filter([a, CASE WHEN b > coalesce(a, -1) THEN b END, CASE WHEN c > coalesce(a, -1) AND c > coalesce(b, -1) THEN c END], lambda x: x IS NOT NULL) AS up FROM last
)"""


@_query(f"""{_UP} SELECT u.conv_id, u.turn, string_agg({_clean("t.title")}, ' > ' ORDER BY t.turn) AS path, count(*)::INT AS depth
FROM (SELECT conv_id, turn, unnest(up) AS at FROM up) u JOIN turns t ON t.conv_id = u.conv_id AND t.turn = u.at GROUP BY ALL""")
def section_ancestors(t):
    rows = structure.headings(_turns(t))
    rows = structure.enclosing(rows, title=F.col("title"))
    return rows.select(F.col("doc").alias("conv_id"), F.col("pos").alias("turn"), structure.path_of(F.col("up")).alias("path"), F.size("up").alias("depth"))


@_query(f"{_UP} SELECT len(up)::INT AS depth, level::INT AS level, count(*)::BIGINT AS sections FROM up GROUP BY ALL")
def section_depth_hist(t):
    rows = structure.enclosing(structure.headings(_turns(t)), title=F.col("title"))
    return rows.groupBy(F.size("up").alias("depth"), "level").agg(F.count(F.lit(1)).alias("sections"))


def _markdown(t) -> DataFrame:
    """Each conversation as one Markdown document: a heading for each turn, with its text below; every turn under a title of references is an entry."""
    entry = F.concat(F.lit("["), (F.col("pos") + 1).cast("string"), F.lit("] "), F.translate("text", "[]", "  "), F.lit("."))
    rows = _turns(t).withColumn("part", F.concat("line", F.lit("\n"), F.when(F.col("line").contains("References"), entry).otherwise(F.col("text"))))
    told = F.array_sort(F.collect_list(F.struct("pos", "part")))
    return rows.groupBy(F.col("doc").cast("string").alias("doc")).agg(F.array_join(F.transform(told, lambda x: x["part"]), "\n").alias("markdown"))


def _case(c: str, pairs, value, other: str) -> str:
    test = lambda words: " OR ".join(f"contains({c}, '{w}')" for w in words)
    return "CASE " + " ".join(f"WHEN {test(words)} THEN {value(name)}" for name, words in pairs) + f" ELSE {other} END"


_STRIP = f"'^{_S}+|{_S}+$', '', 'g'"
_LINES = f"list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, {_STRIP}) <> '')"
_ENTRY = "'[' || (turn + 1) || '] ' || translate(text, '[]', '  ') || '.'"
_WRITTEN = f"""written AS (
  SELECT * REPLACE (CASE WHEN title = 'References' THEN {_ENTRY} ELSE text END AS text) FROM turns
), contents AS (
  SELECT conv_id, turn, level, title, regexp_replace(array_to_string({_LINES}, chr(10)), {_STRIP}) AS content FROM written
)"""
_CONTENT = f"{_TURNS}, {_WRITTEN}"


@_query(f"WITH {_CONTENT} SELECT conv_id::VARCHAR AS doc, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS n, content FROM contents")
def section_content(t):
    rows = structure.sections(structure.headings(structure.lines(_markdown(t))))
    return rows.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("pos")).alias("n"), "content")


_CHUNKS = f"""{_UP}, {_WRITTEN}, marked AS (
  SELECT conv_id, turn, level, content, title = 'References' AS refs, CASE WHEN turn % 3 = 0 THEN turn ELSE 1 END AS page_num, {_case("lower(t)", structure.SPECIAL, lambda n: f"'[{n}] ' || t", "t")} AS title
  FROM (SELECT *, {_clean("title")} AS t FROM contents)
), paths AS (
  SELECT u.conv_id, u.turn, string_agg(m.title, ' > ' ORDER BY m.turn) AS path, bool_or(m.refs AND m.turn < u.turn) AS below
  FROM (SELECT conv_id, turn, unnest(up) AS at FROM up) u JOIN marked m ON m.conv_id = u.conv_id AND m.turn = u.at GROUP BY ALL
), sections AS (
  SELECT m.*, p.path, length(content) - length(replace(content, '|', '')) > 2 AS is_table FROM marked m JOIN paths p USING (conv_id, turn) WHERE NOT p.below
), cleaned AS (
  SELECT *, CASE WHEN refs THEN trim(regexp_replace(content, '{_S}+', ' ', 'g'), ' ') WHEN is_table THEN content ELSE {_clean("content")} END AS x FROM sections WHERE refs OR length(content) >= 10
), cut AS (
  SELECT *, CASE WHEN NOT refs AND length(x) > 1500 THEN list_transform({_spelt("replace(x, '。', '。' || chr(10))", chr(10))}, lambda y: CASE WHEN y[-1] = '。' THEN y ELSE y || '。' END) ELSE [x] END AS parts FROM cleaned
), pieces AS (
  SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM cut
), numbered AS (
  SELECT conv_id::VARCHAR AS doc, path, refs, level, page_num, is_table, parts[k] AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, k) - 1 AS seq FROM pieces
), chunks AS (
  SELECT substr(md5(doc || '_' || path || CASE WHEN refs THEN '_ref_' ELSE '_' END || seq), 1, 16) AS id, text, doc, page_num::INT AS page_num, (seq + 1)::INT AS chunk_seq,
    CASE WHEN refs THEN '{structure.ENTRY}' ELSE {_case("lower(path)", structure.TYPES, lambda n: f"'{n}'", f"'{structure.BODY}'")} END AS element_type, path AS section_path,
    CASE WHEN refs THEN 0 ELSE level END::INT AS text_level, CASE WHEN NOT refs THEN is_table END AS is_table, refs AS is_reference FROM numbered
)"""


@_query(f"{_CHUNKS} SELECT * FROM chunks")
def chunks(t):
    return structure.chunks(_markdown(t))


@_query(f"{_CHUNKS} SELECT doc, count(*)::BIGINT AS chunks, sum(length(text))::BIGINT AS chars FROM chunks GROUP BY doc")
def short_chunk_totals(t):
    """The chunks of every document, whatever their length."""
    return structure.chunks(_markdown(t)).groupBy("doc").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.length("text").cast("long")).alias("chars"))


@_query(f"SELECT conv_id, turn, turn::INT AS page_num, {_clean('title')} AS title FROM (SELECT *, {_TITLES}[turn % {len(_WORDS)} + 1] AS title FROM conversations)")
def page_tag_extract(t):
    line = F.concat(F.lit("# "), _title(F.col("turn")), F.lit(" (p."), F.col("turn").cast("string"), F.lit(")"))
    rows = structure.headings(t("conversations").select("conv_id", "turn", line.alias("line")))
    return rows.select("conv_id", "turn", "page_num", "title")


_NAMES = ["Methods", "Results", "Introduction", "Latest news", "References", "Appendix", "Related work", "Conclusion"]
_PATHS = "[" + ", ".join(f"'{w}'" for w in _NAMES) + "]"


def _titled(t) -> DataFrame:
    words = F.array(*map(F.lit, _NAMES))
    return t("conversations").withColumn("path", F.concat_ws(" > ", F.element_at(words, (F.col("conv_id") % 8 + 1).cast("int")), F.element_at(words, (F.col("turn") % 8 + 1).cast("int"))))


@_query(f"""SELECT conv_id, turn, {_case("lower(path)", structure.TYPES, lambda n: f"'{n}'", "'正文'")} AS section_type
FROM (SELECT conv_id, turn, {_PATHS}[conv_id % 8 + 1] || ' > ' || {_PATHS}[turn % 8 + 1] AS path FROM conversations)""")
def section_type_map(t):
    return _titled(t).select("conv_id", "turn", structure.section_type(F.col("path")).alias("section_type"))


@_query(f"""SELECT conv_id, turn, {_case("lower(path)", structure.SPECIAL, lambda n: f"'[{n}] ' || path", "path")} AS title
FROM (SELECT conv_id, turn, {_PATHS}[conv_id % 8 + 1] || ' > ' || {_PATHS}[turn % 8 + 1] AS path FROM conversations)""")
def special_section_mark(t):
    return _titled(t).select("conv_id", "turn", structure.special_mark(F.col("path")).alias("title"))


_REFERENCE = "'[' || (turn + 1) || '] ' || translate(text, '[]', '  ') || CASE WHEN turn % 4 = 3 THEN ' [J].' ELSE '.' END"


@_query(f"""
WITH l AS (SELECT conv_id, string_agg({_REFERENCE}, chr(10) ORDER BY turn) AS content FROM conversations GROUP BY conv_id),
m AS (SELECT conv_id, string_split(regexp_replace(content, '(\\[[0-9]+\\])', chr(1) || '\\1', 'g'), chr(1)) AS parts FROM l),
e AS (SELECT conv_id, i, trim(regexp_replace(parts[i], '{_S}+', ' ', 'g'), ' ') AS entry FROM (SELECT conv_id, parts, unnest(range(2, len(parts) + 1)) AS i FROM m))
SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1)::INT AS at, entry FROM e WHERE NOT contains(substr(entry, 2), '[')""")
def reference_entries(t):
    """Whole turns as entries; those with a [J] are none."""
    end = F.when(F.col("turn") % 4 == 3, " [J].").otherwise(".")
    line = F.concat(F.lit("["), (F.col("turn") + 1).cast("string"), F.lit("] "), F.translate("text", "[]", "  "), end)
    told = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"))))
    rows = t("conversations").groupBy("conv_id").agg(F.array_join(F.transform(told, lambda x: x["line"]), "\n").alias("content"))
    return rows.select("conv_id", F.posexplode(structure.reference_entries(F.col("content"))).alias("at", "entry"))


@_query(f"""
SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS at,
  '[' || (turn + 1) || '] ' || trim(regexp_replace(translate(text, '[]', '  ') || ' [J]. See [' || (turn // 2 + 1) || '] and [99].', '{_S}+', ' ', 'g'), ' ') AS entry FROM conversations""")
def reference_entries_strict(t):
    """Whole turns as entries that have a [J] and cite others, each on lines of its own."""
    cited = F.concat(F.lit(" [J]. See ["), (F.floor(F.col("turn") / 2) + 1).cast("string"), F.lit("] and [99]."))
    line = F.concat(F.lit("["), (F.col("turn") + 1).cast("string"), F.lit("] "), F.translate("text", "[]", "  "), cited)
    told = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"))))
    rows = t("conversations").groupBy("conv_id").agg(F.array_join(F.transform(told, lambda x: x["line"]), "\n").alias("content"))
    return rows.select("conv_id", F.posexplode(structure.strict_entries(F.col("content"))).alias("at", "entry"))


_SPACED = "replace(translate(text, '#', ' '), '. ', '.' || chr(10) || chr(10))"


@_query(f"""
WITH l AS (SELECT doc_id, i, l[i] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split({_SPACED}, chr(10)) AS l FROM documents))),
own AS (SELECT *, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 1 AS gap FROM l WHERE regexp_replace(line, {_STRIP}) <> ''),
c AS (SELECT doc_id, regexp_replace(string_agg(CASE WHEN gap THEN chr(10) ELSE '' END || line, chr(10) ORDER BY i), {_STRIP}) AS content FROM own GROUP BY doc_id),
p AS (SELECT doc_id, unnest(list_transform(string_split(content, chr(10) || chr(10)), lambda x: regexp_replace(x, {_STRIP}))) AS p FROM c)
SELECT doc_id::VARCHAR AS doc, count(*)::BIGINT AS paragraphs, sum(length({_clean("p")}))::BIGINT AS chars, max(length({_clean("p")}))::INT AS longest FROM p
WHERE length(p) >= 10 AND length(p) - length(replace(p, '|', '')) <= 2 AND length({_clean("p")}) <= 1500 GROUP BY doc_id""")
def blank_line_paragraphs(t):
    """Documents as one section each, with a blank line after each sentence; tables and paragraphs that would be cut are left to other queries."""
    spaced = F.replace(F.translate("text", "#", " "), F.lit(". "), F.lit(".\n\n"))
    docs = t("documents").select(F.col("doc_id").cast("string").alias("doc"), F.concat(F.lit("# Whole\n"), spaced).alias("markdown"))
    found = structure.sections(structure.headings(structure.lines(docs)), blank_lines=True)
    parts = F.filter(F.transform(F.split("content", "\n\n"), X.strip), lambda p: (F.length(p) >= X.MIN_PARAGRAPH) & ~X.is_table(p))
    # lengths come out of the explosion, so that no filter or sum cleans a paragraph again
    rows = found.select("doc", F.explode(F.transform(parts, lambda p: F.length(X.clean(p)))).alias("n"))
    return rows.filter(F.col("n") <= X.MAX_PARAGRAPH).groupBy("doc").agg(F.count(F.lit(1)).alias("paragraphs"), F.sum(F.col("n").cast("long")).alias("chars"), F.max("n").alias("longest"))


@_query("""SELECT conv_id, turn, substr(md5(conv_id || '_' || path || '_' || (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)), 1, 16) AS id
FROM (SELECT conv_id, turn, role || ' > ' || turn AS path FROM conversations)""")
def chunk_ids(t):
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    path = F.concat(F.col("role"), F.lit(" > "), F.col("turn").cast("string"))
    return t("conversations").select("conv_id", "turn", X.chunk_id(F.col("conv_id"), path, place).alias("id"))


def _as_markdown(t) -> DataFrame:
    """Whole documents with every line that is not blank marked by up to five # (its length modulo 6), so that lines of one to four become
    headings and the others text below them, and by a page tag on every other line."""
    tag = lambda i: F.when(i % 2 == 0, F.concat(F.lit(" (p."), (i + 1).cast("string"), F.lit(")"))).otherwise("")
    marked = lambda x, i: F.when(X.strip(x) == "", x).otherwise(F.concat(F.repeat(F.lit("#"), F.length(x) % 6), F.lit(" "), x, tag(i)))
    lines = F.transform(F.split(F.translate("text", "#", " "), "\n", -1), marked)
    return t("documents").select(F.col("doc_id").alias("doc"), F.array_join(lines, "\n").alias("markdown"))


_MARKED = f"""raw AS (
  SELECT doc_id, i - 1 AS pos, l[i] AS line, length(l[i]) % 6 AS n FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(translate(text, '#', ' '), chr(10)) AS l FROM documents))
), marked AS (
  SELECT doc_id, pos, CASE WHEN n BETWEEN 1 AND 4 THEN n END AS level, {_clean("line")} AS title, CASE WHEN pos % 2 = 0 THEN pos + 1 ELSE 1 END AS page_num,
    repeat('#', n) || ' ' || line || CASE WHEN pos % 2 = 0 THEN ' (p.' || (pos + 1) || ')' ELSE '' END AS written FROM raw WHERE regexp_replace(line, {_STRIP}) <> ''
)"""


@_query(f"WITH {_MARKED} SELECT doc_id, pos::INT AS pos, level::INT AS level, title, page_num::INT AS page_num FROM marked WHERE level IS NOT NULL")
def document_headings(t):
    rows = structure.headings(structure.lines(_as_markdown(t))).filter("level IS NOT NULL")
    return rows.select(F.col("doc").alias("doc_id"), "pos", "level", "title", "page_num")


_K = ("a", "b", "c", "d")
_LIVE = ", ".join(f"CASE WHEN {' AND '.join([f'{k} IS NOT NULL', *[f'{k} > coalesce({j}, -1)' for j in _K[:n]]])} THEN {k} END" for n, k in enumerate(_K))


@_query(f"""WITH {_MARKED}, heads AS (
  SELECT *, {_case("lower(title)", structure.SPECIAL, lambda n: f"'[{n}] ' || title", "title")} AS special, {", ".join(f"max(CASE WHEN level = {n} THEN pos END) OVER w AS {k}" for n, k in enumerate(_K, 1))}
  FROM marked WHERE level IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
), up AS (
  SELECT doc_id, pos, unnest(list_filter([{_LIVE}], lambda x: x IS NOT NULL)) AS at FROM heads
), paths AS (
  SELECT u.doc_id, u.pos, string_agg(h.special, ' > ' ORDER BY h.pos) AS path, count(*) AS depth FROM up u JOIN heads h ON h.doc_id = u.doc_id AND h.pos = u.at GROUP BY ALL
), own AS (
  SELECT doc_id, pos, level, written, max(CASE WHEN level IS NOT NULL THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS section FROM marked
), contents AS (
  SELECT doc_id, section AS pos, regexp_replace(coalesce(string_agg(written, chr(10) ORDER BY pos) FILTER (level IS NULL), ''), {_STRIP}) AS content FROM own WHERE section IS NOT NULL GROUP BY doc_id, section
)
SELECT h.doc_id, h.pos::INT AS pos, depth::INT AS depth, page_num::INT AS page_num, special AS title, md5(path) AS path_hash, {_case("lower(path)", structure.TYPES, lambda n: f"'{n}'", f"'{structure.BODY}'")} AS section_type,
  md5(content) AS content_hash, length(content)::INT AS n_chars FROM heads h JOIN paths USING (doc_id, pos) JOIN contents USING (doc_id, pos)""")
def document_sections(t):
    """The sections of whole documents: where they stand in the tree, what kind they are, and their own text."""
    rows = structure.sections(structure.headings(structure.lines(_as_markdown(t))))
    kind = structure.section_type(F.col("path"))
    return rows.select(F.col("doc").alias("doc_id"), "pos", F.size("up").alias("depth"), "page_num", "title", F.md5("path").alias("path_hash"), kind.alias("section_type"), F.md5("content").alias("content_hash"), F.length("content").alias("n_chars"))


_PREFIXES = ["摘 要：", "结果", "", "3.2讨论", "参考\t文献 "]


@_query(f"""WITH raw AS (SELECT doc_id, i - 1 AS pos, l[i] AS line, ['摘 要：', '结果', '', '3.2讨论', '参考' || chr(9) || '文献 '][(i - 1) % 5 + 1] AS prefix
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(translate(text, '#', ' '), chr(10)) AS l FROM documents)))
SELECT doc_id, pos::INT AS pos, 2::INT AS level, 1::INT AS page_num, regexp_replace(prefix || line, {_STRIP}) AS title FROM raw
WHERE regexp_replace(line, {_STRIP}) <> '' AND prefix <> '' AND length(regexp_replace(prefix || line, '{_S}+', '', 'g')) < 50""")
def keyword_headings(t):
    """Lines of whole documents behind words that make a short line a heading; white space does not count."""
    prefix = F.element_at(F.array(*map(F.lit, _PREFIXES)), F.col("pos") % 5 + 1)
    rows = structure.lines(t("documents").withColumn("text", F.translate("text", "#", " ")), "doc_id", "text").withColumn("line", F.concat(prefix, F.col("line")))
    return structure.headings(rows).filter("level IS NOT NULL").select(F.col("doc").alias("doc_id"), "pos", "level", "page_num", "title")


@_query(f"""WITH d AS (SELECT doc_id, translate(text, '#', ' ') AS t FROM documents),
c AS (SELECT doc_id, regexp_replace(array_to_string(list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, {_STRIP}) <> ''), chr(10)), {_STRIP}) AS content FROM d)
SELECT doc_id::VARCHAR AS doc, CASE WHEN doc_id % 3 = 2 OR doc_id % 3 = 1 AND content = '' THEN 'empty Markdown' ELSE 'no chunk' END AS error FROM c WHERE doc_id % 3 <> 0 OR length(content) < 10""")
def documents_without_chunks(t):
    """Documents with a heading, without one, and blank ones: those of which nothing can be made, and why."""
    third = F.col("doc_id") % 3
    text = F.translate("text", "#", " ")
    docs = t("documents").select(F.col("doc_id").cast("string").alias("doc"), F.when(third == 0, F.concat(F.lit("# Title\n"), text)).when(third == 1, text).otherwise(" \n\t").alias("markdown"))
    return structure.without_chunks(docs, structure.chunks(docs), "doc", "markdown")


@_query("SELECT (role = 'assistant') AS reference, count(*)::BIGINT AS n, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY ALL")
def ref_para_partition(t):
    kind = F.when(F.col("role") == "assistant", structure.ENTRY).otherwise(structure.BODY)
    rows = t("conversations").withColumn("reference", fragments.is_reference(kind, F.lit("")))
    return rows.groupBy("reference").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text").cast("long")).alias("chars"))


# --- discovery and status ------------------------------------------------------------------------------------------


def _status(t) -> DataFrame:
    """``labels`` as the status of an earlier run: good ones are done, the others have failed once or, if toxic, twice."""
    failed = F.when(F.col("quality") == 1, "success").otherwise("failure")
    return t("labels").select(F.col("doc_id").cast("string").alias("lngid"), failed.alias("status"), (F.col("toxic") + 1).cast("int").alias("attempt"))


_STATUS = "status AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'success' ELSE 'failure' END AS status, toxic + 1 AS attempt FROM labels)"


def _tasks(t) -> DataFrame:
    return discovery.identified(_named(t("documents")), root="/data")


@_query("""SELECT doc_id::VARCHAR AS lngid, CASE WHEN quality = 1 THEN 'success' ELSE 'failure' END AS status, (toxic + 1)::INT AS attempt FROM labels
WHERE doc_id % 7 <> 3 AND doc_id % 11 <> 5 AND doc_id % 13 <> 1""")
def status_lines(t):
    """A log with lines that are cut off, that name no document, and blank ones."""
    told = F.to_json(F.struct(F.col("doc_id").cast("string").alias("lngid"), F.when(F.col("quality") == 1, "success").otherwise("failure").alias("status"), (F.col("toxic") + 1).alias("attempt"), F.array("quality").alias("other")))
    line = F.when(F.col("doc_id") % 7 == 3, F.substring(told, 1, 20)).when(F.col("doc_id") % 11 == 5, '{"status":"failure","attempt":1}').when(F.col("doc_id") % 13 == 1, " ").otherwise(told)
    return files.records(t("labels").select(line.alias("value"))).select("lngid", "status", "attempt")


def _only_whole(content: bytes) -> str:
    """A stand-in for a parser: pages whose article does not end are broken, of the others the text after it counts."""
    head, end, rest = content.decode().partition("</article>")
    if not end:
        raise ValueError("no end of the article")
    return "" if rest.startswith("<footer>") and len(rest) % 2 else head


@_query("""WITH p AS (SELECT page_id, html, strpos(html, '</article>') AS ends FROM pages), q AS (SELECT *, substr(html, ends + 10) AS rest, substr(html, 1, ends - 1) AS head FROM p)
SELECT page_id, CASE WHEN ends = 0 THEN 'ValueError: no end of the article' WHEN starts_with(rest, '<footer>') AND length(rest) % 2 = 1 OR trim(head) = '' THEN 'empty Markdown' END AS error,
  CASE WHEN ends > 0 AND NOT (starts_with(rest, '<footer>') AND length(rest) % 2 = 1 OR trim(head) = '') THEN md5(head) END AS hash, 'cpu' AS device FROM q""")
def parsed_pages(t):
    """Pages as files: those that a parser fails on, and those that it makes nothing of, are rows with an error."""
    rows = files.parsed(t("pages").select("page_id", F.col("html").cast("binary").alias("content")), _only_whole)
    return rows.select("page_id", "error", F.md5("markdown").alias("hash"), "device")


_BROKEN = """p AS (SELECT page_id, url, html, strpos(html, '</article>') AS ends FROM pages), q AS (SELECT *, substr(html, ends + 10) AS rest, substr(html, 1, ends - 1) AS head FROM p),
read AS (SELECT *, CASE WHEN ends = 0 THEN 'ValueError: no end of the article' WHEN starts_with(rest, '<footer>') AND length(rest) % 2 = 1 OR trim(head) = '' THEN 'empty Markdown' END AS error FROM q)"""


def _three(content: bytes) -> parsers.Output:
    """:func:`_only_whole` as a parser with three outputs."""
    text = _only_whole(content)
    return parsers.Output(text, json.dumps([{"type": "text", "n": len(text)}]), json.dumps({"pdf_info": [len(content)]}))


def _converted(t) -> DataFrame:
    return files.parsed(t("pages").select(F.col("page_id").cast("string").alias("stem"), F.col("url").alias("pdf_path"), F.col("html").cast("binary").alias("content")), _three)


@_query(f"""WITH {_BROKEN} SELECT page_id::VARCHAR AS stem, md5(head) AS hash, '[{{"type": "text", "n": ' || length(head) || '}}]' AS content_list, '{{"pdf_info": [' || strlen(html) || ']}}' AS middle FROM read WHERE error IS NULL""")
def converted_outputs(t):
    """Pages converted to three outputs, each of which is a table of its own, and these read again."""
    spark = t("pages").sparkSession
    folder = sinks.scratch_folder(spark)
    sinks.write_triple(_converted(t).filter("error IS NULL"), folder)
    of = {c: spark.read.parquet(f"{folder}/{c}").withColumnRenamed("value", c) for c in ("markdown", "content_list", "middle")}
    return of["markdown"].join(of["content_list"], "stem").join(of["middle"], "stem").select("stem", F.md5("markdown").alias("hash"), "content_list", "middle")


@_query(f"WITH {_BROKEN} SELECT page_id::VARCHAR AS stem, error, CASE WHEN ends = 0 THEN 'ValueError: no end of the article' END AS raised FROM read WHERE error IS NOT NULL")
def error_details(t):
    """What failed, appended to the log of errors with its traceback, and read again."""
    spark = t("pages").sparkSession
    folder = sinks.scratch_folder(spark)
    sinks.append_errors(_converted(t).select("stem", "pdf_path", "error", "traceback"), f"{folder}/errors")
    rows = spark.read.schema("stem string, pdf_path string, error string, traceback string").json(f"{folder}/errors")
    return rows.select("stem", "error", F.regexp_extract(F.rtrim("traceback"), r"([^\n]*)\s*$", 1).alias("raised"))


@_query(f"WITH {_BROKEN} SELECT url AS pdf_path, error FROM read WHERE error IS NOT NULL")
def failed_list(t):
    """The failed files as a path, a tab and a message each, and these read again."""
    spark = t("pages").sparkSession
    folder = sinks.scratch_folder(spark)
    sinks.write_failed(_converted(t).filter("error IS NOT NULL"), f"{folder}/failed")
    return spark.read.option("sep", "\t").schema("pdf_path string, error string").csv(f"{folder}/failed")


def _picky(texts: list[str]) -> list[list[float]]:
    """A stand-in for a model: over 20 texts at once are too many, and texts with a pipe are refused."""
    if len(texts) > 20:
        raise RuntimeError("413")
    if any("|" in x for x in texts):
        raise RuntimeError("refused")
    return embedding.hashed(texts)


@_query("""SELECT doc_id, CASE WHEN contains(text, '|') THEN 'refused' END AS vector_error, CASE WHEN NOT contains(text, '|') AND trim(text) <> '' THEN 8 END::INT AS size,
  CASE WHEN NOT contains(text, '|') AND trim(text) <> '' THEN ('0x' || substr(sha256(text), 1, 2))::INT END AS first FROM documents""")
def embedded_texts(t):
    """Whole documents through a model that has its limits: batches shrink, and a text that is refused takes no other along."""
    rows = embedding.embedded(t("documents").select("doc_id", "text"), _picky)
    return rows.select("doc_id", "vector_error", F.size("vector").alias("size"), F.round(F.get("vector", F.lit(0)) * 255).cast("int").alias("first")).withColumn("size", F.when(F.col("size") >= 0, F.col("size")))


@_query("SELECT d.doc_id, coalesce(quality, -1)::INT AS quality, coalesce(toxic, 0)::INT AS toxic FROM documents d LEFT JOIN labels USING (doc_id)")
def meta_left_join(t):
    rows = indexes.with_lookup(t("documents").select("doc_id"), t("labels"), "doc_id", "doc_id", {"quality": -1, "toxic": 0})
    return rows.select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))


@_query(f"WITH {_STATUS} SELECT doc_id::VARCHAR AS lngid FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM status WHERE status = 'success')")
def skip_done_anti(t):
    return discovery.without_done(_tasks(t), _status(t)).select("lngid")


@_query(f"WITH {_STATUS} SELECT doc_id::VARCHAR AS lngid FROM documents WHERE doc_id IN (SELECT doc_id FROM status WHERE status = 'success')")
def done_semi(t):
    return discovery.done(_tasks(t), _status(t)).select("lngid")


@_query(f"WITH {_STATUS} SELECT doc_id::VARCHAR AS lngid FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM status WHERE status = 'failure' AND attempt >= 2)")
def attempts_exhausted(t):
    return discovery.without_exhausted(_tasks(t), _status(t)).select("lngid")


@_query(f"WITH {_STATUS} SELECT doc_id::VARCHAR AS lngid, (coalesce(attempt, 0) + 1)::INT AS attempt FROM documents LEFT JOIN (SELECT * FROM status WHERE status = 'failure') USING (doc_id)")
def attempt_carry_over(t):
    return discovery.with_attempt(_tasks(t), _status(t)).select("lngid", "attempt")


@_query(f"""WITH {_STATUS} SELECT {_NAME} AS path, doc_id::VARCHAR AS lngid, (coalesce(attempt, 0) + 1)::INT AS attempt FROM documents LEFT JOIN status USING (doc_id)
WHERE status IS NULL OR status = 'failure' AND attempt < 2 ORDER BY path LIMIT 100""")
def limit_by_path(t):
    return discovery.tasks(_named(t("documents")), _status(t), limit=100, root="/data").select("path", "lngid", "attempt")


@_query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def last_status(t):
    return discovery.last_status(t("events"), "user_id", ("ts", "event_id")).select("user_id", "event_type", "value")


@_query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def dedupe_first(t):
    return discovery.first_of_each(t("documents").select("doc_id", "source", F.sha2("text", 256).alias("hash")), "hash", "doc_id").select("doc_id", "source")


@_query("""SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'click')::INT DESC, event_id)::INT AS place FROM events""")
def retry_first_order(t):
    return discovery.retry_first(t("events"), F.col("event_type") == "click", ("event_id",), ("user_id",), F.floor(F.col("event_id") / 10_000)).select("user_id", "event_id", "place")


@_query("SELECT doc_id, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) % 3)::INT AS slot FROM documents")
def round_robin(t):
    return discovery.in_turn(t("documents"), 3, "doc_id", F.floor(F.col("doc_id") / 10_000), ("source",)).select("doc_id", "slot")


@_query("SELECT DISTINCT regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') AS stem FROM pages")
def processed_stems(t):
    return files.stems(t("pages"), "url")


@_query("""SELECT user_id, event_id, event_type, greatest(count(*) OVER (PARTITION BY user_id) - 5, 0)::BIGINT AS more FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 5""")
def first_errors_topn(t):
    rows = discovery.first_and_more(t("events"), "user_id", (F.col("value").desc(), "event_id"))
    return rows.select("user_id", "event_id", "event_type", "more")


@_query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def events_json(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


# --- metrics -------------------------------------------------------------------------------------------------------


@_query("""SELECT event_id, event_type, round(CASE WHEN n > 1 AND s > 0 THEN (n - 1) / s * 3600 ELSE 0 END, 6) AS rate FROM (
  SELECT event_id, event_type, count(*) OVER w AS n, (epoch_us(ts) - epoch_us(min(ts) OVER w)) / 1e6 AS s FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 100 PRECEDING))""")
def moving_rate(t):
    return metrics.moving_rate(t("events"), "event_type").select("event_id", "event_type", F.round("rate", 6).alias("rate"))


@_query("""SELECT event_type, count(*)::BIGINT AS n, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS seconds,
  round(CASE WHEN max(ts) > min(ts) THEN count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) * 3600 ELSE 0 END, 6) AS rate FROM events GROUP BY event_type""")
def avg_rate(t):
    return metrics.average_rate(t("events"), "event_type").select("event_type", "n", F.round("seconds", 6).alias("seconds"), F.round("rate", 6).alias("rate"))


@_query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 21600000000 THEN 0 ELSE 1 END AS far FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(far) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM g),
c AS (SELECT *, row_number() OVER (PARTITION BY user_id, streak ORDER BY ts, event_id) - 1 AS crash_count FROM s)
SELECT event_id, user_id, crash_count::INT AS crash_count, max(crash_count > 3) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS disabled FROM c""")
def crash_streaks(t):
    return metrics.crash_streaks(t("events"), "user_id", gap=21600, unit="day").select("event_id", "user_id", "crash_count", "disabled")


@_query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 300000000 THEN 0 ELSE 1 END AS far FROM events WHERE event_type = 'error' WINDOW w AS (ORDER BY ts, event_id)),
s AS (SELECT *, sum(far) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM g),
c AS (SELECT *, row_number() OVER (PARTITION BY streak ORDER BY ts, event_id) - 1 AS crash_count FROM s)
SELECT event_id, crash_count::INT AS crash_count, max(crash_count > 3) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS disabled FROM c""")
def crash_streaks_of_all(t):
    """Errors of all users as the crashes of one worker: one key with all rows."""
    errors = t("events").filter(F.col("event_type") == "error").withColumn("worker", F.lit("w"))
    return metrics.crash_streaks(errors, "worker", gap=300, block=100).select("event_id", "crash_count", "disabled")


@_query("SELECT event_id, n::INT AS n FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events) WHERE n <= 10 OR n % 50 = 0")
def progress_sample(t):
    return metrics.progress(t("events"), ("ts", "event_id"), 50, F.date_trunc("hour", "ts"), ("event_type",)).select("event_id", F.col("n").cast("int").alias("n"))


@_query("""
WITH e AS (SELECT user_id, event_id, ts, event_type = 'click' AS begins FROM events WHERE event_type IN ('click', 'purchase', 'error')),
n AS (SELECT *, epoch_us(lead(ts) OVER w) AS next_at, lead(begins) OVER w AS next_begins, (SELECT epoch_us(max(ts)) FROM events) AS ends FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
t AS (SELECT *, (coalesce(next_at, ends) - epoch_us(ts)) / 1e6 AS took FROM n WHERE begins)
SELECT user_id, event_id, ts, CASE WHEN took > 43200 THEN 'timeout' WHEN next_at IS NULL THEN 'open' WHEN next_begins THEN 'restarted' ELSE 'ended' END AS outcome,
  CASE WHEN took > 43200 OR next_at IS NOT NULL THEN round(least(took, 43200.0::DOUBLE), 6) END AS seconds FROM t""")
def attempt_outcomes(t):
    """Clicks begin attempts of a user, purchases and errors end them; half a day is too long."""
    rows = attempts.outcomes(t("events"), "user_id", F.col("event_type") == "click", F.col("event_type").isin("purchase", "error"), 43_200, unit="month")
    return rows.withColumn("seconds", F.round("seconds", 6))


@_query("SELECT 'slot ' || user_id % 4 AS device, count(*)::BIGINT AS parsed FROM events WHERE event_type <> 'error' GROUP BY 1")
def parsed_per_device(t):
    error = F.when(F.col("event_type") == "error", "failed")
    return metrics.parsed_by_device(t("events").select(F.concat(F.lit("slot "), (F.col("user_id") % 4).cast("string")).alias("device"), error.alias("error")))


@_query("""SELECT event_type AS index_name, user_id::VARCHAR AS _id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) = 1""")
def upsert_read(t):
    """Events as versions of a document for each user and kind, the first half of them merged into a base."""
    rows = t("events").select(F.col("event_type").alias("index_name"), F.col("user_id").cast("string").alias("_id"), F.col("event_id").alias("version"), "event_id", "value")
    early = F.col("version") % 1000 < 500
    merged = upserts.newest(rows.filter(early)).withColumnRenamed("event_id", "version").withColumn("event_id", F.col("version"))
    return upserts.newest(rows.filter(~early).unionByName(merged))


def _log(t) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    ok = kind == "purchase"
    return t("events").select(
        user.cast("string").alias("lngid"), F.when(ok, "success").otherwise("failure").alias("status"), F.when(ok, None).when(kind == "click", "parse").otherwise("index").alias("stage"),
        (user % 2 + 1).cast("int").alias("attempt"), F.when(F.col("value") > 100, "Timeout").alias("error"), F.col("ts").alias("timestamp"),
    )


@_query("""SELECT user_id::VARCHAR AS lngid, CASE WHEN event_type = 'purchase' THEN 'success' ELSE 'failure' END AS status, CASE WHEN event_type = 'click' THEN 'parse' WHEN event_type <> 'purchase' THEN 'index' END AS stage,
  (user_id % 2 + 1)::INT AS attempt, CASE WHEN value > 100 THEN 'Timeout' END AS error, ts AS timestamp FROM events""")
def status_appended(t):
    """Records appended to the status log by two runs, and the log read again."""
    rows = _log(t)
    folder = sinks.scratch_folder(rows.sparkSession)
    for status in ("success", "failure"):
        sinks.append_status(rows.filter(F.col("status") == status), f"{folder}/status")
    return files.status_log(rows.sparkSession, f"{folder}/status").select("lngid", "status", "stage", "attempt", "error", "timestamp")


@_query("""SELECT count(*) FILTER (event_type = 'purchase')::BIGINT AS success, count(*) FILTER (event_type = 'click')::BIGINT AS parse_failures, count(*) FILTER (event_type NOT IN ('purchase', 'click'))::BIGINT AS index_failures,
  count(*) FILTER (event_type <> 'purchase' AND value > 100)::BIGINT AS timeouts, count(*) FILTER (user_id % 2 = 1)::BIGINT AS retries, count(*)::BIGINT AS records, round(max(e) - min(e), 2) AS elapsed_seconds,
  round(count(*) FILTER (event_type = 'purchase') / (max(e) - min(e)) * 3600, 2) AS throughput_per_hour,
  round(CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN (max(e) - min(e)) / count(*) FILTER (event_type = 'purchase') ELSE 0 END, 2) AS average_seconds_per_success
FROM (SELECT *, epoch_us(ts) / 1e6 AS e FROM events)""")
def run_summary(t):
    return metrics.run_summary(_log(t))


@_query("SELECT event_type AS index_name, count(*)::BIGINT AS documents FROM events GROUP BY event_type UNION ALL SELECT 'fulltext', count(*)::BIGINT FROM documents")
def counts_per_index(t):
    rows = t("events").select(F.col("event_type").alias("index_name")).unionByName(t("documents").select(F.lit("fulltext").alias("index_name")))
    return metrics.index_totals(rows)


_KINDS = ["click", "error", "purchase", "signup", "view"]


@_query(f"""SELECT user_id, {", ".join(f"count(*) FILTER (event_type = '{k}')::BIGINT AS {k}" for k in _KINDS)}, count(*)::BIGINT AS total,
  concat_ws(', ', {", ".join(f"CASE WHEN {k} > 0 THEN '{k}=' || {k} END" for k in _KINDS)}) AS told FROM events GROUP BY user_id""")
def counts_pivot(t):
    rows = t("events").withColumnRenamed("user_id", "lngid").withColumnRenamed("event_type", "index_name")
    return metrics.breakdown(metrics.counts_by_index(rows, _KINDS), _KINDS).withColumnRenamed("lngid", "user_id")


# --- packing and indexes -------------------------------------------------------------------------------------------


def _pages_as_actions(t) -> DataFrame:
    line = packing.ndjson(F.lit("fulltext"), F.col("page_id").cast("string"), F.struct("url"))
    return t("pages").select("page_id", F.floor(F.col("page_id") / 1000).alias("group"), line.alias("line"), packing.size(line).cast("long").alias("bytes"))


_ACTION = """'{"index":{"_index":"fulltext","_id":"' || page_id || '"}}' || chr(10) || '{"url":"' || url || '"}' || chr(10)"""


@_query(f"SELECT page_id, strlen({_ACTION})::BIGINT AS bytes FROM pages")
def bulk_bytes(t):
    return _pages_as_actions(t).select("page_id", "bytes")


@_query(f"""
WITH RECURSIVE a AS (SELECT page_id, page_id // 1000 AS g, row_number() OVER (PARTITION BY page_id // 1000 ORDER BY page_id) AS i, strlen({_ACTION}) AS n FROM pages),
b AS (
  SELECT page_id, g, i, 0 AS batch, 1 AS c, n AS used FROM a WHERE i = 1
  UNION ALL SELECT a.page_id, a.g, a.i, CASE WHEN c >= 10 OR used + n > 900 THEN batch + 1 ELSE batch END, CASE WHEN c >= 10 OR used + n > 900 THEN 1 ELSE c + 1 END, CASE WHEN c >= 10 OR used + n > 900 THEN n ELSE used + n END
  FROM b JOIN a ON a.g = b.g AND a.i = b.i + 1
)
SELECT page_id, batch::BIGINT AS batch FROM b""")
def bulk_pack(t):
    return packing.packed(_pages_as_actions(t), "group", "page_id", "bytes", 10, 900).select("page_id", "batch")


@_query(f"""
WITH RECURSIVE a AS (SELECT page_id, row_number() OVER (ORDER BY page_id) AS i, strlen({_ACTION}) AS n FROM pages),
b AS (
  SELECT page_id, i, 0 AS batch, 1 AS c, n AS used FROM a WHERE i = 1
  UNION ALL SELECT a.page_id, a.i, CASE WHEN c >= 10 OR used + n > 900 THEN batch + 1 ELSE batch END, CASE WHEN c >= 10 OR used + n > 900 THEN 1 ELSE c + 1 END, CASE WHEN c >= 10 OR used + n > 900 THEN n ELSE used + n END
  FROM b JOIN a ON a.i = b.i + 1
)
SELECT page_id, batch::BIGINT AS batch FROM b""")
def bulk_pack_stream(t):
    """All pages as one stream of requests, in blocks of a hundred."""
    rows = _pages_as_actions(t).withColumn("stream", F.lit("pages"))
    return packing.packed(rows, "stream", "page_id", "bytes", 10, 900, F.floor(F.col("page_id") / 1000), block=100).select("page_id", "batch")


@_query("SELECT doc_id, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 100)::BIGINT AS batch FROM documents")
def bulk_pack_count(t):
    return packing.packed_by_count(t("documents"), "source", ("doc_id",), F.floor(F.col("doc_id") / 10_000)).select("doc_id", "batch")


@_query("SELECT label, count(*)::BIGINT AS vectors, min(len(embedding))::INT AS size FROM embeddings WHERE len(embedding) > 0 GROUP BY label")
def vector_present(t):
    return indexes.with_vector(t("embeddings").withColumn("vector", F.col("embedding"))).groupBy("label").agg(F.count(F.lit(1)).alias("vectors"), F.min(F.size("embedding")).alias("size"))


@_query("""SELECT 'fulltext' AS index_name, doc_id || '_fulltext' AS _id, length(text)::BIGINT AS chars FROM documents UNION ALL SELECT 'title', item_id || '_title', length(text) FROM benchmark""")
def index_union(t):
    chars = F.length("text").cast("long").alias("chars")
    return indexes.united({"fulltext": t("documents").select(F.col("doc_id").alias("doc"), chars), "title": t("benchmark").select(F.col("item_id").alias("doc"), chars)}).drop("doc")


_SIZE = 800


def _fragments(table: str, key: str, size: int) -> str:
    """CTEs that cut ``text`` of a table with a unique ``key`` into fragments: fragment_index and fragment."""
    return f"""parts_of_{table} AS (SELECT {key}, CASE WHEN length(text) <= {size} THEN [text] ELSE {_cascade(size)} END AS parts FROM (SELECT {key}, regexp_replace(text, {_STRIP}) AS text FROM {table}) WHERE text <> ''),
l_{table} AS (SELECT {key}, i, parts[i] AS x FROM (SELECT {key}, parts, unnest(range(1, len(parts) + 1)) AS i FROM parts_of_{table})),
g_{table} AS (
  SELECT {key}, i, 0 AS n, length(x) AS used FROM l_{table} WHERE i = 1
  UNION ALL SELECT l.{key}, l.i, CASE WHEN used + length(x) > {size} THEN n + 1 ELSE n END, CASE WHEN used + length(x) > {size} THEN length(x) ELSE used + length(x) END FROM g_{table} g JOIN l_{table} l ON l.{key} = g.{key} AND l.i = g.i + 1
), fragments_of_{table} AS (
  SELECT {key}, n AS fragment_index, regexp_replace(string_agg(x, '' ORDER BY i), {_STRIP}) AS fragment FROM g_{table} JOIN l_{table} USING ({key}, i) GROUP BY {key}, n
)"""


_PAPERS = f"""{_CHUNKS.replace("WITH ", "WITH RECURSIVE ", 1)}, grouped AS (
  SELECT *, is_reference OR contains(section_path, '{structure.REFERENCES}') AS reference, row_number() OVER (PARTITION BY doc, is_reference OR contains(section_path, '{structure.REFERENCES}') ORDER BY chunk_seq) - 1 AS source_index FROM chunks
), {_fragments("grouped", "id", _SIZE)}, spoken AS (
  SELECT id, k - 1 AS sentence_index, s[k] AS text, id || '_' || k AS skey FROM (SELECT id, s, unnest(range(1, len(s) + 1)) AS k
    FROM (SELECT *, {_spelt("text", "[。！？.!?]")} AS s FROM grouped WHERE NOT reference)) WHERE length(s[k]) >= 2
), {_fragments("spoken", "skey", _SIZE)}, papers AS (
  SELECT doc, trim(regexp_replace(string_agg(text, chr(10) ORDER BY chunk_seq) FILTER (text <> ''), '{_S}+', ' ', 'g'), ' ') AS whole FROM chunks GROUP BY doc
), heads AS (
  SELECT doc, coalesce(b.text, '') AS title_c, coalesce(b.text, '') AS title_e, coalesce(b.text, '') AS remark_c, '' AS remark_e, '' AS keyword_c, coalesce(reverse(b.text), '') AS keyword_e
  FROM papers LEFT JOIN benchmark b ON b.item_id::VARCHAR = doc
), placed AS (
  SELECT doc, reference, source_index, NULL::BIGINT AS sentence_index, fragment_index, fragment AS text, section_path, element_type, page_num, id AS source_chunk_id, chunk_seq AS source_chunk_seq,
    count(*) OVER (PARTITION BY id) AS fragment_count FROM fragments_of_grouped JOIN grouped USING (id)
  UNION ALL SELECT doc, reference, source_index, sentence_index, fragment_index, fragment, section_path, element_type, page_num, id, chunk_seq, count(*) OVER (PARTITION BY skey)
  FROM fragments_of_spoken JOIN spoken USING (skey) JOIN grouped USING (id)
), every AS (
  SELECT CASE WHEN sentence_index IS NOT NULL THEN 'sentence' WHEN reference THEN 'reference' ELSE 'paragraph' END AS index_name,
    doc || CASE WHEN reference THEN '_r' ELSE '_p' END || source_index || coalesce('s' || sentence_index, '') || '_f' || fragment_index AS _id, text, doc, source_index, sentence_index, fragment_index AS fragment_seq,
    fragment_count, section_path, element_type, page_num, source_chunk_id, source_chunk_seq, NULL::BIGINT AS token_count FROM placed
  UNION ALL SELECT 'fulltext', doc || '_fulltext', CASE WHEN length(whole) <= {_SIZE} THEN whole ELSE '' END, doc, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, (length(whole) + 1) // 2 FROM papers
  UNION ALL SELECT unnest(['title', 'abstract', 'keyword']), unnest([doc || '_title', doc || '_abstract', doc || '_keyword']),
    unnest(list_transform([trim(title_c || ' ' || title_e, ' '), trim(remark_c || ' ' || remark_e, ' '), trim(keyword_c || ' ' || keyword_e, ' ')], lambda x: CASE WHEN length(x) <= {_SIZE} THEN x ELSE '' END)),
    doc, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM heads
)"""


def _indexed(t, name: str | None = None) -> DataFrame:
    """The conversations as papers, with texts of ``benchmark`` as their titles, abstracts and keywords; fragments of at most 800 characters."""
    meta = t("benchmark").select(F.col("item_id").cast("string").alias("lngid"), F.col("text").alias("title_c"), F.col("text").alias("title_e"), F.col("text").alias("remark_c"), F.reverse("text").alias("keyword_e"))
    meta = meta.withColumns({c: F.lit("") for c in indexes.META if c not in meta.columns})
    # as in the ingestion: four branches are made of the chunks, and each would make them anew
    chunks = sinks.written(structure.chunks(_markdown(t)))
    return indexes.documents(chunks, meta, size=_SIZE, only=name)


@_query(f"{_PAPERS} SELECT index_name, _id, text, md5(text) AS hash, 1::BIGINT AS vectors FROM every WHERE text <> ''")
def index_documents(t):
    """All seven indexes: every document with its id and text."""
    rows = indexes.with_vector(_indexed(t))
    return rows.select("index_name", "_id", "text", F.md5("text").alias("hash"), F.when(F.size("vector") > 0, 1).otherwise(0).cast("long").alias("vectors"))


def _of_index(name: str) -> None:
    """A query for the documents of one index, with the fields that it has; of the vector its size."""
    own = {"source_index": "source_index::INT", "sentence_index": "sentence_index::INT", "fragment_index": "fragment_seq::INT", "fragment_count": "fragment_count::INT", "page_num": "page_num::INT", "source_chunk_seq": "source_chunk_seq::INT", "token_count": "token_count::INT", "vector": "8::INT"}
    fields = indexes.FIELDS[name]
    told = ", ".join(f"{own.get(c, c)} AS {f}" for f, c in fields.items())

    def query(t):
        return indexes.of_index(_indexed(t, name), name).withColumns({f: F.size(f) for f, c in fields.items() if c == "vector"})

    query.__name__ = f"{name}_index"
    _query(f"{_PAPERS} SELECT _id, doc AS file_id, '' AS doi, '' AS firstwriter, '' AS showwriter, 0::INT AS delete_flag, {told} FROM every JOIN heads USING (doc) WHERE text <> '' AND index_name = '{name}'")(query)


for _name in indexes.INDEXES:
    _of_index(_name)


@_query(f"""WITH {_STATUS} SELECT count(*)::BIGINT AS discovered, count(*) FILTER (status = 'success' OR status = 'failure' AND attempt >= 2)::BIGINT AS skipped,
  count(*) FILTER (status IS NULL OR status = 'failure' AND attempt < 2)::BIGINT AS submitted, count(*) FILTER (status = 'failure' AND attempt < 2)::BIGINT AS retried FROM documents LEFT JOIN status USING (doc_id)""")
def run_counters(t):
    return metrics.run_counters(_tasks(t), discovery.tasks(_named(t("documents")), _status(t), root="/data"))


def _refuses_sevenths(body: bytes) -> dict:
    """A stand-in for a search service: requests of over 30 documents are too large, documents whose number ends in 7 are refused."""
    ids = [json.loads(x)["index"]["_id"] for x in body.decode().splitlines()[::2]]
    if len(ids) > 30:
        raise packing.TooLarge(f"{len(ids)} documents")
    return {"took": 1, "errors": True, "items": [{"index": {"_id": x} | ({"error": "refused"} if x.endswith("7") else {})} for x in ids]}


@_query("""SELECT count(*) FILTER (page_id % 10 = 7) > 0 AS errors, count(*)::BIGINT AS items, count(*) FILTER (page_id % 10 = 7)::BIGINT AS failed, min(page_id::VARCHAR) FILTER (page_id % 10 = 7) AS first_failed FROM pages""")
def bulk_result(t):
    rows = _pages_as_actions(t).select(F.lit("fulltext").alias("index_name"), F.col("page_id").cast("string").alias("_id"), "line")
    return packing.merged(packing.sent(rows, _refuses_sevenths)).select("errors", "items", "failed", F.col("first_failed._id").alias("first_failed"))
