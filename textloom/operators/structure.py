"""From Markdown to sections and chunks, with windows over a document's lines instead of a parser's stack.

Headings have at most LEVELS levels. An enclosing heading of level k is the last one of that level before a line, if none of a
lower level stands after it; so every ancestor is a running maximum, and one partitioning by document serves all steps.

Rows with a null Markdown have no lines; a document without a heading has no section and no chunk.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as X

LEVELS = 4
MAX_TITLE = 50
#: Words whose presence makes a short line a heading of level 2 (white space in lines does not count).
TITLE_WORDS = (
    "摘要", "引言", "前言", "绪论", "方法", "方法学", "结果", "讨论", "结论", "结语", "参考文献", "致谢", "附录", "实验", "相关工作", "背景",
    "理论", "理论基础", "分析", "展望", "评估", "设计", "实现", "验证", "测试", "对比", "总结",
)
#: A range with the first characters of all of them: other lines have none of the words.
_TITLE_BEGINS = f"[{min(w[0] for w in TITLE_WORDS)}-{max(w[0] for w in TITLE_WORDS)}]"
#: Marks of special sections, by words in the lower-cased title; the first that applies.
SPECIAL = (
    ("references", ("参考文献", "reference", "references", "参 考 文 献")),
    ("appendix", ("附录", "appendix", "附 录")),
    ("acknowledgement", ("致谢", "acknowledgement", "acknowledgments", "致 谢")),
)
#: Types of sections, by words in the lower-cased path; the first that applies.
TYPES = (
    ("摘要", ("摘要", "abstract")),
    ("关键词", ("关键词", "key words", "keywords")),
    ("引言", ("引言", "前言", "绪论", "introduction", "intro")),
    ("背景", ("背景", "background", "相关背景")),
    ("相关工作", ("相关工作", "related work", "related works")),
    ("方法", ("方法", "方法学", "methods", "methodology", "模型", "model")),
    ("实验", ("实验", "试验", "experiment", "experiments")),
    ("结果", ("结果", "results", "findings")),
    ("讨论", ("讨论", "discussion")),
    ("分析", ("分析", "analysis")),
    ("结论", ("结论", "结语", "总结", "conclusion", "总结与展望", "future work")),
    ("致谢", ("致谢", "acknowledgements", "acknowledgment")),
    ("参考文献", ("参考文献", "references", "reference")),
    ("附录", ("附录", "appendix")),
    ("设计", ("设计", "design")),
    ("实现", ("实现", "implementation")),
    ("验证", ("验证", "verification", "validation")),
    ("测试", ("测试", "test", "testing")),
    ("对比", ("对比", "comparison")),
    ("评估", ("评估", "evaluation")),
    ("展望", ("展望", "未来工作", "future work")),
)
BODY = "正文"
PARAGRAPHS = ("section", "blank_line")
REFERENCES, ENTRY = "参考文献", "参考文献条目"


def has_any(c: Column, words: tuple[str, ...]) -> Column:
    """Plain words, looked for as bytes: a pattern of them is tried at every character, and took half the time of long paths."""
    return reduce(Column.__or__, [c.contains(w) for w in words])


def special_mark(title: Column) -> Column:
    """The title with the mark of a special section before it."""
    low, out = F.lower(title), None
    for mark, words in SPECIAL:
        test, value = has_any(low, words), F.concat(F.lit(f"[{mark}] "), title)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(title)


def section_type(path: Column) -> Column:
    low, out = F.lower(path), None
    for name, words in TYPES:
        out = F.when(has_any(low, words), name) if out is None else out.when(has_any(low, words), name)
    return out.otherwise(BODY)


def lines(docs: DataFrame, doc_col: str = "doc", text_col: str = "markdown") -> DataFrame:
    """(doc, pos, line): the lines that are not blank, with their numbers from 0."""
    rows = docs.select(F.col(doc_col).alias("doc"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line"))
    return rows.filter(~X.is_blank(F.col("line")))


def headings(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`lines` with level, title and page_num; level is null where a line is no heading."""
    pattern = r"(?U)^(#{1,4})[\s\x1c-\x1f]+(.+)$"
    # step by step, as a column that is used more than once is computed once a row only if it is one of the step before
    found = rows.withColumn("__line", X.strip(F.col("line")))
    line = F.col("__line")
    found = found.withColumn("__atx", line.startswith("#") & line.rlike(pattern))
    atx = F.col("__atx")
    steps = {"__named": F.when(atx, X.strip(F.regexp_extract(line, pattern, 2))), "__packed": F.when(~atx & line.rlike(_TITLE_BEGINS), F.regexp_replace(line, rf"{X.WS}+", ""))}
    found = found.withColumns(steps)
    named, packed = F.col("__named"), F.col("__packed")
    found = found.withColumns({"__page": F.when(atx, F.regexp_extract(named, r"\(p\.(\d+)\)$", 1)), "__word": ~atx & (F.length(packed) < MAX_TITLE) & has_any(packed, TITLE_WORDS)})
    page, word = F.col("__page"), F.col("__word")
    found = found.select(
        "*",
        F.when(atx, F.length(F.regexp_extract(line, pattern, 1))).when(word, 2).cast("int").alias("level"),
        F.when(atx, X.clean(F.regexp_replace(named, rf"(?U)[\s\x1c-\x1f]*\(p\.\d+\)$", ""))).when(word, line).alias("title"),
        F.when(atx & (page != ""), page).otherwise("1").cast("int").alias("page_num"),
    )
    return found.drop("__line", "__atx", "__named", "__packed", "__page", "__word")


def enclosing(rows: DataFrame, doc: str = "doc", pos: str = "pos", level: str = "level", **carried: Column) -> DataFrame:
    """``rows`` (headings) with ``up``: the headings from the root to each, itself last, as structs of level, pos and ``carried``."""
    before = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    last = [F.max(F.when(F.col(level) == k, F.struct(F.col(pos).alias("pos"), F.lit(k).alias("level"), *[v.alias(n) for n, v in carried.items()]))).over(before) for k in range(1, LEVELS + 1)]
    rows = rows.withColumns({f"__{k}": c for k, c in enumerate(last)})
    kept = []
    for k in range(LEVELS):
        lower = [F.coalesce(F.col(f"__{j}.pos"), F.lit(-1)) for j in range(k)]
        alive = F.col(f"__{k}.pos").isNotNull()
        for p in lower:
            alive = alive & (F.col(f"__{k}.pos") > p)
        kept.append(F.when(alive, F.col(f"__{k}")))
    return rows.withColumn("up", F.filter(F.array(*kept), lambda x: x.isNotNull())).drop(*[f"__{k}" for k in range(LEVELS)])


def path_of(up: Column) -> Column:
    return F.array_join(F.transform(up, lambda x: x["title"]), " > ")


def sections(rows: DataFrame, strict_refs: bool = False, blank_lines: bool = False) -> DataFrame:
    """(doc, pos, level, title, page_num, content, path, up) from :func:`headings`: a row for each heading, its own lines joined.

    ``strict_refs``: see :func:`strict_entries`. ``blank_lines``: lines that blank ones part are parted by one in the content, too.
    """
    order = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("section", F.max(F.when(F.col("level").isNotNull(), F.col("pos"))).over(order)).filter(F.col("section").isNotNull())
    own = F.array_sort(F.collect_list(F.when(F.col("level").isNull(), F.struct("pos", "line"))))
    head = F.first(F.when(F.col("level").isNotNull(), F.struct("level", "title", "page_num")), ignorenulls=True)
    found = rows.groupBy("doc", "section").agg(head.alias("head"), own.alias("own"))
    gap = lambda x, i: F.when((i > 0) & (x["pos"] - F.get("own", i - 1)["pos"] > 1), "\n").otherwise("") if blank_lines else F.lit("")
    found = found.withColumn("content", X.strip(F.array_join(F.transform("own", lambda x, i: F.concat(gap(x, i), x["line"])), "\n")))
    found = found.select("doc", F.col("section").alias("pos"), "head.level", special_mark(F.col("head.title")).alias("title"), "head.page_num", "content")
    refs = F.when(F.col("title").contains(REFERENCES) | F.lower("title").contains("references"), (strict_entries if strict_refs else reference_entries)(F.col("content"))).otherwise(F.array().cast("array<string>"))
    found = found.withColumn("entries", refs)
    found = enclosing(found, title=F.col("title"), entries=F.size("entries"))
    return found.withColumn("path", path_of(F.col("up")))


def _without_notes(content: Column) -> Column:
    """Without what tells that a list goes on from or on another page."""
    return F.regexp_replace(F.regexp_replace(content, r"(?U)[（(]上接第[\s\x1c-\x1f]*\d+[\s\x1c-\x1f]*页[）)]", ""), r"(?U)[（(]下转第[\s\x1c-\x1f]*\d+[\s\x1c-\x1f]*页[）)]", "")


def _entry(n: Column, t: Column) -> Column:
    t = F.regexp_replace(F.regexp_replace(X.squeeze(t), "[（(]责任编辑[：:].*", ""), r"\)\)$", ")")
    return X.bound(t, lambda x: F.when(x != "", F.concat(F.lit("["), n, F.lit("] "), x)))


def reference_entries(content: Column) -> Column:
    """The entries [n] of a list of references, one string each. An entry that has a [ in its text is none."""
    whole = F.regexp_extract_all(_without_notes(content), F.lit(r"(?sU)\[\d+\][\s\x1c-\x1f]*[^\[]+?(?=\[\d+\]|$)"), F.lit(0))
    mark = r"(?U)^\[(\d+)\]"
    return F.filter(F.transform(whole, lambda x: _entry(F.regexp_extract(x, mark, 1), F.regexp_replace(x, mark, ""))), lambda x: x.isNotNull())


def _rising(numbers: list[int]) -> list[int]:
    """The places of the longest rising run of numbers, the earliest of equal ones."""
    ends: list[int] = []
    tails: list[int] = []
    before = [-1] * len(numbers)
    for k, n in enumerate(numbers):
        at = bisect_left(tails, n)
        before[k] = ends[at - 1] if at else -1
        if at == len(tails):
            tails.append(n)
            ends.append(k)
        elif tails[at] != n:
            tails[at], ends[at] = n, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("n", T.StringType()), T.StructField("t", T.StringType())])))
def _by_marks(contents: pd.Series) -> pd.Series:
    def one(content: str | None) -> list[tuple[str, str]]:
        marks = list(re.finditer(r"\[([0-9]+)\]", content or ""))
        leading = [m for m in marks if not content[content.rfind("\n", 0, m.start()) + 1 : m.start()].strip()]
        marks = leading if len(leading) > 1 else marks
        marks = [marks[k] for k in _rising([int(m[1]) for m in marks])]
        return [(m[1], content[m.end() : then]) for m, then in zip(marks, [*[m.start() for m in marks[1:]], len(content or "")])]

    return contents.map(one)


def strict_entries(content: Column) -> Column:
    """The entries of a list of references by its longest rising run of [n] marks, those that lead a line if there are several: kinds of
    publication such as [J], and other entries' numbers in an entry's text, are part of it."""
    both = _by_marks(F.coalesce(_without_notes(content), F.lit("")))
    return F.filter(F.transform(both, lambda x: _entry(x["n"], x["t"])), lambda x: x.isNotNull())


def _pieces(paragraph: Column) -> Column:
    """The texts of a paragraph, each with what tells whether it is a table; both are computed once a paragraph."""
    table = F.struct(paragraph.alias("p"), X.is_table(paragraph).alias("is_table"))
    return X.bound(table, lambda x: F.transform(X.split_long(X.clean(x["p"], x["is_table"])), lambda t: F.struct(t.alias("text"), x["is_table"].alias("is_table"))))


def chunks(docs: DataFrame, doc_col: str = "doc", text_col: str = "markdown", strict_refs: bool = False, paragraphs: str = "section") -> DataFrame:
    """One row a chunk: id, text, doc, page_num, chunk_seq, element_type, section_path, text_level, is_table, is_reference.

    Sections with parsed references give their entries and nothing below them; others their text, long ones in pieces. ``paragraphs``:
    "section", one a section, or "blank_line", parted by blank lines. ``strict_refs``: see :func:`strict_entries`.
    """
    if paragraphs not in PARAGRAPHS:
        raise ValueError(f"paragraphs are one of {PARAGRAPHS}, not {paragraphs!r}")
    found = sections(headings(lines(docs, doc_col, text_col)), strict_refs, paragraphs == "blank_line")
    above = F.slice("up", 1, F.greatest(F.size("up") - 1, F.lit(0)))
    found = found.filter(~F.exists(above, lambda x: x["entries"] > 0))
    paragraph = F.filter(F.transform(F.split("content", "\n\n"), X.strip), lambda x: F.length(x) >= X.MIN_PARAGRAPH)
    body = F.flatten(F.transform(paragraph, _pieces))
    listed = F.transform("entries", lambda e: F.struct(e.alias("text"), F.lit(None).cast("boolean").alias("is_table")))
    is_reference = F.size("entries") > 0
    found = found.select("doc", "pos", "level", "page_num", "path", is_reference.alias("is_reference"), F.posexplode(F.when(is_reference, listed).otherwise(body)).alias("at", "x"))
    order = Window.partitionBy("doc").orderBy("pos", "at")
    found = found.withColumn("seq", F.row_number().over(order) - 1)
    key = F.when(F.col("is_reference"), X.chunk_id(F.col("doc"), F.col("path"), F.lit("ref"), F.col("seq"))).otherwise(X.chunk_id(F.col("doc"), F.col("path"), F.col("seq")))
    return found.select(
        key.alias("id"), F.col("x.text").alias("text"), "doc", "page_num", (F.col("seq") + 1).alias("chunk_seq"),
        F.when(F.col("is_reference"), ENTRY).otherwise(section_type(F.col("path"))).alias("element_type"), F.col("path").alias("section_path"),
        F.when(F.col("is_reference"), 0).otherwise(F.col("level")).alias("text_level"), F.col("x.is_table").alias("is_table"), "is_reference",
    )


def without_chunks(docs: DataFrame, found: DataFrame, doc_col: str = "doc", text_col: str = "markdown") -> DataFrame:
    """(doc, error) for the documents of which nothing can be made: errors are rows."""
    empty = F.coalesce(X.strip(F.col(text_col)) == "", F.lit(True))
    rows = docs.select(F.col(doc_col).alias("doc"), F.when(empty, "empty Markdown").otherwise("no chunk").alias("error"))
    return rows.join(found.select("doc").distinct(), "doc", "left_anti")
