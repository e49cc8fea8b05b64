"""Chunks against the rules, told over intervals of line numbers."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import fragments, structure


def clean(t):
    t = re.sub("<[^>]+>", "", t)
    t = t.replace("'", ", ").replace("（", "(").replace("）", ")")
    for a, b in ((r"\s*/\s*", "/"), (r"\(\s+", "("), (r"\s+\)", ")"), (r",\s+,", ",")):
        t = re.sub(a, b, t)
    return re.sub(r"\s+", " ", t.replace("－", "-")).strip()


def heading(line):
    """(level, title, page) of a line, or None."""
    s = line.strip()
    m = re.match(r"^(#{1,4})\s+(.+)$", s)
    if m:
        page = re.search(r"\(p\.(\d+)\)$", m[2].strip())
        return len(m[1]), clean(re.sub(r"\s*\(p\.\d+\)$", "", m[2].strip())), int(page[1]) if page else 1
    packed = re.sub(r"\s+", "", s)
    return (2, s, 1) if len(packed) < 50 and any(w in packed for w in structure.TITLE_WORDS) else None


def entries(content):
    c = re.sub(r"[（(]上接第\s*\d+\s*页[）)]|[（(]下转第\s*\d+\s*页[）)]", "", content)
    texts = [(n, re.sub(r"\)\)$", ")", re.sub("[（(]责任编辑[：:].*", "", re.sub(r"\s+", " ", t.strip())))) for n, t in re.findall(r"\[(\d+)\]\s*([^\[]+?)(?=\[\d+\]|$)", c, re.S)]
    return [f"[{n}] {t}" for n, t in texts if t]


def naive(doc, md):
    """Rows of chunks. A section is the interval from its heading to the next one of its level or a lower one; what it is in are the
    intervals around it; its own lines end at the next heading of any level."""
    rows = [(k, line) for k, line in enumerate((md or "").split("\n")) if line.strip()]
    heads = [(k, *h) for k, line in rows if (h := heading(line))]
    ends = [min((x[0] for x in heads if x[0] > k and x[1] <= level), default=10**9) for k, level, _, _ in heads]
    titles = []
    for _, _, title, _ in heads:
        mark = next((m for m, words in structure.SPECIAL if any(w in title.lower() for w in words)), None)
        titles.append(f"[{mark}] {title}" if mark else title)
    nexts = [x[0] for x in heads[1:]] + [10**9]
    contents = ["\n".join(line for k, line in rows if h[0] < k < n).strip() for h, n in zip(heads, nexts)]
    refs = [entries(c) if "参考文献" in t or "references" in t.lower() else [] for c, t in zip(contents, titles)]
    out = []
    for n, (k, level, _, page) in enumerate(heads):
        around = [m for m in range(n) if heads[m][0] < k < ends[m]]
        if any(refs[m] for m in around):
            continue
        path = " > ".join(titles[m] for m in [*around, n])
        kind = next((name for name, words in structure.TYPES if any(w in path.lower() for w in words)), "正文")
        table = contents[n].count("|") > 2
        if refs[n]:
            texts, kind, table, level = refs[n], "参考文献条目", None, 0
        elif len(contents[n]) < 10:
            continue
        else:
            text = contents[n] if table else clean(contents[n])
            texts = [t.strip().removesuffix("。") + "。" for t in text.replace("。", "。\n").split("\n") if t.strip()] if len(text) > 1500 else [text]
        for text in texts:
            key = hashlib.md5(f"{doc}_{path}_{'ref_' if refs[n] else ''}{len(out)}".encode()).hexdigest()[:16]
            out.append((key, text, doc, page, len(out) + 1, kind, path, level, table, bool(refs[n])))
    return out


GOLDEN = """text before the first heading goes
# 标题 Title (p.12)
First section's text ( with / without ) <b>tags</b> , , and so on.
## Methods 方法
| a | b |
  | 1 | 2 |
### It's deep
plain text of the deep section
# 参 考 文 献
[1] Author A. Title one. （责任编辑：王）
(下转第 12 页)[2] Author B. Title two))
[3] Author C. Title three[J]. Journal.
## below the references
this text is never shown anywhere
# 结 论
最后一段，足够长的内容在这里。
##### five marks are no heading
"""


def test_chunks_golden_and_random(spark):
    random.seed(7)
    docs = [("golden", GOLDEN), ("none", "no heading at all"), ("null", None), ("empty", ""), ("long", "# x\n" + "这是一个句子。" * 400), ("table", "# t\n" + "a|b|c|d\n" * 300)]
    parts = ["# A", "## B (p.3)", "### C", "#### D", "# References", "引言", "[1] one two [2] three", "some plain text line", "short", "", "a | b | c | d", "## 参考文献"]
    docs += [(f"r{k}", "\n".join(random.choice(parts) for _ in range(random.randint(1, 25)))) for k in range(60)]
    df = spark.createDataFrame(docs, "doc string, markdown string")
    found = structure.chunks(df)
    mine = sorted((tuple(r) for r in found.collect()), key=lambda r: (r[2], r[4]))
    expected = sorted((r for d, m in docs for r in naive(d, m)), key=lambda r: (r[2], r[4]))
    assert mine == expected
    errors = {r.doc: r.error for r in structure.without_chunks(df, found).collect()}
    assert errors["null"] == errors["empty"] == "empty Markdown" and errors["none"] == "no chunk" and "golden" not in errors


def naive_fragments(text, size):
    def split(p, t):
        return [x.strip() for x in re.split(p, t) if x.strip()]

    text = text.strip()
    if not text or len(text) <= size:
        return [text] if text else []
    parts = [text]
    for p in (r"(?<=\n\n)", r"(?<=[。！？.!?])", r"(?<=[；;：:，,、])", r"(?<=\s)"):
        parts = [y for x in parts for y in ([x] if len(x) <= size else split(p, x) or [x])]
    parts = [y for x in parts for y in ([x] if len(x) <= size else [x[k : k + size].strip() for k in range(0, len(x), size) if x[k : k + size].strip()])]
    out, now = [], ""
    for x in parts:
        if now and len(now + x) > size:
            out.append(now.strip())
            now = x
        else:
            now += x
    return out + ([now.strip()] if now.strip() else [])


def test_safe_fragments(spark):
    random.seed(3)
    texts = ["", "  ", "x" * 95, "word " * 50, "句子。" * 40, "a\n\nb" * 20] + ["".join(random.choice("ab ，。.;\n ") for _ in range(random.randint(0, 300))) for _ in range(150)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    for k, parts in df.select("k", X.safe_fragments(df["text"], 30)).collect():
        assert parts == naive_fragments(texts[k], 30)
        assert all(len(p) <= 30 for p in parts)
    many = "word, " * 5000  # many times more pieces than one run of them
    assert spark.createDataFrame([(many,)], "text string").select(X.safe_fragments(F.col("text"), 30).alias("x")).first().x == naive_fragments(many, 30)


def test_sentence_and_text_fragments(spark):
    rows = [("i1", "One. Two! x", "d", 1, 1, "正文", "p"), ("i2", "", "d", 1, 2, "正文", "p"), ("i3", "[1] ref", "d", 2, 3, "参考文献条目", "p > 参考文献"), ("i4", "Last。好", "d", 1, 4, "正文", "p")]
    df = fragments.grouped(spark.createDataFrame(rows, "id string, text string, doc string, page_num int, chunk_seq int, element_type string, section_path string"))
    told = {(r.source_index, r.sentence_index, r.text) for r in fragments.sentence_fragments(df.filter("not reference")).collect()}
    assert told == {(0, 0, "One."), (0, 1, "Two!"), (2, 0, "Last。")}
    whole = {(r.reference, r.source_index, r.fragment_index, r.fragment_count) for r in fragments.text_fragments(df).collect()}
    assert whole == {(False, 0, 0, 1), (False, 2, 0, 1), (True, 0, 0, 1)}


def test_keys(spark):
    names = {"/d/temp_a1b2c3_1000004517957.pdf": "1000004517957", "vec_ab12_x y .PDF": "x y", "a/b/n.docx": "n", "temp_a_b-c_9.md": "9", "z.tar": "z.tar", "/d/.pdf": ""}
    df = spark.createDataFrame([(n,) for n in names], "path string")
    assert {r.path: r.k for r in df.select("path", X.file_key(df["path"]).alias("k")).collect()} == names
    key = df.select("path", X.task_key(df["path"], "/d").alias("k")).collect()
    assert {r.path: r.k for r in key} == {n: hashlib.sha256(n.removeprefix("/d/").encode()).hexdigest()[:20] for n in names}


def test_strict_references_and_blank_lines(spark):
    refs = "[1] A. Title[J]. X, 2001.\n[2] B. As in [1] and [9]; Book[M].\n[4] C.\nmore of C [3].\n\n[5] D（责任编辑：E）"
    text = f"# Body\nfirst line of text\nsecond line\n\n \nanother paragraph\n\nshort\n# References\n{refs}\n# 参考文献\n[1] one [2] two[J] [2] [3] three"
    docs = spark.createDataFrame([("d", text), ("n", None), ("e", "")], "doc string, markdown string")
    rows = structure.chunks(docs, strict_refs=True, paragraphs="blank_line").orderBy("chunk_seq").collect()
    assert [r.text for r in rows] == ["first line of text second line", "another paragraph", "[1] A. Title[J]. X, 2001.", "[2] B. As in [1] and [9]; Book[M].", "[4] C. more of C [3].", "[5] D", "[1] one", "[2] two[J] [2]", "[3] three"]
    plain = structure.chunks(docs).orderBy("chunk_seq").collect()
    assert plain[0].text == "first line of text second line another paragraph short" and not any("[J]" in r.text for r in plain)
    with pytest.raises(ValueError):
        structure.chunks(docs, paragraphs="page")


def test_long_paths_are_typed_without_patterns(spark):
    """A type of section is told from plain words: no pattern is tried at every character of a long path."""
    rows = spark.createDataFrame([("x" * 5000 + " > The Future Work",), ("plain",), (None,), ("A > 试验",)], "path string")
    df = rows.select(structure.section_type(F.col("path")).alias("kind"))
    assert [r.kind for r in df.collect()] == ["结论", structure.BODY, structure.BODY, "实验"]
    assert "RLIKE" not in df._jdf.queryExecution().optimizedPlan().toString()
    blank = spark.createDataFrame([("",), (" \t\x1c　",), (" a ",), (None,)], "t string").select(X.is_blank(F.col("t")).alias("b"), (X.strip(F.col("t")) == "").alias("s")).collect()
    assert [r.b for r in blank] == [r.s for r in blank] == [True, True, False, None]


def test_paragraphs_are_cleaned_once(spark, data):
    from textloom.plans import catalogue

    plan = catalogue.QUERIES["blank_line_paragraphs"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<[^>]+>") <= 2  # of a title, if it is kept, and of a paragraph


def test_chunks_are_made_once_for_all_indexes(spark, data):
    """No branch of the seven indexes cuts the documents again, and no paragraph is cleaned more than once."""
    from textloom.plans import catalogue

    plan = lambda q: catalogue.QUERIES[q](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "<[^>]+>" not in plan("index_documents")
    assert plan("chunks").count("<[^>]+>") <= 2  # of a title and of a paragraph


def test_cleaning_is_that_of_plain_patterns(spark):
    """Ends are stripped without patterns, and patterns are tried only where their mark stands; the results are those of the patterns."""
    random.seed(5)
    white = [chr(k) for k in range(1, 0x10000) if not 0xD800 <= k < 0xE000]
    texts = [c + "x" + c for c in white] + ["".join(random.choice("ab (),/'<>|\t\n\x1c\x85  　（）－.") for _ in range(random.randint(0, 40))) for _ in range(3000)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t, w = F.col("t"), r"[\s\x1c-\x1f]"
    plain = F.regexp_replace(t, "<[^>]+>", "")
    plain = F.replace(F.replace(F.replace(plain, F.lit("'"), F.lit(", ")), F.lit("（"), F.lit("(")), F.lit("）"), F.lit(")"))
    for a, b in ((rf"{w}*/{w}*", "/"), (rf"\({w}+", "("), (rf"{w}+\)", ")"), (rf",{w}+,", ",")):
        plain = F.regexp_replace(plain, f"(?U){a}", b)
    plain = F.coalesce(F.trim(F.regexp_replace(F.replace(plain, F.lit("－"), F.lit("-")), f"(?U){w}+", " ")), F.lit(""))
    stripped = F.regexp_replace(t, f"(?U)^{w}+|{w}+$", "")
    assert df.filter(~X.strip(t).eqNullSafe(stripped) | ~X.clean(t).eqNullSafe(plain)).collect() == []
    assert "regexp" not in df.select(X.strip(t))._jdf.queryExecution().optimizedPlan().toString()


def test_entries_and_title_words(spark):
    """Entries come from one pattern, and words of titles are looked for only in lines that have a first character of one."""
    random.seed(6)
    texts = ["".join(random.choice(["[1]", "[23]", "[x]", "[", "]", " ", "\n", "　", "a", "))", "（责任编辑：x", "词"]) for _ in range(random.randint(0, 25))) for _ in range(500)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", structure.reference_entries(F.col("t")).alias("e"))
    for k, e in df.collect():
        assert e == entries(texts[k])
    lines = spark.createDataFrame([(w[0] + " " + w[1:],) for w in structure.TITLE_WORDS] + [("no title",), ("一丁",)], "line string")
    assert structure.headings(lines).filter("level = 2").count() == len(structure.TITLE_WORDS)
