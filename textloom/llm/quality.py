"""Quality rules with cross-document line frequency. DataFrame functions only.

Counts of one text are taken inside its row. The frequency of lines comes from the corpus: lines are normalised (lower
case, digits as 0, white space as one space), hashed, and for each host counted in distinct texts, so that exact copies of
a document count once. A line of any length over both limits of its host - ``MIN_TEXTS`` texts and ``MIN_SHARE`` of the
host's texts - is boilerplate and is removed; a document that keeps less than ``MIN_LEFT`` of its words without such lines is
depleted and rejected. :func:`judge` tells the counts, :func:`keep` gives the documents that pass, without those lines.

A text is read once; what is counted later are the hashes of its lines. A text is known by 128 bits of hashes, a line by 64 bits: one of
10^10 lines is taken for one of a host's thousand boilerplate lines with a chance of 5e-7. Equal texts of a host are one, lines are summed by
(host, line) before and after the shuffle, so a line that every document of a host has is a handful of rows. A host has at
most 1/``MIN_SHARE`` times as many boilerplate lines as a text has lines on average: that list comes to each of its rows,
which are judged where they are.

Defined cases: null text has no words and fails the base rules, as does an empty one; a null host is a host of its own;
repeated rows (same id, same text) each get the same result; a text may be as long as a row can be; an empty table gives an
empty result; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import WORD, barrier, cut, own_names, small

MIN_WORDS = 50
MAX_REPEATED = 50
MIN_TEXTS = 25
MIN_SHARE = 0.05
MIN_LEFT = 0.3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "[#*$%&|<>]"
SPACES = " \t\n\x0b\x0c\r"


def _beside(values: str, close) -> Column:
    """Of a sorted array those elements that are close to one beside them, with repeats; ``close`` judges two in a row."""
    n = F.size(values)
    pairs = F.zip_with(F.slice(values, 1, F.greatest(n - 1, F.lit(0))), F.slice(values, 2, F.greatest(n - 1, F.lit(0))), lambda x, y: F.when(close(x, y), F.array(x, y)))
    return F.flatten(F.filter(pairs, lambda x: x.isNotNull()))


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Repeated three-word windows: the windows' hashes with their positions in the low bits (as many as the text's length
    needs) are sorted as longs, so equal windows come to stand side by side. Those are few; they are sorted again by their words, which settles what the hash
    left open, and the words under them are counted by position. No array of windows is ever stored in a row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    columns = list(docs.columns)
    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.octet_length(text)))) - 1
    df = barrier(docs, __words=F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), __lines=F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""), __low=low)
    n = F.size("__words")
    first = F.slice("__words", 1, F.greatest(n - 2, F.lit(0)))
    second, third = F.slice("__words", 2, F.greatest(n - 2, F.lit(0))), F.slice("__words", 3, F.greatest(n - 2, F.lit(0)))
    hashed = F.zip_with(F.zip_with(first, second, lambda x, y: F.xxhash64(x, y)), third, lambda x, y: F.xxhash64(x, y))
    keyed = F.transform(hashed, lambda h, i: h.bitwiseAND(F.bitwise_not("__low")).bitwiseOR(i.cast("long")))
    simple = {
        "n_words": n,
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
    }
    simple = {k: v.cast("long") for k, v in simple.items()}
    df = barrier(df, __keys=F.sort_array(keyed), **simple).drop("__lines")
    places = F.array_distinct(F.transform(_beside("__keys", lambda x, y: x.bitwiseOR(F.col("__low")) == y.bitwiseOR(F.col("__low"))), lambda x: x.bitwiseAND(F.col("__low")).cast("int")))
    df = barrier(df, __places=places).drop("__keys", "__low")
    # few windows are left: with their words, in order of these
    found = F.transform("__places", lambda i: F.struct(F.get("__words", i).alias("a"), F.get("__words", i + 1).alias("b"), F.get("__words", i + 2).alias("c"), i.alias("i")))
    df = barrier(df, __found=F.sort_array(found)).drop("__words", "__places")
    twice = _beside("__found", lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]))
    df = barrier(df, __at=F.sort_array(F.array_distinct(F.transform(twice, lambda x: x["i"])))).drop("__found")
    m = F.size("__at")
    gaps = F.zip_with(F.slice("__at", 2, F.greatest(m - 1, F.lit(0))), F.slice("__at", 1, F.greatest(m - 1, F.lit(0))), lambda x, y: F.least(x - y, F.lit(3)))
    covered = F.when(m > 0, F.aggregate(gaps, F.lit(3), lambda a, x: a + x)).otherwise(F.lit(0))
    return df.select(*columns, *simple, covered.cast("long").alias("n_repeat_words"))


def _normal(text: Column) -> Column:
    """White space is looked for only where it is not one space."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[0-9]", "0"), r"[\x09\x0B-\x0D]|[\x20\x09\x0B-\x0D]{2,}", " ")


def _identity(text_col: str) -> Column:
    """What a text is known by, null for null: two hashes of different seeds."""
    return F.when(F.col(text_col).isNotNull(), F.struct(F.xxhash64(text_col).alias("a"), F.xxhash64(F.lit(1), F.col(text_col)).alias("b")))


def measured(docs: DataFrame, text_col: str, host_col: str, *kept: str) -> DataFrame:
    """(kept columns, the five counts, __host, __hash, __lines) for every row: each text is read once.

    __lines: hashes and words of the lines, normalised.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = counts(docs.withColumn("__host", F.col(host_col)), text_col)
    words = lambda x: F.when(x == "", 0).otherwise(F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1)
    lines = F.transform(F.transform(F.split(_normal(text), "\n"), lambda x: F.trim(x)), lambda x: F.struct(F.xxhash64(x).alias("line"), words(x).alias("words")))
    df = barrier(df, __lines=F.filter(lines, lambda x: x["words"] > 0))
    df = df.withColumn("__hash", _identity(text_col))
    return cut(df.select(*kept, *COUNTS, "__host", "__hash", "__lines"))


def boilerplate(rows: DataFrame) -> DataFrame:
    """(__of, __common): for each host that has some, the hashes of its boilerplate lines, of :func:`measured` rows."""
    texts = rows.filter(F.col("__hash").isNotNull()).groupBy(F.col("__host").alias("host"), F.col("__hash").alias("hash")).agg(F.first("__lines").alias("lines"))
    texts = cut(texts)
    total = texts.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("all_texts"))
    in_texts = texts.select("host", F.explode(F.array_distinct("lines")).alias("x")).groupBy("host", "x").agg(F.count(F.lit(1)).alias("texts"))
    common = in_texts.filter(F.col("texts") >= MIN_TEXTS).join(total, F.col("host").eqNullSafe(F.col("of")))
    common = common.filter(F.col("texts") >= F.lit(MIN_SHARE) * F.col("all_texts"))
    return cut(common.groupBy(F.col("of").alias("__of")).agg(F.collect_set("x.line").alias("__common")))


def _judged(docs: DataFrame, text_col: str, host_col: str, *kept: str) -> tuple[DataFrame, DataFrame]:
    """Rows of :func:`measured`, judged with the boilerplate lines of their hosts, and these lines."""
    rows = measured(docs, text_col, host_col, *kept)
    lists = boilerplate(rows)
    # a table of known size: where it is small Spark sends it to all tasks, else it joins on host and splits the hot ones
    df = rows.join(lists, F.col("__host").eqNullSafe(F.col("__of")), "left").drop("__of")
    hit = F.filter("__lines", lambda x: F.array_contains("__common", x["line"]))
    removed = F.aggregate(hit, F.lit(0).cast("long"), lambda a, x: a + x["words"])
    df = df.withColumn("removed_words", F.when(F.col("__common").isNotNull(), removed).otherwise(0).cast("long")).drop("__lines", "__common")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    depleted = F.col("n_words") - F.col("removed_words") < F.lit(MIN_LEFT) * F.col("n_words")
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted), lists


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id_col, the five counts, removed_words, base_failed, kept) for every row of ``docs``."""
    rows, _ = _judged(docs.select(F.col(id_col), F.col(text_col).alias("__text"), F.col(host_col).alias("__of_host")), "__text", "__of_host", id_col)
    return rows.select(id_col, *COUNTS, "removed_words", "base_failed", "kept")


@own_names
def keep(docs: DataFrame, text_col: str = "text", host_col: str = "source", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` that pass, with all columns: the text without boilerplate lines, its length told anew in ``chars_col`` where that column is there.

    A row is known by its host and text, so copies go alike. Those that are rejected or changed are named to all tasks if they
    are counted to be few enough, so that no text moves; else texts join by shuffle.
    """
    rows, lists = _judged(docs.select(F.col(text_col).alias("__text"), F.col(host_col).alias("__of_host")), "__text", "__of_host")
    changed = cut(rows.filter(~F.col("kept") | (F.col("removed_words") > 0)).select("__host", "__hash", F.col("kept").alias("__kept")).distinct())
    same = F.col(host_col).eqNullSafe(F.col("__host")) & _identity(text_col).eqNullSafe(F.col("__hash"))
    rows = docs.join(small(changed), same, "left").filter(F.coalesce("__kept", F.lit(True)))
    rows = rows.join(lists, F.col("__host").eqNullSafe(F.col("__of")) & F.col("__kept"), "left")
    left = F.array_join(F.filter(F.split(text_col, "\n"), lambda x: ~F.array_contains("__common", F.xxhash64(F.trim(_normal(x))))), "\n")
    rows = rows.withColumn(text_col, F.when(F.col("__common").isNotNull(), left).otherwise(F.col(text_col)))
    if chars_col in docs.columns:
        rows = rows.withColumn(chars_col, F.when(F.col("__common").isNotNull(), F.length(text_col).cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col)))
    return rows.select(*docs.columns)
