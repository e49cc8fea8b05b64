"""Spelling variant grouping: words of a corpus that differ by one code point, found by an even-partition pigeonhole join.

Words are counted over all texts. A word of length L is cut into two halves; if another word of its length or one longer is one edit
away, one half stands in it unchanged, at its place or (after an insertion) shifted by one. So halves are indexed by length and place,
and words are looked up by their own halves as words of length L and as words of length L - 1. Words that meet are verified with
a banded edit distance where they meet, and pairs that met over both halves are taken once.

A half that many words have in common (over ``LEAF``) is no group: the half that may differ is cut in two again, by the same argument,
and so on until it is one code point, so a group holds no more words than the alphabet allows and no pair is lost. The form of a word
is its most frequent near word, if that is ``RATIO`` times as frequent; forms are followed to the last one by pointer doubling.

Null texts have no words; rows of one id are texts of their own; a null id takes no part in the contract's draw. Words of any length are
taken. Nothing goes through the driver but counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import Scratch, slices

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
#: Words of one group that are compared with each other; larger groups are cut further.
LEAF = 64
#: Different words that a task counts before it hands them on.
HELD = 200_000
LETTER = "A-Za-zÀ-ÿ"


def _parts(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in parts of about ``size`` that end where no word goes on."""
    gap, at = re.compile(f"[^{LETTER}]"), 0
    while len(text) - at > size:
        found = gap.search(text, at + size)
        to = found.start() if found else len(text)
        yield text[at:to]
        at = to
    yield text[at:] if at else text


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, altered: Callable[[object, str], str] | None = None) -> DataFrame:
    """(word, n): the runs of Latin letters, A to Z lower-cased, with so many code points and occurrences in all texts.

    ``altered(id, word)`` may put another word in a word's place, for all its occurrences in a row.
    """
    word = re.compile(f"[{LETTER}]{{{min_chars},}}")

    def told(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches, 1):
            for of, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                mine: Counter = Counter()
                for part in _parts((value.as_py() or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")):
                    mine.update(word.findall(part))
                for w, n in mine.items():
                    held[altered(of, w) if altered else w] += n
                if len(held) > HELD:
                    yield told(held)
                    held.clear()
        yield told(held)

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(work, "word string, n long")
    rows = rows.groupBy("word").agg(F.sum("n").alias("n"))
    return rows.filter((F.col("n") >= min_count) & (F.char_length("word") >= min_chars))


def _key() -> Column:
    """Of all that is not open, with where it is open. Words of two groups that share a key by chance meet in vain."""
    tail = F.substr("word", F.col("hi") + F.when(F.col("probe"), 2).otherwise(1))
    return F.xxhash64("size", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")), tail)


def _cut(rows: DataFrame) -> DataFrame:
    """Both ways to keep half of what is open: its first half stays and the second is open, or the other way round."""
    middle = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2).cast("int")
    ways = F.array(F.struct(middle.alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), middle.alias("hi")))
    rows = rows.select("word", "n", "probe", "size", F.explode(ways).alias("open")).select("word", "n", "probe", "size", "open.lo", "open.hi")
    return rows.withColumn("key", _key())


def _met(rows: DataFrame) -> DataFrame:
    """Near pairs of the words of each group: an indexed word with another of its length, or with a longer one."""
    index = rows.filter(~F.col("probe")).select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    other = rows.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), "probe")
    near = (F.col("probe") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    return index.join(other, "key").filter(near).select("a", "n_a", "b", "n_b")


def near_pairs(words: DataFrame, scratch: Scratch, leaf: int = LEAF) -> DataFrame:
    """(a, n_a, b, n_b) for all pairs of different words (word, n) that are one inserted, deleted or replaced code point apart, once each."""
    length = F.char_length("word")
    roles = F.array(F.struct(F.lit(False).alias("probe"), length.alias("size")), F.struct(F.lit(True).alias("probe"), (length - 1).alias("size")))
    rows = words.select("word", "n", F.inline(roles)).withColumns({"lo": F.lit(0), "hi": F.col("size")})
    found = []
    while True:
        rows = scratch.cut(_cut(rows))
        # groups without an indexed word, or with one word alone, hold no pair
        groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("probe")).alias("indexed"))
        groups = scratch.cut(groups.filter((F.col("indexed") > 0) & (F.col("rows") > 1)).select("key", (F.col("rows") > leaf).alias("large")))
        rows = rows.join(groups, "key")
        cuttable = F.col("large") & (F.col("hi") - F.col("lo") > 1)
        found.append(scratch.cut(_met(rows.filter(~cuttable))))
        if groups.filter("large").isEmpty():
            break
        rows = scratch.cut(rows.filter(cuttable).drop("key", "large"))
        if rows.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of the words that have a form: each step follows twice as many forms as the one before."""
    links = scratch.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = scratch.cut(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = ahead.drop("moved")
        if ahead.filter("moved").isEmpty():
            return links


def variants(words: DataFrame, ratio: int = RATIO, leaf: int = LEAF) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of unique words (word, n); see above. Of equally frequent near words the smallest one counts."""
    with Scratch(words.sparkSession) as scratch:
        words = scratch.cut(words.select("word", "n"))
        pairs = scratch.cut(near_pairs(words, scratch, leaf))
        both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))
        best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best"))
        rows = words.join(best, "word", "left")
        form_n = F.when(-F.col("best.rank") >= ratio * F.col("n"), -F.col("best.rank"))
        rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form_n.isNotNull(), F.col("best.other")).alias("form"), form_n.alias("form_n"))
        rows = scratch.cut(rows)
        roots = _roots(rows.filter("form IS NOT NULL"), scratch)
        rows = rows.join(roots, "word", "left")
        return scratch.keep(rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
