"""Chunks cut into what an embedding model takes: text fragments, sentence fragments, whole texts and titles.

Input: chunks as of :func:`textloom.operators.structure.chunks`, one row each. Positions are counted from 0 among the chunks of
a document's group (references, or all others), those without text included, so ids do not move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators.structure import ENTRY, REFERENCES


def is_reference(element_type: Column, path: Column) -> Column:
    return element_type.isin(REFERENCES, ENTRY) | F.coalesce(path.contains(REFERENCES), F.lit(False))


def grouped(chunks: DataFrame) -> DataFrame:
    """``chunks`` with ``reference`` and ``source_index``, the place in the group."""
    rows = chunks.withColumn("reference", is_reference(F.col("element_type"), F.col("section_path")))
    return rows.withColumn("source_index", F.row_number().over(Window.partitionBy("doc", "reference").orderBy("chunk_seq")) - 1)


def _carried() -> list:
    return ["doc", "reference", "source_index", F.col("id").alias("source_chunk_id"), F.col("chunk_seq").alias("source_chunk_seq"), "section_path", "page_num", "element_type"]


def text_fragments(rows: DataFrame, size: int = X.MAX_FRAGMENT) -> DataFrame:
    """A row for each fragment of the rows of :func:`grouped`: text, fragment_index, fragment_count and where it comes from."""
    rows = rows.filter(X.strip(F.col("text")) != "").withColumn("parts", X.safe_fragments(F.col("text"), size))
    return rows.select(F.size("parts").alias("fragment_count"), F.posexplode("parts").alias("fragment_index", "fragment"), *_carried()).withColumnRenamed("fragment", "text")


def sentence_fragments(rows: DataFrame, size: int = X.MAX_FRAGMENT) -> DataFrame:
    """The same by sentence; sentences of under two characters are left out, and keep their number."""
    rows = rows.filter(X.strip(F.col("text")) != "").select(F.posexplode(X.sentences(X.strip(F.col("text")))).alias("sentence_index", "sentence"), *_carried())
    rows = rows.filter(F.length("sentence") >= X.MIN_SENTENCE).withColumn("parts", X.safe_fragments(F.col("sentence"), size))
    rows = rows.select("*", F.size("parts").alias("fragment_count"), F.posexplode("parts").alias("fragment_index", "text"))
    return rows.drop("sentence", "parts")


def full_texts(chunks: DataFrame, size: int = X.MAX_FRAGMENT) -> DataFrame:
    """(doc, full_text, token_count): all chunks of a document in one line; over-long texts are blank, their tokens are told."""
    told = F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("chunk_seq", "text"))))
    joined = chunks.groupBy("doc").agg(X.squeeze(F.array_join(F.transform(told, lambda x: x["text"]), "\n")).alias("whole"))
    return joined.select("doc", F.when(F.length("whole") <= size, F.col("whole")).otherwise("").alias("full_text"), X.tokens(F.col("whole")).alias("token_count"))


def two_languages(first: Column, second: Column, size: int = X.MAX_FRAGMENT) -> Column:
    both = X.strip(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(second, F.lit(""))))
    return F.when(F.length(both) <= size, both).otherwise("")
