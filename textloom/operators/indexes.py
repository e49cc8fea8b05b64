"""The documents of the seven search indexes, with keys that stay the same from run to run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import embedding, fragments, packing

INDEXES = ["title", "abstract", "keyword", "fulltext", "paragraph", "sentence", "reference"]
COMMON = ("file_id", "doi", "firstwriter", "showwriter", "delete_flag")
_PLACE = {c: c for c in ("section_path", "element_type", "page_num", "source_chunk_id", "source_chunk_seq")} | {"fragment_seq": "fragment_index", "fragment_count": "fragment_count"}
#: The fields of each index besides the common ones, with the columns that they come from.
FIELDS = {
    "title": {"title_c": "title_c", "title_e": "title_e", "title_text": "text", "title_embedding": "vector"},
    "abstract": {"remark_c": "remark_c", "remark_e": "remark_e", "abstract_embedding": "vector"},
    "keyword": {"keyword_c": "keyword_c", "keyword_e": "keyword_e", "keyword_text": "text", "keyword_embedding": "vector"},
    "fulltext": {"full_text": "text", "full_embedding": "vector", "token_count": "token_count"},
    "paragraph": {"para_index": "source_index", "para_text": "text", "para_embedding": "vector", **_PLACE},
    "sentence": {"para_index": "source_index", "sent_seq": "sentence_index", "sent_text": "text", "sent_embedding": "vector", **_PLACE},
    "reference": {"ref_seq": "source_index", "ref_text": "text", "ref_embedding": "vector", **_PLACE},
}
META = ("title_c", "title_e", "keyword_c", "keyword_e", "remark_c", "remark_e", "doi", "firstwriter", "showwriter")


def with_lookup(rows: DataFrame, table: DataFrame, key: str, table_key: str, defaults: dict) -> DataFrame:
    """``rows`` with columns of a table of unique keys; what is not there has the default."""
    known = table.select(F.col(table_key).alias("__key"), *defaults)
    rows = rows.join(known, F.col(key) == F.col("__key"), "left").drop("__key")
    return rows.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def with_meta(rows: DataFrame, meta: DataFrame, key: str = "lngid") -> DataFrame:
    """``rows`` with a paper's metadata; what is not there is an empty string."""
    return with_lookup(rows, meta, key, "lngid", dict.fromkeys(META, ""))


def united(of: dict[str, DataFrame], doc: str = "doc") -> DataFrame:
    """Rows of several indexes that have one document a paper, as one table with index_name and _id; what an index has not is null."""
    rows = None
    for name, some in of.items():
        some = some.withColumns({"index_name": F.lit(name), "_id": F.concat_ws("_", F.col(doc).cast("string"), F.lit(name))})
        rows = some if rows is None else rows.unionByName(some, allowMissingColumns=True)
    return rows


def texts_to_embed(chunks: DataFrame, meta: DataFrame, size: int = X.MAX_FRAGMENT) -> DataFrame:
    """One row for each document of each index: index_name, _id, file_id, common fields, text, and what it comes from."""
    return _with_common(_texts(chunks, meta, size), meta)


def _with_common(rows: DataFrame, meta: DataFrame) -> DataFrame:
    return with_meta(rows, meta, "doc").withColumn("delete_flag", F.lit(0)).withColumnRenamed("doc", "file_id")


def _texts(chunks: DataFrame, meta: DataFrame, size: int) -> DataFrame:
    """The rows of :func:`texts_to_embed` without the common fields, which the model does not need."""
    rows = fragments.grouped(chunks)
    place = F.concat(F.when(F.col("reference"), "_r").otherwise("_p"), F.col("source_index").cast("string"))
    piece = F.concat(F.lit("_f"), F.col("fragment_index").cast("string"))
    told = fragments.text_fragments(rows, size)
    told = told.select("*", F.when(F.col("reference"), "reference").otherwise("paragraph").alias("index_name"), F.concat("doc", place, piece).alias("_id"))
    spoken = fragments.sentence_fragments(rows.filter(~F.col("reference")), size)
    spoken = spoken.select("*", F.lit("sentence").alias("index_name"), F.concat("doc", place, F.lit("s"), F.col("sentence_index").cast("string"), piece).alias("_id"))
    out = told.unionByName(spoken, allowMissingColumns=True)
    full = united({"fulltext": fragments.full_texts(chunks, size).select("doc", F.col("full_text").alias("text"), "token_count")})
    docs = with_meta(chunks.select("doc").distinct(), meta, "doc")
    pairs = {"title": ("title_c", "title_e"), "abstract": ("remark_c", "remark_e"), "keyword": ("keyword_c", "keyword_e")}
    listed = F.array(*[F.struct(F.lit(k).alias("index_name"), fragments.two_languages(F.col(a), F.col(b), size).alias("text")) for k, (a, b) in pairs.items()])
    heads = docs.select("doc", F.inline(listed)).withColumn("_id", F.concat_ws("_", "doc", "index_name"))
    return out.unionByName(full, allowMissingColumns=True).unionByName(heads, allowMissingColumns=True).filter(F.col("text") != "")


def documents(chunks: DataFrame, meta: DataFrame, model: Callable = embedding.hashed, size: int = X.MAX_FRAGMENT, learned: embedding.Learned | None = None, only: str | None = None) -> DataFrame:
    """The rows of :func:`texts_to_embed`, ``only`` of one index if told, with their vectors; those that have none are the failed ones, see
    ``vector_error``. Texts of other indexes are neither made nor given to the model."""
    texts = _texts(chunks, meta, size)
    rows = embedding.embedded(texts if only is None else texts.filter(F.col("index_name") == only), model, learned=learned)
    told = [c for c in rows.columns if c not in ("vector", "vector_error")]
    return _with_common(rows, meta).select(*["file_id" if c == "doc" else c for c in told], *META, "delete_flag", "vector", "vector_error")


def with_vector(rows: DataFrame) -> DataFrame:
    """The documents that are written: those without a vector are not."""
    return rows.filter(F.size("vector") > 0)


def of_index(rows: DataFrame, name: str) -> DataFrame:
    """The documents of one index, with the fields that it has."""
    return with_vector(rows).filter(F.col("index_name") == name).select("_id", *COMMON, *[F.col(c).alias(f) for f, c in FIELDS[name].items()])


def actions(rows: DataFrame, prefix: str = "") -> DataFrame:
    """(file_id, index_name, _id, line): what a bulk interface takes, for documents with a vector; ``prefix`` comes before the indexes' names."""
    line = None
    for name, fields in FIELDS.items():
        source = F.struct(*COMMON, *[F.col(c).alias(f) for f, c in fields.items()])
        told = packing.ndjson(F.lit(f"{prefix}{name}"), F.col("_id"), source)
        line = F.when(F.col("index_name") == name, told) if line is None else line.when(F.col("index_name") == name, told)
    return with_vector(rows).select("file_id", "index_name", "_id", line.alias("line"))
