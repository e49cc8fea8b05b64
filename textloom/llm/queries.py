"""The queries of the operators: each applies its operator to a whole table and derives the contract's columns."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import chat, decontam, html, licenses, mixing, neardup, periodic, pii, quality, spelling, substrings, toxicity, warc
from textloom.llm.common import WORD, barrier
from textloom.llm.sql import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.plan(_table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken, "source", "copies")


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op3_transaction_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"), "refers_to")


def op4_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = neardup.components_of(_table(spark, sf_dir, "documents"))
    kept = F.col("id") == F.col("component")
    return rows.select(F.col("id").alias("doc_id"), F.col("n_shingles").cast("long"), F.col("component").alias("component_id"), F.coalesce(kept, F.lit(True)).alias("kept"))


def op5_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html.with_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep_html=False)
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.render(_table(spark, sf_dir, "conversations"))
    return rows.select(F.col("conv").alias("conv_id"), "n_turns", "n_copies", "part", "text")


def op7_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontam.summary(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated", "longest")


def op8_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.with_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return rows.drop("detections")


def op9_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.with_kept(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    n_removed = n_bytes - F.octet_length("kept").cast("long")
    return rows.select("doc_id", n_bytes.alias("n_bytes"), n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.sanitised(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "masked")
    told = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"] != "term")
    number = [F.size(F.array_remove(F.transform("spans", lambda x: F.when(x["kind"] == k, 1).otherwise(0)), 0)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return rows.select("doc_id", *number, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document, by the checksum of its id, is made to repeat itself from some word on before the runs are looked for."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    tail = F.coalesce(draw % 10 == 0, F.lit(False))
    rows = barrier(docs, g=F.floor(draw / 10), words=F.when(tail, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    n, a = F.size("words"), (F.col("g") % F.size("words")).cast("int")
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    rows = rows.select("doc_id", "text", "words", F.when(n > 0, n).alias("n"), F.when(n > 0, a).alias("a"), "g").withColumn("p", p)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    planted = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", place(i))), " ")
    rows = periodic.with_runs(rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text")), keep_text=False)
    told = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    rows = rows.withColumn("top", F.array_min(F.transform("runs", lambda x: F.struct((-x["length"]).alias("length"), x["start"].alias("start"), x["period"].alias("period")))))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", (-F.col("top.length")).alias("length"), "top.period", F.expr("(-1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _misspelt(doc_id: int | None, word: str) -> str:
    """One of 199 words of a document, by the checksum of both, loses a code point."""
    h = zlib.crc32(f"{doc_id}:{word}".encode("utf-8", "surrogatepass")) if doc_id is not None else 1
    return word if h % 199 else word[: h % len(word)] + word[h % len(word) + 1 :]


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted(_table(spark, sf_dir, "documents"), altered=_misspelt))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the held-out third are taken away before anything is learned."""
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = toxicity.learned(docs, labels.filter(~held))
    rows = toxicity.scored(docs, model, keep_text=False)
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"), "threshold", "flagged")


QUERIES = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_line_frequency": op2_line_frequency,
    "op3_transaction_assembly": op3_transaction_assembly,
    "op4_chosen_path_join": op4_chosen_path_join,
    "op5_site_templates": op5_site_templates,
    "op6_snapshot_collapse": op6_snapshot_collapse,
    "op7_suffix_decontamination": op7_suffix_decontamination,
    "op8_signature_rules": op8_signature_rules,
    "op9_suffix_sort": op9_suffix_sort,
    "op10_disclosure": op10_disclosure,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_toxicity": op13_toxicity,
}
