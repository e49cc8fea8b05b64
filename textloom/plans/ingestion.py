"""The whole ingestion: files that are not done yet, parsed, cut, embedded, indexed, and told in the status log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import discovery, embedding, indexes, metrics, packing, structure
from textloom.sources import files, parsers, sinks
from textloom.sources.upserts import Upserts

#: Versions that a stream may take.
_BLOCK = 1 << 20


@dataclass(frozen=True)
class Ingestion:
    """input: folder of files; output: folder for the tables tasks, parsed, chunks, made, index, bulk, status, errors, failed and summary.

    parser: bytes to Markdown, at most ``timeout`` seconds a file (0: no limit); model: texts to vectors; send: the body of a bulk
    request to its answer, if the documents are to go to a search service as well, under ``prefix`` and the index's name. learned: the
    size of batches that the model takes, kept from run to run. strict_refs, paragraphs: see :func:`textloom.operators.structure.chunks`.
    """

    input: str
    output: str
    pattern: str = "*.pdf"
    parser: Callable[[bytes], str | parsers.Output] = files.as_text
    model: Callable = embedding.hashed
    send: Callable[[bytes], dict] | None = None
    prefix: str = ""
    max_attempts: int = discovery.MAX_ATTEMPTS
    limit: int = 0
    timeout: float = 600
    files_at_once: int = 20_000
    fragment_size: int = X.MAX_FRAGMENT
    learned: embedding.Learned | None = None
    strict_refs: bool = False
    paragraphs: str = "section"

    def __post_init__(self):
        for name in ("max_attempts", "files_at_once", "fragment_size"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} has to be positive")
        for name in ("limit", "timeout"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        if self.paragraphs not in structure.PARAGRAPHS:
            raise ValueError(f"paragraphs are one of {structure.PARAGRAPHS}")

    def at(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}"

    def _there(self, spark: SparkSession, read: Callable[[], DataFrame], schema: str) -> DataFrame:
        try:
            return read()
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return spark.createDataFrame([], schema)

    def status(self, spark: SparkSession) -> DataFrame:
        return self._there(spark, lambda: discovery.last_status(files.status_log(spark, self.at("status"))), files.STATUS)

    def _last(self, spark: SparkSession) -> int:
        return self._there(spark, lambda: spark.read.parquet(self.at("tasks")), "version int").agg(F.max("version")).first()[0] or 0

    def first_version(self, spark: SparkSession, stream: str) -> int:
        """Where the versions of a stream's batches begin: after all that were there when it first started, the same whenever it starts again.
        Runs and streams take turns; none writes while another one does."""
        rows = self._there(spark, lambda: spark.read.schema("stream string, first int").json(self.at("streams")), "stream string, first int")
        known = rows.filter(F.col("stream") == stream).first()
        if known:
            return known.first
        first = (self._last(spark) // _BLOCK + 1) * _BLOCK
        spark.createDataFrame([(stream, first)], "stream string, first int").write.mode("append").json(self.at("streams"))
        return first

    def _written(self, spark: SparkSession, rows: DataFrame, name: str, version: int, mode: str = "overwrite") -> DataFrame:
        """What is dear, or has to stay as it is, is written before anything is made of it."""
        where = self.at(f"{name}/version={version}")
        rows.write.mode(mode).parquet(where)
        return spark.read.schema(rows.schema).parquet(where)

    def run(self, spark: SparkSession, meta: DataFrame, version: int | None = None, todo: DataFrame | None = None) -> DataFrame | None:
        """One run; the summary of all records so far, with the counters of this run, which the writes observe as they go.

        ``todo``: (path, lngid, key, attempt), told by a stream, instead of what is in the input folder; then nothing is summed up, see
        :meth:`finish`. ``version``: one more than the last, unless told; the same one again replaces what it wrote.
        """
        if version is None:
            last = self._last(spark)
            version = last + 1 if last < _BLOCK else (last // _BLOCK + 1) * _BLOCK
        streamed, seen = todo is not None, metrics.Observed()
        if streamed:
            marked = todo.withColumns({"files": F.lit(1).cast("long"), "todo": F.lit(True)})
        else:
            found = discovery.identified(files.paths(spark, self.input, self.pattern), root=self.input)
            marked = discovery.marked(found, self.status(spark), self.max_attempts, self.limit)
        marked = self._written(spark, seen.counting(marked, metrics.DISCOVERY), "tasks", version)
        todo, mode, parsed = marked.filter("todo").select("path", "lngid", "key", "attempt"), "overwrite", None
        for content in files.contents(spark, todo, self.files_at_once):
            told = files.parsed(content, self.parser, self.timeout)
            parsed, mode = self._written(spark, seen.counting(told, metrics.PARSING), "parsed", version, mode), "append"
        if parsed is None:
            parsed = self._written(spark, files.parsed(todo.withColumn("content", F.lit(b"")), self.parser), "parsed", version)
        chunks = self._written(spark, structure.chunks(parsed.filter("error IS NULL"), "lngid", "markdown", self.strict_refs, self.paragraphs), "chunks", version)
        made = indexes.documents(chunks, meta, self.model, self.fragment_size, self.learned)
        made = self._written(spark, seen.counting(made, metrics.indexing(indexes.INDEXES)), "made", version)
        sinks.write_index(indexes.with_vector(made).drop("vector_error"), self.at("index"), version)
        bulk = None
        if self.send:
            bulk = self._written(spark, packing.sent(indexes.actions(made, self.prefix), self.send), "bulk", version)
        self._tell(spark, parsed, made, bulk)
        return None if streamed else self.finish(spark, seen.totals())

    def finish(self, spark: SparkSession, counted: dict[str, int] | None = None) -> DataFrame:
        """The list of failed files and the summary of all records so far, with what a run has ``counted``; both are written."""
        log = files.status_log(spark, self.at("status"))
        sinks.write_failed(discovery.last_status(log).filter(F.col("status") == discovery.FAILURE), self.at("failed"))
        counted = counted or {}
        summary = metrics.run_summary(log).withColumns({c: F.lit(counted.get(c, 0)).cast("long") for c in ("discovered", "skipped", "submitted", "retried", "parsed")})
        summary = summary.withColumn("counts", F.struct(*[F.lit(counted.get(i, 0)).cast("long").alias(i) for i in indexes.INDEXES]))
        summary = summary.withColumn("safe_batch", F.lit(self.learned.value if self.learned else None).cast("int"))
        sinks.write_summary(summary, self.at("summary"))
        return spark.read.schema(summary.schema).json(self.at("summary"))

    def compact(self, spark: SparkSession) -> None:
        """Merges the versions of the index into its base and removes what that replaces; for times at which nobody reads or writes it."""
        table = Upserts(self.at("index"))
        table.compact(spark)
        table.vacuum(spark)

    def _tell(self, spark: SparkSession, parsed: DataFrame, rows: DataFrame, bulk: DataFrame | None) -> None:
        """A record for each file: success only for documents that are in the index with all their texts."""
        made = rows.groupBy(F.col("file_id").alias("id")).agg(F.first("vector_error", ignorenulls=True).alias("refused"))
        if bulk is not None:
            unsent = bulk.groupBy(F.col("file_id").alias("of")).agg(F.min("bulk_error").alias("bulk_error"))
            made = made.join(unsent, F.col("id") == F.col("of"), "left").select("id", F.coalesce("refused", "bulk_error").alias("refused"))
        told = parsed.join(made, F.col("lngid") == F.col("id"), "left")
        stage = F.when(F.col("error").isNotNull() | F.col("id").isNull(), "parse").when(F.col("refused").isNotNull(), "index")
        error = F.coalesce("error", F.when(F.col("id").isNull(), F.lit("no chunk")), "refused")
        log = told.select("lngid", F.when(stage.isNull(), discovery.SUCCESS).otherwise(discovery.FAILURE).alias("status"), stage.alias("stage"), "attempt", error.alias("error"), F.col("path").alias("pdf_path"), F.localtimestamp().alias("timestamp"), F.coalesce("traceback", error).alias("traceback"))
        sinks.append_errors(log, self.at("errors"))
        sinks.append_status(log.drop("traceback"), self.at("status"))


def convert(spark: SparkSession, folder: str, output: str, parser: Callable[[bytes], parsers.Output], pattern: str = "*.pdf", timeout: float = 0, resume: bool = True, files_at_once: int = 20_000) -> DataFrame:
    """Files to Markdown, list of contents and middle form, three tables below ``output``, and the list of those that failed.

    Files are known by their path below ``folder`` without extension, not by their name alone, so files of one name in two folders
    do not stand for each other. With ``resume``, those that are there already are left out. One row: converted, failed.
    """
    # paths are told as Spark writes them, so the folder is found by its own end
    rows = files.paths(spark, folder, pattern).withColumn("stem", F.regexp_replace(F.substring_index("path", folder.rstrip("/") + "/", -1), r"\.[^./]*$", ""))
    if resume:
        try:
            rows = rows.join(spark.read.parquet(f"{output.rstrip('/')}/markdown").select("stem"), "stem", "left_anti")
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
    where = f"{output.rstrip('/')}/tasks"
    rows.select("path", "stem").write.mode("overwrite").parquet(where)
    todo = spark.read.schema("path string, stem string").parquet(where)
    told = f"{output.rstrip('/')}/parsed"
    files.parsed(todo.limit(0).withColumn("content", F.lit(b"")), parser).write.mode("overwrite").parquet(told)
    for content in files.contents(spark, todo, files_at_once):
        files.parsed(content, parser, timeout).write.mode("append").parquet(told)
    parsed = spark.read.parquet(told)
    sinks.write_triple(parsed.filter("error IS NULL"), output)
    sinks.write_failed(parsed.filter("error IS NOT NULL").withColumnRenamed("path", "pdf_path"), f"{output.rstrip('/')}/failed")
    return parsed.agg(F.count_if(F.col("error").isNull()).alias("converted"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def page_classes(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Pages cleaned, and counted by what can be done with the text: too short, embedded whole, or cut first."""
    text = X.clean(F.col(html_col))
    rows = pages.select(F.length(text).alias("n"), X.tokens(text).alias("tokens"), X.is_table(F.col(html_col)).alias("is_table"))
    kind = F.when(F.col("n") < X.MIN_PARAGRAPH, "short").when(F.col("n") <= X.MAX_PARAGRAPH, "paragraph").when(F.col("n") <= X.MAX_FRAGMENT, "long").otherwise("over")
    return rows.groupBy(kind.alias("class"), "is_table").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.col("n").cast("long")).alias("chars"), F.sum(F.col("tokens").cast("long")).alias("tokens"), F.max("n").alias("longest"))
