"""What the ingestion reads: files, documents parsed from them, the status log."""

from __future__ import annotations

import re
import traceback
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.sources import parsers

STATUS = "lngid string, status string, stage string, attempt int, error string, pdf_path string, timestamp timestamp_ntz"


def paths(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, modified, size) of the files below a folder; their bytes are not read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return rows.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def contents(spark: SparkSession, rows: DataFrame, at_once: int = 20_000) -> Iterator[DataFrame]:
    """``rows`` (path and narrow columns) with ``content``, so many files at once: no other file is opened. The driver holds the rows of one
    part, which are named to all tasks, so the bytes of files are not shuffled."""

    def read(some: list) -> DataFrame:
        plain = [re.sub(r"([\\\[\]{}*?])", r"\\\1", row.path) for row in some]  # names are no patterns
        told = F.broadcast(spark.createDataFrame(some, rows.schema))
        return spark.read.format("binaryFile").load(plain).select("path", "content").join(told, "path")

    part: list = []
    for row in rows.toLocalIterator():
        part.append(row)
        if len(part) == at_once:
            yield read(part)
            part = []
    if part:
        yield read(part)


def stems(rows: DataFrame, path_col: str = "path") -> DataFrame:
    """The distinct file names without folder and extension, as of processed outputs."""
    name = F.regexp_extract(path_col, r"([^/]*)$", 1)
    return rows.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("stem")).distinct()


def records(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """The status records of lines of JSON; lines that are blank or broken, or name no document, are skipped."""
    schema = f"{STATUS}, _corrupt_record string"
    told = F.from_json(F.col(line_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = lines.select(told.alias("told")).select("told.*")
    return rows.filter(F.col("_corrupt_record").isNull() & F.col("lngid").isNotNull()).drop("_corrupt_record")


def status_log(spark: SparkSession, folder: str) -> DataFrame:
    return records(spark.read.text(folder))


def as_text(content: bytes) -> str:
    """A stand-in for a parser: the bytes as UTF-8."""
    return content.decode("utf-8")


def parsed(rows: DataFrame, parser: Callable[[bytes], str | parsers.Output], timeout: float = 0) -> DataFrame:
    """``rows`` with ``markdown``, ``content_list``, ``middle``, ``error``, ``traceback`` and ``device`` in place of ``content``; a file that the
    parser fails on or takes over ``timeout`` seconds for (0: no limit), or that has no text, is a row with an error. ``device`` is the
    accelerator that Spark gave to the task, if it gives any."""
    kept = [f for f in rows.schema.fields if f.name != "content"]
    told = ["markdown", "content_list", "middle", "error", "traceback", "device"]
    schema = T.StructType([*kept, *[T.StructField(c, T.StringType()) for c in told]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = parsers.within(timeout, parser) if timeout > 0 else parser
        device = parsers.device()
        for batch in batches:
            found = []
            for content in batch.column(batch.schema.names.index("content")):
                try:
                    out = parse(content.as_py() or b"")
                    out = out if isinstance(out, parsers.Output) else parsers.Output(out)
                    blank = not out.markdown or out.markdown.isspace()
                    found.append((None, out.content_list, out.middle, "empty Markdown", None) if blank else (*out, None, None))
                except parsers.Failed as failed:
                    found.append((None, None, None, failed.args[0][:500], failed.args[1]))
                except Exception as failed:
                    found.append((None, None, None, f"{type(failed).__name__}: {failed}"[:500], traceback.format_exc()))
            columns = [*(list(zip(*found)) or [()] * (len(told) - 1)), [device] * len(found)]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.names.index(f.name)) for f in kept], *[pa.array(c, pa.string()) for c in columns]], names=schema.names)

    return rows.mapInArrow(work, schema)
