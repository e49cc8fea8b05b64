"""What the ingestion writes. Everything goes through Spark's writers and their commit protocol; nothing is renamed by hand."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.upserts import Upserts


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for outputs that are read again, in the shared folder that ``spark.checkpoint.dir`` names; it goes when the application
    ends. Only in local mode, where all is one machine, may none be named."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/textloom-{uuid.uuid4().hex}")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return place.toString()


def written(rows: DataFrame) -> DataFrame:
    """``rows`` written to a folder of their own in the shared one and read again, so that they are computed once, however many queries use them."""
    where = scratch_folder(rows.sparkSession)
    rows.write.mode("overwrite").parquet(where)
    return rows.sparkSession.read.schema(rows.schema).parquet(where)


def write_index(rows: DataFrame, folder: str, version: int) -> None:
    """Writes the documents of one version, partitioned by index; the same version written again replaces itself."""
    Upserts(folder).write(rows, version)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, each as written in the highest version: an upsert by id."""
    return Upserts(folder).read(spark)


def append_status(rows: DataFrame, folder: str) -> None:
    """Appends records to the status log, as lines of JSON; times keep their microseconds."""
    rows.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(folder)


def append_errors(rows: DataFrame, folder: str) -> None:
    """Appends failures with their tracebacks, as lines of JSON."""
    rows.filter(F.col("error").isNotNull()).write.mode("append").json(folder)


def write_failed(rows: DataFrame, folder: str) -> None:
    """Failed files as path, tab, message."""
    rows.select("pdf_path", "error").write.mode("overwrite").option("sep", "\t").csv(folder)


def write_summary(row: DataFrame, folder: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(folder)


def write_triple(rows: DataFrame, folder: str, name: str = "stem") -> None:
    """Appends the three outputs of converted documents, a table each, keyed by the document's relative path."""
    for column in ("content_list", "middle", "markdown"):  # a document is done when its Markdown is there
        rows.select(name, F.col(column).alias("value")).write.mode("append").parquet(f"{folder.rstrip('/')}/{column}")
