"""The ingestion as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from textloom.operators import discovery
from textloom.plans.ingestion import Ingestion
from textloom.streaming import progress, stateful

FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest(spark: SparkSession, job: Ingestion, meta: DataFrame, checkpoint: str, files_per_batch: int = 64) -> StreamingQuery:
    """All files that are there and were not read before, in batches; each batch is one run of the job, and a batch that is run
    again after a failure writes the same versions again.

    The stream is of paths: the state knows the ids that were begun, from the status log at the stream's start and from its own batches,
    and only files that are to be done are opened. A :class:`textloom.streaming.progress.Progress` tells how far it is. ``job.finish`` sums up the log once the stream is done.
    """
    arriving = (
        spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", job.pattern).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(job.input).select("path")
    )
    todo = progress.observed(stateful.begun_once(discovery.identified(arriving, root=job.input), job.status(spark), job.max_attempts))
    first = job.first_version(spark, checkpoint)
    return todo.writeStream.foreachBatch(lambda batch, number: job.run(spark, meta, first + number, batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
