"""Progress of a stream while it runs: told by a listener, from what the stream observes of itself."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

FIRST, EVERY = 10, 100
_NAME = "files begun"


def observed(todo: DataFrame) -> DataFrame:
    """A stream of files to be done (with ``attempt``), counted as it runs. What follows has to take each batch once."""
    return todo.observe(_NAME, F.count(F.lit(1)).alias("files"), F.count_if(F.col("attempt") > 1).alias("retried"))


class Progress(StreamingQueryListener):
    """Tells how many files were begun: after each batch with one of the first ten, or that passes another ``every`` of them.

    To be added with ``spark.streams.addListener``; ``tell`` takes a line, and by default writes it to the log.
    """

    def __init__(self, every: int = EVERY, tell: Callable[[str], None] = logging.getLogger("textloom").info):
        self.every, self.tell = every, tell
        self.files = self.retried = self.batches = 0

    def onQueryStarted(self, event) -> None:
        self.files = self.retried = self.batches = 0

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(_NAME)
        if seen is None or not seen.files:
            return
        before = self.files
        self.files, self.retried, self.batches = self.files + seen.files, self.retried + seen.retried, self.batches + 1
        if before < FIRST or self.files // self.every > before // self.every:
            rate = event.progress.processedRowsPerSecond or 0.0
            self.tell(f"{self.files} files begun, {self.retried} of them again, {rate * 3600:.0f} an hour, batch {event.progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.tell(f"{self.files} files in {self.batches} batches" + (f"; ended by {event.exception}" if event.exception else ""))
