"""A search service as a sink of Spark's: bulk requests from every task, and one answer for the whole write.

    spark.dataSource.register(bulk.sink(send))
    indexes.actions(made).write.format("bulk").mode("append").option("log", folder).save()

Each task packs the lines of its whole partition into requests and sends them; its commit message carries the milliseconds that its
requests took, whether any document was refused, how many were sent, and the first refused ones. The driver's commit sums the messages
up and appends one record to ``log``, as does an abort, with what had been sent by then. A stream's sink does so for each batch. Documents
have ids, so what is sent twice, by a task or a batch that runs again, is written once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from textloom.operators import packing

#: Refused documents that are named in the log; of the others their number is told.
NAMED = 5


@dataclass
class Answer(WriterCommitMessage):
    took: int = 0
    items: int = 0
    failed: int = 0
    first: list = field(default_factory=list)


def total(answers: list) -> dict:
    """One answer of all tasks' (None: tasks that did not end)."""
    ended = [a for a in answers if a is not None]
    first = sorted(x for a in ended for x in a.first)[:NAMED]
    failed = sum(a.failed for a in ended)
    return {"tasks": len(ended), "took": sum(a.took for a in ended), "errors": failed > 0, "items": sum(a.items for a in ended), "failed": failed, "first_failed": first, "more": failed - len(first)}


def _append(folder: str | None, record: dict) -> None:
    """A file of one line in the log; a new name each, so records need no lock."""
    if folder:
        system, path = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(record, ensure_ascii=False).encode() + b"\n")


def sink(send: Callable[[bytes], dict], name: str = "bulk", max_count: int = packing.MAX_COUNT, max_bytes: int = packing.MAX_BYTES) -> type[DataSource]:
    """A data source for rows with ``_id`` and ``line`` (see :func:`textloom.operators.indexes.actions`), to be registered under its name."""

    class Writer:
        def __init__(self, log: str | None):
            self.log = log

        def write(self, batches: Iterator[pa.RecordBatch]) -> Answer:
            mine = Answer()
            for some, took, errors in packing.requests(batches, send, "line", max_count, max_bytes):
                refused = [(i, e) for i, e in zip(some.column("_id").to_pylist(), errors) if e]
                mine.took, mine.items, mine.failed = mine.took + took, mine.items + some.num_rows, mine.failed + len(refused)
                mine.first = sorted([*mine.first, *refused])[:NAMED]
            return mine

        def commit(self, messages: list, *batch: int) -> None:
            _append(self.log, {"state": "committed", "batch": batch[0] if batch else None, **total(messages)})

        def abort(self, messages: list, *batch: int) -> None:
            _append(self.log, {"state": "aborted", "batch": batch[0] if batch else None, **total(messages)})

    class Table(Writer, DataSourceArrowWriter):
        pass

    class Stream(Writer, DataSourceStreamArrowWriter):
        pass

    class Bulk(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> Table:
            return Table(self.options.get("log"))

        def streamWriter(self, schema, overwrite: bool) -> Stream:
            return Stream(self.options.get("log"))

    return Bulk
