"""Index documents as lines of JSON, packed into requests of bounded count and size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators import scan
from textloom.operators.numbering import in_blocks, numbered

#: A request's documents and bytes; how often a refused one is halved, and how small its limit may become.
MAX_COUNT = 100
MAX_BYTES = 2 << 20
MIN_BYTES = 1 << 19
RETRIES = 3


def ndjson(index: Column, doc_id: Column, source: Column) -> Column:
    """The two lines of a document: where it goes, and the document; compact, not escaped beyond need."""
    head = F.to_json(F.struct(F.struct(index.alias("_index"), doc_id.alias("_id")).alias("index")))
    return F.concat(head, F.lit("\n"), F.to_json(source, {"ignoreNullFields": "false"}), F.lit("\n"))


def size(line: Column) -> Column:
    return F.octet_length(line)


def _next_batch(sizes: np.ndarray, own: int, max_count: int, max_bytes: int) -> np.ndarray:
    """For a batch that begins at each of the first ``own`` rows, the row at which the next one begins."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    full = np.searchsorted(total, total[:own] + max_bytes, "right") - 1
    return np.minimum(full, np.minimum(np.arange(own) + max_count, len(sizes)))


def _block(table: pa.Table) -> tuple[pa.Table, np.ndarray, int]:
    """(rows of a block by number, their sizes, how many are its own); those of the next block come last."""
    table = table.take(pa.array(np.argsort(table.column("__n").to_numpy(), kind="stable")))
    return table, table.column("__bytes").to_numpy().astype(np.int64), int(np.count_nonzero(table.column("__own").to_numpy()))


def packed(
    rows: DataFrame, group: str, order: str, bytes_col: str, max_count: int = MAX_COUNT, max_bytes: int = MAX_BYTES, bucket: Column | None = None, block: int = 10_000, fan: int = scan.FAN, keep: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """``rows`` with ``batch``: within a group, in order, a batch is closed when it is full or the next row would not fit.

    What fits depends on all before it, but a batch that reaches into a block ends in its first ``max_count`` rows. So for each row of
    a block the next begin of a batch is searched in the running sum of bytes, begins are followed to the block's end by pointer
    doubling, from each row at which the block may be entered, and a scan over the blocks tells at which it is. A group of any size is as
    many tasks as it has blocks, if ``bucket`` (see :func:`numbered`) cuts it into parts; without it, numbering is one task a group.
    ``keep`` may write the summaries of blocks, a few numbers a row at most, where making them twice is dear.

    A row that is too large by itself has batch -1 and parts nothing; a null size is 0. ``order`` has to be unique within a group.
    """
    block = max(block, max_count)
    size = F.coalesce(F.col(bytes_col), F.lit(0))
    large = rows.filter(size > max_bytes).withColumn("batch", F.lit(-1).cast("long"))
    parts = numbered(rows.filter(size <= max_bytes), (group,), (order,), F.lit(0) if bucket is None else bucket, "__n")
    parts = in_blocks(parts.withColumn("__bytes", size.cast("long")), block, max_count, "__n", after=True)
    kind = rows.schema[group].dataType.simpleString()

    def summary(key: tuple, table: pa.Table) -> pa.Table:
        _, sizes, own = _block(table)
        hop = np.append(_next_batch(sizes, own, max_count, max_bytes), np.arange(own, own + max_count))
        steps = (np.arange(len(hop)) < own).astype(np.int64)
        while (hop[:own] < own).any():
            steps, hop = np.where(hop < own, steps + steps[np.minimum(hop, own)], steps), np.where(hop < own, hop[np.minimum(hop, own)], hop)
        ways = min(own, max_count)
        exits, taken = np.zeros(max_count, np.int32), np.zeros(max_count, np.int64)
        exits[:ways], taken[:ways] = hop[:ways] - own, steps[:ways]
        return pa.table({"__key": pa.array([key[0].as_py()], table.schema.field(group).type), "__block": pa.array([key[1].as_py()], pa.int64()), "exits": pa.array([exits], pa.list_(pa.int32())), "steps": pa.array([taken], pa.list_(pa.int64()))})

    narrow = parts.select(F.col(group), "__block", "__own", "__n", "__bytes")
    entered = scan.entries(keep(narrow.groupBy(group, "__block").applyInArrow(summary, f"__key {kind}, __block long, {scan.SUMMARY}")), fan)
    entered = entered.select(F.col("__key").alias("__of"), F.col("__block").alias("__at"), "enter", "before")
    names, schema = rows.columns, T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])

    def deal(table: pa.Table) -> pa.Table:
        table, sizes, own = _block(table)
        following, begins = _next_batch(sizes, own, max_count, max_bytes).tolist(), np.zeros(own, np.int64)
        at = table.column("enter")[0].as_py()
        while at < own:
            begins[at] = 1
            at = following[at]
        batch = table.column("before")[0].as_py() + np.cumsum(begins) - 1
        return table.slice(0, own).select(names).append_column("batch", pa.array(batch, pa.int64()))

    known = parts.join(entered, F.col(group).eqNullSafe(F.col("__of")) & (F.col("__block") == F.col("__at"))).drop("__of", "__at")
    return known.groupBy(group, "__block").applyInArrow(deal, schema).unionByName(large)


def packed_by_count(rows: DataFrame, group: str, order: tuple[str, ...], bucket: Column, max_count: int = MAX_COUNT) -> DataFrame:
    """``rows`` with ``batch``, of ``max_count`` each within a group; ``bucket``: see :func:`numbered`."""
    return numbered(rows, (group,), order, bucket, "__n").withColumn("batch", F.floor((F.col("__n") - 1) / max_count)).drop("__n")


class TooLarge(Exception):
    """What a ``send`` raises when the other side refuses a request for its size."""


def _batches(lines: list[bytes], max_count: int, max_bytes: float) -> Iterator[list[bytes]]:
    """Greedy: a batch is closed when it is full or the next line would not fit. A line over the limit is a batch of its own."""
    batch: list[bytes] = []
    size = 0
    for line in lines:
        if batch and (len(batch) >= max_count or size + len(line) > max_bytes):
            yield batch
            batch, size = [], 0
        batch.append(line)
        size += len(line)
    if batch:
        yield batch


def deliver(send: Callable[[bytes], dict], lines: list[bytes], max_bytes: float, depth: int = 0) -> tuple[int, list[str | None]]:
    """(milliseconds, an error or null for each line). A request that fails or is too large goes again in halves, three times at most."""
    try:
        told = send(b"".join(lines))
    except Exception as failed:
        if len(lines) == 1 or depth == RETRIES:
            return 0, [f"{type(failed).__name__}: {failed}"[:500]] * len(lines)
        took, errors = 0, []
        for some in _batches(lines, len(lines) // 2, max(max_bytes / 2, MIN_BYTES)):
            more, found = deliver(send, some, max(max_bytes / 2, MIN_BYTES), depth + 1)
            took, errors = took + more, errors + found
        return took, errors
    items = [next(iter(x.values()), {}) for x in told.get("items", [])]
    if len(items) != len(lines):
        return told.get("took", 0), ["no answer" if told.get("errors") or items else None] * len(lines)
    return told.get("took", 0), [str(x["error"])[:500] if x.get("error") else None for x in items]


def requests(batches: Iterator[pa.RecordBatch], send: Callable[[bytes], dict], line_col: str, max_count: int = MAX_COUNT, max_bytes: int = MAX_BYTES) -> Iterator[tuple[pa.Table, int, list[str | None]]]:
    """(rows of a request, milliseconds, an error or null for each) of a task's rows: requests go on over the batches in which rows come, so
    only the task's last one is not full. A line over the limit is not sent, and is an error."""

    def done(table: pa.Table, some: list[bytes]) -> tuple[pa.Table, int, list[str | None]]:
        if len(some[0]) > max_bytes:
            return table, 0, [f"one document of {len(some[0])} bytes is over the limit of {max_bytes}"]
        return table, *deliver(send, some, max_bytes)

    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        at, parts = 0, list(_batches([x.encode() for x in table.column(line_col).to_pylist()], max_count, max_bytes))
        for some in parts[:-1]:
            yield done(table.slice(at, len(some)), some)
            at += len(some)
        rest = table.slice(at)
    if rest is not None and rest.num_rows:
        yield done(rest, [x.encode() for x in rest.column(line_col).to_pylist()])


def sent(rows: DataFrame, send: Callable[[bytes], dict], line_col: str = "line", max_count: int = MAX_COUNT, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``rows`` without their line, with ``took`` (of the request, at its first row) and ``bulk_error``: each task packs its rows as they
    come and sends them. Documents have ids, so a task that is run again writes the same ones again. Where the answer to each
    document is not needed, see :mod:`textloom.sources.bulk`.

    ``send`` takes the body of a request and gives {"took", "errors", "items"}, as bulk interfaces do, or raises.
    """
    kept = [f for f in rows.schema.fields if f.name != line_col]
    schema = T.StructType([*kept, T.StructField("took", T.LongType()), T.StructField("bulk_error", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, ms, errors in requests(batches, send, line_col, max_count, max_bytes):
            told = some.select([f.name for f in kept]).append_column("took", pa.array([ms] + [0] * (len(errors) - 1), pa.int64())).append_column("bulk_error", pa.array(errors, pa.string()))
            yield from told.combine_chunks().to_batches()

    return rows.mapInArrow(work, schema)


def merged(results: DataFrame) -> DataFrame:
    """One row of the answers to all requests: took, errors, items, and the first failed ones."""
    failed = F.when(F.col("bulk_error").isNotNull(), F.struct("index_name", "_id", "bulk_error"))
    return results.agg(F.coalesce(F.sum("took"), F.lit(0)).alias("took"), F.coalesce(F.bool_or(F.col("bulk_error").isNotNull()), F.lit(False)).alias("errors"), F.count(F.lit(1)).alias("items"), F.count("bulk_error").alias("failed"), F.min(failed).alias("first_failed"))
