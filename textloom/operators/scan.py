"""A walk along a stream that is cut into blocks, as a scan over summaries of the blocks.

Where a block ends a walk depends on where it enters the block, in one of a fixed number of ways. So a block is summed up by where each
way in leads to (``exits``: the way into the next block) and how many steps it takes (``steps``). Two summaries make one of both, so
``fan`` blocks are summed up by one task, so many of these again by one, and back down each task tells its blocks how they are
entered. A stream of 10**10 rows in blocks of 10**4 is three levels, each task holds ``fan`` summaries, whatever the stream's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 1_000
SUMMARY = "exits array<int>, steps array<long>"


def _matrix(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(flat), -1)


def _walked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the blocks; before each of them and after the last: way in, steps so far), a column for each way into the first."""
    order = np.argsort(table.column("__block").to_numpy())
    exits, steps = _matrix(table.column("exits"), np.int64)[order], _matrix(table.column("steps"), np.int64)[order]
    way, done = [np.arange(exits.shape[1])], [np.zeros(exits.shape[1], np.int64)]
    for out, n in zip(exits, steps):
        done.append(done[-1] + n[way[-1]])
        way.append(out[way[-1]])
    return order, np.array(way), np.array(done)


def _composed(table: pa.Table) -> pa.Table:
    """One summary of neighbouring blocks."""
    _, way, done = _walked(table)
    first = table.slice(0, 1)
    return pa.table({"__key": first.column("__key"), "__block": first.column("__up"), "exits": pa.array([way[-1].tolist()], pa.list_(pa.int32())), "steps": pa.array([done[-1].tolist()], pa.list_(pa.int64()))})


def _entered(table: pa.Table) -> pa.Table:
    """How each of neighbouring blocks is entered, from how the first of them is."""
    order, way, done = _walked(table)
    enter, before = (table.column(c)[0].as_py() for c in ("enter", "before"))
    blocks = table.column("__block").to_numpy()[order]
    return pa.table({"__key": table.column("__key").take(pa.array(order)), "__block": blocks, "enter": pa.array(way[:-1, enter], pa.int32()), "before": pa.array(before + done[:-1, enter], pa.int64())})


def entries(blocks: DataFrame, fan: int = FAN) -> DataFrame:
    """(__key, __block, enter, before) of the blocks (__key, __block from 0 without gaps, exits, steps) of any number of streams: the way in
    and the steps before it. Streams are entered at the first way.

    The summaries are read twice a level; where they are dear, give them as a written table. The driver learns the highest number.
    """
    kind = blocks.schema["__key"].dataType.simpleString()
    last, levels = blocks.agg(F.max("__block")).first()[0] or 0, [blocks]
    while last >= fan:
        up = levels[-1].withColumn("__up", F.floor(F.col("__block") / fan))
        levels.append(up.groupBy("__key", "__up").applyInArrow(_composed, f"__key {kind}, __block long, {SUMMARY}"))
        last //= fan
    found = None
    for level in reversed(levels):
        rows = level.withColumn("__up", F.floor(F.col("__block") / fan))
        if found is None:
            rows = rows.withColumns({"enter": F.lit(0), "before": F.lit(0).cast("long")})
        else:
            above = found.select(F.col("__key").alias("__of"), F.col("__block").alias("__at"), "enter", "before")
            rows = rows.join(above, F.col("__key").eqNullSafe(F.col("__of")) & (F.col("__up") == F.col("__at"))).drop("__of", "__at")
        found = rows.groupBy("__key", "__up").applyInArrow(_entered, f"__key {kind}, __block long, enter int, before long")
    return found
