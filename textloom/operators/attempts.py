"""What became of attempts: the events that begin and end them, paired, and those that took too long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.metrics import seconds_between
from textloom.operators.numbering import in_blocks, numbered

ENDED, RESTARTED, TIMEOUT, OPEN = "ended", "restarted", "timeout", "open"


def outcomes(events: DataFrame, key: str, begins: Column, ends: Column, limit: float, ts: str = "ts", tie: str = "event_id", until: Column | None = None, unit: str = "day", block: int = 10_000) -> DataFrame:
    """(key, tie, ts, outcome, seconds): a row for each event that ``begins`` an attempt of the key, from a log of events.

    The key's next event that begins or ends one decides, if it comes within ``limit`` seconds: "ended" or "restarted", after so many
    seconds. Else the attempt is a "timeout" after ``limit`` seconds, whatever comes later, or still "open" if the log ends (or
    ``until`` is) before. Other events are passed over; ends without a begin say nothing.

    A key's events are numbered by ``unit`` of time and cut into blocks that have the event before them too: an event decides on the
    one before it, and the last one of a key is told by itself. So a key is as many tasks as it has blocks.
    """
    of_begin, of_end = F.coalesce(begins, F.lit(False)), F.coalesce(ends, F.lit(False))
    rows = events.select(F.col(key), F.col(tie), F.col(ts), of_begin.alias("__begins"), of_end.alias("__ends")).filter("__begins OR __ends")
    told = numbered(rows, (key,), (ts, tie), F.date_trunc(unit, F.col(ts)), "__n")
    order = Window.partitionBy(key, "__block").orderBy("__n")
    before = F.lag(F.struct(F.col(tie), F.col(ts), F.col("__begins"))).over(order)
    paired = in_blocks(told, block, 1, "__n").withColumn("__before", before).filter(F.col("__own") & F.col("__before.__begins"))
    paired = paired.select(key, F.col(f"__before.{tie}").alias(tie), F.col(f"__before.{ts}").alias("__at"), F.col(ts).alias("__next"), F.when(F.col("__begins"), RESTARTED).otherwise(ENDED).alias("__as"))
    last = rows.groupBy(key).agg(F.max_by(F.struct(F.col(tie), F.col(ts), F.col("__begins")), F.struct(ts, tie)).alias("__last")).filter("__last.__begins")
    last = last.select(key, F.col(f"__last.{tie}").alias(tie), F.col(f"__last.{ts}").alias("__at"), F.lit(None).cast(rows.schema[ts].dataType).alias("__next"), F.lit(None).cast("string").alias("__as"))
    rows = paired.unionByName(last)
    if until is None:
        until = F.lit(events.agg(F.max(ts)).first()[0]).cast(rows.schema["__at"].dataType)  # one value
    took = seconds_between(F.col("__at"), F.coalesce("__next", until))
    outcome = F.when(took > limit, TIMEOUT).otherwise(F.coalesce("__as", F.lit(OPEN)))
    return rows.select(key, tie, F.col("__at").alias(ts), outcome.alias("outcome"), F.when(outcome != OPEN, F.least(took, F.lit(float(limit)))).alias("seconds"))
