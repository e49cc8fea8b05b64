"""Rates, streaks and totals of a run, from its log of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from textloom.operators.numbering import in_blocks, numbered

RECENT = 101
STREAK_SECONDS = 60
MAX_STREAK = 3


def seconds_between(first: Column, last: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", first, last) / F.lit(1e6)


def per_hour(n: Column, seconds: Column) -> Column:
    """n in so many seconds as a rate; 0 where there is no time to divide by."""
    return F.when((n > 0) & (seconds > 0), n / seconds * 3600).otherwise(0.0)


def moving_rate(events: DataFrame, key: str, ts: str = "ts", tie: str = "event_id", recent: int = RECENT, unit: str = "hour", block: int = 10_000) -> DataFrame:
    """``events`` with ``rate``: completions an hour over the last ``recent`` of the key.

    A key's events are numbered by ``unit`` of time, and cut into blocks that have the ``recent`` events before them too, so
    a key is as many tasks as it has blocks.
    """
    rows = in_blocks(numbered(events, (key,), (ts, tie), F.date_trunc(unit, F.col(ts)), "__n"), block, min(recent - 1, block), "__n")
    last = Window.partitionBy(key, "__block").orderBy("__n").rowsBetween(-(recent - 1), 0)
    n, first = F.count(F.lit(1)).over(last), F.min(ts).over(last)
    rows = rows.withColumn("rate", per_hour(n - 1, seconds_between(first, F.col(ts)))).filter("__own")
    return rows.select(*events.columns, "rate")


def average_rate(events: DataFrame, *keys: str, ts: str = "ts") -> DataFrame:
    """(keys, n, seconds, rate) over the whole time of each."""
    rows = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    rows = rows.withColumn("seconds", seconds_between(F.col("first"), F.col("last")))
    return rows.select(*keys, "n", "seconds", per_hour(F.col("n"), F.col("seconds")).alias("rate"))


def crash_streaks(events: DataFrame, key: str, ts: str = "ts", tie: str = "event_id", gap: int = STREAK_SECONDS, unit: str = "hour", block: int = 10_000) -> DataFrame:
    """``events`` (crashes) with ``crash_count``, the crashes in a row less than ``gap`` seconds apart before this one, and
    ``disabled``, whether the key is given up by now.

    A streak begins at the last event that is far from the one before it. Events of a key are numbered by ``unit`` of time and cut into
    blocks that have the event before them too; of each block only its last begin is told to the blocks after it, so a key is as many
    tasks as it has blocks. A key is given up from the first event on that is too much, one number a key.
    """
    rows = in_blocks(numbered(events, (key,), (ts, tie), F.date_trunc(unit, F.col(ts)), "__n"), block, 1, "__n")
    order = Window.partitionBy(key, "__block").orderBy("__n")
    far = F.coalesce(seconds_between(F.lag(ts).over(order), F.col(ts)) >= gap, F.lit(True))
    rows = rows.withColumn("__begin", F.when(far, F.col("__n"))).filter("__own").withColumn("__begin", F.max("__begin").over(order))
    # a block's last begin; before it, that of the blocks before
    earlier = Window.partitionBy("__of").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy(F.col(key).alias("__of"), F.col("__block").alias("__at")).agg(F.max("__begin").alias("__last"))
    ends = ends.select("__of", "__at", F.max("__last").over(earlier).alias("__open"))
    rows = rows.join(ends, F.col(key).eqNullSafe(F.col("__of")) & (F.col("__block") == F.col("__at"))).drop("__of", "__at")
    rows = rows.withColumn("crash_count", (F.col("__n") - F.coalesce("__begin", "__open")).cast("int"))
    first = rows.filter(F.col("crash_count") > MAX_STREAK).groupBy(F.col(key).alias("__of")).agg(F.min("__n").alias("__over"))
    rows = rows.join(first, F.col(key).eqNullSafe(F.col("__of")), "left")
    return rows.select(*events.columns, "crash_count", F.coalesce(F.col("__n") >= F.col("__over"), F.lit(False)).alias("disabled"))


def progress(rows: DataFrame, order: tuple[str, ...], every: int, bucket: Column, within: tuple[str, ...] = (), first: int = 10) -> DataFrame:
    """The rows at which progress is told, with their number ``n``: the first ten and every so many. ``bucket``: see :func:`numbered`."""
    rows = numbered(rows, within, order, bucket)
    return rows.filter((F.col("n") <= first) | (F.col("n") % every == 0))


#: What the writes of a run count: ids and files as :func:`textloom.operators.discovery.marked` tells them, and parsed files.
DISCOVERY = {
    "discovered": lambda: F.sum("files"), "skipped": lambda: F.sum(F.col("files") - F.col("todo").cast("long")), "submitted": lambda: F.count_if("todo"),
    "retried": lambda: F.count_if(F.col("todo") & (F.col("attempt") > 1)),
}
PARSING = {"parsed": lambda: F.count_if(F.col("error").isNull())}


def indexing(indexes: list[str]) -> dict:
    """The documents of each index that have a vector."""
    return {i: lambda i=i: F.count_if((F.col("index_name") == i) & (F.size("vector") > 0)) for i in indexes}


class Observed:
    """Counters of a run, observed by the writes themselves: nothing is read a second time to be counted."""

    def __init__(self):
        self._seen: list[Observation] = []

    def counting(self, rows: DataFrame, what: dict) -> DataFrame:
        """``rows``, whose next action tells the counters. The action has to take ``rows`` as they are."""
        self._seen.append(Observation())
        return rows.observe(self._seen[-1], *[F.coalesce(make(), F.lit(0)).cast("long").alias(name) for name, make in what.items()])

    def totals(self) -> dict[str, int]:
        """Of all that was written, summed up by name."""
        told: dict[str, int] = {}
        for one in self._seen:
            for name, n in one.get.items():
                told[name] = told.get(name, 0) + n
        return told


def parsed_by_device(parsed: DataFrame) -> DataFrame:
    """(device, parsed): the files that each device has parsed."""
    return parsed.filter(F.col("error").isNull()).groupBy("device").agg(F.count(F.lit(1)).alias("parsed"))


def run_counters(found: DataFrame, todo: DataFrame) -> DataFrame:
    """One row of what discovery made of the files: those with an id, those skipped as done, given up or not first of their id, those
    to be done and those of them that failed before."""
    every = found.select(F.lit(1).alias("discovered"), F.lit(0).alias("submitted"), F.lit(0).alias("retried"))
    every = every.unionByName(todo.select(F.lit(0).alias("discovered"), F.lit(1).alias("submitted"), (F.col("attempt") > 1).cast("int").alias("retried")))
    rows = every.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("discovered", "submitted", "retried")])
    return rows.select("discovered", (F.col("discovered") - F.col("submitted")).alias("skipped"), "submitted", "retried")


def breakdown(counts: DataFrame, indexes: list[str]) -> DataFrame:
    """Rows of :func:`counts_by_index` with ``total`` and ``told``, the indexes that are not empty, as name=number."""
    told = F.array(*[F.when(F.col(i) > 0, F.concat(F.lit(f"{i}="), F.col(i).cast("string"))) for i in indexes])
    total = sum((F.col(i) for i in indexes[1:]), F.col(indexes[0]))
    return counts.withColumns({"total": total.cast("long"), "told": F.array_join(told, ", ")})


def index_totals(rows: DataFrame, index: str = "index_name") -> DataFrame:
    """The documents of each index over all papers."""
    return rows.groupBy(index).agg(F.count(F.lit(1)).alias("documents"))


def run_summary(log: DataFrame) -> DataFrame:
    """One row of totals from a status log with ``status``, ``stage``, ``attempt``, ``error`` and ``timestamp``."""
    ok, failed = F.col("status") == "success", F.col("status") == "failure"
    told = F.lower(F.coalesce("error", F.lit("")))
    rows = log.agg(
        F.count_if(ok).alias("success"), F.count_if(failed & (F.col("stage") == "parse")).alias("parse_failures"), F.count_if(failed & (F.col("stage") == "index")).alias("index_failures"),
        F.count_if(failed & told.contains("timeout")).alias("timeouts"), F.count_if(F.coalesce("attempt", F.lit(1)) > 1).alias("retries"), F.count(F.lit(1)).alias("records"),
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
    )
    seconds = F.coalesce(seconds_between(F.col("first"), F.col("last")), F.lit(0.0))
    return rows.select(
        "success", "parse_failures", "index_failures", "timeouts", "retries", "records", F.round(seconds, 2).alias("elapsed_seconds"),
        F.round(per_hour(F.col("success"), seconds), 2).alias("throughput_per_hour"), F.round(F.when(F.col("success") > 0, seconds / F.col("success")).otherwise(0.0), 2).alias("average_seconds_per_success"),
    )


def counts_by_index(rows: DataFrame, indexes: list[str], key: str = "lngid", index: str = "index_name") -> DataFrame:
    """A row for each key with a column for each index, 0 where it has no document there."""
    return rows.groupBy(key).pivot(index, indexes).agg(F.count(F.lit(1))).na.fill(0, indexes)
