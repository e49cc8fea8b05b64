"""Which files are still to be done: ids, duplicates, finished and given-up ones, attempts, limits.

All joins are on the document's id; the log side is one row an id. Spark sends it to all tasks where it is known to be small
and joins by shuffle elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators.numbering import numbered

MAX_ATTEMPTS = 2
SUCCESS, FAILURE = "success", "failure"


def identified(files: DataFrame, path_col: str = "path", root: str = "") -> DataFrame:
    """(path, lngid, key) for files whose name gives an id."""
    rows = files.select(F.col(path_col).alias("path"), X.file_key(F.col(path_col)).alias("lngid"), X.task_key(F.col(path_col), root).alias("key"))
    return rows.filter(F.col("lngid") != "")


def first_of_each(rows: DataFrame, key: str | Column = "lngid", order: str | Column = "path") -> DataFrame:
    """Of the rows of one key the first, by an order that does not depend on the run, taken before the shuffle.

    For long keys, such as texts, give a hash of theirs."""
    first = F.min_by(F.struct(*rows.columns), F.col(order) if isinstance(order, str) else order)
    found = rows.groupBy((F.col(key) if isinstance(key, str) else key).alias("__key")).agg(first.alias("__row"))
    return found.select("__row.*")


def retry_first(rows: DataFrame, is_retry: Column, order: tuple[str, ...], within: tuple[str, ...] = (), bucket: Column | None = None) -> DataFrame:
    """``rows`` with ``place``: what failed before comes first, then in order. ``bucket``, which must not fall in that order, cuts a queue of
    any length into parts (see :func:`numbered`); without it a queue is one task's for those that failed and one for the others."""
    late = ~F.coalesce(is_retry, F.lit(False))
    part = F.struct(late.alias("late"), (F.lit(0) if bucket is None else bucket).alias("bucket"))
    return numbered(rows.withColumn("__late", late), within, ("__late", *order), part, "place").drop("__late").withColumn("place", F.col("place").cast("int"))


def first_and_more(rows: DataFrame, key: str, order: tuple, n: int = 5) -> DataFrame:
    """The first ``n`` rows of each key, with ``more``: how many of it are left out. Spark keeps n rows a key and task only."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    first = rows.withColumn("__place", place).filter(F.col("__place") <= n).drop("__place")
    counts = rows.groupBy(F.col(key).alias("__key")).agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("more"))
    return first.join(counts, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def last_status(log: DataFrame, key: str = "lngid", order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """The last record of each key, taken before the shuffle."""
    others = [c for c in log.columns if c != key]
    last = log.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("last"))
    return last.select(key, *[F.col(f"last.{c}").alias(c) for c in others])


def done(rows: DataFrame, status: DataFrame) -> DataFrame:
    return rows.join(status.filter(F.col("status") == SUCCESS).select("lngid"), "lngid", "left_semi")


def without_done(rows: DataFrame, status: DataFrame) -> DataFrame:
    return rows.join(status.filter(F.col("status") == SUCCESS).select("lngid"), "lngid", "left_anti")


def without_exhausted(rows: DataFrame, status: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    spent = (F.col("status") == FAILURE) & (F.coalesce("attempt", F.lit(0)) >= max_attempts)
    return rows.join(status.filter(spent).select("lngid"), "lngid", "left_anti")


def with_attempt(rows: DataFrame, status: DataFrame) -> DataFrame:
    """``rows`` with the number of the attempt: one more than a failed one before."""
    before = status.filter(F.col("status") == FAILURE).select("lngid", F.coalesce("attempt", F.lit(1)).alias("__before"))
    rows = rows.join(before, "lngid", "left")
    return rows.withColumn("attempt", (F.coalesce("__before", F.lit(0)) + 1).cast("int")).drop("__before")


def tasks(files: DataFrame, status: DataFrame, max_attempts: int = MAX_ATTEMPTS, limit: int = 0, root: str = "") -> DataFrame:
    """(path, lngid, key, attempt): what is to be done, the first ``limit`` by path if one is set."""
    rows = first_of_each(identified(files, root=root))
    rows = with_attempt(without_exhausted(without_done(rows, status), status, max_attempts), status)
    return rows.orderBy("path").limit(limit) if limit > 0 else rows


def marked(found: DataFrame, status: DataFrame, max_attempts: int = MAX_ATTEMPTS, limit: int = 0) -> DataFrame:
    """(path, lngid, key, attempt, files, todo): a row for each id that was found, with the number of its files and whether it is to be done:
    what :func:`tasks` gives, beside what it leaves out."""
    rows = found.groupBy("lngid").agg(F.min_by(F.struct("path", "key"), "path").alias("__first"), F.count(F.lit(1)).alias("files"))
    known = status.select(F.col("lngid").alias("__id"), "status", F.coalesce("attempt", F.lit(0)).alias("__spent"), F.coalesce("attempt", F.lit(1)).alias("__before"))
    rows = rows.join(known, F.col("lngid") == F.col("__id"), "left")
    failed = F.coalesce(F.col("status") == FAILURE, F.lit(False))
    over = F.coalesce(F.col("status") == SUCCESS, F.lit(False)) | (failed & (F.col("__spent") >= max_attempts))
    rows = rows.select("__first.path", "lngid", "__first.key", (F.when(failed, F.col("__before")).otherwise(0) + 1).cast("int").alias("attempt"), "files", (~over).alias("todo"))
    if limit > 0:
        first = rows.filter("todo").orderBy("path").limit(limit).select(F.col("lngid").alias("__id"), F.lit(True).alias("__in"))
        rows = rows.join(first, F.col("lngid") == F.col("__id"), "left").withColumn("todo", F.coalesce("__in", F.lit(False))).drop("__id", "__in")
    return rows


def in_turn(rows: DataFrame, slots: int, order: str, bucket: Column, within: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with ``slot``, dealt out in turn. Spark deals out tasks itself; this is for devices that have to be named."""
    return numbered(rows, within, (order,), bucket, "__n").withColumn("slot", ((F.col("__n") - 1) % slots).cast("int")).drop("__n")


def slots_of(gpus: str, workers: str) -> list[int]:
    """Devices by slot, from "0,1" and "2,1" (or one number for all): [0, 0, 1]."""
    devices = [int(x) for x in gpus.split(",") if x.strip()]
    each = [int(x) for x in workers.split(",") if x.strip()]
    if not devices or len({*devices}) < len(devices):
        raise ValueError("devices have to be named, each once")
    each = each * len(devices) if len(each) == 1 else each
    if len(each) != len(devices) or min(each) < 1:
        raise ValueError("one number of workers is needed, or one for each device, and at least 1")
    return [d for d, n in zip(devices, each) for _ in range(n)]
