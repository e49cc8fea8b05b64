"""State by key in a stream: attempts with timers, rates over the last events, and ids that were begun.

State is kept by RocksDB, so it may outgrow memory, and goes with the query's checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from textloom.operators.attempts import ENDED, RESTARTED, TIMEOUT
from textloom.operators.metrics import RECENT

_PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
SECOND = 1_000_000


def prepared(spark: SparkSession) -> None:
    """State by key needs this store; it is the session's from now on."""
    spark.conf.set(*_PROVIDER)


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


class _Attempts(StatefulProcessor):
    """At most one open attempt a key, and a timer for its end."""

    def __init__(self, limit: float):
        self.limit = int(limit * SECOND)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "id long, at long")

    def _timer(self, at: int) -> int:
        """Milliseconds, the first that lie past the limit."""
        return (at + self.limit) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.open.get() if self.open.exists() else None
        for row in sorted(rows, key=lambda r: (r.at, r.id)):
            if held:
                took = row.at - held[1]
                yield self._told(key, held, TIMEOUT if took > self.limit else RESTARTED if row.begins else ENDED, took)
                self.handle.deleteTimer(self._timer(held[1]))
                held = None
            if row.begins:
                held = (row.id, row.at)
                self.handle.registerTimer(self._timer(row.at))
        if held:
            self.open.update(held)
        else:
            self.open.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.open.exists():
            held = self.open.get()
            if self._timer(held[1]) <= expiredTimerInfo.getExpiryTimeInMs():
                self.open.clear()
                yield self._told(key, held, TIMEOUT, self.limit + 1)

    def _told(self, key, held, outcome: str, took: int) -> Row:
        return Row(key=key[0], id=held[0], at=held[1], outcome=outcome, seconds=min(took, self.limit) / SECOND)


def outcomes(events: DataFrame, key: str, begins: Column, ends: Column, limit: float, ts: str = "ts", tie: str = "event_id", delay: str = "0 seconds") -> DataFrame:
    """(key, tie, at, outcome, seconds) of attempts as they end, are begun again, or, by a timer on the time of events, take over ``limit``
    seconds: what :func:`textloom.operators.attempts.outcomes` tells of the whole log, but for what is still open.

    ``events`` is a stream whose events of one key come in order from batch to batch; ``tie`` is a number.
    """
    prepared(events.sparkSession)
    rows = events.select(F.col(key).cast("string").alias("key"), F.col(tie).cast("long").alias("id"), F.col(ts).cast("timestamp").alias("time"), _micros(F.col(ts)).alias("at"), F.coalesce(begins, F.lit(False)).alias("begins"), F.coalesce(ends, F.lit(False)).alias("ends"))
    rows = rows.withWatermark("time", delay)  # before the filter: time goes on with every event
    rows = rows.filter("begins OR ends")
    told = rows.groupBy("key").transformWithState(_Attempts(limit), "key string, id long, at long, outcome string, seconds double", "append", "eventTime")
    return told.select("key", F.col("id").alias(tie), F.timestamp_micros("at").cast("timestamp_ntz").alias(ts), "outcome", "seconds")


class _Rates(StatefulProcessor):
    """A ring of the last times of a key: an event takes the place of the one that is ``recent`` events older."""

    def __init__(self, recent: int, expiry: int | None):
        self.recent, self.expiry = recent, expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getMapState("ring", "place int", "at long", self.expiry)
        self.count = handle.getValueState("count", "n long", self.expiry)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = self.count.get()[0] if self.count.exists() else 0
        times = sorted(r.at for r in rows)
        for k in range(max(0, len(times) - self.recent), len(times)):
            self.ring.updateValue(((n + k) % self.recent,), (times[k],))
        n += len(times)
        self.count.update((n,))
        held = min(n, self.recent)
        oldest = self.ring.getValue(((n - held) % self.recent,)) if held > 1 else None  # what has expired is not there
        span = (times[-1] - oldest[0]) / SECOND if oldest else 0
        yield Row(key=key[0], n=n, rate=(held - 1) / span * 3600 if span > 0 else 0.0)


def recent_rates(events: DataFrame, key: str = "event_type", ts: str = "ts", recent: int = RECENT, expiry_seconds: int | None = None) -> DataFrame:
    """(key, n, rate): after each batch the completions an hour over the last ``recent`` events of the keys in it, in the order of their
    batches. The state of a key is so many times at most, of which a batch writes only its own; keys without events for
    ``expiry_seconds`` of the clock are forgotten, if told; such a query never ends by itself."""
    prepared(events.sparkSession)
    rows = events.select(F.col(key).cast("string").alias("key"), _micros(F.col(ts)).alias("at"))
    mode = "processingTime" if expiry_seconds else "none"
    return rows.groupBy("key").transformWithState(_Rates(recent, expiry_seconds and expiry_seconds * 1000), "key string, n long, rate double", "update", mode)


class _Begun(StatefulProcessor):
    """Attempts of an id, and whether it is done."""

    def __init__(self, max_attempts: int):
        self.max_attempts = max_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("begun", "attempts int, closed boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((initialState.attempts, initialState.closed))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        attempts, closed = self.state.get() if self.state.exists() else (0, False)
        first = min(rows, key=lambda r: r.path)
        if closed or attempts >= self.max_attempts:
            return
        self.state.update((attempts + 1, True))  # other files of this id are copies of what is begun now
        yield Row(path=first.path, lngid=key[0], key=first.key, attempt=attempts + 1)


def begun_once(files: DataFrame, status: DataFrame | None, max_attempts: int) -> DataFrame:
    """Of a stream (path, lngid, key) the first path of each id, with the number of the attempt: each id once, whatever batch its files
    come in. ``status``, the last records at the stream's start, tells which ids are done and how often the others were tried; it is
    read once, not in every batch."""
    prepared(files.sparkSession)
    known = None
    if status is not None:
        attempts = F.coalesce(F.col("attempt"), F.lit(1)).cast("int")
        known = status.select("lngid", attempts.alias("attempts"), (F.col("status") == "success").alias("closed")).groupBy("lngid")
    return files.groupBy("lngid").transformWithState(_Begun(max_attempts), "path string, lngid string, key string, attempt int", "append", "none", known)
