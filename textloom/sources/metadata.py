"""Metadata of papers, from a table of Spark's or from a SQLite file in a folder that the executors share."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from textloom.operators.indexes import META

SCHEMA = "lngid string, " + ", ".join(f"{c} string" for c in META)


class _Rows(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.path, self.table, self.columns, self.parts = options["path"], options.get("table", "meta"), columns, int(options.get("partitions", "16"))
        if not self.table.isidentifier():
            raise ValueError(f"{self.table} is no name of a table")

    def _open(self) -> closing:
        return closing(sqlite3.connect(f"file:{self.path}?mode=ro", uri=True))

    def partitions(self) -> list[_Rows]:
        """Ranges of row numbers, which SQLite finds without reading others."""
        with self._open() as db:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {self.table}").fetchone()
        if low is None:
            return [_Rows(0, 0)]
        step = -(-(high - low + 1) // self.parts)
        return [_Rows(k, min(k + step, high + 1)) for k in range(low, high + 1, step)]

    def read(self, partition: _Rows) -> Iterator[tuple]:
        with self._open() as db:
            yield from db.execute(f"SELECT {', '.join(self.columns)} FROM {self.table} WHERE rowid >= ? AND rowid < ?", (partition.low, partition.high))


class Sqlite(DataSource):
    """``spark.read.format("papers").option("path", ...)``: options path, table (meta), partitions (16)."""

    @classmethod
    def name(cls) -> str:
        return "papers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options, [f.name for f in schema.fields])


def from_sqlite(spark: SparkSession, path: str, table: str = "meta", partitions: int = 16) -> DataFrame:
    """(lngid and the fields of a paper), values that are not there as null."""
    spark.dataSource.register(Sqlite)
    return spark.read.format("papers").option("table", table).option("partitions", partitions).option("path", path).load()
