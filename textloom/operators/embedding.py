"""Texts to vectors through a model of the caller's, in batches that shrink when the model refuses them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import AccumulatorParam
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH = 64


def hashed(texts: list[str], size: int = 8) -> list[list[float]]:
    """A stand-in for a model: vectors from hashes, the same for the same text everywhere."""
    return [[b / 255 for b in hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest()[:size]] for t in texts]


class _Least(AccumulatorParam):
    def zero(self, value: int) -> int:
        return value

    def addInPlace(self, a: int, b: int) -> int:
        return min(a, b)


class Learned:
    """The smallest batch that any task had to go down to: told by tasks as they end, and where the next job's tasks begin."""

    def __init__(self, spark: SparkSession, batch: int = BATCH):
        self._least = spark.sparkContext.accumulator(batch, _Least())

    @property
    def value(self) -> int:
        return self._least.value


def embedded(rows: DataFrame, model: Callable[[list[str]], list[list[float]]] = hashed, text_col: str = "text", batch: int = BATCH, learned: Learned | None = None) -> DataFrame:
    """``rows`` with ``vector`` and ``vector_error``.

    A refused batch is halved, down to one text; a size that has worked out is kept for the rest of the task, and by ``learned`` for
    the jobs after this one. A text that is refused alone has a null vector and the error, and teaches no size; the others are
    not touched by it. Blank texts are not sent.
    """
    batch, least = (min(batch, learned.value), learned._least) if learned else (batch, None)
    schema = T.StructType([*rows.schema.fields, T.StructField("vector", T.ArrayType(T.FloatType())), T.StructField("vector_error", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = batch
        for part in batches:
            texts = part.column(part.schema.names.index(text_col)).to_pylist()
            vectors: list = [None] * len(texts)
            errors: list = [None] * len(texts)
            todo = [k for k, t in enumerate(texts) if t and not t.isspace()]
            at = 0
            while at < len(todo):
                some = todo[at : at + step]
                try:
                    for k, v in zip(some, model([texts[k] for k in some]), strict=True):
                        vectors[k] = v or None
                except Exception as refused:
                    if len(some) > 1:
                        step = max(1, len(some) // 2)
                        continue
                    errors[some[0]] = str(refused)[:500]
                else:
                    if least is not None and len(some) == step < batch:
                        least.add(step)  # only sizes that have worked out are told
                at += len(some)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(vectors, pa.list_(pa.float32())), pa.array(errors, pa.string())], names=[*part.schema.names, "vector", "vector_error"])

    return rows.mapInArrow(work, schema)
