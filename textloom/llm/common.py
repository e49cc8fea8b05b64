"""What several operators share: word patterns, tables that cut lineage, and vectorised text hashing."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White-space-delimited words.
WORD = r"[^\x20\x09-\x0D]+"
_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path in the shared folder that the session names. Only in local mode, where all is one machine, may none be named."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="textloom-"))
        base = f"file://{_own_folder[0]}"
    return f"{base.rstrip('/')}/textloom-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


#: While steps run, Spark removes the shuffle files of a query when it ends, and gives Python workers no more bytes at once.
_STEP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}
_lock, _running, _before = threading.Lock(), [0], {}


@contextlib.contextmanager
def step(spark: SparkSession) -> Iterator[None]:
    """The settings of steps hold in this block; those of the session come back when the last of the blocks that run at once ends."""
    with _lock:
        if not _running[0]:
            _before.update({k: spark.conf.get(k) for k in _STEP})
            for k, v in _STEP.items():
                spark.conf.set(k, v)
        _running[0] += 1
    try:
        yield
    finally:
        with _lock:
            _running[0] -= 1
            if not _running[0]:
                for k, v in _before.items():
                    spark.conf.set(k, v)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: its lineage ends there, and no executor's loss can take it.

    The table goes when the application ends.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    files, place = _file_system(spark, path)
    files.deleteOnExit(place)
    with step(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(table: DataFrame) -> None:
    """Removes a table that was cut, once nothing is to read it any more."""
    for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
        files, place = _file_system(table.sparkSession, path)
        files.delete(place, True)


class Scratch:
    """Tables of a long job: those that it cuts go when it ends, but for the one that it keeps."""

    def __init__(self, spark: SparkSession):
        self.spark, self.tables = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for df in self.tables:
            free(df)

    def cut(self, df: DataFrame) -> DataFrame:
        self.tables.append(cut(df))
        return self.tables[-1]

    def keep(self, df: DataFrame) -> DataFrame:
        return cut(df)


#: Rows, and bytes of their texts, that are sent to all tasks at most.
SMALL, SMALL_BYTES = 500_000, 32 << 20


def small(table: DataFrame) -> DataFrame:
    """A narrow table that was cut, to be sent to all tasks if its rows and the bytes of its strings are counted to be few; else it joins by shuffle."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in table.schema.fields if f.dataType.typeName() in ("string", "binary")]
    size = F.coalesce(F.sum(sum(texts[1:], texts[0])), F.lit(0)) if texts else F.lit(0)
    rows, size = table.agg(F.count(F.lit(1)), size).first()
    return F.broadcast(table) if rows <= SMALL and size <= SMALL_BYTES else table


def own_names(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``work`` on a table that may have columns named like its working columns, which begin with ``__``: these have other names meanwhile."""

    @functools.wraps(work)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        names = {}
        for c in docs.columns:
            if c.startswith("__") and c not in (*args, *options.values()):
                names[c] = f"own{c}"
                while names[c].lower() in (x.lower() for x in (*docs.columns, *[v for k, v in names.items() if k != c])):
                    names[c] = f"own_{names[c]}"
        return work(docs.withColumnsRenamed(names), *args, **options).withColumnsRenamed({v: k for k, v in names.items()})

    return run


def barrier(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row, however often later expressions and their lambdas use them."""
    packed = F.array(F.struct(*[F.col(c) for c in df.columns], *[v.alias(k) for k, v in columns.items()]))
    return df.select(F.inline(packed))


# --- vectorised hashing of the words of many texts -----------------------------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.Generator(np.random.PCG64(20240131)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of the polynomial hashes, and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", int(_MULT)), ("down", pow(int(_MULT), -1, 2**64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of a byte buffer, the empty one first."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * powers(len(raw))[0], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of substrings, from the prefix hashes: equal strings have equal hashes wherever they stand."""
    return (prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts]


def slices(batches: Iterator[pa.RecordBatch], text: int | str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches in parts with about ``limit`` bytes of text, so that few texts are Python's at once."""
    for batch in batches:
        column = batch.column(text)
        size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
        if not batch.num_rows:
            yield batch
    _give_back()


def _give_back() -> None:
    """Memory that a task has freed goes back to the system: workers wait for their next task with what they need only."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than GNU's have no such call
        ctypes.CDLL(None).malloc_trim(0)


def in_chunks(rows: Iterable, texts: Iterable, limit: int = 1 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(rows, their texts as UTF-8; null is empty) in runs of about ``limit`` bytes, so that work arrays stay small."""
    keep, out, size = [], [], 0
    for row, text in zip(rows, texts):
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if out and size + len(raw) > limit:
            yield keep, out
            keep, out, size = [], [], 0
        keep.append(row)
        out.append(raw)
        size += len(raw)
    if out:
        yield keep, out


class Words:
    """The words of a run of texts, in arrays: ``doc`` (index of the text), ``start`` and ``end`` (bytes in ``raw``), ``hash``."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        joined = b"\n".join(texts).lower() + b"\n"
        self.raw = np.frombuffer(joined, np.uint8)
        inside = is_word[self.raw]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.start, self.end = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offset = np.concatenate(([0], np.cumsum(lengths)))
        self.doc = np.searchsorted(self.offset, self.start, "right") - 1
        self.hash = mix(span_hashes(prefix_hashes(self.raw), self.start, self.end) + (self.end - self.start).astype(np.uint64))
        self.count = np.bincount(self.doc, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.count)))


#: By byte: is it part of a word, for words between white space; and for words of digits, letters and non-ASCII characters.
NOT_SPACE = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
