"""Exact substring dedup: bytes under a ``LENGTH``-byte string that also starts earlier are removed.

The suffixes of all texts are compared by their first ``LENGTH`` bytes. To bring those that can be equal together without
moving the rest, every such window is named by its anchor: the ``GRAM``-byte string in it that hashes lowest (equal windows
have equal anchors at equal places). Windows in a row with one anchor make up a piece.

1. Anchors that occur once are dropped: nothing in their windows repeats.
2. Pieces that are equal as a whole by hash are one class; all but its first occurrence are removed at once. Counts and minima
   are taken before the shuffle, so a passage in a third of all documents is no more work for a task than any other.
   In a text that repeats itself with a period, equal pieces follow each other; of such a row of pieces only the first one takes part in this,
   the others' windows start one period earlier too and are one range, whatever its length. Long texts are read in stretches of
   ``STRETCH`` bytes.
3. Anchors with several classes (at the edges of copies): one piece of each class goes, with its bytes, to its anchor's
   bucket, and the buckets' suffixes are sorted. The sort is a mergesort in which two suffixes are compared by their longest
   common extension, found by binary search over prefix polynomial hashes; equal neighbours are verified byte by byte, and
   all but the first of a run are removed. Anchors with over ``BUCKET`` classes are dealt over several buckets, sorted one
   by one; the firsts of these meet again by a digest of their window.
4. Removed ranges are gathered by document, each with a digest (BLAKE2b) of the bytes that it repeats, taken where these stand
   first. A range is cut out if the document's own bytes have that digest, so what only shares a hash stays.

Positions are ordered by (id, start). Defined cases: null text is empty and keeps nothing; texts under ``LENGTH`` bytes are
left whole; rows that repeat an id and text get equal results and are not earlier than each other; different texts under
one id are taken as one document's, and each loses the ranges that it has itself; a null id has no place in the order: its
row is left whole and removes nothing; an empty table gives an empty result; extra columns of ``docs`` are kept,
those named like the added ones are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import cut, in_chunks, mix, own_names, powers, prefix_hashes, slices, small

LENGTH = 100
GRAM = 32
#: Classes of one anchor that are sorted together at most.
BUCKET = 4096
_CHUNK = 1 << 18
#: Bytes of a text that are looked at together at most.
STRETCH = 1 << 22
#: Pieces of a period that are told from pieces before, and how many of these in a row are taken as one range.
PERIOD = 8
MIN_ROW = 16
#: A piece's place in one long: first window's start, number of windows, place of the anchor after that start.
_AT = (1 << 14, 1 << 7)


def _pieces(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor's place, anchor, class) of the pieces of some texts, starts counted within each."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offset = np.concatenate(([0], np.cumsum(lengths)))
    n = len(raw)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefix, down = prefix_hashes(raw), powers(n + 1)[1]
    grams = mix((prefix[GRAM:] - prefix[:-GRAM]) * down[: n - GRAM + 1])
    low = np.uint64(0xFFFFFFFF)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, done = LENGTH - GRAM + 1, 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    anchor = (least & low).astype(np.int64)
    # a window that reaches into the next text is none; a piece ends where the anchor or the text changes
    new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    within = np.zeros(n + 1, np.int8)
    full = lengths >= LENGTH
    np.add.at(within, offset[:-1][full], 1)
    np.add.at(within, offset[1:][full] - LENGTH + 1, -1)
    inside = np.cumsum(within[: len(anchor)]).astype(bool)
    new[offset[:-1][full]] = True
    starts = np.flatnonzero(new & inside)
    change = np.flatnonzero(new | np.concatenate(([False], inside[1:] != inside[:-1])))
    stops = np.append(change, len(anchor))[np.searchsorted(change, starts, "right")]
    at, windows = anchor[starts], stops - starts
    ends = stops - 1 + LENGTH
    whole = mix((prefix[ends] - prefix[starts]) * down[starts] + (at - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + windows.astype(np.uint64))
    text = np.searchsorted(offset, starts, "right") - 1
    return text, starts - offset[text], windows, at - starts, grams[at], whole


def _stretches(ids: list[int | None], texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(id, first byte, bytes): whole texts, or stretches of them that have the windows that begin in them."""
    for of, raw in zip(ids, texts):
        if of is not None:
            for at in range(0, max(len(raw) - LENGTH + 1, 1), STRETCH):
                yield of, at, raw[at : at + STRETCH + LENGTH - 1]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    for batch in slices(batches, 1):
        for ids, texts in in_chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _CHUNK):
            some, size = [], 0
            for x in _stretches(ids, texts):
                some.append(x)
                size += len(x[2])
                if size >= STRETCH:
                    yield _columns(some)
                    some, size = [], 0
            if some:
                yield _columns(some)


def _columns(some: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    return np.array([x[0] for x in some], np.int64), np.array([x[1] for x in some], np.int64), [x[2] for x in some]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, texts in _batches(batches):
        anchors, times = np.unique(_pieces(texts)[4], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(times)], names=["anchor", "times"])


def _rows_of_equals(text: np.ndarray, start: np.ndarray, windows: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """For each piece how many pieces before it (0: none, up to ``PERIOD``) is an equal one, at the end of a row of such pieces that began with
    as many others."""
    back = np.zeros(len(text), np.int64)
    for k in range(1, PERIOD + 1):
        same = np.zeros(len(text), bool)
        same[k:] = (whole[k:] == whole[:-k]) & (text[k:] == text[:-k]) & (windows[k:] == windows[:-k])
        back[same & (back == 0)] = k
    return back


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces by anchor and class; and, without a class, ranges of windows that start one period earlier in the same text, too."""
    for ids, bases, texts in _batches(batches):
        text, start, windows, place, anchor, whole = _pieces(texts)
        back = _rows_of_equals(text, start, windows, whole)
        own = np.ones(len(text), bool)
        spans = []
        # neighbours that are all repeated at one distance in bytes are one range; it is compared byte by byte
        earlier = np.arange(len(text)) - back
        shift = np.where(back > 0, start - start[earlier], 0)
        edge = np.flatnonzero(np.diff(shift, prepend=-1) | np.diff(text, prepend=-1) | (np.diff(start, prepend=0) != np.append(0, windows[:-1])))
        for a, b in zip(edge.tolist(), np.append(edge[1:], len(text)).tolist()):
            d = int(shift[a]) if b - a >= MIN_ROW else 0
            if d:
                raw, begin, end = texts[text[a]], int(start[a]), int(start[b - 1] + windows[b - 1] - 1 + LENGTH)
                if raw[begin:end] == raw[begin - d : end - d]:
                    own[a:b] = False
                    spans.append((int(ids[text[a]]), int(bases[text[a]]) + begin, int(bases[text[a]]) + end, digest(raw[begin:end])))
        at = ((start + bases[text]) * _AT[0] + windows * _AT[1] + place)[own]
        n, m = len(at), len(spans)
        of, begins, ends, digests = zip(*spans) if spans else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((anchor.view(np.int64)[own], np.zeros(m, np.int64))), mask=np.arange(n + m) >= n), pa.array(np.concatenate((whole.view(np.int64)[own], np.zeros(m, np.int64))), mask=np.arange(n + m) >= n),
                pa.array(np.concatenate((ids[text][own], np.array(of, np.int64)))), pa.array(np.concatenate((at, np.array(begins, np.int64)))),
                pa.array([*[None] * n, *ends], pa.int64()), pa.array([*[None] * n, *digests], pa.binary()),
            ],
            names=["anchor", "class", "id", "at", "end", "digest"],
        )


def digest(raw: bytes | memoryview) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is asked of texts: the bytes of a piece for its anchor's bucket, or their digest for its class."""
    for batch in slices(batches, "text"):
        rows = []
        for at, text, pieces in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "pieces"))):
            raw = text.encode("utf-8", "surrogatepass")
            for x in pieces:
                start, windows = x["at"] // _AT[0], x["at"] % _AT[0] // _AT[1]
                if start + windows - 1 + LENGTH <= len(raw):
                    piece = raw[start : start + windows - 1 + LENGTH]
                    rows.append((x["anchor"], x["class"], x["bucket"], x["split"], at, x["at"], piece if x["class"] is None else digest(piece)))
        columns = list(zip(*rows)) or [()] * 7
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "class", "bucket", "split", "id", "at", "piece"])


class Suffixes:
    """Suffixes of a byte buffer, compared by their first LENGTH bytes."""

    def __init__(self, raw: np.ndarray):
        self.raw, self.prefix = raw, prefix_hashes(raw)
        self.up = powers(len(raw) + 1)[0]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of each pair, LENGTH at most: binary search over prefix hashes."""
        first, second = np.minimum(x, y), np.maximum(x, y)
        shift = self.up[second - first]
        low, high = np.zeros(len(x), np.int64), np.full(len(x), LENGTH)
        for _ in range(LENGTH.bit_length()):
            mid = (low + high + 1) >> 1
            same = (self.prefix[first + mid] - self.prefix[first]) * shift == self.prefix[second + mid] - self.prefix[second]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def below(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Is each x < y (or equal, where so said)?"""
        n = self.common(x, y)
        last = np.minimum(n, LENGTH - 1)
        return np.where(n == LENGTH, or_equal, self.raw[x + last] < self.raw[y + last])

    def merge_sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The stable order of suffixes ``at`` within each of the groups, which are runs of equal numbers in ``group``."""
        n = len(at)
        start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        size = np.diff(np.append(start, n))
        base, room = np.repeat(start, size), np.repeat(size, size)
        local = np.arange(n) - base
        order, run = np.arange(n), 1
        while run < (size.max() if n else 0):
            todo = np.flatnonzero(room > run)
            where, pair = local[todo], local[todo] // (2 * run) * 2 * run
            left = where < pair + run
            begin = np.where(left, pair + run, pair)
            stop = np.minimum(np.where(left, pair + 2 * run, pair + run), room[todo])
            begin = np.minimum(begin, stop)
            low, high = begin.copy(), stop.copy()
            mine = at[order[todo]]
            while len(open_ := np.flatnonzero(low < high)):
                mid = (low[open_] + high[open_]) >> 1
                # from the left run go before equal ones of the right run
                less = self.below(at[order[base[todo[open_]] + mid]], mine[open_], ~left[open_])
                low[open_] = np.where(less, mid + 1, low[open_])
                high[open_] = np.where(less, high[open_], mid)
            own = where - np.where(left, pair, pair + run)
            target = base[todo] + pair + own + low - begin
            merged = order.copy()
            merged[target] = order[todo]
            order, run = merged, 2 * run
        return order

    def repeats(self, at: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """For each suffix in order: does it equal the one before in its group? Equal hashes are verified on the bytes."""
        x = at[order]
        out = np.zeros(len(x), bool)
        close = np.flatnonzero(group[1:] == group[:-1]) + 1
        close = close[self.common(x[close - 1], x[close]) == LENGTH]
        span = np.arange(LENGTH)
        for k in range(0, len(close), 1 << 14):
            some = close[k : k + (1 << 14)]
            out[some] = (self.raw[x[some - 1, None] + span] == self.raw[x[some, None] + span]).all(axis=1)
        return out


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges to remove, and of split buckets the first of each distinct window; rows come ordered by (anchor, bucket, id, at)."""
    kept: pa.Table | None = None

    def work(table: pa.Table) -> pa.RecordBatch:
        pieces = table.column("piece").to_pylist()
        anchor, bucket, ids, place = (table.column(c).to_numpy() for c in ("anchor", "bucket", "id", "at"))
        split = np.array(table.column("split").to_pylist(), bool)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        offset = np.concatenate(([0], np.cumsum(length)))
        suffixes = Suffixes(np.frombuffer(b"".join(pieces), np.uint8))
        windows = length - LENGTH + 1
        piece = np.repeat(np.arange(len(pieces)), windows)
        k = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
        # equal windows have their anchor at the same place: each place is sorted by itself
        lead = (place % _AT[1])[piece] - k + LENGTH
        start = (place // _AT[0])[piece] + k
        number = np.cumsum(np.concatenate(([False], (anchor[1:] != anchor[:-1]) | (bucket[1:] != bucket[:-1]))))
        group = number[piece] * (3 * LENGTH) + lead
        by = np.lexsort((start, ids[piece], group))
        at, group = (offset[piece] + k)[by], group[by]
        order = suffixes.merge_sort(at, group)
        repeat = suffixes.repeats(at, order, group)
        sorted_piece, sorted_k = piece[by][order], k[by][order]
        gone = np.zeros(len(piece), bool)
        flat = np.cumsum(windows) - windows
        gone[flat[sorted_piece] + sorted_k] = repeat
        # runs of removed windows of a piece are one range
        edge = np.concatenate(([True], (piece[1:] != piece[:-1])))
        first = np.flatnonzero(gone & (edge | ~np.concatenate(([False], gone[:-1]))))
        last = np.flatnonzero(gone & np.append(edge[1:] | ~gone[1:], True))
        of = piece[first]
        begin, end = (place[of] // _AT[0]) + k[first], (place[of] // _AT[0]) + k[last] + LENGTH
        own = np.flatnonzero(split[sorted_piece] & ~repeat)
        spot = at[order][own]
        bytes_ = memoryview(suffixes.raw)
        begins = (offset[of] + k[first]).tolist()
        digests = [digest(bytes_[b : b + n]) for b, n in zip(begins, (end - begin).tolist())] + [digest(bytes_[b : b + LENGTH]) for b in spot.tolist()]
        ids_of, starts_of = ids[sorted_piece[own]], (place // _AT[0])[sorted_piece[own]] + sorted_k[own]
        none = [None] * len(first)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((ids[of], ids_of))), pa.array(np.concatenate((begin, starts_of))), pa.array(np.concatenate((end, starts_of + LENGTH))), pa.array([*none, *anchor[sorted_piece[own]].tolist()], pa.int64()), pa.array(digests, pa.binary())],
            names=["id", "begin", "end", "anchor", "digest"],
        )

    for batch in batches:
        kept = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
        if kept.num_rows >= BUCKET:
            a, b = kept.column("anchor").to_numpy(), kept.column("bucket").to_numpy()
            change = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            if len(change):
                yield work(kept.slice(0, change[-1]))
                kept = kept.slice(change[-1])
    if kept is not None and kept.num_rows:
        yield work(kept)


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): for each id with removed bytes, the ranges as array<struct<begin: long, end: long, digest: binary>>, unordered, overlapping."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = docs.filter(F.col("id").isNotNull() & (F.octet_length("text") >= LENGTH))
    counted = texts.mapInArrow(_anchors, "anchor long, times long").groupBy("anchor").agg(F.sum("times").alias("times"))
    twice = cut(counted.filter("times > 1").select("anchor"))
    seen = texts.mapInArrow(_occurrences, "anchor long, class long, id long, at long, end long, digest binary")
    # ranges within one text have no anchor and need no other text
    of = F.coalesce("anchor", F.xxhash64("id", "at"))  # so these are no hot key
    seen = cut(seen.join(twice.select(F.col("anchor").alias("__twice")), of == F.col("__twice"), "left").filter("__twice IS NOT NULL OR anchor IS NULL").drop("__twice"))
    found, inner = seen.filter("anchor IS NOT NULL").drop("end", "digest"), seen.filter("anchor IS NULL").select("id", F.col("at").alias("begin"), "end", "digest")
    classes = cut(found.groupBy("anchor", "class").agg(F.min(F.struct("id", "at")).alias("first"), F.count(F.lit(1)).alias("times")))
    # one piece of each class of the anchors that have several is sorted, and the first of each class that has more is asked for its digest
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1").select(F.col("anchor").alias("a"), "classes")
    parts = F.ceil(F.col("classes") / BUCKET)
    pieces = classes.join(several, F.col("anchor") == F.col("a")).select("anchor", F.lit(None).cast("long").alias("class"), F.pmod(F.xxhash64("class"), parts).cast("int").alias("bucket"), (parts > 1).alias("split"), F.col("first.id").alias("id"), F.col("first.at").alias("at"))
    many = classes.filter("times > 1").select("anchor", "class", F.lit(0).alias("bucket"), F.lit(False).alias("split"), F.col("first.id").alias("id"), F.col("first.at").alias("at"))
    listed = cut(pieces.unionByName(many).groupBy("id").agg(F.collect_list(F.struct("anchor", "class", "bucket", "split", "at")).alias("pieces")))
    asked = texts.join(small(listed.select("id")), "id", "left_semi").join(listed, "id").select("id", "text", "pieces")
    told = cut(asked.mapInArrow(_bytes_of, "anchor long, class long, bucket int, split boolean, id long, at long, piece binary"))
    # all but the first of a class
    first = told.filter("class IS NOT NULL").select(F.col("anchor").alias("a"), F.col("class").alias("c"), F.col("id").alias("first_id"), F.col("at").alias("first_at"), F.col("piece").alias("digest")).distinct()
    begin, windows = F.floor(F.col("at") / _AT[0]), F.floor(F.pmod("at", F.lit(_AT[0])) / _AT[1])
    later = found.join(first, (F.col("anchor") == F.col("a")) & (F.col("class") == F.col("c"))).filter((F.col("id") != F.col("first_id")) | (F.col("at") != F.col("first_at")))
    ranges = later.select("id", begin.alias("begin"), (begin + windows - 1 + LENGTH).alias("end"), "digest")
    buckets = told.filter("class IS NULL").drop("class").dropDuplicates(["anchor", "id", "at"])
    buckets = buckets.repartition("anchor", "bucket").sortWithinPartitions("anchor", "bucket", "id", "at")
    out = cut(buckets.mapInArrow(_sorted_buckets, "id long, begin long, end long, anchor long, digest binary"))
    ranges = ranges.unionByName(inner).unionByName(out.filter("anchor IS NULL").select("id", "begin", "end", "digest"))
    firsts = out.filter("anchor IS NOT NULL")
    lowest = firsts.groupBy("anchor", "digest").agg(F.min(F.struct("id", "begin")).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1").select(F.col("anchor").alias("a"), F.col("digest").alias("w"), "first")
    again = firsts.join(lowest, (F.col("anchor") == F.col("a")) & (F.col("digest") == F.col("w"))).filter(F.struct("id", "begin") != F.col("first"))
    ranges = ranges.unionByName(again.select("id", "begin", "end", "digest"))
    return ranges.groupBy("id").agg(F.collect_set(F.struct("begin", "end", "digest")).alias("spans"))


def merged(spans: list[dict] | None, raw: bytes) -> list[tuple[int, int]]:
    """The ranges in order whose bytes are what they repeat, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((x["begin"], x["end"]) for x in spans or () if x["end"] <= len(raw) and digest(raw[x["begin"] : x["end"]]) == x["digest"]):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


@own_names
def with_kept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``removed`` (byte ranges in order, array<struct<begin, end>>) and ``kept`` (the other bytes, binary)."""
    docs = docs.drop("removed", "kept")
    spans = removed(docs, id_col, text_col).select(F.col("id").alias("__id"), F.col("spans").alias("__spans"))
    df = docs.join(spans, F.col(id_col).cast("long") == F.col("__id"), "left").drop("__id")
    ranges = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("removed", ranges), T.StructField("kept", T.BinaryType())])
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            names, columns = list(batch.schema.names), list(batch.columns)
            spans = columns.pop().to_pylist()
            told, left = [], []
            for text, some in zip(batch.column(names.index(text_col)).to_pylist(), spans):
                raw = (text or "").encode("utf-8", "surrogatepass")
                runs = merged(some, raw)
                told.append([{"begin": b, "end": e} for b, e in runs])
                edges = [0, *[x for run in runs for x in run], len(raw)]
                left.append(b"".join(raw[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(told, kind), pa.array(left, pa.binary())], names=[*names[:-1], "removed", "kept"])

    return df.mapInArrow(apply, schema)
