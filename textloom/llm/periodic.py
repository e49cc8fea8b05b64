"""Periodic run detection: stretches of words that repeat with a period, found through Lyndon arrays in linear time.

A run is a stretch with a smallest period q that is at least ``min_exponent`` periods long and that neither neighbour extends. By the
runs theorem, each of its full turns that begin at the Lyndon rotation of its root is, in the order of words or in the opposite one,
the longest Lyndon word that begins there. So both Lyndon arrays are computed, with the length to which each such word repeats after
itself, and every run is read off its first turn.

After Ellert and Fischer, words are only compared: nothing is hashed and no suffix array or tree is built. Suffixes are compared along
the edges of next and previous smaller suffixes; an edge inside a stretch that was matched before takes the length of the edge at
the place it was matched with, and only what lies beyond the furthest matched word is compared anew.

Null texts have no words and no runs. Copies of a document have the same runs. A document is one task's, in memory of some 30 bytes a
word; time is linear in its words (but for the first turn of a run, which is extended to the left by less than a period).
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textloom.llm.common import slices

MIN_LENGTH = 6
MIN_EXPONENT = 4

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def lyndon_array(s, rising: bool = True) -> tuple[array, array]:
    """(next smaller suffix, how long the two suffixes agree) for each place of ``s``; -1 where no smaller suffix follows.

    ``s`` is a sequence of numbers. In either order the end of ``s`` is smaller than everything, so what ends is smaller than what
    goes on. s[i:next[i]] is the longest Lyndon word at i.
    """
    n = len(s)
    smaller, agree = array("i", [-1]) * n, array("i", [0]) * n
    before, shared = array("i", [-1]) * n, array("i", [0]) * n  # the edges to previous smaller suffixes
    furthest = begun = shift = last = 0  # s[begun:furthest] was matched with the stretch ``shift`` words before it
    for r in range(1, n):
        at, k = r - 1, -1
        while at >= 0:
            scan = True
            if k >= 0 and shared[last] != k:  # of two agreements that differ, the shorter one holds
                k, scan = min(k, shared[last]), False
            elif begun < r < furthest and at >= begun:
                was, then = at - shift, r - shift
                k = agree[was] if smaller[was] == then else shared[then]
                scan = r + k >= furthest
                if scan:
                    k = furthest - r
            elif k < 0:
                k = 0
            if scan:
                x, y = at + k, r + k
                while y < n and s[x] == s[y]:
                    x += 1
                    y += 1
                k = y - r
                if y >= furthest:
                    furthest, begun, shift = y, r, r - at
            end = r + k
            if end < n and (s[end] > s[at + k]) == rising:
                before[r], shared[r] = at, k
                break
            smaller[at], agree[at] = r, k
            last, at = at, before[at]
    return smaller, agree


#: How often stretches are counted again; more only saves time.
ROUNDS = 6


def _stretches(codes: np.ndarray, least: int, length: int) -> list[tuple[int, np.ndarray]]:
    """(start, codes) of the stretches that can hold a run: each of a run's words stands in it ``least`` times, so a rarer word parts a text,
    and what it parts is counted again, each stretch by itself."""
    place = np.flatnonzero(np.bincount(codes)[codes] >= least) if len(codes) else codes
    for _ in range(ROUNDS):
        stretch = np.cumsum(np.diff(place, prepend=-1) != 1)
        _, same, often = np.unique(stretch * (len(codes) + 1) + codes[place], return_inverse=True, return_counts=True)
        good = (often[same] >= least) & (np.bincount(stretch)[stretch] >= length) if len(place) else np.ones(0, bool)
        if good.all():
            break
        place = place[good]
    edges = np.flatnonzero(np.diff(place, prepend=-2) != 1)
    return [(int(x[0]), codes[x]) for x in np.split(place, edges[1:]) if len(x) >= length]


def runs(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, sorted."""
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    found = set()
    for offset, part in _stretches(codes, min_exponent, max(min_length, min_exponent)):
        s = part.tolist()
        for rising in (True, False):
            smaller, agree = (np.frombuffer(x, np.int32) for x in lyndon_array(s, rising))
            i = np.flatnonzero(smaller >= 0)
            period, right = smaller[i] - i, agree[i]
            enough = np.maximum(min_length, min_exponent * period)
            # of the turns of a run only the first can be the one that begins less than a period after the run does
            turn = (i >= period) & (smaller[i - period] == i) & (agree[i - period] >= period)
            for a, p, k in zip(*(x[(2 * period - 1 + right >= enough) & ~turn].tolist() for x in (i, period, right))):
                left = 0
                while left < p and a > left and s[a - 1 - left] == s[a + p - 1 - left]:
                    left += 1
                length = p + k + left
                if left < p and length >= max(min_length, min_exponent * p):
                    found.add((offset + a - left, length, p))
    return sorted(found, key=lambda x: (x[0], x[2]))


def coded(words: list[bytes]) -> np.ndarray:
    """Words as numbers, in the order in which they first stand in the text: equal numbers are equal words."""
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def with_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length and period in words, by start and period) and ``collapsed``, the words joined
    by one space without what follows the first period of a run. Columns of these names are replaced, all others kept."""
    added = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    kept = [f for f in docs.schema.fields if f.name.lower() not in {x.name for x in added} and (keep_text or f.name != text)]
    schema = T.StructType([*kept, *added])
    read = docs.select(*[docs[f"`{f.name.replace('`', '``')}`"] for f in docs.schema.fields if f in kept or f.name == text])

    def one(value: bytes | None) -> tuple[int, list[dict], bytes]:
        words = (value or b"").split()  # bytes are parted at ASCII's white space alone
        found = runs(coded(words), min_length, min_exponent)
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            edge[start + period] += 1
            edge[start + length] -= 1
        left = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()] if found else words
        return len(words), [{"start": a, "length": b, "period": p} for a, b, p in found], b" ".join(left)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            values = batch.column(text).cast(pa.binary())
            n, spans, left = zip(*(one(v.as_py()) for v in values)) if batch.num_rows else ((), (), ())
            made = [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))), pa.array(left, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *made], names=schema.names)

    return read.mapInArrow(work, schema)
