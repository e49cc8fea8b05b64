"""Benchmark decontamination with suffix arrays of the training texts.

Benchmark items come in blocks of at most ``BLOCK_BYTES``; a block is sent to all tasks. For each shard of the training texts
(a run of about 1 MB within a task), hashes of the windows of its words are held against those of the block, so that only
suffixes that begin with a window of an item are looked at, however much of their vocabulary texts and items share. These are
sorted into a suffix array, into which the suffixes of the items are placed by binary search; ranks by 1, 2, 4, .. windows
(prefix doubling) order those that go on alike. The longest verbatim match of a place with an item is then with one of the two
suffixes of the item that stand beside it in that order. Suffixes of a text whose word before is that of every suffix of the
item with the same window are within a longer match and not looked at, so work is in proportion to the places where matches
begin; neither one repeated word nor a phrase that text and item repeat is a quadratic case. The words of the matches are held
against the bytes of the texts.

Blocks are applied one after the other to the shards of the same task, which holds one of them at a time, so nothing is
shuffled and no document is ever in one place with another. The driver reads the items as a stream and holds one block. At most
``SENT_BYTES`` of items are with the executors at once: beyond that, the matches with those so far are written with the rows
to a table in the shared folder, their blocks are taken back, and the next ones are sent.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window.

Defined cases: null or empty text has no words and no match; an item without words matches nothing; items with equal texts
all match; a null item id marks words as hit but is in no list of items; repeated rows get equal results; with an empty
benchmark nothing is hit; an empty table gives an empty result; extra columns of ``docs`` are kept, those named like the
added ones are replaced. Of the matches of one place of a text with several places of one item, the longest is told, and only
if it does not go on to the left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import ALNUM, Words, cut, free, in_chunks, mix, powers, slices

WINDOW = 10
BLOCK_BYTES = 8 << 20
SENT_BYTES = 256 << 20
#: Where a window of an item stands in a text: words item_word.. of the item are words word.. of the text, n_words long.
MATCH = "array<struct<item:long, item_word:int, word:int, n_words:int>>"
_MATCH_TYPE = pa.list_(pa.struct([("item", pa.int64()), ("item_word", pa.int32()), ("word", pa.int32()), ("n_words", pa.int32())]))


def _spread(begin: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, .. of each range, one range after the other."""
    return np.repeat(begin - (np.cumsum(times) - times), times) + np.arange(times.sum())


def _keys(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The word numbers of the windows at these places, as strings whose order is theirs."""
    return np.ascontiguousarray(ids[at[:, None] + np.arange(size)].astype(">u4")).view(f"S{4 * size}").ravel()


def _windows(words: Words, size: int, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The places where whole windows begin, in the texts ``of`` only or in all, and the hashes of these windows."""
    up, down = powers(len(words.hash) + 1)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.hash * up[:-1])))
    whole = np.arange(len(words.hash)) + size <= words.first[1:][words.doc]
    at = np.flatnonzero(whole if of is None else whole & of[words.doc])
    return at, mix((prefix[at + size] - prefix[at]) * down[at])


class _Order:
    """The order of suffixes, each the windows from its place on, by ranks over 1, 2, 4, .. windows."""

    def __init__(self, window: np.ndarray, place: np.ndarray, text: np.ndarray):
        """Suffixes in the order of their places: number of the window there, from 1 on, place, and text."""
        here = np.arange(len(place))
        breaks = np.concatenate(((place[1:] != place[:-1] + 1) | (text[1:] != text[:-1]), [True]))
        ends = np.flatnonzero(breaks)
        self.run = ends[np.searchsorted(ends, here)] + 1 - here  # windows from each on that follow each other
        self.ranks, step = [window.astype(np.int64)], 1
        classes = len(np.unique(window))
        while step < self.run.max(initial=0):
            rank = self.ranks[-1]
            then = np.where(step < self.run, rank[np.minimum(here + step, len(here) - 1)], 0)
            distinct, finer = np.unique(rank * (len(here) + 1) + then, return_inverse=True)
            if len(distinct) == classes:
                break
            self.ranks.append(finer + 1)
            classes, step = len(distinct), 2 * step

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many windows the suffixes a and b have in common."""
        same = np.where(self.ranks[-1][a] == self.ranks[-1][b], self.run[a], 0)
        for level in range(len(self.ranks) - 2, -1, -1):
            on = (same < self.run[a]) & (same < self.run[b])
            x, y = a[on] + same[on], b[on] + same[on]
            same[on] += np.where(self.ranks[level][x] == self.ranks[level][y], np.minimum(1 << level, self.run[x]), 0)
        return same


class Block:
    """The suffixes of a block of benchmark items, ready to be looked up."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        texts = [(x[1] or "").encode("utf-8", "surrogatepass") for x in items]
        self.words = words = Words(texts, ALNUM)
        self.items = [x[0] for x in items]
        self.vocabulary, self.spelt, ids = np.unique(words.hash, return_index=True, return_inverse=True)
        self.ids = ids.astype(np.int64) + 1
        self.windows = []  # length, hashes in order, their places, and a table of the first bits of the hashes
        for size in np.unique(np.minimum(words.count, WINDOW)):
            if size:
                at, hashes = _windows(words, int(size), np.minimum(words.count, WINDOW) == size)
                order = np.argsort(hashes, kind="stable")
                shift = np.uint64(64 - max(10, int(8 * len(at)).bit_length()))
                first = np.zeros(1 << (64 - int(shift)), bool)
                first[hashes >> shift] = True
                self.windows.append((int(size), hashes[order], at[order], first, shift))

    def matches(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple]]]:
        """The number of words of each text, and its longest matches."""
        words, found = Words(texts, ALNUM), [[] for _ in texts]
        for size, hashes, places, first, shift in self.windows:
            at, own = _windows(words, size)
            known = first[own >> shift]
            at, own = at[known], own[known]
            known = hashes[np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)] == own
            at, own = at[known], np.unique(own[known])
            if len(at):
                low = np.searchsorted(hashes, own)
                theirs = np.sort(places[_spread(low, np.searchsorted(hashes, own, "right") - low)])
                for text, *match in self._longest(words, at, theirs, size):
                    found[text].append(tuple(match))
        return words.count, found

    def _longest(self, words: Words, at: np.ndarray, theirs: np.ndarray, size: int) -> Iterator[tuple]:
        """(text, item, word of the item, word of the text, words) of the matches that begin at these places, with these places of items."""
        ids = self._numbered(words, at, size)
        array, window = np.unique(_keys(ids, at, size), return_inverse=True)
        keys = _keys(self.ids, theirs, size)
        place = np.minimum(np.searchsorted(array, keys), len(array) - 1)
        theirs, place = theirs[array[place] == keys], place[array[place] == keys]
        item, before = self.words.doc[theirs], self._before(self.words, self.ids, theirs)
        order = _Order(np.concatenate([window, place]) + 1, np.concatenate([at, theirs + len(ids) + 1]), np.concatenate([words.doc[at], item + len(words.count)]))

        # which items have a window, and the word before it if that is the same wherever it stands in the item
        by = np.lexsort((before, item, place))
        begins = np.flatnonzero(np.concatenate(([True], (place[by][1:] != place[by][:-1]) | (item[by][1:] != item[by][:-1])))) if len(by) else by
        ends = np.concatenate((begins[1:], [len(by)]))
        of_window, of_item = place[by][begins], item[by][begins]
        word = np.where(before[by][begins] == before[by][ends - 1], before[by][begins], 0) if len(by) else by
        group = of_window * (len(self.vocabulary) + 1) + word
        by = np.argsort(group, kind="stable")
        of_item, group = of_item[by], group[by]
        own, base = self._before(words, ids, at), window * (len(self.vocabulary) + 1)
        low, high = np.searchsorted(group, base), np.searchsorted(group, base + len(self.vocabulary), "right")
        skip = np.where(own > 0, np.searchsorted(group, base + own), high)
        go_on = np.where(own > 0, np.searchsorted(group, base + own, "right"), high)
        begin, times = np.concatenate([low, go_on]), np.concatenate([skip - low, high - go_on])
        node = np.repeat(np.concatenate([np.arange(len(at))] * 2), times)
        with_item = of_item[_spread(begin, times)]

        # the suffixes of the item beside that of the text
        rank = order.ranks[-1]
        top = np.int64(rank.max(initial=0) + 1)
        mine = item * top + rank[len(at) :]
        sort = np.argsort(mine, kind="stable")
        next_ = np.searchsorted(mine[sort], with_item * top + rank[node])
        best, chosen = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        for beside in (next_, next_ - 1):
            there = sort[np.clip(beside, 0, len(sort) - 1)] if len(sort) else beside
            ok = (beside >= 0) & (beside < len(sort)) & (item[there] == with_item) if len(sort) else np.zeros(len(node), bool)
            n = np.where(ok, order.shared(node, there + len(at)), 0)
            best, chosen = np.where(n > best, n, best), np.where(n > best, there, chosen)
        whole = (best > 0) & ((own[node] == 0) | (own[node] != before[chosen])) if len(node) else best > 0
        by = np.lexsort((with_item[whole], node[whole]))
        start, n, chosen, with_item = at[node[whole]][by], best[whole][by] + size - 1, theirs[chosen[whole]][by], with_item[whole][by]
        wrong = self._misread(words, ids, start, n)
        text = words.doc[start]
        rows = zip(text.tolist(), with_item.tolist(), (chosen - self.words.first[with_item]).tolist(), (start - words.first[text]).tolist(), n.tolist(), start.tolist())
        for t, k, m, w, length, a in rows:
            if not len(wrong) or np.searchsorted(wrong, a) == np.searchsorted(wrong, a + length):
                yield t, self.items[k], m, w, length

    def _numbered(self, words: Words, at: np.ndarray, size: int) -> np.ndarray:
        """The numbers in the block's vocabulary of the words of these windows and before them; 0 elsewhere and for other words."""
        step = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(step, np.maximum(at - 1, 0), 1)
        np.add.at(step, at + size, -1)
        needed = np.flatnonzero(np.cumsum(step)[:-1])
        place = np.minimum(np.searchsorted(self.vocabulary, words.hash[needed]), len(self.vocabulary) - 1)
        ids = np.zeros(len(words.hash), np.int64)
        ids[needed] = np.where(self.vocabulary[place] == words.hash[needed], place + 1, 0)
        return ids

    @staticmethod
    def _before(words: Words, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The number of the word before each place, 0 if the text begins there."""
        return np.where(at > words.first[words.doc[at]], ids[at - 1], 0)

    def _misread(self, words: Words, ids: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The places of those words of matches that have the hash of a word of the block, but are another word."""
        step = np.zeros(len(ids) + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + size, -1)
        places = np.flatnonzero(np.cumsum(step)[:-1])
        theirs = self.spelt[ids[places] - 1]
        length = words.end[places] - words.start[places]
        wrong = length != self.words.end[theirs] - self.words.start[theirs]
        places, theirs, length, odd = places[~wrong], theirs[~wrong], length[~wrong], places[wrong]
        k = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        differs = words.raw[np.repeat(words.start[places], length) + k] != self.words.raw[np.repeat(self.words.start[theirs], length) + k]
        return np.unique(np.concatenate([odd, np.repeat(places, length)[differs]]))


def _in_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in items.toLocalIterator():
        more = len((row[1] or "").encode("utf-8", "surrogatepass")) + 16
        if block and size + more > block_bytes:
            yield block
            block, size = [], 0
        block.append(tuple(row))
        size += more
    yield block


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """``docs`` with ``n_words`` and ``matches``."""
    spark, docs = docs.sparkSession, docs.drop("n_words", "matches")
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text"))
    docs = docs.withColumns({"n_words": F.lit(0).cast("long"), "matches": F.array().cast(MATCH)})
    group, size, written = [], 0, None
    for block in _in_blocks(items, block_bytes):
        if group and size + block_bytes > sent_bytes:
            docs = cut(_scanned(docs, group, text_col))
            for x in group:
                x.destroy()
            if written is not None:
                free(written)
            group, size, written = [], 0, docs
        group.append(spark.sparkContext.broadcast(block))
        size += block_bytes
    return _scanned(docs, group, text_col)


def _scanned(docs: DataFrame, sent: list, text_col: str) -> DataFrame:
    """``docs`` with the matches with these blocks beside those that it has."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Block(sent[0].value) if len(sent) == 1 else None
        # several blocks are made again for each part, so these are longer
        for batch in slices(batches, text_col, 1 << (22 if ready else 25)):
            texts = batch.column(text_col).to_pylist()
            found: list[list[tuple]] = [[] for _ in texts]
            counts: list[int] = []
            for x in sent:
                block, at = ready or Block(x.value), 0
                if not ready:
                    vars(x).pop("_value", None)  # the worker keeps none of several blocks: the next use reads it again
                for _, some in in_chunks(texts, texts):
                    n, more = block.matches(some)
                    for mine, theirs in zip(found[at : at + len(some)], more):
                        mine += theirs
                    at += len(some)
                    if x is sent[0]:
                        counts += n.tolist()
            earlier = batch.column("matches").to_pylist()
            told = pa.array([x + [dict(zip(("item", "item_word", "word", "n_words"), m)) for m in y] for x, y in zip(earlier, found)], _MATCH_TYPE)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(counts, pa.int64()), told], names=batch.schema.names)

    return docs.mapInArrow(scan, docs.schema)


def summary(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_words, n_hit, n_items, items, longest, contaminated) for every row of ``docs``.

    items: the ids with matches as strings in order, comma-joined; longest: the words of the longest verbatim match.
    """
    df = with_matches(docs.select(F.col(id_col), F.col(text_col)), benchmark, text_col, **options).drop(text_col)
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit"))
    grow = lambda a, m: F.struct(F.greatest(a["end"], m["word"] + m["n_words"]).alias("end"), (a["hit"] + F.greatest(F.lit(0), m["word"] + m["n_words"] - F.greatest(a["end"], m["word"]))).alias("hit"))
    placed = F.array_sort(F.transform("matches", lambda m: F.struct(m["word"].alias("word"), m["n_words"].alias("n_words"))))
    items = F.array_sort(F.array_distinct(F.transform(F.filter("matches", lambda m: m["item"].isNotNull()), lambda m: m["item"].cast("string"))))
    df = df.withColumn("n_hit", F.aggregate(placed, start, grow)["hit"].cast("long")).withColumn("__items", items)
    longest = F.coalesce(F.array_max(F.transform("matches", lambda m: m["n_words"])), F.lit(0)).cast("long")
    return df.select(id_col, "n_words", "n_hit", F.size("__items").cast("long").alias("n_items"), F.array_join("__items", ",").alias("items"), longest.alias("longest"), (F.col("n_hit") > 0).alias("contaminated"))


def keep(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a match, with all columns."""
    clash = [c for c in ("n_words", "matches") if c in docs.columns]
    plain = docs.withColumnsRenamed({c: f"__own_{c}" for c in clash})
    rows = with_matches(plain, benchmark, text_col, **options).filter(F.size("matches") == 0).drop("n_words", "matches")
    return rows.withColumnsRenamed({f"__own_{c}": c for c in clash}).select(*docs.columns)
