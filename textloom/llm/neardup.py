"""Near-duplicates by a chosen-path set similarity join.

A document is its set of five-word shingles. From it come ``TOKENS`` minwise tokens. There are ``TREES`` independent trees,
each of which chooses a token position of its own at the root and sends a document to the node of its token there. Nodes of
two or more documents are worked on:

* a node of at most ``LEAF`` documents is compared exhaustively;
* in a larger one, all documents are first held against one of them, that which shares nodes with the most others (the hub).
  If at most ``LEAF`` are then outside the node's largest component, these few are compared with all documents of the node,
  in blocks of ``LEAF``;
* a node with more outside branches: some positions are chosen by a hash of the node, and its documents go to a child for
  each, which is worked on in the same way.

A comparison has two steps, both within blocks that have all their documents in one task and no more than twice ``LEAF``.
Blocks of long documents are taken apart for the second step, so that a task holds two parts of ``TILE`` shingles at once.
First tokens: which documents of the block have a partner of another component that agrees in at least ``SKETCH`` tokens?
A pair that meets in several roots counts in the first of them only. The rest goes no further. Then the full sets of those
documents are brought to the block, once each, and counted there exactly; what leaves a block are the links that join two
components, fewer than it has documents. So neither step emits pairs, and a group of thousands of copies is rows in
proportion to its members.

Recall, for a pair at the threshold: it agrees in fewer than ``SKETCH`` tokens with probability 2e-7, and meets in none of
the roots with 0.25**16. If a root it meets in branches (over ``LEAF`` documents outside the largest component, which takes
very common tokens), it survives a tree with probability 0.3 to 0.6, so that of 16 trees it is missed once in 50 to 5000 if
all its roots do. Tests and README hold figures against all pairs.

Defined cases: null or empty text has no shingles, is linked with nothing and is its own component; a null id cannot be
linked and has a null component and is kept; equal texts are in one component with the smallest id; rows that share an id
but not their text are one document's, and link what their texts link; texts of fewer than five words are one shingle; an
empty table gives an empty result; extra columns are not touched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import NOT_SPACE, Scratch, Words, cut, in_chunks, mix, own_names, slices, small
from textloom.llm.graph import components

SHINGLE = 5
PERCENT = 75
TOKENS = 64
TREES = 16
SKETCH = 30
LEAF = 1024
BRANCH = 1.5
#: Levels that a node branches at once, before its children are looked at.
STEPS = 4
MAX_LEVELS = 60
#: Shingles of the documents of a block that are one part of it; more parts are compared two at a time.
TILE = 1 << 21
#: Bytes of text that are hashed at once, and pairs whose tokens are compared at once.
CHUNK, PAIRS = 1 << 20, 1 << 15

_SALT = mix(np.arange(1, 257, dtype=np.uint64))
_TIMES, _PLUS = _SALT[:TOKENS] | np.uint64(1), _SALT[64 : 64 + TOKENS]
#: A sketch: tokens of the roots' positions in 32 bits, as they name nodes; the others in 16.
_SKETCH = np.dtype([("root", "<u4", TREES), ("rest", "<u2", TOKENS - TREES)])


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    words = Words(texts, NOT_SPACE)
    hashes = words.hash
    whole = len(hashes) - SHINGLE + 1
    if whole > 0:
        rolled = np.zeros(whole, np.uint64)
        for k in range(SHINGLE):
            rolled = mix(rolled + hashes[k : k + whole] * _TIMES[k])
    for k, n in enumerate(words.count):
        first = words.first[k]
        if n >= SHINGLE:
            yield np.unique(rolled[first : first + n - SHINGLE + 1])
        elif n:
            yield np.array([xxhash.xxh3_64_intdigest(hashes[first : first + n].tobytes())], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """TOKENS minwise hashes of a set."""
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 4096):
        best = np.minimum(best, ((shingles[k : k + 4096, None] ^ _PLUS) * _TIMES).min(axis=0))
    return mix(best)


def sketch_of(shingles: np.ndarray) -> bytes:
    tokens = minwise(shingles)
    return tokens[:TREES].astype("<u4").tobytes() + tokens[TREES:].astype("<u2").tobytes()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_shingles, digest, sketch) of (id, text)."""
    for batch in slices(batches, 1):
        for ids, texts in in_chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist(), CHUNK):
            rows = [(len(x), xxhash.xxh3_128_digest(x.tobytes()), sketch_of(x)) if len(x) else (0, None, None) for x in shingle_sets(texts)]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], names=["id", "n_shingles", "digest", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, shingles) of texts."""
    for batch in slices(batches, 0):
        texts = batch.column(0).to_pylist()
        for _, some in in_chunks(texts, texts, CHUNK):
            sets = [x for x in shingle_sets(some) if len(x)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            shingles = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()), shingles], names=["digest", "shingles"])


def _whole_blocks(work: Callable[[pa.Table], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on runs of whole blocks, of rows that come ordered by ``block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column("block").to_numpy()
            # what stands before the last block's begin is whole
            cut = len(blocks) - int((blocks[::-1] == blocks[-1]).argmin()) if blocks[0] != blocks[-1] else 0
            if cut or waiting and waiting[-1].column("block")[-1].as_py() != blocks[0]:
                yield work(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield work(pa.Table.from_batches(waiting))

    return run


def _bounds(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the block of each row begins and ends."""
    start = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
    size = np.diff(np.append(start, len(blocks)))
    return np.repeat(start, size), np.repeat(start + size, size)


def _candidates(table: pa.Table) -> pa.RecordBatch:
    """Those rows of blocks that have a partner by tokens; in a block the few, which are compared with all, come first."""
    block, doc, few, comp, n, root, roots = (table.column(c).to_numpy() for c in ("block", "doc", "few", "comp", "n", "root", "roots"))
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), _SKETCH)
    mine, ends = np.flatnonzero(few), _bounds(block)[1]
    later = ends[mine] - mine - 1
    hit = np.zeros(len(block), bool)
    step = np.concatenate(([0], np.cumsum(later)))
    at = 0
    while at < len(mine):
        to = max(at + 1, int(np.searchsorted(step, step[at] + PAIRS, "right")) - 1)
        i = np.repeat(mine[at:to], later[at:to])
        j = i + 1 + np.arange(len(i)) - np.repeat(step[at:to] - step[at], later[at:to])
        at = to
        able = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
        i, j = i[able], j[able]
        same = sketch["root"][i] == sketch["root"][j]
        alike = same.sum(axis=1) + (sketch["rest"][i] == sketch["rest"][j]).sum(axis=1) >= SKETCH
        i, j, same = i[alike], j[alike], same[alike]
        # in the first root in which they meet and are compared
        meet = same & ((roots[i][:, None] >> np.arange(TREES)) & 1).astype(bool)
        here = (root[i] < 0) | ~meet.any(axis=1) | (meet.argmax(axis=1) == root[i])
        hit[i[here]] = hit[j[here]] = True
    return pa.RecordBatch.from_arrays([pa.array(x) for x in _tiles(block[hit], doc[hit], few[hit], comp[hit], n[hit])], names=["block", "doc", "few", "comp"])


def _tiles(block: np.ndarray, doc: np.ndarray, few: np.ndarray, comp: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(block, doc, few, comp), where a block with more than TILE shingles is a block for each two of its parts of so many.

    A document with more is a part of its own. Parts of which none has any of the few are not compared with each other.
    """
    if not len(block):
        return block, doc, few, comp
    start, end = _bounds(block)
    before = np.cumsum(n) - n
    before -= before[start]
    part = before // TILE
    part = np.cumsum(np.concatenate(([True], (part[1:] != part[:-1]) | (start[1:] != start[:-1]))))
    part -= part[start]  # numbers in a row, although a long document may leave some out
    parts = part[end - 1] + 1
    if parts.max() == 1:
        return block, doc, few, comp
    # the few come first, so theirs are the first parts
    with_few = np.maximum.reduceat(np.where(few, part, -1), np.unique(start))[np.searchsorted(np.unique(start), start)]
    row = np.repeat(np.arange(len(block)), parts)
    other = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    low, high = np.minimum(part[row], other), np.maximum(part[row], other)
    # a part alone is in each of its pairs
    wanted = (parts[row] == 1) | (low != high) & (low <= with_few[row])
    row, low, high = row[wanted], low[wanted].astype(np.uint64), high[wanted].astype(np.uint64)
    named = mix(mix(mix(block[row].view(np.uint64)) + low) + high).view(np.int64)
    return np.where(parts[row] == 1, block[row], named), doc[row], few[row], comp[row]


def _links(table: pa.Table) -> pa.RecordBatch:
    """Links between components of the few and all documents of blocks, counted on the full sets."""
    block, doc, few, comp = (table.column(c).to_numpy() for c in ("block", "doc", "few", "comp"))
    comp, ends = comp.copy(), _bounds(block)[1]
    sets = table.column("shingles").combine_chunks()
    offset = sets.offsets.to_numpy().astype(np.int64)
    known, number = np.unique(sets.values.to_numpy()[offset[0] : offset[-1]], return_inverse=True)
    offset = offset - offset[0]
    size, member, found = np.diff(offset), np.zeros(len(known), bool), []
    for i in np.flatnonzero(few).tolist():
        end = ends[i]
        others = i + 1 + np.flatnonzero(comp[i + 1 : end] != comp[i])
        if not len(others):
            continue
        others = others[100 * np.minimum(size[i], size[others]) >= PERCENT * np.maximum(size[i], size[others])]
        if not len(others):
            continue
        own = number[offset[i] : offset[i + 1]]
        member[own] = True
        first, last = others[0], others[-1] + 1
        common = np.add.reduceat(member[number[offset[first] : offset[last]]], offset[first:last] - offset[first], dtype=np.int64)[others - first]
        member[own] = False
        for j in others[100 * common >= PERCENT * (size[i] + size[others] - common)].tolist():
            if comp[j] != comp[i]:
                found.append((doc[i], doc[j]))
                here = comp[i:end]
                here[here == comp[j]] = comp[i]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, doc) some levels down: positions are chosen by a hash of the node, so all its documents choose alike."""
    positions = mix(np.arange(1000, 1000 + TOKENS, dtype=np.uint64))
    bound = np.uint64(int(2**64 * BRANCH / TOKENS))
    for batch in batches:
        nodes = batch["node"].to_numpy(np.int64).view(np.uint64)
        sketch = np.frombuffer(b"".join(batch["sketch"]), _SKETCH)
        tokens = np.concatenate([sketch["root"].astype(np.uint64), sketch["rest"].astype(np.uint64)], axis=1).reshape(len(nodes), TOKENS)
        of = np.arange(len(nodes))
        for _ in range(STEPS):
            chance = mix(nodes[:, None] ^ positions)
            row, position = np.nonzero(chance < bound)
            nodes = mix(mix(chance[row, position]) + tokens[of[row], position])
            of = of[row]
        yield pd.DataFrame({"node": nodes.view(np.int64), "doc": batch["doc"].to_numpy()[of]})


def _labelled(rows: DataFrame, labels: DataFrame | None, doc: str = "doc") -> DataFrame:
    """``rows`` with ``comp``; labels has those documents only that are in a component of another name."""
    if labels is None:
        return rows.withColumn("comp", F.col(doc))
    rows = rows.join(labels.select(F.col("node").alias("__node"), "component"), F.col(doc) == F.col("__node"), "left")
    return rows.withColumn("comp", F.coalesce("component", doc)).drop("component", "__node")


class _Join:
    """A join on its way: the distinct texts ``reps`` (doc, id, digest, n, sketch), and the links found so far as ``labels``."""

    def __init__(self, docs: DataFrame, reps: DataFrame, scratch: Scratch):
        self.docs, self.reps, self.cut = docs, reps, scratch.cut
        self.labels: DataFrame | None = None

    def add(self, links: DataFrame) -> None:
        """New links between components become components of those that there are, so old links are not looked at again."""
        for end in ("a", "b"):
            links = _labelled(links, self.labels, end).drop(end).withColumnRenamed("comp", end)
        links = self.cut(links.filter("a <> b").distinct())
        if links.isEmpty():
            return
        new = components(links, self.cut).filter(F.col("node") != F.col("component"))
        if self.labels is not None:
            old = self.labels.join(new.toDF("__node", "__component"), F.col("component") == F.col("__node"), "left")
            new = old.select("node", F.coalesce("__component", "component").alias("component")).unionByName(new)
        self.labels = self.cut(new)

    def compare(self, blocks: DataFrame) -> None:
        """Adds the links in ``blocks`` (block, doc, few, root, roots): in each, of the few with all documents."""
        told = blocks.join(_labelled(self.reps.select("doc", "n", "sketch"), self.labels), "doc")
        told = told.repartition("block").sortWithinPartitions("block", F.desc("few"), "doc")
        found = self.cut(told.mapInArrow(_whole_blocks(_candidates), "block long, doc long, few boolean, comp long"))
        wanted = self.cut(self.reps.select("doc", "id", "digest").join(found.select("doc").distinct(), "doc", "left_semi"))
        # no text moves, unless those with a candidate are too many to be named to all tasks
        texts = self.docs.join(small(wanted.select("id")), "id", "left_semi").select("text")
        sets = texts.mapInArrow(_sets, "digest binary, shingles array<long>").join(wanted.select("doc", "digest"), "digest")
        sets = self.cut(sets.groupBy("doc").agg(F.first("shingles").alias("shingles")))
        each = found.join(sets, "doc").repartition("block").sortWithinPartitions("block", F.desc("few"), "doc")
        self.add(self.cut(each.mapInArrow(_whole_blocks(_links), "a long, b long")))

    def hubs(self, front: DataFrame) -> DataFrame:
        """Blocks of the documents of large nodes with the hubs of these; a hub with many is in several."""
        # the more documents stand in a document's nodes, the likelier it is like many
        scores = front.groupBy("doc").agg(F.sum("size").alias("score"))
        hub = front.join(scores, "doc").groupBy("node").agg(F.max_by("doc", F.struct("score", "doc")).alias("hub"))
        pairs = self.cut(front.join(hub, "node").filter("doc <> hub").select("hub", "doc").distinct())
        parts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / LEAF).alias("parts"))
        others = pairs.join(parts, "hub").select("hub", F.pmod(F.xxhash64("doc"), "parts").alias("part"), "doc", F.lit(False).alias("few"))
        own = parts.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("hub").alias("doc"), F.lit(True).alias("few"))
        return _blocks(others.unionByName(own), "hub", "part")

    def outside(self, front: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Of large nodes, what is outside of their largest components: blocks of these few with all, and nodes with too many."""
        here = self.cut(front.join(_labelled(self.reps.select("doc"), self.labels), "doc"))
        parts = here.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("of"))
        sizes = parts.groupBy("node").agg(F.max_by("comp", F.struct("of", "comp")).alias("main"), (F.sum("of") - F.max("of")).alias("others"), F.ceil(F.max("of") / LEAF).alias("parts"))
        sizes = self.cut(sizes.filter("others > 0"))
        here = here.join(sizes, "node")
        some = here.filter(F.col("others") <= LEAF)
        main = some.filter("comp = main").select("node", F.pmod(F.xxhash64("doc"), "parts").alias("part"), "doc", "root", F.lit(False).alias("few"))
        few = some.filter("comp <> main").select("node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "doc", "root", F.lit(True).alias("few"))
        return _blocks(main.unionByName(few), "node", "part", root=True), here.filter(F.col("others") > LEAF).select("node", "doc")


def _blocks(rows: DataFrame, *key: str, root: bool = False) -> DataFrame:
    block = F.xxhash64(F.lit(len(key)), *key).alias("block")
    return rows.select(block, "doc", "few", "root" if root else F.lit(-1).alias("root"))


def _shared(front: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, doc, root, size): the documents of nodes that have at least two."""
    sizes = front.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return cut(front.join(sizes, "node"))


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component) for every row of ``docs``; component is the smallest id that links reach."""
    with Scratch(docs.sparkSession) as scratch:
        return scratch.keep(_components_of(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), scratch))


def _components_of(docs: DataFrame, scratch: Scratch) -> DataFrame:
    cut = scratch.cut
    rows = cut(docs.mapInArrow(_sketches, "id long, n_shingles long, digest binary, sketch binary"))
    linkable = rows.filter(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    # texts with equal sets are one, and have a number of their own
    told = linkable.groupBy("digest").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    reps = cut(told.withColumn("doc", F.monotonically_increasing_id()))
    join = _Join(docs, reps, scratch)
    several = linkable.groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).filter("x < y").select("id")
    several = cut(linkable.join(several, "id", "left_semi").join(reps.select("digest", "doc"), "digest").select(F.col("id"), "doc").distinct())
    join.add(several.join(several.groupBy("id").agg(F.min("doc").alias("a")), "id").select("a", F.col("doc").alias("b")))
    token = [F.struct(F.xxhash64(F.lit(t), F.substring("sketch", 4 * t + 1, 4)).alias("node"), F.lit(t).alias("root")) for t in range(TREES)]
    front = _shared(reps.select("doc", F.inline(F.array(*token))), cut)
    for _ in range(MAX_LEVELS):
        blocks = _blocks(front.filter(F.col("size") <= LEAF).withColumn("few", F.lit(True)), "node", root=True)
        large = front.filter(F.col("size") > LEAF)
        branching = None
        if not large.isEmpty():
            join.compare(join.hubs(large).withColumn("roots", F.lit(0)))
            more, branching = join.outside(large)
            blocks = cut(blocks.unionByName(more))
        compared = blocks.filter("root >= 0").groupBy("doc").agg(F.bit_or(F.expr("shiftleft(1, root)")).alias("roots"))
        join.compare(blocks.join(compared, "doc", "left").withColumn("roots", F.coalesce("roots", F.lit(0))))
        if branching is None or branching.isEmpty():
            break
        branching = branching.join(reps.select("doc", "sketch"), "doc").select("node", "doc", "sketch")
        front = cut(branching.mapInPandas(_children, "node long, doc long").distinct()).withColumn("root", F.lit(-1))
        front = _shared(front, cut)
    else:
        raise RuntimeError(f"nodes are still open after {MAX_LEVELS} levels")
    named = cut(_labelled(reps.select("digest", "doc", "id"), join.labels))
    least = named.groupBy("comp").agg(F.min("id").alias("component"))
    named = named.join(least, "comp").select("digest", "component")
    found = rows.select("id", "n_shingles", "digest").join(named, "digest", "left")
    return found.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


@own_names
def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each component that with the smallest id."""
    found = components_of(docs, id_col, text_col)
    gone = cut(found.filter(F.col("component") < F.col("id")).select(F.col("id").alias("__gone")).distinct())
    return docs.join(small(gone), F.col(id_col) == F.col("__gone"), "left_anti")
