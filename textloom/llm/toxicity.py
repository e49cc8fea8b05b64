"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy and applied to whole texts.

A word is the sum of the embeddings of its hashes: of itself and of its first four, five and six bytes, so that the endings of a stem
share what is learned of it. Filters of one, two and three words slide over a text; of each the largest answer counts, and a logistic
layer weighs these. Hashes that fewer than ``MIN_DOCS`` learned texts hold have no embedding. Every labelled text is learned, whole: the
texts are dealt to shards of about ``SHARD``, each pass learns every shard from the same model in a task of its own, and the changes
are averaged by a shuffle; so the driver sees models, never texts. The steps are Adagrad's, on the rows that won a maximum only. Each of
``FOLDS`` parts of the texts is scored by a model of the others, which is learned in the same passes: the score is moved so that ``CUT`` lies
where it parts the labels best, and each language gets its own threshold for ``flagged``, drawn towards the common one where few of its
texts are toxic. Language, source and id are no inputs of the score.

Every text is scored whole, in runs of about a megabyte; null and empty texts have the score of no words. Rows of one id are rows of their
own. With no labels at all the score is ``NO_LABELS`` everywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from textloom.llm.common import ALNUM, Scratch, Words, in_chunks, prefix_hashes, slices, small, span_hashes, step

#: Texts of a shard, about; passes over all texts are ``EPOCHS`` where they are few and ``PASSES`` at least, so that ``LEARNED`` texts are seen.
SHARD = 8_000
PASSES, LEARNED = 3, 40_000
#: Rows of the embedding that are averaged in one group.
PIECE = 1 << 12
#: Parts of a unit of the logit in which answers are counted for the thresholds.
STEPS = 512
#: What :func:`sample_of` takes of each label at most, and of words of one text.
SAMPLE = 3_000
MAX_WORDS = 3_000
BUCKETS = 1 << 15
SIZE = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (4, 5, 6)
EPOCHS, BATCH, RATE = 6, 32, 0.1
MIN_DOCS = 3
FOLDS = 3
CUT = 0.7
NO_LABELS = 0.1
#: Toxic texts of a language that weigh as much as all languages together in its threshold.
PRIOR = 30


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(rows of embeddings of each word: itself and its beginnings; number of words of each text)."""
    words = Words(texts, ALNUM)
    sums = prefix_hashes(words.raw)
    columns = [words.hash]
    for k in PREFIXES:
        end = np.minimum(words.end, words.start + k)
        columns.append(span_hashes(sums, words.start, end) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(7))
    at = [(h >> np.uint64(20)) % np.uint64(BUCKETS) + np.uint64(j * BUCKETS) for j, h in enumerate(columns)]
    return np.stack(at, 1).astype(np.int32), words.count


@dataclass
class Model:
    """embedding: a row for each hash of each kind; filters: by width (words, SIZE, FILTERS), with their biases; weight and bias of the
    logistic layer; scale and shift of its answer; thresholds of the score by language, None for all."""

    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    weight: np.ndarray
    bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str | None, float] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int = 13) -> Model:
        draw = np.random.default_rng(seed)
        normal = lambda *shape: draw.normal(0, 0.1, shape).astype(np.float32)
        filters = {w: normal(w, SIZE, FILTERS) * 3 for w in WIDTHS}
        return cls(normal((1 + len(PREFIXES)) * BUCKETS, SIZE) / 2, filters, {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}, normal(len(WIDTHS) * FILTERS), np.zeros(1, np.float32))

    def pooled(self, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(largest answer of each filter by text, where it was, padded rows, vectors): each text is followed by places without a word, so no
        window reaches into another text, and a text without words has its answer too."""
        pad = max(WIDTHS)
        first = np.concatenate(([0], np.cumsum(counts + pad)[:-1])).astype(np.int64)
        where = np.arange(len(rows)) + np.repeat(np.arange(len(counts)) * pad, counts)
        padded = np.full((len(rows) + pad * len(counts), rows.shape[1]), -1, np.int32)
        padded[where] = rows
        vectors = np.zeros((len(padded), SIZE), np.float32)
        for j in range(rows.shape[1]):
            vectors[where] += self.embedding[rows[:, j]]
        best, places, ends = [], [], np.append(first[1:], len(padded))
        for w in WIDTHS:
            answer = vectors @ self.filters[w][0]
            for j in range(1, w):
                answer[:-j] += vectors[j:] @ self.filters[w][j]
            answer += self.biases[w]
            if self.learning:
                places.append(np.stack([a + answer[a:b].argmax(0) for a, b in zip(first, ends)]))
                best.append(np.take_along_axis(answer, places[-1], 0))
            else:
                best.append(np.maximum.reduceat(answer, first))
        return np.concatenate(best, 1), np.concatenate(places, 1) if places else np.zeros((0, 0), np.int64), padded, vectors

    learning = False

    def logits(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(rows, counts)[0], 0) @ self.weight + self.bias[0]

    def scores(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(rows, counts).astype(np.float64) * self.scale + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Learner:
    """A model that learns by Adagrad on the log loss. Only windows that won a maximum have a gradient, so only their rows move.

    values: the model's arrays by name; squares: the sums of their squared gradients; known: the rows of embeddings that are learned.
    """

    def __init__(self, model: Model, known: np.ndarray, toxic: float, squares: dict[str, np.ndarray] | None = None):
        self.model, self.known, self.toxic = model, known, toxic
        self.values = {"e": model.embedding, "w": model.weight, "b": model.bias}
        self.values |= {f"f{w}": model.filters[w] for w in WIDTHS} | {f"b{w}": model.biases[w] for w in WIDTHS}
        self.squares = squares or {k: np.full_like(v, 0.01) for k, v in self.values.items()}

    def copy(self) -> Learner:
        m = self.model
        own = Model(m.embedding.copy(), {w: x.copy() for w, x in m.filters.items()}, {w: x.copy() for w, x in m.biases.items()}, m.weight.copy(), m.bias.copy())
        return Learner(own, self.known, self.toxic, {k: v.copy() for k, v in self.squares.items()})

    def _move(self, name: str, gradient: np.ndarray, at=slice(None)) -> None:
        seen, value = self.squares[name], self.values[name]
        seen[at] += gradient * gradient
        value[at] -= RATE * gradient / np.sqrt(seen[at])

    def step(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        model = self.model
        model.learning = True
        balance = np.where(labels == 1, 0.5 / max(self.toxic, 1e-6), 0.5 / max(1 - self.toxic, 1e-6))
        best, places, padded, vectors = model.pooled(np.concatenate(texts), np.array([len(x) for x in texts]))
        model.learning = False
        active = np.maximum(best, 0)
        error = (_sigmoid(active @ model.weight + model.bias[0]) - labels) * balance / len(labels)
        back = (error[:, None] * model.weight * (best > 0)).astype(np.float32)
        touched, pulls = [], []
        for k, w in enumerate(WIDTHS):
            part, place = back[:, k * FILTERS : (k + 1) * FILTERS], places[:, k * FILTERS : (k + 1) * FILTERS]
            steps = np.zeros_like(model.filters[w])
            for j in range(w):
                at = np.minimum(place + j, len(vectors) - 1)
                steps[j] = np.einsum("tf,tfs->sf", part, vectors[at])
                touched.append(padded[at].reshape(-1, padded.shape[1]))
                pulls.append((part[:, :, None] * model.filters[w][j].T[None]).reshape(-1, SIZE))
            self._move(f"f{w}", steps)
            self._move(f"b{w}", part.sum(0))
        self._move("w", (active * error[:, None]).sum(0).astype(np.float32))
        self._move("b", np.array([error.sum()], np.float32))
        touched, pulls = np.concatenate(touched), np.concatenate(pulls)
        rows, same = np.unique(touched, return_inverse=True)
        sums = np.zeros((len(rows), SIZE), np.float32)
        np.add.at(sums, same.reshape(-1), np.repeat(pulls, touched.shape[1], 0))
        real = (rows >= 0) & self.known[rows]
        self._move("e", sums[real], rows[real])

    def changes(self, before: Learner) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(piece, rows, change of values, change of squares): of the embeddings the rows that moved, by pieces; under -1 all other arrays, as one row."""
        pairs = ((self.values, before.values), (self.squares, before.squares))
        yield -1, np.zeros(1, np.int32), *[np.concatenate([(x[k] - y[k]).ravel() for k in sorted(x) if k != "e"])[None] for x, y in pairs]
        value, square = [x["e"] - y["e"] for x, y in pairs]
        rows = np.flatnonzero(square.any(1)).astype(np.int32)
        for some in np.split(rows, np.flatnonzero(np.diff(rows // PIECE)) + 1):
            if len(some):
                yield int(some[0]) // PIECE, some, value[some], square[some]

    def add(self, piece: int, rows: np.ndarray, value: np.ndarray, square: np.ndarray) -> None:
        for mine, change in ((self.values, value), (self.squares, square)):
            if piece >= 0:
                mine["e"][rows] += change
                continue
            for k in sorted(mine.keys() - {"e"}):
                mine[k] += change[0, : mine[k].size].reshape(mine[k].shape)
                change = change[:, mine[k].size :]


def _best_cut(scores: np.ndarray, labels: np.ndarray, clean: np.ndarray | None = None) -> float:
    """The middle of the gap at which the labels are parted with the highest F1. ``labels`` and ``clean`` may be numbers of texts of a score."""
    clean = 1 - labels if clean is None else clean
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum(labels[order])
    f1 = 2 * hits / (np.cumsum((labels + clean)[order]) + max(labels.sum(), 1))
    f1[:-1][s[:-1] == s[1:]] = -1  # no cut between equal scores
    k = int(np.argmax(f1))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


def _fresh(seen: np.ndarray, toxic: float) -> Learner:
    model = Model.new()
    model.embedding[seen < MIN_DOCS] = 0
    return Learner(model, seen >= MIN_DOCS, toxic)


def _fitted(texts: list[np.ndarray], labels: np.ndarray) -> Model:
    learner, draw = _fresh(np.bincount(np.concatenate([np.unique(x) for x in texts]), minlength=(1 + len(PREFIXES)) * BUCKETS), labels.mean()), np.random.default_rng(7)
    for _ in range(EPOCHS):
        order = draw.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            learner.step([texts[k] for k in order[a : a + BATCH]], labels[order[a : a + BATCH]])
    return learner.model


def _untaught() -> Model:
    model = Model.new()
    model.weight[:] = 0
    model.scale, model.shift, model.thresholds = 0.0, float(np.log(NO_LABELS / (1 - NO_LABELS))), {None: CUT}
    return model


def _drawn_cut(n: int, own: float) -> float:
    """The threshold of a language with ``n`` toxic texts, whose own best one is ``own``."""
    return (n * own + PRIOR * CUT) / (n + PRIOR)


def trained(sample: list[tuple[bytes, int, str | None]]) -> Model:
    """A model of a few texts in the driver, (text, label, language), calibrated on what models of the other parts say of each part of them.
    :func:`learned` does the same on tables of any size."""
    labels = np.array([x[1] for x in sample], np.int64)
    if min(np.bincount(labels, minlength=2)) < FOLDS:
        return _untaught()
    texts = []
    for _, part in in_chunks(range(len(sample)), (x[0].decode("utf-8", "surrogatepass") for x in sample)):
        rows, counts = hashed(part)
        texts += np.split(rows, np.cumsum(counts)[:-1])
    fold = np.zeros(len(sample), np.int64)
    for label in (0, 1):
        fold[labels == label] = np.arange((labels == label).sum()) % FOLDS
    logits = np.zeros(len(sample))
    for k in range(FOLDS):
        others, part = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        model = _fitted([texts[i] for i in others], labels[others])
        for some in np.array_split(part, len(part) // 256 + 1):
            logits[some] = model.logits(np.concatenate([texts[i] for i in some]), np.array([len(texts[i]) for i in some])) if len(some) else 0
    model = _fitted(texts, labels)
    model.shift = float(np.log(CUT / (1 - CUT)) - _best_cut(logits, labels))
    scores, languages = _sigmoid(logits + model.shift), np.array([x[2] or "" for x in sample])
    model.thresholds = {None: CUT}
    for language in sorted({x[2] or "" for x in sample}):
        mine = languages == language
        n = int(labels[mine].sum())
        if 0 < n < mine.sum():
            model.thresholds[language] = _drawn_cut(n, _best_cut(scores[mine], labels[mine]))
    return model


def sample_of(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", lang: str = "lang", size: int = SAMPLE) -> list[tuple[bytes, int, str | None]]:
    """At most ``size`` labelled texts of each label for :func:`trained`, drawn by a hash of the id; :func:`learned` takes all. Labels of one id
    that contradict each other count as 1.

    Ids are drawn from the labels, so no text is read but of those; their number is bounded, so they are named to all tasks.
    """
    known = _known(labels, doc_id, label)
    drawn = [known.filter(F.col("__label") == k).orderBy(F.xxhash64("__id"), "__id").limit(size) for k in (0, 1)]
    rows = docs.select(F.col(doc_id).alias("__of"), F.col(text).alias("__text"), F.col(lang).alias("__lang")).join(F.broadcast(drawn[0].unionByName(drawn[1])), F.col("__of") == F.col("__id"))
    # ids may be repeated: of texts of one id the smallest is taken
    few = rows.filter(F.octet_length("__text") <= 16 * MAX_WORDS).groupBy("__id").agg(F.min(F.struct("__text", "__lang", "__label")).alias("one"))
    found = few.select("__id", "one.*").orderBy(F.xxhash64("__id"), "__id").collect()
    return [(r["__text"].encode("utf-8", "surrogatepass"), r["__label"], r["__lang"]) for r in found]


def _known(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(__id, __label): labels of one id that contradict each other count as 1."""
    return labels.filter(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("__id")).agg(F.max(F.col(label).cast("int")).alias("__label"))


def _passed(rows: DataFrame, of_shard: Callable[[int, Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]], Iterator[tuple]], schema: str) -> DataFrame:
    """What ``of_shard`` gives for each shard of :func:`_shards`, from its number and its texts in runs of about a megabyte: (rows of embeddings
    of each text, labels, folds)."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple[list[np.ndarray], np.ndarray, np.ndarray]]]:
        for batch in slices(batches, "text", 1 << 20):
            shard, label, fold = (batch.column(c).to_numpy() for c in ("shard", "label", "fold"))
            for of in np.unique(shard):  # in their order
                mine = np.flatnonzero(shard == of)
                rows, counts = hashed([x.encode("utf-8", "surrogatepass") for x in batch.column("text").take(pa.array(mine)).to_pylist()])
                yield int(of), (np.split(rows, np.cumsum(counts)[:-1]), label[mine], fold[mine])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of, some in groupby(runs(batches), lambda x: x[0]):
            told = list(zip(*of_shard(of, (x[1] for x in some))))
            if told:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(told, arrow)], schema=arrow)

    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    return rows.select("shard", "text", "label", "fold").mapInArrow(work, schema)


def _shards(docs: DataFrame, known: DataFrame, size: int, doc_id: str, text: str, lang: str) -> DataFrame:
    """(shard, text, label, fold, lang): every text with a known label, a shard's texts in one partition and in an order by hash."""
    rows = docs.select(F.col(doc_id).alias("__of"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit("")).alias("lang")).join(small(known), F.col("__of") == F.col("__id"))
    shards = -(-max(known.count(), 1) // size)
    key = F.xxhash64("__id", "text")
    rows = rows.select(F.pmod(key, F.lit(shards)).cast("int").alias("shard"), F.xxhash64(key).alias("__key"), "text", F.col("__label").alias("label"), "lang")
    return rows.withColumn("fold", F.pmod(F.shiftright("__key", 8), F.lit(FOLDS)).cast("int")).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "__key", "text", "label").drop("__key")


def _seen(rows: DataFrame) -> list[np.ndarray]:
    """For each fold the numbers of texts with each row of embeddings, up to MIN_DOCS."""
    size, width = (1 + len(PREFIXES)) * BUCKETS, 1 << 14

    def of_shard(shard: int, runs: Iterator) -> Iterator[tuple]:
        count = np.zeros((FOLDS, size), np.int64)
        for texts, _, folds in runs:
            for x, fold in zip(texts, folds):
                count[fold, np.unique(x)] += 1
        count = np.minimum(count, MIN_DOCS).astype(np.uint8)
        yield from ((k, a, count[k, a : a + width].tobytes()) for k in range(FOLDS) for a in range(0, size, width))

    def summed(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        count = np.minimum(sum(np.frombuffer(x, np.uint8).astype(np.int64) for x in parts["count"]), MIN_DOCS).astype(np.uint8)
        return pd.DataFrame({"fold": [key[0]], "piece": [key[1]], "count": [count.tobytes()]})

    schema = "fold int, piece int, count binary"
    out = [np.zeros(size, np.int64) for _ in range(FOLDS)]
    for r in _passed(rows, of_shard, schema).groupBy("fold", "piece").applyInPandas(summed, schema).collect():
        out[r["fold"]][r["piece"] : r["piece"] + width] = np.frombuffer(r["count"], np.uint8)
    return out


_CHANGE = "model int, piece int, shard int, texts long, at binary, value binary, square binary"


def _averaged(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
    """The changes of all shards that touched a row, weighed by their texts."""
    rows = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in parts["at"]]))
    sums, weight = None, np.zeros(len(rows))
    for r in parts.sort_values("shard").itertuples():
        at = np.searchsorted(rows, np.frombuffer(r.at, np.int32))
        both = np.stack([np.frombuffer(x, np.float32).reshape(len(at), -1) for x in (r.value, r.square)]).astype(np.float64)
        sums = np.zeros((2, len(rows), both.shape[2])) if sums is None else sums
        sums[:, at] += both * r.texts
        weight[at] += r.texts
    value, square = (sums / weight[:, None]).astype(np.float32)
    return pd.DataFrame([(*key, -1, int(weight.max()), rows.tobytes(), value.tobytes(), square.tobytes())], columns=[c.split()[0] for c in _CHANGE.split(", ")])


def _pass(rows: DataFrame, learners: list[Learner]) -> None:
    """All texts are learned once: by learner k those of other folds than k, so that the last one learns them all."""
    shared = rows.sparkSession.sparkContext.broadcast(learners)

    def of_shard(shard: int, runs: Iterator) -> Iterator[tuple]:
        mine = [x.copy() for x in shared.value]
        pending, told = [([], []) for _ in mine], [0] * len(mine)

        def learn(k: int) -> None:
            texts, labels = pending[k]
            mine[k].step(texts, np.array(labels))
            told[k] += len(texts)
            pending[k] = ([], [])

        for texts, labels, folds in runs:
            for x, label, fold in zip(texts, labels, folds):
                for k in range(len(mine)):
                    if fold != k:
                        pending[k][0].append(x)
                        pending[k][1].append(label)
                        if len(pending[k][0]) == BATCH:
                            learn(k)
        for k, learner in enumerate(mine):
            if pending[k][0]:
                learn(k)
            for piece, at, value, square in learner.changes(shared.value[k]) if told[k] else ():
                yield k, piece, shard, told[k], at.tobytes(), value.tobytes(), square.tobytes()

    for r in _passed(rows, of_shard, _CHANGE).groupBy("model", "piece").applyInPandas(_averaged, _CHANGE).collect():
        at = np.frombuffer(r["at"], np.int32)
        learners[r["model"]].add(r["piece"], at, *[np.frombuffer(x, np.float32).reshape(len(at), -1) for x in (r["value"], r["square"])])
    shared.destroy()


def _answers(rows: DataFrame, models: list[Model]) -> DataFrame:
    """(lang, at, toxic, clean): numbers of texts by language and by the logit, in steps, that the model of the other folds gives."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            fold, logits = batch.column("fold").to_numpy(), np.zeros(batch.num_rows)
            texts = [x.encode("utf-8", "surrogatepass") for x in batch.column("text").to_pylist()]
            for k in np.unique(fold):
                mine = np.flatnonzero(fold == k)
                logits[mine] = shared.value[k].logits(*hashed([texts[i] for i in mine]))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("label"), pa.array(np.floor(np.clip(logits, -30, 30) * STEPS).astype(np.int32))], names=["lang", "label", "at"])

    found = rows.select("text", "fold", "lang", "label").mapInArrow(work, "lang string, label int, at int")
    return found.groupBy("lang", "at").agg(F.sum(F.col("label").cast("long")).alias("toxic"), F.sum((1 - F.col("label")).cast("long")).alias("clean"))


def learned(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", lang: str = "lang", size: int = SHARD) -> Model:
    """A model of every text of ``docs`` whose id has a label, calibrated on what models of the other folds say of each fold. Texts of one id
    are texts of their own. The same rows give the same model, however they lie in files."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch, step(spark):
        rows = _shards(docs, scratch.cut(_known(labels, doc_id, label)), size, doc_id, text, lang).persist(StorageLevel.DISK_ONLY)
        try:
            numbers = np.zeros((FOLDS, 2), np.int64)
            for r in rows.groupBy("fold", "label").count().collect():
                numbers[r["fold"], r["label"]] = r["count"]
            if min(numbers.sum(0)) < FOLDS:
                return _untaught()
            seen, others = _seen(rows), [*(numbers.sum(0) - numbers), numbers.sum(0)]
            learners = [_fresh(sum(x for j, x in enumerate(seen) if j != k), n[1] / max(n.sum(), 1)) for k, n in enumerate(others)]
            for _ in range(int(np.clip(-(-LEARNED // numbers.sum()), PASSES, EPOCHS))):
                _pass(rows, learners)
            model, tally = learners[-1].model, scratch.cut(_answers(rows, [x.model for x in learners[:-1]]))
        finally:
            rows.unpersist()
        middle = lambda at: (at + 0.5) / STEPS
        whole = tally.groupBy("at").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).orderBy("at").toPandas()
        shift = float(np.log(CUT / (1 - CUT)) - _best_cut(middle(whole["at"].to_numpy()), whole["toxic"].to_numpy(), whole["clean"].to_numpy()))

        def own(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("at")
            toxic, clean = part["toxic"].to_numpy(), part["clean"].to_numpy()
            cut = _drawn_cut(int(toxic.sum()), _best_cut(_sigmoid(middle(part["at"].to_numpy()) + shift), toxic, clean)) if toxic.sum() and clean.sum() else None
            return pd.DataFrame({"lang": [key[0]], "cut": [cut]})

        cuts = tally.groupBy("lang").applyInPandas(own, "lang string, cut double").filter("cut IS NOT NULL").orderBy("lang").collect()
    model.shift, model.thresholds = shift, {None: CUT} | {r["lang"]: r["cut"] for r in cuts}
    return model


def scored(docs: DataFrame, model: Model, text: str = "text", lang: str | None = "lang", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``threshold`` (that of the row's language) and ``flagged`` (the score reaches it). Columns of these
    names are replaced, all others kept. The model is a few megabytes, whatever it was trained on."""
    names = ("score", "threshold", "flagged")
    kept = [f for f in docs.schema.fields if f.name.lower() not in names and (keep_text or f.name != text)]
    read = docs.select(*[docs[f"`{f.name.replace('`', '``')}`"] for f in docs.schema.fields if f in kept or f.name == text])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        for batch in slices(batches, text):
            scores = np.zeros(batch.num_rows)
            for at, part in in_chunks(range(batch.num_rows), (x.as_py() for x in batch.column(text))):
                scores[at] = mine.scores(*hashed(part))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(scores)], names=[*[f.name for f in kept], "score"])

    rows = read.mapInArrow(work, T.StructType([*kept, T.StructField("score", T.DoubleType())]))
    threshold: Column = F.lit(model.thresholds[None])
    for language, cut in model.thresholds.items():
        if lang and language is not None:
            threshold = F.when(F.coalesce(F.col(lang), F.lit("")) == language, cut).otherwise(threshold)
    return rows.withColumn("threshold", threshold).withColumn("flagged", F.col("score") >= F.col("threshold"))
