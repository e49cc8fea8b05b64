"""Periodic runs, spelling variants and the toxicity classifier against plain versions, and their edges."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_edges import EXTRA, table, whole
from textloom.llm import periodic, queries, spelling, toxicity
from textloom.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(s, min_length=6, min_exponent=4):
    """Every period tried at every place."""
    found, n = [], len(s)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(min_length, min_exponent * q):
                part = s[i : i + length]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda x: (x[0], x[2]))


def test_runs_against_all_periods():
    random.seed(11)
    for _ in range(3000):
        kinds = random.randint(1, 3)
        s = [random.randint(0, kinds) for _ in range(random.randint(0, 40))]
        root = [random.randint(0, kinds) for _ in range(random.randint(1, 6))]
        s[10:10] = (root * 9)[: random.randint(0, 9 * len(root))] if random.random() < 0.6 else []
        for exponent, length in ((4, 6), (2, 2), (3, 5)):
            assert periodic.runs(np.array(s, np.int64), length, exponent) == plain_runs(s, length, exponent)
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(3, np.int64), min_exponent=1)


def test_lyndon_arrays_against_all_suffixes():
    random.seed(12)
    for _ in range(800):
        s = [random.randint(0, 2) for _ in range(random.randint(1, 30))]
        for rising in (True, False):
            signed = [x if rising else -x for x in s]
            smaller, agree = periodic.lyndon_array(s, rising)
            assert list(smaller) == [next((j for j in range(i + 1, len(s)) if signed[j:] < signed[i:]), -1) for i in range(len(s))]
            for i, j in enumerate(smaller):
                assert j < 0 or agree[i] == next((k for k in range(len(s)) if j + k == len(s) or s[i + k] != s[j + k]), 0)


def test_runs_take_linear_time():
    nested = [0]
    for level in range(1, 8):
        nested = nested * 4 + [level]
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 100_000:
        fibonacci, before = fibonacci + before, fibonacci
    for s in ([0] * 100_000, [0, 1] * 50_000, nested, fibonacci, list(range(100_000)), [0] * 50_000 + [1] + [0] * 50_000):
        began = time.time()
        periodic.runs(np.array(s))
        assert time.time() - began < 10


def planted(doc_id, text):
    """The contract's words of a document."""
    words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_op11(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = queries.op11_periodic_runs(spark, data).collect()
    assert len(rows) == len(texts) and sum(r.n_runs for r in rows) > 3
    for r in rows:
        words = planted(r.doc_id, texts[r.doc_id])
        found = plain_runs(words)
        out = {k for start, length, q in found for k in range(start + q, start + length)}
        top = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *(top or (None,) * 3))
        assert r.exponent_milli == (1000 * top[1] // top[2] if top else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in out).encode()).hexdigest()


def test_runs_of_edge_rows(spark):
    docs = table(spark).withColumn("Runs", F.lit("mine"))
    out = periodic.with_runs(docs)
    assert out.columns == [c for c in docs.columns if c != "Runs"] + ["n_words", "runs", "collapsed"]
    assert all(r.n_words == len(WORD.findall(r.text or "")) and r.runs == [] and r.collapsed == " ".join((r.text or "").split()) and r.id == "mine" for r in out.collect())
    assert periodic.with_runs(docs.limit(0)).count() == 0
    rows = [(1, "a b " * 200_000 + "c"), (2, "x y x y\tx y\nx y x y x y"), (2, "x y " * 6), (3, "ab ab ab")]
    out = periodic.with_runs(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[tuple(x) for x in r.runs] for r in out] == [[(0, 400_000, 2)], [(0, 6, 1)], [(0, 6, 1)], []]
    assert [r.collapsed for r in out] == ["a b c", "x y", "x y", "ab ab ab"]


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    near = defaultdict(list)
    for a in counts:
        for b in counts:
            if one_edit(a, b):
                near[a].append(b)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return rows


@pytest.mark.parametrize("leaf", [64, 3])
def test_variants_against_all_pairs(spark, leaf):
    """Also with groups that have to be cut down to one code point: words that share all but a few letters."""
    random.seed(leaf)
    words = {"".join(random.choice("abà") for _ in range(random.randint(6, 9))) for _ in range(150)}
    words |= {f"common{a}{b}" for a in "abcde" for b in "abcdeß"} | {f"{a}{b}common" for a in "abcd" for b in "xyz"} | {"𝒳longword", "longword", "longwords", "ongword" * 900, "ongword" * 900 + "s"}
    counts = {w: random.choice([5, 6, 30, 200, 1200, 9000]) for w in words}
    out = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4), leaf=leaf)
    assert {tuple(r) for r in out.collect()} == plain_variants(counts)
    with Scratch(spark) as scratch:
        assert spelling.near_pairs(spark.createDataFrame([], "word string, n long"), scratch).count() == 0


def test_counted_words_of_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    docs = table(spark)
    assert spelling.counted(docs, min_count=1).count() == 0 and spelling.counted(docs.limit(0)).count() == 0
    rows = [(1, "Straße STRASSE straße×ÀÉ a1bcdefg"), (1, None), (2, ""), (None, "Straße"), (3, "word-with-hyphens longest" * 100_000)]
    told = {r.word: r.n for r in spelling.counted(spark.createDataFrame(rows, "doc_id long, text string"), min_count=1).collect()}
    assert told == {"straße": 2, "strasse": 1, "straße×ÀÉ": 1, "bcdefg": 1, "hyphens": 100_000, "longestword": 99_999, "longest": 1}


def test_toxicity_on_held_out_texts(spark, tmp_path):
    """Insults in two languages, stems with other endings among the held-out texts than most learned ones, in texts of any length."""
    random.seed(13)
    word = lambda: "".join(random.choice("etaoinshr") for _ in range(random.randint(2, 7)))
    bad = {"en": [lambda: "blockhead", lambda: "rubbish"], "de": [lambda: "quatsch" + word(), lambda: "dumm" + word()]}
    rows, labels, truth = [], [], {}
    for k in range(1500):
        lang, toxic = random.choice(["en", "de"]), int(random.random() < 0.15)
        body = [word() for _ in range(random.choice([5, 40, 200, 1000]))]
        for _ in range(random.randint(1, 3) if toxic else 0):
            body.insert(random.randrange(len(body) + 1), random.choice(bad[lang])())
        rows.append((k, " ".join(body), lang))
        truth[k] = toxic
        if k % 5:
            labels.append((k, toxic if random.random() > 0.01 else 1 - toxic))  # one label in a hundred is wrong
    for name, value, schema in (("documents", rows + [(5000, None, None), (5001, "", "en"), (None, "blockhead", "en"), (0, rows[0][1], "en")], "doc_id long, text string, lang string"), ("labels", labels + [(None, 1), (1, None)], "doc_id long, toxic int")):
        spark.createDataFrame(value, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    out = queries.op13_toxicity(spark, str(tmp_path))
    told = out.collect()
    assert len(told) == 1504 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in told)
    held = [r for r in told if r.held_out and r.doc_id in truth]
    hit = Counter((r.predicted, truth[r.doc_id]) for r in held)
    assert hit[1, 1] / (hit[1, 1] + hit[0, 1]) > 0.85 and hit[1, 1] / (hit[1, 1] + hit[1, 0]) > 0.85
    assert {(r.doc_id, r.score) for r in told} == {(r.doc_id, r.score) for r in queries.op13_toxicity(spark, str(tmp_path)).collect()}  # reruns agree


def test_labels_of_held_out_texts_are_not_learned(spark, data, tmp_path):
    for name in ("documents", "labels"):
        rows = spark.read.parquet(f"{data}/{name}.parquet")
        if name == "labels":  # turned round where they must not count
            held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
            rows = rows.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
        else:
            rows = rows.withColumns({"lang": F.lit("xx"), "source": F.lit("y")})
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    scores = lambda folder: {r.doc_id: r.score for r in queries.op13_toxicity(spark, folder).collect()}
    assert scores(data) == scores(str(tmp_path))


def test_toxicity_of_edge_rows(spark):
    docs = table(spark)
    none = toxicity.trained([])
    out = toxicity.scored(docs, none)
    assert out.columns == [*docs.columns, "score", "threshold", "flagged"] and {round(r.score, 9) for r in out.collect()} == {toxicity.NO_LABELS}
    assert whole(out.select(docs.columns)) == whole(docs) and all(r[c] == "mine" for r in out.collect() for c in EXTRA)
    assert toxicity.scored(docs.limit(0), none).count() == 0
    assert toxicity.trained([(b"x", 1, None)] * 9).scale == 0  # one label alone teaches nothing
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (5, 0), (7, 0), (7, 1), (None, 1), (8, None)], "doc_id long, toxic int")
    assert sorted(toxicity.sample_of(docs, labels)) == [(b"", 0, "en"), (b"one two three four five six seven", 1, "en"), (b"x", 1, "en")]


def test_every_labelled_text_is_learned_whole(spark):
    """Only texts of over 48,000 bytes, which were left out of the sample once, are toxic; in several shards, wherever rows lie."""
    random.seed(31)
    text = lambda n: [random.choice("etaoin") + random.choice("shrdlu") * random.randint(1, 4) for _ in range(n)]
    rows = []
    for k in range(360):
        words = text(16_000 if k % 3 == 0 else 30)
        if k % 6 == 0:
            words[random.randrange(len(words))] = "blockhead"
        rows.append((k, " ".join(words), "en", int(k % 6 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").repartition(3).cache()
    labels = docs.filter("doc_id < 300").select("doc_id", "toxic")
    shards = toxicity._shards(docs, toxicity._known(labels, "doc_id", "toxic"), 60, "doc_id", "text", "lang")
    assert shards.count() == 300 and shards.select("shard").distinct().count() == 5
    assert all(n.sum() > 0 for n in toxicity._seen(shards))
    model = toxicity.learned(docs, labels, size=60)
    held = [(r.score >= toxicity.CUT, r.toxic) for r in toxicity.scored(docs.filter("doc_id >= 300"), model).collect()]
    assert sum(p and t for p, t in held) >= 9 and sum(p and not t for p, t in held) <= 1
    again = toxicity.learned(docs.orderBy(F.desc("doc_id")).repartition(7), labels.repartition(2), size=60)
    assert again.shift == model.shift and again.thresholds == model.thresholds and (again.embedding == model.embedding).all()
