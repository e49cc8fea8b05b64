"""The operators' queries against the same in SQL, or against brute force, on the small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from oracle import assert_same, connected
from textloom.llm import queries
from textloom.llm.sql import ORACLE_SQL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def con(data):
    return connected(data)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_sql(spark, data, con, name):
    assert_same(queries.QUERIES[name](spark, data), con, ORACLE_SQL[name])


@pytest.fixture(scope="module")
def texts(spark, data):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}


def test_op8(spark, data, texts):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    rows = queries.op8_signature_rules(spark, data).collect()
    assert len(rows) == len(texts) and any(r.base_labels for r in rows)
    for r in rows:
        words = ALNUM.findall(texts[r.doc_id].translate(LOWER))
        at = [(i, label) for p, label in phrases.items() for q in [p.split()] for i in range(len(words) - len(q) + 1) if words[i : i + len(q)] == q]
        starts = [i for i, _ in at]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(at), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and {x for _, x in at} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_op9(spark, data, texts):
    first = {}
    for i in sorted(texts):
        raw = texts[i].encode()
        for p in range(len(raw) - 99):
            first.setdefault(raw[p : p + 100], (i, p))
    rows = queries.op9_suffix_sort(spark, data).collect()
    assert len(rows) == len(texts) and any(r.n_removed for r in rows)
    for r in rows:
        raw = texts[r.doc_id].encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if first[raw[p : p + 100]] < (r.doc_id, p):
                gone[p : p + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())


KINDS = ("email", "ip", "card", "phone")
PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def personal(text):
    def holds(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 12 <= len(d) <= 19 and sum(n - 9 if n > 9 else n for n in (int(c) * (1 + k % 2) for k, c in enumerate(d[::-1]))) % 10 == 0
        return kind == "email" or 9 <= len(d) <= 15

    found = [(k, m.start(), m.end()) for k, p in zip(KINDS, PATTERNS) for m in re.finditer(p, text) if holds(k, m.group())]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def test_op10(spark, data, texts):
    rows = queries.op10_disclosure(spark, data).collect()
    assert len(rows) == len(texts)
    counts = defaultdict(int)
    for r in rows:
        found = personal(texts[r.doc_id])
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in found) for k in KINDS]
        assert {x for x in r.spans.split(",") if x and not x.startswith("term")} == set(filter(None, told.split(",")))
        for k, _, _ in found:
            counts[k] += 1
    assert set(counts) == set(KINDS)


def test_op5(spark, data):
    import html

    pages = {r.page_id: r for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    for r in queries.op5_site_templates(spark, data).collect():
        source = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1])
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?(?:p|h1)>", source)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url
