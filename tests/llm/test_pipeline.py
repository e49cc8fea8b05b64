"""Every stage of the pipeline against SQL or brute force, on what its predecessor kept."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from oracle import connected
from test_brute import naive_terms
from test_contracts import ALNUM, LOWER, personal
from test_edges import brute_components
from textloom.llm import pii, quality, sql

pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    names, seen = docs.columns, [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, seen[-1], data)
        assert out.columns == names
        out.coalesce(1).write.parquet(f"{tmp_path}/{k}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}"))
    texts = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in seen]
    con = connected(data)
    kept = con.sql(f"SELECT doc_id FROM ({sql.OP2}) WHERE kept").fetchall()
    assert sorted(texts[1]) == sorted(x for (x,) in kept) and len(texts[1]) < len(texts[0])
    parts = brute_components(list(texts[1].items()))
    assert sorted(texts[2]) == sorted({low for _, low in parts.values()}) and len(texts[2]) < len(texts[1])
    windows = set()
    for (t,) in con.sql("SELECT text FROM benchmark").fetchall():
        w = ALNUM.findall(t.translate(LOWER))
        n = min(10, len(w))
        windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1) if n}
    sizes = {len(w) for w in windows}

    def clean(t):
        w = ALNUM.findall(t.translate(LOWER))
        return not any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    assert texts[3] == {i: t for i, t in texts[2].items() if clean(t)} and len(texts[3]) < len(texts[2])
    assert sorted(texts[4]) == sorted(texts[3])
    masks = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}
    masked = 0
    for i, t in texts[3].items():
        out, at = [], 0
        for kind, a, b in personal(t):
            if a >= at:
                out += [t[at:a], masks[kind]]
            at = max(at, b)
        masked += bool(out)
        assert texts[4][i] == "".join(out) + t[at:]
    assert masked and all(r.n_chars == len(r.text) for r in seen[4].collect())
    con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/3/*.parquet')")
    copies = {i: n for i, n in con.sql(f"SELECT doc_id, copies FROM ({sql.OP1})").fetchall() if n}
    assert Counter(r.doc_id for r in seen[5].select("doc_id").collect()) == copies


def repeated(words):
    """Words in three-word windows that stand twice or more."""
    places = defaultdict(list)
    for k in range(len(words) - 2):
        places[tuple(words[k : k + 3])].append(k)
    return len({k + i for at in places.values() if len(at) > 1 for k in at for i in range(3)})


def by_quality(docs):
    """What the quality rules leave: id to text."""
    normal = lambda x: re.sub(r"[ \t\x0b-\r]+", " ", re.sub("[0-9]", "0", x.lower())).strip(" ")
    texts = {(d["source"], d["text"]) for d in docs}
    times = Counter((host, n) for host, t in texts for n in {normal(x) for x in t.split("\n")} if n)
    hosts = Counter(host for host, _ in texts)
    gone = {x for x, n in times.items() if n >= quality.MIN_TEXTS and n >= quality.MIN_SHARE * hosts[x[0]]}
    out = {}
    for d in docs:
        words = d["text"].split()
        hit = [x for x in d["text"].split("\n") if (d["source"], normal(x)) in gone]
        left = len(words) - sum(len(x.split()) for x in hit)
        if len(words) >= 50 and 100 * repeated(words) <= 50 * len(words) and left >= quality.MIN_LEFT * len(words):
            out[d["doc_id"]] = "\n".join(x for x in d["text"].split("\n") if (d["source"], normal(x)) not in gone)
    return out


def masked(text, terms):
    base = personal(text)
    found = base + [("term", m.start(), m.end()) for m in re.finditer(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{3,}", text) if m.group().lower() in terms and not any(a < m.end() and m.start() < b for _, a, b in base)]
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda x: (x[1], pii.KINDS.index(x[0]))):
        if a >= at:
            word = text[a:b]
            out += [text[at:a], f"<{kind.upper()}>" if kind != "term" else "" if terms[word.lower()] <= pii.REMOVE_BITS else "<Name>" if word[0].isupper() else "<word>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_all_stages_on_planted_documents(spark, data, tmp_path):
    """Boilerplate lines, depleted documents, near copies, benchmark passages and terms that give an address away: each stage has its effect."""
    random.seed(11)
    words = [f"{a}{b}" for a in ("ba", "de", "fi", "go", "ku", "lo") for b in ("ran", "tel", "mos", "vin", "par")]
    say = lambda n: " ".join(random.choice(words) + random.choice("abcdefgh") for _ in range(n))
    docs = []
    add = lambda text, source: docs.append({"doc_id": len(docs), "text": text, "lang": "en", "source": source, "n_chars": len(text)})
    item = say(14)
    for k in range(40):
        add(f"Read more on page {k + 10}\n{say(70)}\nAll rights reserved by host one", "one")
    add(f"Read more on page 10\n{say(40)}\n" + "\n".join(["Read more on page 77", "All rights reserved by host one"] * 12), "one")
    for k in range(25):
        add(f"{say(60)}\nMarguerite {say(3)} mg.dupont@example.org" if k % 3 else say(90), "two")
    for k in range(6):
        add(docs[50]["text"].replace("\n", f" extra{k} ", 1), "two")
    add(f"{say(30)} {item} {say(30)}", "three")
    add(say(20), "three")
    add(" ".join([say(6)] * 15), None)
    for k in range(12):
        add(say(60 + k), None if k % 2 else "three")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "no such words anywhere")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    first = by_quality(docs)
    assert 40 not in first and all(i in first and first[i].count("\n") == 0 for i in range(40))
    low = {n for _, n in brute_components(list(first.items())).values()}
    second = {i: t for i, t in first.items() if i in low}
    third = {i: t for i, t in second.items() if item not in t}
    terms = naive_terms(list(third.values()))
    fourth = {i: masked(t, terms.get(t, {})) for i, t in third.items()}
    assert len(docs) > len(first) > len(second) > len(third) and any(len(terms.get(t, {})) for t in third.values())
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in out}.items() <= fourth.items() and all(r.n_chars == len(r.text) for r in out)
    by_id = {d["doc_id"]: d for d in docs}
    spark.createDataFrame([by_id[i] | {"text": t} for i, t in fourth.items()], schema).coalesce(1).write.parquet(f"{tmp_path}/fourth")
    con = connected(data)
    con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/fourth/*.parquet')")
    copies = {i: n for i, n in con.sql(f"SELECT doc_id, copies FROM ({sql.OP1})").fetchall() if n}
    assert Counter(r.doc_id for r in out) == copies
