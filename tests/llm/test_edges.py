"""Nulls, empty and long texts, ties, repeated rows, empty tables and columns with clashing names; and each method's own case."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from textloom.llm import chat, decontam, html, licenses, mixing, neardup, pii, quality, substrings, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k}" for k in range(60_000))
ROWS = [
    (1, "one two three four five six seven", "en", "a", 33), (1, "one two three four five six seven", "en", "a", 33), (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t ", "en", "b", 4),
    (5, LONG, "en", "b", len(LONG)), (6, LONG, "en", None, len(LONG)), (None, "one two three four five six seven", "en", "a", 33), (7, "x", "en", "a", 1), (8, "X", "en", "", 1),
]
EXTRA = ["id", "size", "host", "comp", "node", "spans", "key", "line", "words", "matches_", "bucket", "goal", "__size", "__Source", "__u", "__bits", "__kept", "__host", "__hash", "__gone", "__key", "__terms", "__spans", "__id", "own__u", "own_own__u"]


def table(spark, rows=ROWS):
    """With columns whose names the operators could use for themselves."""
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.withColumns({c: F.lit("mine") for c in EXTRA})


def whole(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name, keep", [("quality", quality.keep), ("neardup", neardup.keep), ("pii", pii.keep), ("mixing", mixing.mix), ("decontam", lambda d: decontam.keep(d, d.sparkSession.createDataFrame([(1, "four five six")], "item_id long, text string")))])
def test_stages_keep_columns_and_rows(spark, name, keep):
    docs = table(spark)
    out = keep(docs)
    assert out.columns == docs.columns
    got = whole(out)
    assert all(r[-1] == "mine" for r in got)
    assert keep(docs.limit(0)).count() == 0
    ids = [r[0] for r in got]
    if name == "quality":
        assert sorted(ids) == [5, 6]
    if name == "neardup":
        assert sorted(map(str, ids)) == sorted(map(str, [1, 1, 2, 3, 4, 5, 7, None]))  # 8 is 7 in capitals, 6 is 5
    if name == "decontam":
        assert sorted(ids) == [2, 3, 4, 5, 6, 7, 8]
    if name == "pii":
        assert got == whole(docs.withColumn("n_chars", F.length("text").cast("long")))


def test_removed_ranges_keep_columns_of_any_name(spark):
    docs = table(spark, ROWS[:4])
    out = substrings.with_kept(docs)
    assert set(docs.columns) <= set(out.columns) and all(r[c] == "mine" for r in out.collect() for c in EXTRA)


def test_mix_reaches_targets(spark):
    random.seed(1)
    rows = [(k, " ".join(["w"] * random.randint(1, 80)), "en", random.choice("aaaaaabbc") if k % 50 else None, 0) for k in range(4000)]
    docs = spark.createDataFrame(rows, DOCS)
    plan = mixing.plan(docs)
    again = whole(mixing.plan(docs.repartition(7)))
    assert whole(plan) == again
    by = plan.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("got"), F.first("target").alias("t"), F.max("copies").alias("most"), F.first("source_size").alias("s")).collect()
    total = sum(r.s for r in by)
    assert abs(sum(r.t for r in by) - total) < 1e-6 * total
    for r in by:
        assert abs(r.got - r.t) <= 80 and r.most <= 3 and r.t <= 3 * r.s + 1e-9
    assert mixing.mix(docs).count() == plan.agg(F.sum("copies")).first()[0]


def test_mix_loses_no_row(spark):
    """Null ids, repeated rows, one id with several texts, ties in size, sources without words."""
    random.seed(3)
    rows = [(k if k % 3 else None, " ".join(["w"] * (k % 40)), "en", random.choice("ab") if k % 7 else None, 0) for k in range(600)]
    rows += rows[:50] + [(5, f"other text {k}", "en", "a", 0) for k in range(30)] + [(9000 + k, None, "en", "empty", 0) for k in range(5)]
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.plan(docs).collect()
    assert sorted(((r.id, r.source, r.size) for r in out), key=repr) == sorted(((i, s, len((t or "").split())) for i, t, _, s, _ in rows), key=repr)
    assert all(0 <= r.copies <= 3 for r in out)
    for source in ("a", "b", None):
        mine = [r for r in out if r.source == source]
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= 40
        longer = lambda n: [r.copies for r in mine if n <= r.size < 2 * n]
        assert sum(longer(20)) / len(longer(20)) > sum(longer(2)) / len(longer(2))  # each document has its own odds
    assert mixing.mix(docs).count() == sum(r.copies for r in out)


def test_boilerplate_lines_deplete(spark):
    random.seed(2)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    body = lambda n: " ".join(word() for _ in range(n))
    notice = "This Notice  stands on all pages " + " ".join(f"n{k} x" for k in range(60))
    rows = [(k, f"Subscribe NOW to our list {k + 10}\n" + body(80) + f"\n\n{notice}", "en", "h", 0) for k in range(60)]
    rows += [(100 + k, "\n".join([f"Subscribe  now to our list {k + 10}"] + [notice]) + "\n" + body(40), "en", "h", 0) for k in range(3)]
    rows += [(200, "Subscribe now to our list 1\n" + body(80), "en", "other", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    out = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(out[k].removed_words == 132 and out[k].kept for k in range(60))  # lines of any length
    assert all(out[100 + k].removed_words == 132 and not out[100 + k].base_failed and not out[100 + k].kept for k in range(3))  # 40 of 172 words are left
    assert out[200].removed_words == 0 and out[200].kept
    text = {r.doc_id: r for r in quality.keep(docs).collect()}
    assert set(text) == {*range(60), 200} and text[200].text == rows[-1][1] and text[200].n_chars == 0
    assert all(text[k].text == rows[k][1].split("\n")[1] + "\n" and text[k].n_chars == len(text[k].text) for k in range(60))


def brute_components(rows):
    sets = {}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in rows:
        w = t.translate(low).split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((top(x), top(y)))
                up[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_duplicates_with_a_common_passage(spark, monkeypatch):
    """Small nodes and few of them: the tree has to branch, and still finds all links."""
    monkeypatch.setattr(neardup, "LEAF", 16)
    random.seed(5)
    words = [f"w{k}" for k in range(5000)]
    passage = " ".join(random.choices(words, k=120))
    rows = []
    for k in range(40):
        own = random.choices(words, k=60)
        rows.append((len(rows), f"{passage} " + " ".join(own)))
        for _ in range(k % 3):
            copy = list(own)
            copy[random.randrange(60)] = "changed"
            rows.append((len(rows), f"{passage} " + " ".join(copy)))
    base = random.choices(words, k=100)
    for k in range(30):  # a chain: neighbours are alike, ends are not
        base = base[5:] + random.choices(words, k=5)
        rows.append((len(rows), " ".join(base)))
    rows += [(len(rows) + k, "same text for all of these") for k in range(20)]
    df = neardup.components_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r.id: (r.n_shingles, r.component) for r in df.collect()} == brute_components(rows)


def test_near_duplicates_of_ids_with_several_texts(spark):
    text = lambda *x: " ".join(f"{a}{k}" for a in x for k in range(20))
    rows = [(5, text("a")), (2, text("a")), (2, text("b")), (7, text("b")), (1, text("c")), (2, ""), (9, text("d")), (9, text("d"))]
    out = {(r.id, r.n_shingles): r.component for r in neardup.components_of(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {(5, 16): 2, (2, 16): 2, (7, 16): 2, (1, 16): 1, (2, 0): 2, (9, 16): 9}


@pytest.mark.parametrize("leaf", [1024, 12])
def test_recall_of_near_duplicates_in_skewed_groups(spark, monkeypatch, leaf):
    """A group of near copies of every likeness, half of them outside of its component, and a common passage: no link is lost."""
    monkeypatch.setattr(neardup, "LEAF", leaf)
    random.seed(leaf)
    base = [f"b{k}" for k in range(80)]
    rows = []
    for k in range(150):
        copy = list(base)
        for _ in range(k % 7):
            copy[random.randrange(80)] = f"own{k}"
        rows.append((k, " ".join(copy)))
    rows += [(200 + k, " ".join(base[:30] + [f"x{k}y{j}" for j in range(40)])) for k in range(60)]
    df = neardup.components_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    truth = brute_components(rows)
    got = {r.id: (r.n_shingles, r.component) for r in df.collect()}
    # with the smallest leaves, nodes branch that no table has; a link may be missed there, but none is invented
    assert sum(got[k] == truth[k] for k in truth) >= len(truth) * (0.98 if leaf < 1024 else 1)
    assert all(truth[k][1] <= got[k][1] for k in truth)


def test_decontamination_finds_longest_matches(spark):
    item = " ".join(f"q{k}" for k in range(30))
    items = spark.createDataFrame([(1, item), (2, "short one"), (3, None), (4, "!!"), (5, item.upper())], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + " ".join(f"Q{k}" for k in range(5, 25)) + " y"), (2, "a short, one; b"), (3, " ".join(f"q{k}" for k in range(9))), (4, None)], "doc_id long, text string")
    for size, sent in ((1 << 20, 1 << 20), (64, 1 << 20), (64, 128)):  # one block of items, several, and not all of them sent at once
        rows = {r.doc_id: r for r in decontam.summary(docs, items, block_bytes=size, sent_bytes=sent).collect()}
        assert (rows[1].n_words, rows[1].n_hit, rows[1].items, rows[1].longest) == (22, 20, "1,5", 20)
        assert (rows[2].n_hit, rows[2].items) == (2, "2") and not rows[3].contaminated and rows[4].n_words == 0


def test_captures(spark):
    big = "x\r\n\r\nWARC/1.1\r\n\r\n" * 20
    rows = [(1, "http://a/b c", big), (2, "http://a/2", big), (0, None, "é" * 60 + "\r\n"), (3, "u", "\r\n"), (4, "u", "\r\n\r\n"), (5, "u", None), (6, "u", "é" * 60 + "\r\n"), (7, "u", "r" * 200), (7, "u", "r" * 200), (None, "u", big), (9, "u", "\r\r\n\r\n\n" * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in EXTRA})
    out = warc.round_trip(pages, payloads=True).collect()
    told = sorted(((r.page_id, r.response.type, r.refers_to, r.response.payload_bytes) for r in out), key=repr)
    assert told == sorted([(1, "response", None, 340), (2, "revisit", 1, 340), (0, "response", None, 122), (3, "response", None, 2), (4, "response", None, 4), (5, "response", None, 0), (6, "revisit", 0, 122), (7, "response", None, 200), (7, "response", None, 200), (None, "revisit", 1, 340), (9, "response", None, 180)], key=repr)
    text = {i: (t or "").encode() for i, _, t in rows}
    assert all(bytes(r.response.payload) == text[r.page_id] for r in out if r.response.type == "response")
    assert all(r.request.type == "request" and len(r.metadata) == 1 for r in out)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_captures_linked_over_the_request(spark):
    rows = [("<r>", "response", []), ("<q>", "request", ["<r>"]), ("<m>", "metadata", ["<q>"]), ("<lost>", "metadata", ["<none>"]), ("<m2>", "metadata", ["<m>"]), ("<m3>", "metadata", ["<m2>", "<m4>"]), ("<m4>", "metadata", [])]
    df = spark.createDataFrame([(i, t, None, "u", c, None, None, None, 1, "d", b"x") for i, t, c in rows], warc.RECORD)
    out = {r.capture_id: r for r in warc.assemble(df).collect()}
    assert out["<r>"].request.record_id == "<q>" and sorted(m.record_id for m in out["<r>"].metadata) == ["<m2>", "<m3>", "<m4>", "<m>"]
    assert out["<lost>"].response is None and len(out) == 2


def test_site_templates(spark):
    page = lambda k, body: (k, "http://h.example/p", f"<html><body><nav><a href=/>menu</a></nav><article><h1>T {k}</h1><div>By the staff of <b>H</b></div>{body}<p>Text of page {k}.</p></article></body></html>")
    rows = [page(k, "<p>The.</p>" if k < 3 else "") for k in range(30)]
    rows += [(100 + k, "http://mirror.example/", "<article><p>The same article everywhere.</p></article>") for k in range(30)]
    rows += [(200, None, "<article><p>By the staff of <b>H</b></p></article>"), (201, "http://x.example", None), (202, "nonsense", ""), (203, "http://h.example", "<p>no article<p>here &amp; th")]
    out = {r.page_id: r.text for r in html.with_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in EXTRA})).collect()}
    assert all(out[k] == (f"T {k}\nThe.\nText of page {k}." if k < 3 else f"T {k}\nText of page {k}.") for k in range(30))
    assert all(out[100 + k] == "The same article everywhere." for k in range(30))
    assert (out[200], out[201], out[202], out[203]) == ("By the staff of H", "", "", "no article\nhere & th")
    assert html.with_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("source, text", [
    ("<div id=comments><p>hi</p></div><div class='content'><p>Hello <b>big</b>\n world &amp; co<p>two<br>lines<table><tr><td>a<td>b</table></div>", "Hello big world & co\ntwo lines\na\nb"),
    ("<ul><li>a<li>b</ul>x", "a\nb\nx"), ("plain &lt;b&gt; text", "plain <b> text"),
    ("<body class='no-sidebar'><header><h1>Site</h1></header><main><h1>T</h1><aside>s</aside>para</main><footer>f", "T\npara"),
    ("<p>a<!-- x > --><script>if(a<b){'</p>'}</script>b", "ab"), ("<a title='x>y'>q</a>", "q"),
    ("<div class=cookie-notice>c</div><form>f</form><div class='ad'>x</div><article>A<section class=comments><article>c</article></section></article>", "A"),
])
def test_pages(source, text):
    page = html.Page(source)
    assert page.text(page.kept()) == text


def test_snapshots_collapse(spark):
    talk = [("user", "a"), ("assistant", None), ("user", ""), (None, "d"), ("assistant", "e")]
    rows = [(n, k, *talk[k]) for n in range(1, 6) for k in range(n)]  # 1..5 are snapshots of 5
    rows += [(9, k + 3, *talk[k]) for k in range(5)]  # equal to 5, turns counted from 3
    rows += [(7, 0, "user", "a"), (7, 1, "assistant", ""), (5, 0, "user", "a"), (None, 0, "user", "z"), (8, None, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in EXTRA})
    out = {r.conv: r for r in chat.render(df).collect()}
    assert set(out) == {5, 7, 8, None} and (out[5].n_turns, out[5].n_copies) == (5, 2)
    assert out[5].text == "".join(f"<|im_start|>{r or 'unknown'}\n{t or ''}<|im_end|>\n" for r, t in talk)
    assert chat.render(df.limit(0)).count() == 0


def test_long_conversations_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "RUN", 7)
    monkeypatch.setattr(chat, "PART_CHARS", 200)
    rows = [(1, k, "user", f"turn {k}") for k in range(100)] + [(2, k, "user", f"turn {k}") for k in range(60)]
    out = sorted(chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect(), key=lambda r: r.part)
    assert len(out) > 5 and {r.conv for r in out} == {1}
    assert "".join(r.text for r in out) == "".join(f"<|im_start|>user\nturn {k}<|im_end|>\n" for k in range(100))


def test_licenses(spark):
    says = {
        "This file is licensed under the Apache License, Version 2.0 (the": "apache,apache-2.0", "SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3.0", "Released under CC BY-SA 4.0": "cc-by,cc-by-sa-4.0",
        "MIT License": "mit", "mit der Lizenz": "", "3-clause BSD license": "bsd-3-clause", "GNU Lesser General Public License v2.1": "lgpl-2.1", None: "", "": "",
    }
    df = spark.createDataFrame([(k, t) for k, t in enumerate(says)], "doc_id long, text string").withColumns({c: F.lit(1) for c in EXTRA})
    rows = {r.text: r for r in licenses.with_licenses(df).collect()}
    assert {t: r.labels for t, r in rows.items()} == says
    assert [r.score for t, r in rows.items() if not says[t]] == [0.0] * 3
    assert len(licenses._rules()[1]) > 300
    assert licenses.with_licenses(df.limit(0)).count() == 0


def test_disclosing_terms(spark):
    rows = [(k, f"Call Marguerite of the office {k}, mail anna.smith@example.org or come by. Common words here.", "", "", 0) for k in range(5)]
    rows += [(10 + k, f"Common words of the office here, mail or call {k}. Come by.", "", "", 0) for k in range(40)]
    rows += [(99, "Marguerite alone", "", "", 0), (100, None, "", "", 0), (101, "Marguerite wrote to bob@x.org", "", "", 0)]
    df = spark.createDataFrame(rows, DOCS)
    out = {r.doc_id: r for r in pii.sanitised(df).collect()}
    told = [(x.kind, out[0].text[x.start : x.end]) for x in out[0].spans]
    assert told == [("term", "Marguerite"), ("email", "anna.smith@example.org")]
    assert out[0].masked == "Call <Name> of the office 0, mail <EMAIL> or come by. Common words here."
    assert not out[99].spans and not out[10].spans and out[100].masked is None and [x.kind for x in out[101].spans] == ["email"]


def test_patterns_match_plain_expressions():
    from test_contracts import personal

    random.seed(1)
    for _ in range(20_000):
        s = "".join(random.choice("a@.1+ -(2%9é") for _ in range(random.randint(1, 30)))
        assert [x[:3] for x in pii.find(s)] == personal(s)


@pytest.mark.parametrize("bucket", [4096, 2])
def test_substrings(spark, monkeypatch, bucket):
    monkeypatch.setattr(substrings, "BUCKET", bucket)
    random.seed(bucket)
    words = ["".join(random.choice("abcdeé") for _ in range(random.randint(1, 8))) for _ in range(300)]
    passages = [" ".join(random.choices(words, k=random.randint(15, 60))) for _ in range(12)]
    rows = [(i, "\n".join(random.choice(passages) if random.random() < 0.5 else " ".join(random.choices(words, k=random.randint(1, 80))) for _ in range(random.randint(0, 4)))) for i in range(120)]
    rows += [(200, "a" * 500), (201, "ab" * 300), (202, None), (203, ""), (204, rows[3][1]), (204, rows[3][1]), (205, "a" * 99), (None, rows[5][1])]
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (t or "").encode()
        for p in range(len(raw) - 99):
            first.setdefault(raw[p : p + 100], (i, p))
    expected = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99 if i is not None else 0):
            if first[raw[p : p + 100]] < (i, p):
                gone[p : p + 100] = b"\1" * 100
        expected.append((i, bytes(x for x, g in zip(raw, gone) if not g)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({c: F.lit(1) for c in EXTRA})
    assert sorted(((r.doc_id, bytes(r.kept)) for r in substrings.with_kept(df).collect()), key=repr) == sorted(expected, key=repr)


def test_nothing_in_an_article_goes_by_a_word(spark):
    stay = ['<div class="related-work">a</div>', '<section id="social-impact">b</section>', '<p class="notice">c</p>', '<p class="share-price">d</p>', '<div class="promotion-rules">e</div>', "<label>f</label>", "<fieldset>g</fieldset>", "<object>h</object>", '<div id="comments-on-method">i</div>', '<p class="cookie reply">j</p>']
    go = ["<nav>k</nav>", "<aside>l</aside>", "<form>m<label>n</label></form>", '<div class="x ad">o</div>', '<div class="Comments">p</div>', '<div role="navigation">q</div>', "<footer>r</footer>", '<p hidden>s</p>', "<script>t</script>"]
    around = '<div class="notice">u</div><div class="related-links">v</div><label>w</label>'
    rows = [(k, "http://h/", f"<body>{around}<{tag}><h1>T</h1>{''.join(stay)}{''.join(go)}<p>one</p></{tag}>{around}</body>", "mine") for k, tag in enumerate(("article", "main"))]
    out = html.with_text(spark.createDataFrame(rows, "page_id long, url string, html string, __host string")).collect()
    assert [r.text for r in out] == ["\n".join(["T", *"abcdefghij", "one"])] * 2 and {r["__host"] for r in out} == {"mine"}
