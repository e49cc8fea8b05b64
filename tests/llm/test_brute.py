"""Operators that SQL cannot express, against plain versions of their methods; and very long, repetitive and deeply nested texts."""

from __future__ import annotations

import html.parser
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
from test_contracts import personal

from textloom.llm import decontam, html as pages, licenses, neardup, pii, substrings

DOCS = "doc_id long, text string"


class Tree(html.parser.HTMLParser):
    """Of well-formed markup: elements as [tag, classes, children], text as strings."""

    def __init__(self, source):
        super().__init__()
        self.open = [["#", "", []]]
        self.feed(source)

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs).get("class", ""), []]
        self.open[-1][2].append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        self.open[-1][2].append(data)


def spelt(node):
    """A subtree as a string: tag, own text and what is below; None if it has no text."""
    inside = [x if isinstance(x, str) else spelt(x) for x in node[2]]
    inside = [" ".join(x.split()) if isinstance(y, str) else x for x, y in zip(inside, node[2]) if x and x.strip()]
    return f"<{node[0]}>" + "\0".join(inside) + "<>" if inside else None


def walk(node):
    yield node
    for x in node[2]:
        if not isinstance(x, str):
            yield from walk(x)


BLOCKS = {"div", "p", "ul", "li", "h1", "section", "nav", "footer"}


def main_text(node, template, keep=False):
    """Blocks of the article without menus and what is in the template."""
    out = [""]

    def go(x, inside):
        for y in x[2]:
            if isinstance(y, str):
                out[-1] += y if inside else ""
            elif y[0] in ("nav", "footer") or y[0] in BLOCKS and spelt(y) in template:
                out.append("")
            elif y[0] in BLOCKS or y[0] in ("article", "body", "html"):
                out.append("")
                go(y, inside or y[0] == "article")
                out.append("")
            else:
                go(y, inside)

    go(node, keep)
    return "\n".join(t for x in out if (t := " ".join(x.split())))


def test_site_templates_by_brute_force(spark):
    random.seed(4)
    words = [f"w{k}" for k in range(400)]
    say = lambda n: " ".join(random.choices(words, k=n))
    rows = []
    for k in range(240):
        host, section = ("a.example", random.choice(["news", "blog", "help"])) if k % 3 else ("b.example", "x")
        body = [f"<h1>{say(3)}</h1>", *[f"<p>{say(8)} <b>{random.choice(['Note', 'See'])}</b> {say(2)}</p>" for _ in range(random.randint(1, 4))]]
        body.insert(1, f"<div>By the {host} staff <a href=x>more</a></div>")  # on all pages of a host
        if section == "blog":
            body.append("<section><p>All posts of this blog</p><p>Write to us</p></section>")  # of a section only
        if random.random() < 0.5:
            body.append(f"<div>Rated <b>{random.choice('12')}</b></div>")  # in a quarter of the pages each
        if random.random() < 0.1:
            body.append("<p>Yes, indeed.</p>")  # many pages, but too few of all
        rows.append((k, f"https://{host}/{section}/{k}", f"<html><body><nav><ul><li>Home</li><li>{say(1)}</li></ul></nav><article>{''.join(body)}</article><footer><p>{host}</p></footer></body></html>"))
    rows += [(900 + k, f"https://a.example/news/m{k}", rows[0][2]) for k in range(40)]  # a mirrored page counts once
    articles, seen = {}, defaultdict(set)
    for i, url, source in rows:
        tree = Tree(source).open[0]
        articles[i] = tree
        host, section = url.split("/")[2:4]
        for node in walk(tree):
            if node[0] in BLOCKS and (s := spelt(node)):
                for key in ((host,), (host, section)):
                    seen[key, s].add(main_text(tree, ()))
    groups = defaultdict(set)
    for i, url, _ in rows:
        host, section = url.split("/")[2:4]
        for key in ((host,), (host, section)):
            groups[key].add(main_text(articles[i], ()))
    template = defaultdict(set)
    for (key, s), where in seen.items():
        if len(where) >= pages.MIN_PAGES and len(where) >= pages.MIN_SHARE * len(groups[key]):
            template[key].add(s)
    expected = {i: main_text(articles[i], template[url.split("/")[2],] | template[url.split("/")[2], url.split("/")[3]]) for i, url, _ in rows}
    got = {r.page_id: r.text for r in pages.with_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    assert got == expected
    assert any("Yes, indeed" in t for t in got.values()) and not any("staff" in t or "Write to us" in t for i, t in got.items() if i < 900)


def test_license_rules_by_brute_force():
    """All rules without the keyword filter, and every pair of detections held against each other."""
    random.seed(6)
    parts = ["licensed under the", "MIT License", "Apache License, Version 2.0", "GNU General Public License v3 or later", "SPDX-License-Identifier: BSD-3-Clause", "CC BY-SA 4.0", "zlib license", "mozilla public license 2.0", "the terms of the", "ISC License", "see", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "unlicense", "x", "and", "copy of the"]
    rules = licenses._rules()[1]
    found = 0
    for _ in range(150):
        text = " ".join(random.choices(parts, k=random.randint(1, 14)))
        words = re.sub(rb"[^a-z0-9]+", b" ", text.lower().encode()).strip()
        every = [(-p, m.start() - m.end(), m.start(), k, label) for k, (p, label, pattern) in enumerate(rules) for m in pattern.finditer(words)]
        every.sort()
        left = [x for n, x in enumerate(every) if not any(y[2] <= x[2] and x[2] - x[1] <= y[2] - y[1] for y in every[:n])]
        number = lambda at: words[:at].count(b" ")
        assert licenses.scan(text)["detections"] == [(label, -p, number(at), number(at - size)) for p, size, at, _, label in left]
        found += len(left)
    assert found > 300


def naive_terms(texts):
    """For each text its disclosing terms, by counting all pairs in all documents."""
    found = {t: pii.find(t) for t in set(texts)}
    things = {t: pii.entities(x) for t, x in found.items() if x}
    terms = {t: pii.terms_beside(t, found[t]) for t in things}
    times = Counter(texts)
    stands = Counter()
    for t in texts:
        stands.update({w.lower() for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{3,}", t)})
    in_texts, together = Counter(), Counter()
    for t, some in things.items():
        for e in some:
            for w in terms[t]:
                in_texts[e, w] += 1
                together[e, w] += times[t]
    bits = {p: -math.log2(min(1, together[p] / stands[p[1]])) for p in in_texts if in_texts[p] >= pii.MIN_TEXTS}
    out = {}
    for t, some in things.items():
        hit = {w: min(bits[e, w] for e in some if bits.get((e, w), 9) <= pii.GENERALISE_BITS) for w in terms[t] if any(bits.get((e, w), 9) <= pii.GENERALISE_BITS for e in some)}
        out[t] = hit
    return out


def test_disclosure_by_brute_force(spark):
    random.seed(8)
    words = ["alpha", "beta", "gamma", "delta", "Straße", "office", "mail", "call"]
    people = {"Marguerite": ("marguerite.dupont@example.org", "+1 555 123 4567"), "Olaf": ("olaf@mail.example.net", "10.20.30.40"), "Indira": ("indira.rao@example.com", "4111 1111 1111 1111")}
    texts = []
    for k in range(160):
        name = random.choice([*people, None, None])
        body = random.choices(words, k=random.randint(3, 12))
        if name:
            body += [name, random.choice([*[people[name][0]] * 5, people[name][1], "nobody@else.example"])]
        if random.random() < 0.1:
            body.append(random.choice(list(people)))
        random.shuffle(body)
        texts.append(" ".join(body))
    texts += texts[:20] + ["", "no data at all"]
    out = pii.sanitised(spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(4)).collect()
    expected, n = naive_terms(texts), 0
    for r in out:
        terms = expected.get(r.text, {})
        base = personal(r.text)
        spans = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{3,}", r.text) if m.group().lower() in terms and not any(a < m.end() and m.start() < b for _, a, b in base)]
        assert sorted((x.kind, x.start, x.end) for x in r.spans) == sorted([*base, *[("term", a, b) for a, b in spans]])
        n += len(spans)
    assert n > 30  # the method finds terms that no pattern does
    assert not any(name in r.masked for r in out for name in ("Marguerite", "Olaf") if any(x.kind != "term" for x in r.spans) and name.lower() in expected.get(r.text, {}))


def test_terms_are_told_from_common_words(spark):
    """A list of contacts among many words makes pairs with what few texts have; sigmas and apostrophes are one term in counts and pairs."""
    random.seed(3)
    common = [f"common{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]
    texts = [" ".join(random.choices(common, k=200)) for _ in range(60)]
    texts += [f"{' '.join(random.choices(common, k=200))} Ὀδυσσεύς'x Okonkwo writes to n.okonkwo@example.org {k}" for k in range(5)]
    texts += [" ".join(f"u{a}{b}@list.example {common[(ord(a) * 7 + b) % 300]}" for a in "abcdefghij" for b in range(20)) + f" note {k}" for k in range(4)]
    out = {r.text: [r.text[x.start : x.end] for x in r.spans if x.kind == "term"] for r in pii.sanitised(spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)).collect()}
    expected = naive_terms(texts)
    for text, words in out.items():
        assert {w.lower() for w in words} == set(expected.get(text, {}))
    assert all({"Ὀδυσσεύς", "Okonkwo", "writes"} <= set(out[t]) for t in texts[60:65])


#: Sentences of licenses as these have them, and what they are.
SENTENCES = [
    ("You must cause the modified files to carry prominent notices stating that you changed the files and the date of any change.", "gpl-2.0"),
    ("you have permission to link or combine any covered work with a work licensed under version 3 of the GNU Affero General Public License into a single combined work", "gpl-3.0"),
    ("your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports it)", "agpl-3.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "mpl-2.0"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "epl-2.0"),
    ("The Software shall be used for Good, not Evil.", "json"),
    ("Except as contained in this notice, the name of a copyright holder shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software", "curl"),
    ("Permission to use, copy, modify, and distribute this software and its documentation for any purpose and without fee is hereby granted, provided that the above copyright notice appear in all copies", "hpnd"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\"", "mit-0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, subject to the following conditions", "mit"),
    ("3. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.", "zlib"),
    ("4. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n4. The name of the author may not be used to endorse or promote products", "bzip2"),
    ("Affirmer hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and surrenders all of Affirmer's Copyright and Related Rights", "cc0-1.0"),
    ("The code was placed in the public domain in 1999", "public-domain"),
    ("the grant of rights under the License will not include, and the License does not grant to you, the right to Sell the Software.", "commons-clause"),
    ("You may not provide the software to third parties as a hosted or managed service, where the service provides users with access to any substantial set of the features or functionality of the software.", "elastic-2.0"),
    ("If we meet some day, and you think this stuff is worth it, you can buy me a beer in return.", "beerware"),
    ("Permission is hereby granted, free of charge, subject to the following condition, to any person obtaining a copy of this software, associated documentation and/or data", "upl-1.0"),
    ("Neither the Font Software nor any of its individual components, in Original or Modified Versions, may be sold by itself", "ofl-1.1"),
    ("If you remix, transform, or build upon the material, you may not distribute the modified material.", "cc-nd"),
    ("This file is free software; the Free Software Foundation gives unlimited permission to copy and/or distribute it, with or without modifications, as long as this notice is preserved.", "fsfullr"),
    ("No part of this publication may be reproduced, stored in a retrieval system, or transmitted in any form or by any means", "all-rights-reserved"),
    ("The patient was released into the garden; the notes are in good order and nothing in this text is a license.", ""),
]


def test_sentences_of_licenses_by_hand():
    assert [(text, licenses.scan(f"Intro words. {text} More words.")["labels"]) for text, _ in SENTENCES] == [(text, [label] if label else []) for text, label in SENTENCES]


def limited(seconds, f, *args):
    began = time.time()
    out = f(*args)
    assert time.time() - began < seconds
    return out


def test_very_long_texts():
    """A megabyte of what could make an operator slow; the limits are many times what is needed."""
    block = decontam.Block([(1, "a " * 10_000), (2, "b c"), (3, " ".join(f"q{k}" for k in range(30)))])
    n, found = limited(20, block.matches, [b"a " * 500_000, b"b c " * 20_000])
    assert n.tolist() == [500_000, 40_000] and max(m[3] for m in found[0]) == 10_000 and len(found[1]) == 20_000
    told = limited(30, licenses.scan, "mit license zlib license " * 40_000)
    assert told["labels"] == ["mit", "zlib"] and len(told["detections"]) == 80_000
    for nest in ("<div>", "<p><button>", "<ul><li>", "<table><tr><td>", "<a '", "<b ", "<!-- "):
        page = limited(20, pages.Page, nest * 100_000 + "text")
        limited(20, page.text, page.kept())
    for text in ("1" * 1_000_000, "1." * 500_000, "a" * 1_000_000 + "@", "@a" * 500_000, "+1 " * 300_000, "1 " * 500_000, "0" * 5000 + ".1.2.3", "a.b@" * 200_000):
        limited(20, pii.find, text)
    assert [x[:3] for x in pii.find("0" * 5000 + "1.1.2.3")] == [("ip", 0, 5007)]


def plain_matches(items, text):
    """(hit words, items with windows, words of the longest common stretch with a window) by holding all places against all."""
    words, hit, found, longest = re.findall(r"[a-z0-9]+", text), set(), set(), 0
    for k, item in items:
        theirs = re.findall(r"[a-z0-9]+", item)
        window = min(len(theirs), decontam.WINDOW)
        for a in range(len(words)):
            for b in range(len(theirs)):
                n = 0
                while a + n < len(words) and b + n < len(theirs) and words[a + n] == theirs[b + n]:
                    n += 1
                if window and n >= window:
                    hit |= set(range(a, a + n))
                    found.add(k)
                    longest = max(longest, n)
    return len(words), hit, found, longest


def test_matches_by_brute_force():
    """Few words, phrases that texts and items repeat, items below a window, and one word again and again."""
    random.seed(5)
    for turn in range(60):
        words = [f"w{k}" for k in range(random.choice([1, 2, 5, 60]))]
        say = lambda n: " ".join(random.choices(words, k=n))  # noqa: E731, B023
        phrases = [say(n) for n in (3, 9, 10, 11, 25)]
        piece = lambda: random.choice([*phrases, say(1), say(4)])  # noqa: E731, B023
        items = [(k, " ".join(piece() for _ in range(random.choice([0, 1, 2, 6])))) for k in range(8)]
        texts = [" ".join(piece() for _ in range(random.choice([0, 1, 3, 10]))) for _ in range(5)]
        counts, found = decontam.Block(items).matches([t.encode() for t in texts])
        for text, n, told in zip(texts, counts.tolist(), found):
            hit = {w for m in told for w in range(m[2], m[2] + m[3])}
            assert (n, hit, {m[0] for m in told}, max((m[3] for m in told), default=0)) == plain_matches(items, text), turn
            for k, b, a, size in told:
                assert re.findall(r"\w+", dict(items)[k])[b : b + size] == re.findall(r"\w+", text)[a : a + size]


def test_matches_of_repeated_phrases_are_few():
    """A phrase that text and item repeat, each time before another word, is one match a place and not one a pair of places."""
    phrase = " ".join(f"p{k}" for k in range(12))
    item, text = (" ".join(f"{phrase} {x}{k}" for k in range(5000)) for x in "uv")
    _, (found,) = limited(20, decontam.Block([(1, item)]).matches, [text.encode()])
    assert len(found) == 5000 and {m[3] for m in found} == {12}


def test_texts_that_share_their_vocabulary_with_the_benchmark():
    """A shared vocabulary alone is no work: only windows of items are sorted."""
    random.seed(6)
    words = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(random.choices(words, k=90))) for k in range(1000)]
    block = decontam.Block(items)
    texts = [" ".join(random.choices(words, k=1000)) for _ in range(400)]
    texts[7] += " " + items[3][1]
    _, found = limited(20, block.matches, [t.encode() for t in texts])
    assert [(t, m) for t, x in enumerate(found) for m in x] == [(7, (3, 0, 1000, 90))]


def test_blocks_of_long_documents_are_taken_apart(monkeypatch):
    """Every two documents of a block of which one is of the few meet in a tile, and no tile has more than two parts."""
    monkeypatch.setattr(neardup, "TILE", 100)
    random.seed(12)
    for _ in range(50):
        rows = [(b, k < few, n) for b in range(4) for few in [random.choice([0, 1, 3, 20])] for k, n in enumerate(random.choices([5, 30, 99, 100, 101, 450], k=random.choice([1, 2, 20])))]
        block, few, n = (np.array(x) for x in zip(*rows))
        doc = np.arange(len(rows))
        tiles = list(zip(*(x.tolist() for x in neardup._tiles(block, doc, few, doc * 10, n))))
        wanted = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if block[i] == block[j] and (few[i] or few[j])}
        by = defaultdict(list)
        for b, d, f, c in tiles:
            assert f == few[d] and c == 10 * d
            by[b].append(d)
        met = {(i, j) for x in by.values() for i in x for j in x if i < j}
        assert wanted <= met and all(block[i] == block[j] for i, j in met)
        assert all(sum(n[x]) <= 200 + sum(sorted(n[x])[-2:]) and len(set(x)) == len(x) for x in by.values())


def test_very_long_rows_through_spark(spark):
    rows = [(1, "word " * 200_000), (2, "word " * 200_000), (3, " ".join(f"w{k}" for k in range(150_000)))]
    out = {r.doc_id: r for r in substrings.with_kept(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(out[1].kept) < 200 and len(out[2].kept) == 0 and bytes(out[3].kept).decode() == rows[2][1]


def test_ranges_are_verified():
    """A range whose bytes are not what it is said to repeat stays."""
    raw = b"x" * 300
    good = {"begin": 10, "end": 120, "digest": substrings.digest(raw[:110])}
    assert substrings.merged([good, {"begin": 150, "end": 260, "digest": substrings.digest(b"y" * 110)}, {"begin": 250, "end": 360, "digest": substrings.digest(raw[:110])}], raw) == [(10, 120)]


def plain_removed(texts):
    """Bytes under a window that starts earlier, by id and place."""
    seen, out = set(), {}
    for of, text in sorted(texts):
        raw, gone = text.encode(), bytearray(len(text.encode()))
        for k in range(len(raw) - substrings.LENGTH + 1):
            window = raw[k : k + substrings.LENGTH]
            if window in seen:
                gone[k : k + substrings.LENGTH] = b"\1" * substrings.LENGTH
            seen.add(window)
        out[of] = bytes(b for b, x in zip(raw, gone) if not x)
    return out


def test_periodic_texts_by_brute_force(spark):
    """Rows of equal pieces, alone, between other text, and again in later documents at another phase."""
    random.seed(9)
    say = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    rows = []
    for k in range(40):
        root = random.choice(["a", "ab", "-----\n", say(7), say(23), say(40), say(101), say(150)])
        rows.append((k, say(random.choice([0, 5, 300])) + (root * 4000)[random.randrange(20) :][: random.choice([0, 90, 150, 1000, 4000])] + say(random.choice([0, 300])) + (root * 50)[:2000]))
    rows += [(40 + k, rows[k][1][random.randrange(50) :]) for k in range(10)]
    out = {r.doc_id: bytes(r.kept) for r in substrings.with_kept(spark.createDataFrame(rows, DOCS).repartition(5)).collect()}
    assert out == plain_removed(rows)


def test_long_periodic_texts(spark):
    """Tens of megabytes of one character, and of a table of dashes: no row a byte, and no row of ranges a text."""
    began = time.time()
    rows = [(1, "a" * 30_000_000), (2, "-----+----|\n" * 1_000_000), (3, "b" + "a" * 5_000_000)]
    out = {r.doc_id: bytes(r.kept) for r in substrings.with_kept(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    assert out == {1: b"a", 2: b"-----+----|\n", 3: b"b"}
    assert time.time() - began < 180


def test_stretches_have_all_windows(monkeypatch):
    monkeypatch.setattr(substrings, "STRETCH", 1000)
    raw = bytes(random.randrange(97, 120) for _ in range(5555))
    for n in (0, 99, 100, 999, 1000, 1099, 1100, 5555):
        seen = [(at + k, piece[k : k + 100]) for of, at, piece in substrings._stretches([7, None], [raw[:n], b"x"]) for k in range(len(piece) - 99)]
        assert seen == [(k, raw[k : k + 100]) for k in range(n - 99)]
