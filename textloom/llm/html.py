"""Main text of web pages: site templates are found by counting element subtrees, and removed.

Every page is parsed once. Of each block-level element of the whole page the subtree is hashed: tag, own text and the subtrees
below it. Spark counts in how many different articles of a host, and of a section of a host (the first folder of the path), a
subtree stands; pages with equal articles count once, so that mirrored articles are no template. Subtrees in at least
``MIN_PAGES`` articles and ``MIN_SHARE`` of the host's, or of the section's, are its template; as a page has only so many
subtrees, a host or section has at most 1/``MIN_SHARE`` times the mean of these. What is left of the pages' elements and text
is then read again, without the template. A subtree in a smaller share of a host and of all its sections stays, however large
the host is: of a million pages some phrases stand in thousands.

By rule, whatever the counts say, go: menus, page headers, footers, sidebars, notices, adverts, forms, reader comments, what is hidden,
scripts and styles. Outside of articles these are told by element, role, or a word in the class or id. Inside an ``article`` or ``main``
nothing goes by a word: only elements and roles of these kinds, and what has a class that is, as a whole, the name of an advert, a menu,
a sidebar or of reader comments. The article is the ``article`` elements outside of these, or
else ``main``, or else the body without lists of links. Parsing follows HTML: implied end tags, void and raw-text elements,
unclosed and truncated markup. Times are in proportion to the page, however deep its elements are nested.

Text: a block ends where a block-level element begins or ends; white space in a block is one space, blocks without text are
none, and blocks are joined by one line end. ``br`` is white space.

Defined cases: null or empty html has empty text; a null url, or one without a host, belongs to the host null; repeated rows
get equal results; an empty table gives an empty result; extra columns of ``pages``
are kept, one named like the added one is replaced.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import cut, slices

MIN_PAGES = 10
MIN_SHARE = 0.2
LINK_SHARE = 0.6
MIN_LINKS = 3
#: What has the article or all of the page in it, or no text that is shown, is no template.
WHOLE = frozenset("html body article main head".split())

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption head html legend optgroup option tbody td tfoot th thead tr".split())
#: An element that begins closes an open one of these, up to the element that bounds it.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}), "body": ({"head"}, set()),
}
P_BOUNDS = frozenset("button table td th caption template object html".split())
DROP_TAGS = frozenset(
    "nav footer aside form menu dialog button select textarea input label fieldset script style noscript template iframe object embed svg canvas audio video map head title noembed noframes xmp".split()
)
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist status".split())
DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promotion promotions menu menus nav navbar navigation breadcrumb breadcrumbs "
    "sidebar sidebars footer cookie cookies consent gdpr notice notices notification popup modal newsletter subscribe subscription signup login paywall share sharing social related "
    "recommended comment comments commentlist disqus respond reply replies widget widgets toolbar pagination pager masthead skip".split()
)
HEADER_WORDS = frozenset({"header", "topbar", "masthead"})
#: In an article: elements that may hold a part of it, and the classes that say, by their whole name, that theirs is none.
ARTICLE_TAGS = frozenset({"label", "fieldset", "object"})
NO_ARTICLE = frozenset("ad ads advert adverts advertisement advertisements adsbygoogle menu nav navbar sidebar comment comments comment-list commentlist reader-comments user-comments".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Za-z][a-z]*|[0-9]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPACE = re.compile(r"\s+")


class Page:
    """The elements of a page in the order in which they begin, and its text in pieces."""

    def __init__(self, source: str):
        self.tag, self.parent, self.drop, self.hash = ["#"], [0], [False], [0]
        self.main: list[int] = []
        self.articles: list[int] = []
        self.pieces: list[tuple[int, str | None]] = []  # (element, text), text None where a block ends
        self._content: list[list[str]] = [[]]
        self._open = [0]
        self._depths: dict[str, list[int]] = {}  # of each tag, how deep its open elements are
        self._read(source)
        while self._open:
            self._close()

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            found = _TOKEN.search(source, at)
            if not found:
                self._text(source[at:])
                return
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            closing, name, attributes, ended = found.group(1, 2, 3, 4) if found.group(2) else found.group(5, 6, 7, 8)
            if not name or not ended:
                continue
            name = name.lower()
            if closing:
                self._end(name)
                continue
            self._begin(name, attributes)
            if name in RAW:
                end = _RAW_END[name].search(source, at)
                at = end.start() if end else size

    def _text(self, text: str) -> None:
        text = entities.unescape(text)
        self.pieces.append((self._open[-1], text))
        if not text.isspace():
            self._content[self._open[-1]].append(" ".join(text.split()))

    def _close(self) -> None:
        node = self._open.pop()
        if node:
            self._depths[self.tag[node]].pop()
        content = self._content[node]
        if content:
            digest = xxhash.xxh3_64_intdigest(f"{self.tag[node]}\0" + "\0".join(content))
            self.hash[node] = digest
            if self._open:
                self._content[self._open[-1]].append(f"\1{digest:x}")
        self._content[node] = []
        if self.tag[node] in BLOCK:
            self.pieces.append((node, None))

    def _pop_to(self, names: set[str] | frozenset[str], bounds: set[str] | frozenset[str]) -> None:
        """Closes the outermost open element among ``names`` that no bound stands above."""
        opened = [d for t in names if (d := self._depths.get(t))]
        if opened:
            bound = max([d[-1] for t in bounds if (d := self._depths.get(t))], default=0)
            depth = min([d[k] for d in opened if (k := bisect_right(d, bound)) < len(d)], default=len(self._open))
            while len(self._open) > depth:
                self._close()

    def _begin(self, name: str, attributes: str) -> None:
        if name in CLOSES_P:
            self._pop_to({"p"}, P_BOUNDS)
        if name in SIBLINGS:
            self._pop_to(*SIBLINGS[name])
        node = len(self.tag)
        self.tag.append(name)
        self.parent.append(self._open[-1])
        self.hash.append(0)
        self._content.append([])
        said = {k.lower(): (a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes else {}
        self.drop.append(self._dropped(name, said))
        if name == "article":
            self.articles.append(node)
        if name == "main" or said.get("role") == "main":
            self.main.append(node)
        if name in BLOCK:
            self.pieces.append((node, None))
        elif name == "br":
            self.pieces.append((node, " "))
        if name not in VOID and not attributes.endswith("/") or name in BLOCK - VOID:
            self._depths.setdefault(name, []).append(len(self._open))
            self._open.append(node)

    def _dropped(self, name: str, said: dict[str, str]) -> bool:
        if name in ("html", "body", "main"):
            return False
        within = bool(self._depths.get("article") or self._depths.get("main"))
        if name in DROP_TAGS and not (within and name in ARTICLE_TAGS):
            return True
        if name == "header" and not within:
            return True
        if not said:
            return False
        if "hidden" in said or said.get("aria-hidden") == "true" or _HIDDEN.search(said.get("style", "")) or said.get("role", "").lower() in DROP_ROLES:
            return True
        if within:
            return not NO_ARTICLE.isdisjoint(said.get("class", "").lower().split())
        words = {w.lower() for w in _WORDS.findall(f"{said.get('class', '')} {said.get('id', '')}")}
        return bool(words & (DROP_WORDS | HEADER_WORDS))

    def _end(self, name: str) -> None:
        depths = self._depths.get(name)
        if depths:
            depth = depths[-1]
            while len(self._open) > depth:
                self._close()

    def kept(self) -> list[bool]:
        """For each element: is it in the article, outside of what is dropped by rule?"""
        n = len(self.tag)
        size, linked, links, inside = [0] * n, [0] * n, [0] * n, [False] * n
        for node, text in self.pieces:
            if text:
                size[node] += len(text.strip())
        for k in range(1, n):
            inside[k] = self.tag[k] == "a" or inside[self.parent[k]]
        for k in range(n - 1, 0, -1):
            if inside[k]:
                linked[k] = size[k]
            links[k] += self.tag[k] == "a"
            up = self.parent[k]
            size[up] += size[k]
            linked[up] += linked[k]
            links[up] += links[k]
        out_of_reach = [False] * n
        for k in range(1, n):
            out_of_reach[k] = self.drop[k] or out_of_reach[self.parent[k]]
        roots = [k for k in self.articles if not out_of_reach[k] and size[k]] or [k for k in self.main if not out_of_reach[k] and size[k]]
        if not roots and self.articles and max(size[k] for k in self.articles):
            roots = [max(self.articles, key=lambda k: (size[k], -k))]  # whatever its surroundings are called
        whole = not roots
        self.roots = root = set(roots)
        state = [whole] + [False] * (n - 1)
        for k in range(1, n):
            if k in root:
                state[k] = True
                continue
            state[k] = state[self.parent[k]] and not self.drop[k]
            if state[k] and whole and links[k] >= MIN_LINKS and linked[k] > LINK_SHARE * size[k] and self.tag[k] not in ("html", "body"):
                state[k] = False
        return state

    def subtrees(self) -> list[int]:
        """The hashes of the block-level elements that have text; inline ones are words of a sentence and go with its block only."""
        return sorted({h for h, tag in zip(self.hash, self.tag) if h and tag in BLOCK and tag not in WHOLE})

    def left(self, kept: list[bool]) -> tuple[list[tuple[int, int]], list[tuple[int, str | None]]]:
        """What is needed of a page: (parent, hash) of the kept elements, numbered anew, and their (element, text), text None between blocks."""
        number, elements, pieces = {}, [], []
        for k, state in enumerate(kept):
            if state:
                number[k] = len(elements)
                elements.append((number.get(self.parent[k], -1) if k and k not in self.roots else -1, 0 if k in self.roots or self.tag[k] not in BLOCK else self.hash[k]))
        for node, text in self.pieces:
            if text is not None and kept[node]:
                pieces.append((number[node], text))
            elif text is None and pieces and pieces[-1][1] is not None:
                pieces.append((0, None))
        return elements, pieces

    def text(self, kept: list[bool]) -> str:
        return joined(text for node, text in self.pieces if text is None or kept[node])


def joined(pieces: Iterable[str | None]) -> str:
    """The blocks of a text, one a line; None ends a block."""
    blocks, here = [], []
    for text in pieces:
        if text is not None:
            here.append(text)
        elif here:
            blocks.append(_SPACE.sub(" ", "".join(here)).strip())
            here = []
    blocks.append(_SPACE.sub(" ", "".join(here)).strip())
    return "\n".join(b for b in blocks if b)


_PARTS = "__of_page_host string, __of_page_section string, __of_page_page long, __of_page_subtrees array<long>, __of_page_elements array<struct<parent: int, hash: long>>, __of_page_pieces array<struct<element: int, text: string>>"

#: The columns that this operator works with; all others are the caller's.
OWN = frozenset(f"__of_page_{c}" for c in "host section page subtrees elements pieces template t1 t2 h g s".split())


def _listed(rows: list[list[tuple]], kinds: dict[str, pa.DataType]) -> pa.Array:
    """A list of structs a row."""
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in rows], dtype=np.int64))).astype(np.int32)
    columns = list(zip(*(y for x in rows for y in x))) or [()] * len(kinds)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds)))


def _parts(pages: DataFrame, html_col: str, keep_html: bool) -> DataFrame:
    """``pages``, with __of_page_host and __of_page_section, and what is needed of each page: its article's hash, its subtrees, its elements and text."""
    kept = [f for f in pages.schema.fields if f.name not in OWN and (keep_html or f.name != html_col)]
    schema = T.StructType([*kept, *T._parse_datatype_string(_PARTS).fields])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_col):
            articles, subtrees, elements, pieces = [], [], [], []
            for source in batch.column(html_col).to_pylist():
                page = Page(source or "")
                state = page.kept()
                text = page.text(state)
                articles.append(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63 if text else None)
                subtrees.append([x - 2**63 for x in page.subtrees()])
                more = page.left(state)
                elements.append([(up, h - 2**63 if h else None) for up, h in more[0]])
                pieces.append(more[1])
            told = [pa.array(articles, pa.int64()), pa.array(subtrees, pa.list_(pa.int64())), _listed(elements, {"parent": pa.int32(), "hash": pa.int64()}), _listed(pieces, {"element": pa.int32(), "text": pa.string()})]
            own = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*own, batch.column("__of_page_host"), batch.column("__of_page_section"), *told], names=schema.names)

    return pages.mapInArrow(parse, schema)


def templates(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, template) and (host, section, template): the hashes of the subtrees that recur, for each that has some."""
    rows = parts.filter(F.col("__of_page_page").isNotNull()).groupBy(F.col("__of_page_host").alias("host"), F.col("__of_page_section").alias("section"), F.col("__of_page_page").alias("page"))
    rows = cut(rows.agg(F.min("__of_page_subtrees").alias("subtrees")))
    pages = rows.groupBy("host", "section").agg(F.count(F.lit(1)).alias("pages"))
    times = rows.select("host", "section", F.explode("subtrees").alias("subtree")).groupBy("host", "section", "subtree").agg(F.count(F.lit(1)).alias("times"))
    found = []
    for key in (["host"], ["host", "section"]):
        total = pages.groupBy(*[F.col(k).alias(f"of_{k}") for k in key]).agg(F.sum("pages").alias("pages")).filter(F.col("pages") >= MIN_PAGES)
        often = times.groupBy(*key, "subtree").agg(F.sum("times").alias("times")).filter(F.col("times") >= MIN_PAGES)
        same = F.col("host").eqNullSafe(F.col("of_host"))
        often = often.join(total, same & F.col("section").eqNullSafe(F.col("of_section")) if len(key) > 1 else same)
        often = often.filter(F.col("times") >= F.lit(MIN_SHARE) * F.col("pages"))
        found.append(cut(often.groupBy(*key).agg(F.sort_array(F.collect_list("subtree")).alias("template"))))
    return found[0], found[1]


def _host(url_col: str):
    return F.lower(F.nullif(F.regexp_extract(url_col, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _section(url_col: str):
    return F.regexp_extract(url_col, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)/", 1)


def with_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text", keep_html: bool = True) -> DataFrame:
    """``pages`` with the main text of each, and without their html if it is not to be kept."""
    pages = pages.drop(text_col).withColumns({"__of_page_host": _host(url_col), "__of_page_section": _section(url_col)})
    parts = cut(_parts(pages, html_col, keep_html))
    of_host, of_section = templates(parts)
    # tables of known size: where they are small Spark sends them to all tasks, else it joins on host and splits the hot ones
    df = parts.drop("__of_page_page", "__of_page_subtrees").join(of_host.select(F.col("host").alias("__of_page_h"), F.col("template").alias("__of_page_t1")), F.col("__of_page_host").eqNullSafe(F.col("__of_page_h")), "left")
    of_section = of_section.select(F.col("host").alias("__of_page_g"), F.col("section").alias("__of_page_s"), F.col("template").alias("__of_page_t2"))
    df = df.join(of_section, F.col("__of_page_host").eqNullSafe(F.col("__of_page_g")) & F.col("__of_page_section").eqNullSafe(F.col("__of_page_s")), "left")
    kept = [f for f in parts.schema.fields if f.name not in OWN]
    df = df.select(*[f.name for f in kept], "__of_page_elements", "__of_page_pieces", F.array_union(F.coalesce("__of_page_t1", F.array().cast("array<long>")), F.coalesce("__of_page_t2", F.array().cast("array<long>"))).alias("__of_page_template"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (up, hashes), (of, texts) = (batch.column(c).flatten().flatten() for c in ("__of_page_elements", "__of_page_pieces"))
            up, hashes, of, texts = (x.to_pylist() for x in (up, hashes, of, texts))
            first, begin = (np.concatenate(([0], np.cumsum(batch.column(c).value_lengths().to_numpy()))).tolist() for c in ("__of_page_elements", "__of_page_pieces"))
            told = []
            for k, template in enumerate(map(set, batch.column("__of_page_template").to_pylist())):
                e, p, q = first[k], begin[k], begin[k + 1]
                if template:
                    gone: list[bool] = []
                    for parent, h in zip(up[e : first[k + 1]], hashes[e : first[k + 1]]):
                        gone.append(h in template or parent >= 0 and gone[parent])
                    told.append(joined(t for n, t in zip(of[p:q], texts[p:q]) if t is None or not gone[n]))
                else:
                    told.append(joined(texts[p:q]))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(told, pa.string())], names=[*[f.name for f in kept], text_col])

    return df.mapInArrow(write, T.StructType([*kept, T.StructField(text_col, T.StringType())]))
