"""Expressions over strings. Lengths are in code points, white space is Unicode's, everything stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a pattern: what Unicode calls so, and the four separators of ASCII.
WS = r"(?U)[\s\x1c-\x1f]"
_W = r"[\s\x1c-\x1f]"
#: The same, character by character.
_WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
MAX_PARAGRAPH = 1500
MIN_PARAGRAPH = 10
MAX_FRAGMENT = 14000
MIN_SENTENCE = 2
SENTENCE_END = r"(?<=[。！？.!?])"
#: The boundaries at which over-long text is split, strongest first.
LEVELS = (r"(?<=\n\n)", SENTENCE_END, r"(?<=[；;：:，,、])", r"(?U)(?<=[\s\x1c-\x1f])")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(c: Column) -> Column:
    """Looks at the ends only: a pattern for them is tried at every character."""
    return F.trim(c, F.lit(_WHITE))


def is_blank(c: Column) -> Column:
    """Is nothing left of a text that is stripped? Told by its first character that is no white space."""
    return ~c.rlike(r"(?U)[^\s\x1c-\x1f]")


def squeeze(c: Column) -> Column:
    """White space as single spaces, none at the ends. A single space between words is no match."""
    return F.trim(F.regexp_replace(c, rf"(?U){_W}(?:{_W}+|(?<! ))", " "))


def _replace_at(c: Column, mark: str, pattern: str, by: str) -> Column:
    """A pattern that has a mark in it is tried only on texts that have the mark."""
    return bound(c, lambda t: F.when(t.contains(mark), F.regexp_replace(t, pattern, by)).otherwise(t))


def clean(c: Column, is_table: Column | None = None) -> Column:
    """A text without markup: tags, apostrophes, full-width brackets and dashes, spaces at slashes, brackets and commas; tables
    are only stripped. The order of the steps shows in the result."""
    # fixed values: what is replaced by what, in this order
    t = _replace_at(c, "<", "<[^>]+>", "")
    t = F.replace(F.replace(F.replace(t, F.lit("'"), F.lit(", ")), F.lit("（"), F.lit("(")), F.lit("）"), F.lit(")"))
    t = _replace_at(t, "/", rf"(?U){_W}*/{_W}*", "/")
    t = _replace_at(_replace_at(t, "(", rf"(?U)\({_W}+", "("), ")", rf"(?U){_W}+\)", ")")
    t = _replace_at(t, ",", rf"(?U),{_W}+,", ",")
    t = squeeze(F.replace(t, F.lit("－"), F.lit("-")))
    t = F.coalesce(t, F.lit(""))
    return t if is_table is None else F.when(is_table, F.coalesce(strip(c), F.lit(""))).otherwise(t)


def times(c: Column, what: str) -> Column:
    """How often a one-character string stands in a text."""
    return F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))


def is_table(c: Column) -> Column:
    return times(c, "|") > 2


def tokens(c: Column) -> Column:
    """Estimated tokens, at two characters each."""
    return F.floor((F.length(c) + 1) / 2).cast("int")


def pieces(c: Column, boundary: str) -> Column:
    """A text split where the pattern matches (nothing is lost but white space at the ends of pieces)."""
    return F.filter(F.transform(F.split(c, boundary), strip), lambda x: x != "")


def split_long(c: Column) -> Column:
    """A paragraph of over MAX_PARAGRAPH characters after each full stop (。) and at line ends, each piece closed by one."""

    def split(t: Column) -> Column:
        parts = pieces(F.replace(t, F.lit("。"), F.lit("。\n")), "\n")
        closed = F.transform(parts, lambda x: F.when(x.endswith("。"), x).otherwise(F.concat(x, F.lit("。"))))
        return F.when(F.length(t) > MAX_PARAGRAPH, closed).otherwise(F.array(t))

    return bound(c, split)


def hard_cut(c: Column, size: int) -> Column:
    """Windows of ``size`` characters, stripped; blank ones are left out."""
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.length(c), F.lit(1)) - 1) / size).cast("int")), lambda i: strip(F.substring(c, i * size + 1, F.lit(size))))
    return F.filter(cut, lambda x: x != "")


#: Merged pieces that are put away together.
_RUN = 128


def merge_small(parts: Column, size: int) -> Column:
    """Neighbours put together, without a separator, as long as they are at most ``size`` characters.

    An array grows by being copied, so merged pieces are collected in runs of ``_RUN``, and the array of runs is what grows.
    """
    start = F.struct(F.array().cast("array<array<string>>").alias("runs"), F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def add(a: Column, x: Column) -> Column:
        full = (a["open"] != "") & (F.length(a["open"]) + F.length(x) > size)
        away = full & (F.size(a["done"]) >= _RUN)
        runs = F.when(away, F.concat(a["runs"], F.array(a["done"]))).otherwise(a["runs"])
        done = F.when(away, F.array(strip(a["open"]))).when(full, F.concat(a["done"], F.array(strip(a["open"])))).otherwise(a["done"])
        return F.struct(runs.alias("runs"), done.alias("done"), F.when(full, x).otherwise(F.concat(a["open"], x)).alias("open"))

    last = lambda a: F.when(strip(a["open"]) != "", F.array(strip(a["open"]))).otherwise(F.array().cast("array<string>"))
    return F.aggregate(parts, start, add, lambda a: F.concat(F.flatten(a["runs"]), a["done"], last(a)))


def safe_fragments(c: Column, size: int = MAX_FRAGMENT) -> Column:
    """A text in fragments of at most ``size`` characters: split at ever weaker boundaries, only what is still too long, then
    cut; small neighbours are merged. A text that is short enough, nearly every one, is not touched."""

    def cut(text: Column) -> Column:
        parts = F.array(text)
        for boundary in LEVELS:
            parts = _level(parts, boundary, size)
        parts = F.flatten(F.transform(parts, lambda x: F.when(F.length(x) <= size, F.array(x)).otherwise(hard_cut(x, size))))
        merged = merge_small(parts, size)
        over = F.raise_error(F.lit(f"a fragment is over the limit of {size} characters")).cast("string")
        whole = F.transform(merged, lambda x: F.when(F.length(x) <= size, x).otherwise(over))
        return F.when(text == "", F.array().cast("array<string>")).when(F.length(text) <= size, F.array(text)).otherwise(whole)

    return bound(strip(c), cut)


def _level(parts: Column, boundary: str, size: int) -> Column:
    def split(x: Column) -> Column:
        return F.when(F.length(x) <= size, F.array(x)).otherwise(pieces(x, boundary))

    return F.flatten(F.transform(parts, split))


def sentences(c: Column) -> Column:
    return pieces(c, SENTENCE_END)


def file_key(path: Column) -> Column:
    """A document's id from its file name: without folder, extension and prefixes of temporary names."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    name = F.regexp_replace(name, r"(?i)\.(pdf|docx?|txt|md)$", "")
    return strip(F.regexp_replace(F.regexp_replace(name, r"^vec_[a-f0-9]+_", ""), r"^temp_[a-f0-9_-]+_", ""))


def task_key(path: Column, root: Column | str = "") -> Column:
    """The first 20 hex digits of the SHA-256 of the path under ``root``; a path outside of it counts whole."""
    root = F.lit(root) if isinstance(root, str) else root
    prefix = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    relative = F.when((root != "") & F.startswith(path, prefix), F.substring(path, F.length(prefix) + 1, F.length(path))).otherwise(path)
    return F.substring(F.sha2(relative, 256), 1, 20)


def chunk_id(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("_", *parts)), 1, 16)
