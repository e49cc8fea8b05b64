"""Personal data, and the terms that give it away.

Found by pattern: e-mail addresses, IP addresses, card and phone numbers (:data:`KINDS`). A found value is a protected entity,
and words of its text can reveal it even when it is masked, wherever they stand; so can they reveal a part of it that other
values have too (:func:`entities`). How strongly a term t reveals an entity or part e is estimated from the whole corpus: with
documents(t) those in which t stands and documents(e, t) those in which it stands with e, the information about e that is
still missing once t is known is -log2(documents(e, t) / documents(t)) bits. A term that leaves at most
``GENERALISE_BITS`` is disclosing; it is replaced by what kind of word it is, and removed if it leaves at most ``REMOVE_BITS``.
Pairs seen in fewer than ``MIN_TEXTS`` different texts say nothing, so copies of one text do not make a term. In the documents
in which it stands with the entity, every occurrence of a disclosing term goes.

Counts are taken in Spark: entities and terms of fewer than ``MIN_TEXTS`` texts have no pair that counts and are left out first,
equal texts are one row with their number, pairs are summed by (entity, term) before and after the shuffle, terms of all
documents by batch first and then by term. A term that stands in more documents than can be disclosing is left out before any
pair is made, for all entities or for the rarer ones: common words meet no entity of a few texts, so a long list of contacts
makes pairs with its rare words only. What is joined are lists per text, not pairs of documents, so an entity in a third of all
documents costs rows in proportion to the words of their texts.

Defined cases: null or empty text has no spans; ids are not used, so repeated rows and null ids get what their text gets;
an empty table gives an empty result; extra columns are kept, those named like the added ones are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import cut, own_names, slices, small

#: Kinds of the patterns in order; terms come after them.
KINDS = ("email", "ip", "card", "phone", "term")
MIN_TEXTS = 3
#: Digits of a number that are a part of their own.
PREFIX = {"card": 6, "phone": 5}
GENERALISE_BITS = 1.0
REMOVE_BITS = 0.152  # at least nine in ten

# no expression can start in the middle of a run that it has failed on, so times stay in proportion to the text
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_TOKENS = re.compile(r"[A-Za-z]{3,}")
_WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{3,}")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def find(text: str | None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then kind; code points, end exclusive; the value is the same however it is written."""
    if not text or not _ANY.search(text):
        return []
    found = [("email", a, b, text[a:b].lower()) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            found.append(("ip", m.start(), m.end(), m.group()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 9 <= len(digits) <= 15:
                found.append(("phone", m.start(), m.end(), digits))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def entities(found: list[tuple[str, int, int, str]]) -> set[str]:
    """The values found, and the parts of them that can recur: mail domain and tokens of the local part, and the first three
    numbers of an IP address, six digits of a card and five of a phone number."""
    out = set()
    for kind, _, _, value in found:
        out.add(f"{kind}:{value}")
        if kind == "email":
            local, _, domain = value.rpartition("@")
            out.update([f"email part:@{domain}", *[f"email part:{x}" for x in _TOKENS.findall(local)]])
        else:
            out.add(f"{kind} part:{value.rpartition('.')[0] if kind == 'ip' else value[: PREFIX[kind]]}")
    return out


def terms_beside(text: str, found: list[tuple[str, int, int, str]]) -> set[str]:
    """The words of a text, those of entities left out."""
    spans = sorted((a, b) for _, a, b, _ in found)
    words, k = set(), 0
    for m in _WORD.finditer(text):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        if not (k < len(spans) and spans[k][0] < m.end()):
            words.add(m.group().lower())
    return words


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text's hash, entities) of the texts that have some."""
    for batch in slices(batches, 1):
        rows = [(key, sorted(entities(found))) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (found := find(text))]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.list_(pa.string()))], names=["key", "entities"])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text's hash, terms)"""
    for batch in slices(batches, 1):
        terms = [sorted(terms_beside(text, find(text))) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.string()))], names=["key", "terms"])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 0):
        times: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            times.update({word.lower() for word in set(_WORD.findall(text or ""))})  # as in terms_beside: a sigma's form depends on what is beside it
        yield pa.RecordBatch.from_arrays([pa.array(times.keys(), pa.string()), pa.array(times.values(), pa.int64())], names=["term", "documents"])


def disclosing(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(key, terms): for each text (by hash) the disclosing terms in it, as array<struct<term, bits>>."""
    texts = docs.filter(F.col(text_col).rlike("[0-9@]")).select(F.unhex(F.md5(text_col)).alias("key"), F.col(text_col).alias("text"))
    rows = texts.mapInArrow(_entities, "key binary, entities array<string>")
    rows = cut(rows.groupBy("key").agg(F.first("entities").alias("entities"), F.count(F.lit(1)).alias("n")))
    each = rows.select("key", "n", F.explode("entities").alias("entity"))
    recurring = each.groupBy("entity").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("of")).filter(F.col("texts") >= MIN_TEXTS)
    wanted = each.join(cut(recurring.select("entity", "of")), "entity").groupBy("key")
    wanted = cut(wanted.agg(F.collect_list(F.struct("entity", "of")).alias("entities"), F.first("n").alias("n")))
    terms = texts.join(wanted.select("key"), "key", "left_semi").mapInArrow(_terms, "key binary, terms array<string>").groupBy("key").agg(F.first("terms").alias("terms"))
    rows = cut(wanted.join(terms, "key"))
    # a term in over documents(e) * 2 ** GENERALISE_BITS documents discloses no entity e: such pairs are not made
    most = 2**GENERALISE_BITS * (1 + 1e-9)
    stands = rows.select("key", "n", F.explode("terms").alias("term"))
    beside = stands.groupBy("term").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("beside")).filter(F.col("texts") >= MIN_TEXTS)
    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(_term_counts, "term string, documents long").groupBy("term").agg(F.sum("documents").alias("documents"))
    able = cut(counts.join(beside, "term").filter(F.col("documents") <= F.col("beside") * most).select("term", "documents"))
    slim = stands.join(small(able), "term").groupBy("key").agg(F.collect_list(F.struct("term", "documents")).alias("terms"))
    rows = cut(rows.drop("terms").join(slim, "key"))
    together = rows.select("key", "n", "terms", F.inline("entities")).select("key", "n", "entity", F.inline(F.filter("terms", lambda t: t["documents"] <= F.col("of") * most)))
    pairs = together.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("together"), F.first("documents").alias("documents"))
    bits = -F.log2(F.least(F.col("together") / F.col("documents"), F.lit(1.0)))
    strong = pairs.filter(F.col("texts") >= MIN_TEXTS).withColumn("bits", bits).filter(F.col("bits") <= GENERALISE_BITS)
    strong = cut(strong.select(F.col("entity").alias("e"), F.col("term").alias("t"), "bits"))
    hits = together.join(strong, (F.col("entity") == F.col("e")) & (F.col("term") == F.col("t")))
    hits = hits.groupBy("key", "term").agg(F.min("bits").alias("bits"))
    return cut(hits.groupBy("key").agg(F.collect_list(F.struct("term", "bits")).alias("terms")))


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}


def spans_of(text: str, terms: dict[str, float]) -> tuple[list[tuple[str, int, int]], str]:
    """All spans of a text in order, and the text with them masked; spans that overlap are masked as the first of them."""
    base = find(text)
    found = [(kind, a, b) for kind, a, b, _ in base]
    if terms:
        taken = sorted((a, b) for _, a, b in found)
        k = 0
        for m in _WORD.finditer(text):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if not (k < len(taken) and taken[k][0] < m.end()) and m.group().lower() in terms:
                found.append(("term", m.start(), m.end()))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    out, at = [], 0
    for kind, a, b in found:
        if a < at:
            at = max(at, b)
            continue
        out.append(text[at:a])
        if kind != "term":
            out.append(_MASKS[kind])
        elif terms[text[a:b].lower()] > REMOVE_BITS:
            out.append("<Name>" if text[a].isupper() else "<word>")
        at = b
    out.append(text[at:])
    return found, "".join(out)


@own_names
def sanitised(docs: DataFrame, text_col: str = "text", masked_col: str = "masked", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans`` (array<struct<kind, start, end>>, in order) and the masked text; a null text stays null."""
    docs = docs.drop(masked_col, spans_col)
    # a table of known size: where it is small Spark sends it to all tasks, else it joins on the text's hash
    found = disclosing(docs, text_col).select(F.col("key").alias("__key"), F.col("terms").alias("__terms"))
    df = docs.join(found, F.unhex(F.md5(text_col)) == F.col("__key"), "left").drop("__key")
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField(spans_col, span), T.StructField(masked_col, T.StringType())])

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            names, columns = list(batch.schema.names), list(batch.columns)
            spans, texts = [], []
            for text, terms in zip(batch.column(names.index(text_col)).to_pylist(), columns.pop().to_pylist()):
                found, masked = spans_of(text or "", {x["term"]: x["bits"] for x in terms or ()})
                spans.append([dict(zip(("kind", "start", "end"), x)) for x in found])
                texts.append(None if text is None else masked)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, _SPAN), pa.array(texts, pa.string())], names=[*names[:-1], spans_col, masked_col])

    return df.mapInArrow(mask, schema)


def keep(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """All rows of ``docs``, all columns, with the text masked and its length in ``chars_col`` told anew where that column is there."""
    df = sanitised(docs, text_col, "__masked", "__spans_of")
    told = {text_col: F.col("__masked")}
    if chars_col in docs.columns:
        told[chars_col] = F.length("__masked").cast(docs.schema[chars_col].dataType)
    return df.withColumns(told).select(*docs.columns)
