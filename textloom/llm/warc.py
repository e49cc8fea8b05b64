"""WARC archives: captures written as request, response or revisit, and metadata records, and put together again from these.

Writing (:func:`write`): payloads that are equal and of at least ``MIN_REVISIT`` bytes are stored once, with the smallest id;
the others are revisit records that refer to it. A record is the text of a row, and the two line ends after it are the row
separator of Spark's text writer, so archives go through its committer to any file system, as gzip.

Reading (:func:`read`): Spark's text reader gives a file in pieces between pairs of line ends; since gzip files are not
split, a task has all pieces of a file in order, puts the byte stream together again and cuts records by Content-Length.
No file is held in memory, only one record.

Assembly (:func:`assemble`): request and metadata records find their response or revisit through WARC-Concurrent-To, named by
either side, directly or over other records, however many. Requests and metadata are summed up by capture before they are joined.

Defined cases: a null payload is empty; a null url leaves its header out; a null id comes last in the order and is left out
of the metadata; of rows that repeat an id, url and payload each gets the same result (if the payload is stored under this
id, each is a response); an empty table gives archives without records and no captures; extra columns are not used. A record
that names no known record is a capture of its own without a response.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import cut, shared_folder, step

MIN_REVISIT = 100
END = "\r\n"
GAP = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: One of record's headers each, but for the last two, which are taken from its block.
RECORD = (
    "record_id string, type string, date string, target_uri string, concurrent_to array<string>, refers_to string, "
    "http string, fields map<string,string>, payload_bytes long, payload_digest string, payload binary"
)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _record_id(kind: str, key: Column) -> Column:
    h = F.md5(F.concat(F.lit(f"{kind} "), key))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.lit("-" if a > 1 else ""), F.substring(h, a, n))], F.lit(">"))


def _record(kind: Column, record_id: Column, headers: Column, block: Column) -> Column:
    return F.concat(F.lit(f"WARC/1.1{END}WARC-Type: "), kind, F.lit(f"{END}WARC-Record-ID: "), record_id, F.lit(END), headers, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(GAP), block)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> str:
    """Archives of all rows in folder ``path``; a row's id goes into its metadata record."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    url = F.regexp_replace(F.col(url_col), r"[\x00-\x20\x7F]", "%20")
    rows = pages.select(F.col(id_col).cast("string").alias("name"), F.col(id_col).alias("id"), url.alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    digests = rows.filter(F.octet_length("payload") >= MIN_REVISIT)
    lowest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "name", "url"))
    once = digests.groupBy("digest").agg(lowest.alias("low"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    again = digests.select("digest", "id", "name", "url").join(once, "digest").filter(~F.col("id").eqNullSafe(F.col("low.id")))
    again = again.groupBy(F.col("digest").alias("d"), F.col("name").alias("n"), F.col("url").alias("u")).agg(F.first("low").alias("low"))
    rows = rows.join(again, (F.col("digest") == F.col("d")) & F.col("name").eqNullSafe(F.col("n")) & F.col("url").eqNullSafe(F.col("u")), "left")

    def key(name: Column, of: Column) -> Column:
        return F.concat_ws(" ", F.coalesce(name, F.lit("-")), F.coalesce(of, F.lit("-")), "digest")

    revisit = F.col("low").isNotNull()
    own, other = _record_id("response", key(F.col("name"), F.col("url"))), _record_id("response", key(F.col("low.name"), F.col("low.url")))
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), size, F.lit(GAP))
    common = F.concat(F.lit(f"WARC-Date: {date}{END}"), _line("WARC-Target-URI", F.col("url")))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit(END))
    main = F.concat(common, digest, F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{END}"), _line("WARC-Refers-To", other))).otherwise(F.lit("")), F.lit(f"Content-Type: application/http; msgtype=response{END}"))
    linked = F.concat(common, _line("WARC-Concurrent-To", own))
    host, where = F.coalesce(F.regexp_extract("url", r"^[a-z]+://([^/]*)", 1), F.lit("")), F.coalesce(F.regexp_extract("url", r"^[a-z]+://[^/]*([^#]*)", 1), F.lit(""))
    request = F.concat(F.lit("GET "), F.when(where == "", F.lit("/")).otherwise(where), F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(GAP))
    records = F.array(
        _record(F.lit("request"), _record_id("request", key(F.col("name"), F.col("url"))), F.concat(linked, F.lit(f"Content-Type: application/http; msgtype=request{END}")), request),
        _record(F.when(revisit, "revisit").otherwise("response"), own, main, F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))),
        _record(F.lit("metadata"), _record_id("metadata", key(F.col("name"), F.col("url"))), F.concat(linked, F.lit(f"Content-Type: application/warc-fields{END}")), _line("page-id", F.col("name"))),
    )
    with step(pages.sparkSession):
        rows.select(F.explode(records).alias("value")).write.option("lineSep", GAP).option("compression", "gzip").text(path)
    return path


# --- reading ------------------------------------------------------------------------------------------------------


class Stream:
    """The byte stream of an archive, fed in pieces; gives whole records."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.size, self.need, self.headers = 0, 0, None

    def feed(self, piece: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
        """The next bytes of the stream. Nothing is joined or searched before a record's length is there."""
        self.parts.append(piece)
        self.size += len(piece)
        while self.size >= self.need and (found := self._next()):
            yield found

    def _next(self) -> tuple[list[tuple[str, str]], bytes] | None:
        held = b"".join(self.parts)
        if self.headers is None:
            held = held.lstrip(b"\r\n")
            stop = held.find(b"\r\n\r\n")
            if stop >= 0:
                lines = held[:stop].decode("utf-8", "replace").split("\r\n")
                self.headers = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])]
                held = held[stop + 4 :]
                self.need = int(dict(self.headers).get("content-length") or 0)
        self.parts, self.size = [held] if held else [], len(held)
        if self.headers is None or self.size < self.need:
            return None
        out = self.headers, held[: self.need]
        rest = held[self.need :]
        self.parts, self.size, self.need, self.headers = [rest] if rest else [], len(rest), 0, None
        return out


def _row(headers: list[tuple[str, str]], block: bytes) -> dict:
    of, kind = dict(headers), dict(headers).get("content-type", "")
    http, payload, fields = None, block, None
    if kind.startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = head.decode("utf-8", "replace")
    if kind.startswith("application/warc-fields"):
        fields = [(k.strip(), v.strip()) for k, sep, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")) if sep]
    size, digest = len(payload), None
    if of.get("warc-type") == "revisit":
        size = next((int(v) for k, _, v in (x.partition(":") for x in (http or "").split("\r\n")) if k.strip().lower() == "content-length" and v.strip().isdigit()), None)
        digest = of.get("warc-payload-digest", "").removeprefix("sha256:") or None
    elif of.get("warc-type") == "response":
        digest = hashlib.sha256(payload).hexdigest()
    return {
        "record_id": of.get("warc-record-id"), "type": of.get("warc-type"), "date": of.get("warc-date"), "target_uri": of.get("warc-target-uri"), "concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"],
        "refers_to": of.get("warc-refers-to"), "http": http, "fields": fields, "payload_bytes": size, "payload_digest": digest, "payload": payload,
    }


_ARROW = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("date", pa.string()), ("target_uri", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
    ("http", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])
_MOST = 8 << 20


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, stream, rows, held = None, Stream(), [], 0
    for batch in batches:
        for path, piece in zip(batch.column(1).to_pylist(), batch.column(0)):
            if path != name:
                name, stream = path, Stream()
            for headers, block in stream.feed(piece.as_py() + b"\r\n\r\n"):
                rows.append(_row(headers, block))
                held += len(block)
                if held > _MOST:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the gzip archives in a folder, one row each."""
    pieces = spark.read.schema("value string").option("lineSep", GAP).text(path)
    return pieces.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path")).mapInArrow(_parse, RECORD)


# --- assembly -----------------------------------------------------------------------------------------------------


def assemble(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One row a capture: (capture_id, target_uri, date, response, request, metadata), nested; response.refers_to names a record.

    ``payloads=False`` leaves the payload out, and so no payload is shuffled.
    """
    slim = cut(records.drop("payload"))
    main = F.col("type").isin("response", "revisit")
    primary = slim.filter(main)
    rest = slim.filter(~main & F.col("record_id").isNotNull()).groupBy("record_id").agg(F.first(F.struct("type", "date", "target_uri", "http", "fields")).alias("of"), F.flatten(F.collect_set("concurrent_to")).alias("concurrent_to"))
    rest = cut(rest)
    links = slim.select("record_id", F.explode("concurrent_to").alias("to")).filter("record_id IS NOT NULL").distinct()
    links = cut(links.unionByName(links.select(F.col("to").alias("record_id"), F.col("record_id").alias("to"))).distinct())
    captures = primary.select(F.col("record_id").alias("to")).distinct()
    found = near = cut(rest.select("record_id").join(links, "record_id").join(captures, "to", "left_semi").select("record_id", F.col("to").alias("capture")))
    while not near.isEmpty():  # records that name, or are named by, those that have found their capture, and so on
        reached = links.join(near.select(F.col("record_id").alias("to"), "capture"), "to").select("record_id", "capture").distinct()
        near = cut(reached.join(rest.select("record_id"), "record_id", "left_semi").join(found.select("record_id"), "record_id", "left_anti"))
        found = cut(found.unionByName(near))
    alone = rest.select("record_id").join(found, "record_id", "left_anti").select("record_id", F.col("record_id").alias("capture"))
    members = rest.join(found.unionByName(alone), "record_id")
    told = F.struct("record_id", "of.type", "of.date", "of.target_uri", "of.http", "of.fields")
    request = F.col("of.type") == "request"
    parts = members.groupBy("capture").agg(F.first(F.when(request, told), ignorenulls=True).alias("request"), F.collect_list(F.when(~request, told)).alias("metadata"))
    response = F.struct("record_id", "type", "refers_to", "http", "payload_bytes", "payload_digest", *(["payload"] if payloads else []))
    whole = (records if payloads else slim).filter(main).select(F.col("record_id").alias("id"), "date", "target_uri", response.alias("response"))
    rows = whole.join(parts, F.col("id") == F.col("capture"), "full")
    return rows.select(
        F.coalesce("id", "capture").alias("capture_id"),
        F.coalesce("target_uri", "request.target_uri", F.get("metadata", F.lit(0))["target_uri"]).alias("target_uri"),
        F.coalesce("date", "request.date", F.get("metadata", F.lit(0))["date"]).alias("date"),
        "response", "request", "metadata",
    )


def round_trip(pages: DataFrame, id_col: str = "page_id", payloads: bool = False, **columns) -> DataFrame:
    """The captures of ``pages``, written as archives into the shared folder, read back and assembled; with ``page_id`` and the
    ``page_id`` of the response that a revisit refers to."""
    spark = pages.sparkSession
    path = write(pages, shared_folder(spark), id_col, **columns)
    kind = pages.schema[id_col].dataType
    rows = cut(assemble(read(spark, path), payloads).withColumn("page_id", F.element_at(F.get("metadata", F.lit(0))["fields"], "page-id").cast(kind)))
    named = rows.filter(F.col("response.type") == "response").groupBy(F.col("capture_id").alias("named")).agg(F.min("page_id").alias("refers_to"))
    return rows.join(named, F.col("response.refers_to") == F.col("named"), "left").drop("named")
