from __future__ import annotations

import datetime
import json
import os
import random
import sqlite3
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from textloom.operators import attempts, discovery, embedding, indexes, metrics, packing
from textloom.operators.numbering import numbered
from textloom.plans.ingestion import Ingestion, convert
from textloom.sources import bulk, files, metadata, parsers, sinks, upserts
from textloom.streaming import ingest, progress, stateful

DOC = "# 标题\nThis is the text of the first section.\n## Results\nMore text. Even more text。\n# References\n[1] A first entry. [2] A second.\n"


def parser(content: bytes) -> str:
    if content.startswith(b"broken"):
        raise ValueError("no such format")
    return content.decode()


def meta(spark):
    return spark.createDataFrame([("1", "题目", "Title", "", "k", "", "", "10/x", "", "")], "lngid string, title_c string, title_e string, keyword_c string, keyword_e string, remark_c string, remark_e string, doi string, firstwriter string, showwriter string")


def test_run_twice_and_resume(spark, tmp_path):
    source, out = tmp_path / "in" / "sub", tmp_path / "out"
    source.mkdir(parents=True)
    (source / "temp_ab_1.pdf").write_text(DOC)
    (source.parent / "1.pdf").write_text(DOC + "again")  # the same id: the first path counts
    (source / "2.pdf").write_text("broken")
    (source / "3.pdf").write_text("text without a heading")
    (source / "4.PDF").write_text(DOC)
    job = Ingestion(str(tmp_path / "in"), str(out), parser=parser)
    row = job.run(spark, meta(spark)).first()
    assert (row.success, row.parse_failures, row.index_failures) == (1, 2, 0)
    assert (row.discovered, row.skipped, row.submitted, row.retried, row.parsed) == (4, 1, 3, 0, 2)
    assert row.counts.asDict() == {"title": 1, "abstract": 0, "keyword": 1, "fulltext": 1, "paragraph": 2, "sentence": 3, "reference": 2}
    index = sinks.read_index(spark, f"{out}/index")
    names = {r.index_name: r["count"] for r in index.groupBy("index_name").count().collect()}
    assert names == {"title": 1, "keyword": 1, "fulltext": 1, "paragraph": 2, "sentence": 3, "reference": 2}
    first = {r._id for r in index.collect()}
    assert index.filter("index_name = 'title'").first().text == "题目 Title" and all(r.doi == "10/x" for r in index.collect())
    row = job.run(spark, meta(spark)).first()  # done ones are skipped, failed ones tried once more
    assert (row.success, row.parse_failures, row.retries, row.retried) == (1, 4, 2, 2)
    row = job.run(spark, meta(spark)).first()  # given up
    assert (row.success, row.parse_failures, row.submitted) == (1, 4, 0)
    assert sorted(f.name for f in (out / "tasks").glob("version=*")) == ["version=1", "version=2", "version=3"]
    details = spark.read.json(f"{out}/errors").filter("error LIKE 'ValueError%'").collect()
    assert len(details) == 2 and all("Traceback" in r.traceback and "no such format" in r.traceback for r in details)
    assert {r._id for r in sinks.read_index(spark, f"{out}/index").collect()} == first
    job.compact(spark)
    assert {r._id for r in sinks.read_index(spark, f"{out}/index").collect()} == first and not list((out / "index").glob("version=*"))
    assert len(list((out / "failed").glob("*.csv"))) > 0
    for name, fields in indexes.FIELDS.items():
        rows = indexes.of_index(sinks.read_index(spark, f"{out}/index"), name)
        assert rows.columns == ["_id", *indexes.COMMON, *fields] and rows.count() == names.get(name, 0)


def test_bulk_is_part_of_success(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(6):
        (tmp_path / "in" / f"{k}.pdf").write_text(DOC)
    log = tmp_path / "requests"
    log.mkdir()

    def send(body: bytes) -> dict:
        lines = body.decode().splitlines()
        ids = [json.loads(x)["index"] for x in lines[::2]]
        if len(ids) > 4:
            raise packing.TooLarge("413")
        for x, source in zip(ids, lines[1::2]):
            (log / f"{x['_index']}-{x['_id']}").write_text(source)
        return {"took": 1, "errors": True, "items": [{"index": {"_id": x["_id"], **({"error": "no"} if x["_id"].startswith("3_p0_") else {})}} for x in ids]}

    job = Ingestion(str(tmp_path / "in"), str(tmp_path / "out"), parser=parser, send=send, prefix="papers_")
    row = job.run(spark, meta(spark)).first()
    assert (row.success, row.index_failures) == (5, 1)
    results = spark.read.parquet(f"{tmp_path}/out/bulk")
    told = packing.merged(results).first()
    assert told.errors and told.failed == 1 and told.first_failed._id == "3_p0_f0" and told.items == results.count() == len(list(log.iterdir())) and told.took > 1
    source = json.loads((log / "papers_title-1_title").read_text())
    assert list(source) == [*indexes.COMMON, *indexes.FIELDS["title"]] and source["title_text"] == "题目 Title" and source["doi"] == "10/x"


def test_bulk_requests_are_halved():
    seen = []

    def send(body):
        lines = body.splitlines()
        seen.append(len(lines))
        if len(lines) > 3 or b"bad" in lines and len(lines) > 1:
            raise OSError("reset")
        return {"took": 2, "errors": b"bad" in lines, "items": [{"index": {"error": "bad"} if x == b"bad" else {}} for x in lines]}

    lines = [b"bad\n" if k == 5 else b"%d\n" % k for k in range(16)]
    took, errors = packing.deliver(send, lines, 1 << 20)
    assert [k for k, e in enumerate(errors) if e] == [4, 5] and seen[0] == 16 and max(seen[1:]) == 8  # three times halved: pairs
    assert packing.deliver(send, [b"x\n"] * 40, 1 << 20)[1] == ["OSError: reset"] * 40


def test_time_limit_and_lost_processes(spark):
    def slow(content: bytes) -> str:
        if content == b"hang":
            time.sleep(60)
        if content == b"crash":
            os._exit(3)
        if content == b"raise":
            raise ValueError("bad file")
        return content.decode() * 50_000

    rows = spark.createDataFrame([(k, k.encode()) for k in ("good", "hang", "crash", "raise")], "path string, content binary").repartition(1)
    began = time.time()
    out = {r.path: r for r in files.parsed(rows, slow, timeout=2).collect()}
    assert time.time() - began < 30
    assert out["good"].markdown == "good" * 50_000 and out["good"].error is None
    assert "timeout" in out["hang"].error and "code 3" in out["crash"].error and "bad file" in out["raise"].error


def test_parser_shapes():
    make = lambda pages, kind: f"{kind}:{pages}" if kind == parsers.MARKDOWN else [kind, pages]
    results = parsers.from_results(lambda contents, langs, **o: ([["m"]], [["i"]], [contents[0]], langs, [o["formula"]]), lambda r, i, d, lang, ocr: {"pdf_info": f"{d.decode()}-{lang}-{ocr}"}, make, formula=True)
    assert results(b"x") == ("mm_markdown:x-ch-True", '["content_list", "x-ch-True"]', '{"pdf_info": "x-ch-True"}')

    def streaming(contents, lang_list, on_doc_ready):
        on_doc_ready(0, [], {"pdf_info": contents[0].decode() + lang_list[0]}, False)

    assert parsers.from_callback(streaming, make, "en")(b"y").markdown == "mm_markdown:yen"
    with pytest.raises(ValueError):
        parsers.from_callback(lambda *a, **b: None, make)(b"y")
    model = parsers.choose("vlm-http-client", results, lambda name: parsers.from_model(lambda c, backend: ({"pdf_info": backend}, None), make, name))
    assert model(b"z").markdown == "mm_markdown:http-client" and parsers.choose("pipeline", results, None) is results


def test_conversion_resumes_by_path(spark, tmp_path):
    for name, text in (("a/1.pdf", "one"), ("b/1.pdf", "two"), ("b/x [1].pdf", "three"), ("c.pdf", "broken")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(text)
    out = str(tmp_path / "out")

    def both(content: bytes) -> parsers.Output:
        return parsers.Output(parser(content), "[]", "{}")

    assert tuple(convert(spark, str(tmp_path / "in"), out, both).first()) == (3, 1)
    assert {(r.stem, r.value) for r in spark.read.parquet(f"{out}/markdown").collect()} == {("a/1", "one"), ("b/1", "two"), ("b/x [1]", "three")}
    assert spark.read.parquet(f"{out}/content_list").count() == spark.read.parquet(f"{out}/middle").count() == 3
    (tmp_path / "in" / "a" / "2.pdf").write_text("four")
    assert tuple(convert(spark, str(tmp_path / "in"), out, both).first()) == (1, 1)
    assert spark.read.parquet(f"{out}/markdown").count() == 4
    failed = "".join(f.read_text() for f in (tmp_path / "out" / "failed").glob("*.csv"))
    assert "c.pdf\tValueError: no such format" in failed


def test_metadata_from_sqlite(spark, tmp_path):
    path = str(tmp_path / "papers.db")
    with sqlite3.connect(path) as db:
        db.execute(f"CREATE TABLE meta (lngid TEXT, {', '.join(f'{c} TEXT' for c in indexes.META)})")
        db.executemany("INSERT INTO meta (lngid, title_c, doi) VALUES (?, ?, ?)", [(str(k), f"题 {k}", None if k % 3 else f"10/{k}") for k in range(101)])
    rows = metadata.from_sqlite(spark, path, partitions=7)
    assert rows.rdd.getNumPartitions() == 7 and {(r.lngid, r.title_c, r.doi) for r in rows.collect()} == {(str(k), f"题 {k}", None if k % 3 else f"10/{k}") for k in range(101)}
    told = {r.lngid: r for r in indexes.with_meta(spark.createDataFrame([("3",), ("4",), ("x",)], "lngid string"), rows).collect()}
    assert (told["3"].title_c, told["3"].doi, told["4"].doi, told["x"].title_c) == ("题 3", "10/3", "", "")
    with pytest.raises(Exception, match="no name of a table"):
        metadata.from_sqlite(spark, path, "meta; DROP").count()


def test_numbers_over_parts(spark):
    rows = [(k % 3 if k % 7 else None, k) for k in range(500)]
    df = numbered(spark.createDataFrame(rows, "g int, k int").repartition(4), ("g",), ("k",), F.floor(F.col("k") / 20))
    seen = {}
    for g, k in rows:
        seen[k] = sum(1 for h, j in rows if h == g and j <= k)
    assert {r.k: r.n for r in df.collect()} == seen


def test_failed_ones_come_first(spark):
    random.seed(4)
    rows = [(g, k, random.choice([True, False, None])) for g in (1, 2, None) for k in range(60)]
    df = spark.createDataFrame(rows, "g int, k int, again boolean").repartition(3)
    for bucket in (None, F.floor(F.col("k") / 7)):
        told = discovery.retry_first(df, F.col("again"), ("k",), ("g",), bucket)
        assert told.columns == ["g", "k", "again", "place"]
        for g in (1, 2, None):
            queue = sorted((x for x in rows if x[0] == g), key=lambda x: (not x[2], x[1]))
            assert [(r.k, r.place) for r in sorted((r for r in told.collect() if r.g == g), key=lambda r: r.place)] == [(x[1], n) for n, x in enumerate(queue, 1)]


def test_stream_reads_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.pdf").write_text(DOC)
    job = Ingestion(str(tmp_path / "in"), str(tmp_path / "out"), parser=parser)
    told: list[str] = []
    listener = progress.Progress(tell=told.append)
    spark.streams.addListener(listener)
    for _ in range(2):
        query = ingest.ingest(spark, job, meta(spark), str(tmp_path / "cp"), 2)
        query.awaitTermination()
        for _ in range(100):  # a listener hears of it a little later
            if told and "batches" in told[-1]:
                break
            time.sleep(0.1)
        assert told[-1] == ("3 files in 2 batches" if len(told) > 1 else "0 files in 0 batches")
        assert len(told) == 1 or [x.split(",")[0] for x in told[:-1]] == ["2 files begun", "3 files begun"]
        told.clear()
    spark.streams.removeListener(listener)
    row = job.finish(spark).first()
    assert (row.success, row.parse_failures) == (3, 0)
    status = files.status_log(spark, str(tmp_path / "out" / "status"))
    assert sorted(r.lngid for r in status.collect()) == ["0", "1", "2"]


def streamed(spark, data, tmp_path, parts=6):
    """The events as a stream of files in the order of time, one file a batch."""
    events = spark.read.parquet(f"{data}/events.parquet").toPandas().sort_values(["ts", "event_id"])
    folder, size = tmp_path / "log", len(events) // parts + 1
    folder.mkdir()
    for k in range(parts):
        path = str(folder / f"{k}.parquet")
        pq.write_table(pa.Table.from_pandas(events.iloc[k * size : (k + 1) * size], preserve_index=False).set_column(0, "event_id", pa.array(events.event_id.iloc[k * size : (k + 1) * size])), path, coerce_timestamps="us")
        os.utime(path, (1e9 + k, 1e9 + k))
    return spark.readStream.schema(spark.read.parquet(f"{data}/events.parquet").schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drained(rows, name, mode, tmp_path):
    query = rows.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
    query.awaitTermination()
    return rows.sparkSession.table(name)


def test_streamed_outcomes_are_those_of_the_log(spark, data, tmp_path):
    events, limit = spark.read.parquet(f"{data}/events.parquet"), 40_000.0
    begins, ends = F.col("event_type") == "click", F.col("event_type").isin("purchase", "error")
    told = stateful.outcomes(streamed(spark, data, tmp_path), "user_id", begins, ends, limit)
    stream = {(r.key, r.event_id, r.ts, r.outcome, round(r.seconds, 6)) for r in drained(told, "outcomes", "append", tmp_path).collect()}
    batch = attempts.outcomes(events, "user_id", begins, ends, limit).collect()
    assert len(batch) == events.filter(begins).count() and {r.outcome for r in batch} >= {"ended", "restarted", "timeout"}
    assert stream == {(str(r.user_id), r.event_id, r.ts, r.outcome, round(r.seconds, 6)) for r in batch if r.outcome != "open"}


def test_outcomes_of_attempts(spark):
    t = datetime.datetime(2024, 1, 1)
    log = [("a", 0, "b"), ("a", 5, "x"), ("a", 10, "e"), ("a", 20, "b"), ("a", 30, "b"), ("a", 91, "e"), ("a", 92, "e"), ("b", 80, "b"), (None, 1, "b"), (None, 61, "e"), ("c", 40, "b"), ("d", 3, "e"), ("d", 100, None)]
    rows = spark.createDataFrame([(w, k, t + datetime.timedelta(seconds=s), x) for k, (w, s, x) in enumerate(log)], "w string, event_id int, ts timestamp_ntz, kind string").repartition(3)
    for block in (1, 2, 1000):
        told = {(r.w, r.event_id): (r.outcome, r.seconds) for r in attempts.outcomes(rows, "w", F.col("kind") == "b", F.col("kind") == "e", 60, block=block).collect()}
        assert told == {("a", 0): ("ended", 10), ("a", 3): ("restarted", 10), ("a", 4): ("timeout", 60), ("b", 7): ("open", None), (None, 8): ("ended", 60), ("c", 10): ("open", None)}
    late = attempts.outcomes(rows, "w", F.col("kind") == "b", F.col("kind") == "e", 60, until=F.lit(t + datetime.timedelta(seconds=141)).cast("timestamp_ntz"))
    assert {r.w: r.outcome for r in late.collect() if r.event_id > 6 and r.w} == {"b": "timeout", "c": "timeout"}
    assert attempts.outcomes(rows.limit(0), "w", F.col("kind") == "b", F.col("kind") == "e", 60).count() == 0


def test_streamed_rates_over_batches(spark, data, tmp_path):
    rows = drained(stateful.recent_rates(streamed(spark, data, tmp_path), recent=7), "rates_of_batches", "update", tmp_path).collect()
    events = spark.read.parquet(f"{data}/events.parquet")
    ends = {r.event_type: round(r.rate, 4) for r in metrics.moving_rate(events, "event_type", recent=7).orderBy("ts", "event_id").collect()}
    last = {r.key: (r.n, round(r.rate, 4)) for r in sorted(rows, key=lambda r: r.n)}
    assert last == {r.event_type: (r.n, ends[r.event_type]) for r in events.groupBy("event_type").agg(F.count("*").alias("n")).collect()}


def test_stream_begins_each_id_once(spark, tmp_path):
    """Copies of an id in one batch and in a later one; ids that an earlier run has done, given up, or failed once."""
    (tmp_path / "in" / "b").mkdir(parents=True)
    for k, name in enumerate(["b/1.pdf", "temp_ab_1.pdf", "1.pdf", "2.pdf", "3.pdf", "4.pdf", "b/2.pdf"]):
        (tmp_path / "in" / name).write_text(DOC)
        os.utime(tmp_path / "in" / name, (1e9 + k, 1e9 + k))
    job = Ingestion(str(tmp_path / "in"), str(tmp_path / "out"), parser=parser)
    t = datetime.datetime(2024, 1, 1)
    log = [("2", "success", None, 1, None, "x", t), ("3", "failure", "parse", 2, "no", "x", t), ("4", "failure", "parse", 1, "no", "x", t)]
    sinks.append_status(spark.createDataFrame(log, files.STATUS), job.at("status"))
    ingest.ingest(spark, job, meta(spark), str(tmp_path / "cp"), 2).awaitTermination()
    tasks = [(r.lngid, os.path.basename(r.path), r.attempt) for r in spark.read.parquet(f"{tmp_path}/out/tasks").collect()]
    assert sorted(tasks) == [("1", "1.pdf", 1), ("4", "4.pdf", 2)] and any(r.path.endswith("b/1.pdf") for r in spark.read.parquet(f"{tmp_path}/out/tasks").collect())
    row = job.finish(spark).first()
    assert (row.success, row.parse_failures, row.retries) == (3, 2, 2)
    # a run after the stream, and a stream after that, take new versions
    (tmp_path / "in" / "9.pdf").write_text(DOC)
    assert job.run(spark, meta(spark)).first().submitted == 1
    (tmp_path / "in" / "10.pdf").write_text(DOC)
    ingest.ingest(spark, job, meta(spark), str(tmp_path / "cp2"), 100).awaitTermination()
    assert {r.file_id for r in sinks.read_index(spark, job.at("index")).collect()} == {"1", "4", "9", "10"}
    assert job.first_version(spark, str(tmp_path / "cp")) < job.first_version(spark, str(tmp_path / "cp2"))


def test_streamed_rates(spark, data):
    schema = spark.read.parquet(f"{data}/events.parquet").schema
    stream = stateful.recent_rates(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(data))
    query = stream.writeStream.format("memory").queryName("rates").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    events = spark.read.parquet(f"{data}/events.parquet")
    told = {r.key: (r.n, round(r.rate, 4)) for r in spark.table("rates").collect()}
    last = metrics.moving_rate(events, "event_type").groupBy("event_type").agg({"*": "count"}).collect()
    assert {r.event_type: r["count(1)"] for r in last} == {k: v[0] for k, v in told.items()}
    ends = {r.event_type: round(r.rate, 4) for r in metrics.moving_rate(events, "event_type").orderBy("ts", "event_id").collect()}
    assert ends == {k: v[1] for k, v in told.items()}


def test_status_log_skips_broken_lines(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"lngid":"a","status":"success","timestamp":"2024-01-01T00:00:01"}\n\n{broken\n{"status":"failure"}\n{"lngid":"a","status":"failure","attempt":1,"timestamp":"2024-01-01T00:00:02"}\n')
    last = discovery.last_status(files.status_log(spark, str(tmp_path)))
    assert [(r.lngid, r.status) for r in last.collect()] == [("a", "failure")]


def test_embedding_halves_refused_batches(spark):
    def model(texts):
        if len(texts) > 3:
            raise RuntimeError("413")
        if "bad" in texts:
            raise RuntimeError("refused")
        return embedding.hashed(texts)

    rows = [(k, "bad" if k == 5 else "" if k == 7 else f"t{k}") for k in range(20)]
    out = embedding.embedded(spark.createDataFrame(rows, "k int, text string").coalesce(1), model).collect()
    assert [r.k for r in out if r.vector is None] == [5, 7]
    assert [r.vector_error for r in out if r.k in (5, 7)] == ["refused", None]


def greedy(rows, max_count, max_bytes):
    """Batches of (group, order, bytes), one row after the other."""
    told, state = {}, {}
    for g, k, n in sorted(rows, key=lambda x: x[1]):
        if (n or 0) > max_bytes:
            told[g, k] = -1
            continue
        batch, count, used = state.get(g, (0, 0, 0))
        if count and (count >= max_count or used + (n or 0) > max_bytes):
            batch, count, used = batch + 1, 0, 0
        state[g] = batch, count + 1, used + (n or 0)
        told[g, k] = batch
    return told


@pytest.mark.parametrize("block, fan, max_count", [(10_000, 1000, 7), (8, 3, 7), (5, 2, 5), (1, 2, 3), (40, 1000, 1)])
def test_packing(spark, block, fan, max_count):
    random.seed(block)
    sizes = [(g, k, random.choice([10, 200, 500, 2000, 0, None])) for g in (0, 1, None) for k in range(200)]
    sizes += [(7, 0, 3000), (8, 1, 5)]
    df = packing.packed(spark.createDataFrame(sizes, "g int, k int, bytes long").repartition(3), "g", "k", "bytes", max_count, 1000, F.floor(F.col("k") / 16), block, fan)
    assert df.columns == ["g", "k", "bytes", "batch"]
    assert {(r.g, r.k): r.batch for r in df.collect()} == greedy(sizes, max_count, 1000)
    assert packing.packed(df.drop("batch").limit(0), "g", "k", "bytes").count() == 0


def test_crash_streaks(spark):
    t = datetime.datetime(2024, 1, 1)
    at = [0, 10, 20, 30, 40, 200, 210]
    df = spark.createDataFrame([(k, "w", t + datetime.timedelta(seconds=s)) for k, s in enumerate(at)], "event_id int, w string, ts timestamp_ntz")
    rows = metrics.crash_streaks(df, "w").orderBy("event_id").collect()
    assert [r.crash_count for r in rows] == [0, 1, 2, 3, 4, 0, 1] and [r.disabled for r in rows] == [False] * 4 + [True] * 3
    df = df.withColumn("w", F.lit(None).cast("string"))  # a null key is a key
    assert [r.crash_count for r in metrics.crash_streaks(df, "w", block=2, unit="minute").orderBy("event_id").collect()] == [0, 1, 2, 3, 4, 0, 1]


def test_crash_streaks_over_blocks(spark):
    random.seed(5)
    t, rows, seen = datetime.datetime(2024, 1, 1), [], {}
    for w in ("a", "b", None):
        at, count, gone = 0, 0, False
        for k in range(300):
            step = random.choice([0, 1, 5, 59, 60, 61, 4000])
            at, count = at + step, count + 1 if k and step < 60 else 0
            gone = gone or count > metrics.MAX_STREAK
            rows.append((k, w, t + datetime.timedelta(seconds=at)))
            seen[w, k] = count, gone
    df = spark.createDataFrame(rows, "event_id int, w string, ts timestamp_ntz").repartition(3)
    for block in (1, 7, 10_000):
        assert {(r.w, r.event_id): (r.crash_count, r.disabled) for r in metrics.crash_streaks(df, "w", block=block).collect()} == seen


def test_upserts_and_compaction(spark, tmp_path):
    random.seed(2)
    table, truth = upserts.Upserts(str(tmp_path / "index"), 4), {}

    def write(version, n):
        mine = {(random.choice(["title", "sentence"]), f"d{random.randrange(40)}"): f"{version}" for _ in range(n)}
        truth.update(mine)
        table.write(spark.createDataFrame([(i, k, v, [float(version)]) for (i, k), v in mine.items()], "index_name string, _id string, text string, vector array<float>"), version)

    def same():
        rows = table.read(spark)
        assert set(rows.columns) == {"index_name", "_id", "text", "vector"}
        assert {(r.index_name, r._id): r.text for r in rows.collect()} == truth and rows.count() == len(truth)

    with pytest.raises(FileNotFoundError):
        table.read(spark)
    for version in (0, 1, 2):
        write(version, 20)
    same()
    assert table.compact(spark) == 1 and table.compact(spark) == 1  # nothing to merge the second time
    same()
    write(3, 1)  # one bucket
    same()
    assert table.compact(spark) == 2
    same()
    held = table._held(spark)[2]
    assert sorted(held.values()).count(2) == 1 and 1 in held.values()
    write(4, 30)
    assert set(table.vacuum(spark)) == {"version=0", "version=1", "version=2", "version=3", "_manifest/generation=1"}
    same()
    (tmp_path / "index" / "_base" / "generation=3").mkdir()  # a merge that was cut off
    same()
    assert table.compact(spark) == 3
    table.vacuum(spark)
    same()


def test_bulk_sink(spark, tmp_path):
    seen = tmp_path / "requests"
    seen.mkdir()

    def send(body: bytes) -> dict:
        ids = [json.loads(x)["index"]["_id"] for x in body.decode().splitlines()[::2]]
        if "down" in ids:
            raise OSError("reset")
        (seen / f"{ids[0]}-{len(ids)}").write_text("")
        return {"took": 3, "errors": True, "items": [{"index": {"_id": x, **({"error": "no"} if x.endswith("9") else {})}} for x in ids]}

    def lines(ids):
        rows = spark.createDataFrame([(x,) for x in ids], "_id string")
        return rows.select("_id", packing.ndjson(F.lit("title"), F.col("_id"), F.struct(F.lit("x").alias("text"))).alias("line"))

    spark.dataSource.register(bulk.sink(send, "bulk", max_count=10))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        lines([f"d{k}" for k in range(95)]).coalesce(1).write.format("bulk").mode("append").option("log", str(tmp_path / "log")).save()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    told = json.loads("".join(f.read_text() for f in (tmp_path / "log").glob("*.json")))
    assert sorted(int(f.name.split("-")[1]) for f in seen.iterdir()) == [5] + [10] * 9  # batches of 7 rows part no request
    assert (told["state"], told["took"], told["errors"], told["items"], told["failed"], told["more"]) == ("committed", 30, True, 95, 9, 4)
    assert told["first_failed"] == [["d19", "no"], ["d29", "no"], ["d39", "no"], ["d49", "no"], ["d59", "no"]]
    lines(["a", "down"]).coalesce(1).write.format("bulk").mode("append").option("log", str(tmp_path / "refused")).save()
    told = json.loads("".join(f.read_text() for f in (tmp_path / "refused").glob("*.json")))
    assert (told["items"], told["failed"], told["first_failed"]) == (2, 1, [["down", "OSError: reset"]])  # halved, so "a" went through
    # a write that fails as a whole
    broken = lines(["b", "c"]).withColumn("line", F.when(F.col("_id") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="lost"):
        broken.coalesce(1).write.format("bulk").mode("append").option("log", str(tmp_path / "aborted")).save()
    assert json.loads("".join(f.read_text() for f in (tmp_path / "aborted").glob("*.json")))["state"] == "aborted"


def test_bulk_sink_of_a_stream(spark, tmp_path):
    def send(body: bytes) -> dict:
        return {"took": 1, "items": [{"index": {}} for _ in body.splitlines()[::2]]}

    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text("".join(json.dumps({"_id": f"{k}-{j}", "line": f"{{}}\n{{}}\n"}) + "\n" for j in range(3)))
    spark.dataSource.register(bulk.sink(send, "bulk_stream"))
    rows = spark.readStream.schema("_id string, line string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    rows.writeStream.format("bulk_stream").option("log", str(tmp_path / "log")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    told = [json.loads(f.read_text()) for f in (tmp_path / "log").glob("*.json")]
    assert sorted((x["batch"], x["items"], x["state"]) for x in told) == [(0, 3, "committed"), (1, 3, "committed")]


def test_learned_batch_is_known_to_the_next_job(spark):
    sizes = spark.sparkContext.accumulator(0)

    def model(texts):
        sizes.add(1)
        if len(texts) > 20:
            raise RuntimeError("413")
        if "bad" in texts and len(texts) == 1:
            raise RuntimeError("refused")
        return embedding.hashed(texts)

    rows = spark.createDataFrame([(k, "bad" if k == 3 else f"t{k}") for k in range(256)], "k int, text string").repartition(2)
    learned = embedding.Learned(spark)
    assert learned.value == 64
    embedding.embedded(rows, model, learned=learned).write.format("noop").mode("overwrite").save()
    assert learned.value == 16
    sizes.value = 0
    out = embedding.embedded(rows, model, learned=learned)
    out.write.format("noop").mode("overwrite").save()
    assert sizes.value == 16 and learned.value == 16  # no batch is refused any more


def test_parsed_by_device(spark):
    rows = spark.createDataFrame([("a", b"x"), ("b", b"broken"), ("c", b"y")], "path string, content binary")
    assert [tuple(r) for r in metrics.parsed_by_device(files.parsed(rows, parser)).collect()] == [("cpu", 2)]


def test_slots_and_arguments():
    assert discovery.slots_of("0,1", "2,1") == [0, 0, 1] and discovery.slots_of("0,1", "2") == [0, 0, 1, 1]
    for bad in (("0,0", "1"), ("", "1"), ("0,1", "1,2,3"), ("0", "0")):
        with pytest.raises(ValueError):
            discovery.slots_of(*bad)
    with pytest.raises(ValueError):
        Ingestion("a", "b", max_attempts=0)
    with pytest.raises(ValueError):
        Ingestion("a", "b", paragraphs="page")
