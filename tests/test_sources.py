from pathlib import Path
from types import SimpleNamespace

import pytest
from helpers import envelope, tuples

from pagetide.operators.normalize import accepted, parse_envelope, rejected
from pagetide.session import scratch_folder
from pagetide.plans.queries import QUERIES
from pagetide.sources.event_table import stream_events
from pagetide.sources.frames import frame_messages, sse_frames
from pagetide.sources.messages import PATIENT, file_messages, kafka_raw
from pagetide.streaming.jobs import normalized_messages, start_normalize_to_kafka

FRAMES = (
    ":ok\n\n"
    "event: message\nid: [1]\ndata: {\"a\":1}\n\n"
    "event: other\ndata: no\n\n"
    "data: untyped\n\n"
    "event:message\ndata:two\ndata: lines\n\n"
    "event: message\nid: 3\n\n"
    "\n\n"
    "database: no\ndata: odd text\n\n"
    "event: first\nevent: message\r\ndata: crlf\r\n\n"
)


@pytest.mark.parametrize("streaming", [False, True])
def test_frames(spark, tmp_path, streaming):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "feed.sse").write_bytes(FRAMES.encode())
    frame = sse_frames(spark, str(tmp_path / "in"), streaming)
    if streaming:
        stream = frame.writeStream.format("memory").queryName("frames")
        stream.trigger(availableNow=True).start().awaitTermination()
        frame = spark.table("frames")
    assert tuples(frame.select("value")) == sorted(
        [('{"a":1}',), ("untyped",), ("two\nlines",), ("odd text",), ("crlf",)], key=str
    )
    assert [row.id for row in frame.filter("id is not null").collect()] == ["[1]"]


def test_frames_to_events(spark, tmp_path):
    good = envelope()
    half = len(good) // 2
    split_at = good.index(", ", half) + 1
    text = (
        f"event: message\ndata: {good[:split_at]}\ndata: {good[split_at:]}\n\n"
        "event: message\ndata: broken\n\n"
    )
    (tmp_path / "feed.sse").write_text(text)
    decoded = parse_envelope(sse_frames(spark, str(tmp_path)))
    assert accepted(decoded).first().page_id == 3_000_000_000
    assert tuples(rejected(decoded), "value") == [("broken",)]


def test_crlf_feed(spark, tmp_path):
    (tmp_path / "feed.sse").write_bytes(b"data: a\r\n\r\nevent: message\r\ndata: b\r\n\r\n")
    frame = sse_frames(spark, str(tmp_path), separator="\r\n\r\n")
    assert tuples(frame.select("value")) == [("a",), ("b",)]


def test_file_messages(spark, tmp_path):
    (tmp_path / "m.txt").write_text(envelope() + "\nnope\n")
    decoded = parse_envelope(file_messages(spark, str(tmp_path)))
    assert accepted(decoded).count() == 1


class Recorder:
    """Stands in for a reader or writer, since no topic connector is at hand."""

    def __init__(self, end):
        self.calls, self.end = {}, end

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def options(self, **settings):
        self.calls.update(settings)
        return self

    def trigger(self, **settings):
        self.calls["trigger"] = settings
        return self

    def load(self):
        return self.end

    def start(self):
        return self.end


@pytest.mark.parametrize("streaming", [False, True])
def test_kafka_source_options(spark, streaming):
    rows = spark.sql(
        "SELECT CAST('x' AS BINARY) AS value, id AS offset, 0 AS partition,"
        " timestamp_millis(1000 + id DIV 2) AS timestamp FROM range(4)"
    )
    reader = Recorder(rows)
    fake = SimpleNamespace(read=reader, readStream=reader)
    frame = kafka_raw(
        fake, "k:9092", "processed", min_partitions=12, options=PATIENT, streaming=streaming
    )
    assert frame.columns == ["value", "seq"]
    order = [row.seq for row in frame.collect()]
    assert order == sorted(set(order))
    assert reader.calls == {
        "format": "kafka",
        "kafka.bootstrap.servers": "k:9092",
        "subscribe": "processed",
        "startingOffsets": "latest" if streaming else "earliest",
        "minPartitions": "12",
        "kafka.request.timeout.ms": "6000",
        "kafka.session.timeout.ms": "6000",
    }


def test_kafka_sink_options(spark, monkeypatch):
    writer = Recorder("query")
    out = SimpleNamespace(writeStream=writer)
    monkeypatch.setattr("pagetide.streaming.jobs.normalized_messages", lambda m, **t: out)
    assert start_normalize_to_kafka(None, "k:9092", "/check") == "query"
    assert writer.calls["format"] == "kafka"
    assert writer.calls["kafka.bootstrap.servers"] == "k:9092"
    assert writer.calls["checkpointLocation"] == "/check"


def test_outgoing_messages_are_keyed_by_page(spark):
    rows = spark.createDataFrame([(envelope(page_id=42), 1), ("nope", 2)], "value string, seq bigint")
    sent = normalized_messages(rows).orderBy("topic").collect()
    assert [(row.topic, row.key) for row in sent] == [("processed", "42"), ("rejected", None)]


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark, "x").startswith(base + "/")
    conf = SimpleNamespace(get=lambda key, default: None)
    none = SimpleNamespace(isDefined=lambda: False)
    inner = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(SimpleNamespace(conf=conf, _jsc=inner), "x")


def test_running_a_query_again_removes_its_earlier_copies(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir"))

    def copies():
        return set(base.glob("pagetide-sse_to_views-*"))

    QUERIES["sse_to_views"](spark, "/root/testdata/sf0.001").collect()
    first = copies()
    QUERIES["sse_to_views"](spark, "/root/testdata/sf0.001").collect()
    assert len(copies()) == len(first) == 1 and copies() != first


def test_crlf_frames(spark, tmp_path):
    frame = "event: message\r\nid: {0}\r\ndata: {{\"page_id\": {0}}}\r\n\r\n"
    (tmp_path / "f.txt").write_bytes("".join(frame.format(i) for i in range(5)).encode())
    for options in ({}, {"separator": "\r\n\r\n"}):
        messages = sse_frames(spark, str(tmp_path), **options)
        assert sorted(row.value for row in messages.collect()) == [
            f'{{"page_id": {i}}}' for i in range(5)
        ]


def test_stream_reads_the_table_only(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for name in ("events.parquet", "events.parquet.bak"):
        rows.limit(3).write.parquet(str(tmp_path / name))
    stream = stream_events(spark, str(tmp_path))
    query = stream.writeStream.format("memory").queryName("only").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("only").count() == 3


def test_fields_of_a_frame_end_with_their_lines(spark):
    """One carriage return at the end of a line is not part of it; others are."""
    text = "event\r\nid:\r\nid: 1 \r2\r\r\ndata\ndata:  a\r\ndata: \r\ndata:b"
    frames = spark.createDataFrame([(text,), ("datax: 1\nid: 4",)], "value string")
    assert [tuple(row) for row in frame_messages(frames).collect()] == [("1 \r2\r", "\n a\n\nb")]
    plan = frame_messages(frames)._jdf.queryExecution().optimizedPlan().toString()
    # Each field is taken once.
    assert plan.count("regexp_extract_all(") == 3
