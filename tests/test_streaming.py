"""Run-once drains on a file source (T1-T6, K5, K17) and topic options
(S6-S8, K4).  No broker is available here, so topics are exercised only
through the options they would be given."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewater.plans import messages
from tidewater.sources import topic
from tidewater.streaming import drain

from conftest import SF_SMALL

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def test_drain_once_then_rerun_adds_nothing(spark, tmp_dir):
    sdf = drain.file_stream(spark, SF_SMALL, EVENTS, glob="events.parquet")
    values = sdf.select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    first = drain.drain_to_table(messages.message_values(values), "drained_events", out, ckpt)
    n = first.count()
    batch = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert n == batch.count()
    # batch result equals stream result
    flat = spark.sql("SELECT get_json_object(value, '$.event_id') AS id FROM drained_events")
    assert sorted(int(r.id) for r in flat.collect()) == sorted(r.event_id for r in batch.collect())
    drain.drain_to_files(messages.message_values(values), out, ckpt)
    assert spark.read.parquet(out).count() == n


def test_stream_text_writes_lines(spark, tmp_dir):
    sdf = drain.file_stream(spark, SF_SMALL, "conv_id BIGINT, turn BIGINT, role STRING, text STRING", glob="conversations.parquet")
    values = sdf.select(F.to_json(F.struct("conv_id", "turn", "text")).alias("value"))
    messages.stream_text(values, f"{tmp_dir}/o", f"{tmp_dir}/c", f"{tmp_dir}/lines", view="text_msgs")
    lines = spark.read.text(f"{tmp_dir}/lines")
    assert lines.count() == spark.read.parquet(f"{SF_SMALL}/conversations.parquet").count()
    with pytest.raises(Exception):
        messages.stream_text(values, f"{tmp_dir}/o", f"{tmp_dir}/c", f"{tmp_dir}/lines", view="text_msgs")


def test_topic_options():
    sec = topic.topic_security("user1", "s3cret")
    assert sec["kafka.security.protocol"] == "SASL_SSL" and sec["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert 'username="user1"' in sec["kafka.sasl.jaas.config"] and sec["kafka.sasl.jaas.config"].endswith(";")
    read = topic.topic_options("broker:9091", "t", sec)
    assert read["subscribe"] == "t" and read["startingOffsets"] == "earliest" and "topic" not in read
    write = topic.topic_options("broker:9091", "t", sec, subscribe=False)
    assert write["topic"] == "t" and "subscribe" not in write and "startingOffsets" not in write
    assert "maxOffsetsPerTrigger" not in read
    assert topic.topic_options("broker:9091", "t", max_offsets_per_batch=500000)["maxOffsetsPerTrigger"] == "500000"


def test_topic_source_needs_connector(spark):
    # The connector jar is not bundled: the read fails cleanly.
    with pytest.raises(Exception):
        topic.read_topic(spark, topic.topic_options("localhost:1", "t")).schema


def test_drain_timeout_stops_and_rerun_completes(spark, tmp_dir):
    sdf = drain.file_stream(spark, SF_SMALL, EVENTS, glob="events.parquet")
    values = messages.message_values(sdf.select(F.to_json(F.struct("event_id")).alias("value")))
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    with pytest.raises(TimeoutError):
        drain.drain_to_files(values, out, ckpt, timeout=0.001)
    assert not any(q.isActive for q in spark.streams.active)
    drain.drain_to_files(values, out, ckpt)
    got = sorted(r.value for r in spark.read.parquet(out).collect())
    want = sorted(r.value for r in spark.read.parquet(f"{SF_SMALL}/events.parquet").select(F.to_json(F.struct("event_id")).alias("value")).collect())
    assert got == want


def test_send_jobs_hand_json_values_to_the_topic_writer(spark, monkeypatch):
    import json

    sent = []
    monkeypatch.setattr(messages, "write_topic", lambda df, options: sent.append((df, options)))
    opts = topic.topic_options("broker:9093", "loans", subscribe=False)
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id BIGINT, name STRING")
    messages.send_rows(rows, opts)
    messages.send_nested(rows, {"application": {"id": "id"}, "who": "name"}, opts)
    (flat, o1), (nested, o2) = sent
    assert o1 == o2 == opts and flat.columns == ["value"] and nested.columns == ["value"]
    assert sorted(json.loads(r.value)["id"] for r in flat.collect()) == [1, 2]
    docs = sorted((json.loads(r.value) for r in nested.collect()), key=lambda d: d["application"]["id"])
    assert docs == [{"application": {"id": 1}, "who": "a"}, {"application": {"id": 2}}]
