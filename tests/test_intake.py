"""Intake: two layouts, registry read per batch, replay, batch log."""

import json
import os
import struct

import pytest
from pyspark.sql import functions as F

from lumenlog.sources.stream import read_wire_files
from lumenlog.streaming import intake as IN
from lumenlog.streaming import jobs as ST
from lumenlog.streaming.batchlog import BatchLog, drain, read_batch_log
from test_streaming import NOW, framed, land, ts


def second(ts_, level, message="m", schema=2):
    return b"\x00" + struct.pack(">I", schema) + json.dumps({"time": ts_, "severity": level, "text": message}).encode()


def register(spark, path, *rows):
    spark.createDataFrame(list(rows), IN.REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, root):
    q = IN.start_intake(read_wire_files(spark, f"{root}/in", max_files_per_trigger=1), f"{root}/out", f"{root}/registry", f"{root}/ck", trigger=NOW)
    q.awaitTermination()


def messages(df):
    return sorted(r.message for r in df.collect())


def test_layouts_quarantine_and_a_schema_registered_meanwhile(spark, tmp_dir):
    register(spark, f"{tmp_dir}/registry", (1, "v1"))
    land(f"{tmp_dir}/in", [[framed(ts(1), "ERROR", "a"), second(ts(2), "INFO", "b"), framed("nope", "INFO", "c"), b"\x00\x00", None, framed(ts(3), None, "d")]])
    run(spark, tmp_dir)
    assert messages(IN.read_valid(spark, f"{tmp_dir}/out")) == ["a"]
    bad = sorted((r.reason, r.message or "") for r in IN.read_quarantine(spark, f"{tmp_dir}/out").collect())
    assert bad == [("missing_event_time", "c"), ("missing_level", "d"), ("unknown_schema", ""), ("unreadable", ""), ("unreadable", "")]
    register(spark, f"{tmp_dir}/registry", (2, "v2"))
    land(f"{tmp_dir}/in", [[second(ts(4), "INFO", "e, Service: node-1")]], first=50)
    run(spark, tmp_dir)
    assert [(r.message, r.service, r.version) for r in IN.read_valid(spark, f"{tmp_dir}/out").orderBy("event_time").collect()] == [("a", None, "v1"), ("e, Service: node-1", "node-1", "v2")]
    assert messages(IN.redecoded(spark, f"{tmp_dir}/out", f"{tmp_dir}/registry")) == ["b"]
    assert sorted(tuple(r) for r in IN.read_batches(spark, f"{tmp_dir}/out").collect()) == [(1, 1, 0, 0, 1), (6, 1, 5, 1, 0)]


def test_registry_is_read_in_every_batch_of_one_run(spark, tmp_dir):
    """The second batch of the same query knows what was registered after the first."""
    registry = f"{tmp_dir}/registry"
    register(spark, registry, (1, "v1"))
    land(f"{tmp_dir}/in", [[second(ts(1), "INFO", "early")], [second(ts(2), "INFO", "later")]])
    write = IN.batch_writer(f"{tmp_dir}/out", registry)

    def handle(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 0:
            register(spark, registry, (2, "v2"))

    q = read_wire_files(spark, f"{tmp_dir}/in", max_files_per_trigger=1).writeStream.foreachBatch(handle).option("checkpointLocation", f"{tmp_dir}/ck").trigger(**NOW).start()
    q.awaitTermination()
    assert messages(IN.read_valid(spark, f"{tmp_dir}/out")) == ["later"]


def test_replayed_batch_leaves_every_row_once(spark, tmp_dir):
    register(spark, f"{tmp_dir}/registry", (1, "v1"))
    batch = spark.createDataFrame([(b"k", bytearray(v)) for v in (framed(ts(1), "INFO", "a"), second(ts(2), "INFO", "b"), b"bad")], "key binary, value binary")
    handle = IN.batch_writer(f"{tmp_dir}/out", f"{tmp_dir}/registry")
    handle(batch, 0)
    handle(batch, 0)
    assert (messages(IN.read_valid(spark, f"{tmp_dir}/out")), IN.read_quarantine(spark, f"{tmp_dir}/out").count()) == (["a"], 2)
    register(spark, f"{tmp_dir}/registry", (2, "v2"))      # the replay sees a newer registry: a row changes its table
    handle(batch, 0)
    assert (messages(IN.read_valid(spark, f"{tmp_dir}/out")), IN.read_quarantine(spark, f"{tmp_dir}/out").count()) == (["a", "b"], 1)


def test_unpublished_batch_is_not_read(spark, tmp_dir):
    register(spark, f"{tmp_dir}/registry", (1, "v1"))
    batch = spark.createDataFrame([(b"k", bytearray(framed(ts(1), "INFO", "a")))], "key binary, value binary")
    handle = IN.batch_writer(f"{tmp_dir}/out", f"{tmp_dir}/registry")
    assert IN.read_valid(spark, f"{tmp_dir}/out").count() == 0 and IN.read_batches(spark, f"{tmp_dir}/out").count() == 0
    handle(batch, 0)
    handle(batch, 1)
    os.rename(f"{tmp_dir}/out/batches/batch_id=1", f"{tmp_dir}/cut-off")       # cut off between the rows and the line
    assert IN.read_valid(spark, f"{tmp_dir}/out").count() == 1


def test_empty_batch(spark, tmp_dir):
    register(spark, f"{tmp_dir}/registry", (1, "v1"))
    IN.batch_writer(f"{tmp_dir}/out", f"{tmp_dir}/registry")(spark.createDataFrame([], "key binary, value binary"), 0)
    assert [tuple(r) for r in IN.read_batches(spark, f"{tmp_dir}/out").collect()] == [(0, 0, 0, 0, 0)]


def test_alerts_over_two_layouts(spark, tmp_dir):
    register(spark, f"{tmp_dir}/registry", (1, "v1"), (2, "v2"))
    land(f"{tmp_dir}/in", [[framed(ts(1, 1), "ERROR"), second(ts(1, 2), "ERROR"), second(ts(1, 3), "ERROR"), second(ts(1, 4), "ERROR", schema=9)]])
    incidents = ST.incident_stream(read_wire_files(spark, f"{tmp_dir}/in"), registry=IN.read_registry(spark, f"{tmp_dir}/registry"))
    q = ST.start_alert_sink(incidents, f"{tmp_dir}/alerts", f"{tmp_dir}/ck", trigger=NOW)
    q.awaitTermination()
    assert [r["count"] for r in ST.final_alerts(spark, f"{tmp_dir}/alerts").collect()] == [3]


@pytest.fixture()
def log(spark, tmp_dir):
    listener = BatchLog(spark, f"{tmp_dir}/log", {"alerts", "rows"})
    spark.streams.addListener(listener)
    yield f"{tmp_dir}/log"
    spark.streams.removeListener(listener)


def test_batch_log(spark, tmp_dir, log):
    land(f"{tmp_dir}/in", [
        [framed(ts(1, s), "ERROR") for s in (1, 2, 3)],
        [framed(ts(20), "INFO")],
        [framed(ts(21), "INFO"), framed(ts(22), "INFO")],
        [framed(ts(2), "ERROR", "late")],
    ])
    def start(name):
        incidents = ST.incident_stream(read_wire_files(spark, f"{tmp_dir}/in", max_files_per_trigger=1))
        if name == "rows":
            return ST.start_enriched_sink(incidents, f"{tmp_dir}/rows", f"{tmp_dir}/ck-rows", trigger=NOW, query_name=name)
        return ST.start_alert_sink(incidents, f"{tmp_dir}/alerts", f"{tmp_dir}/ck-alerts", trigger=NOW, query_name=name)

    for name in ("alerts", "rows", "other"):
        start(name).awaitTermination()
    drain(spark)
    lines = read_batch_log(spark, log)
    assert {r["query"]: r.n for r in lines.groupBy("query").agg(F.sum("rows_in").alias("n")).collect()} == {"alerts": 7, "rows": 7}
    assert lines.where("query = 'rows'").agg(F.sum("rows_observed")).first()[0] == 7
    assert lines.where("query = 'alerts'").agg(F.sum("late_rows")).first()[0] == 1
    assert [r.rows_in for r in lines.where("query = 'alerts'").orderBy("batch_id").collect()] == [3, 1, 2, 1]
    land(f"{tmp_dir}/in", [[framed(ts(23), "INFO")]], first=50)
    start("alerts").awaitTermination()         # goes on where it stopped: a new line, none twice
    drain(spark)
    again = read_batch_log(spark, log).where("query = 'alerts'")
    assert again.count() == 5 and again.agg(F.sum("rows_in")).first()[0] == 8
