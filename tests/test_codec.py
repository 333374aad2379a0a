"""Wire codec: hand-written framed / plain cases and the round trip."""

import datetime as dt
import json
import os
import struct

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from lumenlog.sources import codec as CD
from lumenlog.sources.fixtures import load_incidents


def framed(body: bytes, schema_id: int = 1, magic: bytes = b"\x00") -> bytes:
    return magic + struct.pack(">I", schema_id) + body


def ev(ts, level="ERROR", message="m"):
    return json.dumps({"timestamp": ts, "level": level, "message": message}).encode()


def wire(spark, values):
    return spark.createDataFrame([(b"k", v) for v in values], "key binary, value binary")


def test_framed_cases(spark):
    vals = [
        framed(ev("2024-01-01T00:00:01.123456+00:00")),   # micros
        framed(ev("2024-01-01T02:00:01+02:00")),          # no micros, other offset
        framed(b"{bad"),                                  # malformed body
        framed(ev("nope")),                               # bad time
        b"abc",                                           # short value
        None,                                             # null value
    ]
    got = rows(CD.decode_framed(wire(spark, vals)))
    assert got[0] == (dt.datetime(2024, 1, 1, 0, 0, 1, 123456), "ERROR", "m")
    assert got[1] == (dt.datetime(2024, 1, 1, 0, 0, 1), "ERROR", "m")
    assert got[2] == (None, None, None)
    assert got[3] == (None, "ERROR", "m")
    assert got[4] == (None, None, None)
    assert got[5] == (None, None, None)


def test_frame_parts_and_magic(spark):
    vals = [framed(ev("2024-01-01T00:00:00+00:00"), 7), framed(ev("2024-01-01T00:00:00+00:00"), 1, b"\x01"), b"ab"]
    df = wire(spark, vals)
    parts = rows(df.select(CD.frame_magic(F.col("value")), CD.frame_schema_id(F.col("value"))))
    assert parts == [("00", 7), ("01", 1), ("61", None)]
    checked = rows(CD.decode_framed(df, check_magic=True), "level")
    assert checked == [("ERROR",), (None,), (None,)]


def test_registry_dispatch(spark):
    vals = [framed(ev("2024-01-01T00:00:00+00:00"), 1), framed(ev("2024-01-01T00:00:00+00:00"), 9)]
    reg = spark.createDataFrame([(1, "v1")], "schema_id long, version string")
    got = rows(CD.decode_by_schema(wire(spark, vals), reg), "level", "schema_id", "version")
    assert sorted(got, key=lambda r: r[1]) == [("ERROR", 1, "v1"), (None, 9, None)]


def test_each_schema_has_its_own_layout(spark):
    second = json.dumps({"time": "2024-01-01T00:00:00+00:00", "severity": "INFO", "text": "x"}).encode()
    vals = [framed(ev("2024-01-01T00:00:00+00:00"), 1), framed(second, 2), framed(second, 1)]
    reg = spark.createDataFrame([(1, "v1"), (2, "v2")], "schema_id long, version string")
    got = rows(CD.decode_by_schema(wire(spark, vals), reg), "schema_id", "level", "message")
    assert sorted(got, key=str) == [(1, "ERROR", "m"), (1, None, None), (2, "INFO", "x")]


def test_plain_json(spark):
    got = rows(CD.decode_plain(wire(spark, [ev("2024-01-01T00:00:05+00:00", "INFO", "x")])))
    assert got == [(dt.datetime(2024, 1, 1, 0, 0, 5), "INFO", "x")]


def test_encode_matches_python_framing(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1), "INFO", "hi", "ticket_closed")],
                               "event_time timestamp, level string, message string, action string")
    (key, value), = rows(CD.to_wire(df, schema_id=258))
    assert bytes(key) == b"ticket_closed"
    value = bytes(value)
    assert value[:5] == b"\x00\x00\x00\x01\x02"
    assert json.loads(value[5:]) == {"timestamp": "2024-01-01T00:00:01+00:00", "level": "INFO", "message": "hi"}


def test_roundtrip_on_fixture(spark):
    inc = load_incidents(spark, SF_SMALL)
    back = CD.decode_framed(CD.to_wire(inc, keep=["event_id"]), check_magic=True, keep=["event_id"])
    diff = inc.select("event_id", "event_time", "level", "message").exceptAll(
        back.select("event_id", "event_time", "level", "message"))
    assert diff.count() == 0
    assert back.count() == inc.count() == 1000


def test_quality_split_routes_in_one_write(spark, tmp_dir):
    from lumenlog.operators.quality import quality_split
    from lumenlog.sinks.files import write_quality_split
    vals = [framed(ev("2024-01-01T00:00:01+00:00")), framed(b"{bad"), framed(ev("nope"))]
    checked = quality_split(CD.decode_framed(wire(spark, vals)))
    write_quality_split(checked, f"{tmp_dir}/q", mode="overwrite")
    back = spark.read.parquet(f"{tmp_dir}/q")
    got = sorted((r.quality, r.reason) for r in back.collect())
    assert got == [("quarantine", "missing_event_time"), ("quarantine", "unreadable"), ("valid", None)]
    assert sorted(os.listdir(f"{tmp_dir}/q"))[-2:] == ["quality=quarantine", "quality=valid"]
