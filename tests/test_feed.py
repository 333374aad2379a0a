"""Feed, KPIs and incident directories (CSV / Parquet)."""

import datetime as dt
import os

from conftest import SF_SMALL, rows
from lumenlog.operators import feed as FD
from lumenlog.operators.enrich import fixed_order
from lumenlog.operators.kpis import kpis, kpis_legacy
from lumenlog.operators.enrich import enrich_extended
from lumenlog.plans.catalog import enriched
from lumenlog.schemas import ENRICHED_SCHEMA
from lumenlog.sinks.files import compact, write_incidents
from lumenlog.sources.files import read_incident_dir

T = dt.datetime
HEADER = "event_time,level,message,incident_id,service,category\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_kpis_fixture_and_empty(spark):
    # FIXTURES.md §2 expected values at sf0.001
    enr = enriched(spark, SF_SMALL)
    assert tuple(kpis(enr).first()) == (1000, 201, 210, 13)
    empty = spark.createDataFrame([], ENRICHED_SCHEMA)
    assert tuple(kpis(empty).first()) == (0, 0, 0, 0)
    assert tuple(kpis_legacy(enrich_extended(enr)).first()) == (1000, 201, 201, 13)


def test_level_match_exact_vs_legacy(spark):
    df = spark.createDataFrame([(None, "error", "m", None, None, None)], ENRICHED_SCHEMA)
    assert kpis(df).first().critical == 0
    assert kpis_legacy(enrich_extended(df)).first().error == 1


def test_csv_directory_edge_cases(spark, tmp_dir):
    assert read_incident_dir(spark, os.path.join(tmp_dir, "missing")).count() == 0
    d = os.path.join(tmp_dir, "incidents")
    write(f"{d}/a.csv", HEADER + '2024-01-01 00:00:01.123456,ERROR,"Quote "" and, comma",INC-1,svc-01,Disk Fault\n'
                                 "2024-01-01 00:00:02,INFO,plain,,,\n")
    write(f"{d}/tiny.csv", "a,b\n1,2\n")                  # 8 bytes: skipped
    write(f"{d}/b.csv", "event_time,level,message\n2024-01-01 00:00:03,WARNING,older file\n")
    write(f"{d}/notes.txt", "ignored")
    raw = read_incident_dir(spark, d)
    feed = FD.clean_feed(raw)
    got = sorted(rows(feed, "event_time", "level", "message", "incident_id", "service"), key=lambda r: r[0])
    assert got == [
        (T(2024, 1, 1, 0, 0, 1, 123456), "ERROR", 'Quote " and, comma', "INC-1", "svc-01"),
        (T(2024, 1, 1, 0, 0, 2), "INFO", "plain", None, None),       # both time forms parse
        (T(2024, 1, 1, 0, 0, 3), "WARNING", "older file", None, None),  # missing columns -> null
    ]


def test_bad_times_dropped_not_fatal(spark):
    raw = spark.createDataFrame([("nope", "INFO", "a"), (None, "INFO", "b"), ("2024-01-01T00:00:00+00:00", "INFO", "c")],
                                "event_time string, level string, message string")
    assert rows(FD.clean_feed(raw), "message") == [("c",)]
    assert FD.clean_feed(raw, drop_bad_time=False).count() == 3


def test_roundtrip_and_compaction(spark, tmp_dir):
    enr = fixed_order(enriched(spark, SF_SMALL))
    for fmt in ("csv", "parquet"):
        out = os.path.join(tmp_dir, fmt)
        write_incidents(enr, out, fmt=fmt, mode="overwrite", max_records_per_file=100)
        back = read_incident_dir(spark, out, fmt=fmt)
        if fmt == "csv":
            back = FD.clean_feed(back, drop_bad_time=False)
        assert back.exceptAll(enr).count() == 0 and enr.exceptAll(back).count() == 0
        compacted = os.path.join(tmp_dir, fmt + "-compact")
        compact(spark, out, compacted, fmt=fmt)
        back2 = read_incident_dir(spark, compacted, fmt=fmt)
        assert back2.count() == enr.count()


def test_latest_and_lookup(spark):
    df = spark.createDataFrame([
        (T(2024, 1, 1, 0, 0), "WARNING", "first", "INC-1", "svc", None),
        (T(2024, 1, 1, 0, 9), "INFO", "b-later", "INC-1", "svc", None),
        (T(2024, 1, 1, 0, 9), "INFO", "a-later", "INC-1", "svc", None),   # tie: message asc wins
        (T(2024, 1, 1, 0, 5), "ERROR", "other", "INC-2", None, None),
        (T(2024, 1, 1, 0, 6), "ERROR", "no id", None, None, None),
    ], ENRICHED_SCHEMA)
    latest = {r.incident_id: r.message for r in FD.latest_per_incident(df).collect()}
    assert latest == {"INC-1": "a-later", "INC-2": "other"}
    assert rows(FD.lookup_incident(df, "INC-1"), "message") == [("a-later",)]
    assert FD.lookup_incident(df, "INC-404").count() == 0


def test_filters_distinct_and_recent(spark):
    enr = enriched(spark, SF_SMALL)
    f = FD.filter_feed(enr, level="WARNING", service="node-3")
    assert {r.level for r in f.collect()} == {"WARNING"}
    assert FD.filter_feed(enr).count() == 1000
    assert {r.level for r in FD.distinct_levels(enr).collect()} == {"INFO", "WARNING", "ERROR"}
    assert FD.distinct_services(enr).count() == 13
    top = FD.feed_recent(enr, n=5, tiebreak=["event_id"]).collect()
    assert len(top) == 5 and all(top[i].event_time >= top[i + 1].event_time for i in range(4))
    assert FD.has_incident_ids(enr).first()[0] is True
    none = FD.has_incident_ids(FD.filter_feed(enr, level="NOPE")).first()[0]
    assert none is False


def test_feed_json_keeps_nulls(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, 0, 0, 1), "INFO", "m", None, "svc", None)], ENRICHED_SCHEMA)
    rec = FD.feed_json(df).first()[0]
    assert rec == ('{"event_time":"2024-01-01T00:00:01","level":"INFO","message":"m",'
                   '"incident_id":null,"service":"svc","category":null}')


def test_hour_range_prunes_partitions(spark, tmp_dir):
    enr = fixed_order(enriched(spark, SF_SMALL))
    out = os.path.join(tmp_dir, "by-hour")
    write_incidents(enr, out, fmt="parquet", mode="overwrite")
    df = read_incident_dir(spark, out, fmt="parquet", hour_range=("2024-01-01_02", "2024-01-01_03"),
                           hour_col="event_hour")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_hour" in plan
    expected = enr.where("event_time >= '2024-01-01 02:00:00' AND event_time < '2024-01-01 04:00:00'").count()
    assert df.count() == expected > 0


def test_strict_times_fail_on_bad_text(spark):
    import pytest
    ok = spark.createDataFrame([("2024-01-01 00:00:01",), (None,)], "event_time string")
    assert FD.strict_times(ok).where("event_time IS NULL").count() == 1     # missing kept
    bad = spark.createDataFrame([("nope",)], "event_time string")
    with pytest.raises(Exception):
        FD.strict_times(bad).collect()


def test_na_tokens_only_when_asked(spark, tmp_dir):
    d = os.path.join(tmp_dir, "na")
    write(f"{d}/a.csv", HEADER + "2024-01-01 00:00:01,INFO,NA,null,svc-01,\n")
    plain = read_incident_dir(spark, d).first()
    assert (plain.message, plain.incident_id, plain.category) == ("NA", "null", None)   # only empty is null
    tokens = read_incident_dir(spark, d, na_values=["NA", "null"]).first()
    assert (tokens.message, tokens.incident_id, tokens.service) == (None, None, "svc-01")


def test_kpis_with_absent_columns(spark):
    df = spark.createDataFrame([("x",), ("y",)], "message string")
    assert tuple(kpis(df).first()) == (2, 0, 0, 0)
    assert tuple(kpis_legacy(df).first()) == (2, None, None, None)


def test_corrupt_parquet_file_is_skipped(spark, tmp_dir):
    enr = fixed_order(enriched(spark, SF_SMALL))
    out = os.path.join(tmp_dir, "with-corrupt")
    write_incidents(enr, out, fmt="parquet", hour="event", mode="overwrite")
    hour_dir = sorted(d for d in os.listdir(out) if d.startswith("event_hour="))[0]
    with open(os.path.join(out, hour_dir, "broken.parquet"), "wb") as f:
        f.write(b"this is not a parquet file at all" * 4)
    import pytest
    from lumenlog.sources.files import skipped_files
    with pytest.raises(Exception):
        read_incident_dir(spark, out, fmt="parquet").count()
    assert read_incident_dir(spark, out, fmt="parquet", skip_unreadable=True).count() == 1000
    skipped = skipped_files(spark, out, fmt="parquet").collect()
    assert [r.path.rsplit("/", 1)[1] for r in skipped] == ["broken.parquet"]


def test_compaction_one_file_per_hour(spark, tmp_dir):
    enr = fixed_order(enriched(spark, SF_SMALL))
    src, dst = os.path.join(tmp_dir, "many"), os.path.join(tmp_dir, "one")
    write_incidents(enr.repartition(8), src, fmt="parquet", mode="overwrite", max_records_per_file=20)
    compact(spark, src, dst, fmt="parquet", files_per_hour=1)
    hours = [d for d in os.listdir(dst) if d.startswith("event_hour=")]
    assert len(hours) == 12
    for h in hours:
        files = [f for f in os.listdir(os.path.join(dst, h)) if f.endswith(".parquet")]
        assert len(files) == 1, (h, files)
    back = read_incident_dir(spark, dst, fmt="parquet")
    assert back.exceptAll(enr).count() == 0 and enr.exceptAll(back).count() == 0


def test_columns_are_taken_by_header(spark, tmp_dir):
    from lumenlog.sources.files import skipped_files
    d = os.path.join(tmp_dir, "headers")
    write(f"{d}/a.csv", "event_time,level,service,message,incident_id\n2024-01-01 00:00:01,INFO,svc-2,world text,INC-2\n")
    write(f"{d}/b.csv", HEADER + "2024-01-01 00:00:02,INFO,m,INC-1,svc-1,c\n")
    write(f"{d}/c.csv", "x\n1\n")
    got = {r.incident_id: (r.message, r.service, r.category) for r in read_incident_dir(spark, d).collect()}
    assert got == {"INC-2": ("world text", "svc-2", None), "INC-1": ("m", "svc-1", "c")}
    assert [(r.bytes, r.reason) for r in skipped_files(spark, d).collect()] == [(4, "too small")]


def test_storage_errors_are_raised(spark):
    import pytest
    with pytest.raises(Exception):
        read_incident_dir(spark, "nosuchscheme://bucket/x")


def test_compaction_by_size(spark, tmp_dir):
    enr = fixed_order(enriched(spark, SF_SMALL))
    src, dst = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "dst")
    write_incidents(enr.repartition(6), src, fmt="parquet", mode="overwrite")
    compact(spark, src, dst, target_bytes=4000)
    assert read_incident_dir(spark, dst, fmt="parquet").exceptAll(enr).count() == 0
    per_hour = [len([f for f in os.listdir(os.path.join(dst, h)) if f.endswith(".parquet")]) for h in os.listdir(dst) if "=" in h]
    assert max(per_hour) > 1
