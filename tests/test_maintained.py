"""Maintained tables: latest row per id, hourly rollup, compacted hours."""

import glob
import os
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lumenlog.operators.feed import latest_per_incident
from lumenlog.operators.kpis import kpis
from lumenlog.plans.catalog import enriched
from lumenlog.sinks import compaction as CO
from lumenlog.sinks import latest as LA
from lumenlog.sinks import rollup as RO
from lumenlog.sinks.files import write_incidents


def batches(spark, n=4):
    """The fixture's rows in batches that do not follow event time."""
    enr = enriched(spark, SF_SMALL)
    return enr, [enr.where(F.pmod(F.xxhash64("event_id"), F.lit(n)) == k) for k in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_equals_the_batch_operator(spark, tmp_dir):
    enr, parts = batches(spark)
    path = f"{tmp_dir}/latest"
    assert LA.read_latest(spark, path, enr.schema).count() == 0
    for k, part in enumerate(parts):
        LA.upsert(part, k, path, buckets=8, tiebreak=["event_id"])
    want = rows(latest_per_incident(enr, ["event_id"]))
    assert rows(LA.read_latest(spark, path, enr.schema)) == want
    LA.upsert(parts[3], 3, path, buckets=8, tiebreak=["event_id"])         # done again
    LA.upsert(enr.limit(0), 4, path, buckets=8, tiebreak=["event_id"])     # nothing new
    assert rows(LA.read_latest(spark, path, enr.schema)) == want
    one = want[0][3]
    got = LA.latest_of(spark, path, enr.schema, one, buckets=8)
    assert rows(got) == [w for w in want if w[3] == one]
    assert len(got.inputFiles()) >= 1
    gone = LA.vacuum(spark, path)
    assert gone == [0, 1, 2] and rows(LA.read_latest(spark, path, enr.schema)) == want


def test_only_touched_buckets_are_written(spark, tmp_dir):
    enr, _ = batches(spark)
    path = f"{tmp_dir}/latest"
    LA.upsert(enr, 0, path, buckets=16, tiebreak=["event_id"])
    one = enr.where("incident_id is not null").limit(1)
    LA.upsert(spark.createDataFrame(one.collect(), enr.schema), 1, path, buckets=16, tiebreak=["event_id"])
    assert len(glob.glob(f"{path}/rows/version=0/bucket=*")) == 16
    assert len(glob.glob(f"{path}/rows/version=1/bucket=*")) == 1


def test_cut_off_batch_is_not_seen(spark, tmp_dir):
    enr, parts = batches(spark, 2)
    path = f"{tmp_dir}/latest"
    LA.upsert(parts[0], 0, path, buckets=4, tiebreak=["event_id"])
    before = rows(LA.read_latest(spark, path, enr.schema))
    LA.upsert(parts[1], 1, path, buckets=4, tiebreak=["event_id"])
    os.rename(f"{path}/manifest/batch=1", f"{tmp_dir}/cut-off")             # between the rows and the line
    assert rows(LA.read_latest(spark, path, enr.schema)) == before
    LA.upsert(parts[1], 1, path, buckets=4, tiebreak=["event_id"])
    assert rows(LA.read_latest(spark, path, enr.schema)) == rows(latest_per_incident(enr, ["event_id"]))


def test_rollup_gives_the_kpis_of_any_hours(spark, tmp_dir):
    enr, parts = batches(spark)
    assert [tuple(r) for r in RO.kpis_of(RO.read_rollup(spark, f"{tmp_dir}/r")).collect()] == [(0, 0, 0, 0)]
    no_time = enr.limit(3).withColumn("event_time", F.lit(None).cast("timestamp"))
    for k, part in enumerate([*parts, no_time]):
        RO.add_batch(part, k, f"{tmp_dir}/r")
        RO.add_batch(part, k, f"{tmp_dir}/r")
    whole = enr.unionByName(no_time)
    r = RO.read_rollup(spark, f"{tmp_dir}/r")
    assert rows(RO.kpis_of(r)) == rows(kpis(whole)) == rows(RO.kpis_of(RO.merged(r)))
    for since, until in (("2024-01-01 02:00:00", "2024-01-01 05:00:00"), (None, "2024-01-01 01:00:00"), ("2024-01-01 11:00:00", None), ("2030-01-01 00:00:00", None)):
        mine = whole.where(F.lit(True) if since is None else F.col("event_time") >= since).where(F.lit(True) if until is None else F.col("event_time") < until)
        assert rows(RO.kpis_of(r, since, until)) == rows(kpis(mine))


def test_rollup_error_on_many_services(spark, tmp_dir):
    n = 200_000
    many = spark.range(n).select(F.timestamp_seconds(F.col("id") % 7200).alias("event_time"), F.lit("INFO").alias("level"), F.concat(F.lit("s"), F.col("id") % 50_000).alias("service"))
    for k in range(3):
        RO.add_batch(many.where(F.col("id") % 3 == k), k, f"{tmp_dir}/r")
    got = RO.kpis_of(RO.read_rollup(spark, f"{tmp_dir}/r")).first()
    assert got.total == n and abs(got.services - 50_000) < 0.05 * 50_000


def small_files(spark, path):
    """Hours of very different sizes in many files."""
    r = random.Random(4)
    data = [(h, i, "".join(r.choices("abcdefgh", k=200))) for h, n in ((0, 30), (1, 4000), (2, 900), (3, 5)) for i in range(n)]
    df = spark.createDataFrame(data, "h int, i int, message string").select(
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, h, 0, i % 3600)").alias("event_time"), "message")
    for k in range(4):
        write_incidents(df.where(F.pmod(F.xxhash64("message"), F.lit(4)) == k).repartition(3), path)
    return df


def test_compaction_packs_every_hour_by_its_bytes(spark, tmp_dir):
    live, root = f"{tmp_dir}/live", f"{tmp_dir}/packed"
    df = small_files(spark, live)
    want = rows(df)
    read = lambda: rows(CO.read_hours(spark, live, root, df.schema).select(*df.columns))      # noqa: E731
    assert read() == want
    lines = {r.hour: r.files for r in CO.compact_hours(spark, live, root, df.schema, target_bytes=100_000, before="2024-01-01_03").collect()}
    assert set(lines) == {"2024-01-01_00", "2024-01-01_01", "2024-01-01_02"}       # the last hour still grows
    assert lines["2024-01-01_00"] == 1 and lines["2024-01-01_01"] > lines["2024-01-01_02"] >= 1
    assert read() == want
    write_incidents(spark.createDataFrame([(None, "x")], "h int, message string").select(F.expr("timestamp'2024-01-01 03:00:09'").alias("event_time"), "message"), live)
    assert len(read()) == len(want) + 1                                             # rows of the live hour are seen at once
    again = CO.compact_hours(spark, live, root, df.schema, target_bytes=100_000)
    assert [r.hour for r in again.collect()] == ["2024-01-01_03"]                   # packed hours are left alone
    assert len(read()) == len(want) + 1
    assert CO.compact_hours(spark, live, root, df.schema, target_bytes=100_000).count() == 0


def test_unpublished_generation_is_not_read(spark, tmp_dir):
    live, root = f"{tmp_dir}/live", f"{tmp_dir}/packed"
    df = small_files(spark, live)
    CO.compact_hours(spark, live, root, df.schema, target_bytes=100_000)
    os.rename(f"{root}/manifest", f"{tmp_dir}/cut-off")
    assert rows(CO.read_hours(spark, live, root, df.schema).select(*df.columns)) == rows(df)
