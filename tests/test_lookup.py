"""Lookups by incident id read the files and row groups that may hold it."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lumenlog.operators.feed import latest_per_incident, lookup_incident
from lumenlog.plans.catalog import enriched
from lumenlog.sinks.lookup import lookup, lookup_many, write_lookup


def scanned_rows(df) -> tuple[int, int]:
    """(files, rows) that the scan of an executed plan read, by its own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    scan = next(leaves.apply(k) for k in range(leaves.size()) if "Scan" in leaves.apply(k).nodeName())
    m = scan.metrics()
    return m.apply("numFiles").value(), m.apply("numOutputRows").value()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "t")
    # 60,000 rows of 20,000 ids; one id holds a third of them
    n = F.col("id")
    rows = spark.range(60_000).select(
        F.when(n % 3 == 0, "INC-HOT").otherwise(F.concat(F.lit("INC-"), F.sha2((n % 20_000).cast("string"), 256))).alias("incident_id"),
        F.timestamp_seconds(n).alias("event_time"), F.concat(F.lit("message "), n).alias("message"))
    rows = rows.unionByName(spark.createDataFrame([(None, None, "no id")], "incident_id string, event_time timestamp, message string"))
    write_lookup(rows, path, files=12, group_bytes=64 << 10, distinct_per_file=5000)
    return path, rows


def test_rows_and_layout(spark, table):
    path, rows = table
    assert spark.read.parquet(f"{path}/rows").count() == 60_000
    ranges = sorted((r.lo, r.hi, r.rows) for r in spark.read.parquet(f"{path}/ranges").collect())
    assert len(ranges) == len(glob.glob(f"{path}/rows/*.parquet")) >= 12
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))              # disjoint but for a shared end
    assert max(r[2] for r in ranges) < 12_000                                   # the hot id is cut into several files
    one = pq.ParquetFile(glob.glob(f"{path}/rows/*.parquet")[0]).metadata
    assert one.num_row_groups > 1 and one.row_group(0).column(0).path_in_schema == "incident_id"


def test_lookup_reads_one_file_of_all(spark, table):
    path, rows = table
    wanted = rows.where("incident_id like 'INC-a%'").agg(F.min("incident_id")).first()[0]
    got = lookup(spark, path, wanted)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.where(F.col("incident_id") == wanted).collect()))
    files, read = scanned_rows(lookup(spark, path, wanted))
    assert files == 1 and read < 3000                                           # a row group, not the file, of 60,000 rows
    whole = spark.read.parquet(f"{path}/rows").where(F.col("incident_id") == wanted)
    files_all, read_all = scanned_rows(whole)
    assert files_all >= 12 and read_all < 6000                                  # without the ranges: all files opened, few groups read


def test_absent_id_is_settled_by_the_bloom_filter(spark, table):
    path, _ = table
    absent = "INC-" + "7" * 64
    files, read = scanned_rows(lookup(spark, path, absent))
    assert (files, read) == (1, 0)                                              # inside a file's range, in no filter
    assert lookup(spark, path, "ZZZ").count() == 0 and lookup(spark, path, "").count() == 0


def test_hot_id_and_many_ids(spark, table):
    path, rows = table
    assert lookup(spark, path, "INC-HOT").count() == 20_000
    ids = spark.createDataFrame([("INC-HOT",), ("INC-HOT",), ("nothing",), (None,)], "incident_id string")
    assert lookup_many(spark, path, ids).count() == 20_000


def test_empty_table(spark, table, tmp_path):
    _, rows = table
    write_lookup(rows.limit(0), f"{tmp_path}/t", files=3)
    assert lookup(spark, f"{tmp_path}/t", "INC-HOT").count() == 0


def test_latest_row_from_the_table(spark, tmp_path):
    enr = enriched(spark, SF_SMALL)
    write_lookup(enr, f"{tmp_path}/t", files=4)
    one = enr.agg(F.min("incident_id")).first()[0]
    got = latest_per_incident(lookup(spark, f"{tmp_path}/t", one), ["event_id"]).collect()
    assert got == lookup_incident(enr, one, ["event_id"]).collect()
