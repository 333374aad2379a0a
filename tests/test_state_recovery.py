"""The stateful window count over RocksDB: killed between batches or inside one, restarted."""

import os

import pytest
from pyspark.sql import functions as F

from lumenlog.operators.windows import alerts, window_counts
from lumenlog.plans.catalog import enriched
from lumenlog.sources import codec as CD
from lumenlog.sources.fixtures import load_incidents
from lumenlog.sources.stream import read_wire_files
from lumenlog.streaming import jobs as ST
from conftest import SF_SMALL
from test_streaming import NOW, land


def run(spark, root, files=1):
    incidents = ST.incident_stream(read_wire_files(spark, f"{root}/in", max_files_per_trigger=files))
    q = ST.start_alert_sink(incidents, f"{root}/alerts", f"{root}/ck", trigger=NOW, state_partitions=3, rocksdb=True)
    q.awaitTermination()
    return q


def state(spark, root):
    """(window start, level, count) in the state after the last committed batch."""
    rows = spark.read.format("statestore").load(f"{root}/ck")
    return {(r.s, r.l): r.n for r in rows.select(F.col("key.window.start").alias("s"), F.col("key.level").alias("l"), F.col("value.count").alias("n")).collect()}


@pytest.fixture()
def slices(spark):
    """The fixture's records in order of time, in four slices."""
    wire = CD.to_wire(load_incidents(spark, SF_SMALL), keep=["event_time"]).toPandas().sort_values("event_time")
    return [list(wire.iloc[k * 250:(k + 1) * 250]["value"]) for k in range(4)]


def still_open(spark, upto):
    """Counts of the windows that the watermark (10 seconds behind the newest row but one batch) has not passed."""
    enr = enriched(spark, SF_SMALL).orderBy("event_time").limit(upto)
    return {(r.window_start, r.level): r["count"] for r in window_counts(enr).collect()}


def test_state_goes_on_after_a_restart(spark, tmp_dir, slices):
    land(f"{tmp_dir}/in", slices[:2])
    q = run(spark, tmp_dir)
    assert "RocksDBStateStoreProvider" in spark.read.text(f"{tmp_dir}/ck/offsets/0").agg(F.concat_ws("", F.collect_list("value"))).first()[0]
    held, counts = state(spark, tmp_dir), still_open(spark, 500)
    assert held and all(counts[k] == n for k, n in held.items())
    assert max(held)[0] == max(counts)[0]                   # the newest window is in the state
    land(f"{tmp_dir}/in", slices[2:], first=10)             # the query is gone; a new one over the same checkpoint goes on
    run(spark, tmp_dir)
    held, counts = state(spark, tmp_dir), still_open(spark, 1000)
    assert held and all(counts[k] == n for k, n in held.items())
    streamed, batch = ST.final_alerts(spark, f"{tmp_dir}/alerts"), alerts(enriched(spark, SF_SMALL))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_batch_cut_off_before_its_commit_is_done_again(spark, tmp_dir, slices):
    land(f"{tmp_dir}/in", slices)
    run(spark, tmp_dir)
    before, held = sorted(map(tuple, ST.read_alert_table(spark, f"{tmp_dir}/alerts").collect()), key=str), state(spark, tmp_dir)
    commits = f"{tmp_dir}/ck/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    run(spark, tmp_dir)
    assert sorted(map(tuple, ST.read_alert_table(spark, f"{tmp_dir}/alerts").collect()), key=str) == before
    assert state(spark, tmp_dir) == held
