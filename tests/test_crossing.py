"""First crossings as keyed state: one alert per window, dropped state, restart."""

import os

import pytest

from lumenlog.sources.stream import read_wire_files
from lumenlog.streaming import jobs as ST
from lumenlog.streaming.crossing import earliest, first_crossings, read_crossings, start_first_crossings
from test_streaming import NOW, framed, land, ts


def run(spark, root, **rule):
    wire = read_wire_files(spark, f"{root}/in", max_files_per_trigger=1)
    q = start_first_crossings(ST.incident_stream(wire), f"{root}/out", f"{root}/ck", trigger=NOW, state_partitions=2, **rule)
    q.awaitTermination()
    return q


def got(spark, root):
    return sorted((r.window_start.minute, r.crossing_time.minute * 60 + r.crossing_time.second, r.crossing_message) for r in read_crossings(spark, f"{root}/out").collect())


def state(spark, root):
    """The windows in the state store after the last batch."""
    return sorted(r["key"]["start"] // 60_000_000 % 60 for r in spark.read.format("statestore").option("stateVarName", "earliest").load(f"{root}/ck").collect())


def test_one_alert_per_window_across_batches(spark, tmp_dir):
    land(f"{tmp_dir}/in", [
        [framed(ts(1, 5), "ERROR", "b"), framed(ts(1, 1), "ERROR", "a"), framed(ts(2), "INFO", "x")],
        [framed(ts(1, 3), "ERROR", "c")],                                  # third in the second batch, not the last by time
        [framed(ts(1, 2), "ERROR", "d"), framed(ts(3), "ERROR", "e")],     # has alerted
        [framed(ts(6, s), "ERROR", f"m{s}") for s in (9, 8, 7, 6)],
        [framed(None, "ERROR"), framed("nope", "ERROR"), b"\x00bad", framed(ts(7), None)],
    ])
    run(spark, tmp_dir)
    assert got(spark, tmp_dir) == [(0, 65, "b"), (5, 6 * 60 + 8, "m8")]
    assert state(spark, tmp_dir) == [5]     # the watermark has passed the end of the first


def test_state_goes_after_the_watermark_and_late_rows_with_it(spark, tmp_dir):
    land(f"{tmp_dir}/in", [
        [framed(ts(1, s), "ERROR") for s in (1, 2)],
        [framed(ts(40), "INFO")],          # rows of other levels move the watermark
        [framed(ts(41), "INFO")],
        [framed(ts(1, 3), "ERROR", "late")],
        [framed(ts(42, s), "ERROR", f"n{s}") for s in (1, 2, 3)],
    ])
    run(spark, tmp_dir)
    assert got(spark, tmp_dir) == [(40, 42 * 60 + 3, "n3")]
    assert state(spark, tmp_dir) == [40]


def test_restart_keeps_state(spark, tmp_dir):
    land(f"{tmp_dir}/in", [[framed(ts(1, s), "ERROR", f"a{s}") for s in (1, 2)], [framed(ts(1, 3), "WARNING")]])
    run(spark, tmp_dir)
    assert got(spark, tmp_dir) == [] and state(spark, tmp_dir) == [0]
    land(f"{tmp_dir}/in", [[framed(ts(1, 9), "ERROR", "a9"), framed(ts(1, 4), "INFO")]], first=50)
    run(spark, tmp_dir)                    # a new query over the same checkpoint
    assert got(spark, tmp_dir) == [(0, 69, "a9")]
    land(f"{tmp_dir}/in", [[framed(ts(1, 8), "ERROR", "a8") for _ in range(5)]], first=60)
    run(spark, tmp_dir)                    # alerted before the restart
    run(spark, tmp_dir)                    # and without new input
    assert got(spark, tmp_dir) == [(0, 69, "a9")]


def test_uncommitted_batch_is_done_again(spark, tmp_dir):
    """As after a kill between the batch's output and its commit."""
    land(f"{tmp_dir}/in", [[framed(ts(1, s), "ERROR", f"a{s}") for s in (1, 2)], [framed(ts(1, 3), "ERROR", "a3")]])
    run(spark, tmp_dir)
    before = got(spark, tmp_dir)
    commits = f"{tmp_dir}/ck/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{f}"):
            os.remove(f"{commits}/{f}")
    run(spark, tmp_dir)
    assert got(spark, tmp_dir) == before == [(0, 63, "a3")]


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_tasks_send_the_earliest_only(n):
    import pyarrow as pa
    b = pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int64()), pa.array([300] * n, pa.int64()), pa.array([(k * 7919) % 5003 for k in range(n)], pa.int64()),
                                    pa.array([f"m{k}" for k in range(n)], pa.string())], ["start", "end", "at", "message"])
    out = next(earliest(iter([b, b]), 3))
    want = sorted((b.column("at")[k].as_py(), b.column("message")[k].as_py()) for k in range(n) for _ in range(2))[:3]
    assert list(zip(out.column("at").to_pylist(), out.column("message").to_pylist())) == want


def test_other_rule(spark, tmp_dir):
    land(f"{tmp_dir}/in", [[framed(ts(1), "WARNING", "a"), framed(ts(11), "WARNING", "b"), framed(ts(2), "ERROR", "c")]])
    run(spark, tmp_dir, level="WARNING", min_count=2, duration="15 minutes")
    assert got(spark, tmp_dir) == [(0, 660, "b")]
    assert first_crossings.__doc__
