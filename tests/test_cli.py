"""Command-line reports over a stored enriched folder."""

import argparse
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lumenlog.cli import main, run_stream
from lumenlog.operators import correlate as CR
from lumenlog.operators.enrich import fixed_order
from lumenlog.operators.kpis import kpis
from lumenlog.plans.catalog import enriched, primaries
from lumenlog.sinks.files import write_incidents
from lumenlog.sources.stream import read_wire_files
from lumenlog.streaming.batchlog import drain, read_batch_log
from lumenlog.streaming.crossing import read_crossings
from lumenlog.streaming.intake import read_quarantine, read_valid


def test_reports_over_stored_incidents(spark, tmp_dir):
    enr = enriched(spark, SF_SMALL)
    for fmt in ("parquet", "csv"):
        store = os.path.join(tmp_dir, f"store-{fmt}")
        write_incidents(fixed_order(enr), store, fmt=fmt, hour="event", mode="overwrite")

        out = os.path.join(tmp_dir, f"kpis-{fmt}")
        main(["report", "kpis", "--input", store, "--format", fmt, "--out", out])
        assert tuple(spark.read.parquet(out).first()) == tuple(kpis(enr).first()) == (1000, 201, 210, 13)

        out = os.path.join(tmp_dir, f"counts-{fmt}")
        main(["report", "correlate_counts", "--input", store, "--format", fmt, "--out", out])
        got = {r.incident_id: r.n_correlated for r in spark.read.parquet(out).collect()}
        want = {r.incident_id: r.n_correlated for r in CR.correlate_counts(primaries(enr), enr).collect()}
        assert got == want

    out = os.path.join(tmp_dir, "alerts-window")
    main(["report", "alerts", "--input", os.path.join(tmp_dir, "store-parquet"), "--out", out,
          "--out-format", "json", "--hours", "2024-01-01_00,2024-01-01_02", "--hour-col", "event_hour"])
    alerts = spark.read.json(out)
    assert alerts.count() > 0
    assert alerts.where(F.col("window_start") >= "2024-01-01T03:00:00").count() == 0

    out = os.path.join(tmp_dir, "warning-ids")
    main(["report", "incident_ids", "--input", os.path.join(tmp_dir, "store-parquet"), "--out", out,
          "--level", "WARNING"])
    assert spark.read.parquet(out).count() == enr.where("level = 'WARNING'").select("incident_id").dropna().distinct().count()


def test_filters_choose_primaries_only(spark, tmp_dir):
    enr = enriched(spark, SF_SMALL)
    store = os.path.join(tmp_dir, "store")
    write_incidents(fixed_order(enr), store, hour="event", mode="overwrite")
    out = os.path.join(tmp_dir, "counts")
    main(["report", "correlate_counts", "--input", store, "--out", out, "--level", "WARNING"])
    warned = primaries(enr.where("level = 'WARNING'"))
    want = CR.correlate_pairs(warned, enr).count()
    assert spark.read.parquet(out).agg(F.sum("n_correlated")).first()[0] == want > 0

    one = warned.where("service IS NOT NULL").orderBy("incident_id").first().incident_id
    out = os.path.join(tmp_dir, "one")
    main(["report", "correlated", "--input", store, "--out", out, "--level", "WARNING", "--incident-id", one])
    assert spark.read.parquet(out).count() == CR.correlate_pairs(warned.where(F.col("incident_id") == one), enr).count()
    out = os.path.join(tmp_dir, "prompt")
    main(["report", "rca_prompt_full", "--input", store, "--out", out, "--incident-id", one])
    assert one in spark.read.parquet(out).first().prompt


def test_chat_requests_from_json(spark, tmp_dir):
    requests = os.path.join(tmp_dir, "requests.json")
    asked = [{"message": "what broke?", "incident_context": [{"event_time": "2024-01-01 00:00:01", "message": "INC-1 disk"}], "history": [{"role": "user", "content": "hello there"}]},
             {"message": "and now?"}, {"message": None, "history": []}]
    with open(requests, "w") as f:
        f.write("\n".join(map(json.dumps, asked)))
    for fmt in ("json", "parquet"):
        out = os.path.join(tmp_dir, f"prompts-{fmt}")
        main(["chat", "--requests", requests, "--out", out, "--out-format", fmt])
        got = sorted((r.conv_id, r.prompt) for r in spark.read.format(fmt).load(out).collect())
        assert len(got) == 3 and all(x in got[0][1] for x in ("what broke?", "INC-1 disk", "hello there")) and "and now?" in got[1][1]


def test_compact_and_report_through_the_manifest(spark, tmp_dir):
    enr = fixed_order(enriched(spark, SF_SMALL))
    store, packed = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "packed")
    for k in range(3):
        write_incidents(enr.where(F.pmod(F.xxhash64("message"), F.lit(3)) == k), store)
    main(["compact", "--input", store, "--packed", packed, "--hour-col", "event_hour", "--before", "2024-01-01_06"])
    assert spark.read.parquet(f"{packed}/manifest").count() == 6
    for hours, want in ((None, enr), ("2024-01-01_04,2024-01-01_07", enr.where("event_time >= '2024-01-01 04:00:00' and event_time < '2024-01-01 08:00:00'"))):
        out = os.path.join(tmp_dir, f"kpis-{hours is None}")
        main(["report", "kpis", "--input", store, "--packed", packed, "--hour-col", "event_hour", "--out", out, *(["--hours", hours] if hours else [])])
        assert tuple(spark.read.parquet(out).first()) == tuple(kpis(want).first())


def test_stream_queries_with_registry_and_log(spark, tmp_dir):
    """The wiring of ``stream`` over a file source."""
    from test_intake import register, second
    from test_streaming import NOW, framed, land, ts
    register(spark, f"{tmp_dir}/registry", (1, "v1"), (2, "v2"))
    land(f"{tmp_dir}/in", [[framed(ts(1, 1), "ERROR", "a"), second(ts(1, 2), "ERROR", "b"), framed(ts(1, 3), "ERROR", "c"), b"bad"]])
    args = argparse.Namespace(plain=False, registry=f"{tmp_dir}/registry", batch_log=f"{tmp_dir}/log", first_only=True, state_partitions=2, format="parquet", hour="ingest")
    for q in run_stream(spark, read_wire_files(spark, f"{tmp_dir}/in"), f"{tmp_dir}/out", args, NOW):
        q.awaitTermination()
    drain(spark)
    assert read_valid(spark, f"{tmp_dir}/out/intake").count() == 3 and read_quarantine(spark, f"{tmp_dir}/out/intake").count() == 1
    assert [r.crossing_message for r in read_crossings(spark, f"{tmp_dir}/out/crossings").collect()] == ["c"]
    assert sorted(r["query"] for r in read_batch_log(spark, f"{tmp_dir}/log").collect()) == ["crossings", "intake"]
