"""Window counts and alert rules (batch)."""

import datetime as dt

from conftest import SF_SMALL, rows
from lumenlog.operators.enrich import enrich
from lumenlog.operators.windows import alerts, alerts_first_crossing, window_counts
from lumenlog.plans.catalog import enriched

T = dt.datetime


def frame(spark, data):
    return spark.createDataFrame(data, "event_time timestamp, level string, message string, event_id long")


def test_window_edges_and_null_time(spark):
    df = enrich(frame(spark, [
        (T(2024, 1, 1, 0, 4, 59), "ERROR", "a", 1),
        (T(2024, 1, 1, 0, 5, 0), "ERROR", "b", 2),
        (None, "ERROR", "c", 3),
    ]))
    got = sorted(rows(window_counts(df)))
    assert got == [(T(2024, 1, 1, 0, 0), T(2024, 1, 1, 0, 5), "ERROR", 1),
                   (T(2024, 1, 1, 0, 5), T(2024, 1, 1, 0, 10), "ERROR", 1)]


def test_alert_threshold_and_text(spark):
    data = [(T(2024, 1, 1, 0, 1, i), "ERROR", "x", i) for i in range(3)]
    data += [(T(2024, 1, 1, 0, 6, i), "ERROR", "x", 10 + i) for i in range(2)]
    data += [(T(2024, 1, 1, 0, 7, i), "WARNING", "x", 20 + i) for i in range(5)]
    got = rows(alerts(enrich(frame(spark, data), keep=["event_id"])))
    assert len(got) == 1
    start, end, level, count, text = got[0]
    assert (start, end, level, count) == (T(2024, 1, 1, 0, 0), T(2024, 1, 1, 0, 5), "ERROR", 3)
    assert text == "Alert: 3 ERROR events from 2024-01-01 00:00:00 to 2024-01-01 00:05:00"


def test_first_crossing_is_third_error(spark):
    data = [(T(2024, 1, 1, 0, 1, s), "ERROR", "x", s) for s in (30, 10, 20, 40)]
    got = rows(alerts_first_crossing(enrich(frame(spark, data), keep=["event_id"])))
    assert got == [(T(2024, 1, 1, 0, 0), T(2024, 1, 1, 0, 5), "ERROR", T(2024, 1, 1, 0, 1, 30), 30)]


def test_fixture_alert_counts(spark):
    # FIXTURES.md §2: 27 alerting windows at sf0.001, max count 6
    a = alerts(enriched(spark, SF_SMALL))
    assert a.count() == 27
    assert max(r["count"] for r in a.collect()) == 6
