"""Field extraction: every combination of markers, and edge cases."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from lumenlog.operators.enrich import enrich, enrich_extended, enrich_template_fields
from lumenlog.sources.fixtures import load_incidents


def test_markers_are_independent(spark):
    """Each of id, service and category is found where its marker is whole, in
    every combination with the others."""
    enr = enrich(load_incidents(spark, SF_SMALL))
    has = [F.col(c).isNotNull().alias(c) for c in ("incident_id", "service", "category")]
    marks = [F.col("message").contains("INC-").alias("i"),
             (F.col("message").contains("Service: ") & ~F.col("message").contains(" degraded")).alias("s"), F.col("message").contains("Category: ").alias("c")]
    got = enr.select(*has, *marks).distinct().collect()
    assert all((r.incident_id, r.service, r.category) == (r.i, r.s, r.c) for r in got)
    assert len(got) == 8


def _one(spark, message):
    df = spark.createDataFrame([(None, "INFO", message)], "event_time timestamp, level string, message string")
    return rows(enrich(df), "incident_id", "service", "category")[0]


def test_patterns_on_free_text(spark):
    assert _one(spark, "reading 5, INC-77K3, Service: node-1. rest") == ("INC-77K3", "node-1", None)
    # service followed by a space (not . , or end) does not match
    assert _one(spark, "INC-AB, Service: node-2 degraded, Category: Heavy Load, x") == ("INC-AB", None, "Heavy Load")
    # service at end of text, category with spaces at end
    assert _one(spark, "note, Service: edge-cache") == (None, "edge-cache", None)
    assert _one(spark, "Category: Two Words") == (None, None, "Two Words")
    # comma terminates too
    assert _one(spark, "Service: cdn, CPU: 90%") == (None, "cdn", None)
    # no markers at all -> nulls, not empty strings
    assert _one(spark, "nothing to see") == (None, None, None)
    assert _one(spark, None) == (None, None, None)


def test_extended_and_template_fields(spark):
    msg = "reading 9, INC-1, Service: node-1, Category: Light Load, Affected users: 42, Severity: Minor, Assigned to: crew.3"
    df = spark.createDataFrame([(None, "ERROR", msg)], "event_time timestamp, level string, message string")
    ext = enrich_extended(enrich(df)).first()
    assert (ext.affected_users, ext.duration, ext.system_id, ext.is_critical) == (42, None, None, True)
    tf = enrich_template_fields(enrich(df)).first()
    assert tf.severity == "Minor" and tf.assignee == "crew.3" and tf.service_lenient == "node-1"

    msg2 = "reading 1, SYS-42, Recovery time: 17 minutes"
    df2 = spark.createDataFrame([(None, "INFO", msg2)], "event_time timestamp, level string, message string")
    e2 = enrich_extended(enrich(df2)).first()
    assert (e2.duration, e2.system_id, e2.is_critical) == (17, "SYS-42", False)

    msg3 = "INC-9, Service: node-3 degraded, Escalated to: crew.2, Load increased by 40%, CPU: 7%, Memory: 8%, Disk: 9%"
    df3 = spark.createDataFrame([(None, "ERROR", msg3)], "event_time timestamp, level string, message string")
    t3 = enrich_template_fields(enrich(df3)).first()
    assert t3.service is None and t3.service_lenient == "node-3" and t3.escalation_team == "crew.2"
    assert (t3.impact_pct, t3.cpu_pct, t3.memory_pct, t3.disk_pct) == (40, 7, 8, 9)


def test_huge_number_does_not_fail(spark):
    """ANSI mode: an out-of-range number becomes null instead of failing."""
    df = spark.createDataFrame([(None, "INFO", "Affected users: 99999999999999999999")],
                               "event_time timestamp, level string, message string")
    assert enrich_extended(enrich(df)).first().affected_users is None


def test_service_from_prose(spark):
    from lumenlog.operators.enrich import enrich_service_prose
    rows = [("work finished on node-4. all fine", "node-4"), ("slow answers (seen) at db_2, Service: web", "web"), ("slow answers (seen) at db_2", "db_2"), ("work finished on ", None),
            ("slow answers (seen) at a work finished on b", "b"), ("nothing", None), (None, None), (r"odd \E prefix x1", "x1")]
    df = spark.createDataFrame(rows, "message string, want string")
    got = enrich_service_prose(df, ["work finished on ", "slow answers (seen) at ", r"odd \E prefix "]).collect()
    assert [r.service_any for r in got] == [r.want for r in got]
