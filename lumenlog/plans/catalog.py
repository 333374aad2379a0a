"""Named queries over the driver tables: ``(spark, sf_dir) -> DataFrame``.

Each entry composes the engine's operators over incidents derived from the
whole ``events`` table (or over ``conversations``).  Timestamps leave as
timestamp_ntz holding UTC wall-clock values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import to_utc_wallclock
from ..operators import correlate as CR
from ..operators import enrich as EN
from ..operators import feed as FD
from ..operators import kpis as KP
from ..operators import prompts as PR
from ..operators import quality as QL
from ..operators import versions as VS
from ..operators import windows as WN
from ..schemas import ENRICHED_COLUMNS
from ..session import run_folder
from ..sinks import compaction as CO
from ..sinks import files as SK
from ..sinks import latest as LA
from ..sinks import lookup as LK
from ..sinks import rollup as RO
from ..sources import codec as CD
from ..sources import files as SF
from ..sources import fixtures as FX
from ..sources import stream as SS
from ..sources.fixtures import load_incidents
from ..streaming import batchlog as BL
from ..streaming import crossing as CX
from ..streaming import intake as IN
from ..streaming import jobs as ST
from . import readside as RS

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _out(df: DataFrame) -> DataFrame:
    return to_utc_wallclock(df)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched incidents carrying ``event_id`` as the deterministic tie-break key."""
    return EN.enrich(load_incidents(spark, sf_dir), keep=["event_id"])


# --- enrichment ---------------------------------------------------------------

@register("enrich")
def q_enrich(spark, sf_dir):
    return _out(enriched(spark, sf_dir))


@register("enrich_extended")
def q_enrich_extended(spark, sf_dir):
    return _out(EN.enrich_extended(enriched(spark, sf_dir)))


@register("enrich_template_fields")
def q_enrich_template_fields(spark, sf_dir):
    return _out(EN.enrich_template_fields(enriched(spark, sf_dir)))


PROSE = ["error reading ", "click reading "]


@register("enrich_service_prose")
def q_enrich_service_prose(spark, sf_dir):
    """Services also from the prose of two kinds of messages."""
    return _out(EN.enrich_service_prose(enriched(spark, sf_dir), PROSE))


# --- windows and alerts -------------------------------------------------------

@register("window_counts")
def q_window_counts(spark, sf_dir):
    return _out(WN.window_counts(enriched(spark, sf_dir)))


@register("alerts")
def q_alerts(spark, sf_dir):
    return _out(WN.alerts(enriched(spark, sf_dir)))


@register("alerts_first_crossing")
def q_alerts_first_crossing(spark, sf_dir):
    return _out(WN.alerts_first_crossing(enriched(spark, sf_dir)))


@register("hourly_rollup")
def q_hourly_rollup(spark, sf_dir):
    return _out(WN.hourly_rollup(enriched(spark, sf_dir)))


@register("counts_by_action")
def q_counts_by_action(spark, sf_dir):
    """Events per record key (action name) and level, read off the wire."""
    wire = CD.to_wire(load_incidents(spark, sf_dir), key_col="action")
    dec = CD.decode_framed(wire, keep=["key"])
    return (dec.groupBy(CD.record_key(dec).alias("action"), "level")
            .agg(F.count(F.lit(1)).alias("count")))


# --- KPIs ----------------------------------------------------------------------

@register("kpis")
def q_kpis(spark, sf_dir):
    return KP.kpis(enriched(spark, sf_dir))


@register("kpis_legacy")
def q_kpis_legacy(spark, sf_dir):
    return KP.kpis_legacy(EN.enrich_extended(enriched(spark, sf_dir)))


# --- feed ----------------------------------------------------------------------

FILTER_LEVEL = "WARNING"
FILTER_SERVICE = "node-3"


@register("feed_clean")
def q_feed_clean(spark, sf_dir):
    return _out(FD.clean_feed(FX.feed_text(enriched(spark, sf_dir))))


@register("feed_recent")
def q_feed_recent(spark, sf_dir):
    return _out(FD.feed_recent(enriched(spark, sf_dir), tiebreak=["event_id"]))


@register("feed_filtered")
def q_feed_filtered(spark, sf_dir):
    df = FD.filter_feed(enriched(spark, sf_dir), level=FILTER_LEVEL, service=FILTER_SERVICE)
    return _out(FD.feed_recent(df, tiebreak=["event_id"]))


@register("feed_json")
def q_feed_json(spark, sf_dir):
    return FD.feed_json(enriched(spark, sf_dir))


@register("feed_clean_nan")
def q_feed_clean_nan(spark, sf_dir):
    events = FX.read_table(spark, sf_dir, "events").select("event_id", "value")
    value = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    inc = load_incidents(spark, sf_dir).select("event_id", "event_time")
    return _out(FD.clean_feed(inc.join(events.select("event_id", value.alias("value")), "event_id")))


@register("strict_times")
def q_strict_times(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    text = F.when(F.col("event_id") % 4 != 0, F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return _out(FD.strict_times(enr.select("event_id", text.alias("event_time"))))


@register("kpis_empty")
def q_kpis_empty(spark, sf_dir):
    return KP.kpis(FD.filter_feed(enriched(spark, sf_dir), level="NO SUCH LEVEL"))


@register("has_incident_ids")
def q_has_incident_ids(spark, sf_dir):
    return FD.has_incident_ids(FD.filter_feed(enriched(spark, sf_dir), level=FILTER_LEVEL))


@register("distinct_levels")
def q_distinct_levels(spark, sf_dir):
    return FD.distinct_levels(enriched(spark, sf_dir))


@register("distinct_services")
def q_distinct_services(spark, sf_dir):
    return FD.distinct_services(enriched(spark, sf_dir))


@register("distinct_incident_ids")
def q_distinct_incident_ids(spark, sf_dir):
    return FD.distinct_incident_ids(enriched(spark, sf_dir))


@register("latest_per_incident")
def q_latest_per_incident(spark, sf_dir):
    return _out(FD.latest_per_incident(enriched(spark, sf_dir), tiebreak=["event_id"]))


def chosen_incident(enr: DataFrame):
    """The smallest incident id that has a service (a scalar subquery)."""
    return enr.where(F.col("service").isNotNull()).agg(F.min("incident_id")).scalar()


@register("lookup_incident")
def q_lookup_incident(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return _out(FD.lookup_incident(enr, chosen_incident(enr), tiebreak=["event_id"]))


@register("lookup_indexed")
def q_lookup_indexed(spark, sf_dir):
    """The same lookup on a table laid out for it: file ranges and Bloom filters on the id."""
    path = run_folder(spark, "lookup")
    LK.write_lookup(enriched(spark, sf_dir), path)
    rows = spark.read.parquet(f"{path}/rows")
    wanted = rows.agg(chosen_incident(rows).alias("id")).first().id
    return _out(FD.latest_per_incident(LK.lookup(spark, path, wanted), tiebreak=["event_id"]))


# --- versions and files --------------------------------------------------------

VERSION_SPLIT = "2024-01-01 06:00:00"


@register("union_versions")
def q_union_versions(spark, sf_dir):
    """Rows of two versions, damaged ones (without a time) in the older."""
    enr = EN.enrich(CD.decode_framed(topic(spark, sf_dir), keep=["event_id"]), keep=["event_id"])
    newer = F.coalesce(F.col("event_time") >= F.lit(VERSION_SPLIT).cast("timestamp"), F.lit(False))
    return _out(VS.union_versions(enr.where(~newer), EN.enrich_extended(enr.where(newer))))


def _roundtrip(spark, sf_dir, fmt):
    path = run_folder(spark, f"{fmt}-roundtrip")
    SK.write_incidents(EN.fixed_order(enriched(spark, sf_dir)), path, fmt=fmt, mode="overwrite")
    back = SF.read_incident_dir(spark, path, fmt=fmt)
    if fmt == "csv":
        back = FD.clean_feed(back, drop_bad_time=False)
    return _out(back)


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "csv")


@register("csv_union_by_header")
def q_csv_union_by_header(spark, sf_dir):
    """Files of three writers: all columns, columns in another order without the
    category, and three columns only; and one file of a few bytes."""
    path = run_folder(spark, "csv-headers")
    enr = EN.enrich(load_incidents(spark, sf_dir), keep=["event_id"]).withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    for k, cols in enumerate((ENRICHED_COLUMNS, ["service", "message", "incident_id", "event_time", "level"], ["message", "level", "event_time"])):
        enr.where(F.col("event_id") % 3 == k).select(*cols).write.options(**SK.CSV_WRITE_OPTIONS).csv(f"{path}/writer={k}")
    spark.createDataFrame([("x",)], "a string").coalesce(1).write.options(header="true").csv(f"{path}/writer=9")
    return _out(FD.clean_feed(SF.read_incident_dir(spark, path), drop_bad_time=False))


@register("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "parquet")


# --- wire codec and quality ----------------------------------------------------

def topic(spark, sf_dir) -> DataFrame:
    return FX.wire_records(load_incidents(spark, sf_dir))


@register("decode_framed")
def q_decode_framed(spark, sf_dir):
    return _out(CD.decode_framed(topic(spark, sf_dir), keep=["event_id"]))


@register("decode_plain")
def q_decode_plain(spark, sf_dir):
    wire = CD.to_wire(load_incidents(spark, sf_dir), framed=False, keep=["event_id"])
    return _out(CD.decode_plain(wire, keep=["event_id"]))


@register("frame_schema_ids")
def q_frame_schema_ids(spark, sf_dir):
    v = F.col("value")
    return (topic(spark, sf_dir)
            .groupBy(CD.frame_magic(v).alias("magic"), CD.frame_schema_id(v).alias("schema_id"))
            .agg(F.count(F.lit(1)).alias("count")))


@register("decode_registry")
def q_decode_registry(spark, sf_dir):
    registry = spark.createDataFrame([(1, "v1"), (2, "v2")], "schema_id long, version string")
    wire = FX.wire_records(load_incidents(spark, sf_dir), layouts=True)
    return _out(CD.decode_by_schema(wire, registry, keep=["event_id"]))


@register("frame_roundtrip")
def q_frame_roundtrip(spark, sf_dir):
    wire = CD.to_wire(load_incidents(spark, sf_dir), schema_id=1, keep=["event_id"])
    dec = CD.decode_framed(wire, check_magic=True, keep=["event_id", "key"])
    return _out(dec.select("event_id", "event_time", "level", "message",
                           CD.record_key(dec).alias("action")))


@register("quality_split")
def q_quality_split(spark, sf_dir):
    return _out(QL.quality_split(CD.decode_framed(topic(spark, sf_dir), keep=["event_id"])))


# --- correlation ---------------------------------------------------------------

def primaries(enr: DataFrame) -> DataFrame:
    """Latest row of every incident id: the primaries to correlate."""
    return FD.latest_per_incident(enr, tiebreak=["event_id"])


PRIMARY_KEY_COLUMNS = ["incident_id", "event_time", "service", "event_id"]


@register("correlate_pairs")
def q_correlate_pairs(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    # only the key columns of a primary travel through the latest-row shuffle
    return _out(CR.correlate_pairs(primaries(enr.select(*PRIMARY_KEY_COLUMNS)), enr))


@register("correlate_pairs_cut")
def q_correlate_pairs_cut(spark, sf_dir):
    """The same pairs with heavy (service, bucket) keys cut by a histogram."""
    enr = enriched(spark, sf_dir)
    return _out(CR.correlate_pairs(primaries(enr.select(*PRIMARY_KEY_COLUMNS)), enr, rows_per_key=200))


def chosen_primary(enr: DataFrame) -> DataFrame:
    return FD.lookup_incident(enr, chosen_incident(enr), tiebreak=["event_id"])


@register("correlate_one")
def q_correlate_one(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return _out(CR.correlate_one(chosen_primary(enr), enr))


@register("correlate_one_oldest_first")
def q_correlate_one_oldest_first(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return _out(CR.correlate_one(chosen_primary(enr), enr).orderBy("event_time", "event_id"))


@register("correlate_one_newest_first")
def q_correlate_one_newest_first(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return _out(CR.correlate_one(chosen_primary(enr), enr).orderBy(F.col("event_time").desc(), "event_id"))


@register("report_correlate_counts_filtered")
def q_report_correlate_counts_filtered(spark, sf_dir):
    """The read-side report: primaries from the filtered feed, all rows counted."""
    return _out(RS.report(enriched(spark, sf_dir), "correlate_counts", level=FILTER_LEVEL))


@register("correlate_filtered")
def q_correlate_filtered(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    prim = primaries(FD.filter_feed(enr, level=FILTER_LEVEL).select(*PRIMARY_KEY_COLUMNS))
    return _out(CR.correlate_pairs(prim, enr))


@register("correlate_counts")
def q_correlate_counts(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return _out(CR.correlate_counts(primaries(enr), enr))


@register("correlate_counts_granular")
def q_correlate_counts_granular(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return _out(CR.correlate_counts(primaries(enr), enr, granule_seconds=10))


@register("correlate_counts_cut")
def q_correlate_counts_cut(spark, sf_dir):
    """The same counts with granules bounded by their rows."""
    enr = enriched(spark, sf_dir)
    return _out(CR.correlate_counts(primaries(enr), enr, granule_seconds=600, rows_per_granule=50))


# --- prompts -------------------------------------------------------------------

@register("rca_prompt")
def q_rca_prompt(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return PR.rca_prompt(primaries(enr), enr)


@register("rca_prompt_full")
def q_rca_prompt_full(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return PR.rca_prompt_full(primaries(enr), enr)


@register("rca_prompt_one")
def q_rca_prompt_one(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return PR.rca_prompt_one(chosen_primary(enr), enr)


@register("rca_prompt_full_one")
def q_rca_prompt_full_one(spark, sf_dir):
    enr = enriched(spark, sf_dir)
    return PR.rca_prompt_one(chosen_primary(enr), enr, full=True)


@register("single_prompt_plain")
def q_single_prompt_plain(spark, sf_dir):
    """Without the columns that older versions wrote."""
    return PR.single_prompt(FD.latest_per_incident(enriched(spark, sf_dir), tiebreak=["event_id"]))


@register("single_prompt")
def q_single_prompt(spark, sf_dir):
    ext = EN.enrich_extended(enriched(spark, sf_dir))
    return PR.single_prompt(FD.latest_per_incident(ext, tiebreak=["event_id"]))


def conversations(spark, sf_dir) -> DataFrame:
    return FX.read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


@register("chat_history")
def q_chat_history(spark, sf_dir):
    return PR.chat_history(conversations(spark, sf_dir))


@register("chat_prompt")
def q_chat_prompt(spark, sf_dir):
    """Conversations as requests; ten events are at hand for each conversation."""
    conv = F.call_function("div", F.col("event_id"), F.lit(10))
    context = enriched(spark, sf_dir).select(conv.alias("conv_id"), "event_time", "message")
    return PR.chat_prompt(PR.chat_requests(conversations(spark, sf_dir), context))


# --- streaming (file-source stand-in for the topic, availableNow trigger) ----------

def _land_topic(spark, sf_dir) -> str:
    """Write the derived topic as wire files for a streaming source to pick up."""
    landing = run_folder(spark, "topic")
    FX.wire_records(load_incidents(spark, sf_dir), damage=False).select("key", "value").write.parquet(landing)
    return landing


@register("stream_enriched_sink")
def q_stream_enriched_sink(spark, sf_dir):
    root = run_folder(spark, "stream-enriched")
    wire = SS.read_wire_files(spark, _land_topic(spark, sf_dir))
    q = ST.start_enriched_sink(ST.incident_stream(wire), f"{root}/out", f"{root}/_checkpoint",
                               trigger={"availableNow": True})
    q.awaitTermination()
    return _out(spark.read.parquet(f"{root}/out").select(*ENRICHED_COLUMNS))


@register("stream_alerts_final")
def q_stream_alerts_final(spark, sf_dir):
    root = run_folder(spark, "stream-alerts")
    wire = SS.read_wire_files(spark, _land_topic(spark, sf_dir))
    q = ST.start_alert_sink(ST.incident_stream(wire), f"{root}/alerts", f"{root}/_checkpoint",
                            trigger={"availableNow": True},
                            state_partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    return _out(ST.final_alerts(spark, f"{root}/alerts"))


@register("stream_first_crossing")
def q_stream_first_crossing(spark, sf_dir):
    """Keyed state with timers: every window alerts once."""
    root = run_folder(spark, "stream-crossing")
    wire = SS.read_wire_files(spark, _land_topic(spark, sf_dir))
    q = CX.start_first_crossings(ST.incident_stream(wire), f"{root}/out", f"{root}/_checkpoint", trigger={"availableNow": True},
                                 state_partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    return _out(CX.read_crossings(spark, f"{root}/out"))


def _intake(spark, sf_dir) -> str:
    """The damaged topic of two schemas through the intake job; its folder."""
    root = run_folder(spark, "stream-intake")
    FX.wire_records(load_incidents(spark, sf_dir), layouts=True).select("key", "value").write.parquet(f"{root}/topic")
    spark.createDataFrame([(1, "v1"), (2, "v2")], IN.REGISTRY_SCHEMA).coalesce(1).write.parquet(f"{root}/registry")
    q = IN.start_intake(SS.read_wire_files(spark, f"{root}/topic"), f"{root}/out", f"{root}/registry", f"{root}/_checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    return f"{root}/out"


@register("stream_intake_valid")
def q_stream_intake_valid(spark, sf_dir):
    return _out(IN.read_valid(spark, _intake(spark, sf_dir)).drop("batch_id"))


@register("stream_intake_quarantine")
def q_stream_intake_quarantine(spark, sf_dir):
    rows = IN.read_quarantine(spark, _intake(spark, sf_dir))
    return _out(rows.select("event_time", "level", "message", "schema_id", "version", "reason"))


@register("stream_intake_batches")
def q_stream_intake_batches(spark, sf_dir):
    """Rows of all batches by the job's own lines."""
    return IN.read_batches(spark, _intake(spark, sf_dir)).agg(*(F.sum(c).alias(c) for c in IN.COUNTS))


@register("stream_batch_log")
def q_stream_batch_log(spark, sf_dir):
    """Rows per query of the batch log, which a listener writes."""
    root = run_folder(spark, "stream-log")
    name = f"incidents_{root[-12:]}"
    listener = BL.BatchLog(spark, f"{root}/log", {name})
    spark.streams.addListener(listener)
    try:
        wire = SS.read_wire_files(spark, _land_topic(spark, sf_dir))
        q = ST.start_enriched_sink(ST.incident_stream(wire), f"{root}/out", f"{root}/_checkpoint", trigger={"availableNow": True}, query_name=name)
        q.awaitTermination()
        BL.drain(spark)
    finally:
        spark.streams.removeListener(listener)
    return BL.read_batch_log(spark, f"{root}/log").agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_observed").alias("rows_observed"), F.sum("late_rows").alias("late_rows"))


# --- maintained tables -------------------------------------------------------------

#: Batches of the maintained tables' queries: rows by a hash of their id, so not in order of time.
BATCHES = 3


def _batches(enr: DataFrame) -> list[DataFrame]:
    return [enr.where(F.pmod(F.xxhash64("event_id"), F.lit(BATCHES)) == k) for k in range(BATCHES)]


@register("latest_maintained")
def q_latest_maintained(spark, sf_dir):
    """The latest row per incident as a table kept by batches that come out of order."""
    enr, path = enriched(spark, sf_dir), run_folder(spark, "latest")
    for k, batch in enumerate(_batches(enr)):
        LA.upsert(batch, k, path, tiebreak=["event_id"])
    return _out(LA.read_latest(spark, path, enr.schema))


def _rolled_up(spark, sf_dir) -> DataFrame:
    path = run_folder(spark, "rollup")
    for k, batch in enumerate(_batches(enriched(spark, sf_dir))):
        RO.add_batch(batch, k, path)
    return RO.read_rollup(spark, path)


@register("kpis_rollup")
def q_kpis_rollup(spark, sf_dir):
    """The headline counts from the hourly rollup of all batches."""
    return RO.kpis_of(_rolled_up(spark, sf_dir))


HOURS = ("2024-01-01 02:00:00", "2024-01-01 07:00:00")


@register("kpis_rollup_hours")
def q_kpis_rollup_hours(spark, sf_dir):
    """The headline counts of five hours, from the rollup."""
    return RO.kpis_of(_rolled_up(spark, sf_dir), *HOURS)


@register("compacted_hours")
def q_compacted_hours(spark, sf_dir):
    """All rows of an hour-partitioned table after its hours were packed by bytes."""
    live, root = run_folder(spark, "live"), run_folder(spark, "packed")
    enr = EN.fixed_order(enriched(spark, sf_dir))
    for k in range(BATCHES):
        SK.write_incidents(enr.where(F.pmod(F.xxhash64("message"), F.lit(BATCHES)) == k), live)
    CO.compact_hours(spark, live, root, enr.schema, before="2024-01-01_09")
    return _out(CO.read_hours(spark, live, root, enr.schema).select(*ENRICHED_COLUMNS))
