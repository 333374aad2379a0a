"""DuckDB SQL twins of the registered queries (the correctness oracle).

The driver pre-registers the parquet tables as views.  Every rule, pattern,
threshold and prompt text is stated here again as a literal, on its own: a
wrong constant in the engine shows as a difference.
"""

from __future__ import annotations

# fixed values of the twins
INCIDENT_ID, SERVICE, CATEGORY = r"(INC-\w+)", r"Service: (\S+?)(?:[.,]|$)", r"Category: ([\w\s]+?)(?:[.,]|$)"
AFFECTED_USERS, DURATION, SYSTEM_ID = r"Affected users: (\d+)", r"(?:Duration|Recovery time): (\d+) minutes", r"(SYS-\d+)"
TEXT_FIELDS = {
    "severity": r"Severity: (\w+)",
    "assignee": r"Assigned to: (\S+?)(?:[.,]?\s|[.,]?$)",
    "resolver": r"Resolved by: (\S+?)(?:[.,]?\s|[.,]?$)",
    "escalation_team": r"Escalated to: (\S+?)(?:[.,]?\s|[.,]?$)",
    "attack_type": r"Attack type: ([^.,]+)",
    "source_ip": r"Source IP: (\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})",
    "database": r"Database: (\w+)",
    "service_lenient": r"Service: ([\w-]+)",
}
INT_FIELDS = {
    "affected_records": r"Records affected: (\d+)",
    "impact_pct": r"increased by (\d+)%",
    "cpu_pct": r"CPU: (\d+)%",
    "memory_pct": r"Memory: (\d+)%",
    "disk_pct": r"Disk: (\d+)%",
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ex(col: str, pattern: str) -> str:
    return f"nullif(regexp_extract({col}, {_q(pattern)}, 1), '')"


def _ex_int(col: str, pattern: str) -> str:
    return f"TRY_CAST({_ex(col, pattern)} AS INTEGER)"


INC = """
inc_tok AS (
  SELECT event_id, ts, event_type, value, user_id, CAST(round(value * 100) AS BIGINT) AS cents,
         coalesce(TRY_CAST(nullif(regexp_extract(props, '(\\d+)', 1), '') AS INTEGER), 0) AS k
  FROM events
),
inc_text AS (
  SELECT event_id, ts, event_type,
         concat_ws(', ',
           event_type || ' reading ' || cents,
           CASE WHEN k % 3 <> 0 THEN 'INC-' || user_id || 'K' || k END,
           CASE WHEN k % 7 <> 0 THEN 'Service: node-' || (user_id % 13) || CASE WHEN k % 5 = 0 THEN ' degraded' ELSE '' END END,
           CASE WHEN k % 4 = 1 THEN 'Category: ' || CASE WHEN value < 5 THEN 'Light Load' WHEN value < 20 THEN 'Steady Load' ELSE 'Heavy Load' END END,
           CASE WHEN k % 6 = 2 THEN 'Affected users: ' || user_id END,
           CASE WHEN k % 8 < 3 THEN 'Duration: ' || k || ' minutes' WHEN k % 8 = 3 THEN 'Recovery time: ' || k || ' minutes' END,
           CASE WHEN k % 9 < 4 THEN 'SYS-' || user_id END,
           CASE WHEN k % 10 = 4 THEN 'Severity: ' || CASE WHEN value < 10 THEN 'Minor' ELSE 'Major' END END,
           CASE WHEN k % 11 = 5 THEN 'Assigned to: crew.' || (user_id % 7) END,
           CASE WHEN k % 11 = 6 THEN 'Resolved by: crew.' || (user_id % 7) END,
           CASE WHEN k % 11 = 7 THEN 'Escalated to: crew.' || (user_id % 7) END,
           CASE WHEN k % 12 = 3 THEN 'Attack type: odd ' || event_type END,
           CASE WHEN k % 12 = 3 THEN 'Source IP: 198.51.100.' || k END,
           CASE WHEN k % 13 = 1 THEN 'Database: store' || (user_id % 5) END,
           CASE WHEN k % 13 = 1 THEN 'Records affected: ' || cents END,
           CASE WHEN k % 14 = 2 THEN 'Load increased by ' || k || '%' END,
           CASE WHEN k % 15 = 4 THEN 'CPU: ' || k || '%' END,
           CASE WHEN k % 15 = 4 THEN 'Memory: ' || k || '%' END,
           CASE WHEN k % 15 = 4 THEN 'Disk: ' || k || '%' END) AS message
  FROM inc_tok
),
inc AS (
  SELECT event_id,
         make_timestamp(epoch_us(TIMESTAMP '2024-01-01') + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 60) AS event_time,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARNING' ELSE 'INFO' END AS level,
         event_type || CASE WHEN contains(message, 'INC-') THEN '_case' ELSE '_note' END AS action,
         message
  FROM inc_text
)"""

ENR = f"""
enr AS (
  SELECT event_time, level, message,
         {_ex('message', INCIDENT_ID)} AS incident_id,
         {_ex('message', SERVICE)} AS service,
         {_ex('message', CATEGORY)} AS category,
         event_id
  FROM inc
)"""

EXT = f"""
ext AS (
  SELECT *,
         {_ex_int('message', AFFECTED_USERS)} AS affected_users,
         {_ex_int('message', DURATION)} AS duration,
         {_ex('message', SYSTEM_ID)} AS system_id,
         level = 'ERROR' AS is_critical
  FROM enr
)"""


LATEST = """
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY event_time DESC NULLS LAST, event_id) AS rn
    FROM enr WHERE incident_id IS NOT NULL) t
  WHERE rn = 1
)"""

DEC = f"""
dec AS (
  SELECT CASE WHEN event_id % 101 = 0 OR event_id % 107 = 0
              THEN NULL ELSE event_time END AS event_time,
         CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0
              THEN NULL ELSE level END AS level,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE message END AS message,
         event_id
  FROM inc
)"""


CORR_COND = (f"r.service = p.service AND r.event_time BETWEEN p.event_time - INTERVAL "
             f"30 MINUTE AND p.event_time + INTERVAL "
             f"30 MINUTE AND r.incident_id IS DISTINCT FROM p.incident_id")


def render_ts(col: str) -> str:
    """Twin of ``functions.timefmt.render_ts``."""
    return (f"CASE WHEN epoch_us({col}) % 1000000 = 0 THEN strftime({col}, '%Y-%m-%d %H:%M:%S') "
            f"ELSE strftime({col}, '%Y-%m-%d %H:%M:%S.%f') END")


def render_iso_local(col: str) -> str:
    return (f"CASE WHEN epoch_us({col}) % 1000000 = 0 THEN strftime({col}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({col}, '%Y-%m-%dT%H:%M:%S.%f') END")


def render_iso(col: str) -> str:
    return (f"CASE WHEN epoch_us({col}) % 1000000 = 0 THEN strftime({col}, '%Y-%m-%dT%H:%M:%S') || '+00:00' "
            f"ELSE strftime({col}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END")


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


WINDOW_US = 5 * 60 * 1_000_000

WINDOW_COUNTS = f"""
wc AS (
  SELECT make_timestamp((epoch_us(event_time) // {WINDOW_US}) * {WINDOW_US}) AS window_start,
         make_timestamp((epoch_us(event_time) // {WINDOW_US}) * {WINDOW_US} + {WINDOW_US}) AS window_end,
         level, count(*) AS count
  FROM enr WHERE event_time IS NOT NULL
  GROUP BY 1, 2, 3
)"""


def alert_text_sql(count: str, level: str, start: str, end: str) -> str:
    return (f"'Alert: ' || CAST({count} AS VARCHAR) || ' ' || {level} || ' events from ' || "
            f"{render_ts(start)} || ' to ' || {render_ts(end)}")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["enrich"] = with_(INC, ENR, body="SELECT event_time, level, message, incident_id, service, category, event_id FROM enr")

    q["enrich_extended"] = with_(INC, ENR, EXT, body="SELECT * FROM ext")

    tf = ",\n".join([f"{_ex('message', p)} AS {n}" for n, p in TEXT_FIELDS.items()]
                    + [f"{_ex_int('message', p)} AS {n}" for n, p in INT_FIELDS.items()])
    q["enrich_template_fields"] = with_(INC, ENR, body=f"SELECT *, {tf} FROM enr")

    q["enrich_service_prose"] = with_(INC, ENR, body=f"""
SELECT *, coalesce({_ex('message', TEXT_FIELDS['service_lenient'])}, {_ex('message', 'error reading ([-A-Za-z0-9_]+)')}, {_ex('message', 'click reading ([-A-Za-z0-9_]+)')}) AS service_any FROM enr""")

    q["window_counts"] = with_(INC, ENR, WINDOW_COUNTS, body="SELECT * FROM wc")

    q["alerts"] = with_(INC, ENR, WINDOW_COUNTS, body=f"""
SELECT window_start, window_end, level, count,
       {alert_text_sql('count', 'level', 'window_start', 'window_end')} AS alert_text
FROM wc WHERE level = 'ERROR' AND count >= 3""")

    q["alerts_first_crossing"] = with_(INC, ENR, body=f"""
SELECT window_start, window_end, level, event_time AS crossing_time, event_id AS crossing_event_id
FROM (
  SELECT make_timestamp((epoch_us(event_time) // {WINDOW_US}) * {WINDOW_US}) AS window_start,
         make_timestamp((epoch_us(event_time) // {WINDOW_US}) * {WINDOW_US} + {WINDOW_US}) AS window_end,
         level, event_time, event_id,
         row_number() OVER (PARTITION BY epoch_us(event_time) // {WINDOW_US} ORDER BY event_time, event_id) AS rn
  FROM enr WHERE level = 'ERROR' AND event_time IS NOT NULL
) t WHERE rn = 3""")

    q["hourly_rollup"] = with_(INC, ENR, body="""
SELECT date_trunc('hour', event_time) AS event_hour, level, count(*) AS count
FROM enr WHERE event_time IS NOT NULL GROUP BY 1, 2""")

    q["counts_by_action"] = with_(INC, body="SELECT action, level, count(*) AS count FROM inc GROUP BY 1, 2")

    # --- KPIs ---------------------------------------------------------------
    q["kpis"] = with_(INC, ENR, body="""
SELECT count(*) AS total,
       count(*) FILTER (WHERE level = 'ERROR') AS critical,
       count(*) FILTER (WHERE level = 'WARNING') AS warning,
       count(DISTINCT service) AS services
FROM enr""")
    q["kpis_legacy"] = with_(INC, ENR, EXT, body="""
SELECT count(*) AS total,
       count(*) FILTER (WHERE is_critical) AS critical,
       count(*) FILTER (WHERE upper(level) = 'ERROR') AS error,
       count(DISTINCT service) AS services
FROM ext""")

    # --- feed ---------------------------------------------------------------
    cols = "event_time, level, message, incident_id, service, category, event_id"
    q["feed_clean"] = with_(INC, ENR, body=f"""
SELECT * FROM (
  SELECT TRY_CAST(txt AS TIMESTAMP) AS event_time, level, message, incident_id, service, category, event_id
  FROM (SELECT *, CASE WHEN event_id % 7 = 3 THEN 'not-a-time'
                       WHEN event_id % 11 = 5 THEN NULL
                       WHEN event_id % 2 = 0 THEN {render_iso('event_time')}
                       ELSE {render_ts('event_time')} END AS txt
        FROM enr) t
) c WHERE event_time IS NOT NULL""")
    q["feed_recent"] = with_(INC, ENR, body=f"""
SELECT {cols} FROM enr ORDER BY event_time DESC NULLS LAST, event_id""")
    q["feed_filtered"] = with_(INC, ENR, body=f"""
SELECT {cols} FROM enr WHERE level = 'WARNING' AND service = 'node-3'
ORDER BY event_time DESC NULLS LAST, event_id""")
    q["feed_json"] = with_(INC, ENR, body=f"""
SELECT to_json({{'event_time': {render_iso_local('event_time')}, 'level': level, 'message': message,
                 'incident_id': incident_id, 'service': service, 'category': category}}) AS record
FROM enr""")
    q["kpis_empty"] = with_(INC, ENR, body="""
SELECT count(*) AS total, count(*) FILTER (WHERE level = 'ERROR') AS critical,
       count(*) FILTER (WHERE level = 'WARNING') AS warning, count(DISTINCT service) AS services
FROM enr WHERE level = 'NO SUCH LEVEL'""")
    q["feed_clean_nan"] = with_(INC, body="""
SELECT inc.event_id, event_time, CASE WHEN inc.event_id % 5 = 0 THEN NULL ELSE events.value END AS value
FROM inc JOIN events ON inc.event_id = events.event_id""")
    q["strict_times"] = with_(INC, ENR, body=f"""
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_time END AS event_time FROM enr""")
    q["csv_union_by_header"] = with_(INC, ENR, body="""
SELECT event_time, level, message,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE incident_id END AS incident_id,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE service END AS service,
       CASE WHEN event_id % 3 = 0 THEN category END AS category
FROM enr""")
    q["has_incident_ids"] = with_(INC, ENR, body=f"""
SELECT coalesce(bool_or(incident_id IS NOT NULL), false) AS has_incident_ids
FROM enr WHERE level = 'WARNING'""")
    q["distinct_levels"] = with_(INC, ENR, body="SELECT DISTINCT level FROM enr")
    q["distinct_services"] = with_(INC, ENR, body="SELECT DISTINCT service FROM enr WHERE service IS NOT NULL")
    q["distinct_incident_ids"] = with_(INC, ENR, body=
        "SELECT DISTINCT incident_id FROM enr WHERE incident_id IS NOT NULL")
    q["latest_per_incident"] = with_(INC, ENR, LATEST, body=f"SELECT {cols} FROM latest")
    q["lookup_incident"] = with_(INC, ENR, LATEST, body=f"""
SELECT {cols} FROM latest
WHERE incident_id = (SELECT min(incident_id) FROM enr WHERE service IS NOT NULL)""")

    # --- versions and files ---------------------------------------------------
    # damaged records have no time
    dec_ext = EXT.replace("ext AS", "dec_ext AS").replace("FROM enr", "FROM dec_enr_id")
    dec_enr_id = ENR.replace("enr AS", "dec_enr_id AS").replace("FROM inc", "FROM dec")
    q["union_versions"] = with_(INC, DEC, dec_enr_id, dec_ext, body=f"""
SELECT * FROM dec_ext WHERE event_time >= TIMESTAMP '2024-01-01 06:00:00'
UNION ALL BY NAME
SELECT event_time, level, message, incident_id, service, category, event_id FROM dec_ext
WHERE event_time IS NULL OR event_time < TIMESTAMP '2024-01-01 06:00:00'""")
    six = "SELECT event_time, level, message, incident_id, service, category FROM enr"
    q["csv_roundtrip"] = with_(INC, ENR, body=six)
    q["parquet_roundtrip"] = with_(INC, ENR, body=six)

    # --- wire codec and quality -------------------------------------------------
    q["decode_framed"] = with_(INC, DEC, body="SELECT * FROM dec")
    q["decode_plain"] = with_(INC, body="SELECT event_time, level, message, event_id FROM inc")
    q["frame_schema_ids"] = with_(INC, body=f"""
SELECT '00' AS magic,
       CAST(CASE WHEN event_id % 109 = 0 THEN 2 ELSE 1 END AS BIGINT) AS schema_id,
       count(*) AS count
FROM inc GROUP BY 1, 2""")
    q["decode_registry"] = with_(INC, DEC, body=f"""
SELECT dec.*, CAST(CASE WHEN event_id % 109 = 0 THEN 2 ELSE 1 END AS BIGINT) AS schema_id,
       CASE WHEN event_id % 109 = 0 THEN 'v2' ELSE 'v1' END AS version
FROM dec""")
    q["frame_roundtrip"] = with_(INC, body="SELECT event_id, event_time, level, message, action FROM inc")
    q["quality_split"] = with_(INC, DEC, body="""
SELECT * EXCLUDE (r),
       CASE WHEN r IS NULL THEN 'valid' ELSE 'quarantine' END AS quality,
       r AS reason
FROM (SELECT *, CASE WHEN event_time IS NULL AND level IS NULL AND message IS NULL THEN 'unreadable'
                     WHEN event_time IS NULL THEN 'missing_event_time'
                     WHEN level IS NULL THEN 'missing_level'
                     WHEN message IS NULL THEN 'missing_message' END AS r
      FROM dec) t""")

    # --- correlation -----------------------------------------------------------
    pair_cols = ("p.incident_id AS primary_id, p.event_time AS primary_time, r.event_time, r.level, "
                 "r.message, r.incident_id, r.service, r.category, r.event_id")
    q["correlate_pairs"] = with_(INC, ENR, LATEST, body=f"""
SELECT {pair_cols} FROM latest p JOIN enr r ON {CORR_COND}""")
    q["correlate_one"] = with_(INC, ENR, LATEST, body=f"""
SELECT {pair_cols} FROM latest p JOIN enr r ON {CORR_COND}
WHERE p.incident_id = (SELECT min(incident_id) FROM enr WHERE service IS NOT NULL)""")
    latest_f = f"""
latest_f AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY event_time DESC NULLS LAST, event_id) AS rn
    FROM enr WHERE incident_id IS NOT NULL AND level = 'WARNING') t
  WHERE rn = 1
)"""
    q["correlate_filtered"] = with_(INC, ENR, latest_f, body=f"""
SELECT {pair_cols} FROM latest_f p JOIN enr r ON {CORR_COND}""")
    q["correlate_counts"] = with_(INC, ENR, LATEST, body=f"""
SELECT p.event_time, p.level, p.message, p.incident_id, p.service, p.category, p.event_id,
       count(r.event_id) AS n_correlated
FROM latest p LEFT JOIN enr r ON {CORR_COND}
GROUP BY ALL""")
    q["correlate_counts_granular"] = q["correlate_counts"]
    q["report_correlate_counts_filtered"] = q["correlate_counts"].replace(LATEST, latest_f).replace("FROM latest p", "FROM latest_f p")
    q["correlate_one_oldest_first"] = q["correlate_one"] + " ORDER BY r.event_time, r.event_id"
    q["correlate_one_newest_first"] = q["correlate_one"] + " ORDER BY r.event_time DESC, r.event_id"

    # --- prompts -----------------------------------------------------------------
    def none(expr):
        return f"coalesce(CAST({expr} AS VARCHAR), 'None')"

    line = f"'- ' || {none(render_ts('event_time'))} || ' | ' || {none('level')} || ' | ' || {none('message')}"
    wanted = """
WANTED (Markdown, cite evidence lines, say "unknown" rather than guess)
"""

    def rca(full, chosen=""):
        order = "epoch_us(event_time)" + ("" if full else " DESC")
        txt = f"""
pairs AS (SELECT p.incident_id AS primary_id, r.* FROM latest p JOIN enr r ON {CORR_COND}),
txt AS (SELECT primary_id, string_agg({line}, chr(10) ORDER BY {order}, event_id) AS correlated
        FROM pairs GROUP BY primary_id)"""
        found = "coalesce(txt.correlated, '(nothing else on this service in that hour)')"
        if full:
            prompt = (f"""'EVIDENCE\n[primary] ' || {none('p.incident_id')} || ' at ' || {none(render_ts('p.event_time'))} || ', level ' || {none('p.level')} || ', category ' || {none('p.category')} || ', on ' || {none('p.service')} || ': ' || {none('p.message')} || '\n[same service, half an hour either way, in order of time]\n' || {found} || """
                      f"""'\n{wanted}1. Impact, from first sign to recovery.\n2. Sequence: which line led to which, with the gaps in between.\n3. Cause: one explanation that covers all lines; list those it leaves out.\n4. Checklist for ' || {none('p.service')} || ': stop it now, keep it from coming back.\n'""")
        else:
            prompt = (f"""'EVIDENCE\n[primary] ' || {none('p.incident_id')} || ' on ' || {none('p.service')} || ': ' || {none('p.message')} || '\n[same service, half an hour either way]\n' || {found} || """
                      f"""'\n{wanted}1. Impact: who noticed, and how.\n2. Sequence: a table of time, line and what it shows.\n3. Cause: the best-supported explanation and what would disprove it.\n4. Repair: what to do in this shift, what to change for good.\n'""")
        return with_(INC, ENR, LATEST, txt, body=f"""
SELECT p.incident_id, {prompt} AS prompt
FROM latest p LEFT JOIN txt ON txt.primary_id = p.incident_id {chosen}""")

    smallest = "WHERE p.incident_id = (SELECT min(incident_id) FROM enr WHERE service IS NOT NULL)"
    q["rca_prompt"] = rca(False)
    q["rca_prompt_full"] = rca(True)
    q["rca_prompt_one"] = rca(False, smallest)
    q["rca_prompt_full_one"] = rca(True, smallest)

    latest_ext = """
latest_ext AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY event_time DESC NULLS LAST, event_id) AS rn
    FROM ext WHERE incident_id IS NOT NULL) t
  WHERE rn = 1
)"""

    def single(users, minutes, host, critical, table):
        return f"""
SELECT incident_id, 'RECORD\nid=' || {none('incident_id')} || '; level=' || {none('level')} || '; service=' || {none('service')} || '; category=' || {none('category')} || '; time=' || {none(render_ts('event_time'))} || '\nusers=' || {none(users)} || '; minutes=' || {none(minutes)} || '; host=' || {none(host)} || '; critical=' || {none(critical)} || '\ntext=' || {none('message')} || '\n
WANTED (Markdown, from this record alone)
- Likely cause, and what record would confirm it.
- Next steps by hour, by day, by month.
- What it may cost if it happens again, and which signal to alert on.\n' AS prompt FROM {table}"""

    crit = "CASE WHEN is_critical THEN 'True' WHEN NOT is_critical THEN 'False' END"
    q["single_prompt"] = with_(INC, ENR, EXT, latest_ext, body=single("affected_users", "duration", "system_id", crit, "latest_ext"))
    q["single_prompt_plain"] = with_(INC, ENR, LATEST, body=single("'N/A'", "'N/A'", "'N/A'", "'N/A'", "latest"))

    hist_line = f"'<' || {none('c.role')} || '> ' || {none('c.text')}"
    chat = f"""
lu AS (SELECT conv_id, max(turn) AS last_user FROM conversations WHERE role = 'user' GROUP BY conv_id),
hist AS (
  SELECT c.conv_id,
         max(CASE WHEN c.turn = lu.last_user THEN c.text END) AS message,
         coalesce(string_agg(CASE WHEN lu.last_user IS NULL OR c.turn < lu.last_user THEN {hist_line} END,
                             chr(10) ORDER BY c.turn, c.role, c.text), '') AS history,
         count(*) FILTER (WHERE lu.last_user IS NULL OR c.turn < lu.last_user) AS history_turns
  FROM conversations c LEFT JOIN lu ON c.conv_id = lu.conv_id
  GROUP BY c.conv_id
)"""
    q["chat_history"] = with_(chat, body="SELECT conv_id, message, history, history_turns FROM hist")
    ctx = f"""
ctx AS (
  SELECT event_id // 10 AS conv_id,
         string_agg('* ' || {none(render_ts('event_time'))} || ' ' || {none('message')}, chr(10) ORDER BY event_time DESC, message) AS context
  FROM enr GROUP BY 1
)"""
    q["chat_prompt"] = with_(INC, ENR, ctx, chat, body=f"""
SELECT hist.conv_id, 'TRANSCRIPT\n' || hist.history || '\nINCIDENTS AT HAND\n' || coalesce(ctx.context, '') || '\nQUESTION\n' || {none('hist.message')} ||
       '\nAnswer the question for an engineer on call; use the transcript and the incidents.\n' AS prompt
FROM hist LEFT JOIN ctx ON hist.conv_id = ctx.conv_id""")

    # --- streaming ---------------------------------------------------------------
    dec_enr = f"""
dec_enr AS (
  SELECT event_time, level, message,
         {_ex('message', INCIDENT_ID)} AS incident_id,
         {_ex('message', SERVICE)} AS service,
         {_ex('message', CATEGORY)} AS category
  FROM inc
)"""
    q["stream_enriched_sink"] = with_(INC, dec_enr, body="SELECT * FROM dec_enr")
    q["stream_alerts_final"] = with_(INC, dec_enr, WINDOW_COUNTS.replace("FROM enr", "FROM dec_enr"), body=f"""
SELECT window_start, window_end, level, count,
       {alert_text_sql('count', 'level', 'window_start', 'window_end')} AS alert_text
FROM wc WHERE level = 'ERROR' AND count >= 3""")
    q["stream_first_crossing"] = with_(INC, dec_enr, body=f"""
SELECT window_start, window_end, level, event_time AS crossing_time, message AS crossing_message
FROM (
  SELECT make_timestamp((epoch_us(event_time) // {WINDOW_US}) * {WINDOW_US}) AS window_start,
         make_timestamp((epoch_us(event_time) // {WINDOW_US}) * {WINDOW_US} + {WINDOW_US}) AS window_end,
         level, event_time, message,
         row_number() OVER (PARTITION BY epoch_us(event_time) // {WINDOW_US} ORDER BY event_time, message) AS rn
  FROM dec_enr WHERE level = 'ERROR' AND event_time IS NOT NULL
) t WHERE rn = 3""")
    intake = f"""
taken AS (
  SELECT *, CAST(CASE WHEN event_id % 109 = 0 THEN 2 ELSE 1 END AS BIGINT) AS schema_id, CASE WHEN event_id % 109 = 0 THEN 'v2' ELSE 'v1' END AS version,
         CASE WHEN event_time IS NULL AND level IS NULL AND message IS NULL THEN 'unreadable'
              WHEN event_time IS NULL THEN 'missing_event_time' WHEN level IS NULL THEN 'missing_level' WHEN message IS NULL THEN 'missing_message' END AS reason
  FROM dec
)"""
    q["stream_intake_valid"] = with_(INC, DEC, intake, body=f"""
SELECT event_time, level, message, {_ex('message', INCIDENT_ID)} AS incident_id, {_ex('message', SERVICE)} AS service,
       {_ex('message', CATEGORY)} AS category, schema_id, version
FROM taken WHERE reason IS NULL""")
    q["stream_intake_quarantine"] = with_(INC, DEC, intake, body="SELECT event_time, level, message, schema_id, version, reason FROM taken WHERE reason IS NOT NULL")
    q["stream_intake_batches"] = with_(INC, DEC, intake, body="""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count(reason) AS BIGINT) AS valid, CAST(count(reason) AS BIGINT) AS quarantined,
       CAST(0 AS BIGINT) AS unknown_schema FROM taken""")
    q["stream_batch_log"] = with_(INC, body="SELECT CAST(count(*) AS BIGINT) AS rows_in, CAST(count(*) AS BIGINT) AS rows_observed, CAST(0 AS BIGINT) AS late_rows FROM inc")
    q["lookup_indexed"] = q["lookup_incident"]

    # --- maintained tables ---------------------------------------------------------
    q["latest_maintained"] = q["latest_per_incident"]
    q["kpis_rollup"] = q["kpis"]
    q["kpis_rollup_hours"] = with_(INC, ENR, body="""
SELECT count(*) AS total,
       count(*) FILTER (WHERE level = 'ERROR') AS critical,
       count(*) FILTER (WHERE level = 'WARNING') AS warning,
       count(DISTINCT service) AS services
FROM enr WHERE event_time >= TIMESTAMP '2024-01-01 02:00:00' AND event_time < TIMESTAMP '2024-01-01 07:00:00'""")
    q["compacted_hours"] = q["parquet_roundtrip"]
    q["correlate_counts_cut"] = q["correlate_counts"]
    q["correlate_pairs_cut"] = q["correlate_pairs"]

    return q
