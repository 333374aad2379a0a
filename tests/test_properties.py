"""Property tests: bucketed operators against brute force on random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lumenlog.operators import correlate as CR
from lumenlog.operators.feed import latest_per_incident
from lumenlog.operators.windows import window_counts

BASE = dt.datetime(2024, 1, 1)
HALF = dt.timedelta(minutes=30)

event = st.tuples(
    st.integers(0, 4 * 3600),                          # seconds after BASE
    st.sampled_from([0, 1, 999_999]),                  # microseconds: exact edges appear
    st.sampled_from(["svc-a", "svc-b", None]),
    st.sampled_from(["INC-1", "INC-2", "INC-3", "INC-4", None]),
    st.sampled_from(["INFO", "WARNING", "ERROR"]),
)
SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def to_rows(evs):
    return [(BASE + dt.timedelta(seconds=s, microseconds=u), lvl, f"m{i}", inc, svc, None, i)
            for i, (s, u, svc, inc, lvl) in enumerate(evs)]


SCHEMA = ("event_time timestamp, level string, message string, incident_id string, service string, "
          "category string, event_id long")


def brute_latest(rows):
    best = {}
    for r in rows:
        if r[3] is None:
            continue
        cur = best.get(r[3])
        if cur is None or (r[0], -r[6]) > (cur[0], -cur[6]):
            best[r[3]] = r
    return list(best.values())


def brute_pairs(prims, rows):
    out = set()
    for p in prims:
        if p[4] is None:
            continue
        for r in rows:
            if r[4] == p[4] and p[0] - HALF <= r[0] <= p[0] + HALF and r[3] != p[3]:
                out.add((p[3], r[6]))
    return out


@settings(**SETTINGS)
@given(evs=st.lists(event, max_size=40), width=st.sampled_from([1, 7, 30, 45, 120]), salt=st.sampled_from([1, 3]))
def test_correlation_matches_brute_force(spark, evs, width, salt):
    rows = to_rows(evs)
    df = spark.createDataFrame(rows, SCHEMA)
    prims = latest_per_incident(df, tiebreak=["event_id"])
    expected_prims = brute_latest(rows)
    assert sorted(r.event_id for r in prims.collect()) == sorted(r[6] for r in expected_prims)

    expected = brute_pairs(expected_prims, rows)
    pairs = CR.correlate_pairs(prims, df, bucket_minutes=width, salt=salt)
    got = [(r.primary_id, r.event_id) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == expected

    counts = {r.incident_id: r.n_correlated
              for r in CR.correlate_counts(prims, df, granule_seconds=width * 13).collect()}
    for p in expected_prims:
        assert counts[p[3]] == sum(1 for (pid, _) in expected if pid == p[3])


@settings(**SETTINGS)
@given(evs=st.lists(event, max_size=40), granule=st.sampled_from([1, 60, 600, 7200]))
def test_counts_for_every_row_as_primary(spark, evs, granule):
    """Every row as a primary, null ids and services included."""
    rows = to_rows(evs)
    df = spark.createDataFrame(rows, SCHEMA)
    by_granule = {r.event_id: r.n_correlated
                  for r in CR.correlate_counts(df, df, granule_seconds=granule).collect()}
    for p in rows:
        n = 0 if p[4] is None else sum(
            1 for r in rows if r[4] == p[4] and p[0] - HALF <= r[0] <= p[0] + HALF and r[3] != p[3])
        assert by_granule[p[6]] == n


@settings(**SETTINGS)
@given(evs=st.lists(event, max_size=60))
def test_window_counts_match_brute_force(spark, evs):
    rows = to_rows(evs)
    df = spark.createDataFrame(rows, SCHEMA)
    expected = {}
    for r in rows:
        start = BASE + dt.timedelta(minutes=5 * ((r[0] - BASE) // dt.timedelta(minutes=5)))
        expected[(start, r[1])] = expected.get((start, r[1]), 0) + 1
    got = {(r.window_start, r.level): r["count"] for r in window_counts(df).collect()}
    assert got == expected


TEXT = st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00\r"), min_size=1, max_size=30)


@settings(**SETTINGS)
@given(msgs=st.lists(TEXT, min_size=1, max_size=8))
def test_text_roundtrips_through_wire_and_csv(spark, tmp_dir, msgs):
    import uuid
    from lumenlog.operators.feed import clean_feed
    from lumenlog.sinks.files import write_incidents
    from lumenlog.sources import codec as CD
    from lumenlog.sources.files import read_incident_dir
    rows = [(BASE + dt.timedelta(seconds=i), "INFO", m, None, None, None) for i, m in enumerate(msgs)]
    df = spark.createDataFrame(rows, "event_time timestamp, level string, message string, incident_id string, "
                                     "service string, category string")
    wire = CD.decode_framed(CD.to_wire(df, key_col=None))
    assert sorted(r.message for r in wire.collect()) == sorted(msgs)
    out = f"{tmp_dir}/{uuid.uuid4().hex}"
    write_incidents(df, out, fmt="csv", mode="overwrite")
    back = clean_feed(read_incident_dir(spark, out, multi_line=True))
    assert sorted(r.message for r in back.collect()) == sorted(msgs)


turn = st.tuples(st.integers(0, 3), st.integers(0, 6), st.sampled_from(["system", "user", "assistant"]),
                 st.sampled_from(["a", "b c", "d\ne", None]))


@settings(**SETTINGS)
@given(turns=st.lists(turn, max_size=20, unique_by=lambda t: (t[0], t[1])))
def test_chat_history_matches_brute_force(spark, turns):
    from lumenlog.operators.prompts import chat_history
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.message, r.history, r.history_turns) for r in chat_history(df).collect()}
    expected = {}
    for cid in {t[0] for t in turns}:
        ts = sorted((t for t in turns if t[0] == cid), key=lambda t: t[1])
        users = [t[1] for t in ts if t[2] == "user"]
        last = max(users) if users else None
        msg = next((t[3] for t in ts if t[1] == last), None) if last is not None else None
        hist = [t for t in ts if last is None or t[1] < last]
        text = "\n".join(f"<{t[2]}> {'None' if t[3] is None else t[3]}" for t in hist)
        expected[cid] = (msg, text, len(hist))
    assert got == expected


@settings(**SETTINGS)
@given(evs=st.lists(event, max_size=60), k=st.sampled_from([1, 2, 3]))
def test_first_crossing_matches_brute_force(spark, evs, k):
    from lumenlog.operators.windows import alerts_first_crossing
    rows = to_rows(evs)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.window_start, r.crossing_event_id) for r in alerts_first_crossing(df, min_count=k).collect()}
    by_window = {}
    for r in rows:
        if r[1] == "ERROR":
            start = BASE + dt.timedelta(minutes=5 * ((r[0] - BASE) // dt.timedelta(minutes=5)))
            by_window.setdefault(start, []).append((r[0], r[6]))
    expected = {(w, sorted(v)[k - 1][1]) for w, v in by_window.items() if len(v) >= k}
    assert got == expected
