"""Burst windows, edges, ties and ids."""

import datetime as dt
import random
import uuid
from collections import deque

import pytest

from ruleweave.errors import RuleError
from ruleweave.operators import burst
from ruleweave.operators.burst import burst_alerts
from ruleweave.plans.rules import Rule, burst_spec

BASE = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return (BASE + dt.timedelta(seconds=seconds)).isoformat()


def brule(n=5, tf="60s", rid="bf", by="host", extra=None):
    det = {"selection": {"log_type": "windows_event", "event_id": "4625", **(extra or {})},
           "condition": f"selection | count() by {by} > {n}", "timeframe": tf}
    return Rule(id=rid, title="Brute force", level="high", detection=det)


def ev(sec, host="h", event_id=4625):
    return {"timestamp": at(sec), "host": host, "log_type": "windows_event", "event_id": event_id}


def fired(view, rules, **kw):
    return sorted((r.seq, r.window_count) for r in burst_alerts(view, rules, **kw).collect())


def test_threshold_is_strict_and_fires_every_event(logs_of):
    v = logs_of([ev(i) for i in range(7)])
    assert fired(v, [brule()]) == [(5, 6), (6, 7)]
    assert fired(logs_of([ev(i) for i in range(5)]), [brule()]) == []


def test_half_open_interval(logs_of):
    # events at 0 and 60, T = 60: the one at 0 is out when counting at 60
    v = logs_of([ev(0), ev(60)])
    assert fired(v, [brule(n=1)]) == []
    v = logs_of([ev(0), ev(59.9)])
    assert fired(v, [brule(n=1)]) == [(1, 2)]


def test_three_then_four(logs_of):
    v = logs_of([ev(0)] * 3 + [ev(70)] * 4)
    assert fired(v, [brule(n=3)]) == [(6, 4)]


def test_spread_out_events(logs_of):
    assert fired(logs_of([ev(0)] * 5 + [ev(15)]), [brule(n=5, tf="10s")]) == []
    assert fired(logs_of([ev(0)] * 2 + [ev(15)] * 3), [brule(n=2, tf="10s")]) == [(4, 3)]


def test_minutes_timeframe(logs_of):
    assert fired(logs_of([ev(0), ev(61), ev(119)]), [brule(n=2, tf="2m")]) == [(2, 3)]
    assert fired(logs_of([ev(0), ev(65), ev(65)]), [brule(n=2, tf="1m")]) == []


def test_hosts_isolated(logs_of):
    v = logs_of([ev(i, "a") for i in range(6)] + [ev(7, "b")])
    assert fired(v, [brule(n=5)]) == [(5, 6)]


def test_selection_prefilter(logs_of):
    v = logs_of([ev(i, event_id=4624) for i in range(10)] + [ev(10 + i) for i in range(5)])
    assert fired(v, [brule(n=5)]) == []


def test_burst_ids_share_bucket(logs_of):
    v = logs_of([ev(i) for i in range(8)])
    rows = burst_alerts(v, [brule()]).collect()
    ids = {r.alert_id for r in rows}
    bucket = int(BASE.timestamp() // 60)
    assert ids == {str(uuid.uuid5(uuid.NAMESPACE_OID, f"bf:h:{bucket}"))}


def test_missing_timestamp_bucket_zero(spark):
    from ruleweave.functions.ids import time_bucket
    from pyspark.sql import functions as F
    assert spark.range(1).select(time_bucket(F.lit(None).cast("long"), 60).alias("b")).first().b == 0


def test_declared_by_field(logs_of):
    v = logs_of([{**ev(i, host=f"h{i}"), "user": "u"} for i in range(4)])
    assert fired(v, [brule(n=3, by="user")]) == [(3, 4)]
    assert fired(v, [brule(n=3, by="host")]) == []


@pytest.mark.parametrize("cond,tf", [("selection | sum() by host > 5", "60s"), ("selection | count() by host > 5", "5d"),
                                     ("selection | count() by host > x", "60s"), ("nope | count() by host > 5", "60s")])
def test_bad_burst_rules(cond, tf):
    r = Rule(id="x", title="t", level="l", detection={"selection": {}, "condition": cond, "timeframe": tf})
    with pytest.raises(RuleError):
        burst_spec(r)


def deque_reference(events, window, n):
    """Arrival-order deque per host, counted at each event's own time."""
    out, dq = [], {}
    for seq, (t, host) in enumerate(events):
        d = dq.setdefault(host, deque())
        d.append(t)
        live = [x for x in d if x > t - window]
        if len(live) > n:
            out.append((seq, len(live)))
    return out


@pytest.mark.parametrize("chunk_factor", [1, 3])
def test_random_against_deque(logs_of, chunk_factor):
    rnd = random.Random(7)
    events = []
    t = 0
    for _ in range(400):
        t += rnd.choice([0, 0, 1, 2, 5, 13])      # many ties
        events.append((t, rnd.choice("abc")))
    v = logs_of([ev(t, h) for t, h in events])
    got = fired(v, [brule(n=3, tf="20s")], chunk_factor=chunk_factor)
    assert got == deque_reference(events, 20, 3)


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
def test_hot_key_and_ties_in_blocks_against_deque(logs_of, monkeypatch, block):
    """Ties cut into blocks of the arrival order count the same."""
    monkeypatch.setattr(burst, "TIE_BLOCK", block)
    rnd = random.Random(11)
    events, t = [], 0
    for _ in range(500):
        t += rnd.choice([0, 0, 0, 1, 4])
        events.append((t, rnd.choice("aaaab")))
    v = logs_of([ev(t, h) for t, h in events])
    assert fired(v, [brule(n=4, tf="15s")]) == deque_reference(events, 15, 4)


def test_all_logs_share_one_time(logs_of, monkeypatch):
    monkeypatch.setattr(burst, "TIE_BLOCK", 7)
    v = logs_of([ev(0) for _ in range(100)])
    assert fired(v, [brule(n=5)]) == [(i, i + 1) for i in range(5, 100)]


def test_null_keys_are_a_key(spark):
    rows = spark.createDataFrame([(None if i % 2 else "a", i * 1_000_000, i) for i in range(20)], "k string, t long, o long")
    got = burst.windowed_counts(rows, key_cols=["k"], time_col="t", order_cols=["o"], window_us=7_000_000).collect()
    assert sorted((r.o, r.window_count) for r in got) == [(i, min(i // 2 + 1, 4)) for i in range(20)]
    assert {r.k for r in got} == {None, "a"}


def test_logs_without_a_time_count_by_arrival(logs_of):
    """No timestamp and no arrival time: the logs arrive together, in their order; ids use bucket 0."""
    v = logs_of([{k: x for k, x in ev(0).items() if k != "timestamp"} for _ in range(8)])
    assert fired(v, [brule(n=5)]) == [(5, 6), (6, 7), (7, 8)]
    assert {r.alert_id for r in burst_alerts(v, [brule()]).collect()} == {str(uuid.uuid5(uuid.NAMESPACE_OID, "bf:h:0"))}


def test_arrival_time_drives_windows(spark):
    import json
    from ruleweave.sources.logs import decode_json_logs, json_view
    rows = [(i, json.dumps(ev(0)), BASE + dt.timedelta(seconds=20 * i)) for i in range(8)]
    good, _ = decode_json_logs(spark.createDataFrame(rows, "seq long, value string, arrived timestamp"))
    for time, expected in (("arrival", []), ("event", [(5, 6), (6, 7), (7, 8)])):
        v = json_view(good, order_cols=["seq"], keep=["seq"], time=time, arrival_col="arrived")
        assert fired(v, [brule(n=5)]) == expected


def test_other_keys_have_ids_of_their_own(logs_of):
    v = logs_of([{**ev(i), "user": "uv"[i % 2]} for i in range(12)])
    rows = burst_alerts(v, [brule(n=3, by="user")]).collect()
    assert len(rows) == 6 and len({r.alert_id for r in rows}) == 2


def test_building_the_plan_runs_no_job(logs_of, spark):
    v = logs_of([ev(i) for i in range(8)])
    sc = spark.sparkContext
    sc.setJobGroup("build-only", "no job before the action")
    burst_alerts(v, [brule()])
    jobs = sc.statusTracker().getJobIdsForGroup("build-only")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_reference_pack_brute_force(logs_of):
    """The bundled brute-force rule: more than 5 failed logins per host within 60 s."""
    import os
    from ruleweave.operators.evaluate import evaluate
    from ruleweave.plans.rules import load_rules
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "rules", "reference_pack")
    rules = load_rules(root)
    logs = [ev(i * 5, "ws-01") for i in range(7)] + [ev(100 + i * 20, "ws-02") for i in range(7)]
    logs.sort(key=lambda x: x["timestamp"])
    for x in logs:
        x["log_type"] = "windows_event"
    alerts = evaluate(logs_of(logs), rules).collect()
    brute = sorted((a.host, a.rule_id) for a in alerts if a.rule_id == "win-brute-force-001")
    failed = [a for a in alerts if a.rule_id == "win-failed-login-001"]
    assert brute == [("ws-01", "win-brute-force-001"), ("ws-01", "win-brute-force-001")]
    assert len(failed) == 14
    assert {a.severity for a in alerts if a.rule_id == "win-brute-force-001"} == {"high"}


def test_iso_parsing_like_fromisoformat(spark):
    from pyspark.sql import functions as F
    from ruleweave.functions.timeutil import iso_text_micros
    xs = ["2024-01-01T00:00:07.5Z", "2024-01-01T00:00:07.123+00:00", "2024-01-01T05:30:07+05:30", "2024-01-01",
          "2024-01-01T00:00:07.179575+00:00", "2024-01-01 00:00:07", "2024-01-01T00:00", "bad", "",
          "2024-01-01T00:00:07.1234567+00:00", "2024-01-01T01:00:00+0100"]
    got = [r.us for r in spark.createDataFrame([(x,) for x in xs], "t string")
           .select(iso_text_micros(F.col("t")).alias("us")).collect()]
    want = []
    for x in xs:
        try:
            d = dt.datetime.fromisoformat(x)
            d = d if d.tzinfo else d.replace(tzinfo=dt.timezone.utc)
            want.append(int(d.timestamp()) * 1_000_000 + d.microsecond)
        except ValueError:
            want.append(None)
    assert got == want
