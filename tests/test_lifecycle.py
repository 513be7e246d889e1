"""Changelog validation, the fold without a loop, as-of evaluation."""

import datetime as dt
import json
import random

from ruleweave.operators.lifecycle import CHANGELOG_SCHEMA, active_rules, asof_alerts, decode_envelopes, rule_count, with_errors


def payload(rid, tag="v"):
    return {"id": rid, "title": f"{rid}-{tag}", "level": "low",
            "detection": {"s": {"log_type": tag}, "condition": "s"}}


def changelog(spark, envs):
    rows = [(i + 1, None, json.dumps(e)) for i, e in enumerate(envs)]
    raw = spark.createDataFrame(rows, "seq long, at_us long, value string")
    return decode_envelopes(raw, at_col="at_us")


def list_fold(envs):
    """The plain list semantics (append / replace all / remove all)."""
    rules = []
    for e in envs:
        op = e.get("op")
        if op == "add" and isinstance(e.get("rule"), dict):
            rules.append(e["rule"])
        elif op == "update" and "rule_id" in e and isinstance(e.get("rule"), dict) \
                and e["rule"].get("id") == e["rule_id"]:
            if any(r["id"] == e["rule_id"] for r in rules):
                rules = [e["rule"] if r["id"] == e["rule_id"] else r for r in rules]
            else:
                rules.append(e["rule"])
        elif op == "delete" and "rule_id" in e:
            rules = [r for r in rules if r["id"] != e["rule_id"]]
    return rules


def test_errors(spark):
    envs = [
        {"op": "add", "rule": payload("a")},
        {"op": "add", "rule_id": "zzz", "rule": payload("b")},      # add ignores the envelope id
        {"rule_id": "a"},                                         # missing op
        {"op": "update", "rule": payload("a")},                   # update without rule_id
        {"op": "update", "rule_id": "a", "rule": payload("c")},   # ids differ
        {"op": "add"},                                            # add without rule
        {"op": "add", "rule": {"id": "x", "title": "t"}},         # rule lacks fields
        {"op": "frobnicate", "rule_id": "a"},                     # unknown op
        {"op": "delete", "rule_id": "nope"},                      # unknown id: valid no-op
    ]
    rows = with_errors(changelog(spark, envs)).orderBy("seq").collect()
    assert [r.error is None for r in rows] == [True, True, False, False, False, False, False, False, True]
    bad = spark.createDataFrame([(1, None, "not json"), (2, None, "[1]")], "seq long, at_us long, value string")
    assert all(r.error for r in with_errors(decode_envelopes(bad, at_col="at_us")).collect())


def test_update_inserts_and_replaces_all(spark):
    envs = [{"op": "update", "rule_id": "a", "rule": payload("a", "1")},
            {"op": "add", "rule": payload("a", "2")},
            {"op": "update", "rule_id": "a", "rule": payload("a", "3")}]
    act = active_rules(changelog(spark, envs)).collect()
    assert [(r.rule_id, r.copies, r.rule_title) for r in act] == [("a", 2, "a-3")]
    assert rule_count(changelog(spark, envs)).first().rule_count == 2


def test_random_fold_equals_list_fold(spark):
    rnd = random.Random(3)
    cases = []
    for _ in range(60):
        envs = []
        for _ in range(rnd.randint(0, 12)):
            op = rnd.choice(["add", "add", "update", "delete", "bad"])
            rid = rnd.choice("xyz")
            tag = str(rnd.randint(0, 99))
            if op == "add":
                envs.append({"op": "add", "rule": payload(rid, tag)})
            elif op == "update":
                envs.append({"op": "update", "rule_id": rid, "rule": payload(rid, tag)})
            elif op == "delete":
                envs.append({"op": "delete", "rule_id": rid})
            else:
                envs.append({"op": "update", "rule_id": rid, "rule": payload("q", tag)})
        cases.append(envs)
    rows = []
    for c, envs in enumerate(cases):
        for i, e in enumerate(envs):
            rows.append((c * 100 + i + 1, None, json.dumps(e), c))
    raw = spark.createDataFrame(rows, "seq long, at_us long, value string, case_id long")
    # one changelog per case: prefix ids with the case so the folds stay apart
    from pyspark.sql import functions as F
    cl = decode_envelopes(raw, at_col="at_us").join(raw.select("seq", "case_id"), "seq")
    cl = cl.withColumn("rule_id", F.concat_ws("/", F.col("case_id").cast("string"), "rule_id")) \
           .withColumn("rule", F.when(F.col("rule").isNotNull(), F.expr(
               "to_json(named_struct('id', concat(cast(case_id as string), '/', get_json_object(rule, '$.id')),"
               " 'title', get_json_object(rule, '$.title'), 'level', get_json_object(rule, '$.level'),"
               " 'detection', from_json(get_json_object(rule, '$.detection'), 'map<string,string>')))")))
    got = {}
    for r in active_rules(cl.drop("case_id")).collect():
        c, rid = r.rule_id.split("/", 1)
        got.setdefault(int(c), []).extend([(rid, r.rule_title)] * r.copies)
    for c, envs in enumerate(cases):
        want = sorted((r["id"], r["title"]) for r in list_fold(envs))
        assert sorted(got.get(c, [])) == want, (c, envs)


def test_asof_window_reset_on_delete(spark, logs_of):
    """Five events, delete, re-add, five more: the window restarts, so no alert."""
    import datetime as dt
    base = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    us = lambda s: int((base + dt.timedelta(seconds=s)).timestamp() * 1_000_000)
    burst = {"id": "bf", "title": "bf", "level": "high",
             "detection": {"sel": {"log_type": "w"}, "condition": "sel | count() by host > 5", "timeframe": "60s"}}
    rows = [(1, us(0), json.dumps({"op": "add", "rule": burst})),
            (2, us(10), json.dumps({"op": "delete", "rule_id": "bf"})),
            (3, us(10), json.dumps({"op": "add", "rule": burst}))]
    cl = decode_envelopes(spark.createDataFrame(rows, "seq long, at_us long, value string"), at_col="at_us")
    logs = [{"timestamp": (base + dt.timedelta(seconds=s)).isoformat(), "host": "h", "log_type": "w"}
            for s in [1, 2, 3, 4, 5, 11, 12, 13, 14, 15]]
    view = logs_of(logs)
    assert asof_alerts(view, cl).count() == 0
    # without the delete the sixth event fires
    cl2 = decode_envelopes(spark.createDataFrame(rows[:1], "seq long, at_us long, value string"), at_col="at_us")
    assert asof_alerts(view, cl2).count() == 5


def test_asof_plain_versions(spark, logs_of):
    import datetime as dt
    base = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    us = lambda s: int((base + dt.timedelta(seconds=s)).timestamp() * 1_000_000)
    rows = [(1, us(0), json.dumps({"op": "add", "rule": payload("a", "x")})),
            (2, us(10), json.dumps({"op": "update", "rule_id": "a", "rule": payload("a", "y")})),
            (3, us(20), json.dumps({"op": "delete", "rule_id": "a"}))]
    cl = decode_envelopes(spark.createDataFrame(rows, "seq long, at_us long, value string"), at_col="at_us")
    logs = [{"timestamp": (base + dt.timedelta(seconds=s)).isoformat(), "log_type": t}
            for s, t in [(5, "x"), (5, "y"), (15, "x"), (15, "y"), (25, "y")]]
    got = sorted((r.seq, r.rule_title) for r in asof_alerts(logs_of(logs), cl).collect())
    assert got == [(0, "a-x"), (3, "a-y")]


def test_bad_rule_in_changelog_is_left_out(spark, logs_of):
    good = payload("a", "x")
    bad = {"id": "b", "title": "b", "level": "low", "detection": {"s": {"log_type": "x"}, "condition": "s and"}}
    bad_burst = {"id": "c", "title": "c", "level": "low",
                 "detection": {"s": {"log_type": "x"}, "condition": "s | count() by host > 1", "timeframe": "5d"}}
    cl = changelog(spark, [{"op": "add", "rule": good}, {"op": "add", "rule": bad}, {"op": "add", "rule": bad_burst}])
    got = [r.rule_id for r in asof_alerts(logs_of([{"log_type": "x", "timestamp": "2024-01-01T00:00:00Z"}]), cl).collect()]
    assert got == ["a"]


def test_timeframe_and_key_may_change_within_an_epoch(logs_of):
    """An update keeps the window: logs before it count, with the new span or key."""
    def version(tf, by="host"):
        return json.dumps({"id": "B", "title": "t", "level": "l", "detection": {
            "s": {"e": 1}, "condition": f"s | count() by {by} > 2", "timeframe": tf}})

    base = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    us = lambda s: int((base + dt.timedelta(seconds=s)).timestamp() * 1_000_000)
    logs = [{"timestamp": (base + dt.timedelta(seconds=10 * i)).isoformat(), "host": "h", "user": "uv"[i % 2], "e": 1}
            for i in range(12)]
    view = logs_of(logs)
    spark = view.df.sparkSession
    changes = [(1, us(0), "add", "B", version("15s")), (2, us(40), "update", "B", version("60s")),
               (3, us(80), "update", "B", version("60s", "user"))]
    got = sorted(r.seq for r in asof_alerts(view, spark.createDataFrame(changes, CHANGELOG_SCHEMA)).collect())
    expected = []
    for i in range(12):
        t = 10 * i
        span, by_user = (15, False) if t < 40 else (60, False) if t < 80 else (60, True)
        n = sum(t - span < 10 * j <= t and (not by_user or j % 2 == i % 2) for j in range(i + 1))
        if n > 2:
            expected.append(i)
    assert got == expected


def test_asof_logs_without_an_event_time(spark):
    """They meet the versions valid at their arrival time, or at time 0 where the source has none."""
    from ruleweave.sources.logs import decode_json_logs, json_view
    base = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    us = lambda s: int((base + dt.timedelta(seconds=s)).timestamp() * 1_000_000)
    burst = {"id": "b", "title": "b", "level": "high",
             "detection": {"s": {"log_type": "x"}, "condition": "s | count() by host > 1", "timeframe": "60s"}}
    rows = [(0, None, "add", "old", json.dumps(payload("old", "x"))), (1, us(0), "add", "a", json.dumps(payload("a", "x"))),
            (2, us(0), "add", "b", json.dumps(burst)), (3, us(10), "delete", "a", None),
            (4, us(20), "delete", "old", None), (5, us(20), "delete", "b", None)]
    cl = spark.createDataFrame(rows, CHANGELOG_SCHEMA)
    logs = [(i, base + dt.timedelta(seconds=s), json.dumps({"log_type": "x", "host": "h"}))
            for i, s in enumerate([-5, 5, 8, 15, 25])]
    good, _ = decode_json_logs(spark.createDataFrame(logs, "seq long, at timestamp, value string"))
    for arrival, expected in (("at", [("a", 1), ("a", 2), ("b", 2), ("b", 3), ("old", 0), ("old", 1), ("old", 2), ("old", 3)]),
                              (None, [("old", i) for i in range(5)])):
        view = json_view(good, order_cols=["seq"], keep=["seq"], arrival_col=arrival)
        assert sorted((r.rule_id, r.seq) for r in asof_alerts(view, cl).collect()) == expected
