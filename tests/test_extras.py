"""J9 documents, S3 on Spark, E2 conditions, A10 coarse bursts, M4 on a stream, K4 empty batch."""

import json
import os
import random

from pyspark.sql import functions as F

from ruleweave.operators.evaluate import alerts_json, plain_alerts
from ruleweave.operators import ruletable
from ruleweave.operators.ruletable import CONDITIONS_SCHEMA, conditions_frame, rules_frame, split_for_table, table_alerts
from ruleweave.plans.rules import Rule, load_rules

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_alert_documents(logs_of):
    v = logs_of([{"host": "h", "event_id": 4625, "nested": {"a": [1, 2]}}])
    r = Rule("r", "t", "high", {"s": {"event_id": 4625}, "condition": "s"})
    doc = json.loads(alerts_json(plain_alerts(v, [r])).first().value)
    assert set(doc) == {"alert_id", "rule_id", "rule_title", "severity", "matched_at", "host", "raw_log"}
    assert doc["raw_log"]["event_id"] == 4625 and doc["raw_log"]["nested"] == {"a": [1, 2]}


def test_rules_frame_matches_loader(spark, tmp_path):
    folder = os.path.join(ROOT, "rules", "reference_pack")
    got = rules_frame(spark, folder).orderBy("path").collect()
    want = load_rules(folder)
    assert [r.id for r in got] == [r.id for r in want]
    assert all(r.error is None for r in got)
    bad = tmp_path / "bad.yml"
    bad.write_text("id: x\ntitle: t\n")
    (tmp_path / "note.txt").write_text("not a rule")
    rows = rules_frame(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and "level" in rows[0].error


def test_conditions_frame_equals_driver_flattening(spark):
    rules = load_rules(os.path.join(ROOT, "rules", "events"))
    plain = [r for r in rules if not r.is_burst]
    df = spark.createDataFrame([(i, r.id, r.title, r.level, json.dumps(r.detection)) for i, r in enumerate(plain)],
                               "rule_ord int, id string, title string, level string, detection string")
    conditions, listed, left_out = conditions_frame(df)
    rows, rule_list, rest = split_for_table(plain)
    assert sorted(map(repr, map(tuple, conditions.collect()))) == sorted(map(repr, rows))
    assert rest == [] and left_out.count() == 0
    assert {r.rule_ord: [c.asDict(True) for c in r.clauses] for r in listed.collect()} == {
        r[0]: r[4] for r in rule_list}


def test_rules_left_out_have_a_reason(spark):
    df = spark.createDataFrame([
        (0, "ok", '{"s": {"a": 1}, "condition": "s"}'), (1, "unknown", '{"s": {"a": 1}, "condition": "t"}'),
        (2, "open", '{"s": {"a": 1}, "condition": "( s"}'), (3, "null", None), (4, "list", '{"s": [1], "condition": "s"}'),
        (5, "never", '{"s": {"a": []}, "condition": "s"}')], "rule_ord int, id string, detection string").selectExpr(
        "rule_ord", "id", "'t' title", "'low' level", "detection")
    conditions, listed, left_out = conditions_frame(df)
    assert sorted(r.rule_id for r in listed.collect()) == ["never", "ok"]
    assert [r.rule_id for r in conditions.collect()] == ["ok"]
    assert {r.rule_id: bool(r.error) for r in left_out.collect()} == dict.fromkeys(["unknown", "open", "null", "list"], True)


def test_random_conditions_as_data_equal_compiled(spark, logs_of):
    rng = random.Random(5)
    fields = ["a", "b", "c"]
    texts = ["", "x", "xy", "xyz", "wxyz", "yz\u00e9\U0001f600z", "abcabcd", "abcab", "zzzzzzzzz"]
    v = logs_of([{f: rng.choice([*texts, None, 4, True]) for f in fields if rng.random() < 0.7} for _ in range(60)])

    def group():
        out = {}
        for _ in range(rng.choice([0, 1, 1, 1, 2])):
            mod = rng.choice(["", "", "|contains", "|startswith", "|endswith", "|re"])
            t = rng.choice(texts)
            out[rng.choice(fields) + mod] = rng.choice([t, t[1:], t[:-1], 4, [t, rng.choice(texts)], []])
        return out

    def condition(depth):
        if depth == 0 or rng.random() < 0.25:
            return rng.choice(["not ", ""]) + rng.choice(["g0", "g1", "g2", "g3"])
        inner = f" {rng.choice(['and', 'or'])} ".join(condition(depth - 1) for _ in range(rng.choice([2, 2, 3])))
        return rng.choice(["not ( {} )", "( {} )"]).format(inner)

    rules = [Rule(f"r{i}", "t", "l", {**{f"g{k}": group() for k in range(4)}, "condition": condition(2)})
             for i in range(60)]
    assert split_for_table(rules)[2] == []
    got = sorted((r.seq, r.rule_id) for r in table_alerts(spark, v, rules, key_cols=["seq"]).collect())
    want = sorted((r.seq, r.rule_id) for r in plain_alerts(v, rules).collect())
    assert got == want and len(got) > 500


def test_many_clauses_are_compiled(spark, logs_of):
    groups = {f"g{i}": {f"f{i}": "x"} for i in range(24)}
    rule = Rule("r", "t", "l", {**groups, "condition": " and ".join(f"( g{i} or g{i + 1} )" for i in range(0, 24, 2))})
    v = logs_of([{f"f{i}": "x" for i in range(0, 24, 2)}, {"f0": "x"}])
    assert split_for_table([rule])[2] == [0]
    assert [r.seq for r in table_alerts(spark, v, [rule], key_cols=["seq"]).collect()] == [0]


def test_contains_conditions_meet_few_values(spark):
    """5,000 patterns: what the join brings together stays within ten times the matches."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(5000)]
    patterns = spark.createDataFrame([(i, f"r{i}", 0, 0, "a", "contains", w) for i, w in enumerate(words)], CONDITIONS_SCHEMA)
    values = spark.createDataFrame([(" ".join(rng.sample(words, 4)),) for _ in range(400)], "v string")
    pairs = values.select("v", F.explode(ruletable._runs(F.col("v"), 3)).alias("jv")).join(
        ruletable.found_by(patterns), "jv")
    met = pairs.where(F.col("v").contains(F.col("value"))).count()
    assert met >= 1600 and pairs.count() <= 10 * met


def test_table_path_on_json_logs(spark, logs_of):
    v = logs_of([{"a": "x", "b": "yes"}, {"a": "x"}, {"a": "zzz"}, {"c": "pre-fix"}])
    rules = [Rule("and", "t", "l", {"s1": {"a": "x"}, "s2": {"b|endswith": "es"}, "condition": "s1 and s2"}),
             Rule("or", "t", "l", {"s1": {"a": ["zzz", "q"]}, "s2": {"c|startswith": "pre"}, "condition": "s1 or s2"}),
             Rule("not", "t", "l", {"s1": {"a": "x"}, "s2": {"b": "yes"}, "condition": "s1 and not s2"})]
    got = sorted((r.seq, r.rule_id) for r in table_alerts(spark, v, rules, key_cols=["seq"]).collect())
    want = sorted((r.seq, r.rule_id) for r in plain_alerts(v, rules).collect())
    assert got == want == [(0, "and"), (1, "not"), (2, "or"), (3, "or")]


def test_coarse_bursts(spark, logs_of):
    import datetime as dt
    from ruleweave.streaming.bursts import coarse_bursts
    from ruleweave.streaming.pipeline import burst_rows
    base = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    v = logs_of([{"timestamp": (base + dt.timedelta(seconds=s)).isoformat(), "host": "h", "e": 1}
                 for s in [0, 10, 20, 30, 100]])
    r = Rule("b", "t", "l", {"s": {"e": 1}, "condition": "s | count() by host > 3", "timeframe": "60s"})
    got = coarse_bursts(burst_rows(v, [r]), window="60 seconds", slide="30 seconds", threshold=3).collect()
    assert [(r.window_count, r._rw_key) for r in got] == [(4, "h")]


def test_stream_observe_and_empty_batches(spark, tmp_path):
    from ruleweave.streaming.pipeline import observed_decode, start_sink
    from ruleweave.streaming.sources import text_stream
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"x": 1}\nnot json\n{"x": 2}\n')
    raw = observed_decode(text_stream(spark, str(src)))
    q = (raw.writeStream.format("memory").queryName("obs").option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    metrics = q.lastProgress["observedMetrics"]["decode"]
    assert (int(metrics["processed"]), int(metrics["skipped"])) == (1 + 1, 1)
    # an alert stream with no alerts writes nothing (empty flush is a no-op)
    empty = text_stream(spark, str(src)).where(F.lit(False)).select(
        *[F.lit("x").alias(c) for c in ["alert_id", "rule_id", "rule_title", "severity", "matched_at", "host",
                                        "raw_log"]])
    q2 = start_sink(empty, order_col="alert_id", checkpoint=str(tmp_path / "c2"), store_path=str(tmp_path / "store"),
                    trigger={"availableNow": True})
    q2.awaitTermination()
    assert not (tmp_path / "store").exists()


def test_partition_by_host(spark):
    from ruleweave.sources.logs import partition_by_host
    df = spark.createDataFrame([(str(i % 5), i) for i in range(100)], "host string, v int")
    parts = partition_by_host(df, 4).rdd.glom().map(lambda rows: sorted({r.host for r in rows})).collect()
    seen = [h for p in parts for h in p]
    assert len(seen) == len(set(seen)) == 5
