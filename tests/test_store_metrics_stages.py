"""K2/K5/Q1-Q7 store, M1-M4 metrics, R1/R2 stages, J2 ids."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from ruleweave.functions import ids
from ruleweave.operators import metrics as M
from ruleweave.operators import store as S
from ruleweave.operators.stages import WINDOWS_STAGES, stage_labels, stage_transitions


def alert(aid, rule="r", sev="high", host="h", raw="{}", at="t"):
    return (aid, rule, f"title {rule}", sev, at, host, raw)


def test_store_upsert_idempotent_last_write_wins(spark, tmp_path):
    store = str(tmp_path / "store")
    b0 = spark.createDataFrame([alert("a", raw='{"v": 1}'), alert("b"), alert("a", raw='{"v": 2}')], S.STORE_SCHEMA)
    S.write_batch(b0.withColumn("pos", F.monotonically_increasing_id()), store, 0, order=[F.col("pos")])
    b1 = spark.createDataFrame([alert("b", sev="low"), alert("c")], S.STORE_SCHEMA)
    S.write_batch(b1, store, 1, order=[F.col("alert_id")])
    S.write_batch(b1, store, 1, order=[F.col("alert_id")])     # replay of the same batch: no change
    cur = {r.alert_id: r for r in S.read_store(spark, store).collect()}
    assert sorted(cur) == ["a", "b", "c"]
    assert cur["b"].severity == "low"
    assert S.count_alerts(S.read_store(spark, store)).first().alert_count == 3
    S.compact(spark, store, str(tmp_path / "compacted"))
    again = {r.alert_id: r for r in S.read_store(spark, str(tmp_path / "compacted")).collect()}
    assert again == cur


def test_store_queries(spark):
    st = spark.createDataFrame([alert("a", "r1", "high", "h1", '{"event_id": 4625}'),
                                alert("b", "r1", "low", "h2"), alert("c", "r2", "high", "h2")], S.STORE_SCHEMA)
    assert {r.alert_id for r in S.alerts_by_terms(st, severity="high").collect()} == {"a", "c"}
    assert {r.alert_id for r in S.alerts_by_terms(st, severity="high", host="h2").collect()} == {"c"}
    assert {(r.rule_id, r.doc_count) for r in S.bucket_counts(st, ["rule_id"]).collect()} == {("r1", 2), ("r2", 1)}
    assert [r.rule_id for r in S.bucket_counts(st, ["rule_id"], top=1).collect()] == ["r1"]
    hosts = spark.createDataFrame([("h1",), ("h2",), ("h3",)], "host string")
    assert [r.host for r in S.quiet_hosts(hosts, st).collect()] == ["h3"]
    dup = spark.createDataFrame([("x",), ("x",), ("y",)], "alert_id string")
    assert [(r.alert_id, r.copies) for r in S.duplicate_ids(dup).collect()] == [("x", 2)]
    assert st.select(S.embedded_field(st, "event_id")).where("alert_id = 'a'").first()[0] == "4625"


def test_uuid5_matches_python(spark):
    names = ["", "a", "rule:{\"k\": 1}", "ünïcode ✓"] + [f"r{i}:h:{i * 7}" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.u for r in df.select(ids.uuid5(F.col("n")).alias("u")).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_OID, n)) for n in names]


def test_canonical_json_matches_python_layout(spark):
    row = {"b": "x\"y\\z\n", "a": 1, "c": 2.5, "d": True}
    df = spark.createDataFrame([(row["a"], row["b"], row["c"], row["d"])], "a long, b string, c double, d boolean")
    assert df.select(ids.canonical_json(df.schema).alias("j")).first().j == json.dumps(row, sort_keys=True)


def test_histogram_quantile(spark):
    vals = spark.createDataFrame([(1, float(v)) for v in range(1, 101)], "g int, v double")
    h = M.histogram(vals, "v", ["g"], bounds=(10.0, 50.0, 100.0))
    cum = {r.le: r.cumulative_count for r in h.collect()}
    assert cum == {10.0: 10, 50.0: 50, 100.0: 100, float("inf"): 100}
    q = {r.quantile: r.value for r in M.latency_summary(vals, "v", ["g"], (0.5, 0.99, 0.05), (10.0, 50.0, 100.0)).collect()}
    assert q[0.5] == pytest.approx(50.0)
    assert q[0.99] == pytest.approx(99.0)
    assert q[0.05] == pytest.approx(5.0)


def test_lag_and_decode_counts(spark):
    off = spark.createDataFrame([("w1", 0, 100, 90), ("w1", 1, 50, 60), ("w2", 2, 10, 0)],
                                "worker string, partition int, end_offset long, position long")
    got = {r.worker: r.lag for r in M.consumer_lag(off).collect()}
    assert got == {"w1": 10, "w2": 10, None: 20}
    raw = spark.createDataFrame([('{"a": 1}',), ("nope",), ("[1, 2]",), ("{bad",)], "value string")
    r = M.decode_counts(raw).first()
    assert (r.processed, r.skipped) == (1, 3)


def test_throughput_rollup(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=s), w) for s, w in [(1, "a"), (2, "a"), (3, "b"), (70, "a")]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, worker string")
    got = {(str(r.window_start), r.worker): r.events for r in M.throughput(df, "ts", "worker").collect()}
    assert got[("2024-01-01 00:00:00", "a")] == 2 and got[("2024-01-01 00:00:00", None)] == 3
    assert got[("2024-01-01 00:01:00", None)] == 1


def test_stages_and_transitions_across_chunks(logs_of):
    import datetime as dt
    base = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    seq = [(0, 4625), (10, 4625), (20, 4624), (86400 * 2, 4688), (86400 * 2 + 5, 1)]
    logs = [{"timestamp": (base + dt.timedelta(seconds=s)).isoformat(), "host": "h", "event_id": e,
             "process_name": "cmd.exe"} for s, e in seq]
    labels = stage_labels(logs_of(logs), WINDOWS_STAGES)
    assert [r.stage for r in labels.orderBy("seq").collect()] == ["brute_forcing", "brute_forcing", "compromised",
                                                                  "lateral_movement", "idle"]
    got = {(r.from_stage, r.to_stage): (r.transitions, r.share) for r in stage_transitions(labels).collect()}
    assert got == {("brute_forcing", "brute_forcing"): (1, 0.5), ("brute_forcing", "compromised"): (1, 0.5),
                   ("compromised", "lateral_movement"): (1, 1.0), ("lateral_movement", "idle"): (1, 1.0)}


def test_transitions_do_not_depend_on_chunking(logs_of):
    import datetime as dt
    import random
    rnd = random.Random(5)
    base = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    logs, t = [], 0
    for _ in range(200):
        t += rnd.choice([0, 1, 30, 4000])
        logs.append({"timestamp": (base + dt.timedelta(seconds=t)).isoformat(), "host": rnd.choice("ab"),
                     "event_id": rnd.choice([4625, 4624, 4688, 1]), "process_name": "cmd.exe"})
    labels = stage_labels(logs_of(logs), WINDOWS_STAGES)
    whole = sorted(tuple(r) for r in stage_transitions(labels, chunk_seconds=10 ** 7).collect())
    fine = sorted(tuple(r) for r in stage_transitions(labels, chunk_seconds=60).collect())
    assert whole == fine


def test_lag_from_progress():
    from ruleweave.streaming.pipeline import lag_from_progress
    progress = {"sources": [{"description": "KafkaV2[Subscribe[raw-logs]]",
                             "endOffset": json.dumps({"raw-logs": {"0": 90, "1": 60}}),
                             "latestOffset": json.dumps({"raw-logs": {"0": 100, "1": 50}})},
                            {"description": "FileStreamSource", "endOffset": {"logOffset": 3}}]}
    got = lag_from_progress(progress)
    assert got == {"total": 10, "partitions": {("raw-logs", 0): 10, ("raw-logs", 1): 0}}
