"""Rule versions as data (L6) against the compiled versions, and the rule count sweep."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ruleweave.operators import asof
from ruleweave.operators.lifecycle import CHANGELOG_SCHEMA, asof_alerts, entries, rule_count_at
from ruleweave.sources.logs import table_view

SEC = 1_000_000


def view_of(spark, n, seed=0):
    rng = random.Random(seed)
    rows = [(i, None if rng.random() < 0.05 else rng.randrange(400) * SEC, rng.choice(["h1", "h2", None]),
             rng.choice(["x", "y", "xy"]), rng.randrange(5)) for i in range(n)]
    df = spark.createDataFrame(rows, "seq long, t_us long, host string, kind string, size int")
    df = df.select("seq", F.timestamp_micros("t_us").alias("_rw_ts"), "host", "kind", "size").repartition(3)
    return table_view(df, time_col="_rw_ts", order_cols=["seq"], keep=["seq"])


def detection(rng):
    sel = rng.choice([{"kind": "x"}, {"kind|contains": "y"}, {"size": [1, 2]}, {"kind|startswith": "x", "size": 3}, {}])
    if rng.random() < 0.3:
        return {"sel": sel, "condition": f"sel | count() by {rng.choice(['host', 'kind'])} > {rng.randrange(4)}",
                "timeframe": rng.choice(["20s", "60s"])}
    return {"sel": sel, "two": {"kind|endswith": "y"}, "condition": rng.choice(["sel", "not sel", "sel and two", "sel or not two"])}


def random_changelog(spark, seed, n=40):
    rng, at, rows = random.Random(seed), 0, []
    for seq in range(1, n + 1):
        at += rng.randrange(0, 20) * SEC
        rid, op = f"r{rng.randrange(6)}", rng.choice(["add", "update", "update", "delete"])
        rule = None if op == "delete" else json.dumps({"id": rid, "title": f"t{seq}", "level": "low", "detection": detection(rng)})
        rows.append((seq, None if seq < 4 else at, op, rid, rule))
    return spark.createDataFrame(rows, CHANGELOG_SCHEMA)


def found(alerts):
    return sorted(map(tuple, alerts.select("alert_id", "rule_id", "rule_title", "severity", "host", "raw_log", "seq")
                      .fillna("-").collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_changelogs_give_the_compiled_alerts(spark, seed):
    view, changes = view_of(spark, 300, seed), random_changelog(spark, seed)
    got, left_out = asof.asof_table_alerts(view, changes, ["seq"])
    assert found(got) == found(asof_alerts(view, changes)) and found(got)
    assert left_out.count() == 0


def test_rules_that_cannot_run_are_listed_and_many_clauses_compiled(spark):
    wide = {f"g{i}": {"kind": "x", "size": i} for i in range(20)}
    many = " and ".join(f"( g{i} or g{i + 1} )" for i in range(0, 20, 2))
    rules = [("a", {"s": {"kind": "x"}, "condition": "s"}), ("b", {"s": {"kind": "x"}, "condition": "s and"}),
             ("c", {"s": {"kind": "x"}, "condition": "s | count() by host > 1", "timeframe": "5 parsecs"}),
             ("d", {**wide, "condition": f"not ( {many} )"}), ("e", {**wide, "condition": f"{many} or g3"})]
    rows = [(i, i * SEC, "add", rid, json.dumps({"id": rid, "title": rid, "level": "low", "detection": d}))
            for i, (rid, d) in enumerate(rules)]
    changes = spark.createDataFrame(rows, CHANGELOG_SCHEMA)
    view = view_of(spark, 120)
    got, left_out = asof.asof_table_alerts(view, changes, ["seq"])
    assert found(got) == found(asof_alerts(view, changes))
    assert asof.versions(changes).where("compile").count() >= 1
    assert sorted((r.seq, r.rule_id) for r in left_out.collect()) == [(1, "b"), (2, "c")]


def test_empty_changelog_and_empty_logs(spark):
    empty = spark.createDataFrame([], CHANGELOG_SCHEMA)
    assert asof.asof_table_alerts(view_of(spark, 20), empty, ["seq"])[0].count() == 0
    view = view_of(spark, 1)
    view.df = view.df.where("false")
    assert asof.asof_table_alerts(view, random_changelog(spark, 1), ["seq"])[0].count() == 0


def test_ten_thousand_versions(spark):
    """One rule replaced 10,000 times with the same term: a log meets the versions around its time only."""
    n = 10_000
    changes = spark.range(n).select(
        F.col("id").alias("seq"), (F.col("id") * 40_000).alias("at_us"), F.lit("update").alias("op"), F.lit("r").alias("rule_id"),
        F.format_string('{"id":"r","title":"v%d","level":"low","detection":{"s":{"kind":"x"},"condition":"s"}}', "id")
        .alias("rule"))
    view = view_of(spark, 500)
    alerts, _ = asof.asof_table_alerts(view, changes, ["seq"])
    got = {r.seq: r.rule_title for r in alerts.collect()}
    at = {r.seq: int(r.t or 0) for r in view.df.where("kind = 'x'").select(
        "seq", F.unix_micros(F.col("_rw_ts")).alias("t")).collect()}
    assert got == {s: f"v{min(t // 40_000, n - 1)}" for s, t in at.items()}
    usable = asof.versions(changes)
    slots = asof.time_slots(usable)
    first, last = asof._touched(slots)
    copies = usable.agg(F.sum(last - first + 1), F.max(F.lit(1))).first()[0]
    assert slots[2] >= 1024 and copies <= asof.COPIES * n
    plan = alerts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_rw_slot") and "v9999" not in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rule_counts_equal_the_versions_valid_at_each_time(spark, seed):
    changes = random_changelog(spark, seed, 60)
    day = 86_400 * SEC
    rng = random.Random(seed)
    spread = changes.withColumn("at_us", F.col("at_us") * 1000 - 3 * day)      # over days, and below zero
    asked = [None, -10 ** 18, 10 ** 18] + [rng.randrange(-4 * day, 6 * day) for _ in range(40)]
    asked += [r.at_us for r in spread.where("at_us IS NOT NULL").limit(10).collect()]
    times = spark.createDataFrame([(t, "k") for t in asked + asked[:5]], "t long, label string")
    ents = entries(spread).collect()

    def valid(e, t):
        if t is None:
            return e.from_us is None and e.to_seq is None
        return (e.from_us is None or e.from_us <= t) and (e.to_seq is None or (e.to_us is not None and t < e.to_us))

    want = {t: sum(e.copies for e in ents if valid(e, t)) for t in asked}
    result = rule_count_at(spread, times, "t")
    assert {r.t: r.rule_count for r in result.collect()} == want and result.count() == len(want)
    assert "NestedLoop" not in result._jdf.queryExecution().executedPlan().toString()
