"""Registered queries over the test tables, and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame. Each oracle is SQL written
independently of the rule compiler (the WHERE clauses are hand-written from the rule
files), over the views ``events``, ``lineitem``, ... that the checker registers.
"""

from __future__ import annotations

import os
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ruleweave.operators.burst import burst_alerts
from ruleweave.operators.evaluate import evaluate, match_rules, alert_projection
from ruleweave.operators import store as S
from ruleweave.operators.metrics import DEFAULT_BOUNDS
from ruleweave.plans.rules import Rule, load_rules, split_rules
from ruleweave.sources.testdata import events_view, lineitem_view, events_logs, read_table
from ruleweave.functions.timeutil import iso_text_micros, ntz_micros

RULES_ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "rules")
PLAIN_COLUMNS = ["alert_id", "rule_id", "rule_title", "severity", "host", "event_id"]


@lru_cache(maxsize=None)
def rule_pack(name: str) -> tuple[Rule, ...]:
    return tuple(load_rules(os.path.join(RULES_ROOT, name)))


def events_rule(rule_id: str) -> Rule:
    return next(r for r in rule_pack("events") if r.id == rule_id)


# --- Spark side --------------------------------------------------------------------------

def _plain(rule_id: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = events_view(spark, sf_dir)
        return alert_projection(view, match_rules(view, [events_rule(rule_id)])).select(*PLAIN_COLUMNS)
    q.__name__ = f"plain_{rule_id}"
    return q


def rule_set_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every plain rule of the events pack in one pass."""
    plain, _ = split_rules(list(rule_pack("events")))
    view = events_view(spark, sf_dir)
    return alert_projection(view, match_rules(view, plain)).select(*PLAIN_COLUMNS)


def burst_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bursts = split_rules(list(rule_pack("events")))
    return burst_alerts(events_view(spark, sf_dir), bursts).select(*PLAIN_COLUMNS, "window_count")


def burst_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bursts = split_rules(list(rule_pack("lineitem")))
    return burst_alerts(lineitem_view(spark, sf_dir), bursts).select(
        "alert_id", "rule_id", "host", "l_orderkey", "l_linenumber", "window_count")


def lineitem_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + E4 on the larger table: plain and burst rules routed and unioned."""
    return evaluate(lineitem_view(spark, sf_dir), list(rule_pack("lineitem"))).select(
        "alert_id", "rule_id", "severity", "host", "l_orderkey", "l_linenumber")


def spread_events(spark: SparkSession, sf_dir: str):
    """The events view, dealt over the session's partitions after what filters reach the scan: few files hold many
    events, and the work on an event is many times that of reading it."""
    logs = events_logs(spark, sf_dir)
    return events_view(spark, sf_dir, df=logs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))


def published_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything the events pack publishes: plain and burst alerts."""
    view = events_view(spark, sf_dir)
    return evaluate(view, list(rule_pack("events")))


def stored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + A11: one stored document per alert id; the latest log wins."""
    pub = published_alerts(spark, sf_dir)
    return S.latest_per_id(pub.select("alert_id", "rule_id", "severity", "host", "event_id"),
                           [F.col("event_id")])


def _store(spark: SparkSession, sf_dir: str) -> str:
    """A store written from everything the events pack publishes; the path to read it from."""
    import uuid as _uuid
    from ruleweave.session import scratch_path
    path = scratch_path(spark, "stores", _uuid.uuid4().hex)
    S.write_batch(published_alerts(spark, sf_dir), path, 0, [F.col("event_id")])
    return path


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = S.read_store(spark, _store(spark, sf_dir))
    return stored.withColumn("event_id", F.get_json_object("raw_log", "$.event_id").cast("long"))


def alert_count(spark, sf_dir):
    return S.count_alerts(_read(spark, sf_dir))


def alerts_by_term(spark, sf_dir):
    return S.alerts_by_terms(_read(spark, sf_dir), severity="high").select("alert_id", "rule_id", "host")


def alerts_by_two_terms(spark, sf_dir):
    return S.alerts_by_terms(_read(spark, sf_dir), severity="low", host="8").select(
        "alert_id", "rule_id", "event_id")


def alerts_by_rule(spark, sf_dir):
    return S.alerts_by_terms(_read(spark, sf_dir), rule_id="ev-error-burst-001").select("alert_id", "host", "event_id")


def alerts_by_id(spark, sf_dir):
    """Q2 by id, one bucket of the store: the alert with the smallest id."""
    path = _store(spark, sf_dir)
    low = S.read_store(spark, path).agg(F.min("alert_id")).first()[0]
    return S.read_store(spark, path, alert_id=low or "").select("alert_id", "rule_id", "severity", "host")


def alert_buckets(spark, sf_dir):
    return S.bucket_counts(_read(spark, sf_dir), ["rule_id", "severity"])


def top_hosts(spark, sf_dir):
    return S.bucket_counts(_read(spark, sf_dir), ["host"], top=10)


def duplicate_ids(spark, sf_dir):
    return S.duplicate_ids(published_alerts(spark, sf_dir).select("alert_id"))


def quiet_hosts(spark, sf_dir):
    high = S.alerts_by_terms(_read(spark, sf_dir), severity="high")
    return S.quiet_hosts(events_logs(spark, sf_dir), high)


def embedded_fields(spark, sf_dir):
    """Q7: fields of the embedded raw log of the published burst alerts."""
    _, bursts = split_rules(list(rule_pack("events")))
    pub = burst_alerts(events_view(spark, sf_dir), bursts)
    return pub.select("alert_id", S.embedded_field(pub, "props", "props"),
                      S.embedded_field(pub, "log_type", "log_type"), "event_id")


QUERIES = {
    "field_equality": _plain("ev-purchase-001"),
    "contains": _plain("ev-props-contains-001"),
    "startswith": _plain("ev-props-prefix-001"),
    "endswith": _plain("ev-props-suffix-001"),
    "value_list": _plain("ev-click-or-view-001"),
    "unknown_modifier": _plain("ev-unknown-modifier-001"),
    "field_presence": _plain("ev-error-no-user-001"),
    "text_coercion": _plain("ev-host-eight-001"),
    "bool_and": _plain("ev-error-value-one-001"),
    "bool_or": _plain("ev-signup-or-k-zero-001"),
    "bool_not": _plain("ev-view-without-5-001"),
    "bool_nested": _plain("ev-click-or-purchase-not-2-001"),
    "rule_set_alerts": rule_set_alerts,
    "burst_alerts": burst_events,
    "burst_ties": burst_ties,
    "lineitem_alerts": lineitem_alerts,
    "stored_alerts": stored_alerts,
    "alert_count": alert_count,
    "alerts_by_term": alerts_by_term,
    "alerts_by_two_terms": alerts_by_two_terms,
    "alert_buckets": alert_buckets,
    "top_hosts": top_hosts,
    "duplicate_ids": duplicate_ids,
    "quiet_hosts": quiet_hosts,
    "embedded_fields": embedded_fields,
}


# --- DuckDB oracles ----------------------------------------------------------------------

NS = "6ba7b8129dad11d180b400c04fd430c8"


def sql_uuid5(name: str) -> str:
    h = f"sha1(unhex('{NS}') || encode({name}))"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
            f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) "
            f"|| '-' || substr({h}, 21, 12))")


EVENTS_LOGS = """logs AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS host, event_type AS log_type, props,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS "timestamp", value, epoch_us(ts) AS t_us
  FROM events)"""

CANON = ("'{\"event_id\": ' || CAST(event_id AS VARCHAR) || ', \"host\": ' || to_json(host) || "
         "', \"log_type\": ' || to_json(log_type) || ', \"props\": ' || to_json(props) || "
         "', \"timestamp\": ' || to_json(\"timestamp\") || ', \"value\": ' || CAST(value AS VARCHAR) || '}'")

# rule id -> (title, level, WHERE clause over the events log view)
PLAIN_SQL = {
    "ev-purchase-001": ("Purchase event", "low", "log_type = 'purchase'"),
    "ev-props-contains-001": ("Property k in the forties", "medium", "contains(props, '\"k\": 4')"),
    "ev-props-prefix-001": ("Property k starts with 1", "low", "starts_with(props, '{\"k\": 1')"),
    "ev-props-suffix-001": ("Property k ends with 7", "low", "ends_with(props, '7}')"),
    "ev-click-or-view-001": ("Click or view", "low", "log_type IN ('click', 'view')"),
    "ev-unknown-modifier-001": ("Regex modifier is not supported and never matches", "medium",
                                "(false OR log_type = 'signup')"),
    "ev-error-no-user-001": ("Error without a user name field", "medium", "(log_type = 'error' AND NOT false)"),
    "ev-host-eight-001": ("Host 8 given as an integer in the rule", "high",
                          "(host = '8' AND ends_with(CAST(event_id AS VARCHAR), '1'))"),
    "ev-error-value-one-001": ("Error with a value starting with 1", "high",
                               "(log_type = 'error' AND starts_with(CAST(value AS VARCHAR), '1'))"),
    "ev-signup-or-k-zero-001": ("Signup, or k ending with 0", "low", "(log_type = 'signup' OR ends_with(props, '0}'))"),
    "ev-view-without-5-001": ("View whose properties have no 5", "low", "(log_type = 'view' AND NOT contains(props, '5'))"),
    "ev-click-or-purchase-not-2-001": ("Click or purchase whose value does not start with 2", "medium",
                                       "((log_type = 'click' OR log_type = 'purchase') "
                                       "AND NOT starts_with(CAST(value AS VARCHAR), '2'))"),
}


def _plain_select(rule_id: str) -> str:
    title, level, where = PLAIN_SQL[rule_id]
    return (f"SELECT {sql_uuid5(repr(rule_id + ':') + ' || ' + CANON)} AS alert_id, '{rule_id}' AS rule_id, "
            f"'{title}' AS rule_title, '{level}' AS severity, host, event_id FROM logs WHERE {where}")


def _plain_sql(rule_id: str) -> str:
    return f"WITH {EVENTS_LOGS} {_plain_select(rule_id)}"


def _burst_select(extra: str = "") -> str:
    return f"""counted AS (
  SELECT *, count(*) OVER (PARTITION BY host ORDER BY t_us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW)
            - (count(*) OVER (PARTITION BY host, t_us)
               - row_number() OVER (PARTITION BY host, t_us ORDER BY event_id)) AS window_count
  FROM logs WHERE log_type = 'error'),
burst AS (
  SELECT {sql_uuid5("'ev-error-burst-001:' || host || ':' || CAST(t_us // 86400000000 AS VARCHAR)")} AS alert_id,
         'ev-error-burst-001' AS rule_id, 'Error burst per user' AS rule_title, 'high' AS severity,
         host, event_id, window_count {extra}
  FROM counted WHERE window_count > 2)"""


def _published() -> str:
    plain = " UNION ALL ".join(_plain_select(r) for r in PLAIN_SQL)
    return (f"WITH {EVENTS_LOGS}, {_burst_select()}, published AS ("
            f"SELECT alert_id, rule_id, severity, host, event_id FROM burst UNION ALL "
            f"SELECT alert_id, rule_id, severity, host, event_id FROM ({plain}) p), "
            f"stored AS (SELECT alert_id, arg_max(rule_id, event_id) AS rule_id, arg_max(severity, event_id) AS severity, "
            f"arg_max(host, event_id) AS host, max(event_id) AS event_id FROM published GROUP BY alert_id) ")


LINEITEM_LOGS = """li AS (
  SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS host, l_returnflag, l_linestatus,
         l_quantity, l_discount, epoch_us(l_shipdate) AS t_us
  FROM lineitem)"""

LI_BURST = f"""li_counted AS (
  SELECT *, count(*) OVER (PARTITION BY host ORDER BY t_us RANGE BETWEEN {720 * 3600 * 1000000 - 1} PRECEDING AND CURRENT ROW)
            - (count(*) OVER (PARTITION BY host, t_us)
               - row_number() OVER (PARTITION BY host, t_us ORDER BY l_orderkey, l_linenumber)) AS window_count
  FROM li WHERE l_returnflag = 'R'),
li_burst AS (
  SELECT {sql_uuid5("'li-returns-burst-001:' || host || ':' || CAST(t_us // 2592000000000 AS VARCHAR)")} AS alert_id,
         'li-returns-burst-001' AS rule_id, 'medium' AS severity, host, l_orderkey, l_linenumber, window_count
  FROM li_counted WHERE window_count > 3)"""

LI_CANON = ("'{\"host\": ' || to_json(host) || ', \"l_discount\": ' || CAST(l_discount AS VARCHAR) || "
            "', \"l_linenumber\": ' || CAST(l_linenumber AS VARCHAR) || ', \"l_linestatus\": ' || to_json(l_linestatus) || "
            "', \"l_orderkey\": ' || CAST(l_orderkey AS VARCHAR) || ', \"l_quantity\": ' || CAST(l_quantity AS VARCHAR) || "
            "', \"l_returnflag\": ' || to_json(l_returnflag) || ', \"timestamp\": ' || "
            "to_json(strftime(epoch_us_to_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')) || '}'")


def _oracles() -> dict[str, str]:
    o = {}
    for key, q in QUERIES.items():
        rid = getattr(q, "__name__", "")
        if rid.startswith("plain_"):
            o[key] = _plain_sql(rid[len("plain_"):])
    plain_all = " UNION ALL ".join(_plain_select(r) for r in PLAIN_SQL)
    o["rule_set_alerts"] = f"WITH {EVENTS_LOGS} {plain_all}"
    o["burst_alerts"] = (f"WITH {EVENTS_LOGS}, {_burst_select()} "
                         "SELECT alert_id, rule_id, rule_title, severity, host, event_id, window_count FROM burst")
    o["burst_ties"] = (f"WITH {LINEITEM_LOGS}, {LI_BURST} "
                       "SELECT alert_id, rule_id, host, l_orderkey, l_linenumber, window_count FROM li_burst")
    li_canon = LI_CANON.replace("epoch_us_to_ts", "make_timestamp(t_us)")
    li_plain = (f"SELECT {sql_uuid5(repr('li-discounted-bulk-001:') + ' || ' + li_canon)} AS alert_id, "
                "'li-discounted-bulk-001' AS rule_id, 'low' AS severity, host, l_orderkey, l_linenumber FROM li "
                "WHERE l_linestatus = 'O' AND (starts_with(CAST(l_quantity AS VARCHAR), '4') "
                "OR starts_with(CAST(l_quantity AS VARCHAR), '5')) AND CAST(l_discount AS VARCHAR) IN ('0.09', '0.1')")
    o["lineitem_alerts"] = (f"WITH {LINEITEM_LOGS}, {LI_BURST} SELECT alert_id, rule_id, severity, host, l_orderkey, "
                            f"l_linenumber FROM li_burst UNION ALL {li_plain}")
    pub = _published()
    o["stored_alerts"] = pub + "SELECT alert_id, rule_id, severity, host, event_id FROM stored"
    o["alert_count"] = pub + "SELECT count(*) AS alert_count FROM stored"
    o["alerts_by_term"] = pub + "SELECT alert_id, rule_id, host FROM stored WHERE severity = 'high'"
    o["alerts_by_two_terms"] = pub + "SELECT alert_id, rule_id, event_id FROM stored WHERE severity = 'low' AND host = '8'"
    o["alert_buckets"] = pub + "SELECT rule_id, severity, count(*) AS doc_count FROM stored GROUP BY rule_id, severity"
    o["top_hosts"] = pub + ("SELECT host, count(*) AS doc_count FROM stored GROUP BY host "
                            "ORDER BY doc_count DESC, host LIMIT 10")
    o["duplicate_ids"] = pub + "SELECT alert_id, count(*) AS copies FROM published GROUP BY alert_id HAVING count(*) > 1"
    o["quiet_hosts"] = pub + ("SELECT DISTINCT host FROM logs WHERE host NOT IN "
                              "(SELECT host FROM stored WHERE severity = 'high')")
    o["embedded_fields"] = (f"WITH {EVENTS_LOGS}, {_burst_select(', props, log_type')} "
                            "SELECT alert_id, props, log_type, event_id FROM burst")
    return o


ORACLES = _oracles()


# --- lifecycle (L1-L8) over the events stream ----------------------------------------------

def _day_us(day: int) -> int:
    import datetime as _dt
    return int(_dt.datetime(2024, 1, day, tzinfo=_dt.timezone.utc).timestamp()) * 1_000_000


_SIGNUP = {"id": "ev-signup-001", "title": "Signup", "level": "low",
           "detection": {"sel": {"log_type": "signup"}, "condition": "sel"}}
_PURCHASE_V2 = {"id": "ev-purchase-001", "title": "Large purchase", "level": "high",
                "detection": {"sel": {"log_type": "purchase", "value|startswith": ["1", "2"]}, "condition": "sel"}}
_BURST_V2 = {"id": "ev-error-burst-001", "title": "Error burst per user (strict)", "level": "critical",
             "detection": {"errors": {"log_type": "error"}, "condition": "errors | count() by host > 1",
                           "timeframe": "24h"}}
_BURST_V1 = {"id": "ev-error-burst-001", "title": "Error burst per user", "level": "high",
             "detection": {"errors": {"log_type": "error"}, "condition": "errors | count() by host > 2",
                           "timeframe": "24h"}}
_CLICK = {"id": "ev-click-001", "title": "Click", "level": "low",
          "detection": {"sel": {"log_type": "click"}, "condition": "sel"}}

# (day of January 2024, envelope) in sequence order
CHANGELOG = [
    (5, {"op": "add", "rule": _SIGNUP}),
    (10, {"op": "update", "rule_id": "ev-purchase-001", "rule": _PURCHASE_V2}),
    (12, {"op": "update", "rule_id": "ev-error-burst-001", "rule": _BURST_V2}),
    (15, {"op": "delete", "rule_id": "ev-signup-001"}),
    (18, {"op": "delete", "rule_id": "ev-error-burst-001"}),
    (19, {"op": "add", "rule": _BURST_V1}),
    (20, {"op": "add", "rule": _SIGNUP}),
    (22, {"op": "add", "rule_id": "ignored-for-add", "rule": _SIGNUP}),
    (25, {"op": "update", "rule_id": "ev-purchase-001", "rule": dict(_CLICK)}),
    (26, {"rule_id": "ev-purchase-001"}),
    (27, {"op": "update", "rule_id": "ev-click-001", "rule": _CLICK}),
    (28, {"op": "delete", "rule_id": "no-such-rule"}),
    (29, {"op": "rename", "rule_id": "ev-click-001"}),
]


def events_changelog(spark: SparkSession) -> DataFrame:
    import json as _json
    from ruleweave.operators.lifecycle import decode_envelopes, directory_changelog

    directory = [events_rule("ev-purchase-001"), events_rule("ev-error-burst-001")]
    raw = spark.createDataFrame([(i + 1, _day_us(d), _json.dumps(e)) for i, (d, e) in enumerate(CHANGELOG)],
                                "seq long, at_us long, value string")
    return directory_changelog(spark, directory).unionByName(
        decode_envelopes(raw, at_col="at_us").drop("_rw_pre_error"))


def asof_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ruleweave.operators.lifecycle import asof_alerts as _asof
    view = events_view(spark, sf_dir)
    return _asof(view, events_changelog(spark)).select(*PLAIN_COLUMNS)


QUERIES["asof_alerts"] = asof_alerts


def _asof_oracle() -> str:
    d = _day_us
    canon_id = lambda rid: sql_uuid5(repr(rid + ":") + " || " + CANON)
    plain = [
        ("ev-purchase-001", "Purchase event", "low", f"log_type = 'purchase' AND t_us < {d(10)}"),
        ("ev-purchase-001", "Large purchase", "high",
         f"log_type = 'purchase' AND (starts_with(CAST(value AS VARCHAR), '1') OR starts_with(CAST(value AS VARCHAR), '2')) "
         f"AND t_us >= {d(10)}"),
        ("ev-signup-001", "Signup", "low", f"log_type = 'signup' AND t_us >= {d(5)} AND t_us < {d(15)}"),
        ("ev-signup-001", "Signup", "low", f"log_type = 'signup' AND t_us >= {d(20)}"),
        ("ev-signup-001", "Signup", "low", f"log_type = 'signup' AND t_us >= {d(22)}"),
        ("ev-click-001", "Click", "low", f"log_type = 'click' AND t_us >= {d(27)}"),
    ]
    sel = " UNION ALL ".join(
        f"SELECT {canon_id(rid)} AS alert_id, '{rid}' AS rule_id, '{title}' AS rule_title, '{lvl}' AS severity, "
        f"host, event_id FROM logs WHERE {w}" for rid, title, lvl, w in plain)
    bid = sql_uuid5("'ev-error-burst-001:' || host || ':' || CAST(t_us // 86400000000 AS VARCHAR)")
    burst = f"""e AS (
  SELECT *, CASE WHEN t_us < {d(18)} THEN 0 ELSE 1 END AS epoch FROM logs
  WHERE log_type = 'error' AND (t_us < {d(18)} OR t_us >= {d(19)})),
ec AS (
  SELECT *, count(*) OVER (PARTITION BY epoch, host ORDER BY t_us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW)
          - (count(*) OVER (PARTITION BY epoch, host, t_us)
             - row_number() OVER (PARTITION BY epoch, host, t_us ORDER BY event_id)) AS n,
         CASE WHEN t_us >= {d(12)} AND t_us < {d(18)} THEN 1 ELSE 2 END AS threshold,
         CASE WHEN t_us >= {d(12)} AND t_us < {d(18)} THEN 'Error burst per user (strict)' ELSE 'Error burst per user' END AS rule_title,
         CASE WHEN t_us >= {d(12)} AND t_us < {d(18)} THEN 'critical' ELSE 'high' END AS severity
  FROM e)"""
    return (f"WITH {EVENTS_LOGS}, {burst} {sel} UNION ALL SELECT {bid} AS alert_id, 'ev-error-burst-001' AS rule_id, "
            f"rule_title, severity, host, event_id FROM ec WHERE n > threshold")


ORACLES["asof_alerts"] = _asof_oracle()


# --- stream health (M1-M4) and stages (R1, R2) ----------------------------------------------

def _events_timed(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", "value", "props",
                     ntz_micros(F.col("ts")).alias("t_us"),
                     (F.col("user_id") % 8).alias("partition"), ((F.col("user_id") % 8) % 4).alias("worker"))


def throughput(spark, sf_dir):
    from ruleweave.operators.metrics import throughput as _tp
    ev = _events_timed(spark, sf_dir).withColumn("window_start", (F.col("t_us") - F.pmod("t_us", F.lit(60_000_000))) / 1_000_000)
    return _tp(ev.withColumn("window_start", F.col("window_start").cast("long")), "window_start", "worker", unit=None)


def latency_quantile(spark, sf_dir):
    from ruleweave.operators.metrics import latency_summary
    ev = _events_timed(spark, sf_dir).withColumn("day", ((F.col("t_us") - F.pmod("t_us", F.lit(86_400_000_000)))
                                                         / 86_400_000_000).cast("long"))
    return latency_summary(ev, "value", ["day"])


def consumer_lag(spark, sf_dir):
    from ruleweave.operators.metrics import consumer_lag as _lag
    ev = _events_timed(spark, sf_dir)
    cut = _day_us(20)
    offsets = ev.groupBy("worker", "partition").agg(F.count(F.lit(1)).alias("end_offset"),
                                                    F.count_if(F.col("t_us") < F.lit(cut)).alias("position"))
    return _lag(offsets)


def processed_skipped(spark, sf_dir):
    from ruleweave.operators.metrics import decode_counts
    raw = read_table(spark, sf_dir, "events").select(F.col("props").alias("value")).unionByName(
        read_table(spark, sf_dir, "documents").select(F.col("text").alias("value")))
    return decode_counts(raw)


# Stages for the events stream (first match wins, else idle).
EVENTS_STAGES = [
    ("brute_forcing", {"log_type": "error"}),
    ("compromised", {"log_type": "signup"}),
    ("lateral_movement", {"log_type": "purchase", "value|startswith": ["1", "2", "3"]}),
]


def stage_labels(spark, sf_dir):
    from ruleweave.operators.stages import stage_labels as _labels
    return _labels(events_view(spark, sf_dir), EVENTS_STAGES).select("event_id", "host", "stage")


def stage_transitions(spark, sf_dir):
    from ruleweave.operators.stages import stage_labels as _labels, stage_transitions as _tr
    return _tr(_labels(events_view(spark, sf_dir), EVENTS_STAGES))


QUERIES.update({
    "throughput": throughput,
    "latency_quantile": latency_quantile,
    "consumer_lag": consumer_lag,
    "processed_skipped": processed_skipped,
    "stage_labels": stage_labels,
    "stage_transitions": stage_transitions,
})

_TIMED = """timed AS (SELECT event_id, user_id, value, epoch_us(ts) AS t_us, user_id % 8 AS "partition",
                            (user_id % 8) % 4 AS worker FROM events)"""
_BOUNDS = [5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0]


def _latency_oracle() -> str:
    cums = ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS b{i}" for i, b in enumerate(_BOUNDS))
    unp = " UNION ALL ".join(f"SELECT day, CAST({b} AS DOUBLE) AS le, b{i} AS cum FROM c" for i, b in enumerate(_BOUNDS))
    unp += " UNION ALL SELECT day, CAST('inf' AS DOUBLE) AS le, total AS cum FROM c"
    parts = []
    for q in (0.5, 0.99):
        parts.append(f"""SELECT day, CAST({q} AS DOUBLE) AS quantile,
  CASE WHEN arg_min(le, le) = 'inf'::DOUBLE THEN arg_min(prev_le, le)
       WHEN arg_min(cum - prev_cum, le) = 0 THEN arg_min(le, le)
       ELSE arg_min(prev_le + (le - prev_le) * ({q} * total - prev_cum) / (cum - prev_cum), le) END AS value
FROM b WHERE cum >= {q} * total AND total > 0 GROUP BY day""")
    return f"""WITH {_TIMED},
c AS (SELECT t_us // 86400000000 AS day, {cums}, count(value) AS total FROM timed GROUP BY 1),
u AS ({unp}),
b AS (SELECT day, le, cum, coalesce(lag(le) OVER (PARTITION BY day ORDER BY le), 0.0) AS prev_le,
             coalesce(lag(cum) OVER (PARTITION BY day ORDER BY le), 0) AS prev_cum,
             max(cum) OVER (PARTITION BY day) AS total FROM u)
{" UNION ALL ".join(parts)}"""


ORACLES.update({
    "throughput": f"""WITH {_TIMED} SELECT t_us // 60000000 * 60 AS window_start, worker, count(*) AS events,
        count(*) / 60.0 AS events_per_second FROM timed GROUP BY ROLLUP (window_start, worker)
        HAVING window_start IS NOT NULL""",
    "latency_quantile": _latency_oracle(),
    "consumer_lag": f"""WITH {_TIMED}, o AS (SELECT worker, "partition", count(*) AS end_offset,
        count(*) FILTER (WHERE t_us < {_day_us(20)}) AS position FROM timed GROUP BY worker, "partition")
        SELECT worker, CAST(sum(greatest(0, end_offset - position)) AS BIGINT) AS lag, count(*) AS partitions
        FROM o GROUP BY ROLLUP (worker)""",
    "processed_skipped": """WITH raw AS (SELECT props AS v FROM events UNION ALL SELECT text AS v FROM documents)
        SELECT count(*) FILTER (WHERE json_valid(v) AND starts_with(trim(v), '{') AND ends_with(trim(v), '}')) AS processed,
               count(*) FILTER (WHERE NOT (json_valid(v) AND starts_with(trim(v), '{') AND ends_with(trim(v), '}')))
               AS skipped FROM raw""",
    "stage_labels": f"""WITH {EVENTS_LOGS} SELECT event_id, host, CASE WHEN log_type = 'error' THEN 'brute_forcing'
        WHEN log_type = 'signup' THEN 'compromised'
        WHEN log_type = 'purchase' AND (starts_with(CAST(value AS VARCHAR), '1') OR starts_with(CAST(value AS VARCHAR), '2')
             OR starts_with(CAST(value AS VARCHAR), '3')) THEN 'lateral_movement' ELSE 'idle' END AS stage FROM logs""",
})
ORACLES["stage_transitions"] = ("WITH " + EVENTS_LOGS + ", s AS (SELECT host, t_us, event_id, CASE WHEN log_type = 'error' "
    "THEN 'brute_forcing' WHEN log_type = 'signup' THEN 'compromised' WHEN log_type = 'purchase' AND "
    "(starts_with(CAST(value AS VARCHAR), '1') OR starts_with(CAST(value AS VARCHAR), '2') OR "
    "starts_with(CAST(value AS VARCHAR), '3')) THEN 'lateral_movement' ELSE 'idle' END AS stage FROM logs), "
    "t AS (SELECT lag(stage) OVER (PARTITION BY host ORDER BY t_us, event_id) AS from_stage, stage AS to_stage FROM s), "
    "c AS (SELECT from_stage, to_stage, count(*) AS transitions FROM t WHERE from_stage IS NOT NULL GROUP BY 1, 2) "
    "SELECT from_stage, to_stage, transitions, transitions / sum(transitions) OVER (PARTITION BY from_stage) AS share FROM c")


# --- streaming twins (S1, A9, K1-K6): run by availableNow, read back as a table ------------

def _cores(spark: SparkSession) -> int | None:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return None


def _run_stream(spark: SparkSession, df: DataFrame, tag: str, with_path: bool = False):
    """Run a stream to the end of its input into Parquet; read it back with its own schema
    (so an empty result is an empty frame, not a schema error)."""
    import uuid as _uuid
    from ruleweave.session import scratch_path
    base = scratch_path(spark, "stream-queries", f"{tag}-{_uuid.uuid4().hex}")
    q = (df.writeStream.format("parquet").option("path", base + "/out")
         .option("checkpointLocation", base + "/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.schema(df.schema).parquet(base + "/out")
    return (out, base + "/out") if with_path else out


SLICES = 3


def _drain_slices(spark: SparkSession, sf_dir: str, base: str, start) -> None:
    """Run a stream over the events table, one micro-batch per slice of time, hosts out of phase.

    The events are written slice by slice of time to the shared folder; every other host runs
    a slice behind, so that a micro-batch mixes clocks that are far apart. Events without a time
    count at time 0 (A8) and are in the first slice. ``start`` takes the stream of the folder and
    starts its query, from the same checkpoint for each slice, so a micro-batch is a whole slice
    however many files were written for it.
    """
    from ruleweave.functions.timeutil import epoch_micros
    ev = read_table(spark, sf_dir, "events")
    # read and spread once for all slices, each of which is written as one file per core
    ev = ev.repartition(_cores(spark) or int(spark.conf.get("spark.sql.shuffle.partitions"))).persist()
    try:
        t = epoch_micros("ts", ev.schema["ts"].dataType)
        low, high = ev.agg(F.min(t), F.max(t)).first()
        if low is None:     # no event has a time
            low = high = 0
        width = (high - low) // SLICES + 1
        behind = F.coalesce(F.pmod(F.col("user_id"), F.lit(2)), F.lit(0))
        number = F.coalesce(F.floor((t - F.lit(low)) / F.lit(width)) + behind, F.lit(0))
        sliced = ev.withColumn("_rw_slice", number)
        for i in range(SLICES + 1):
            sliced.where(F.col("_rw_slice") == i).drop("_rw_slice").write.parquet(f"{base}/slices/slice-{i}")
            start(spark.readStream.schema(ev.schema).option("recursiveFileLookup", True)
                  .parquet(f"{base}/slices")).awaitTermination()
    finally:
        ev.unpersist()


def _detected(spark: SparkSession, sf_dir: str, tag: str, rules, store: bool = False, **options) -> str:
    """Run the detection job over the events, slice by slice, to the end of its input; the folder it wrote to."""
    import uuid as _uuid
    from ruleweave.session import scratch_path
    from ruleweave.sources.testdata import events_logs_from
    from ruleweave.streaming.pipeline import start_detection
    base = scratch_path(spark, "stream-queries", f"{tag}-{_uuid.uuid4().hex}")
    # an empty batch, so that the published alerts can be read when there are none
    spark.range(0).select(*[F.lit(None).cast(kind).alias(c) for c, kind in (
        x.split(" ") for x in PUBLISHED_SCHEMA.split(", "))]).write.parquet(base + "/out/batch_id=-1")
    _drain_slices(spark, sf_dir, base, lambda stream: start_detection(
        stream, lambda df: events_view(spark, sf_dir, df=events_logs_from(df)), rules,
        checkpoint=base + "/checkpoint", state_path=base + "/state", publish_path=base + "/out",
        store_path=base + "/store" if store else None, trigger={"availableNow": True}, **options))
    return base


PUBLISHED_SCHEMA = "key string, value string, event_id long, window_count long"


def _published_rows(spark: SparkSession, base: str) -> DataFrame:
    value = F.col("value")
    return spark.read.schema(PUBLISHED_SCHEMA).parquet(base + "/out").select(
        F.col("key").alias("alert_id"), *[F.get_json_object(value, f"$.{c}").alias(c) for c in PLAIN_COLUMNS[1:-1]],
        "event_id", "window_count", "value")


def stream_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events burst rule over several micro-batches with hosts out of phase; same answer as the batch."""
    from ruleweave.streaming.pipeline import fixed_rules
    _, bursts = split_rules(list(rule_pack("events")))
    base = _detected(spark, sf_dir, "bursts", fixed_rules(bursts))
    return _published_rows(spark, base).select(*PLAIN_COLUMNS, "window_count")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + K2 + K6 end to end: detect, publish, store per micro-batch; replay the last batch; read the store."""
    from ruleweave.streaming.pipeline import fixed_rules
    base = _detected(spark, sf_dir, "upsert", fixed_rules(list(rule_pack("events"))), store=True)
    last = spark.read.parquet(base + "/out").agg(F.max("batch_id")).first()[0]
    if last is not None:    # else there are no alerts
        again = spark.read.parquet(f"{base}/store/batch_id={last}").drop("_rw_pos")
        again = again.withColumn("event_id", F.get_json_object("raw_log", "$.event_id").cast("long"))
        S.write_batch(_copied(again, base), base + "/store", last, [F.col("event_id")])
    return S.read_store(spark, base + "/store").select("alert_id", "rule_id", "severity", "host",
                         F.get_json_object("raw_log", "$.event_id").cast("long").alias("event_id"))


def _copied(df: DataFrame, base: str) -> DataFrame:
    """A copy in the shared folder, to overwrite what the frame was read from."""
    df.write.parquet(base + "/copy")
    return df.sparkSession.read.schema(df.schema).parquet(base + "/copy")


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3/E4 on a stream: the plain rules of the events pack, stateless."""
    from ruleweave.streaming.pipeline import detection_stream
    from ruleweave.streaming.sources import table_stream
    from ruleweave.sources.testdata import events_logs_from
    plain, _ = split_rules(list(rule_pack("events")))
    stream = events_logs_from(table_stream(spark, sf_dir, "events", min_partitions=_cores(spark)))
    out = detection_stream(events_view(spark, sf_dir, df=stream), plain)
    return _run_stream(spark, out.drop("matched_at"), "plain").select(*PLAIN_COLUMNS)


QUERIES["stream_bursts"] = stream_bursts
QUERIES["stream_upsert"] = stream_upsert
ORACLES["stream_upsert"] = ORACLES["stored_alerts"]
QUERIES["stream_alerts"] = stream_alerts
ORACLES["stream_bursts"] = ORACLES["burst_alerts"]
ORACLES["stream_alerts"] = ORACLES["rule_set_alerts"]


def rule_table_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain rules of the events pack joined as data (compiled path for the rest)."""
    from ruleweave.operators.ruletable import table_alerts
    plain, _ = split_rules(list(rule_pack("events")))
    return table_alerts(spark, events_view(spark, sf_dir), plain, key_cols=["event_id"]).select(*PLAIN_COLUMNS)


QUERIES["rule_table_alerts"] = rule_table_alerts
ORACLES["rule_table_alerts"] = ORACLES["rule_set_alerts"]


def quoted_item_rules(items: DataFrame) -> DataFrame:
    """A rules table made from the benchmark items: a document that quotes an item's beginning, in a
    language other than English, or any text that ends like the item."""
    opening, ending = F.substring("text", 1, 40), F.substring("text", -12, 12)
    detection = F.to_json(F.struct(F.struct(opening.alias("text|contains")).alias("quoted"),
                                   F.struct(F.lit("en").alias("lang")).alias("english"),
                                   F.struct(ending.alias("text|endswith")).alias("ending"),
                                   F.lit("quoted and not english or ending").alias("condition")))
    return items.where(F.length("text") > 0).select(
        F.col("item_id").cast("int").alias("rule_ord"), F.concat(F.lit("item-"), F.col("item_id")).alias("id"),
        F.lit("Quoted item").alias("title"), F.lit("high").alias("level"), detection.alias("detection"))


def quoted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 with rules that Spark derives from a table, negation included."""
    from ruleweave.operators.ruletable import rules_as_data
    from ruleweave.sources.logs import table_view
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", F.lit(None).cast("timestamp").alias("_rw_ts"))
    view = table_view(docs, time_col="_rw_ts", order_cols=["doc_id"], keep=["doc_id"])
    matches, _ = rules_as_data(view, quoted_item_rules(read_table(spark, sf_dir, "benchmark")), ["doc_id"])
    return matches.select("doc_id", "rule_id", "severity")


QUERIES["quoted_items"] = quoted_items
ORACLES["quoted_items"] = """SELECT doc_id, 'item-' || item_id AS rule_id, 'high' AS severity
    FROM documents d, benchmark b WHERE length(b.text) > 0 AND d.text IS NOT NULL
      AND ((contains(d.text, substring(b.text, 1, 40)) AND NOT coalesce(d.lang = 'en', false))
           OR ends_with(d.text, substring(b.text, -12, 12)))"""


# --- JSON-text logs (S2), coarse bursts (A10), stream dedup (K3), empty rule set (E5) ----------

def events_json_view(spark: SparkSession, sf_dir: str):
    """The events as raw JSON text, decoded back with the quarantine split."""
    from ruleweave.sources.logs import decode_json_logs, json_view
    logs = events_logs(spark, sf_dir).drop("_rw_ts")
    raw = logs.select(F.to_json(F.struct(*logs.columns)).alias("value"))
    good, _ = decode_json_logs(raw)
    good = good.withColumn("event_id", F.col("_rw_fields")["event_id"].cast("long"))
    return json_view(good, order_cols=["event_id"], keep=["event_id"])


def json_log_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + E1: the plain rules over decoded JSON text (map fields, open schema)."""
    plain, _ = split_rules(list(rule_pack("events")))
    view = events_json_view(spark, sf_dir)
    return alert_projection(view, match_rules(view, plain)).select("rule_id", "rule_title", "severity", "host",
                                                                    "event_id")


def coarse_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: error logs per host in sliding 24-hour windows every 6 hours, above 2."""
    from ruleweave.streaming.bursts import coarse_bursts as _coarse
    from ruleweave.streaming.pipeline import burst_rows
    _, bursts = split_rules(list(rule_pack("events")))
    rows = burst_rows(events_view(spark, sf_dir), bursts)
    out = _coarse(rows, window="24 hours", slide="6 hours", threshold=2)
    return out.select((F.unix_micros(F.col("window.start")) / 1_000_000).cast("long").alias("window_start"),
                      F.col("_rw_key").alias("host"), "window_count")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + K3: the detection stream publishes plain and burst alerts; a second stream (the
    store side) reads the published alerts and drops repeated ids within the watermark."""
    from ruleweave.functions.timeutil import iso_text_micros
    from ruleweave.streaming.pipeline import dedup_stream, fixed_rules
    from ruleweave.streaming.sources import decode_alerts
    base = _detected(spark, sf_dir, "published", fixed_rules(list(rule_pack("events"))))
    topic = spark.readStream.schema(PUBLISHED_SCHEMA).option("maxFilesPerTrigger", 8).parquet(base + "/out")
    alerts, _ = decode_alerts(topic)
    # made by a generator, so that the log is searched for its time once
    at = F.explode_outer(F.array(F.get_json_object("raw_log", "$.timestamp"))).alias("event_time")
    alerts = alerts.select("alert_id", "rule_id", "host", at).withColumn(
        "event_time", F.timestamp_micros(iso_text_micros(F.col("event_time"))))
    out = dedup_stream(alerts, "event_time", watermark="3650 days").select("alert_id", "rule_id", "host")
    return _run_stream(spark, out, "dedup")


def empty_rule_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: no rules, no alerts, same columns."""
    return evaluate(events_view(spark, sf_dir), []).select(*PLAIN_COLUMNS)


QUERIES.update({"json_log_alerts": json_log_alerts, "coarse_bursts": coarse_bursts,
                "stream_dedup": stream_dedup, "empty_rule_set": empty_rule_set})
ORACLES["json_log_alerts"] = f"WITH {EVENTS_LOGS} " + " UNION ALL ".join(
    f"SELECT '{rid}' AS rule_id, '{t}' AS rule_title, '{lvl}' AS severity, host, event_id FROM logs WHERE {w}"
    for rid, (t, lvl, w) in PLAIN_SQL.items())
ORACLES["coarse_bursts"] = f"""WITH {EVENTS_LOGS},
w AS (SELECT host, (t_us // 21600000000 - k) * 21600 AS window_start
      FROM logs, unnest(generate_series(0, 3)) AS g(k) WHERE log_type = 'error')
SELECT window_start, host, count(*) AS window_count FROM w GROUP BY window_start, host HAVING count(*) > 2"""
ORACLES["stream_dedup"] = _published() + "SELECT DISTINCT alert_id, rule_id, host FROM published"
ORACLES["empty_rule_set"] = (f"WITH {EVENTS_LOGS} SELECT CAST(NULL AS VARCHAR) AS alert_id, CAST(NULL AS VARCHAR) AS rule_id, "
                             "CAST(NULL AS VARCHAR) AS rule_title, CAST(NULL AS VARCHAR) AS severity, host, event_id "
                             "FROM logs WHERE false")


# --- ids and JSON fields (J2-J4, J9, S2, Q7) ---------------------------------------------------

def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + J9: content ids and the embedded raw-log text of one plain rule's alerts."""
    view = events_view(spark, sf_dir)
    return alert_projection(view, match_rules(view, [events_rule("ev-props-contains-001")])).select(
        "alert_id", "rule_id", "event_id", "raw_log")


def json_content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 over JSON text: ids of nested logs with unsorted keys, escapes and characters beyond ASCII."""
    from ruleweave.sources.logs import decode_json_logs, json_view
    logs = events_logs(spark, sf_dir)
    text = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    raw = F.concat(F.lit('{ "value":'), F.col("value").cast("string"), F.lit(',"user":{"name":"Zo\\u00EB \u00e9 \U0001F600",'),
                   F.lit('"id":'), F.col("host"), F.lit(',"flags":[true,null , "a\\/b"]},"props":'), F.col("props"),
                   F.lit(',"timestamp":'), text("timestamp"), F.lit(',\n"log_type": '), text("log_type"),
                   F.lit(',"event_id":'), F.col("event_id").cast("string"), F.lit(',"host":'), text("host"), F.lit("}"))
    good, _ = decode_json_logs(logs.select("event_id", raw.alias("value")))
    view = json_view(good, order_cols=["event_id"], keep=["event_id"])
    return alert_projection(view, match_rules(view, [events_rule("ev-purchase-001")])).select(
        "alert_id", "rule_id", "host", "event_id")


def bucket_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + J4: burst ids and their time buckets; one id per (rule, host, bucket)."""
    from ruleweave.functions.ids import time_bucket
    _, bursts = split_rules(list(rule_pack("events")))
    view = events_view(spark, sf_dir)
    b = burst_alerts(view, bursts)
    day = F.get_json_object("raw_log", "$.timestamp")
    return b.select("alert_id", "rule_id", "host", "event_id",
                    time_bucket(iso_text_micros(day), 86400).alias("bucket"))


def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + Q7: the ``props`` JSON of each event decoded to fields; a rule on field ``k``."""
    from ruleweave.sources.logs import decode_json_logs, json_view
    ev = read_table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    good, _ = decode_json_logs(ev)
    view = json_view(good, order_cols=["event_id"], keep=["event_id"])
    rule = Rule(id="ev-k-round-001", title="k is a round number", level="low",
                detection={"sel": {"k": [10, 20, 30, 40, 50, 60, 70, 80, 90]}, "condition": "sel"})
    m = match_rules(view, [rule])
    return m.select("event_id", F.col("_rw_rule.rule_id").alias("rule_id"),
                    view.fields.text("k").alias("k"))


QUERIES.update({"content_ids": content_ids, "json_content_ids": json_content_ids, "bucket_ids": bucket_ids, "json_fields": json_fields})
ORACLES["content_ids"] = (f"WITH {EVENTS_LOGS} SELECT {sql_uuid5(repr('ev-props-contains-001:') + ' || ' + CANON)} AS alert_id, "
                          f"'ev-props-contains-001' AS rule_id, event_id, {CANON} AS raw_log FROM logs "
                          "WHERE contains(props, '\"k\": 4')")
JSON_CANON = ("'{\"event_id\": ' || CAST(event_id AS VARCHAR) || ', \"host\": ' || to_json(host) || "
              "', \"log_type\": ' || to_json(log_type) || ', \"props\": ' || props || "
              "', \"timestamp\": ' || to_json(\"timestamp\") || ', \"user\": {\"flags\": [true, null, \"a/b\"], \"id\": ' || host || "
              "', \"name\": \"Zo\\u00eb \\u00e9 \\ud83d\\ude00\"}, \"value\": ' || CAST(value AS VARCHAR) || '}'")
ORACLES["json_content_ids"] = (f"WITH {EVENTS_LOGS} SELECT {sql_uuid5(repr('ev-purchase-001:') + ' || ' + JSON_CANON)} AS alert_id, "
                               "'ev-purchase-001' AS rule_id, host, event_id FROM logs WHERE log_type = 'purchase'")
ORACLES["bucket_ids"] = (f"WITH {EVENTS_LOGS}, {_burst_select(', t_us // 86400000000 AS bucket')} "
                         "SELECT alert_id, rule_id, host, event_id, bucket FROM burst")
ORACLES["json_fields"] = ("SELECT event_id, 'ev-k-round-001' AS rule_id, json_extract_string(props, '$.k') AS k "
                          "FROM events WHERE json_extract_string(props, '$.k') IN ('10','20','30','40','50','60','70','80','90')")


def stage_transitions_by_host(spark, sf_dir):
    from ruleweave.operators.stages import stage_labels as _labels, stage_transitions as _tr
    return _tr(_labels(events_view(spark, sf_dir), EVENTS_STAGES), by_host=True)


QUERIES["stage_transitions_by_host"] = stage_transitions_by_host
ORACLES["stage_transitions_by_host"] = (ORACLES["stage_transitions"]
    .replace("lag(stage) OVER (PARTITION BY host ORDER BY t_us, event_id) AS from_stage, stage AS to_stage FROM s",
             "host, lag(stage) OVER (PARTITION BY host ORDER BY t_us, event_id) AS from_stage, stage AS to_stage FROM s")
    .replace("SELECT from_stage, to_stage, count(*) AS transitions FROM t WHERE from_stage IS NOT NULL GROUP BY 1, 2",
             "SELECT host, from_stage, to_stage, count(*) AS transitions FROM t WHERE from_stage IS NOT NULL GROUP BY 1, 2, 3")
    .replace("SELECT from_stage, to_stage, transitions, transitions / sum(transitions) OVER (PARTITION BY from_stage) AS share FROM c",
             "SELECT host, from_stage, to_stage, transitions, transitions / sum(transitions) OVER (PARTITION BY host, from_stage) AS share FROM c"))
assert ORACLES["stage_transitions_by_host"] != ORACLES["stage_transitions"]


def stream_bursts_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on the table read as one micro-batch."""
    import uuid as _uuid
    from ruleweave.session import scratch_path
    from ruleweave.streaming.pipeline import start_table_bursts
    from ruleweave.streaming.sources import table_stream
    from ruleweave.sources.testdata import events_logs_from
    _, bursts = split_rules(list(rule_pack("events")))
    base = scratch_path(spark, "stream-queries", f"tail-bursts-{_uuid.uuid4().hex}")
    stream = table_stream(spark, sf_dir, "events", min_partitions=_cores(spark))
    q = start_table_bursts(stream, lambda df: events_view(spark, sf_dir, df=events_logs_from(df)), bursts,
                           checkpoint=base + "/checkpoint", state_path=base + "/state", publish_path=base + "/out",
                           trigger={"availableNow": True})
    q.awaitTermination()
    return _published_rows(spark, base).select(*PLAIN_COLUMNS, "window_count")


QUERIES["stream_bursts_tables"] = stream_bursts_tables
ORACLES["stream_bursts_tables"] = ORACLES["burst_alerts"]


# Conversation roles as stages.
ROLE_STAGES = [("system", {"role": "system"}), ("user", {"role": "user"}), ("assistant", {"role": "assistant"})]


def role_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 + R2 on conversations: who speaks after whom, per conversation in turn order."""
    from ruleweave.operators.stages import stage_labels as _labels, stage_transitions as _tr
    from ruleweave.sources.logs import table_view
    conv = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("host"), "turn", "role")
    view = table_view(conv, time_col="turn", order_cols=["turn"])
    return _tr(_labels(view, ROLE_STAGES, default="other"), chunk_seconds=10 ** 9)


QUERIES["role_transitions"] = role_transitions
ORACLES["role_transitions"] = """WITH s AS (SELECT CAST(conv_id AS VARCHAR) AS host, turn,
    CASE WHEN role = 'system' THEN 'system' WHEN role = 'user' THEN 'user' WHEN role = 'assistant' THEN 'assistant'
         ELSE 'other' END AS stage FROM conversations),
t AS (SELECT lag(stage) OVER (PARTITION BY host ORDER BY turn) AS from_stage, stage AS to_stage FROM s),
c AS (SELECT from_stage, to_stage, count(*) AS transitions FROM t WHERE from_stage IS NOT NULL GROUP BY 1, 2)
SELECT from_stage, to_stage, transitions, transitions / sum(transitions) OVER (PARTITION BY from_stage) AS share FROM c"""


# --- long-text predicates over documents (P2-P5 on whole texts) ------------------------------

DOCUMENT_RULES = [
    Rule(id="doc-license-001", title="License text", level="low",
         detection={"sel": {"text|contains": ["License", "licen"]}, "condition": "sel"}),
    Rule(id="doc-contact-001", title="Contact or token in English text", level="medium",
         detection={"txt": {"text|contains": ["@", "token"]}, "en": {"lang": "en"}, "condition": "txt and en"}),
    Rule(id="doc-non-english-license-001", title="License text outside English", level="medium",
         detection={"lic": {"text|contains": "License"}, "en": {"lang": "en"}, "condition": "lic and not en"}),
]


def document_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over whole documents (long texts, four languages): host = source, lang as a field."""
    from ruleweave.sources.logs import table_view
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("host"), "lang", "text")
    view = table_view(docs, time_col="doc_id", order_cols=["doc_id"], keep=["doc_id"])
    return alert_projection(view, match_rules(view, DOCUMENT_RULES)).select("rule_id", "severity", "host", "doc_id")


QUERIES["document_alerts"] = document_alerts
ORACLES["document_alerts"] = """
SELECT 'doc-license-001' AS rule_id, 'low' AS severity, source AS host, doc_id FROM documents
 WHERE contains(text, 'License') OR contains(text, 'licen')
UNION ALL
SELECT 'doc-contact-001', 'medium', source, doc_id FROM documents
 WHERE (contains(text, '@') OR contains(text, 'token')) AND lang = 'en'
UNION ALL
SELECT 'doc-non-english-license-001', 'medium', source, doc_id FROM documents
 WHERE contains(text, 'License') AND NOT (lang IS NOT NULL AND lang = 'en')"""


def stream_changelog_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events stream under the events changelog, read anew for each of several micro-batches.

    The changelog is complete from the start, so every log meets the rule set that it leaves active
    (plain and burst rules, copies included); burst windows are carried over by the tail.
    """
    from ruleweave.streaming.pipeline import changelog_rules
    base = _detected(spark, sf_dir, "changelog", changelog_rules(lambda s: events_changelog(s)))
    return _published_rows(spark, base).select("alert_id", "rule_id", "severity", "host", "event_id")


QUERIES["stream_changelog_alerts"] = stream_changelog_alerts


def _stream_changelog_oracle() -> str:
    canon_id = lambda rid: sql_uuid5(repr(rid + ":") + " || " + CANON)
    plain = [
        ("ev-purchase-001", "high", "log_type = 'purchase' AND (starts_with(CAST(value AS VARCHAR), '1') "
                                    "OR starts_with(CAST(value AS VARCHAR), '2'))"),
        ("ev-signup-001", "low", "log_type = 'signup'"),
        ("ev-signup-001", "low", "log_type = 'signup'"),
        ("ev-click-001", "low", "log_type = 'click'"),
    ]
    sel = " UNION ALL ".join(f"SELECT {canon_id(rid)} AS alert_id, '{rid}' AS rule_id, '{lvl}' AS severity, "
                             f"host, event_id FROM logs WHERE {w}" for rid, lvl, w in plain)
    return (f"WITH {EVENTS_LOGS}, {_burst_select()} {sel} UNION ALL "
            "SELECT alert_id, rule_id, severity, host, event_id FROM burst")


ORACLES["stream_changelog_alerts"] = _stream_changelog_oracle()


def stream_coarse_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 on a stream: windowed counts in update mode, kept per (window, key) with the
    largest count (counts only grow), so trailing windows are not lost at the end of input."""
    import uuid as _uuid
    from ruleweave.session import scratch_path
    from ruleweave.streaming.bursts import coarse_bursts as _coarse
    from ruleweave.streaming.pipeline import burst_rows
    from ruleweave.streaming.sources import table_stream
    from ruleweave.sources.testdata import events_logs_from
    _, bursts = split_rules(list(rule_pack("events")))
    base = scratch_path(spark, "stream-queries", f"coarse-{_uuid.uuid4().hex}")

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    def start(stream):
        view = events_view(spark, sf_dir, df=events_logs_from(stream))
        counts = _coarse(burst_rows(view, bursts), window="24 hours", slide="6 hours", threshold=2,
                         watermark="3650 days").select(
            (F.unix_micros(F.col("window.start")) / 1_000_000).cast("long").alias("window_start"),
            F.col("_rw_key").alias("host"), "window_count")
        return (counts.writeStream.outputMode("update").foreachBatch(sink)
                .option("checkpointLocation", base + "/checkpoint").trigger(availableNow=True).start())

    _drain_slices(spark, sf_dir, base, start)
    out = spark.read.schema("window_start long, host string, window_count long").parquet(base + "/out")
    return out.groupBy("window_start", "host").agg(F.max("window_count").alias("window_count"))


QUERIES["stream_coarse_bursts"] = stream_coarse_bursts
ORACLES["stream_coarse_bursts"] = ORACLES["coarse_bursts"]


def strict_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S5 + S6: which texts made from the documents are one JSON object, and what they decode to.

    Each document gives a whole object, two objects in a row, an object with trailing text, one in
    single quotes, an array of objects, and a broken object.
    """
    doc = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text")))
    raw = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.posexplode(F.array(
        doc, F.concat(doc, doc), F.concat(doc, F.lit(" junk }")), F.concat(F.lit("{'id':'"), F.col("doc_id"), F.lit("'}")),
        F.concat(F.lit("["), doc, F.lit("]")), F.expr("substring(to_json(struct(text)), 1, length(text))"))).alias("kind", "value"))
    from ruleweave.sources.logs import decode_json_logs
    good, bad = decode_json_logs(raw)
    ok = good.select("doc_id", "kind", F.lit(True).alias("processed"),
                     (F.col("_rw_fields")["text"] == F.col("text")).alias("same_text"))
    return ok.unionByName(bad.select("doc_id", "kind", F.lit(False).alias("processed"), F.lit(None).cast("boolean").alias("same_text")))


QUERIES["strict_decode"] = strict_decode
ORACLES["strict_decode"] = """SELECT doc_id, CAST(kind AS INTEGER) AS kind, kind = 0 AS processed,
    CASE WHEN kind = 0 THEN TRUE END AS same_text FROM documents, unnest(range(6)) AS u(kind)"""


def alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9 + K1 + S6: published alert documents, decoded strictly; raw_log is an object inside each."""
    from ruleweave.operators.evaluate import alerts_json
    from ruleweave.streaming.sources import checked_alerts
    # decoded and quarantined documents in one frame: the union of both would publish everything twice
    docs = checked_alerts(alerts_json(evaluate(spread_events(spark, sf_dir), list(rule_pack("events")))))
    names = ["event_id", "log_type", "props", "timestamp"]
    docs = docs.select("*", F.json_tuple("_rw_raw_log", *names).alias(*names))
    ok = F.col("_rw_ok")
    return docs.select(F.when(ok, F.col("_rw_alert_id")).otherwise(F.col("key")).alias("alert_id"),
                       F.when(ok, F.col("_rw_rule_id")).otherwise(F.lit("not decoded")).alias("rule_id"),
                       F.col("_rw_severity").alias("severity"), F.col("_rw_host").alias("host"),
                       F.col("event_id").cast("long").alias("event_id"), *names[1:])


QUERIES["alert_documents"] = alert_documents
ORACLES["alert_documents"] = _published() + """SELECT p.alert_id, p.rule_id, p.severity, p.host, p.event_id, l.log_type, l.props,
    l."timestamp" FROM published p JOIN logs l USING (event_id)"""


BY_FIELD_RULE = Rule("ev-type-burst-001", "Busy event type", "low", {
    "some": {"host|startswith": "1"}, "condition": "some | count() by log_type > 5", "timeframe": "6h"})


def burst_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + J3: bursts by a field other than the host; the key is part of the alert id."""
    return burst_alerts(events_view(spark, sf_dir), [BY_FIELD_RULE]).select(
        "alert_id", "rule_id", "severity", "host", "event_id", "window_count")


QUERIES["burst_by_field"] = burst_by_field
ORACLES["burst_by_field"] = f"""WITH {EVENTS_LOGS}, counted AS (
  SELECT *, count(*) OVER (PARTITION BY log_type ORDER BY t_us RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW)
            - (count(*) OVER (PARTITION BY log_type, t_us)
               - row_number() OVER (PARTITION BY log_type, t_us ORDER BY event_id)) AS window_count
  FROM logs WHERE starts_with(host, '1'))
SELECT {sql_uuid5("'ev-type-burst-001:' || host || ':' || CAST(t_us // 21600000000 AS VARCHAR) || ':by=' || log_type")}
    AS alert_id, 'ev-type-burst-001' AS rule_id, 'low' AS severity, host, event_id, window_count
FROM counted WHERE window_count > 5"""


def burst_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON logs without a timestamp count by arrival: one log a second in order of event_id, id bucket 0."""
    from ruleweave.sources.logs import decode_json_logs, json_view
    _, bursts = split_rules(list(rule_pack("events")))
    ev = events_logs(spark, sf_dir)
    raw = ev.select("event_id", F.timestamp_seconds("event_id").alias("arrived"),
                    F.to_json(F.struct("host", "log_type", "props")).alias("value"))
    good, _ = decode_json_logs(raw)
    view = json_view(good, order_cols=["event_id"], keep=["event_id"], arrival_col="arrived")
    return burst_alerts(view, bursts).select("alert_id", "rule_id", "host", "event_id", "window_count")


QUERIES["burst_arrival"] = burst_arrival
ORACLES["burst_arrival"] = f"""WITH {EVENTS_LOGS}, counted AS (
  SELECT *, count(*) OVER (PARTITION BY host ORDER BY event_id RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW) AS window_count
  FROM logs WHERE log_type = 'error')
SELECT {sql_uuid5("'ev-error-burst-001:' || host || ':0'")} AS alert_id, 'ev-error-burst-001' AS rule_id,
    host, event_id, window_count FROM counted WHERE window_count > 2"""


QUERIES.update({"alerts_by_rule": alerts_by_rule, "alerts_by_id": alerts_by_id})
ORACLES["alerts_by_rule"] = _published() + "SELECT alert_id, host, event_id FROM stored WHERE rule_id = 'ev-error-burst-001'"
ORACLES["alerts_by_id"] = _published() + "SELECT alert_id, rule_id, severity, host FROM stored ORDER BY alert_id LIMIT 1"


def _event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day_us, events): the start of every day with events, and their number."""
    day = ntz_micros(F.date_trunc("day", F.col("ts")).cast("timestamp_ntz"))
    return read_table(spark, sf_dir, "events").groupBy(day.alias("day_us")).agg(F.count(F.lit(1)).alias("events"))


def rule_count_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of active rules at the start of every day with events."""
    from ruleweave.operators.lifecycle import rule_count_at
    return rule_count_at(events_changelog(spark), _event_days(spark, sf_dir), "day_us")


def envelope_errors_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 + S4: the envelopes skipped on each day with events, and why."""
    from ruleweave.operators.lifecycle import with_errors
    bad = with_errors(events_changelog(spark)).where(F.col("error").isNotNull()).select(
        F.col("at_us").alias("day_us"), "seq", "error")
    return _event_days(spark, sf_dir).join(bad, "day_us")


QUERIES.update({"rule_count_asof": rule_count_asof, "envelope_errors_by_day": envelope_errors_by_day})
_DAYS = "days AS (SELECT epoch_us(date_trunc('day', ts)) AS day_us, count(*) AS events FROM events GROUP BY 1)"
ORACLES["rule_count_asof"] = f"""WITH {_DAYS} SELECT day_us, events,
    2 + CAST(day_us >= {_day_us(5)} AND day_us < {_day_us(15)} AS INT) + CAST(day_us >= {_day_us(20)} AS INT)
      + CAST(day_us >= {_day_us(22)} AS INT) + CAST(day_us >= {_day_us(27)} AS INT)
      - CAST(day_us >= {_day_us(18)} AND day_us < {_day_us(19)} AS INT) AS rule_count FROM days"""
ORACLES["envelope_errors_by_day"] = f"""WITH {_DAYS}, bad(day_us, seq, error) AS (VALUES
    ({_day_us(25)}, 9, $$'rule_id' differs from the rule's own id$$), ({_day_us(26)}, 10, $$no 'op' given$$),
    ({_day_us(29)}, 13, $$unknown op: rename$$)) SELECT day_us, events, seq, error FROM days JOIN bad USING (day_us)"""


# --- rates of counters (M1, M2) over scraped samples of the events ------------------------------

SCRAPE_US, RUN_US = 900_000_000, 43_200_000_000


def worker_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(worker, le, t_us, value): bucket counters of four workers, scraped at each quarter of an hour in which the
    worker had events. A worker restarts every twelve hours and counts from 0 again."""
    ev = _events_timed(spark, sf_dir).where("t_us IS NOT NULL AND value IS NOT NULL")
    slot = F.col("t_us") - F.pmod("t_us", F.lit(SCRAPE_US))
    les = [*DEFAULT_BOUNDS, float("inf")]
    seen = ev.groupBy("worker", slot.alias("t_us")).agg(
        *[F.count_if(F.col("value") <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(les)])
    run = Window.partitionBy("worker", F.col("t_us") - F.pmod("t_us", F.lit(RUN_US))).orderBy("t_us")
    counters = F.array(*[F.struct(F.lit(b).alias("le"), F.sum(f"b{i}").over(run).alias("value")) for i, b in enumerate(les)])
    return seen.select("worker", "t_us", counters.alias("c")).select("worker", "t_us", F.inline("c"))


def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: events per second of every worker over the last six hours, at each third hour."""
    from ruleweave.operators.metrics import counter_rate as _rate
    total = worker_counters(spark, sf_dir).where(F.col("le") == F.lit(float("inf")))
    return _rate(total, ["worker"], range_seconds=21_600, step_seconds=10_800)


def rate_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: median and 99 % latency of all workers from the rates of their bucket counters."""
    from ruleweave.operators.metrics import rate_quantile as _quantile
    samples = worker_counters(spark, sf_dir)
    parts = [_quantile(samples, q, [], ["worker"], range_seconds=21_600, step_seconds=10_800) for q in (0.5, 0.99)]
    return parts[0].unionByName(parts[1])


QUERIES.update({"counter_rate": counter_rate, "rate_quantile": rate_quantile})
_COUNTERS = f"""{_TIMED},
bounds AS (SELECT unnest([{", ".join(f"{b}::DOUBLE" for b in _BOUNDS)}, 'inf'::DOUBLE]) AS le),
scraped AS (SELECT worker, le, t_us - t_us % {SCRAPE_US} AS t, count(*) FILTER (WHERE value <= le) AS n
            FROM timed, bounds WHERE t_us IS NOT NULL AND value IS NOT NULL GROUP BY ALL),
samples AS (SELECT worker, le, t, sum(n) OVER (PARTITION BY worker, le, t // {RUN_US} ORDER BY t)::DOUBLE AS v FROM scraped),
ends AS (SELECT unnest(range((SELECT min(t) // 10800000000 FROM samples), (SELECT max(t) // 10800000000 + 4 FROM samples)))
                * 10800000000 AS e),
held AS (SELECT worker, le, e, t, v, lag(v) OVER (PARTITION BY worker, le, e ORDER BY t) AS p
         FROM samples JOIN ends ON t > e - 21600000000 AND t <= e),
seen AS (SELECT worker, le, e, count(*) AS k, min(t) AS t0, max(t) AS t1, arg_min(v, t) AS v0,
                sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) AS up
         FROM held GROUP BY ALL HAVING max(t) > min(t)),
edges AS (SELECT *, t1 - t0 AS span, (t1 - t0) / (k - 1) AS d, t0 - (e - 21600000000) AS a, e - t1 AS b FROM seen),
rates AS (SELECT worker, le, e, k, up * (span + least(CASE WHEN a >= 1.1 * d THEN d / 2 ELSE a END,
                                                 CASE WHEN up > 0 THEN span * (v0 / up) ELSE 1e300 END)
                                 + CASE WHEN b >= 1.1 * d THEN d / 2 ELSE b END) / span AS increase FROM edges)"""
ORACLES["counter_rate"] = f"""WITH {_COUNTERS} SELECT worker, e AS window_end_us, k AS samples, increase,
    increase / 21600 AS rate FROM rates WHERE le = 'inf'::DOUBLE"""
ORACLES["rate_quantile"] = f"""WITH {_COUNTERS},
s AS (SELECT e, le, sum(increase / 21600) AS r FROM rates GROUP BY ALL),
m AS (SELECT e, le, max(r) OVER (PARTITION BY e ORDER BY le) AS r FROM s),
w AS (SELECT e, le, r, max(r) OVER (PARTITION BY e) AS total, coalesce(lag(r) OVER (PARTITION BY e ORDER BY le), 0) AS r0,
             coalesce(lag(le) OVER (PARTITION BY e ORDER BY le), 0) AS le0 FROM m),
f AS (SELECT e, q, arg_min(struct_pack(le := le, le0 := le0, r := r, r0 := r0, total := total), le) AS x
      FROM w, (VALUES (0.5::DOUBLE), (0.99::DOUBLE)) AS u(q) WHERE r >= q * total AND total > 0 GROUP BY ALL)
SELECT e AS window_end_us, q AS quantile, CASE WHEN x.le = 'inf'::DOUBLE THEN x.le0 WHEN x.r = x.r0 THEN x.le
    ELSE x.le0 + (x.le - x.le0) * (q * x.total - x.r0) / (x.r - x.r0) END AS value FROM f"""


# --- rule versions as data (L6) ------------------------------------------------------------------

def asof_table_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 with the changelog as data: the alerts of ``asof_alerts`` by joins."""
    from ruleweave.operators.asof import asof_table_alerts as _asof
    alerts, _ = _asof(events_view(spark, sf_dir), events_changelog(spark), ["event_id"])
    return alerts.select(*PLAIN_COLUMNS)


def watch_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changelog that grows with the events: an error of a user puts a rule on the user's purchases from then on,
    titled by the error's event; the user's next error replaces it, a signup ends it."""
    ev = read_table(spark, sf_dir, "events").where("user_id IS NOT NULL AND event_type IN ('error', 'signup')")
    rid = F.concat(F.lit("watch-"), F.col("user_id"))
    detection = F.struct(F.struct(F.col("user_id").cast("string").alias("host"), F.lit("purchase").alias("log_type"))
                         .alias("sel"), F.lit("sel").alias("condition"))
    rule = F.to_json(F.struct(rid.alias("id"), F.concat(F.lit("After error "), F.col("event_id")).alias("title"),
                              F.lit("high").alias("level"), detection.alias("detection")))
    error = F.col("event_type") == "error"
    # changes apply in order of time, ties by event; the number in that order is the sequence
    order = Window.partitionBy("user_id").orderBy("t", "event_id")
    seq = F.col("user_id") * F.lit(1 << 24) + F.row_number().over(order)
    return ev.withColumn("t", ntz_micros(F.col("ts"))).where("t IS NOT NULL").select(
        seq.alias("seq"), F.col("t").alias("at_us"), F.when(error, "update").otherwise("delete").alias("op"),
        rid.alias("rule_id"), F.when(error, rule).alias("rule"))


def watched_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 over a changelog with as many versions as the events have errors."""
    from ruleweave.operators.asof import asof_table_alerts as _asof
    alerts, _ = _asof(spread_events(spark, sf_dir), watch_changelog(spark, sf_dir), ["event_id"])
    return alerts.select(*PLAIN_COLUMNS)


QUERIES.update({"asof_table_alerts": asof_table_alerts, "watched_purchases": watched_purchases})
ORACLES["asof_table_alerts"] = ORACLES["asof_alerts"]
ORACLES["watched_purchases"] = f"""WITH {EVENTS_LOGS},
c AS (SELECT host, log_type, event_id, t_us, lead(t_us) OVER (PARTITION BY host ORDER BY t_us, event_id) AS until
      FROM logs WHERE log_type IN ('error', 'signup') AND host IS NOT NULL)
SELECT {sql_uuid5("'watch-' || host || ':' || " + CANON)} AS alert_id, 'watch-' || host AS rule_id,
    'After error ' || error_id AS rule_title, 'high' AS severity, host, event_id
FROM (SELECT l.*, c.event_id AS error_id FROM logs l JOIN c ON c.host = l.host AND c.log_type = 'error'
          AND l.t_us >= c.t_us AND (c.until IS NULL OR l.t_us < c.until) WHERE l.log_type = 'purchase')"""
