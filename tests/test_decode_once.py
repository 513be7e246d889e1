"""Alert messages are parsed once for the check and once for their fields."""

import json

from pyspark.sql import functions as F

from ruleweave.catalog import QUERIES
from ruleweave.streaming.sources import ALERT_KEYS, checked_alerts, decode_alerts

MESSAGE = {"alert_id": "1", "rule_id": "r", "rule_title": 't"é', "severity": "high", "matched_at": "x", "host": "h", "raw_log": {"a": 1}}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_one_parse_checks_a_message(spark):
    good, bad = decode_alerts(spark.createDataFrame([(json.dumps(MESSAGE),)], "value string").repartition(2))
    assert _plan(good).count("from_json") == 1 and _plan(bad).count("from_json") == 1


def test_fields_as_single_lookups_give_them(spark):
    texts = [json.dumps(dict(MESSAGE, **x)) for x in (
        {}, {"severity": 5}, {"severity": 1.50}, {"host": None}, {"host": {"b": [1, 2.0]}}, {"raw_log": "text"}, {"raw_log": None},
        {"raw_log": {"timestamp": "t", "n": {"m": [1, None]}}}, {"host": True})]
    whole = json.dumps(MESSAGE)
    texts += [whole[:-1] + ', "host": "second"}', whole[:-1] + ', "raw_log": {}}', whole.replace('"h"', "null")[:-1] + ', "host": "later"}']
    broken = ["", "{}", "[]", whole + whole, whole[:-1], whole.replace('"', "'")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + broken)] + [(99, None)], "n int, value string")
    good, bad = decode_alerts(df)
    assert good.columns == ALERT_KEYS and bad.columns == ["n", "value"]
    assert sorted(r.n for r in bad.collect()) == [*range(len(texts), len(texts) + len(broken)), 99]
    single = [F.get_json_object("value", f"$.{k}").alias(k) for k in ALERT_KEYS[:-1]]
    want = df.where(F.col("n") < len(texts)).select(*single, F.coalesce(F.get_json_object("value", "$.raw_log"), F.lit("{}")).alias("raw_log"))
    assert sorted(map(str, good.collect())) == sorted(map(str, want.collect()))
    assert checked_alerts(df).where("NOT _rw_ok AND _rw_alert_id IS NOT NULL").count() == 0


def _events(spark, tmp_path, n):
    rows = spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3).alias("user_id"), F.when(F.col("id") % 2 == 0, "error").otherwise("purchase").alias("event_type"),
        F.lit(1.5).alias("value"), F.format_string('{"k": %d}', F.col("id") % 100).alias("props"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_alert_documents_publishes_once(spark, tmp_path):
    out = QUERIES["alert_documents"](spark, _events(spark, tmp_path, 300))
    # the log is made into JSON for plain and for burst alerts, not again for those that are quarantined
    assert 1 <= _plan(out).count("from_json") <= 2
    assert out.where("rule_id = 'not decoded'").count() == 0 and out.where("event_id IS NULL").count() == 0 and out.count() > 0


def test_slices_of_a_stream_have_a_file_per_core(spark, tmp_path):
    from ruleweave import catalog
    made = []

    class Started:
        def awaitTermination(self):
            pass

    def start(stream):
        made.append(stream)
        return Started()

    catalog._drain_slices(spark, _events(spark, tmp_path / "in", 400), str(tmp_path / "out"), start)
    files = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "out/slices")).select(F.input_file_name().alias("f"))
    assert len(made) == catalog.SLICES + 1
    assert files.distinct().count() > 2 * len(made)
    assert files.count() == 400


def test_events_are_read_once_for_all_slices(spark, tmp_path, monkeypatch):
    from ruleweave import catalog
    read, given = spark.sparkContext.accumulator(0), catalog.read_table

    def counted(spark, sf_dir, name):
        df = given(spark, sf_dir, name)

        def seen(row):
            read.add(1)
            return row
        return spark.createDataFrame(df.rdd.map(seen), df.schema)

    class Started:
        def awaitTermination(self):
            pass

    monkeypatch.setattr(catalog, "read_table", counted)
    catalog._drain_slices(spark, _events(spark, tmp_path / "in", 60), str(tmp_path / "out"), lambda stream: Started())
    assert read.value == 60
    assert spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "out/slices")).count() == 60


def test_alerts_for_one_sink_are_kept_only_to_find_that_there_are_none(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from ruleweave.streaming import pipeline
    kept, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(1) or persist(self, *a))
    alerts = spark.createDataFrame([(*[str(k) for k in range(6)], "{}", 1)], ", ".join(f"{c} string" for c in ALERT_KEYS) + ", n long")

    def sink(alerts, batch, store, some):
        before = len(kept)
        pipeline._sink(alerts, batch, ["n"], str(tmp_path / "out"), store and str(tmp_path / "store"), None, "", ["n"], some=some)
        return len(kept) - before

    assert sink(alerts, 0, False, alerts) == 0
    assert sink(alerts, 1, True, alerts) >= 1
    assert sink(alerts, 2, False, alerts.limit(0)) == 1     # alerts of bursts alone
    assert sink(alerts.limit(0), 3, False, alerts.limit(0)) == 1
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("batch_id").count().orderBy("batch_id").collect()] == [0, 1, 2]


def test_marks_are_values_and_cannot_be_forged(spark):
    from ruleweave.functions.jsontext import marked_parse, strict_object
    whole = '{"a": "1", "_rw_mark": "x"}'
    texts = [whole, "{}", whole + "," + whole, "{},{}", '{},{"_rw_mark":"', '{}]', "[]", "null", '{"a":1},', "1", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")
    found = {r.n: r.m for r in df.select("n", strict_object(F.col("value")).alias("m")).collect()}
    assert {n: m for n, m in found.items() if m is not None} == {0: {"a": "1", "_rw_mark": "x"}, 1: {}}
    # a new key for each text would stay with the JSON reader
    keys = {k for r in df.select(marked_parse(F.col("value")).alias("p")).collect() for m in (r.p or [])[-1:] for k in m or {}}
    assert keys == {"_rw_mark"}


def test_usual_times_are_read_without_being_rewritten(spark):
    from ruleweave.functions.timeutil import _rewritten_micros, iso_text_micros
    base = "2024-03-01T10:20:30"
    texts = [base + x for x in ("", "Z", "+00:00", "-00:00", "+18:00", "+18:30", "+24:00", "+05:60", ".5", ".123456Z", ".1234567Z", ".Z", "z",
                                "+0530", "+05", "\n", " ", "+00:00\n", "Z ", "Zx", "[UTC]")]
    texts += [t.replace("T", " ") for t in texts] + [" " + base, "2024-03-01", "2024-03-01T10:20", "2024-02-30T10:20:30Z", "2023-02-29T00:00:00",
              "2024-03-01T24:00:00Z", "2024-03-01T23:59:60Z", "0000-01-01T00:00:00Z", "0001-01-01T00:00:00", "1500-02-29T00:00:00Z",
              "9999-12-31T23:59:59.999999Z", "24-03-01T10:20:30Z", "T", "", "x", "٢٠٢٤-03-01T10:20:30Z", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    rows = df.select("t", iso_text_micros(F.col("t")).alias("a"), _rewritten_micros(F.col("t")).alias("b")).collect()
    assert [(r.t, r.a) for r in rows] == [(r.t, r.b) for r in rows]
    assert sum(r.a is not None for r in rows) > 20
