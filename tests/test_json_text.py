"""One whole JSON object per text, and raw logs that survive unchanged."""

import json

import pytest
from pyspark.sql import functions as F

from ruleweave.functions.ids import canonical_json
from ruleweave.functions.jsontext import strict_object
from ruleweave.operators.evaluate import alerts_json, plain_alerts
from ruleweave.operators.lifecycle import decode_envelopes, with_errors
from ruleweave.plans.rules import Rule
from ruleweave.sources.logs import table_view

OBJECTS = ['{"a":1}', ' {"a":{"b":[1,2]},"c":null} \n', "{}", '{"a":1.0,"a":"x"}', '{"a":" \u0085  é"}', '{"a":"}]"}']
OTHERS = ['{"a":1}{"b":2}', '{"a":1} junk }', "{'a':1}", '{"a":1},{"b":2}', "[1]", "", "1", "null", '{"a":1', '{"a":1}]',
          '{"a":1}],[{"b":1}', "{a:1}", '"x"', '{"a":1} // c', "[{}]", '{"a":1}] }', '{"a":1},{}] {}', '{"a":1}} ']


@pytest.mark.parametrize("text", OBJECTS + OTHERS)
def test_only_whole_objects_are_read(spark, text):
    got = spark.createDataFrame([(text,)], "v string").select(strict_object(F.col("v")).alias("m")).first().m
    assert (got is not None) == (text in OBJECTS)
    if got is not None:
        assert set(got) == set(json.loads(text))


def test_envelopes_with_trailing_text_change_nothing(spark):
    rows = [(1, '{"op":"delete","rule_id":"a"} junk'), (2, '{"op":"delete","rule_id":"a"}'), (3, "[]")]
    got = with_errors(decode_envelopes(spark.createDataFrame(rows, "seq long, value string"))).collect()
    assert [(r.seq, r.op, r.error is None) for r in got] == [(1, None, False), (2, "delete", True), (3, None, False)]


@pytest.mark.parametrize("text", ["a b", "a c", "x\u0085y", 'q"\\\n\t', "", "é日"])
def test_canonical_text_keeps_every_character(spark, text):
    df = spark.createDataFrame([(text, 1.5), (text, float("nan")), (text, float("inf"))], "t string, d double")
    got = [json.loads(r[0]) for r in df.select(canonical_json(df.schema)).collect()]
    assert [g["t"] for g in got] == [text] * 3 and [g["d"] for g in got] == [1.5, "NaN", "Infinity"]


def test_texts_that_differ_by_a_line_separator_have_ids_of_their_own(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a ", "c ", "x\u0085"])], "n long, t string")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("n")))
    view = table_view(df, time_col="ts", order_cols=["n"], fields=["t"])
    rows = plain_alerts(view, [Rule("r", "t", "l", {"s": {"t|contains": ""}, "condition": "s"})]).collect()
    assert len({r.alert_id for r in rows}) == 3


def test_documents_embed_the_log_as_it_came(logs_of, spark):
    raws = ['{"host":"h","b":1.0,"a":[1, 2],"x":" "}', '{"host":"h","b":2,"b":3}']
    alerts = plain_alerts(logs_of(raws), [Rule("r", "t", "l", {"s": {"host": "h"}, "condition": "s"})])
    values = [r.value for r in alerts_json(alerts).collect()]
    assert all(any(raw in v for v in values) for raw in raws)
    assert {json.loads(v)["rule_id"] for v in values} == {"r"}
