"""Ids of JSON-text logs equal UUIDv5 over ``json.dumps(log, sort_keys=True)``."""

import json
import random
import uuid

from pyspark.sql import functions as F

from ruleweave.functions.pyjson import canonical_text
from ruleweave.operators.evaluate import plain_alerts
from ruleweave.plans.rules import Rule


def random_logs(n, seed):
    rnd = random.Random(seed)
    pieces = ["a", "b", "Z", " ", "\\", '"', "/", "\n", "\t", "\x00", "\x1f", "\x7f", "é", "日", "\U0001F600", "\uffee",
              "\u2028", "'", "{", ",", ":", "]"]
    numbers = [0, -1, 10 ** 25, 1e16, 1e15, 123456789012345680.0, 1e-4, 1e-5, 0.00012, 5e-324, 1.7976931348623157e308, -0.0,
               4625.0, 1.5, 2e-3, 8.41e21, 2.0 ** -44]

    def text():
        return "".join(rnd.choice(pieces) for _ in range(rnd.choice([0, 1, 3, 8])))

    def value(depth):
        r = rnd.random()
        if depth and r < .15:
            return {text(): value(depth - 1) for _ in range(rnd.choice([0, 1, 3]))}
        if depth and r < .3:
            return [value(depth - 1) for _ in range(rnd.choice([0, 1, 3]))]
        return rnd.choice([None, True, False, rnd.choice(numbers), rnd.random() * 10 ** rnd.randint(-30, 30), text(), text()])

    out = []
    for _ in range(n):
        log = {text(): value(3) for _ in range(rnd.choice([0, 1, 2, 6]))} | {"log_type": "x"}
        out.append(json.dumps(log, ensure_ascii=rnd.random() < .5, indent=rnd.choice([None, None, 2]),
                              separators=rnd.choice([None, (",", ":")])))
    return out


def test_text_equals_json_dumps(spark):
    texts = random_logs(700, 1)
    texts += ['{"a":-0,"b":1E3,"c":1e400,"d":-1e-400,"e":"\\u0041\\u00e9\\uD83D\\ude00\\/","f":"\\ud800x"}', "{}", ' { "a" : [ ] } ',
              '{"k":"' + '\\n\\"' * 20000 + '"}', '{"a":1.0E+2,"\\u0062":{"\\"":1}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.c for r in df.select("i", canonical_text(F.col("t")).alias("c")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == json.dumps(json.loads(t), sort_keys=True)


def test_alert_ids_equal_the_original(logs_of):
    texts = random_logs(300, 2)
    rule = Rule(id="r-é", title="t", level="low", detection={"sel": {"log_type": "x"}, "condition": "sel"})
    got = {r.seq: r.alert_id for r in plain_alerts(logs_of(texts), [rule]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        name = "r-é:" + json.dumps(json.loads(t), sort_keys=True)
        assert got[i] == str(uuid.uuid5(uuid.NAMESPACE_OID, name))


def test_repeated_keys_keep_a_stable_id(logs_of):
    rule = Rule(id="r", title="t", level="low", detection={"sel": {"a": 2}, "condition": "sel"})
    ids = [r.alert_id for r in plain_alerts(logs_of(['{"a":1,"a":2}', '{"a":1, "a":2}', '{"a":3,"a":2,"b":1}']), [rule]).collect()]
    assert ids[0] == ids[1] != ids[2]
