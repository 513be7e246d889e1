"""Groups are searched by one term and checked on the others."""

from pyspark.sql import functions as F

from ruleweave.operators import ruletable
from ruleweave.operators.evaluate import plain_alerts
from ruleweave.operators.lifecycle import entries
from ruleweave.plans.rules import Rule


def _conditions(spark, rules):
    return ruletable.local_table(spark, ruletable.split_for_table(rules)[0], ruletable.CONDITIONS_SCHEMA)


def _rule(i, selection, condition="sel", **groups):
    return Rule(f"r{i}", f"R {i}", "low", {"sel": selection, **groups, "condition": condition})


def test_a_term_that_all_rules_share_is_not_searched_by(spark):
    rules = [_rule(i, {"log_type": "purchase", "host": str(i)}) for i in range(200)]
    anchors = ruletable.anchored(_conditions(spark, rules)).collect()
    assert {(a.rule_ord, a.field, a.jv) for a in anchors} == {(i, "host", str(i)) for i in range(200)}
    assert len(anchors) == 200
    assert all([[(c.field, c.value) for c in term] for term in a.rest] == [[("log_type", "purchase")]] for a in anchors)


def test_logs_meet_only_rules_of_their_rare_term(spark, logs_of):
    rules = [_rule(i, {"log_type": "purchase", "host": str(i)}) for i in range(60)]
    view = logs_of([{"host": str(i % 50), "log_type": "purchase" if i % 3 else "view"} for i in range(100)])
    paths, others = ruletable.paths_in(ruletable.anchored(_conditions(spark, rules)))
    assert paths == {"host": {("eq", 0)}} and others == ["log_type"]
    got = ruletable.table_alerts(spark, view, rules, ["seq"])
    assert got.groupBy("rule_id", "seq").count().collect().__len__() == got.count() == sum(1 for i in range(100) if i % 3)


def test_terms_of_all_kinds_beside_the_searched_one(spark, logs_of):
    words = ["alpha", "beta", "", "alphabet", "None", "a"]
    logs = [{k: v for k, v in (("host", str(i % 4)), ("kind", words[i % 6]), ("text", words[(i // 3) % 6] + "-end"),
                               ("level", None if i % 5 == 0 else i % 3)) if (i + len(k)) % 7} for i in range(120)]
    rules = [
        _rule(0, {"host": ["1", "2"], "kind|startswith": "al", "text|endswith": ["end", "x"]}),
        _rule(1, {"host": "1", "text|contains": "lphab"}),
        _rule(2, {"kind|contains": "", "level": "None"}),
        _rule(3, {"host": "1", "kind": "beta"}, "sel or not other", other={"level": [0, 1], "text|contains": "et"}),
        _rule(4, {"host": "3", "missing": "x"}),
        _rule(5, {"host": "0", "kind|endswith": "bet"}, "not sel"),
        _rule(6, {"kind": words, "host|startswith": "", "level": [0, 2]}),
    ]
    view = logs_of(logs)
    cols = ["alert_id", "rule_id", "seq"]
    expected = sorted(plain_alerts(view, rules).select(*cols).collect())
    assert sorted(ruletable.table_alerts(spark, view, rules, ["seq"]).select(*cols).collect()) == expected and expected


def test_entries_end_at_the_next_update_or_delete(spark):
    """A rule of very many changes: each is read once."""
    n = 30_000
    rule = '{"id":"r","title":"t","level":"low","detection":{}}'
    log = spark.range(n).select(F.col("id").alias("seq"), F.col("id").alias("at_us"), F.when(F.col("id") % 3 == 0, "add")
                                .otherwise("update").alias("op"), F.lit("r").alias("rule_id"), F.lit(rule).alias("rule"))
    ends = {r.seq: r.to_seq for r in entries(log).select("seq", "to_seq").collect()}
    assert len(ends) == n
    assert all(ends[i] == next((j for j in (i + 1, i + 2) if j % 3 and j < n), None) for i in range(n))
