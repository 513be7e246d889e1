"""Rule predicates over hand-made logs (cases from the reference's tests)."""

import pytest

from ruleweave.errors import RuleError
from ruleweave.operators.evaluate import evaluate, plain_alerts
from ruleweave.plans.rules import Rule, build_rule


def rule(detection, rid="r1", level="medium"):
    return Rule(id=rid, title=f"title {rid}", level=level, detection=detection)


def hits(view, rules):
    return sorted((r.seq, r.rule_id) for r in plain_alerts(view, rules).collect())


def sel(cond="selection", **groups):
    d = dict(groups)
    d["condition"] = cond
    return d


def test_equality_and_int_text_coercion(logs_of):
    v = logs_of([{"log_type": "windows_event", "event_id": 4625},
                 {"log_type": "windows_event", "event_id": "4625"},
                 {"log_type": "windows_event", "event_id": 4624}])
    r = rule(sel(selection={"log_type": "windows_event", "event_id": "4625"}))
    assert hits(v, [r]) == [(0, "r1"), (1, "r1")]


def test_missing_field_does_not_match(logs_of):
    v = logs_of([{"log_type": "windows_event"}])
    assert hits(v, [rule(sel(selection={"event_id": "4625"}))]) == []


@pytest.mark.parametrize("mod,value,ok,ko", [
    ("startswith", "Delete", "DeleteBucket", "GetObject"),
    ("contains", "powershell", "powershell.exe", "cmd.exe"),
    ("endswith", ".exe", "cmd.exe", "bash"),
])
def test_modifiers(logs_of, mod, value, ok, ko):
    v = logs_of([{"f": ok}, {"f": ko}])
    assert hits(v, [rule(sel(selection={f"f|{mod}": value}))]) == [(0, "r1")]


def test_value_list_is_or_and_empty_list_false(logs_of):
    v = logs_of([{"e": 4625}, {"e": 9999}])
    assert hits(v, [rule(sel(selection={"e": [4624, 4625, 4648]}))]) == [(0, "r1")]
    assert hits(v, [rule(sel(selection={"e": []}))]) == []


def test_list_under_modifier(logs_of):
    v = logs_of([{"p": "powershell.exe"}, {"p": "cmd.exe"}, {"p": "bash"}])
    assert hits(v, [rule(sel(selection={"p|contains": ["powershell", "cmd"]}))]) == [(0, "r1"), (1, "r1")]


def test_unknown_modifier_never_matches(logs_of):
    v = logs_of([{"f": "abc"}])
    assert hits(v, [rule(sel(selection={"f|re": ".*"}))]) == []
    assert hits(v, [rule(sel(selection={"f|contains|all": "a"}))]) == []


def test_empty_group_is_true(logs_of):
    v = logs_of([{"f": "x"}])
    assert hits(v, [rule(sel(selection={}))]) == [(0, "r1")]


def test_not_and_not_on_missing_field(logs_of):
    v = logs_of([{"a": "1", "b": "x"}, {"a": "1", "b": "y"}, {"a": "1"}])
    r = rule(sel("sel and not filter", sel={"a": "1"}, filter={"b": "x"}))
    assert hits(v, [r]) == [(1, "r1"), (2, "r1")]


def test_parentheses_and_precedence(logs_of):
    v = logs_of([{"a": 1, "c": 1}, {"b": 1, "c": 1}, {"a": 1}, {"c": 1}])
    r = rule(sel("( s1 or s2 ) and s3", s1={"a": 1}, s2={"b": 1}, s3={"c": 1}))
    assert hits(v, [r]) == [(0, "r1"), (1, "r1")]
    # without parentheses "and" binds tighter: s1 or (s2 and s3)
    r2 = rule(sel("s1 or s2 and s3", s1={"a": 1}, s2={"b": 1}, s3={"c": 1}))
    assert hits(v, [r2]) == [(0, "r1"), (1, "r1"), (2, "r1")]


def test_stacked_not(logs_of):
    v = logs_of([{"a": 1}, {"a": 2}])
    assert hits(v, [rule(sel("not not s", s={"a": 1}))]) == [(0, "r1")]


def test_json_null_is_present_and_reads_none(logs_of):
    v = logs_of([{"u": None}, {}])
    assert hits(v, [rule(sel(selection={"u": "None"}))]) == [(0, "r1")]


def test_boolean_lowered(logs_of):
    v = logs_of([{"flag": True}, {"flag": False}])
    assert hits(v, [rule(sel(selection={"flag": True}))]) == [(0, "r1")]


def test_two_rules_two_alerts_and_empty_set(logs_of):
    v = logs_of([{"log_type": "windows_event", "event_id": 4625}])
    r1 = rule(sel(selection={"event_id": 4625}), rid="a")
    r2 = rule(sel(selection={"log_type": "windows_event"}), rid="b")
    assert hits(v, [r1, r2]) == [(0, "a"), (0, "b")]
    assert evaluate(v, []).count() == 0
    assert set(evaluate(v, []).columns) >= {"alert_id", "rule_id", "severity", "host", "raw_log"}


@pytest.mark.parametrize("cond", ["missing", "(a or b)", "a b", "a and", "( a", "a )", "", "and a"])
def test_bad_conditions_rejected_at_compile(logs_of, cond):
    v = logs_of([{"a": 1}])
    with pytest.raises(RuleError):
        plain_alerts(v, [rule(sel(cond, a={"a": 1}, b={"b": 1}))])


def test_rule_validation():
    with pytest.raises(RuleError):
        build_rule({"id": "x", "title": "t", "detection": {}})
    with pytest.raises(RuleError):
        build_rule({"id": "x", "title": "t", "level": "low"})
    with pytest.raises(RuleError):
        build_rule(["not", "a", "dict"])
    assert build_rule({"id": "x", "title": "t", "level": "low", "detection": {"condition": "s", "s": {}}}).id == "x"


def test_alert_projection_fields(logs_of):
    v = logs_of([{"host": "h1", "log_type": "cloudtrail", "action": "DeleteBucketPolicy"}, {"action": "CreateUser"}])
    r = rule(sel(selection={"action|startswith": "DeleteBucket"}), rid="aws-s3-delete-001", level="high")
    rows = plain_alerts(v, [r]).collect()
    assert len(rows) == 1
    a = rows[0]
    assert (a.rule_id, a.severity, a.host, a.rule_title) == ("aws-s3-delete-001", "high", "h1", "title aws-s3-delete-001")
    assert len(a.alert_id) == 36 and a.alert_id[14] == "5"


def test_host_defaults_to_empty(logs_of):
    v = logs_of([{"x": 1}])
    a = plain_alerts(v, [rule(sel(selection={"x": 1}))]).first()
    assert a.host == ""


def test_reference_pack_loads_and_routes():
    import os
    from ruleweave.plans.rules import load_rules, split_rules
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "rules", "reference_pack")
    rules = load_rules(root)
    assert len(rules) == 8
    assert [r.source for r in rules] == sorted(r.source for r in rules)
    plain, bursts = split_rules(rules)
    assert [b.id for b in bursts] == ["win-brute-force-001"]


def test_reference_pack_on_sample_logs(logs_of):
    import os
    from ruleweave.plans.rules import load_rules
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "rules", "reference_pack")
    rules = [r for r in load_rules(root) if not r.is_burst]
    v = logs_of([
        {"host": "w1", "log_type": "windows_event", "event_id": 4625},
        {"host": "w1", "log_type": "windows_event", "event_id": 4624},
        {"host": "w1", "log_type": "windows_event", "event_id": 4648},
        {"host": "w1", "log_type": "windows_event", "event_id": 4672},
        {"host": "w1", "log_type": "windows_event", "event_id": 4688, "process_name": "powershell.exe"},
        {"host": "w1", "log_type": "windows_event", "event_id": 4688, "process_name": "notepad.exe"},
        {"host": "a1", "log_type": "cloudtrail", "action": "DeleteBucketPolicy"},
        {"host": "a1", "log_type": "cloudtrail", "action": "CreateUser"},
        {"host": "a1", "log_type": "linux_syslog", "action": "CreateUser"},
    ])
    got = hits(v, rules)
    assert got == [(0, "win-failed-login-001"), (1, "win-successful-login-001"), (2, "win-explicit-creds-001"),
                   (3, "win-privilege-use-001"), (4, "win-suspicious-process-001"), (6, "aws-s3-delete-001"),
                   (7, "aws-iam-create-user-001")]


def test_json_decode_edge_cases(spark):
    from ruleweave.sources.logs import decode_json_logs
    texts = ['{"a": 1, "a": 2}', '{"a": 1} trailing', "[1, 2]", '"text"', "not json", " {\"b\": {\"x\": [1, 2]}} "]
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, value string")
    good, bad = decode_json_logs(df)
    got = {r.seq: dict(r._rw_fields) for r in good.collect()}
    assert got == {0: {"a": "2"}, 5: {"b": '{"x":[1,2]}'}}
    assert sorted(r.seq for r in bad.collect()) == [1, 2, 3, 4]


def test_repeated_key_log_gets_an_id(logs_of):
    v = logs_of(['{"a": "x", "a": "y", "host": "h"}'])
    rows = plain_alerts(v, [rule(sel(selection={"a": "y"}))]).collect()
    assert len(rows) == 1 and rows[0].alert_id is not None


def test_content_ids_are_deterministic(logs_of):
    base = {"host": "h1", "log_type": "windows_event", "event_id": 4625}
    v = logs_of([base, dict(base), dict(base, host="h2")])
    r = rule(sel(selection={"event_id": 4625}))
    ids = {a.seq: a.alert_id for a in plain_alerts(v, [r]).collect()}
    assert ids[0] == ids[1] != ids[2]
    r2 = rule(sel(selection={"event_id": 4625}), rid="other")
    assert plain_alerts(v, [r2]).where("seq = 0").first().alert_id != ids[0]


def test_hundreds_of_rules_in_one_pass(logs_of):
    v = logs_of([{"k": str(i % 50), "t": "x" if i % 2 else "y"} for i in range(60)])
    rules = [rule(sel("a and not b", a={"k": str(i % 50)}, b={"t": "x"}), rid=f"g{i}") for i in range(300)]
    got = plain_alerts(v, rules).groupBy().count().first()[0]
    want = sum(1 for i in range(300) for j in range(60) if j % 50 == i % 50 and j % 2 == 0)
    assert got == want


def test_random_conditions_against_python(logs_of):
    """Random and/or/not/parenthesis trees over four groups vs. Python evaluation of the same tree."""
    import itertools
    import random
    rnd = random.Random(23)
    groups = {"g1": {"a": "1"}, "g2": {"b|startswith": "x"}, "g3": {"c": ["p", "q"]}, "g4": {"a": "1", "d|endswith": "z"}}

    def tree(depth):
        if depth == 0 or rnd.random() < 0.3:
            return rnd.choice(list(groups))
        op = rnd.choice(["and", "or", "not", "paren"])
        if op == "not":
            return ("not", tree(depth - 1))
        if op == "paren":
            return ("paren", tree(depth - 1))
        return (op, tree(depth - 1), tree(depth - 1))

    def tokens(t):
        if isinstance(t, str):
            return [t]
        if t[0] == "not":
            return ["not"] + tokens(t[1])
        if t[0] == "paren":
            return ["("] + tokens(t[1]) + [")"]
        return tokens(t[1]) + [t[0]] + tokens(t[2])

    def group_true(log, g):
        for key, want in groups[g].items():
            name, mod = (key.split("|") + [None])[:2]
            if name not in log:
                return False
            vals = want if isinstance(want, list) else [want]
            v = str(log[name])
            ok = any(v == w if mod is None else v.startswith(w) if mod == "startswith" else v.endswith(w) for w in vals)
            if not ok:
                return False
        return True

    def py_eval(tok, log):
        # Python's own precedence (not > and > or) on the same token list
        expr = " ".join(f"G['{t}']" if t in groups else t for t in tok)
        return eval(expr, {"G": {g: group_true(log, g) for g in groups}})

    conds = [" ".join(tokens(tree(4))) for _ in range(150)]
    values = {"a": ["1", "2", None], "b": ["xa", "y", None], "c": ["p", "q", "r", None], "d": ["z", "az", None]}
    logs = []
    for combo in itertools.product(*values.values()):
        logs.append({k: v for k, v in zip(values, combo) if v is not None})
    logs = logs[::2][:64]
    v = logs_of(logs)
    rules = [rule(dict(groups, condition=c), rid=f"c{i}") for i, c in enumerate(conds)]
    got = {(r.seq, r.rule_id) for r in plain_alerts(v, rules).select("seq", "rule_id").collect()}
    want = {(j, f"c{i}") for i, c in enumerate(conds) for j, log in enumerate(logs) if py_eval(c.split(), log)}
    assert got == want


def test_rule_set_prefilter_reaches_the_scan(spark, tmp_path):
    """A mixed rule set (not, parentheses, unknown modifier) still lets Parquet skip data:
    the OR of each rule's pushable necessary terms is pushed; results stay exact."""
    import contextlib
    import io
    from ruleweave.sources.logs import table_view
    rows = [(i, f"h{i % 3}", ["windows_event", "cloudtrail", "syslog"][i % 3], ["4625", "4624", "x"][i % 2],
             ["DeleteBucket", "GetObject"][i % 2]) for i in range(30)]
    spark.createDataFrame(rows, "seq long, host string, log_type string, event_id string, action string") \
        .write.parquet(str(tmp_path / "logs"))
    df = spark.read.parquet(str(tmp_path / "logs"))
    view = table_view(df, time_col="seq", order_cols=["seq"], keep=["seq"])
    rules = [
        rule(sel("a and not b", a={"log_type": "windows_event"}, b={"event_id": "4624"}), rid="r1"),
        rule(sel("( a or b ) and c", a={"action|startswith": "Delete"}, b={"action": "Put"},
                 c={"log_type": "cloudtrail"}), rid="r2"),
        rule(sel("w or s", w={"log_type|re": ".*"}, s={"log_type": "syslog"}), rid="r3"),
    ]
    alerts = plain_alerts(view, rules)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        alerts.explain("formatted")
    pushed = [l for l in buf.getvalue().splitlines() if l.startswith("PushedFilters:")]
    assert pushed and "Or(" in pushed[0] and "EqualTo(log_type,syslog)" in pushed[0]
    got = sorted((r.seq, r.rule_id) for r in alerts.collect())
    want = sorted([(i, "r1") for i in range(30) if i % 3 == 0 and i % 2 == 0]
                  + [(i, "r2") for i in range(30) if i % 3 == 1 and i % 2 == 0]
                  + [(i, "r3") for i in range(30) if i % 3 == 2])
    assert got == want
