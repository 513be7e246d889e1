"""Rule-set evaluation (E1, E3-E5) and the alert projection.

All plain rules run in one pass over the logs: each rule is a boolean column, a
disjunction of them is the pre-filter (so columnar sources can skip data), and the
matching rules of a row are exploded into one alert row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.functions.fields import any_of, quote
from ruleweave.functions.ids import uuid5_sql
from ruleweave.plans.compile import scan_prefilter, with_rule_flags
from ruleweave.plans.rules import Rule, split_rules
from ruleweave.sources.logs import LogView

# The fields of an alert document; every other layout is derived from this list.
ALERT_COLUMNS = ["alert_id", "rule_id", "rule_title", "severity", "matched_at", "host", "raw_log"]
#: Rules compiled into one scan of the logs.
RULES_PER_SCAN = 250
MATCH_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def matched_at() -> Column:
    """The time of matching, UTC; not part of any comparison."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), MATCH_ISO)


def rule_struct(ordinal: int, rule: Rule) -> Column:
    return F.struct(F.lit(ordinal).alias("rule_ord"), F.lit(rule.id).alias("rule_id"),
                    F.lit(rule.title).alias("rule_title"), F.lit(rule.level).alias("severity"))


def match_rules(view: LogView, rules: list[Rule], *, gates: list[Column] | None = None,
                copies: list[int] | None = None, first: int = 0) -> DataFrame:
    """One row per (log, matching rule), in one scan of the logs per ``RULES_PER_SCAN`` rules.

    ``gates`` (optional, one per rule) are extra predicates ANDed to each rule, e.g. the
    validity interval of a rule version; ``copies`` repeats a rule's match (a rule present
    several times in the active list gives several alerts).
    """
    if not rules:
        return view.df.where(F.lit(False)).select("*", F.lit(None).cast(
            "struct<rule_ord:int,rule_id:string,rule_title:string,severity:string>").alias("_rw_rule"))
    if len(rules) > RULES_PER_SCAN:     # generated code has a size at which it stops being compiled
        out = None
        for at in range(0, len(rules), RULES_PER_SCAN):
            to = at + RULES_PER_SCAN
            part = match_rules(view, rules[at:to], gates=gates and gates[at:to], copies=copies and copies[at:to],
                               first=first + at)
            out = part if out is None else out.unionByName(part)
        return out
    base = view.df
    pre = scan_prefilter(rules, view.fields)
    if pre is not None:         # a pushable superset of the matches: lets the scan skip data
        base = base.where(pre)
    flagged, names = with_rule_flags(base, rules, view.fields)
    if gates is not None:
        flagged = flagged.select(*[F.col(quote(c)) for c in view.df.columns],
                                 *[(F.col(n) & F.coalesce(g, F.lit(False))).alias(n) for n, g in zip(names, gates)])
    any_rule = any_of([F.col(n) for n in names])
    items = [F.when(F.col(n), rule_struct(first + i, rule)) for i, (rule, n) in enumerate(zip(rules, names))]
    if copies is not None and any(c != 1 for c in copies):
        items = [F.when(F.col(n), F.array_repeat(item, c)) for item, n, c in zip(items, names, copies)]
        hits = F.flatten(F.filter(F.array(*items), lambda x: x.isNotNull()))
    else:
        hits = F.filter(F.array(*items), lambda x: x.isNotNull())
    return (flagged.where(any_rule)
            .select(*[F.col(quote(c)) for c in view.df.columns], F.explode(hits).alias("_rw_rule")))


def alert_projection(view: LogView, matched: DataFrame, alert_id: Column | None = None,
                     extra: list[Column] | None = None) -> DataFrame:
    """The alert row; the rule is in the ``_rw_rule`` struct column.

    The canonical text is computed once and feeds both the id (J2) and, for columnar
    logs, the embedded raw log.
    """
    same = view.raw_json is view.canonical
    staged = matched.select("*", view.canonical.alias("_rw_canon"),
                            *([] if same else [view.raw_json.alias("_rw_raw")]))
    aid = F.expr(uuid5_sql("concat(`_rw_rule`.`rule_id`, ':', `_rw_canon`)")) if alert_id is None else alert_id
    return staged.select(
        aid.alias("alert_id"), F.col("_rw_rule.rule_id").alias("rule_id"),
        F.col("_rw_rule.rule_title").alias("rule_title"),
        F.col("_rw_rule.severity").alias("severity"),
        matched_at().alias("matched_at"),
        view.host.alias("host"),
        F.col("_rw_canon" if same else "_rw_raw").alias("raw_log"),
        *[F.col(quote(k)) for k in view.keep],
        *(extra or []),
    )


def plain_alerts(view: LogView, rules: list[Rule]) -> DataFrame:
    """E1 + J1: alerts of plain (non-burst) rules."""
    return alert_projection(view, match_rules(view, rules))


def evaluate(view: LogView, rules: list[Rule], **burst_options) -> DataFrame:
    """E3 + E4: route rules to the plain or the burst path and union the alerts.

    An empty rule set gives an empty frame with the alert columns (E5).
    """
    from ruleweave.operators.burst import burst_alerts

    plain, bursts = split_rules(rules)
    out = plain_alerts(view, plain)
    if bursts:
        b = burst_alerts(view, bursts, **burst_options).drop("window_count")
        out = b.unionByName(out)
    return out


def alerts_json(alerts: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One JSON document per alert; ``raw_log`` is embedded as the object it is, text unchanged."""
    head = F.to_json(F.struct(*[F.col(c) for c in ALERT_COLUMNS if c != "raw_log"]))
    raw = F.coalesce(F.col("raw_log"), F.lit("{}"))
    return alerts.select(F.col("alert_id").alias("key"), F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"raw_log":'), raw, F.lit("}")).alias("value"), *[F.col(quote(c)) for c in extra or []])
