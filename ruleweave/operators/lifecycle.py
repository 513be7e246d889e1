"""Rule lifecycle as a changelog (L1-L8): add, update and delete envelopes over time.

An envelope is ``{op, rule_id?, rule?}`` with a sequence number ``seq`` and, optionally,
the event time ``at_us`` from which it applies. Folding the changelog gives *entries*:
one per ``add`` and one per ``update``, each with a number of copies and a validity
interval ``[from, to)``. All of it is window functions over the changelog, partitioned
by rule id; no row-by-row replay.

* ``add`` appends the payload (its own id, duplicates allowed; the envelope id is not checked);
* ``update`` replaces every entry of the id (all copies become the new payload), or inserts
  one if there is none; the envelope id must equal the payload id;
* ``delete`` removes every entry of the id; unknown ids are a no-op; it also starts a new
  *epoch* of the id, so burst windows restart (L7).

An entry ends at the next ``update`` or ``delete`` of its id. Copies of an update =
adds since the epoch began before it, plus one if the epoch began with an update.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.errors import RuleError
from ruleweave.functions.fields import any_of, case_of, field_value_text, quote
from ruleweave.functions.ids import bucket_alert_id, time_bucket
from ruleweave.functions.jsontext import strict_object
from ruleweave.functions.timeutil import MICROS, floor_div
from ruleweave.operators.burst import DEFAULT_CHUNK_FACTOR, counting_time, windowed_counts
from ruleweave.operators.evaluate import alert_projection, match_rules, matched_at
from ruleweave.plans.compile import group_predicate, usable_rules
from ruleweave.plans.rules import Rule, build_rule, burst_spec
from ruleweave.sources.logs import LogView

#: Before all times, and the slots (a day, in microseconds) of the rule counts.
_FIRST, _DAY = -(1 << 62), 86_400 * MICROS
CHANGELOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("at_us", T.LongType(), True),
    T.StructField("op", T.StringType(), True),
    T.StructField("rule_id", T.StringType(), True),
    T.StructField("rule", T.StringType(), True),   # JSON text of the rule object
])
REQUIRED_KEYS = ("id", "title", "level", "detection")


def decode_envelopes(raw: DataFrame, value_col: str = "value", seq_col: str = "seq",
                     at_col: str | None = None) -> DataFrame:
    """JSON envelopes to changelog rows; text that is not an object gets an error."""
    env = F.from_json(F.col(quote(value_col)), "struct<op:string,rule_id:string,rule:string>")
    is_obj = strict_object(F.col(quote(value_col))).isNotNull()
    return raw.select(
        F.col(quote(seq_col)).cast("long").alias("seq"),
        (F.col(quote(at_col)).cast("long") if at_col else F.lit(None).cast("long")).alias("at_us"),
        F.when(is_obj, env.op).alias("op"),
        F.when(is_obj, env.rule_id).alias("rule_id"),
        F.when(is_obj, env.rule).alias("rule"),
        F.when(~F.coalesce(is_obj, F.lit(False)), F.lit("not a JSON object")).alias("_rw_pre_error"),
    )


def with_errors(changelog: DataFrame) -> DataFrame:
    """L4: add an ``error`` column (NULL when the envelope is valid)."""
    rule = F.col("rule")
    keys = F.json_object_keys(rule)
    payload_id = F.get_json_object(rule, "$.id")
    missing = None
    for k in REQUIRED_KEYS:
        m = F.when(~F.array_contains(keys, k), F.lit(f"rule has no '{k}'"))
        missing = m if missing is None else F.coalesce(missing, m)
    op = F.col("op")
    err = (F.when(op.isNull(), F.lit("no 'op' given"))
           .when(~op.isin("add", "update", "delete"), F.concat(F.lit("unknown op: "), op))
           .when((op != "add") & F.col("rule_id").isNull(), F.lit("no 'rule_id' given"))
           .when((op != "delete") & rule.isNull(), F.concat(F.lit("no 'rule' given with "), op))
           .when((op != "delete") & keys.isNull(), F.lit("'rule' is not an object"))
           .when((op == "update") & ~F.coalesce(payload_id == F.col("rule_id"), F.lit(False)),
                 F.lit("'rule_id' differs from the rule's own id"))
           .when(op != "delete", missing))
    pre = F.col("_rw_pre_error") if "_rw_pre_error" in changelog.columns else F.lit(None).cast("string")
    return changelog.withColumn("error", F.coalesce(pre, err)).drop("_rw_pre_error")


def entries(changelog: DataFrame) -> DataFrame:
    """L1-L3 + L7: fold valid envelopes to rule entries.

    Columns: ``rule_id, epoch, seq, copies, from_us, to_us, to_seq, rule`` (``to_*`` NULL
    while the entry is still active).
    """
    valid = with_errors(changelog).where(F.col("error").isNull())
    rid = F.when(F.col("op") == "add", F.get_json_object("rule", "$.id")).otherwise(F.col("rule_id"))
    c = valid.select("seq", "at_us", "op", rid.alias("rid"), "rule")
    by_id = Window.partitionBy("rid").orderBy("seq")
    c = c.withColumn("epoch", F.sum((F.col("op") == "delete").cast("long")).over(
        by_id.rowsBetween(Window.unboundedPreceding, 0)))
    ender = F.when(F.col("op").isin("update", "delete"), F.struct("seq", "at_us"))
    # the next one: a frame of all that follow would be read anew for each change of an id
    c = c.withColumn("_rw_end", ender).withColumn("_rw_end", F.expr(
        "lead(_rw_end) IGNORE NULLS OVER (PARTITION BY rid ORDER BY seq)"))
    in_epoch = Window.partitionBy("rid", "epoch").orderBy("seq")
    c = c.withColumn("_rw_first", F.first(F.when(F.col("op") != "delete", F.col("op")), ignorenulls=True).over(
        in_epoch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    c = c.withColumn("_rw_adds_before", F.coalesce(F.sum((F.col("op") == "add").cast("long")).over(
        in_epoch.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    copies = (F.when(F.col("op") == "add", F.lit(1))
              .otherwise(F.col("_rw_adds_before") + F.when(F.col("_rw_first") == "update", 1).otherwise(0)))
    return c.where(F.col("op") != "delete").select(
        F.col("rid").alias("rule_id"), "epoch", "seq", copies.cast("long").alias("copies"),
        F.col("at_us").alias("from_us"), F.col("_rw_end.at_us").alias("to_us"),
        F.col("_rw_end.seq").alias("to_seq"), "rule")


def active_rules(changelog: DataFrame) -> DataFrame:
    """The rule set after the whole changelog, one row per entry with its copies."""
    return entries(changelog).where(F.col("to_seq").isNull()).select(
        "rule_id", "copies", F.get_json_object("rule", "$.title").alias("rule_title"),
        F.get_json_object("rule", "$.level").alias("severity"), "rule")


def rule_count(changelog: DataFrame) -> DataFrame:
    """Number of rules in the active list (copies counted)."""
    return active_rules(changelog).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rule_count"))


def rule_count_at(changelog: DataFrame, times: DataFrame, at_col: str) -> DataFrame:
    """L8 as of given times: the distinct rows of ``times`` with ``rule_count``, the copies of the versions valid then.

    A sweep: copies are added at a version's start and taken off at its end, and a time's count is the sum
    of all changes up to it. Sums are taken per slot of a day, over the slots, and inside each slot, so
    neither the versions nor the times meet in one task. A NULL time has the versions without any bound.
    """
    t, at, n = F.col(quote(at_col)), F.col("_rw_at"), F.col("_rw_n")
    ents = entries(changelog).where("to_seq IS NULL OR to_us IS NOT NULL").select("copies", "from_us", "to_us", "to_seq")
    # an open start adds before all times, and alone counts for a NULL time
    start = F.coalesce(F.col("from_us"), F.lit(_FIRST))
    change = F.array(F.struct(start.alias("_rw_at"), F.col("copies").alias("_rw_n")),
                     F.struct(F.when(F.col("to_us").isNotNull(), F.greatest("to_us", start)).alias("_rw_at"), (-F.col("copies")).alias("_rw_n")))
    changes = (ents.select(F.inline(change)).where(at.isNotNull()).groupBy("_rw_at").agg(F.sum("_rw_n").alias("_rw_n"))
               .withColumn("_rw_slot", floor_div(at, _DAY)))
    always = ents.where("from_us IS NULL AND to_seq IS NULL").agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rule_count"))
    instants = times.select(t.cast("long").alias("_rw_at")).where(at.isNotNull()).distinct().withColumn(
        "_rw_slot", floor_div(at, _DAY))
    union = changes.unionByName(instants.withColumn("_rw_n", F.lit(None).cast("long")))
    slots = union.groupBy("_rw_slot").agg(F.sum(n).alias("_rw_sum"))
    before = slots.select("_rw_slot", F.coalesce(F.sum("_rw_sum").over(
        Window.orderBy("_rw_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_rw_before"))
    inside = union.select("_rw_slot", at, F.coalesce(F.sum(n).over(Window.partitionBy("_rw_slot").orderBy("_rw_at")),
                                                     F.lit(0)).alias("_rw_in"), n.isNull().alias("_rw_asked"))
    counts = inside.where("_rw_asked").join(before, "_rw_slot").select(
        "_rw_at", (F.col("_rw_before") + F.col("_rw_in")).alias("rule_count"))
    counts = counts.unionByName(always.select(F.lit(None).cast("long").alias("_rw_at"), "rule_count"))
    return times.distinct().join(counts, t.cast("long").eqNullSafe(at)).select(
        *[F.col(quote(c)) for c in times.columns], "rule_count")


def directory_changelog(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Directory rules are ``add``s before everything else (negative sequence numbers)."""
    rows = [(i - len(rules), None, "add", r.id, r.to_json()) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, CHANGELOG_SCHEMA)


def collect_entries(changelog: DataFrame) -> list[dict]:
    """The folded entries at the driver, to compile them: control-plane data, one row per rule change."""
    return [r.asDict() for r in entries(changelog).orderBy("seq").collect()]


def rule_errors(changelog: DataFrame, view: LogView | None = None) -> DataFrame:
    """S4 + L4: (seq, rule_id, error) of every envelope that is skipped and every rule that cannot run."""
    skipped = with_errors(changelog).where(F.col("error").isNotNull()).select("seq", "rule_id", "error")
    broken = []
    for e in collect_entries(changelog):
        try:
            rule = build_rule(json.loads(e["rule"]), source=f"changelog seq {e['seq']}")
            if rule.is_burst:
                burst_spec(rule)
            if view is not None and not usable_rules([rule], view.fields)[0]:
                raise RuleError("the rule does not compile")
        except RuleError as exc:
            broken.append((e["seq"], e["rule_id"], str(exc)))
    return skipped.unionByName(changelog.sparkSession.createDataFrame(broken, "seq long, rule_id string, error string"))


def asof_alerts(view: LogView, changelog: DataFrame, chunk_factor: int = DEFAULT_CHUNK_FACTOR) -> DataFrame:
    """Every log is evaluated against the rule versions valid at the time it counts at.

    That is its event time, else its arrival time, else 0 (A8), as for burst windows. A version
    valid in ``[from, to)`` is the compiled rule ANDed with that interval, so the whole
    changelog runs in one scan of the logs without a join. Burst windows are
    keyed by (rule id, epoch, key): an update keeps the window, a delete restarts it.
    """
    return alerts_of_entries(view, collect_entries(changelog), chunk_factor)


def alerts_of_entries(view: LogView, ents: list[dict], chunk_factor: int = DEFAULT_CHUNK_FACTOR) -> DataFrame:
    """``asof_alerts`` of folded entries, in order."""
    plain, bursts = [], []
    for e in ents:
        try:
            rule = build_rule(json.loads(e["rule"]), source=f"changelog seq {e['seq']}")
        except RuleError:
            continue                      # listed by rule_errors; the other rules still run
        if not usable_rules([rule], view.fields)[0]:
            continue
        (bursts if rule.is_burst else plain).append((rule, e))
    t = counting_time(view)

    def gate(e):
        g = F.lit(True)
        if e["from_us"] is not None:
            g = g & (t >= F.lit(e["from_us"]))
        if e["to_us"] is not None:
            g = g & (t < F.lit(e["to_us"]))
        elif e["to_seq"] is not None:   # ended by an op without a time: ended before any log
            g = F.lit(False)
        return g

    cols = ["alert_id", "rule_id", "rule_title", "severity", "host", "raw_log", *view.keep]
    out = alert_projection(view, match_rules(view, [r for r, _ in plain], gates=[gate(e) for _, e in plain],
                                             copies=[int(e["copies"]) for _, e in plain])).select(*cols)
    if bursts:
        out = out.unionByName(_asof_bursts(view, bursts, gate, chunk_factor).select(*cols))
    return out


def _asof_bursts(view: LogView, bursts, gate, chunk_factor: int) -> DataFrame:
    """Burst versions grouped by (rule id, epoch): one window per group, one scan and one
    shuffle per distinct timeframe. Inside a group, the version live at a log's time
    decides whether it is counted and sets threshold, title, level and copies."""
    groups: dict[tuple, list] = {}
    for rule, e in bursts:
        groups.setdefault((rule.id, e["epoch"]), []).append((rule, burst_spec(rule), e))
    # An update may change the timeframe or the key field: every pair a group has used counts all of
    # the group's logs, and a log fires by the pair of the version live at its time.
    by_span: dict[int, list] = {}
    for (rid, epoch), versions in groups.items():
        for span, by in sorted({(s.window_seconds, s.by_field) for _, s, _ in versions}):
            by_span.setdefault(span, []).append((rid, epoch, by, versions))
    order_names = [f"_rw_o{i}" for i in range(len(view.order))]
    parts = []
    for window_s, members in sorted(by_span.items()):
        k = F.col("_rw_k")
        live = []      # per group: [(predicate, rule, spec, entry)] of its versions
        for rid, epoch, by_field, versions in members:
            live.append([(group_predicate(view.fields, r.groups[s.selection], r.id, s.selection) & gate(e), r, s, e)
                         for r, s, e in versions])

        def pick(value):
            # per group: the first live version that matched gives the value
            per_group = []
            for vs in live:
                expr = None
                for m, r, s, e in vs:
                    expr = F.when(m, value(r, s, e)) if expr is None else expr.when(m, value(r, s, e))
                per_group.append(expr)
            return case_of(k, per_group)

        fires = []     # per group: does the live version use this pair?
        for (_, _, by_field, _), vs in zip(members, live):
            expr = None
            for m, r, s, e in vs:
                own = F.lit(s.window_seconds == window_s and s.by_field == by_field)
                expr = F.when(m, own) if expr is None else expr.when(m, own)
            fires.append(expr)
        matched = [any_of([m for m, *_ in vs]) for vs in live]
        hits = F.filter(F.array(*[F.when(m, F.lit(g)) for g, m in enumerate(matched)]), lambda x: x.isNotNull())
        selected = view.df.where(any_of(matched)).select("*", F.explode(hits).alias("_rw_k"))
        rows = selected.select(
            "_rw_k", case_of(k, [field_value_text(view.fields, b) for _, _, b, _ in members]).alias("_rw_key"),
            counting_time(view).alias("_rw_t"), *[o.alias(n) for o, n in zip(view.order, order_names)],
            view.host.alias("host"), view.raw_json.alias("raw_log"), view.id_time_us.alias("_rw_idt"),
            pick(lambda r, s, e: F.lit(s.threshold)).alias("_rw_threshold"),
            case_of(k, fires).alias("_rw_fires"),
            pick(lambda r, s, e: F.lit(r.title)).alias("rule_title"),
            pick(lambda r, s, e: F.lit(r.level)).alias("severity"),
            pick(lambda r, s, e: F.lit(int(e["copies"]))).alias("_rw_copies"),
            *[F.col(quote(c)) for c in view.keep],
        )
        counted = windowed_counts(rows, key_cols=["_rw_k", "_rw_key"], time_col="_rw_t", order_cols=order_names,
                                  window_us=window_s * MICROS, chunk_factor=chunk_factor)
        fired = counted.where(F.col("_rw_fires") & (F.col("window_count") > F.col("_rw_threshold")))
        fired = fired.withColumn("_rw_copy", F.explode(F.sequence(F.lit(1), F.col("_rw_copies").cast("int"))))
        rid = case_of(k, [F.lit(m[0]) for m in members])
        other = F.when(case_of(k, [F.lit(m[2] != "host") for m in members]), F.col("_rw_key"))
        parts.append(fired.select(
            bucket_alert_id(rid, F.col("host"), time_bucket(F.col("_rw_idt"), window_s), other).alias("alert_id"),
            rid.alias("rule_id"), "rule_title", "severity", matched_at().alias("matched_at"),
            "host", "raw_log", *[F.col(quote(c)) for c in view.keep],
            case_of(k, [F.lit(m[1]).cast("long") for m in members]).alias("epoch")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
