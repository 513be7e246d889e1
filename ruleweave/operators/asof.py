"""L6 as data: every log meets the rule versions valid at the time it counts at, by joins.

``lifecycle.asof_alerts`` compiles the versions of a changelog into the scan. Here they are a table
that never reaches the driver: the fold's entries are parsed where they are, their terms are joined
with the logs as in ``ruletable`` (by the term of each group that the fewest versions share) and gated by the versions' intervals ``[from, to)``. For that, time is cut
into equal slots; a log lies in one, a version is copied into those it touches, and both join by slot
besides the term's key. So a term that thousands of versions of a rule share meets a log only with the
versions around its time. The number of slots is the largest tried at which copies stay below four per version.

Only the bounds of time, the distinct time spans and key fields of burst rules and the kinds of term per field
reach the driver. Versions that cannot run are returned with their reason. Those whose condition
has more than ``MAX_CLAUSES`` clauses, which are not data, go through ``lifecycle.alerts_of_entries``.
"""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ruleweave.errors import RuleError
from ruleweave.functions.fields import field_value_text, quote
from ruleweave.functions.ids import bucket_alert_id, time_bucket
from ruleweave.functions.timeutil import MICROS, floor_div
from ruleweave.operators.burst import DEFAULT_CHUNK_FACTOR, counting_time, windowed_counts
from ruleweave.operators.evaluate import alert_projection, matched_at
from ruleweave.operators.lifecycle import alerts_of_entries, entries
from ruleweave.operators.ruletable import CONDITIONS_SCHEMA, MAX_CLAUSES, RULE_LIST_SCHEMA, condition_rows, staged_anchors, table_matches
from ruleweave.plans.rules import Rule, build_rule, burst_spec
from ruleweave.session import scratch_path
from ruleweave.sources.logs import LogView

#: Numbers of slots that are tried, and the copies per version that they may lead to.
SLOTS, COPIES = tuple(1 << i for i in range(0, 17, 2)), 4
_ENTRY = ["seq", "epoch", "copies", "from_us", "to_us", "to_seq", "rule"]
_PARSED = T.StructType([
    T.StructField("entry_rule_id", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("epoch", T.LongType()),
    T.StructField("copies", T.LongType()), T.StructField("from_us", T.LongType()), T.StructField("to_us", T.LongType()),
    T.StructField("to_seq", T.LongType()), T.StructField("rule", T.StringType()), *RULE_LIST_SCHEMA.fields[1:4],
    T.StructField("span", T.LongType()), T.StructField("by", T.StringType()), T.StructField("threshold", T.LongType()),
    T.StructField("conditions", T.ArrayType(CONDITIONS_SCHEMA)), RULE_LIST_SCHEMA["clauses"],
    T.StructField("error", T.StringType()), T.StructField("compile", T.BooleanType())])


def _parsed(seq: int, text: str) -> dict:
    """One version's rule as columns, or why it has none."""
    try:
        rule = build_rule(json.loads(text), source=f"changelog seq {seq}")
        out = {"rule_id": rule.id, "rule_title": rule.title, "severity": rule.level}
        if rule.is_burst:
            spec = burst_spec(rule)
            out |= {"span": spec.window_seconds, "by": spec.by_field, "threshold": spec.threshold}
            rule = Rule(rule.id, rule.title, rule.level, {spec.selection: rule.groups[spec.selection], "condition": spec.selection})
        got = condition_rows(seq, rule)
        if got is None:
            return out | {"compile": True}
        return out | {"conditions": [dict(zip(CONDITIONS_SCHEMA.fieldNames(), r)) for r in got[0]], "clauses": got[1]}
    except (RuleError, ValueError, TypeError, AttributeError) as exc:
        return {"error": str(exc)}


def versions(changelog: DataFrame) -> DataFrame:
    """The entries of a changelog with their rules parsed, written below the checkpoint folder and read back.

    Versions that no log can meet (their end is not after their start, or has no time) are left out.
    """
    def parse(batches):
        names = _PARSED.fieldNames()
        for pdf in batches:
            rows = []
            for entry in pdf.to_dict("records"):
                for c in ("from_us", "to_us", "to_seq"):
                    entry[c] = None if entry[c] is None else int(entry[c])
                rows.append({**dict.fromkeys(names), **entry, "compile": False, **_parsed(int(entry["seq"]), entry["rule"])})
            out = pd.DataFrame(rows, columns=names)
            for c in ("seq", "epoch", "copies", "from_us", "to_us", "to_seq", "span", "threshold"):
                out[c] = out[c].astype("Int64")
            yield out

    seen = F.col("to_seq").isNull() | (F.coalesce(F.col("from_us") < F.col("to_us"), F.col("to_us").isNotNull()))
    # whole numbers that may be NULL travel as text, as pandas would make them floats
    exact = [F.col(c).cast("string").alias(c) if c in ("from_us", "to_us", "to_seq") else F.col(c) for c in _ENTRY]
    found = entries(changelog).where(seen).select(F.col("rule_id").alias("entry_rule_id"), *exact)
    spark = changelog.sparkSession
    path = scratch_path(spark, f"ruleweave-versions-{uuid.uuid4().hex}")
    found.mapInPandas(parse, _PARSED).write.parquet(path)
    return spark.read.schema(_PARSED).parquet(path)


def _slot(t: Column, low: int, width: int, n: int) -> Column:
    """The slot of a time: 0 up to the first, n - 1 from the last boundary on. It never falls with time."""
    return F.when(t.isNotNull(), F.least(F.greatest(floor_div(t - F.lit(low), width), F.lit(0)), F.lit(n - 1))).cast("int")


def time_slots(found: DataFrame) -> tuple[int, int, int]:
    """(low, width, n) of the slots for these versions: the most, of those tried, that keep copies within bounds."""
    ends = found.agg(F.least(F.min("from_us"), F.min("to_us")).alias("low"),
                     F.greatest(F.max("from_us"), F.max("to_us")).alias("high"), F.count(F.lit(1)).alias("n")).first()
    if ends["low"] is None:
        return 0, 1, 1
    tried = [(ends["low"], (ends["high"] - ends["low"]) // n + 1, n) for n in SLOTS]
    spans = [F.sum(last - first + 1) for first, last in (_touched(s) for s in tried)]
    copies = found.agg(*[c.alias(f"c{i}") for i, c in enumerate(spans)]).first()
    return [s for s, c in zip(tried, copies) if c <= COPIES * ends["n"]][-1]


def _touched(slots: tuple[int, int, int]) -> tuple[Column, Column]:
    """The first and last slot of a version."""
    return (F.coalesce(_slot(F.col("from_us"), *slots), F.lit(0)),
            F.coalesce(_slot(F.col("to_us") - 1, *slots), F.lit(slots[2] - 1)))


def asof_table_alerts(view: LogView, changelog: DataFrame, key_cols: list[str],
                      chunk_factor: int = DEFAULT_CHUNK_FACTOR) -> tuple[DataFrame, DataFrame]:
    """The alerts of ``lifecycle.asof_alerts`` with the changelog as data, and the versions left out as
    ``(seq, rule_id, error)``.

    ``key_cols`` must identify a log, ``seq`` a change. Plain versions and the selections of burst versions
    are matched by one join; burst windows are keyed by (rule id, epoch, key field, key) as there, with one
    window plan per distinct time span.
    """
    parsed = versions(changelog)
    left_out = parsed.where(F.col("error").isNotNull()).select("seq", F.col("entry_rule_id").alias("rule_id"), "error")
    usable = parsed.where(F.col("error").isNull() & ~F.col("compile"))
    slots = time_slots(usable)
    first, last = _touched(slots)
    conditions = usable.select(F.inline("conditions"), "from_us", "to_us", first.alias("first_slot"), last.alias("last_slot"))
    listed = usable.select(F.col("seq").alias("rule_ord"), "rule_id", "rule_title", "severity", "clauses", "epoch", "copies",
                           "span", "by", "threshold")
    t = counting_time(view)
    matches = table_matches(view, staged_anchors(conditions), listed, key_cols, live=(t, _slot(t, *slots)))
    keys = [F.col(quote(k)) for k in key_cols]
    tagged = matches.select(*keys, F.struct("rule_ord", "rule_id", "rule_title", "severity", "epoch", "copies", "span", "by",
                                            "threshold").alias("_rw_rule"))
    cols = ["alert_id", "rule_id", "rule_title", "severity", "host", "raw_log", *[quote(c) for c in view.keep]]
    plain = tagged.where(F.col("_rw_rule.span").isNull()).withColumn(
        "_rw_copy", F.explode(F.sequence(F.lit(1), F.col("_rw_rule.copies").cast("int")))).drop("_rw_copy")
    out = alert_projection(view, view.df.join(plain, key_cols)).select(*cols)
    pairs = usable.where(F.col("span").isNotNull()).select("rule_id", "epoch", "span", "by").distinct()
    uses = pairs.select("span", "by").distinct().collect()
    if uses:
        # of versions live together, the first stands
        one = (tagged.where(F.col("_rw_rule.span").isNotNull())
               .groupBy(*keys, F.col("_rw_rule.rule_id").alias("_rw_id"), F.col("_rw_rule.epoch").alias("_rw_epoch"))
               .agg(F.min_by("_rw_rule", F.col("_rw_rule.rule_ord")).alias("_rw_rule")))
        counts = pairs.select(F.col("rule_id").alias("_rw_id"), F.col("epoch").alias("_rw_epoch"),
                              F.col("span").alias("_rw_span"), F.col("by").alias("_rw_by"))
        logs = view.df.join(one.join(counts, ["_rw_id", "_rw_epoch"]), key_cols)
        for span in sorted({u["span"] for u in uses}):
            fields = sorted(u["by"] for u in uses if u["span"] == span)
            out = out.unionByName(_bursts(view, logs, span, fields, chunk_factor).select(*cols))
    compiled = [r.asDict() for r in parsed.where("compile").select(
        *_ENTRY, F.col("entry_rule_id").alias("rule_id")).orderBy("seq").collect()]
    if compiled:
        out = out.unionByName(alerts_of_entries(view, compiled, chunk_factor).select(*cols))
    return out, left_out


def _bursts(view: LogView, logs: DataFrame, span: int, fields: list[str], chunk_factor: int) -> DataFrame:
    """The burst alerts of one time span: all logs of a rule and epoch that ever used it are counted, and a
    log fires where the version live at its time uses this span and key field."""
    order = [f"_rw_o{i}" for i in range(len(view.order))]
    rule, by = F.col("_rw_rule"), F.col("_rw_by")
    key = F.coalesce(*[F.when(by == f, field_value_text(view.fields, f)) for f in fields])
    rows = logs.where(F.col("_rw_span") == span).select(
        "_rw_id", "_rw_epoch", "_rw_by", key.alias("_rw_key"), "_rw_rule", counting_time(view).alias("_rw_t"),
        *[o.alias(n) for o, n in zip(view.order, order)], view.host.alias("host"), view.raw_json.alias("raw_log"),
        view.id_time_us.alias("_rw_idt"), *[F.col(quote(c)) for c in view.keep])
    counted = windowed_counts(rows, key_cols=["_rw_id", "_rw_epoch", "_rw_by", "_rw_key"], time_col="_rw_t",
                              order_cols=order, window_us=span * MICROS, chunk_factor=chunk_factor)
    fired = (counted.where((rule["span"] == span) & (rule["by"] == by) & (F.col("window_count") > rule["threshold"]))
             .withColumn("_rw_copy", F.explode(F.sequence(F.lit(1), rule["copies"].cast("int")))))
    other = F.when(by != "host", F.col("_rw_key"))
    return fired.select(
        bucket_alert_id(F.col("_rw_id"), F.col("host"), time_bucket(F.col("_rw_idt"), span), other).alias("alert_id"),
        F.col("_rw_id").alias("rule_id"), rule["rule_title"].alias("rule_title"), rule["severity"].alias("severity"),
        matched_at().alias("matched_at"), "host", "raw_log", *[F.col(quote(c)) for c in view.keep])
