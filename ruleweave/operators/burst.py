"""Burst detection: more than N matching logs per key within a sliding time span.

Semantics, per burst rule and key (the declared ``by`` field, D2): a matching log at time
t fires when the number of matching logs in the half-open span (t - T, t] that arrived no
later than it exceeds N. Every log above the threshold fires (A3); the alert id is shared
by all alerts of one (rule, key, time bucket), so a store keeps one of them (A11). A log
without an event time counts at its arrival time, or at time 0 where the source has none.

One plan for every size (see ``windowed_counts``): the number of logs per (rule, key, time)
is a narrow aggregate; its running sums are taken in time chunks of a multiple of T, and
joined to the logs, which are ranked among their ties only. Ties are cut into blocks of the
arrival order, so neither a busy key nor one time stamp shared by all logs meets in a task.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.functions.fields import any_of, case_of, field_value_text, quote
from ruleweave.functions.ids import bucket_alert_id, time_bucket
from ruleweave.functions.timeutil import MICROS, floor_div
from ruleweave.operators.evaluate import matched_at
from ruleweave.plans.compile import with_rule_flags
from ruleweave.plans.rules import BurstSpec, Rule, burst_spec
from ruleweave.sources.logs import LogView

DEFAULT_CHUNK_FACTOR = 4
#: Ties (rows of one key and time) are ranked in blocks of this many arrival numbers.
TIE_BLOCK = 1 << 16
# Blocks of rows without an order, and of rows that arrived before all others.
_NO_ORDER, _BEFORE_ALL = -(1 << 62), -(1 << 62) - 1


def _with_stand_ins(rows: DataFrame, key_cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Non-null stand-ins for the key columns, so that joins on them are plain equalities."""
    keys = []
    for i, k in enumerate(key_cols):
        rows = rows.withColumn(f"_rw_n{i}", F.coalesce(F.col(quote(k)).cast("string"), F.lit(""))).withColumn(
            f"_rw_z{i}", F.col(quote(k)).isNull())
        keys += [f"_rw_n{i}", f"_rw_z{i}"]
    return rows, keys


def windowed_counts(rows: DataFrame, *, key_cols: list[str], time_col: str, order_cols: list[str],
                    window_us: int, chunk_factor: int = DEFAULT_CHUNK_FACTOR,
                    earlier: DataFrame | None = None) -> DataFrame:
    """A1 + A2 for any keyed rows: adds ``window_count`` = rows of the key in (t - T, t] that
    come no later in (time, order) than the row itself.

    ``rows`` must hold the key columns (NULL is a key like any other), ``time_col`` (epoch
    micros, non-null) and the order columns. With an integer first order column, ties are cut
    into blocks of it; other orders keep the ties of one key and time together. A chunk holds
    one key's distinct times of ``chunk_factor`` x T, and as context those of the T before it.

    ``earlier`` (key columns, ``time_col``, ``_rw_n``) are numbers of rows that arrived before all of
    ``rows``: they are counted, without being read row by row or returned.
    """
    t = F.col(time_col)
    rows, keys = _with_stand_ins(rows, key_cols)
    block = F.lit(0).cast("long")
    if order_cols and rows.schema[order_cols[0]].dataType.typeName() in ("long", "integer", "short", "byte"):
        block = F.coalesce(floor_div(F.col(quote(order_cols[0])).cast("long"), TIE_BLOCK), F.lit(_NO_ORDER))
    rows = rows.withColumn("_rw_block", block)
    tie = [*keys, time_col, "_rw_block"]
    marks = rows.groupBy(*tie).agg(F.count(F.lit(1)).alias("_rw_n"))
    if earlier is not None:
        before_all = _with_stand_ins(earlier, key_cols)[0].withColumn("_rw_block", F.lit(_BEFORE_ALL))
        marks = marks.unionByName(before_all.select(*tie, "_rw_n"))
    chunk_us = window_us * max(1, chunk_factor)
    own, last = floor_div(t, chunk_us), floor_div(t + F.lit(window_us - 1), chunk_us)
    copies = marks.select(*tie, "_rw_n", own.alias("_rw_own"), F.explode(F.sequence(own, last)).alias("_rw_chunk"))
    chunk = Window.partitionBy(*keys, "_rw_chunk")
    until = chunk.orderBy(t, "_rw_block").rowsBetween(Window.unboundedPreceding, -1)
    gone = chunk.orderBy(t).rangeBetween(Window.unboundedPreceding, -window_us)
    before = copies.select(*tie, "_rw_own", "_rw_chunk", (
        F.coalesce(F.sum("_rw_n").over(until), F.lit(0)) - F.coalesce(F.sum("_rw_n").over(gone), F.lit(0)))
        .alias("_rw_before")).where("_rw_own = _rw_chunk").drop("_rw_own", "_rw_chunk")
    among_ties = Window.partitionBy(*tie).orderBy(*[F.col(quote(c)) for c in order_cols] or [t])
    ranked = rows.withColumn("_rw_rank", F.row_number().over(among_ties))
    return ranked.join(before, tie).withColumn("window_count", F.col("_rw_before") + F.col("_rw_rank")).drop(
        *keys, "_rw_block", "_rw_rank", "_rw_before")


def burst_alerts(view: LogView, rules: list[Rule], *, chunk_factor: int = DEFAULT_CHUNK_FACTOR,
                 include_count: bool = True) -> DataFrame:
    """A1-A8 + J3: alerts of burst rules, with ``window_count`` per alert row."""
    specs = [burst_spec(r) for r in rules]
    by_window: dict[int, list[int]] = defaultdict(list)
    for i, s in enumerate(specs):
        by_window[s.window_seconds].append(i)
    parts = [_burst_group(view, [rules[i] for i in idx], [specs[i] for i in idx], idx,
                          chunk_factor) for _, idx in sorted(by_window.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out if include_count else out.drop("window_count")


def burst_rows(view: LogView, rules: list[Rule], single_order: bool = False) -> DataFrame:
    """Matching rows of burst rules, one per (log, rule): ``_rw_k`` (rule ordinal), ``_rw_key``
    (the declared ``by`` field, D2), ``_rw_t`` (event time), ``_rw_o0..`` (order) and the
    alert payload. The selection filter runs first (A4) and reaches the scan."""
    specs = [burst_spec(r) for r in rules]
    flagged, names = with_rule_flags(view.df, rules, view.fields, prefix="__b",
                                     conditions=[s.selection for s in specs])
    hits = F.filter(F.array(*[F.when(F.col(n), F.lit(k)) for k, n in enumerate(names)]),
                    lambda x: x.isNotNull())
    if single_order and len(view.order) != 1:
        raise ValueError("a streaming view needs exactly one order column (e.g. the offset)")
    order = [o.cast("long") for o in view.order] if single_order else view.order
    selected = flagged.where(any_of([F.col(n) for n in names])).select("*", F.explode(hits).alias("_rw_k"))
    return selected.select(
        F.col("_rw_k"),
        case_of(F.col("_rw_k"), [field_value_text(view.fields, s.by_field) for s in specs]).alias("_rw_key"),
        counting_time(view).alias("_rw_t"),
        *[o.alias(f"_rw_o{i}") for i, o in enumerate(order)],
        view.host.alias("host"), view.raw_json.alias("raw_log"),
        view.id_time_us.alias("_rw_idt"),
        *[F.col(quote(k)) for k in view.keep],
    )


def counting_time(view: LogView) -> Column:
    """The time a log counts at: event time, else arrival time, else 0 (all such logs arrive together)."""
    arrival = [] if view.arrival_us is None else [view.arrival_us]
    return F.coalesce(view.event_us, *arrival, F.lit(0).cast("long"))


def other_key(specs: list[BurstSpec], k: Column, key: Column) -> Column | None:
    """The key value that goes into alert ids (J3): NULL for rules by host; None if all are."""
    if all(s.by_field == "host" for s in specs):
        return None
    return F.when(case_of(k, [F.lit(s.by_field != "host") for s in specs]), key)


def _burst_group(view: LogView, rules: list[Rule], specs: list[BurstSpec], ordinals: list[int],
                 chunk_factor: int) -> DataFrame:
    window_s = specs[0].window_seconds
    rows = burst_rows(view, rules)
    order_names = [f"_rw_o{i}" for i in range(len(view.order))]
    counted = windowed_counts(rows, key_cols=["_rw_k", "_rw_key"], time_col="_rw_t", order_cols=order_names,
                              window_us=window_s * MICROS, chunk_factor=chunk_factor)
    k = F.col("_rw_k")
    fired = counted.where(F.col("window_count") > case_of(k, [F.lit(s.threshold) for s in specs]))
    rid = case_of(k, [F.lit(r.id) for r in rules])
    return fired.select(
        bucket_alert_id(rid, F.col("host"), time_bucket(F.col("_rw_idt"), window_s),
                        other_key(specs, k, F.col("_rw_key"))).alias("alert_id"),
        rid.alias("rule_id"),
        case_of(k, [F.lit(r.title) for r in rules]).alias("rule_title"),
        case_of(k, [F.lit(r.level) for r in rules]).alias("severity"),
        matched_at().alias("matched_at"),
        F.col("host"), F.col("raw_log"),
        *[F.col(quote(c)) for c in view.keep],
        F.col("window_count"),
    )
