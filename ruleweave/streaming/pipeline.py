"""The streaming detection job: logs in, alerts out.

``start_detection`` runs plain and burst rules in one ``foreachBatch``. Plain rules evaluate the
batch. Burst rules run the batch plan (:func:`windowed_counts`) over the batch's matches and a
*tail* table of how many earlier matches can still be counted; there is no Python state. Each
micro-batch is persisted once, published (K1), upserted into the store by batch id (K2), and
only then committed by the checkpoint (K6), so a replayed batch rewrites the same files.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ruleweave.errors import RuleError
from ruleweave.functions.fields import case_of, quote
from ruleweave.functions.ids import bucket_alert_id, time_bucket
from ruleweave.functions.jsontext import strict_object
from ruleweave.functions.timeutil import MICROS
from ruleweave.operators.burst import burst_rows as _burst_rows, other_key, windowed_counts
from ruleweave.operators.evaluate import ALERT_COLUMNS, alert_projection, alerts_json, match_rules, matched_at
from ruleweave.operators.lifecycle import entries
from ruleweave.operators.store import write_batch
from ruleweave.plans.compile import usable_rules
from ruleweave.plans.rules import Rule, build_rule, burst_spec, split_rules
from ruleweave.sources.logs import LogView
from ruleweave.streaming.tail import TailState

ERROR_SCHEMA = "seq long, rule_id string, error string"


def burst_rows(view: LogView, rules: list[Rule]) -> DataFrame:
    """Matching rows of burst rules for a stream: one order column (the offset)."""
    return _burst_rows(view, rules, single_order=True)


@dataclass
class ActiveRules:
    """The rules of a micro-batch: plain ones, and burst ones by (rule id, epoch), with their copies."""

    plain: list[Rule] = field(default_factory=list)
    plain_copies: list[int] = field(default_factory=list)
    bursts: list[tuple[str, int, Rule, int]] = field(default_factory=list)
    errors: list[tuple] = field(default_factory=list)


def fixed_rules(rules: list[Rule]) -> Callable[[SparkSession, LogView], ActiveRules]:
    """Rules that never change."""
    plain, bursts = split_rules(rules)
    active = ActiveRules(plain, [1] * len(plain), [(r.id, i, r, 1) for i, r in enumerate(bursts)])
    return lambda spark, view: active


def changelog_rules(load_changelog: Callable[[SparkSession], DataFrame]) -> Callable[[SparkSession, LogView], ActiveRules]:
    """The rules that the changelog, read anew for each micro-batch, leaves active.

    Live entries of one (rule id, epoch) share one window: the newest sets selection, threshold and
    timeframe, and each copy gives an alert. Rules that cannot run become rows of ``errors``.
    """
    def load(spark: SparkSession, view: LogView) -> ActiveRules:
        out, groups = ActiveRules(), {}
        live = entries(load_changelog(spark)).where(F.col("to_seq").isNull()).orderBy("seq")
        for e in live.collect():    # one row per active rule: control-plane data, needed here to compile
            try:
                rule = build_rule(json.loads(e.rule), source=f"changelog seq {e.seq}")
                if not usable_rules([rule], view.fields)[0]:
                    raise RuleError("the rule does not compile")
            except RuleError as exc:
                out.errors.append((e.seq, e.rule_id, str(exc)))
                continue
            if rule.is_burst:
                copies = groups.get((rule.id, int(e.epoch)), (None, 0))[1] + int(e.copies)
                groups[rule.id, int(e.epoch)] = (rule, copies)
            else:
                out.plain.append(rule)
                out.plain_copies.append(int(e.copies))
        out.bursts = [(rid, epoch, *groups[rid, epoch]) for rid, epoch in sorted(groups)]
        return out

    return load


def _burst_step(spark: SparkSession, view: LogView, active: ActiveRules, tail: TailState, batch_id: int,
                lateness_us: int, future_us: int | None):
    """(alerts, rows set aside or None, write of the next tail, persisted matches) of one micro-batch."""
    rules = [r for _, _, r, _ in active.bursts]
    names = [(rid, epoch) for rid, epoch, _, _ in active.bursts]
    specs = [burst_spec(r) for r in rules]
    spans = [s.window_seconds * MICROS for s in specs]
    k = F.col("_rw_k")
    per_rule = lambda values: case_of(k, [F.lit(v).cast("long") for v in values])
    rid, epoch = case_of(k, [F.lit(r) for r, _ in names]), per_rule([e for _, e in names])
    # counted, kept and set aside: match the rules once
    matches = burst_rows(view, rules).withColumn("_rw_bucket", tail.bucket_of(rid, epoch, F.col("_rw_key"))).persist()
    limit = F.lit(None).cast("long") if future_us is None else F.unix_micros(F.current_timestamp()) + F.lit(future_us)
    ahead = F.coalesce(F.col("_rw_t") > limit, F.lit(False))
    # which of the tail's buckets this batch touches
    touched = {r._rw_bucket for r in matches.where(~ahead).select("_rw_bucket").distinct().collect()}
    new = matches.where(~ahead)
    old = tail.read(spark, touched)
    if old is not None:
        ordinals = spark.range(1).select(F.inline(F.array(*[F.struct(
            F.lit(r).alias("_rw_rid"), F.lit(e).cast("long").alias("_rw_epoch"), F.lit(i).alias("_rw_k"))
            for i, (r, e) in enumerate(names)])))
        old = old.join(ordinals, ["_rw_rid", "_rw_epoch"]).drop("_rw_rid", "_rw_epoch")
    counted = None
    for w in sorted(set(spans)):
        own = k.isin([i for i, x in enumerate(spans) if x == w])
        part = windowed_counts(new.where(own), key_cols=["_rw_k", "_rw_key"], time_col="_rw_t", order_cols=["_rw_o0"],
                               window_us=w, earlier=None if old is None else old.where(own))
        counted = part if counted is None else counted.unionByName(part)
    fired = counted.where(F.col("window_count") > case_of(k, [F.lit(s.threshold) for s in specs]))
    fired = fired.withColumn("_rw_copy", F.explode(F.sequence(F.lit(1), case_of(
        k, [F.lit(c) for _, _, _, c in active.bursts]))))
    bucket = case_of(k, [time_bucket(F.col("_rw_idt"), s.window_seconds) for s in specs])
    alerts = fired.select(
        bucket_alert_id(rid, F.col("host"), bucket, other_key(specs, k, F.col("_rw_key"))).alias("alert_id"),
        rid.alias("rule_id"), case_of(k, [F.lit(r.title) for r in rules]).alias("rule_title"),
        case_of(k, [F.lit(r.level) for r in rules]).alias("severity"), matched_at().alias("matched_at"),
        "host", "raw_log", *[F.col(quote(c)) for c in view.keep], "window_count")

    # set aside: too far ahead; too late for what the tail keeps; or of a key that may have been forgotten
    keyed = [F.coalesce("_rw_key", F.lit("")).alias("_rw_kt"), F.col("_rw_key").isNull().alias("_rw_kn")]
    key = ["_rw_k", "_rw_kt", "_rw_kn"]
    seen = matches.select("*", *keyed, ahead.alias("_rw_ahead"))
    if old is None:
        seen = seen.withColumn("_rw_newest", F.lit(None).cast("long"))
    else:
        seen = seen.join(old.select("*", *keyed).groupBy(*key).agg(F.max("_rw_t").alias("_rw_newest")), key, "left")
    span = per_rule(spans)
    known = F.col("_rw_newest").isNotNull()
    reason = (F.when(F.col("_rw_ahead"), F.lit("future"))
              .when(known & (F.col("_rw_t") <= F.col("_rw_newest") - span - F.lit(lateness_us)), F.lit("late"))
              .when(~known & (F.col("_rw_t") < span + per_rule([tail.forgot.get(n, -(1 << 62)) for n in names])),
                    F.lit("returned")))
    aside = seen.select(reason.alias("reason"), "_rw_key", "_rw_t", "_rw_o0", "host", "raw_log").where("reason IS NOT NULL")

    def keep_tail() -> None:
        none = F.lit(None).cast("long")
        fresh = new.select("_rw_k", *keyed, "_rw_t", F.lit(1).cast("long").alias("_rw_n"), none.alias("_rw_seen"))
        marks = fresh if old is None else fresh.unionByName(old.select("_rw_k", *keyed, "_rw_t", "_rw_n", "_rw_seen"))
        # _rw_last: the rule's clock when the key was last seen, none if that is now
        ends = marks.groupBy(*key).agg(F.max("_rw_t").alias("_rw_newest"), F.when(
            F.count("*") == F.count("_rw_seen"), F.max("_rw_seen")).alias("_rw_last"))
        text = F.when(~F.col("_rw_kn"), F.col("_rw_kt"))
        ends = ends.withColumn("_rw_bucket", tail.bucket_of(rid, epoch, text)).persist()
        try:
            found = {(*names[r._rw_k], r._rw_bucket): {"keys": r["keys"], "middle": r.middle, "newest": r.newest}
                     for r in ends.groupBy("_rw_k", "_rw_bucket").agg(
                         F.count("*").alias("keys"), F.percentile_approx("_rw_newest", 0.5).alias("middle"),
                         F.max("_rw_newest").alias("newest")).collect()}
            far = {n: w + lateness_us for n, w in zip(names, spans)}
            tail.advance(found, far)
            now = per_rule([tail.clocks.get(n, 0) for n in names])
            for t in found:
                tail.stats[t]["last"] = tail.clocks[t[:2]]
            reach = per_rule([far[n] for n in names])
            idle = now - F.coalesce("_rw_last", now) > reach
            if old is not None:
                for r in ends.where(idle).groupBy("_rw_k").agg(F.max("_rw_newest").alias("newest")).collect():
                    tail.note_forgotten(names[r._rw_k], r.newest)
            kept = (marks.groupBy(*key, "_rw_t").agg(F.sum("_rw_n").alias("_rw_n")).join(ends.where(~idle), key)
                    .where(F.col("_rw_t") > F.col("_rw_newest") - reach))
            tail.write(spark, kept.select(
                rid.alias("_rw_rid"), epoch.alias("_rw_epoch"), text.alias("_rw_key"), "_rw_t", "_rw_n",
                F.coalesce("_rw_last", now).alias("_rw_seen"), "_rw_bucket"), batch_id, touched)
        finally:
            ends.unpersist()

    return alerts, aside, keep_tail, matches


def start_detection(logs: DataFrame, make_view: Callable[[DataFrame], LogView],
                    rules: Callable[[SparkSession, LogView], ActiveRules], *, checkpoint: str, state_path: str,
                    publish_path: str | None = None, store_path: str | None = None, kafka_servers: str | None = None,
                    kafka_topic: str = "alerts", lateness_seconds: int = 0, future_seconds: int | None = 86_400,
                    trigger: dict | None = None, tail_buckets: int = 16) -> StreamingQuery:
    """E3 + E4 + A9 on a stream: plain and burst rules, published and stored per micro-batch.

    The tail keeps, per (rule, key), the numbers of matches at times newer than that key's own newest less
    the rule's span and ``lateness_seconds``; keys whose clocks differ do not shorten each other's windows.
    It lies in ``tail_buckets`` by key, of which a micro-batch reads and writes those it has matches for.
    A key is forgotten once its rule's clock, the median of its keys' newest times, has moved on by more than
    the span and the lateness since the key was last seen: whatever its own clock shows, it has moved on as
    far. A log of an unknown key that could still be counted with a forgotten key's matches is listed in
    ``state_path/aside`` with reason ``returned``.
    Counts equal the batch answer for logs at most that late against their own key. A later one is
    still counted against what the tail has, and listed there with reason ``late``. A
    log more than ``future_seconds`` ahead of the clock (None: no limit) takes no part in bursts and is
    listed there with reason ``future``, so that a wrong clock does not end its key's window. Rules that
    cannot run are listed in ``state_path/rule_errors``. All of these are written per batch id.

    ``make_view`` gives a view with one order column, which must also be in its ``keep``.
    """
    state = state_path.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch, matches = batch.persist(), None
        try:
            view = make_view(batch)
            active = rules(spark, view)
            columns = [*ALERT_COLUMNS, *view.keep]
            plain = match_rules(view, active.plain, copies=active.plain_copies)
            alerts = alert_projection(view, plain).select(*columns, F.lit(None).cast("long").alias("window_count"))
            tail = TailState.load(spark, state, batch_id - 1, tail_buckets)
            keep_tail = lambda: tail.write(spark, None, batch_id, set())
            if active.bursts:
                burst, aside, keep_tail, matches = _burst_step(
                    spark, view, active, tail, batch_id, lateness_seconds * MICROS,
                    None if future_seconds is None else future_seconds * MICROS)
                alerts = alerts.unionByName(burst.select(*columns, "window_count"))
                aside.write.mode("overwrite").parquet(f"{state}/aside/batch_id={batch_id}")
            if active.errors:
                spark.createDataFrame(active.errors, ERROR_SCHEMA).write.mode("overwrite").parquet(
                    f"{state}/rule_errors/batch_id={batch_id}")
            _sink(alerts, batch_id, view.keep, publish_path, store_path, kafka_servers, kafka_topic, view.keep[:1],
                  some=plain if active.plain else None)
            keep_tail()
        finally:
            batch.unpersist()
            if matches is not None:
                matches.unpersist()

    return _started(logs, run, checkpoint, trigger)


def _sink(alerts: DataFrame, batch_id: int, keep: list[str], publish_path: str | None, store_path: str | None,
          kafka_servers: str | None, kafka_topic: str, order_cols: list[str], some: DataFrame | None = None) -> None:
    """K1 + K2: publish every alert as its JSON document, upsert the batch; nothing for an empty batch (K4).

    Alerts are kept for the check and for each sink, unless they go to one sink and rows of ``some``, which each
    give an alert and cost little to find, already show that there are any.
    """
    sure = sum(map(bool, (publish_path, store_path, kafka_servers))) == 1 and some is not None and not some.isEmpty()
    alerts = alerts if sure else alerts.persist()
    try:
        if not sure and alerts.isEmpty():
            return
        if publish_path:
            extra = [c for c in (*keep, "window_count") if c in alerts.columns]
            docs = alerts_json(alerts, extra)
            docs.write.mode("overwrite").parquet(f"{publish_path.rstrip('/')}/batch_id={batch_id}")
        if kafka_servers:   # needs the Kafka connector on the classpath
            (alerts_json(alerts).write.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
             .option("topic", kafka_topic).save())
        if store_path:
            write_batch(alerts, store_path, batch_id, [F.col(quote(c)) for c in order_cols])
    finally:
        if not sure:
            alerts.unpersist()


def _started(logs: DataFrame, run, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """K4: a 5-second trigger unless told otherwise (``{"availableNow": True}`` drains what is there)."""
    w = logs.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def start_table_bursts(logs: DataFrame, make_view, rules: list[Rule], **options) -> StreamingQuery:
    """Fixed rules on a stream (see :func:`start_detection`)."""
    return start_detection(logs, make_view, fixed_rules(rules), **options)


def start_changelog_detection(logs: DataFrame, make_view, load_changelog, **options) -> StreamingQuery:
    """L5-L7 on a stream (D4): each micro-batch runs the rules that the changelog leaves active.

    An update keeps the window (same epoch), a delete and re-add starts a new one, and a removed
    rule's tail is dropped.
    """
    return start_detection(logs, make_view, changelog_rules(load_changelog), **options)


def detection_stream(view: LogView, rules: list[Rule]) -> DataFrame:
    """E3 on a stream: alerts of plain rules, without state. Burst rules run in :func:`start_detection`."""
    plain, bursts = split_rules(rules)
    if bursts:
        raise RuleError("burst rules need start_detection: " + ", ".join(r.id for r in bursts))
    return alert_projection(view, match_rules(view, plain)).select(*ALERT_COLUMNS, *view.keep)


def dedup_stream(alerts: DataFrame, time_col: str, watermark: str = "1 hour") -> DataFrame:
    """K3: drop repeated alert ids within the watermark (first wins)."""
    return alerts.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(["alert_id"])


def start_sink(alerts: DataFrame, *, checkpoint: str, order_col: str, store_path: str | None = None,
               publish_path: str | None = None, trigger: dict | None = None,
               kafka_servers: str | None = None, kafka_topic: str = "alerts") -> StreamingQuery:
    """K1 + K2 + K4 + K6 for an alert stream: publish and upsert each micro-batch; ``order_col``
    decides which of several alerts with one id is the last."""
    def run(batch: DataFrame, batch_id: int) -> None:
        _sink(batch, batch_id, [order_col], publish_path, store_path, kafka_servers, kafka_topic, [order_col])

    return _started(alerts, run, checkpoint, trigger)


def observed_decode(raw: DataFrame, value_col: str = "value", name: str = "decode") -> DataFrame:
    """M4 on a stream: processed / skipped counts reported in each progress event."""
    ok = strict_object(F.col(quote(value_col))).isNotNull()
    return raw.observe(name, F.count_if(ok).alias("processed"), F.count_if(~ok).alias("skipped"))


def lag_from_progress(progress: dict) -> dict:
    """M3 live: lag per source partition from a query's progress (``query.lastProgress``).

    For offset-based sources the progress holds, per topic and partition, the offsets the
    batch ended at and the latest offsets available; lag is ``max(0, latest - end)``.
    Returns ``{"total": n, "partitions": {(topic, partition): n}}``.
    """
    import json as _json

    out: dict = {}
    for src in progress.get("sources", []):
        end, latest = src.get("endOffset"), src.get("latestOffset")
        if isinstance(end, str):
            end = _json.loads(end)
        if isinstance(latest, str):
            latest = _json.loads(latest)
        if not isinstance(end, dict) or not isinstance(latest, dict):
            continue
        for topic, parts in latest.items():
            for part, last in parts.items():
                done = end.get(topic, {}).get(part, 0)
                out[(topic, int(part))] = max(0, int(last) - int(done))
    return {"total": sum(out.values()), "partitions": out}
