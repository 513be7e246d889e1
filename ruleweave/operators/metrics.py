"""Stream-health queries (M1-M4) over metric tables or raw rows.

* throughput: events per second per time window, per worker and in total (``rollup``);
* latency quantiles from cumulative histogram buckets (the histogram form keeps a fixed
  number of counters per window however many events there are), linear inside a bucket;
* consumer lag: ``sum(max(0, end - position))`` per worker and in total;
* processed / skipped counts of a JSON decode;
* rates of counters that restart with their process, per series and evaluation time, and
  latency quantiles over the rates of histogram bucket counters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ruleweave.functions.fields import quote
from ruleweave.functions.jsontext import strict_object

# Default latency bucket bounds (upper edges, "+Inf" implied last).
DEFAULT_BOUNDS = (5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0)


def throughput(df: DataFrame, time_col: str, worker_col: str, unit: str | None = "minute",
               seconds: int = 60) -> DataFrame:
    """M1: events and events/second per window and worker; worker NULL = all workers, and logs
    without a worker are those of ``(none)``. Counted per window and worker first, then totalled.

    With ``unit`` the time column is truncated (``date_trunc``); with ``unit=None`` it
    already holds the window start and ``seconds`` is the window length.
    """
    if unit is not None:
        seconds = {"second": 1, "minute": 60, "hour": 3600}[unit]
        w = F.date_trunc(unit, F.col(quote(time_col))).alias("window_start")
    else:
        w = F.col(quote(time_col)).alias("window_start")
    each = (df.select(w, F.coalesce(F.col(quote(worker_col)).cast("string"), F.lit("(none)")).alias("worker"))
            .where(F.col("window_start").isNotNull()).groupBy("window_start", "worker").agg(F.count(F.lit(1)).alias("n")))
    out = each.rollup("window_start", "worker").agg(F.sum("n").alias("events")).where(F.col("window_start").isNotNull())
    return out.withColumn("events_per_second", F.col("events") / F.lit(float(seconds)))


def histogram(df: DataFrame, value_col: str, group_cols: list[str], bounds=DEFAULT_BOUNDS) -> DataFrame:
    """Cumulative bucket counts ``(group..., le, cumulative_count)``; ``le`` = +Inf for the total.

    One aggregation with one conditional count per bound, then an unpivot: every bucket
    appears, also empty ones, without joining against a bucket table.
    """
    v = F.col(quote(value_col))
    aggs = [F.count_if(v <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bounds)]
    aggs.append(F.count(v).alias(f"b{len(bounds)}"))
    counts = df.groupBy(*[F.col(quote(g)) for g in group_cols]).agg(*aggs)
    les = [float(b) for b in bounds] + [float("inf")]
    pairs = F.array(*[F.struct(F.lit(le).alias("le"), F.col(f"b{i}").alias("cumulative_count"))
                      for i, le in enumerate(les)])
    return counts.select(*[F.col(quote(g)) for g in group_cols], F.inline(pairs))


def histogram_quantile(buckets: DataFrame, q: float, group_cols: list[str]) -> DataFrame:
    """M2: the q-quantile from cumulative buckets, linear within the bucket it falls in.

    The first bucket starts at 0; a rank in the +Inf bucket returns the last finite bound.
    """
    g = [F.col(quote(c)) for c in group_cols]
    w = Window.partitionBy(*g).orderBy("le")
    b = (buckets.withColumn("_rw_prev_le", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
         .withColumn("_rw_prev_cum", F.coalesce(F.lag("cumulative_count").over(w), F.lit(0)))
         .withColumn("_rw_total", F.max("cumulative_count").over(Window.partitionBy(*g))))
    rank = F.lit(q) * F.col("_rw_total")
    hit = b.where((F.col("cumulative_count") >= rank) & (F.col("_rw_total") > 0))
    first = hit.groupBy(*g).agg(F.min_by(F.struct("le", "_rw_prev_le", "_rw_prev_cum", "cumulative_count",
                                                  "_rw_total"), F.col("le")).alias("_rw_b"))
    x = F.col("_rw_b")
    inside = x.cumulative_count - x._rw_prev_cum
    val = (F.when(x.le == F.lit(float("inf")), x._rw_prev_le)
           .when(inside == 0, x.le)
           .otherwise(x._rw_prev_le + (x.le - x._rw_prev_le) * (F.lit(q) * x._rw_total - x._rw_prev_cum) / inside))
    return first.select(*g, F.lit(q).alias("quantile"), val.alias("value"))


def counter_rate(samples: DataFrame, series_cols: list[str], time_col: str = "t_us", value_col: str = "value",
                 range_seconds: int = 60, step_seconds: int | None = None) -> DataFrame:
    """M1 over counters: per second increase of each series in ``(t - range, t]`` at every step t.

    ``(series..., window_end_us, samples, increase, rate)`` for windows with samples at two times or more.
    A value below its predecessor is a restart: the counter began at 0 again, so all of it is increase.
    The increase seen between the first and last sample is extended to the window's edges, by at most
    half a sample distance where an edge is further than 1.1 distances off, and not to before the time
    at which the counter would have been 0.

    Samples without a time or value are left out; of samples at one time the larger comes later. A NULL
    in a series column is a value like any other. A sample is copied to the range / step windows that
    hold it; the window functions and the aggregate share one shuffle by (series, window), so a series
    of any length is spread over its windows.
    """
    step_us, range_us = (step_seconds or range_seconds) * 1_000_000, range_seconds * 1_000_000
    names = [F.col(quote(c)) for c in series_cols]
    t, v = F.col("_rw_t"), F.col("_rw_v")
    first_end = t + F.pmod(-t, F.lit(step_us))
    held = (samples.select(*names, F.col(quote(time_col)).cast("long").alias("_rw_t"),
                           F.col(quote(value_col)).cast("double").alias("_rw_v"))
            .where(t.isNotNull() & v.isNotNull()))
    if range_us == step_us:
        dealt = held.withColumn("window_end_us", first_end)
    else:       # ends in [t, t + range); none where the range is shorter than the step and misses the sample
        last_end = t + F.lit(range_us - 1) - F.pmod(t + F.lit(range_us - 1), F.lit(step_us))
        dealt = held.where(first_end <= last_end).withColumn(
            "window_end_us", F.explode(F.sequence(first_end, last_end, F.lit(step_us))))
    before = F.lag("_rw_v").over(Window.partitionBy(*names, "window_end_us").orderBy("_rw_t", "_rw_v"))
    grown = dealt.withColumn("_rw_up", F.when(before.isNull(), F.lit(0.0)).when(v < before, v).otherwise(v - before))
    seen = grown.groupBy(*names, "window_end_us").agg(
        F.count(F.lit(1)).alias("samples"), F.sum("_rw_up").alias("_rw_seen"), F.min("_rw_t").alias("_rw_from"),
        F.max("_rw_t").alias("_rw_to"), F.min(F.struct("_rw_t", "_rw_v")).getField("_rw_v").alias("_rw_first"))
    span = F.col("_rw_to") - F.col("_rw_from")
    distance = span / (F.col("samples") - 1)

    def to_edge(gap):
        return F.when(gap >= distance * 1.1, distance / 2).otherwise(gap)

    start = to_edge(F.col("_rw_from") - (F.col("window_end_us") - F.lit(range_us)))
    zero = F.when((F.col("_rw_seen") > 0) & (F.col("_rw_first") >= 0), span * (F.col("_rw_first") / F.col("_rw_seen")))
    covered = span + F.least(start, zero) + to_edge(F.col("window_end_us") - F.col("_rw_to"))
    increase = F.col("_rw_seen") * (covered / span)
    return seen.where(span > 0).select(*names, "window_end_us", "samples", increase.alias("increase"),
                                       (increase / F.lit(float(range_seconds))).alias("rate"))


def rate_quantile(samples: DataFrame, q: float, group_cols: list[str], series_cols: list[str], le_col: str = "le",
                  **rate_options) -> DataFrame:
    """M2 over counters: the q-quantile per group and window from the rates of cumulative bucket counters.

    Rates are summed by ``le`` over the other series columns, then read as a histogram. A bucket whose sum
    is below that of a smaller bound (series that began between two samples) takes the larger one's place.
    Windows whose rates are all 0 have no quantile.
    """
    rates = counter_rate(samples, [*series_cols, le_col], **rate_options)
    keys = [*group_cols, "window_end_us"]
    g = [F.col(quote(c)) for c in keys]
    summed = rates.groupBy(*g, F.col(quote(le_col)).cast("double").alias("le")).agg(F.sum("rate").alias("_rw_rate"))
    rising = F.max("_rw_rate").over(Window.partitionBy(*g).orderBy("le"))
    return histogram_quantile(summed.select(*g, "le", rising.alias("cumulative_count")), q, keys)


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """M3: lag per worker and in total (worker NULL) from ``worker, partition, end_offset, position``."""
    lag = F.greatest(F.lit(0), F.col("end_offset") - F.col("position"))
    return (offsets.rollup("worker").agg(F.sum(lag).cast("long").alias("lag"),
                                         F.count(F.lit(1)).alias("partitions")))


def decode_counts(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """M4: how many texts decode to a JSON object (processed) and how many are skipped."""
    ok = strict_object(F.col(quote(value_col))).isNotNull()
    return raw.agg(F.count_if(ok).alias("processed"), F.count_if(~ok).alias("skipped"))


def latency_summary(df: DataFrame, value_col: str, group_cols: list[str], quantiles=(0.5, 0.99),
                    bounds=DEFAULT_BOUNDS) -> DataFrame:
    """M2 end to end: buckets, then one row per (group, quantile)."""
    h = histogram(df, value_col, group_cols, bounds)
    out = None
    for q in quantiles:
        part = histogram_quantile(h, q, group_cols)
        out = part if out is None else out.unionByName(part)
    return out
