"""Rates of counters against a sample-by-sample computation."""

import random

import pytest

from ruleweave.operators.metrics import counter_rate, histogram_quantile, rate_quantile

SEC = 1_000_000


def expected(samples, range_s, step_s):
    series = {}
    for s, t, v in samples:
        if t is not None and v is not None:
            series.setdefault(s, []).append((t, v))
    out = {}
    for s, points in series.items():
        points.sort()
        ends = {-(-t // (step_s * SEC)) * step_s * SEC + k * step_s * SEC for t, _ in points for k in range(range_s // step_s + 1)}
        for end in ends:
            inside = [(t, v) for t, v in points if end - range_s * SEC < t <= end]
            if len({t for t, _ in inside}) < 2:
                continue
            seen = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
            (t0, v0), (t1, _) = inside[0], inside[-1]
            distance = (t1 - t0) / (len(inside) - 1)
            before, after = t0 - (end - range_s * SEC), end - t1
            before = distance / 2 if before >= distance * 1.1 else before
            after = distance / 2 if after >= distance * 1.1 else after
            if seen > 0:
                before = min(before, (t1 - t0) * (v0 / seen))
            out[s, end] = (len(inside), seen * (t1 - t0 + before + after) / (t1 - t0))
    return out


def make(spark, rows):
    return spark.createDataFrame(rows, "series string, t_us long, value double")


@pytest.mark.parametrize("range_s, step_s", [(60, 60), (60, 15), (60, 45), (20, 60)])
def test_rates_equal_a_walk_over_the_samples(spark, range_s, step_s):
    rng = random.Random(range_s * step_s)
    rows = []
    for s in ("a", "b", None):
        value = float(rng.randrange(50))
        for i in range(120):
            value = 0.0 if rng.random() < 0.05 else value + rng.randrange(9)
            rows.append((s, rng.randrange(-300, 300) * SEC + rng.randrange(SEC), value))
    rows += [("a", None, 3.0), ("b", 5, None), ("lone", 7 * SEC, 1.0), ("tie", 8 * SEC, 1.0), ("tie", 8 * SEC, 4.0)]
    got = counter_rate(make(spark, rows).repartition(4), ["series"], range_seconds=range_s, step_seconds=step_s).collect()
    want = expected(rows, range_s, step_s)
    assert {(r.series, r.window_end_us) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        n, increase = want[r.series, r.window_end_us]
        assert r.samples == n and r.increase == pytest.approx(increase) and r.rate == pytest.approx(increase / range_s)


def test_a_restart_counts_from_zero(spark):
    rows = [("s", t * SEC, float(v)) for t, v in [(15, 100), (30, 130), (45, 5), (60, 20)]]
    got = counter_rate(make(spark, rows), ["series"], range_seconds=60).collect()
    assert [(r.samples, r.increase) for r in got] == [(4, pytest.approx(50 * (45 + 15) / 45))]


def test_one_shuffle_and_empty(spark):
    plan = counter_rate(make(spark, [("s", 1, 1.0)]), ["series"], range_seconds=60, step_seconds=15)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert counter_rate(make(spark, []), ["series"]).count() == 0


def test_quantile_of_rates(spark):
    """Two workers with even counters: the quantile is that of the summed increases."""
    rows = []
    for worker, per_scrape in (("w1", (10, 30, 40)), ("w2", (0, 10, 60))):
        for i in range(5):
            rows += [(worker, le, (i * 15) * SEC, float(n * (i + 20))) for le, n in zip((1.0, 5.0, float("inf")), per_scrape)]
    df = spark.createDataFrame(rows, "worker string, le double, t_us long, value double")
    got = {r.window_end_us: r.value for r in rate_quantile(df, 0.25, [], ["worker"], range_seconds=60).collect()}
    buckets = spark.createDataFrame([(1.0, 10.0), (5.0, 40.0), (float("inf"), 100.0)], "le double, cumulative_count double")
    assert got[60 * SEC] == pytest.approx(histogram_quantile(buckets, 0.25, []).first().value) == pytest.approx(3.0)


def test_buckets_that_fall_are_raised_and_idle_windows_have_none(spark):
    rows = [("w", le, t * SEC, v) for le, vs in ((1.0, (0.0, 8.0)), (5.0, (0.0, 4.0)), (float("inf"), (0.0, 16.0)))
            for t, v in zip((10, 50), vs)]
    rows += [("w", le, t * SEC, 7.0) for le in (1.0, 5.0, float("inf")) for t in (130, 170)]
    df = spark.createDataFrame(rows, "worker string, le double, t_us long, value double")
    got = [(r.window_end_us, r.value) for r in rate_quantile(df, 0.5, [], ["worker"], range_seconds=60).collect()]
    assert got == [(60 * SEC, pytest.approx(1.0))]
