from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.operators import quantiles, seasons, spi, timeseries, weather

DAY = dt.timedelta(days=1)


def test_season_stats_literal(spark):
    start = dt.date(2021, 6, 1)
    df = spark.createDataFrame([("a", start, 2.0), ("a", start + DAY, 4.0), ("a", start + 2 * DAY, 7.0), ("a", start, None), (None, start, 1.0)],
                               "k string, d date, v double")
    row = timeseries.season_stats(df, ["k"], "d", "v").collect()
    assert len(row) == 1
    r = row[0]
    assert (r.season, r.year, r.max, r.min) == ("Kharif", 2021, 7.0, 2.0)
    assert r.mean == pytest.approx(13 / 3) and r.stdDev == pytest.approx(2.0548046676563256) and r.p90 == pytest.approx(6.4)
    assert r.slope == pytest.approx(2.5) and r.auc == 13 * 16
    x = (start - dt.date(1970, 1, 1)).days - 1
    assert r.intercept + 2.5 * x == pytest.approx(-2 / 3)


def test_season_stats_of_long_series(spark):
    """The distributed way for long series and the one-stage way give the same statistics."""
    rng = random.Random(9)
    start = dt.date(2021, 6, 1)
    data = [("hot" if i % 3 else f"k{i % 30}", start + rng.randint(0, 300) * DAY, round(rng.gauss(5, 9), 1)) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, d date, v double")
    def stats(hot_rows):
        return {(r.k, r.season, r.year): tuple(r)[3:] for r in timeseries.season_stats(df, ["k"], "d", "v", hot_rows=hot_rows).collect()}
    one = stats(10**6)
    assert len(one) > 20 and all(len(v) == 8 for v in one.values())
    for hot_rows in (100, 0):
        other = stats(hot_rows)
        assert set(other) == set(one)
        for k, values in one.items():
            assert other[k] == pytest.approx(values, rel=1e-9, abs=1e-9, nan_ok=True), k


def test_season_end_open_or_closed(spark):
    df = spark.createDataFrame([("a", dt.date(2021, 10, 31), 1.0), ("a", dt.date(2021, 10, 30), 1.0), ("a", dt.date(2022, 4, 30), 1.0)],
                               "k string, d date, v double")
    assert seasons.assign_season(df, "d", "both").count() == 3
    assert seasons.assign_season(df, "d", "left").count() == 1
    calendar = seasons.season_calendar(spark, [2021])
    for closed, n in (("both", 3), ("left", 1)):
        for small in (True, False):
            assert seasons.season_range_join(df, calendar, "d", closed, calendar_is_small=small).count() == n


def test_range_join_equals_closed_form(spark):
    first = dt.date(2019, 1, 1)
    df = spark.createDataFrame([(first + i * DAY,) for i in range(1500)], "d date")
    for closed in ("both", "left"):
        a = seasons.season_range_join(df, seasons.season_calendar(spark, range(2017, 2025)), "d", closed).select("d", "season", "year")
        b = seasons.assign_season(df, "d", closed).select("d", "season", "year")
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_calendar_and_grid(spark, rows):
    calendar = seasons.season_calendar(spark, [2020, 2021, 2022])
    assert calendar.count() == 6
    got = {(r.season, r.year): (str(r.start), str(r.end)) for r in calendar.collect()}
    assert got[("Kharif", 2020)] == ("2020-06-01", "2020-10-31") and got[("Rabi", 2022)] == ("2022-11-01", "2023-04-30")
    grid = seasons.season_grid(spark.range(3).withColumnRenamed("id", "loc"), calendar)
    assert grid.count() == 18 and grid.columns == ["loc", "season", "year", "start", "end"]


@pytest.mark.parametrize("hot_rows", [10**6, 20, 0])
def test_quantiles_match_numpy(spark, hot_rows):
    """One key holds most rows, with ties, negatives, zeros, tiny and huge values."""
    rng = random.Random(3)
    pool = [0.0, -0.0, 1e-300, -1e300, 1e300, 5.0, 5.0]
    data = [("hot", rng.choice(pool) if rng.random() < 0.2 else rng.gauss(0, 50)) for _ in range(4000)]
    data += [(f"k{i % 40}", float(rng.randint(-3, 3))) for i in range(400)] + [("one", 1.5), ("one", None), ("none", None), (None, 1.0)]
    data += [("hot", float("nan"))]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    probs = {"lo": 0.0, "q1": 0.25, "p90": 0.9, "hi": 1.0}
    got = {r.k: r for r in quantiles.exact_quantiles(df, ["k"], "v", probs, hot_rows).collect()}
    freq = quantiles.value_frequencies(df, ["k"], "v")
    again = {r.k: r for r in quantiles.quantiles_of_frequencies(freq, ["k"], probs, hot_values=hot_rows).collect()}
    assert got == again
    groups = {}
    for k, v in data:
        if k is not None and v is not None and not math.isnan(v):
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, vs in groups.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(float(np.quantile(vs, p)), rel=1e-12, abs=1e-12), (k, name)


def test_quantile_of_infinities(spark):
    df = spark.createDataFrame([("a", v) for v in (-math.inf, 1.0, 2.0, math.inf)], "k string, v double")
    for hot in (10, 0):
        r = quantiles.exact_quantiles(df, ["k"], "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}, hot).first()
        assert (r.lo, r.mid, r.hi) == (-math.inf, 1.5, math.inf)


def test_magnitude_bin_is_monotone(spark):
    rng = random.Random(5)
    vs = sorted([rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(3000)] + [0.0, 5e-324, -5e-324, 1.7e308, math.inf, -math.inf])
    df = spark.createDataFrame([(v,) for v in vs], "v double").coalesce(1)
    bins = [r[0] for r in df.select(quantiles.magnitude_bin("v")).collect()]
    assert bins == sorted(bins)


def test_rolling_sum_drops_incomplete(spark, rows):
    df = spark.createDataFrame([("a", i, float(i) if i != 4 else None) for i in range(8)], "k string, i int, v double")
    assert rows(timeseries.rolling_sum(df, ["k"], "i", "v", rows=3), "i", "roll") == [(2, 3.0), (3, 6.0), (7, 18.0)]


def test_rate_audit_brute_force(spark):
    """Bursts, ties and slice edges; a slice as short as the window."""
    rng = random.Random(11)
    second = 1_000_000
    times = [rng.randint(0, 400 * second) for _ in range(300)] + [120 * second] * 5 + [60 * second, 0, 59_999_999, 180 * second]
    data = [(i, rng.choice("ab") if i % 3 else "hot", t) for i, t in enumerate(times)]
    df = spark.createDataFrame(data, "id int, k string, us bigint")
    for slice_seconds in (60, 77, 3600):
        got = {r.id: (r.calls, r.over_limit) for r in timeseries.rate_audit(df, ["k"], "us", 9, 60, slice_seconds).collect()}
        want = {}
        for i, k, t in data:
            n = sum(1 for _, k2, t2 in data if k2 == k and t - 60 * second < t2 <= t)
            want[i] = (n, n > 9)
        assert got == want


def daily(n, start=dt.date(2022, 6, 1), f=lambda i: 5 + (i * 37 % 23) + i * 0.01):
    return [(start + i * DAY, f(i)) for i in range(n)]


def features_by_hand(series):
    """gdd, rain_cv and the mean index with the fit solved by bisection and the index by the Erlang-free series."""
    rain = np.array([v for _, v in series])
    rolls = np.array([rain[i - 89 : i + 1].sum() for i in range(89, len(rain))])
    s = math.log(rolls.mean()) - np.log(rolls).mean()

    def gap(a):
        h = a * 1e-4
        psi = (8 * (math.lgamma(a + h) - math.lgamma(a - h)) - (math.lgamma(a + 2 * h) - math.lgamma(a - 2 * h))) / (12 * h)
        return math.log(a) - psi - s

    low, high = 1e-3, 1e9
    for _ in range(200):
        mid = math.sqrt(low * high)
        low, high = (mid, high) if gap(mid) > 0 else (low, mid)
    return rain.std() / rain.mean(), low, rolls


def test_weather_features(spark):
    series = daily(122)
    days = spark.createDataFrame([(1, d, v, 20.0) for d, v in series] + [(2, d, v, 1.0) for d, v in daily(60)]
                                 + [(3, d, 0.0, 1.0) for d, _ in daily(100)] + [(4, d, 2.0, 1.0) for d, _ in daily(100)],
                                 "loc int, date date, prectotcorr double, cdd10 double")
    got = {r["loc"]: r for r in weather.weather_features(days, ["loc"]).collect()}
    cv, shape, rolls = features_by_hand(series)
    assert got[1].gdd == pytest.approx(122 * 20) and got[1].rain_cv == pytest.approx(cv) and got[1].spi3_reason is None
    assert (got[2].spi3_mean, got[2].spi3_reason) == (None, "short")
    assert (got[3].spi3_mean, got[3].spi3_reason) == (None, "nonpositive") and math.isnan(got[3].rain_cv)
    assert (got[4].spi3_mean, got[4].spi3_reason) == (None, "constant")

    rolled = timeseries.rolling_sum(days.where("loc = 1"), ["loc"], "date", "prectotcorr")
    fit = spi.gamma_fit(rolled, ["loc"], "roll").first()
    assert fit.n == 33 and fit["shape"] == pytest.approx(shape, rel=1e-4) and fit["scale"] * fit["shape"] == pytest.approx(rolls.mean())
    index = spi.spi_mean(rolled, ["loc"], "roll").first().spi3_mean
    assert got[1].spi3_mean == pytest.approx(index, abs=1e-12) and abs(index) < 0.05


def test_spi_with_baseline(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(50, 90)], "k string, roll double")
    wet = df.withColumn("roll", F.col("roll") + 30)
    assert spi.spi_mean(wet, ["k"], "roll", baseline=df).first().spi3_mean > 1.5


def test_repeated_days_count_once(spark):
    series = daily(122)
    once = spark.createDataFrame([(1, d, v, 20.0) for d, v in series], "loc int, date date, prectotcorr double, cdd10 double")
    assert weather.weather_features(once.union(once).union(once), ["loc"]).first() == weather.weather_features(once, ["loc"]).first()


def test_days_that_disagree_are_an_error(spark):
    days = spark.createDataFrame([(1, dt.date(2022, 6, 1), 5.0, 1.0), (1, dt.date(2022, 6, 1), 3.0, 1.0)], "loc int, date date, prectotcorr double, cdd10 double")
    with pytest.raises(Exception, match="different values of prectotcorr"):
        weather.weather_features(days, ["loc"]).collect()


def test_zip_parameters(spark, rows):
    docs = spark.createDataFrame([(1, {"20220601": 1.0, "20220602": -999.0}, {"20220601": 5.0, "20220602": 6.0}), (2, {"20220601": 1.0}, {"20220602": 2.0})],
                                 "loc int, prectotcorr map<string,double>, cdd10 map<string,double>")
    assert rows(weather.mismatched_documents(docs), "loc") == [(2,)]
    lenient = weather.zip_parameters(docs, ["loc"], strict=False, fill_value=-999.0)
    assert rows(lenient) == [(1, dt.date(2022, 6, 1), 1.0, 5.0), (1, dt.date(2022, 6, 2), None, 6.0)]
    with pytest.raises(Exception, match="do not match"):
        weather.zip_parameters(docs, ["loc"]).collect()
