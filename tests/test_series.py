"""Properties of grids, windows, forecasts and distances, against brute force."""

import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weekloom.operators.decompose import acf, decompose_additive, pacf
from weekloom.operators.forecast import (
    autoregressive_forecast,
    grid_tuned_trend_season,
    moving_average,
    naive_last,
    seasonal_ar,
)
from weekloom.operators.scoring import dtw
from weekloom.operators.series import asfreq_fill0, resample_inferred_fill0, resample_month, resample_weekly_fill0
from weekloom.operators.windows import add_time_series_features, expanding_folds

SUNDAY = date(2020, 1, 5)


def weekly(name: str, n: int, seed: int = 0, skip=()):
    rng = random.Random(seed)
    return [(name, SUNDAY + timedelta(weeks=i), 1000.0 + 10 * i + rng.uniform(-50, 50)) for i in range(n) if i not in skip]


@pytest.fixture(scope="module")
def series(spark):
    rows = weekly("long", 150, 1) + weekly("gappy", 150, 2, skip={20, 21, 90}) + weekly("nine", 9, 3) + weekly("eight", 8, 4)
    rows += weekly("two", 2, 5) + weekly("one", 1, 6)
    return spark.createDataFrame(rows, "genre string, date date, total double").repartition(7)


def test_weekly_grid(series):
    grid = resample_weekly_fill0(series, ["genre"]).toPandas()
    for name, part in series.toPandas().groupby("genre"):
        got = grid[grid.genre == name].sort_values("date").set_index("date").total
        want = part.assign(date=pd.to_datetime(part.date)).set_index("date").total.resample("W").sum()
        assert list(pd.to_datetime(got.index)) == list(want.index)
        np.testing.assert_allclose(got.to_numpy(), want.to_numpy())


def test_off_grid_days_join_their_week(spark):
    rows = [("a", SUNDAY - timedelta(days=3), 1.0), ("a", SUNDAY, 2.0), ("a", SUNDAY + timedelta(days=15), 4.0)]
    df = spark.createDataFrame(rows, "genre string, date date, total double")
    got = [(r.date, r.total) for r in resample_weekly_fill0(df, ["genre"]).orderBy("date").collect()]
    assert got == [(SUNDAY + timedelta(weeks=i), v) for i, v in enumerate([3.0, 0.0, 0.0, 4.0])]
    on_grid = [(r.date, r.total) for r in asfreq_fill0(df.drop("genre")).orderBy("date").collect()]
    assert on_grid == [(SUNDAY, 2.0)]
    far = df.union(spark.createDataFrame([("a", date(2020, 4, 1), 8.0)], df.schema))
    months = [(r.date, r.total) for r in resample_month(far, ["genre"]).orderBy("date").collect()]
    assert months == [(date(2020, 1, 31), 7.0), (date(2020, 2, 29), 0.0), (date(2020, 3, 31), 0.0), (date(2020, 4, 30), 8.0)]


def test_series_keep_their_own_step(spark):
    def dates(name, days, start=SUNDAY):
        return [(name, start + timedelta(days=d), float(d + 1)) for d in days]

    rows = dates("thursday", range(4, 74, 7)) + dates("fortnight", range(1, 99, 14)) + dates("daily", range(9)) + dates("gappy thursday", [4, 11, 25])
    rows += dates("two", [4, 11]) + dates("twice", [4, 11, 11, 18]) + [("months", date(2020, m, 1), 1.0) for m in (1, 2, 3, 4)] + [("ends", date(2020, m, 1) - timedelta(days=1), 1.0) for m in (2, 5, 8)]
    rows += [("nulls", SUNDAY, None), ("nulls", SUNDAY + timedelta(days=2), 5.0), ("nulls", None, 7.0)]
    frame = pd.DataFrame(rows, columns=["genre", "date", "total"])
    got = resample_inferred_fill0(spark.createDataFrame(rows, "genre string, date date, total double"), ["genre"]).toPandas()
    for name, part in frame.dropna(subset=["date"]).groupby("genre"):
        index = pd.DatetimeIndex(part.date)
        rule = (pd.infer_freq(index) if len(index) > 2 else None) or "W"
        want = pd.Series(part.total.to_numpy(), index).resample(rule).sum().fillna(0)
        mine = got[got.genre == name].sort_values("date").set_index("date").total
        assert list(pd.to_datetime(mine.index)) == list(want.index), (name, rule)
        assert mine.tolist() == want.tolist(), name


def test_seasonal_ar_of_odd_series(spark):
    rows = [(name, SUNDAY + timedelta(weeks=k), v) for k in range(120) for name, v in (("flat", 5.0), ("zero", 0.0), ("line", 3.0 * k), ("wave", 100 + 10.0 * (k % 52 > 20) + k % 3))]
    got = seasonal_ar(spark.createDataFrame(rows, "genre string, date date, total double")).toPandas()
    assert got.groupby("genre").size().to_dict() == {"flat": 8, "zero": 8, "line": 8, "wave": 8}
    error = (got.actual - got.predicted).abs().groupby(got.genre).max()
    assert error["flat"] < 1e-6 and error["zero"] < 1e-6 and error["line"] < 1e-3 and error["wave"] < 3
    assert seasonal_ar(spark.createDataFrame(rows[:400], "genre string, date date, total double")).count() == 0


def test_short_series_gates(series):
    grid = resample_weekly_fill0(series, ["genre"])
    assert {r.genre for r in naive_last(grid).collect()} == {"long", "gappy", "nine"}
    windows = moving_average(grid).groupBy("genre").agg(F.collect_set("ma_window").alias("w")).collect()
    assert {r.genre: sorted(r.w) for r in windows} == {"long": [2, 3, 4, 6, 8, 12], "gappy": [2, 3, 4, 6, 8, 12]}
    assert {r.genre for r in autoregressive_forecast(grid).collect()} == {"long", "gappy"}


def test_autoregression_by_hand(series):
    got = autoregressive_forecast(series.filter("genre = 'long'")).orderBy("date").toPandas()
    y = series.filter("genre = 'long'").orderBy("date").toPandas().total.to_numpy()
    for k, t in enumerate(range(142, 150)):
        change = np.diff(y[:t])
        slope, intercept = np.polyfit(change[:-1], change[1:], 1)
        assert got.predicted[k] == pytest.approx(y[t - 1] + intercept + slope * change[-1], rel=1e-9)


def changed_future(series, day):
    return series.withColumn("total", F.when(F.col("date") >= day, F.col("total") * 7 + 1).otherwise(F.col("total")))


@pytest.mark.parametrize("model", [autoregressive_forecast, seasonal_ar])
def test_walk_forward_uses_no_later_row(series, model):
    long = series.filter("genre = 'long'")
    day = SUNDAY + timedelta(weeks=145)
    before = {r.date: r.predicted for r in model(long).collect()}
    after = {r.date: r.predicted for r in model(changed_future(long, day)).collect()}
    assert len(before) == 8
    assert all(after[d] == pytest.approx(before[d]) for d in before if d <= day)
    assert after[max(after)] != pytest.approx(before[max(before)])


def test_trend_season_ignores_test_weeks(series):
    long = series.filter("genre = 'long'")
    day = SUNDAY + timedelta(weeks=142)
    before = {r.date: (r.predicted, r.best_params) for r in grid_tuned_trend_season(long).collect()}
    after = {r.date: (r.predicted, r.best_params) for r in grid_tuned_trend_season(changed_future(long, day)).collect()}
    assert before == after and len(before) == 8
    truth = {r.date: r.total for r in long.collect()}
    assert all(abs(p - truth[d]) < 0.15 * truth[d] for d, (p, _) in before.items())


def test_features_equal_pandas(spark, series):
    df = series.withColumnRenamed("total", "spotify_streams").withColumn("song", F.lit("s")).withColumnRenamed("genre", "artist")
    got = add_time_series_features(df).toPandas().sort_values(["artist", "date"]).reset_index(drop=True)
    y = got.groupby("artist").spotify_streams
    for k in (1, 8):
        np.testing.assert_allclose(got[f"spotify_streams_lag_{k}"], y.shift(k))
    np.testing.assert_allclose(got.spotify_streams_roll_mean_4, y.transform(lambda x: x.rolling(4, min_periods=1).mean()))
    np.testing.assert_allclose(got.spotify_streams_roll_std_8, y.transform(lambda x: x.rolling(8, min_periods=1).std()))
    shifted = add_time_series_features(df, shift=1).toPandas().sort_values(["artist", "date"]).reset_index(drop=True)
    want = y.transform(lambda x: x.shift(1).rolling(4, min_periods=1).mean())
    np.testing.assert_allclose(shifted.spotify_streams_roll_mean_4, want)


def test_expanding_folds(spark):
    rows = [("a", SUNDAY + timedelta(weeks=i)) for i in range(14)]
    folds = expanding_folds(spark.createDataFrame(rows, "k string, date date"), ["k"])
    assert [r.fold for r in folds.orderBy("date").collect()] == [0] * 5 + [1] * 3 + [2] * 3 + [3] * 3


def warp(a, b):
    cost = np.full((len(a) + 1, len(b) + 1), np.inf)
    cost[0, 0] = 0
    for i, x in enumerate(a, 1):
        for j, z in enumerate(b, 1):
            cost[i, j] = (x - z) ** 2 + min(cost[i - 1, j], cost[i, j - 1], cost[i - 1, j - 1])
    return cost[-1, -1] ** 0.5


def test_dtw(spark):
    rng = random.Random(3)
    pairs = [([rng.random() for _ in range(n)], [rng.random() for _ in range(m)]) for n, m in ((8, 8), (5, 9), (1, 4), (30, 30))]
    pairs.append((pairs[0][0], pairs[0][0]))
    df = spark.createDataFrame(pairs, "a array<double>, b array<double>")
    got = [r[0] for r in df.select(dtw(F.col("a"), F.col("b"))).collect()]
    np.testing.assert_allclose(got, [warp(a, b) for a, b in pairs], atol=1e-12)
    assert got[-1] == 0


def test_autocorrelation(series):
    y = series.filter("genre = 'long'").orderBy("date").toPandas().total.to_numpy()
    c = y - y.mean()
    r = np.array([np.sum(c[: len(c) - k] * c[k:]) / np.sum(c * c) for k in range(53)])
    got = acf(series).filter("genre = 'long'").orderBy("lag").toPandas()
    np.testing.assert_allclose(got.acf, r[1:])
    partial = pacf(series).filter("genre = 'long'").orderBy("lag").toPandas().pacf
    for k in (1, 2, 10, 52):
        system = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert partial[k - 1] == pytest.approx(np.linalg.solve(system, r[1 : k + 1])[-1], abs=1e-8)
    short = {r.genre: r.n for r in acf(series).groupBy("genre").agg(F.count("*").alias("n")).collect()}
    assert short == {"long": 52, "gappy": 52, "nine": 3, "eight": 3}


def test_decomposition_adds_up(series):
    got = decompose_additive(resample_weekly_fill0(series, ["genre"])).toPandas()
    assert set(got.genre) == {"long", "gappy"}
    inner = got.dropna()
    assert len(inner) == 2 * (150 - 52)
    np.testing.assert_allclose(inner.trend + inner.seasonal + inner.residual, inner.observed)
    one = got[got.genre == "long"].sort_values("date")
    assert one.seasonal[:52].sum() == pytest.approx(0, abs=1e-6)
    np.testing.assert_allclose(one.seasonal[:52].to_numpy(), one.seasonal[52:104].to_numpy())


def test_overall_lags_of_a_short_series(spark):
    from weekloom.operators.decompose import acf

    rows = [("all", date(2020, 1, 5) + timedelta(weeks=i), float(i % 7)) for i in range(150)]
    df = spark.createDataFrame(rows, "genre string, date date, total double")
    assert [acf(df, overall=o).count() for o in (True, False)] == [74, 52]


def test_tree_rows_know_only_the_past(spark):
    from weekloom.operators.trees import model_rows

    def rows(shift):
        start = date(2020, 1, 5)
        a = [("a", start + timedelta(weeks=i), 100.0 + i % 5 + (shift if i >= 60 else 0)) for i in range(80)]
        b = [("b", start + timedelta(weeks=40 + i), 50.0 + i % 3 + (shift if i >= 20 else 0)) for i in range(70)]
        df = spark.createDataFrame(a + b, "k string, date date, v double")
        return model_rows(df, "rf", ["k"], "date", "v")

    early = "date < date'2021-02-28'"
    before, after = ({(r.k, r.date): r for r in rows(s).where(early).collect()} for s in (0.0, 9000.0))
    assert before == after and len(before) > 60
    spans = rows(0.0).groupBy("k", "fold").agg(F.min("date").alias("lo"), F.max("date").alias("hi"), F.count("*").alias("c")).orderBy("k", "fold").collect()
    assert [(r.k, r.fold, r.c) for r in spans] == [("a", f, c) for f, c in enumerate((18, 18, 18, 18, 8))] + [("b", f, c) for f, c in enumerate((17, 15, 15, 15, 8))]
    assert all(x.hi < y.lo for x, y in zip(spans, spans[1:]) if x.k == y.k)
