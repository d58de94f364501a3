"""Forecasts of every series in one job.

Input is one row per (series, week).  Horizon forecasts and walk-forward
predictions are window expressions over one shuffle by series; only the two
fitted models (``seasonal_ar``, ``grid_tuned_trend_season``) enter Python, one
series per call, and a series is never longer than the calendar.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from weekloom.operators.scoring import mape
from weekloom.session import spread
from weekloom.operators.windows import TEST_WEEKS, holdout_last_n, min_history_gate, series_window, whole_series

# The fit functions travel with their task: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Moving-average windows that are compared.
MA_WINDOWS = (2, 3, 4, 6, 8, 12)

Predictor = Callable[[str, WindowSpec, WindowSpec], Column]


def _test_rows(df: DataFrame, keys: Sequence[str], date: str, value: str, *extra: str) -> DataFrame:
    return df.filter("is_test").select(*keys, date, *extra, F.col(value).alias("actual"), "predicted")


def naive_last(
    df: DataFrame, keys: Sequence[str] = ("genre",), date: str = "date", value: str = "total",
    test_weeks: int = TEST_WEEKS,
) -> DataFrame:
    """The last training value for every test week."""
    split = min_history_gate(holdout_last_n(df, keys, date, test_weeks), "naive", test_weeks)
    last = F.max_by(value, F.when(~F.col("is_test"), F.col(date))).over(whole_series(keys, date))
    return _test_rows(split.withColumn("predicted", last), keys, date, value)


def moving_average(
    df: DataFrame, windows: Sequence[int] = MA_WINDOWS, keys: Sequence[str] = ("genre",), date: str = "date",
    value: str = "total", test_weeks: int = TEST_WEEKS,
) -> DataFrame:
    """Mean of the last ``w`` training values for every test week, for all
    windows at once."""
    split = holdout_last_n(df, keys, date, test_weeks)
    all_rows = whole_series(keys, date)
    from_end = F.col("n") - test_weeks - F.col("rn")  # 0 is the last training row
    means = {f"_ma_{w}": F.avg(F.when(from_end.between(0, w - 1), F.col(value))).over(all_rows) for w in windows}
    options = F.array(*[F.struct(F.lit(w).alias("ma_window"), F.col(f"_ma_{w}").alias("predicted")) for w in windows])
    long = split.withColumns(means).filter("is_test").select(*keys, date, value, "n", "is_test", F.inline(options))
    gated = min_history_gate(long, "ma", test_weeks, F.col("ma_window"))
    return _test_rows(gated, keys, date, value, "ma_window")


def tune_ma_window(forecasts: DataFrame, keys: Sequence[str] = ("genre",)) -> DataFrame:
    """Forecasts of the one window with the lowest mean MAPE over all series
    (the smaller window on a tie)."""
    per_series = forecasts.groupBy(*keys, "ma_window").agg(mape().alias("mape"))
    per_window = per_series.groupBy("ma_window").agg(F.avg("mape").alias("m"))
    best = per_window.filter(F.col("m").isNotNull()).agg(F.min_by("ma_window", F.struct("m", "ma_window"))).scalar()
    return forecasts.filter(F.col("ma_window") == best)


def walk_forward_one_step(
    df: DataFrame, predictor: Predictor, keys: Sequence[str] = ("genre",), date: str = "date",
    value: str = "total", test_weeks: int = TEST_WEEKS, family: str = "sarima",
) -> DataFrame:
    """One-step forecasts of the test weeks.  ``predictor`` sees, for each row,
    the series window and the frame of all earlier rows; that frame is the
    refit after every true value.  Where it gives null the last value stands in."""
    w = series_window(keys, date)
    history = w.rowsBetween(Window.unboundedPreceding, -1)
    steps = (
        holdout_last_n(df, keys, date, test_weeks)
        .withColumns({"x1": F.lag(value, 1).over(w), "x2": F.lag(value, 2).over(w)})
        .withColumn("predicted", F.coalesce(predictor(value, w, history), F.col("x1"), F.lit(0.0)))
    )
    return _test_rows(min_history_gate(steps, family, test_weeks), keys, date, value)


def drift(value: str, w: WindowSpec, history: WindowSpec) -> Column:
    """Last value plus the mean change so far."""
    return F.col("x1") + F.avg(F.col("x1") - F.col("x2")).over(w.rowsBetween(Window.unboundedPreceding, 0))


def ar1_on_differences(value: str, w: WindowSpec, history: WindowSpec) -> Column:
    """First-order autoregression of the weekly changes, refitted on all
    earlier changes."""
    change, before = F.col(value) - F.col("x1"), F.col("x1") - F.col("x2")
    slope = F.regr_slope(change, before).over(history)
    intercept = F.regr_intercept(change, before).over(history)
    return F.col("x1") + intercept + slope * before


def autoregressive_forecast(df: DataFrame, **kw) -> DataFrame:
    """Walk-forward forecast by :func:`ar1_on_differences`, no Python involved."""
    return walk_forward_one_step(df, ar1_on_differences, **kw)


# --- fitted models: one series per Python call ------------------------------

SEASON = 52
# Largest (p, q, P, Q) of the order search.
MAX_ORDER = (2, 1, 1, 1)


# Terms of the regression in the order of its matrix; the last is the value itself.
_TERMS = ("p1", "p2", "P1", "q1", "Q1", "c")
#: A pivot below this share of its diagonal is no pivot: the terms are collinear.
_PIVOT = 1e-9


def arma_orders() -> list[tuple[tuple[int, ...], str]]:
    """(terms, order text) of every combination; the text lacks the difference."""
    out = []
    for p, q, sp, sq, const in product(*[range(m + 1) for m in (*MAX_ORDER, 1)]):
        names = ["p1", "p2"][:p] + ["q1"] * q + ["P1"] * sp + ["Q1"] * sq + ["c"] * const
        out.append((tuple(_TERMS.index(t) for t in names), f"({p},%d,{q}),({sp},0,{sq},%d)"))
    return out


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _matrix(rows: list[list[str]]) -> Column:
    """Rows of SQL expressions; one parsed text, since a call for each cell is slow to build."""
    return F.expr("array(" + ", ".join("array(" + ", ".join(row) + ")" for row in rows) + ")")


def solved(augmented: Column) -> Column:
    """Solution of the linear system whose rows are (coefficients, right side), by
    elimination; null where a row depends on the rows before it."""

    def step(state: Column, k: Column) -> Column:
        rows, diagonal = state["rows"], state["diagonal"]
        pivot_row = F.get(rows, k)
        pivot = F.get(pivot_row, k)
        usable = F.when(F.abs(pivot) > _PIVOT * F.abs(F.get(diagonal, k)), pivot)
        scaled = F.transform(pivot_row, lambda x: x / usable)
        cleared = F.transform(rows, lambda row, i: F.when(i == k, scaled).otherwise(F.zip_with(row, scaled, lambda x, s: x - F.get(row, k) * s)))
        return F.struct(cleared.alias("rows"), diagonal.alias("diagonal"))

    diagonal = F.transform(augmented, lambda row, i: F.get(row, i))
    start = F.struct(augmented.alias("rows"), diagonal.alias("diagonal"))
    places = F.when(F.size(augmented) > 0, F.sequence(F.lit(0), F.size(augmented) - 1)).otherwise(F.array().cast("array<int>"))
    done = F.aggregate(places, start, step, lambda s: s["rows"])
    return F.transform(done, lambda row: F.element_at(row, -1))


def seasonal_ar(
    df: DataFrame, keys: Sequence[str] = ("genre",), date: str = "date", value: str = "total",
    test_weeks: int = TEST_WEEKS, season: int = SEASON,
) -> DataFrame:
    """Walk-forward one-step forecasts by a seasonal ARMA whose orders are searched
    anew at every step: of the least-squares fits to the history or to its changes
    the one with the lowest BIC; the last value where no fit succeeds.

    Shocks for the moving-average terms are the residuals of an autoregression of
    four lags.  Running sums of the products of lagged values, over all earlier weeks,
    hold everything a step needs: the autoregression is solved from them, its
    coefficients turn the sums into the matrix of all terms, and every order is a
    part of that matrix.  So each test week is one row, no history is read again, and
    nothing leaves the JVM."""
    keys = list(keys)
    ready = min_history_gate(holdout_last_n(df, keys, date, test_weeks), "sarima", test_weeks)
    w = series_window(keys, date)
    lagged = ready.withColumn("_y", F.col(value).cast("double")).withColumn("_before", F.lag("_y", 1).over(w))
    both = lagged.withColumn("d", F.explode(F.array(F.lit(0), F.lit(1))))
    both = both.withColumn("x", F.when(F.col("d") == 0, F.col("_y")).otherwise(F.col("_y") - F.col("_before")))
    w = Window.partitionBy(*keys, "d").orderBy(date)
    far = [season + k for k in range(5)]
    lags = both.withColumns({f"x{k}": F.lag("x", k).over(w) for k in [1, 2, 3, 4, 5, *far]})
    # the shock a season ago is known once its own four lags are; before that it is 0
    known = F.when(F.col("rn") - season - 4 > F.col("d"), F.lit(1.0)).otherwise(0.0)
    lags = lags.withColumn("_known", known)
    near = [F.coalesce(F.col(f"x{k}"), F.lit(0.0)) for k in (1, 2, 3, 4, 5)]
    # 0: the value, 1-5: last values, 6: a season ago, 7-11: the same and before where the shock is known, 12, 13: ones
    parts = [F.col("x"), *near, F.coalesce(F.col(f"x{season}"), F.lit(0.0))]
    parts += [F.col("_known") * F.coalesce(F.col(f"x{k}"), F.lit(0.0)) for k in far] + [F.col("_known"), F.lit(1.0)]
    lags = lags.withColumn("v", F.array(*parts))
    history = w.rowsBetween(Window.unboundedPreceding, -1)
    in_ar, in_arma = "rn - 4 > d", f"rn > {season + 1}"
    ar = [1, 2, 3, 4, 13, 0]
    pairs = [(i, j) for i in range(14) for j in range(i, 14)]

    def running(name: str, use: str, i: int, j: int) -> Column:
        return F.expr(f"sum(CASE WHEN {use} THEN v[{i}] * v[{j}] END)").over(history).alias(f"{name}_{i}_{j}")

    sums = [running("a", in_ar, *sorted((i, j))) for k, i in enumerate(ar) for j in ar[k:]] + [running("w", in_arma, i, j) for i, j in pairs]
    steps = lags.select(*keys, date, "d", "rn", "is_test", "_y", "_before", "v", F.count_if(F.expr(in_arma)).over(history).alias("m"), *sums).filter("is_test")

    def cell(name: str, i: int, j: int) -> str:
        return f"{name}_{min(i, j)}_{max(i, j)}"

    system = _matrix([[cell("a", i, j) for j in ar] for i in ar[:-1]])
    steps = steps.withColumns({"b": solved(system), "sums": _matrix([[cell("w", i, j) for j in range(14)] for i in range(14)])})
    one, b = "1D", [f"-get(b, {k})" for k in range(5)]

    def row(**at: str) -> list[str]:
        return [at.get(f"i{k}", "0D") for k in range(14)]

    shock = row(i1=one, i2=b[0], i3=b[1], i4=b[2], i5=b[3], i13=b[4])
    old_shock = row(i7=one, i8=b[0], i9=b[1], i10=b[2], i11=b[3], i12=b[4])
    terms = _matrix([row(i1=one), row(i2=one), row(i6=one), shock, old_shock, row(i13=one), row(i0=one)])
    steps = steps.withColumn("terms", terms)
    half = F.transform("terms", lambda t: F.transform("sums", lambda s: _dot(s, t)))
    steps = steps.withColumn("half", half).withColumn("full", F.transform("terms", lambda t: F.transform("half", lambda h: _dot(t, h))))
    steps = steps.select(*keys, date, "d", "_y", "_before", "m", "full", F.transform("terms", lambda t: _dot(t, F.col("v"))).alias("now"))

    orders = arma_orders()
    texts = [f"named_struct('k', {k}, 'terms', cast(array({', '.join(map(str, t))}) AS array<int>), 'text', '{text}')" for k, (t, text) in enumerate(orders)]
    listed = F.expr("array(" + ", ".join(texts) + ")")
    # few rows that cost much: dealt to all tasks before they become one for each order
    fits = spread(steps, F.xxhash64(*keys, date, "d")).select("*", F.inline(listed))
    last = len(_TERMS)
    system = F.transform("terms", lambda i: F.concat(F.transform("terms", lambda j: F.get(F.get("full", i), j)), F.array(F.get(F.get("full", i), F.lit(last)))))
    fits = fits.withColumn("beta", solved(system))
    square = F.get(F.get("full", F.lit(last)), F.lit(last))
    explained = _dot(F.col("beta"), F.transform("terms", lambda i: F.get(F.get("full", i), F.lit(last))))
    rss = F.greatest(square - explained, square * 1e-12 + 1e-300)
    step = _dot(F.col("beta"), F.transform("terms", lambda i: F.get("now", i)))
    size = F.col("m").cast("double")
    fits = fits.withColumns({"bic": size * F.log(rss / size) + F.log(size) * F.size("terms"), "step": step})
    best = F.min(F.when(F.col("bic").isNotNull(), F.struct("bic", "d", "k", "step", "text")))
    chosen = fits.groupBy(*keys, date).agg(best.alias("best"), F.first("_y").alias("actual"), F.first("_before").alias("_last"))
    predicted = F.when(F.col("best.d") == 1, F.col("_last") + F.col("best.step")).otherwise(F.col("best.step"))
    order = F.when(F.col("best").isNull(), F.lit("N/A")).otherwise(F.printf(F.col("best.text"), F.col("best.d"), F.lit(season)))
    return chosen.select(*keys, date, order.alias("sarima_order"), "actual", F.coalesce(predicted, F.col("_last")).alias("predicted"))


# The tuning grid of the trend-and-season model.
CHANGEPOINT_SCALES = (0.01, 0.05, 0.1, 0.5)
SEASONALITY_SCALES = (0.1, 1.0, 10.0, 20.0)
SEASONALITY_MODES = ("additive", "multiplicative")
_YEAR, _WEEK = (365.25, 10), (7.0, 3)  # period in days, Fourier order
_CHANGEPOINTS = 25
_NOISE = 0.25  # variance of the scaled series that the priors are weighed against


def _trend_basis(t: np.ndarray, knots: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - knots[None, :], 0.0)])


def _season_basis(days: np.ndarray) -> np.ndarray:
    angles = [2 * np.pi * k * days / period for period, order in (_YEAR, _WEEK) for k in range(1, order + 1)]
    return np.column_stack([f(a) for a in angles for f in (np.sin, np.cos)])


def _ridge(x: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ y)


def _trend_season(
    days: np.ndarray, y: np.ndarray, future: np.ndarray, changepoint: float, season: float, mode: str
) -> np.ndarray:
    """Piecewise-linear trend with Fourier seasonality by ridge regression; the
    two prior scales are the widths of the penalties."""
    scale = float(np.max(np.abs(y))) or 1.0
    start, span = days[0], float(days[-1] - days[0]) or 1.0
    t, tf = (days - start) / span, (future - start) / span
    knots = np.linspace(0, 0.8, min(_CHANGEPOINTS, max(len(y) // 2, 1)) + 1)[1:]
    trend_x, season_x, target = _trend_basis(t, knots), _season_basis(days), y / scale
    trend_pen = np.r_[1e-8, 1e-8, np.full(len(knots), _NOISE / changepoint**2)]
    season_pen = np.full(season_x.shape[1], _NOISE / season**2)
    fx, fs = _trend_basis(tf, knots), _season_basis(future)
    if mode == "multiplicative":
        level = _ridge(trend_x, target, trend_pen)
        season_x, fs = season_x * (trend_x @ level)[:, None], fs * (fx @ level)[:, None]
    beta = _ridge(np.hstack([trend_x, season_x]), target, np.r_[trend_pen, season_pen])
    return np.hstack([fx, fs]) @ beta * scale


def _percent_error(actual: np.ndarray, predicted: np.ndarray) -> float:
    counted = actual != 0
    return float(np.mean(np.abs((actual - predicted)[counted] / actual[counted]))) if counted.any() else np.inf


def grid_tuned_trend_season(
    df: DataFrame, keys: Sequence[str] = ("genre",), date: str = "date", value: str = "total",
    test_weeks: int = TEST_WEEKS, tune_on: str = "train_tail",
) -> DataFrame:
    """Multi-step forecast by the best of 32 parameter combinations per series.

    Works on the rows as they are (a missing week stays missing).  Combinations
    are compared by MAPE on the last training weeks, or on the test weeks
    themselves with ``tune_on="test"``; the best one is fitted to the whole
    training part."""
    keys = list(keys)
    ready = min_history_gate(holdout_last_n(df, keys, date, test_weeks), "prophet", test_weeks)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        y = pdf[value].fillna(0).to_numpy(dtype=float)
        days = pd.to_datetime(pdf[date]).to_numpy().astype("datetime64[D]").astype(float)
        cut = len(y) - test_weeks
        end = cut - test_weeks if tune_on == "train_tail" else cut

        def forecast(upto: int, params: tuple) -> np.ndarray:
            return _trend_season(days[:upto], y[:upto], days[upto : upto + test_weeks], *params)

        grid = list(product(CHANGEPOINT_SCALES, SEASONALITY_SCALES, SEASONALITY_MODES))
        errors = [_percent_error(y[end : end + test_weeks], forecast(end, params)) for params in grid]
        best = grid[int(np.argmin(errors))]
        out = pdf.iloc[cut:][[*keys, date]].copy()
        out["best_params"] = "changepoint={}, seasonality={}, mode={}".format(*best)
        out["actual"] = y[cut:]
        out["predicted"] = forecast(cut, best)
        return out

    types = dict(ready.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in [*keys, date]) + ", best_params string, actual double, predicted double"
    return spread(ready.select(*keys, date, value), *keys).groupBy(*keys).applyInPandas(fit, schema)
