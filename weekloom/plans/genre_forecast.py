"""Group-level weekly series to scored forecasts of every model family.

``series`` has one row per (genre, week)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators.aggregates import total_per_group
from weekloom.operators.forecast import (
    autoregressive_forecast,
    grid_tuned_trend_season,
    moving_average,
    naive_last,
    seasonal_ar,
    tune_ma_window,
)
from weekloom.operators.joins import top_semi
from weekloom.operators.ranking import TOP_GENRES, topn_genres
from weekloom.operators.reshape import union_by_name
from weekloom.operators.scoring import evaluate_forecast
from weekloom.operators.series import fill_missing_weeks


def leading_series(series: DataFrame, n: int | None = TOP_GENRES) -> DataFrame:
    """Series of the ``n`` groups with the largest totals; ``None`` keeps all."""
    if n is None:
        return series
    return top_semi(series, topn_genres(total_per_group(series), n))


def naive_report(series: DataFrame, n: int = TOP_GENRES) -> DataFrame:
    """Which groups lead, and how well does the last value forecast them?"""
    forecast = naive_last(fill_missing_weeks(leading_series(series, n), ["genre"]))
    return evaluate_forecast(forecast, ["genre"])


def all_forecasts(series: DataFrame, n: int | None = TOP_GENRES, fitted: bool = True) -> DataFrame:
    """(genre, date, model, actual, predicted) of all group-level families."""
    raw = leading_series(series, n)
    grid = fill_missing_weeks(raw, ["genre"])
    parts = {
        "Naive": naive_last(grid),
        "MovingAverage": tune_ma_window(moving_average(grid)),
        "Autoregression": autoregressive_forecast(grid),
    }
    if fitted:
        parts |= {"SARIMA": seasonal_ar(grid), "Prophet": grid_tuned_trend_season(raw)}
    return union_by_name(
        *[df.select("genre", "date", F.lit(name).alias("model"), "actual", "predicted") for name, df in parts.items()]
    )
