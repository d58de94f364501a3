"""Forecast errors and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.operators.joins import top_semi
from weekloom.operators.ranking import model_order_in_group
from weekloom.operators.reshape import melt, wide_to_series_list


def mae(actual: str | Column = "actual", predicted: str | Column = "predicted") -> Column:
    return F.avg(F.abs(_error(actual, predicted)))


def rmse(actual: str | Column = "actual", predicted: str | Column = "predicted") -> Column:
    error = _error(actual, predicted)
    return F.sqrt(F.avg(error * error))


def mape(actual: str | Column = "actual", predicted: str | Column = "predicted") -> Column:
    """Percent; rows with actual 0 do not count, null when none is left."""
    actual = F.col(actual) if isinstance(actual, str) else actual
    return 100 * F.avg(F.abs(_error(actual, predicted) / F.nullif(actual, F.lit(0.0))))


def _error(actual: str | Column, predicted: str | Column) -> Column:
    actual = F.col(actual) if isinstance(actual, str) else actual
    predicted = F.col(predicted) if isinstance(predicted, str) else predicted
    return actual - predicted


def evaluate_forecast(
    df: DataFrame, by: Sequence[str] = ("genre",), actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """MAE, RMSE and MAPE per group in one aggregation."""
    return df.groupBy(*by).agg(
        mae(actual, predicted).alias("mae"), rmse(actual, predicted).alias("rmse"), mape(actual, predicted).alias("mape")
    )


def dtw(a: Column, b: Column) -> Column:
    """Dynamic-time-warping distance of two arrays: root of the least summed
    squared difference over all monotone alignments.  One row of the cost table
    is folded at a time, so only that row is kept."""
    inf = F.lit(float("inf"))
    start = F.concat(F.array(F.lit(0.0)), F.array_repeat(inf, F.size(b)))

    def next_row(previous: Column, x: Column) -> Column:
        def cell(row: Column, j: Column) -> Column:
            gap = x - F.get(b, j - 1)
            return F.array_append(row, gap * gap + F.least(F.get(previous, j), F.get(previous, j - 1), F.get(row, j - 1)))

        return F.aggregate(F.sequence(F.lit(1), F.size(b)), F.array(inf), cell)

    return F.sqrt(F.element_at(F.aggregate(a, start, next_row), -1))


def dtw_distance(df: DataFrame, by: Sequence[str] = ("genre", "model"), **columns) -> DataFrame:
    """Distance between actual and predicted values of each (group, model)."""
    lists = wide_to_series_list(df, by, **columns)
    return lists.select(*by, dtw(F.col("actual"), F.col("predicted")).alias("dtw_distance"))


def metric_grid(
    metrics: DataFrame, shown: Sequence[str] = ("rmse", "mae"), order_by: str = "mae",
    group: str = "genre", model: str = "model",
) -> DataFrame:
    """Long metric table of the groups that every model covers, each model with
    its place in the group."""
    from weekloom.operators.aggregates import complete_groups
    from weekloom.operators.rows import complete_case

    complete = complete_case(metrics, sorted({*shown, order_by}))
    covered = top_semi(complete, complete_groups(complete, group, model), group)
    placed = model_order_in_group(covered, group, order_by, [model])
    return melt(placed.select(group, model, "place", *shown), [group, model, "place"], shown)


def actual_vs_predicted(
    df: DataFrame, models: Sequence[str], group: str = "genre", date: str = "date", model: str = "model"
) -> DataFrame:
    """One row per (group, date): the actual value and one column per model."""
    picked = [F.max(F.when(F.col(model) == m, F.col("predicted"))).alias(m) for m in models]
    return df.groupBy(group, date).agg(F.max("actual").alias("actual"), *picked)
