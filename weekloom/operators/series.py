"""Regular weekly and monthly grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.dates import month_end, week_end
from weekloom.operators.windows import series_window, whole_series


def fill_missing_weeks(weekly: DataFrame, keys: Sequence[str], date: str = "date", value: str = "total") -> DataFrame:
    """Weekly rows (one per series and week) with the missing weeks added as 0.
    Each row also emits the empty weeks up to its successor: one window pass,
    no calendar table and no join."""
    following = F.lead(date).over(series_window(keys, date))
    return _filled(weekly.withColumn("_next", following), keys, date, value)


def _filled(rows: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Each row and the empty weeks before its ``_next``; null has none."""
    weeks = F.sequence(F.col(date), F.coalesce(F.date_sub("_next", 7), F.col(date)), F.expr("interval 7 days"))
    return rows.select(*keys, value, F.posexplode(weeks).alias("_i", date)).select(
        *keys, date, F.when(F.col("_i") == 0, F.coalesce(value, F.lit(0.0))).otherwise(0.0).alias(value)
    )


def resample_weekly_fill0(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "total") -> DataFrame:
    """Sum per series and Sunday-ending week, weeks without rows as 0, from each
    series' first week to its last."""
    weekly = df.groupBy(*keys, week_end(F.col(date)).alias(date)).agg(F.sum(value).alias(value))
    return fill_missing_weeks(weekly, keys, date, value)


def resample_inferred_fill0(df: DataFrame, keys: Sequence[str], date: str = "date", value: str = "total") -> DataFrame:
    """Sum per series and step, steps without rows as 0.  The step is that of the
    series' own dates where they are at least three, unlike each other, and equally
    far apart in days or, on first or last days of months, in months: such a series
    stays on its dates, whatever its weekday.  Any other series is summed by
    Sunday-ending weeks.  Rows are summed by day first, so the windows that look at a
    series' gaps see no more rows than it has days."""
    keys = list(keys)
    days = df.groupBy(*keys, F.to_date(date).alias(date)).agg(F.sum(value).alias(value), F.count(F.lit(1)).alias("_rows"))
    days = days.filter(F.col(date).isNotNull())
    w, day = series_window(keys, date), F.col(date)
    month = F.year(date) * 12 + F.month(date)
    gaps = days.withColumns({"_gap": F.datediff(day, F.lag(date).over(w)), "_months": month - F.lag(month).over(w)})
    whole = whole_series(keys, date)

    def always(condition: Column) -> Column:
        return F.min(condition.cast("int")).over(whole) == 1

    in_days = F.min("_gap").over(whole) == F.max("_gap").over(whole)
    in_months = (F.min("_months").over(whole) == F.max("_months").over(whole)) & (F.min("_months").over(whole) > 0)
    in_months &= always(F.dayofmonth(date) == 1) | always(day == F.last_day(date))
    regular = (F.count(F.lit(1)).over(whole) >= 3) & (F.max("_rows").over(whole) == 1) & (in_days | in_months)
    stepped = gaps.withColumn("_regular", F.coalesce(regular, F.lit(False)))
    place = F.when(F.col("_regular"), day).otherwise(week_end(day))
    summed = stepped.groupBy(*keys, "_regular", place.alias(date)).agg(F.sum(value).alias(value))
    following = F.when(~F.col("_regular"), F.lead(date).over(series_window(keys, date)))
    return _filled(summed.withColumn("_next", following), keys, date, value)


def asfreq_fill0(df: DataFrame, keys: Sequence[str] = (), date: str = "date", value: str = "total") -> DataFrame:
    """Weekly grid over unique Sunday dates; values off the grid are dropped,
    missing weeks are 0."""
    on_grid = df.filter(F.dayofweek(date) == 1)
    if keys:
        return fill_missing_weeks(on_grid, keys, date, value)
    one = fill_missing_weeks(on_grid.withColumn("_series", F.lit(1)), ["_series"], date, value)
    return one.drop("_series")


def resample_month(df: DataFrame, keys: Sequence[str] = (), date: str = "date", value: str = "total") -> DataFrame:
    """Sum per series and month, dated by the month's last day; months without
    rows inside a series' range are 0."""
    series = list(keys) or ["_series"]
    tagged = df if keys else df.withColumn("_series", F.lit(1))
    monthly = tagged.groupBy(*series, F.trunc(date, "month").alias(date)).agg(F.sum(value).alias(value))
    following = F.lead(date).over(series_window(series, date))
    last = F.coalesce(F.add_months("_next", -1), F.col(date))
    months = F.sequence(F.col(date), last, F.expr("interval 1 month"))
    amount = F.when(F.col("_i") == 0, F.col(value)).otherwise(0.0)
    return (
        monthly.withColumn("_next", following)
        .select(*series, value, F.posexplode(months).alias("_i", date))
        .select(*keys, month_end(F.col(date)).alias(date), amount.alias(value))
    )
