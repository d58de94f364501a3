"""Seasonal decomposition and autocorrelation of every series at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.columns import computed_once
from weekloom.operators.windows import centered_ma, whole_series, with_position
from weekloom.session import spread

PERIOD = 52
ACF_LAGS = 52
ACF_LAGS_OVERALL = 104


def decompose_additive(
    df: DataFrame, keys: Sequence[str] = ("genre",), date: str = "date", value: str = "total", period: int = PERIOD
) -> DataFrame:
    """Trend, seasonal and residual part of series with two full periods."""
    placed = (
        with_position(df, keys, date)
        .withColumn("trend", centered_ma(value, keys, date, period))
        .filter(F.col("n") >= 2 * period)
        .withColumn("phase", (F.col("rn") - 1) % period)
        .withColumn("detrended", F.col(value) - F.col("trend"))
    )
    by_phase = Window.partitionBy(*keys, "phase")
    phase_mean = F.avg("detrended").over(by_phase)
    # The mean over phases: every phase counts once, taken from its first row.
    centre = F.avg(F.when(F.col("rn") <= period, F.col("phase_mean"))).over(whole_series(keys, date))
    return (
        placed.withColumn("phase_mean", phase_mean)
        .withColumn("seasonal", F.col("phase_mean") - centre)
        .select(
            *keys, date, F.col(value).alias("observed"), "trend", "seasonal",
            (F.col("detrended") - F.col("seasonal")).alias("residual"),
        )
    )


def usable_lags(n: Column, lags: int) -> Column:
    """Lag count for a series of ``n`` points; short series get fewer."""
    return F.when(n >= lags + 5, F.lit(lags)).otherwise(F.greatest(F.lit(1), F.floor(n / 2) - 1)).cast("int")


def overall_lags(n: Column, lags: int = ACF_LAGS_OVERALL) -> Column:
    """Lag count for one overall series: up to two years, below half its length."""
    return F.least(F.lit(lags), F.floor(n / 2) - 1).cast("int")


def acf_arrays(
    df: DataFrame, keys: Sequence[str] = ("genre",), date: str = "date", value: str = "total", lags: int = ACF_LAGS,
    overall: bool = False,
) -> DataFrame:
    """Per series ``n``, ``lags`` and ``acf`` (lag 0 first).  A weekly series is
    an array no longer than the calendar; products with its own shifts are
    array functions on it."""
    points = F.array_sort(F.collect_list(F.struct(F.col(date), F.col(value).cast("double").alias("v"))))
    series = spread(df.select(*keys, date, value), *keys).groupBy(*keys).agg(
        points.alias("_p"),
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("_mean"),
        (F.var_pop(value) * F.count(value)).alias("_s0"),
    )
    used = overall_lags(F.col("n")) if overall else usable_lags(F.col("n"), lags)
    centred = computed_once(
        series, _c=F.transform("_p", lambda p: p["v"] - F.col("_mean")), lags=used, _len=F.col("n").cast("int")
    )

    def at_lag(k: Column) -> Column:
        products = F.zip_with("_c", F.slice("_c", k + 1, F.col("_len")), lambda a, b: a * b)
        total = F.aggregate(products, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
        return total / F.nullif(F.col("_s0"), F.lit(0.0))

    return centred.filter(F.col("n") >= F.col("lags") + 2).select(
        *keys, "n", "lags", F.transform(F.sequence(F.lit(0), F.col("lags")), at_lag).alias("acf")
    )


def acf(df: DataFrame, keys: Sequence[str] = ("genre",), **kw) -> DataFrame:
    """Autocorrelation as (series, lag, acf) rows from lag 1 on."""
    arrays = acf_arrays(df, keys, **kw)
    return arrays.select(*keys, F.posexplode("acf").alias("lag", "acf")).filter("lag > 0")


def pacf_of(r: Column) -> Column:
    """Partial autocorrelations (lag 1 first) of an autocorrelation array that
    starts at lag 0: the Yule-Walker equations solved order by order."""
    state = F.struct(
        F.array().cast("array<double>").alias("phi"),
        F.lit(1.0).alias("v"),
        F.array().cast("array<double>").alias("out"),
    )

    def step(s: Column, k: Column) -> Column:
        phi = s["phi"]
        known = F.aggregate(
            F.sequence(F.lit(1), k), F.lit(0.0),
            lambda total, j: total + F.coalesce(F.get(phi, j - 1) * F.get(r, k - j), F.lit(0.0)),
        )
        new = (F.get(r, k) - known) / F.nullif(s["v"], F.lit(0.0))
        shrunk = F.zip_with(phi, F.reverse(phi), lambda a, b: a - new * b)
        return F.struct(
            F.array_append(shrunk, new).alias("phi"),
            (s["v"] * (1 - new * new)).alias("v"),
            F.array_append(s["out"], new).alias("out"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), state, step)["out"]


def pacf(df: DataFrame, keys: Sequence[str] = ("genre",), **kw) -> DataFrame:
    """Partial autocorrelation as (series, lag, pacf) rows from lag 1 on."""
    arrays = computed_once(acf_arrays(df, keys, **kw), _r=F.col("acf"))
    return arrays.select(*keys, F.posexplode(pacf_of(F.col("_r"))).alias("pos", "pacf")).select(
        *keys, (F.col("pos") + 1).alias("lag"), "pacf"
    )
