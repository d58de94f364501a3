"""Window features of weekly series.

Every window here is partitioned by series and ordered by week.  Its input has
one row per (series, week), so a partition is never longer than the calendar,
however many raw rows a series had.  ``weekly_grain`` makes that so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from weekloom.functions.dates import calendar_parts

LAGS = (1, 2, 4, 8)
ROLLS = (4, 8)
MODEL_LAGS = (1, 2, 4, 8, 12)
MODEL_ROLLS = (4, 8, 12)
TEST_WEEKS = 8

# Least number of rows per series for each model family, as
# (rows in all, rows left for training).
MIN_HISTORY = {
    "sarima": (112, 52),
    "prophet": (60, 2),
    "naive": (9, 1),
    "ma": (8, 0),  # plus the window on both
    "rf": (13, 5),
    "lgbm": (9, 4),
}


def weekly_grain(df: DataFrame, keys: Sequence[str], date: str, metric: str) -> DataFrame:
    """Sum per (series, week); combines map-side and bounds every series."""
    return df.groupBy(*keys, date).agg(F.sum(metric).alias(metric))


def series_window(keys: Sequence[str], date: str = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(date)


def whole_series(keys: Sequence[str], date: str = "date") -> WindowSpec:
    """All rows of the series, in the same order as the other windows so that
    one sort serves them all."""
    return series_window(keys, date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def lag_columns(metric: str, w: WindowSpec, lags: Sequence[int] = LAGS) -> dict[str, Column]:
    """Value ``k`` rows (not weeks) earlier in the series."""
    return {f"{metric}_lag_{k}": F.lag(metric, k).over(w) for k in lags}


def _trailing(w: WindowSpec, size: int, shift: int) -> WindowSpec:
    return w.rowsBetween(-(size - 1) - shift, -shift)


def roll_mean_columns(metric: str, w: WindowSpec, sizes: Sequence[int] = ROLLS, shift: int = 0) -> dict[str, Column]:
    """Trailing mean over up to ``size`` rows, the current one included unless
    ``shift`` moves the frame back (use 1 for models that predict it)."""
    return {f"{metric}_roll_mean_{n}": F.avg(metric).over(_trailing(w, n, shift)) for n in sizes}


def roll_std_columns(metric: str, w: WindowSpec, sizes: Sequence[int] = ROLLS, shift: int = 0) -> dict[str, Column]:
    """Trailing sample deviation, null for a single row."""
    return {f"{metric}_roll_std_{n}": F.stddev_samp(metric).over(_trailing(w, n, shift)) for n in sizes}


def add_time_series_features(
    df: DataFrame, *, date_col: str = "date", metric_col: str = "spotify_streams",
    id_cols: Sequence[str] = ("artist", "song"), lag_windows: Sequence[int] = LAGS,
    roll_windows: Sequence[int] = ROLLS, shift: int = 0,
) -> DataFrame:
    """Calendar parts, lags and trailing statistics in one projection over one
    sort.  A missing metric counts as 0."""
    dated = df.withColumns({date_col: F.to_date(date_col), metric_col: F.coalesce(metric_col, F.lit(0))})
    w = series_window(id_cols, date_col)
    return dated.withColumns(
        calendar_parts(F.col(date_col))
        | lag_columns(metric_col, w, lag_windows)
        | roll_mean_columns(metric_col, w, roll_windows, shift)
        | roll_std_columns(metric_col, w, roll_windows, shift)
    )


def with_position(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """``rn`` (1-based place in the series) and ``n`` (its length)."""
    return df.withColumns(
        {
            "rn": F.row_number().over(series_window(keys, date)),
            "n": F.count(F.lit(1)).over(whole_series(keys, date)),
        }
    )


def holdout_last_n(df: DataFrame, keys: Sequence[str], date: str = "date", n: int = TEST_WEEKS) -> DataFrame:
    """Marks the last ``n`` rows of each series with ``is_test``."""
    return with_position(df, keys, date).withColumn("is_test", F.col("rn") > F.col("n") - n)


def min_history_gate(
    df: DataFrame, family: str, test_weeks: int = TEST_WEEKS, extra: int | Column = 0
) -> DataFrame:
    """Rows of series long enough for a model family (needs ``n``)."""
    total, train = MIN_HISTORY[family]
    extra = F.lit(extra) if isinstance(extra, int) else extra
    return df.filter((F.col("n") >= total + extra) & (F.col("n") - test_weeks >= train + extra))


def centered_ma(metric: str, keys: Sequence[str], date: str = "date", period: int = 52) -> Column:
    """Centred moving average of a full period, the two edge rows of an even
    period at half weight; null where the frame is cut."""
    w = series_window(keys, date)
    half = period // 2
    frame = w.rowsBetween(-half, half)
    total = F.sum(metric).over(frame)
    if period % 2 == 0:
        total = total - (F.lag(metric, half).over(w) + F.lead(metric, half).over(w)) / 2
    return F.when(F.count(metric).over(frame) == 2 * half + 1, total / period)


def fold_of(rn: Column, n: Column, splits: int = 3) -> Column:
    """Fold of row ``rn`` of ``n``: 0 is only ever trained on; fold ``i`` is scored by a
    model trained on the folds below ``i``.  Test folds have ``n // (splits+1)``
    rows, the first part takes the rest."""
    size = F.floor(n / (splits + 1))
    first_test = n - splits * size
    return F.when(rn <= first_test, F.lit(0)).otherwise(F.floor((rn - first_test - 1) / size) + 1).cast("int")


def expanding_folds(df: DataFrame, keys: Sequence[str], date: str = "date", splits: int = 3) -> DataFrame:
    """``fold`` of each row of its series (see :func:`fold_of`)."""
    return with_position(df, keys, date).withColumn("fold", fold_of(F.col("rn"), F.col("n"), splits))
