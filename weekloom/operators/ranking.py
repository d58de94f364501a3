"""Sorts and top-n.  ``orderBy(...).limit(n)`` keeps n rows per task
(``TakeOrderedAndProject``); nothing is sorted as a whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_GENRES = 10
TOP_SERIES = 200


def sort_series(df: DataFrame, keys: Sequence[str] = (), date: str = "date", within_tasks: bool = False) -> DataFrame:
    """By series and date; ``within_tasks`` sorts each partition where it lies,
    for sinks that need no global order."""
    order = [*keys, date]
    return df.sortWithinPartitions(*order) if within_tasks else df.orderBy(*order)


def topn_genres(totals: DataFrame, n: int = TOP_GENRES, group: str = "genre", metric: str = "total") -> DataFrame:
    """The ``n`` largest groups, or all when there are fewer."""
    return totals.orderBy(F.desc(metric), group).limit(n)


def topn_series(lengths: DataFrame, n: int | None = TOP_SERIES, keys: Sequence[str] = ("artist", "song")) -> DataFrame:
    """The ``n`` longest series; ``None`` keeps all."""
    return lengths if n is None else lengths.orderBy(F.desc("n"), *keys).limit(n)


def nlargest_labels(counts: DataFrame, n: int = 5, label: str = "label") -> DataFrame:
    return counts.orderBy(F.desc("n"), label).limit(n)


def model_order_in_group(
    metrics: DataFrame, group: str = "genre", metric: str = "mae", ties: Sequence[str] = ("model",)
) -> DataFrame:
    """Place of each model within its group, best first.  A group has one row
    per model."""
    w = Window.partitionBy(group).orderBy(F.asc_nulls_last(metric), *ties)
    return metrics.withColumn("place", F.row_number().over(w))


def sort_metric(df: DataFrame, metric: str, descending: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(metric) if descending else F.asc_nulls_last(metric), *ties)
