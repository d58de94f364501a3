"""Row filters and first-row selection."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions.dates import parse_date


def drop_bad_dates(df: DataFrame, date: str, out: str | None = None) -> DataFrame:
    """Rows whose date parses, with the parsed date."""
    return df.withColumn(out or date, parse_date(F.col(date)).cast("date")).filter(F.col(out or date).isNotNull())


def drop_empty_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all neither null nor empty."""
    return df.filter(reduce(and_, [F.col(k) != "" for k in keys]))


def positive_metric(df: DataFrame, metric: str) -> DataFrame:
    """Rows with a metric above zero.  Apply it after lag features: dropping
    rows earlier would shift them."""
    return df.filter(F.col(metric) > 0)


def membership_filter(df: DataFrame, label: str, labels: str = "genres") -> DataFrame:
    """Rows that carry a label."""
    return df.filter(F.array_contains(labels, label))


def series_filter(
    df: DataFrame, artist: str, song: str, target: str = "spotify_streams", date: str = "date"
) -> DataFrame:
    """One track's series; empty when the track is unknown."""
    return df.filter((F.col("artist") == artist) & (F.col("song") == song)).select(date, target)


def drop_null_key(df: DataFrame, key: str = "genre") -> DataFrame:
    return df.dropna(subset=[key])


def complete_case(df: DataFrame, metrics: list[str]) -> DataFrame:
    return df.dropna(subset=metrics)


def cutoff_from_model(df: DataFrame, model: str = "SARIMA", model_col: str = "model", date: str = "date") -> DataFrame:
    """Rows from the model's first date on; all rows when the model is absent."""
    first = df.filter(F.col(model_col) == model).agg(F.min(date)).scalar()
    return df.filter(first.isNull() | (F.col(date) >= first))


def count_all_null_rows(df: DataFrame, features: list[str]) -> DataFrame:
    """How many rows have no feature at all."""
    empty = reduce(and_, [F.col(c).isNull() for c in features])
    return df.agg(F.count_if(empty).alias("empty_rows"), F.count(F.lit(1)).alias("rows"))


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key in an explicit order.  ``row_number() = 1`` lets Spark
    keep one row per key in every map task before the shuffle
    (``WindowGroupLimit``), so a key with very many copies stays cheap."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
