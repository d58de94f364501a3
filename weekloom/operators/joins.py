"""Joins.  No join carries a broadcast hint: Catalyst broadcasts a side whose
estimated size is below the threshold, AQE does so on the measured size and
otherwise splits skewed partitions.  What the optimiser cannot see, null keys
piling up in one task and copies multiplying, is handled here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.text import clean_key
from weekloom.operators.rows import keep_first

NULL_KEY_SLOTS = 4096


def spread_null_key(key: Column, spread_by: list[str]) -> Column:
    """String join key in which nulls take one of many values that match
    nothing, so rows without a key do not meet in one task.  The value depends
    on the row and on its map task: copies of one row spread over tasks too, and
    a repeated task gives the same values."""
    slot = F.pmod(F.xxhash64(*spread_by, F.spark_partition_id()), F.lit(NULL_KEY_SLOTS)).cast("string")
    return F.coalesce(key.cast("string"), F.concat(F.lit("\u0000"), slot))


def join_by_id_left(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on identifiers compared as text; a null never matches."""
    keyed_left = left.withColumn("_k", spread_null_key(F.col(left_key), left.columns))
    keyed_right = right.filter(F.col(right_key).isNotNull()).withColumn("_k", F.col(right_key).cast("string"))
    return keyed_left.join(keyed_right.drop(right_key), "_k", "left").drop("_k")


def with_clean_keys(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({f"_k_{n}": clean_key(F.col(n)) for n in names})


def first_per_clean_key(dim: DataFrame, order: list[str | Column], names: list[str]) -> DataFrame:
    """First dimension row per cleaned key, ready for :func:`join_by_clean_key_left`."""
    keyed = with_clean_keys(dim, names)
    return keep_first(keyed, [f"_k_{n}" for n in names], order).drop(*[f"_k_{n}" for n in names])


def join_by_clean_key_left(left: DataFrame, right: DataFrame, names: list[str] = ("artist", "song")) -> DataFrame:
    """Left join on lower-cased, trimmed names.  The right side's own name
    columns are dropped.  Several right rows per key give several result rows;
    use :func:`first_per_clean_key` first where one is wanted."""
    names = list(names)
    keys = [f"_k_{n}" for n in names]
    joined = with_clean_keys(left, names).join(with_clean_keys(right, names).drop(*names), keys, "left")
    return joined.drop(*keys)


def fact_dim_left(fact: DataFrame, dim: DataFrame, keys: list[str] = ("artist", "song")) -> DataFrame:
    return fact.join(dim, list(keys), "left")


def pending_anti(tasks: DataFrame, done: DataFrame, keys: list[str] = ("song", "artist")) -> DataFrame:
    """Tasks whose key has no record yet."""
    keys = list(keys)
    return tasks.join(done.select(*keys).distinct(), keys, "left_anti")


def top_semi(df: DataFrame, top: DataFrame, key: str = "genre") -> DataFrame:
    """Rows of the series named in ``top``.  An inner join with the distinct
    names: a semi join would be pushed below the aggregation that made ``df``,
    which then no longer matches the one ``top`` was made from, and the raw
    rows would be read twice instead of reusing one shuffle."""
    return df.join(top.select(key).distinct(), key)


def align_on_dates(df: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    """Per-date sums of both columns where both exist: the outer alignment of
    two per-date sums followed by dropping nulls, in one aggregation."""
    return (
        df.groupBy(*keys)
        .agg(F.sum(actual).alias("actual"), F.sum(predicted).alias("predicted"))
        .dropna(subset=["actual", "predicted"])
    )


def forecast_align(test: DataFrame, forecast: DataFrame, keys: list[str] = ("genre", "date")) -> DataFrame:
    """Test rows with the forecast for the same series and date."""
    return test.join(forecast, list(keys), "left")
