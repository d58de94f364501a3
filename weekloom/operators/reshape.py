"""Set operations and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.labels import safe_label_name
from weekloom.operators.rows import keep_first


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def label_names(labels: DataFrame, label: str = "label") -> list[str]:
    """Labels that will become columns of a wide table, whose schema bounds them;
    :func:`one_hot_long` serves vocabularies that are no schema."""
    return sorted(r[0] for r in labels.select(label).collect())


def one_hot_multilabel(
    df: DataFrame, labels: str, names: Sequence[str], prefix: str = "deezer_genre_", tag: bool = False
) -> DataFrame:
    """One 0/1 column per label, all in a single projection.  Labels whose
    column names coincide share a column, the later label's values."""
    flags: dict[str, Column] = {}
    for name in names:
        held = F.coalesce(F.array_contains(labels, name), F.lit(False))
        flags[prefix + safe_label_name(name, tag)] = held.cast("int")
    return df.withColumns(flags) if flags else df


def one_hot_long(df: DataFrame, keys: Sequence[str], labels: str) -> DataFrame:
    """Membership as (keys, label) rows for any number of labels."""
    return df.select(*keys, F.explode(F.array_distinct(labels)).alias("label"))


def one_hot_single(df: DataFrame, column: str, values: Sequence[str], prefix: str = "dART_") -> DataFrame:
    """0/1 column per value of a single-valued column; null gives all zeros."""
    flags = {prefix + v: F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in values}
    return df.withColumns(flags).drop(column)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.unpivot(list(ids), list(values), "metric_type", "metric_value")


# Result column of each pooled model family.
TOTAL_COLUMNS = {
    "RandomForest": "predicted_streams_RF_tscv_tuned",
    "LightGBM": "predicted_streams_LGBM_tuned_ts_cv",
}


def coalesce_model_columns(
    df: DataFrame, source: str = "predicted_streams_total", targets: dict[str, str] = TOTAL_COLUMNS
) -> DataFrame:
    """Copies the shared prediction column to the model's own column."""
    if source not in df.columns:
        return df
    return df.withColumns({out: F.when(F.col("model") == model, F.col(source)) for model, out in targets.items()})


def wide_to_series_list(
    df: DataFrame, keys: Sequence[str], predicted: str = "predicted", actual: str = "actual", date: str = "date"
) -> DataFrame:
    """Per key the date-ordered arrays of actual (null as 0) and predicted
    values.  Each array is one forecast window long at most: rows are one per
    key and week."""
    points = F.array_sort(
        F.collect_list(F.struct(F.col(date), F.coalesce(actual, F.lit(0.0)).alias("a"), F.col(predicted).alias("p")))
    )
    return (
        df.filter(F.col(predicted).isNotNull())
        .groupBy(*keys)
        .agg(points.alias("_s"))
        .select(*keys, F.col("_s.a").alias("actual"), F.col("_s.p").alias("predicted"))
    )


def upsert_by_key(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()
) -> DataFrame:
    """Existing records overridden by incoming ones with the same key; within
    one batch the first in ``order`` wins.  Running a batch twice changes
    nothing."""
    tagged = union_by_name(existing.withColumn("_new", F.lit(0)), incoming.withColumn("_new", F.lit(1)))
    return keep_first(tagged, list(keys), [F.desc("_new"), *order]).drop("_new")
