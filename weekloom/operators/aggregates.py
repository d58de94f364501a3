"""Aggregations and distinct.  All aggregates used here combine map-side, so a
dominant key arrives at its reducer as one row per map task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators.columns import numeric_columns, snake
from weekloom.session import fits_broadcast


def weekly_mean(df: DataFrame, keys: list[str], metrics: list[str] | None = None, prefix: str = "spotify_") -> DataFrame:
    """Mean of every numeric column per key; without numeric columns the
    distinct keys."""
    metrics = [c for c in numeric_columns(df) if c not in keys] if metrics is None else metrics
    if not metrics:
        return weekly_keys_only(df, keys)
    return df.groupBy(*keys).agg(*[F.avg(c).alias(snake(c, prefix)) for c in metrics])


def weekly_keys_only(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def unique_tracks(df: DataFrame, keys: list[str] = ("artist", "song")) -> DataFrame:
    return df.select(*keys).distinct()


def genre_weekly_sum(
    tracks: DataFrame, labels: str = "genres", date: str = "date", metric: str = "spotify_streams"
) -> DataFrame:
    """Weekly total per label from rows that carry their labels; a row counts
    under each of its labels.  One pass: the exploded rows are combined before
    they are shuffled."""
    return _sum_per_label(tracks.withColumn(labels, F.array_distinct(labels)), labels, date, metric)


def _sum_per_label(tracks: DataFrame, labels: str, date: str, metric: str) -> DataFrame:
    return (
        tracks.select(F.explode(labels).alias("genre"), date, metric)
        .groupBy("genre", date)
        .agg(F.sum(metric).alias("total"))
    )


def genre_weekly_sum_of_facts(
    fact: DataFrame, dim: DataFrame, key: str, labels: str = "genres", date: str = "date",
    metric: str = "spotify_streams",
) -> DataFrame:
    """The same when the labels live in a dimension.  A dimension below the
    broadcast threshold is joined row by row, and no fact row is shuffled.  A
    larger one meets the facts already summed per (key, date): a key that holds
    a third of the facts then brings one row per date to the join."""
    dim = dim.select(key, F.array_distinct(labels).alias(labels))  # once per dimension row, not per fact
    if not fits_broadcast(dim):
        fact = fact.groupBy(key, date).agg(F.sum(metric).alias(metric))
    return _sum_per_label(fact.join(dim, key), labels, date, metric)


def total_per_group(series: DataFrame, group: str = "genre", metric: str = "total") -> DataFrame:
    return series.groupBy(group).agg(F.sum(metric).alias("total"))


def total_by_date(df: DataFrame, date: str = "date", metric: str = "total") -> DataFrame:
    return df.groupBy(date).agg(F.sum(metric).alias("total"))


def tag_frequency(df: DataFrame, tags: str) -> DataFrame:
    """How often each tag occurs."""
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def joined_copies(left: DataFrame, sides: list[tuple[DataFrame, list[str]]], name: str = "n_copies") -> DataFrame:
    """``left`` with the number of rows that each of its rows becomes when every side is
    left-joined on its columns (named alike on both): rows per key multiplied, a key
    that the side lacks counting once.  No joined row is formed, the copies of a
    side meet as counts, and rows without a key are spread over all tasks (by all
    columns of ``left``: give it only those that are needed)."""
    from weekloom.operators.joins import spread_null_key

    made, parts = left, []
    for i, (side, on) in enumerate(sides):
        part = f"_copies_{i}"
        keys = [f"_on_{k}" for k in range(len(on))]
        counts = side.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias(part))
        counts = counts.select(*[F.col(c).cast("string").alias(k) for c, k in zip(on, keys, strict=True)], part)
        keyed = made.withColumns({k: spread_null_key(F.col(c), left.columns) for c, k in zip(on, keys, strict=True)})
        made, parts = keyed.join(counts, keys, "left").drop(*keys), [*parts, part]
    product = F.lit(1).cast("bigint")
    for part in parts:
        product = product * F.coalesce(part, F.lit(1))
    return made.withColumn(name, product).drop(*parts)


def joined_tag_frequency(left: DataFrame, right: DataFrame, keys: list[str], tags: str, copies: str | None = None) -> DataFrame:
    """Tag counts over ``left`` left-joined with ``right``, every copy on either
    side counted, without forming the joined rows: row counts per key times tag
    counts per key.  ``copies`` names a column with the rows that a left row stands
    for (see :func:`joined_copies`)."""
    left_n = left.groupBy(*keys).agg((F.sum(copies) if copies else F.count(F.lit(1))).alias("n_left"))
    right_n = right.select(*keys, F.explode(tags).alias("tag")).groupBy(*keys, "tag").agg(F.count(F.lit(1)).alias("n_tag"))
    return (
        right_n.join(left_n, keys)
        .groupBy("tag")
        .agg(F.sum(F.col("n_left") * F.col("n_tag")).alias("n"))
    )


def most_frequent(counts: DataFrame, n: int, label: str = "tag", count: str = "n") -> DataFrame:
    """The ``n`` most frequent labels; equal counts by label."""
    return counts.orderBy(F.desc(count), label).limit(n)


def distinct_labels(df: DataFrame, labels: str) -> DataFrame:
    """Sorted distinct labels of an array column."""
    return df.select(F.explode(labels).alias("label")).distinct().orderBy("label")


def series_length(df: DataFrame, keys: list[str] = ("artist", "song")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def genre_prediction_sum(
    df: DataFrame, labels: str = "genres", date: str = "date", actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Track predictions summed per label and date, missing values as 0."""
    return (
        df.select(
            F.explode(F.array_distinct(labels)).alias("genre"),
            date,
            F.coalesce(actual, F.lit(0.0)).alias("a"),
            F.coalesce(predicted, F.lit(0.0)).alias("p"),
        )
        .groupBy("genre", date)
        .agg(F.sum("a").alias("actual"), F.sum("p").alias("predicted"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def label_occurrences(df: DataFrame, labels: str = "genres") -> DataFrame:
    """Rows per label, the sums of the one-hot columns."""
    return (
        df.select(F.explode(F.array_distinct(labels)).alias("label"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def avg_mape_by_window(metrics: DataFrame, window: str = "ma_window") -> DataFrame:
    return metrics.groupBy(window).agg(F.avg("mape").alias("avg_mape"))


def overall_avg_mape(metrics: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Mean over groups that have a MAPE, with how many there are."""
    return metrics.groupBy(*by).agg(F.avg("mape").alias("avg_mape"), F.count("mape").alias("n_scored"))


def best_per_group_composite(
    df: DataFrame, group: str, by: str, columns: list[str], ties: list[str] = ()
) -> DataFrame:
    """Per group and column the first non-null value in order of ``by``.  The
    values may come from different rows."""
    order = F.struct(F.col(by).isNull(), by, *ties)
    return df.groupBy(group).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])


def best_per_group_row(df: DataFrame, group: str, by: str, ties: list[str] = ()) -> DataFrame:
    """Per group the whole row with the smallest ``by``."""
    from weekloom.operators.rows import keep_first

    return keep_first(df, [group], [F.asc_nulls_last(by), *ties])


def complete_groups(df: DataFrame, group: str = "genre", member: str = "model") -> DataFrame:
    """Groups that have every member found anywhere in the table."""
    pairs = df.select(group, member).dropna().distinct()
    members = pairs.select(member).distinct().agg(F.count(F.lit(1))).scalar()
    return pairs.groupBy(group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == members).select(group)
