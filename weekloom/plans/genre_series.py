"""Model dataset with one 0/1 column per label to one weekly series per label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.functions.labels import label_from_column
from weekloom.operators.columns import binary_columns, chosen
from weekloom.plans.model_dataset import METRIC


def label_columns(dataset: DataFrame, prefix: str = "deezer_genre_") -> list[str]:
    """Columns of the prefix that hold flags; one pass over the rows finds them."""
    return chosen(binary_columns(dataset, prefix), "is_binary")


def labels_from_flags(dataset: DataFrame, prefix: str = "deezer_genre_", name: str = "genres") -> DataFrame:
    """``dataset`` with the flag columns as one array of labels."""
    columns = label_columns(dataset, prefix)
    labels = [F.when(F.col(f"`{c}`").cast("double") == 1, label_from_column(F.lit(c), prefix)) for c in columns]
    array = F.array_compact(F.array(*labels)) if labels else F.array().cast("array<string>")
    return dataset.withColumn(name, array).drop(*columns)


def genre_series_from_flags(dataset: DataFrame, prefix: str = "deezer_genre_", metric: str = METRIC, date: str = "date") -> DataFrame:
    """(genre, date, total): the metric summed over the rows that carry a label, a row
    in the sum of each of its labels; a label without rows has no series."""
    rows = labels_from_flags(dataset.select(date, metric, *[c for c in dataset.columns if c.startswith(prefix)]), prefix)
    return rows.select(F.explode("genres").alias("genre"), date, metric).groupBy("genre", date).agg(F.sum(metric).alias("total"))
