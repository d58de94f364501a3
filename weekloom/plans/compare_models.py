"""Result files of several models to one table, its winners and distances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.operators.aggregates import best_per_group_composite, best_per_group_row
from weekloom.operators.columns import drop_empty_columns
from weekloom.operators.reshape import coalesce_model_columns
from weekloom.operators.rows import cutoff_from_model, drop_null_key
from weekloom.sources.readers import scan_result_files


def combine_metrics(spark: SparkSession, folder: str) -> DataFrame | None:
    """All metric files as one table, rows without a genre dropped."""
    found = scan_result_files(spark, folder, "metrics")
    return None if found is None else drop_null_key(found)


def best_models(metrics: DataFrame, composite: bool = False) -> DataFrame:
    """Best model per genre by RMSE: its whole row, or per column the first
    value present in order of RMSE."""
    if composite:
        rest = [c for c in metrics.columns if c != "genre"]
        return best_per_group_composite(metrics, "genre", "rmse", rest, ["source_file"])
    return best_per_group_row(metrics, "genre", "rmse", ["source_file"])


def combine_predictions(spark: SparkSession, folder: str, keep_empty: bool = False) -> DataFrame | None:
    """All prediction files as one table from the first SARIMA date on, columns
    without content dropped."""
    found = scan_result_files(spark, folder, "predictions")
    if found is None:
        return None
    rows = drop_null_key(found)
    rows = rows if keep_empty else drop_empty_columns(rows)
    return cutoff_from_model(coalesce_model_columns(rows))


def long_predictions(wide: DataFrame) -> DataFrame:
    """(genre, date, model, actual, predicted): whichever prediction and actual
    column a row fills."""
    predicted = [c for c in wide.columns if c.startswith("predicted_")]
    actual = [c for c in wide.columns if c.startswith("actual_")]
    return wide.select(
        "genre", "date", "model", F.coalesce(*actual).alias("actual"), F.coalesce(*predicted).alias("predicted")
    )
