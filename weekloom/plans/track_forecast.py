"""Track-level models to group-level forecasts and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators.aggregates import genre_prediction_sum, series_length
from weekloom.operators.ranking import TOP_SERIES, topn_series
from weekloom.operators.scoring import evaluate_forecast
from weekloom.operators.trees import tuned_ensemble

TRACK = ["artist", "song"]
#: Names of the families in result tables.
MODELS = {"rf": "RandomForest", "lgbm": "LightGBM"}


def longest_tracks(rows: DataFrame, n: int | None = TOP_SERIES, keys: Sequence[str] = TRACK) -> DataFrame:
    """Rows of the ``n`` longest series; ``None`` keeps all."""
    if n is None:
        return rows
    return rows.join(topn_series(series_length(rows, list(keys)), n, keys).select(*keys), list(keys))


def track_forecasts(
    rows: DataFrame, family: str, n: int | None = TOP_SERIES, keys: Sequence[str] = TRACK, date: str = "date",
    target: str = "spotify_streams", **search,
) -> DataFrame:
    """Test rows of the longest tracks with the forecast of each track's own model."""
    return tuned_ensemble(longest_tracks(rows, n, keys), family, keys, date, target, **search)


def track_models_to_genres(forecasts: DataFrame, labels: DataFrame, keys: Sequence[str] = TRACK, date: str = "date") -> DataFrame:
    """(genre, date, actual, predicted): track forecasts summed for every label of the
    track.  ``labels`` has one row per track with an array ``genres``; a track without
    labels is in no sum."""
    return genre_prediction_sum(forecasts.join(labels.select(*keys, "genres"), list(keys)), date=date)


def track_model_metrics(
    rows: DataFrame, labels: DataFrame, families: Sequence[str] = ("rf", "lgbm"), n: int | None = TOP_SERIES, **search
) -> DataFrame:
    """(genre, model, mae, rmse, mape) of the families' genre sums, in the shape that
    the comparison of models takes."""
    parts = []
    for family in families:
        summed = track_models_to_genres(track_forecasts(rows, family, n, **search), labels)
        parts.append(evaluate_forecast(summed, ["genre"]).withColumn("model", F.lit(MODELS[family])))
    made = parts[0]
    for part in parts[1:]:
        made = made.unionByName(part)
    return made
