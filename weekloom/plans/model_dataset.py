"""Weekly track table and track features to the modelling dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.dates import is_new_release, parse_date, period_end, release_age_days, release_parts
from weekloom.functions.numbers import binarize, to_number, weeks_to_days, zero_to_null
from weekloom.operators.columns import (
    DURATION_COLUMNS,
    columns_with_prefix,
    drop_listed,
    drop_near_constant,
    normalise_names,
    numeric_columns,
)
from weekloom.operators.joins import fact_dim_left
from weekloom.operators.reshape import label_names, one_hot_single
from weekloom.operators.rows import keep_first, positive_metric
from weekloom.operators.windows import MODEL_LAGS, MODEL_ROLLS, add_time_series_features
from weekloom.session import stored

SERIES = ["artist", "song"]
METRIC = "spotify_streams"
CHART_NUMBERS = ("spotify_position", "spotify_peak_position", "spotify_weeks_on_chart", METRIC)
RECORD_TYPE = "deezer_album_record_type"


def weekly_with_features(weekly: DataFrame, features: DataFrame, order: list[str | Column] = ()) -> DataFrame:
    """Joined, dated and de-duplicated rows with release, lag and rolling features."""
    df = normalise_names(fact_dim_left(weekly, features, SERIES))
    df = df.withColumn("date", period_end(F.col("year_week"))).drop("year_week").filter("date IS NOT NULL")
    if "deezer_release_date" in df.columns:
        release = parse_date(F.col("deezer_release_date")).cast("date")
        df = df.withColumn("deezer_release_date", release)
        date, release = F.col("date"), F.col("deezer_release_date")
        df = df.withColumns(
            {"song_age_days": release_age_days(date, release), "is_new_release_last_28d": is_new_release(date, release)}
            | release_parts(date, release)
        )
    df = df.withColumns({c: to_number(F.col(c)) for c in CHART_NUMBERS if c in df.columns})
    if "spotify_weeks_on_chart" in df.columns:
        df = df.withColumn("spotify_days_on_chart", weeks_to_days(F.col("spotify_weeks_on_chart")))
    df = keep_first(df, [*SERIES, "date"], list(order) or sorted(df.columns))
    df = add_time_series_features(df, metric_col=METRIC, id_cols=SERIES, lag_windows=MODEL_LAGS, roll_windows=MODEL_ROLLS)
    if RECORD_TYPE in df.columns:
        charted = features.join(weekly.select(*SERIES), SERIES, "left_semi")
        kinds = label_names(charted.select(F.col(RECORD_TYPE).alias("label")).dropna().distinct())
        df = one_hot_single(df, RECORD_TYPE, kinds)
    return df


def clean_features(df: DataFrame) -> DataFrame:
    """Identifiers and weak columns out, missing markers to null, probabilities
    to flags, and rows without streams out (last, after the lags)."""
    df = drop_listed(df)
    genres = set(columns_with_prefix(df, "deezer_genre_"))
    zero_is_missing = [
        c for c in numeric_columns(df) if (c.startswith("deezer_") and c not in genres) or c in DURATION_COLUMNS
    ]
    df = df.withColumns({c: zero_to_null(F.col(c)) for c in zero_is_missing}) if zero_is_missing else df
    df = drop_near_constant(df)
    probs = [c for c in df.columns if c.startswith("acoustic_") and c.endswith("_prob")]
    if probs:
        df = df.withColumns({c: binarize(F.col(c)) for c in probs}).drop(*[c.replace("_prob", "_value") for c in probs])
    return positive_metric(df, METRIC)


def model_dataset(weekly: DataFrame, features: DataFrame) -> DataFrame:
    """Both tables are stored first: record types and column choices read them again,
    and the raw rows below them are cleaned and enriched once."""
    weekly, features = stored(weekly, "weekly"), stored(features, "features")
    return clean_features(weekly_with_features(weekly, features))
