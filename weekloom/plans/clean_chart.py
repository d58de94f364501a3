"""Raw chart rows to the weekly track table and the track list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.functions.dates import week_period
from weekloom.functions.numbers import to_number
from weekloom.functions.text import primary_artist, tidy
from weekloom.operators.aggregates import unique_tracks, weekly_mean
from weekloom.operators.columns import computed_once, numeric_columns
from weekloom.operators.rows import drop_bad_dates, drop_empty_keys
from weekloom.sources.readers import CHART_REQUIRED, require_columns

WEEK_KEYS = ["year_week", "artist", "song"]


def clean_rows(raw: DataFrame) -> DataFrame:
    """Tidy names, parsed dates, rows without a usable key or date dropped."""
    require_columns(raw.columns, CHART_REQUIRED)
    named = computed_once(
        drop_bad_dates(raw, "Date"),
        artist=primary_artist(tidy(F.col("Artists"))),
        song=tidy(F.col("Song Title")),
    )
    return drop_empty_keys(named, "artist", "song").withColumn("year_week", week_period(F.col("Date")))


def clean_chart(raw: DataFrame) -> DataFrame:
    """Mean of every numeric chart column per (week, artist, song)."""
    rows = clean_rows(raw)
    texts = [c for c in ("Peak Position", "Weeks on Chart") if c in rows.columns]
    rows = rows.withColumns({c: to_number(F.col(c)) for c in texts}) if texts else rows
    return weekly_mean(rows, WEEK_KEYS, [c for c in numeric_columns(rows) if c not in WEEK_KEYS])


def track_list(weekly: DataFrame) -> DataFrame:
    return unique_tracks(weekly)
