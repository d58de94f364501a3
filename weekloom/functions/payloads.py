"""Nested service responses (JSON text) to flat columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.numbers import to_number

from weekloom.functions.text import join_names

TAG_TEXT_LIMIT = 255

SEARCH_SCHEMA = "STRUCT<data: ARRAY<STRUCT<id: BIGINT, album: STRUCT<id: BIGINT>>>>"
TRACK_SCHEMA = "STRUCT<duration: BIGINT, explicit_lyrics: BOOLEAN, bpm: DOUBLE, gain: DOUBLE>"
ALBUM_SCHEMA = (
    "STRUCT<release_date: STRING, genres: STRUCT<data: ARRAY<STRUCT<name: STRING>>>,"
    " nb_tracks: BIGINT, record_type: STRING, duration: BIGINT, explicit_lyrics: BOOLEAN>"
)
INFO_SCHEMA = (
    "STRUCT<track: STRUCT<listeners: STRING, playcount: STRING, duration: STRING,"
    " album: STRUCT<title: STRING>, toptags: STRUCT<tag: ARRAY<STRUCT<name: STRING>>>>>"
)
SCORED_SCHEMA = "STRUCT<highlevel: MAP<STRING, STRING>>"


def flatten_track_album(df: DataFrame, search: str, track: str, album: str, keys: list[str]) -> DataFrame:
    """First search hit with its track and album fields, one row per key.
    Keys without a hit yield no row; a missing track or album leaves nulls."""
    parsed = df.select(
        *keys,
        F.try_element_at(F.from_json(search, SEARCH_SCHEMA)["data"], F.lit(1)).alias("hit"),
        F.from_json(track, TRACK_SCHEMA).alias("track"),
        F.from_json(album, ALBUM_SCHEMA).alias("album"),
    ).filter(F.col("hit").isNotNull())
    has_album = F.col("album").isNotNull()
    names = F.transform(F.coalesce(F.col("album.genres.data"), F.array()), lambda g: g["name"])
    return parsed.select(
        *keys,
        F.when(F.col("track").isNotNull(), F.col("hit.id")).alias("track_id"),
        F.col("track.duration").alias("duration_sec"),
        F.col("track.explicit_lyrics").alias("explicit_lyrics"),
        F.col("track.bpm").alias("bpm"),
        F.col("track.gain").alias("gain"),
        F.when(has_album, F.col("hit.album.id")).alias("album_id"),
        F.col("album.release_date").alias("release_date"),
        F.when(has_album, join_names(names, ",")).alias("genres"),
        F.col("album.nb_tracks").alias("album_track_count"),
        F.col("album.record_type").alias("album_record_type"),
        F.col("album.duration").alias("album_duration_sec"),
        F.col("album.explicit_lyrics").alias("album_explicit_lyrics"),
    )


def flatten_tags(df: DataFrame, info: str, keys: list[str]) -> DataFrame:
    """Listener counts (missing is 0), album title and ``|``-joined tags."""
    track = F.from_json(info, INFO_SCHEMA)["track"]

    def count(name: str) -> Column:
        return F.coalesce(track[name].try_cast("bigint"), F.lit(0).cast("bigint"))

    tags = F.transform(F.coalesce(track["toptags"]["tag"], F.array()), lambda t: t["name"])
    return df.select(
        *keys,
        count("listeners").alias("listeners"),
        count("playcount").alias("playcount"),
        count("duration").alias("duration_ms"),
        track["album"]["title"].alias("album"),
        join_names(tags, "|", TAG_TEXT_LIMIT).alias("tags"),
        error_record(df[info], None).alias("error"),
    )


def scored_features(df: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """Long form of a feature -> {value, probability} map: one row per feature
    with ``name``, ``value`` and ``prob``.  A bare number keeps its name and
    arrives in ``number``."""
    features = F.from_json(payload, SCORED_SCHEMA)["highlevel"]
    scored = F.from_json("raw", "STRUCT<value: STRING, probability: DOUBLE>")
    is_scored = F.col("scored.value").isNotNull() & F.col("scored.probability").isNotNull()
    number = to_number(F.col("raw"))
    return (
        df.select(*keys, F.explode(features).alias("feature", "raw"))
        .withColumn("scored", F.when(F.col("raw").startswith("{"), scored))
        .filter(is_scored | number.isNotNull())
        .select(
            *keys,
            F.when(is_scored, F.replace("feature", F.lit("-"), F.lit("_")))
            .otherwise(F.col("feature"))
            .alias("name"),
            F.col("scored.value").alias("value"),
            F.col("scored.probability").alias("prob"),
            F.when(~is_scored, number).alias("number"),
        )
    )


def scored_feature_names(df: DataFrame, payload: str) -> tuple[list[str], list[str]]:
    """Names of the scored features and of the bare numbers that occur, for the
    wide form.  They become columns, so their number is that of a schema."""
    found = scored_features(df, payload, []).groupBy("name").agg(F.count("number").alias("numbers"), F.count("prob").alias("scored"))
    rows = found.collect()
    return sorted(r.name for r in rows if r.scored), sorted(r.name for r in rows if r.numbers)


def flatten_scored_map(
    df: DataFrame, payload: str, keys: list[str], scored: list[str], numbers: list[str] = ()
) -> DataFrame:
    """Wide form: ``ab_<name>_value``/``ab_<name>_prob`` for the named scored
    features and ``ab_<name>`` for bare numbers.  The names come from the
    caller (or :func:`scored_feature_names`), so the schema is fixed before
    the job runs; the row stays where it is, nothing is shuffled."""
    highlevel = F.from_json(payload, SCORED_SCHEMA)["highlevel"]
    out = df.withColumn("_m", F.transform_keys(highlevel, lambda k, _: F.replace(k, F.lit("-"), F.lit("_"))))
    cols: list[Column] = []
    for name in scored:
        pair = F.from_json(F.try_element_at("_m", F.lit(name)), "STRUCT<value: STRING, probability: DOUBLE>")
        both = pair["value"].isNotNull() & pair["probability"].isNotNull()
        cols.append(F.when(both, pair["value"]).alias(f"ab_{name}_value"))
        cols.append(F.when(both, pair["probability"]).alias(f"ab_{name}_prob"))
    for name in numbers:
        cols.append(to_number(F.try_element_at("_m", F.lit(name))).alias(f"ab_{name}"))
    return out.select(*keys, *cols, error_record(df[payload]).alias("error"))


def error_record(payload: Column, marker: str | None = "failed") -> Column:
    """Marker for a key whose response is missing."""
    return F.when(payload.isNull(), F.lit(marker)).cast("string")
