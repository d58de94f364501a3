"""Whole plans over the generated tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weekloom.plans.clean_chart import clean_chart
from weekloom.plans.genre_series import genre_series_from_flags
from weekloom.plans.master_features import master_features
from weekloom.plans.model_dataset import model_dataset
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import CLEAN_SQL, raw_chart, table

_TOP = 5


def _enriched(spark, d):
    """Tracks, acoustic records, albums and tags: parts, suppliers and parts again."""
    part, supplier = table(spark, d, "part"), table(spark, d, "supplier")
    mbid = F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey") % 100 + 1)
    base = part.select(F.col("p_brand").alias("artist"), F.col("p_name").alias("song"), mbid.alias("mbid"), F.col("p_partkey").alias("ingest_seq"))
    acoustic = supplier.select(
        F.when(F.col("s_suppkey") % 7 != 0, F.col("s_suppkey")).alias("mb_recording_id"), (F.col("s_acctbal") / 10000).alias("ab_x_prob"),
        F.col("s_name").alias("ab_x_value"), F.col("s_suppkey").alias("ingest_seq"),
    )
    key = [F.upper("p_brand").alias("artist"), F.when(F.col("p_size") % 5 != 0, F.upper("p_name")).alias("song")]
    albums = part.select(
        *key, F.replace("p_name", F.lit(" "), F.lit(",")).alias("genres"), (F.col("p_size") % 4).alias("album_track_count"),
        F.date_format(F.date_add(F.lit("1994-06-01").cast("date"), F.col("p_size") * 40), "yyyy-MM-dd").alias("release_date"),
        F.col("p_type").alias("album_record_type"), (-F.col("p_partkey")).alias("ingest_seq"),
    )
    tags = part.select(
        F.lower("p_brand").alias("artist"), F.col("p_name").alias("song"), (F.col("p_size") % 6).alias("listeners"),
        F.replace("p_name", F.lit(" "), F.lit("|")).alias("tags"), F.col("p_partkey").alias("ingest_seq"),
    )
    return base, acoustic, albums, tags


_MASTER_SQL = f"""base AS (SELECT p_brand AS artist, p_name AS song, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey % 100 + 1 END AS mbid, p_partkey AS seq FROM part),
tracks AS (SELECT * FROM base QUALIFY row_number() OVER (PARTITION BY artist, song, mbid ORDER BY seq) = 1),
acoustic AS (SELECT s_suppkey AS id, s_acctbal / 10000 AS x FROM supplier WHERE s_suppkey % 7 <> 0),
every_album AS (SELECT p_brand AS artist, p_name AS song, p_size % 4 AS n, DATE '1994-06-01' + (p_size * 40)::INT AS released, p_type AS kind, p_partkey AS seq
    FROM part WHERE p_size % 5 <> 0),
albums AS (SELECT * FROM every_album QUALIFY row_number() OVER (PARTITION BY artist, song ORDER BY -seq) = 1),
tags AS (SELECT p_brand AS artist, p_name AS song, p_size % 6 AS listeners FROM part
    QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) = 1),
top_tags AS (SELECT tag FROM (SELECT unnest(string_split(b.song, ' ')) AS tag FROM base b LEFT JOIN acoustic a ON b.mbid = a.id
    LEFT JOIN every_album d ON b.artist = d.artist AND b.song = d.song JOIN part t ON b.artist = t.p_brand AND b.song = t.p_name)
    GROUP BY tag ORDER BY count(*) DESC, tag LIMIT {_TOP}),
master AS (SELECT t.artist, t.song, t.mbid, a.x AS acoustic_ab_x_prob, d.n AS deezer_album_track_count, d.released, d.kind,
    nullif(g.listeners, 0) AS lastfm_listeners, CASE WHEN d.artist IS NULL THEN [] ELSE list_distinct(string_split(t.song, ' ')) END AS genres,
    len(list_filter(list_distinct(string_split(t.song, ' ')), lambda x: list_contains(l.top, x))) AS n_tags
    FROM (SELECT list(tag) AS top FROM top_tags) l, tracks t LEFT JOIN acoustic a ON t.mbid = a.id LEFT JOIN albums d ON t.artist = d.artist AND t.song = d.song
    LEFT JOIN tags g ON t.artist = g.artist AND t.song = g.song)"""


def _flags(columns: list[str], prefix: str):
    found = [F.col(c) for c in columns if c.startswith(prefix) and c != "deezer_genres"]
    return sum(found[1:], found[0])


@query(
    "master_features",
    "artist:s song:s mbid:i acoustic_ab_x_prob:f6 deezer_album_track_count:i lastfm_listeners:f0 n_genres:i n_tags:i",
    f"""WITH {_MASTER_SQL}
        SELECT artist, song, mbid, acoustic_ab_x_prob, deezer_album_track_count, lastfm_listeners, len(genres) AS n_genres, n_tags FROM master""",
)
def _master_features(spark, d):
    made = master_features(*_enriched(spark, d), top_tags=_TOP)
    return made.withColumns({"n_genres": _flags(made.columns, "deezer_genre_"), "n_tags": _flags(made.columns, "lfm_tag_")})


def _dataset(spark, d):
    """Chart weeks with the features of the track's first row."""
    base, acoustic, albums, tags = _enriched(spark, d)
    one = master_features(base.withColumn("mbid", F.lit(None).cast("bigint")), None, albums, tags, top_tags=_TOP)
    return model_dataset(clean_chart(raw_chart(spark, d)), one)


_DATASET_SQL = f"""{CLEAN_SQL},
weekly AS (SELECT artist, song, CAST(string_split(year_week, '/')[2] AS DATE) AS date, avg("Streams") AS streams, avg("Position") AS position
    FROM keyed GROUP BY ALL),
albums AS (SELECT p_brand AS artist, p_name AS song, p_size % 4 AS n, DATE '1994-06-01' + (p_size * 40)::INT AS released, p_type AS kind
    FROM part WHERE p_size % 5 <> 0 QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY -p_partkey) = 1),
rolled AS (SELECT w.*, lag(streams, 1) OVER s AS lag_1, lag(streams, 12) OVER s AS lag_12,
        avg(streams) OVER (PARTITION BY artist, song ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS mean_4,
        stddev_samp(streams) OVER (PARTITION BY artist, song ORDER BY date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS std_8
    FROM weekly w WINDOW s AS (PARTITION BY artist, song ORDER BY date)),
dataset AS (SELECT r.*, date - released AS age, nullif(n, 0) AS tracks, coalesce(kind = 'PROMO', false)::INT AS promo,
        CASE WHEN a.artist IS NULL THEN [] ELSE list_distinct(string_split(r.song, ' ')) END AS genres
    FROM rolled r JOIN (SELECT DISTINCT p_brand, p_name FROM part) t ON r.artist = p_brand AND r.song = p_name
    LEFT JOIN albums a ON r.artist = a.artist AND r.song = a.song WHERE streams > 0)"""


@query(
    "model_dataset",
    "artist:s song:s date:d spotify_streams:f4 lag_1:f4 lag_12:f4 mean_4:f4 std_8:f3 quarter:i weekofyear:i age:i new:i tracks:i promo:i",
    f"""WITH {_DATASET_SQL} SELECT artist, song, date, streams AS spotify_streams, lag_1, lag_12, mean_4, std_8, quarter(date) AS quarter,
        week(date) AS weekofyear, coalesce(age, -1) AS age, coalesce(age BETWEEN 0 AND 28, false)::INT AS new, tracks, promo FROM dataset""",
)
def _model_dataset(spark, d):
    metric = "spotify_streams"
    return _dataset(spark, d).withColumnsRenamed(
        {f"{metric}_lag_1": "lag_1", f"{metric}_lag_12": "lag_12", f"{metric}_roll_mean_4": "mean_4", f"{metric}_roll_std_8": "std_8"}
        | {"song_age_days": "age", "is_new_release_last_28d": "new", "deezer_album_track_count": "tracks", "dART_PROMO": "promo"}
    )


@query(
    "genre_series_from_flags",
    "genre:s date:d total:f2",
    f"WITH {_DATASET_SQL} SELECT genre, date, sum(streams) AS total FROM (SELECT unnest(genres) AS genre, date, streams FROM dataset) GROUP BY ALL",
)
def _genre_series_from_flags(spark, d):
    return genre_series_from_flags(_dataset(spark, d))
