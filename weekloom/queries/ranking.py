from pyspark.sql import functions as F

from weekloom.operators.aggregates import label_occurrences, series_length, total_per_group
from weekloom.operators.ranking import (
    model_order_in_group,
    nlargest_labels,
    sort_metric,
    sort_series,
    topn_genres,
    topn_series,
)
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import (
    GENRE_SQL,
    SCORED_SQL,
    TRACKS_SQL,
    WEEKLY_SQL,
    genre_weekly,
    scored,
    tracks,
    weekly_tracks,
)


@query(
    "sort_date",
    "artist:s song:s date:d streams:f2",
    f"WITH {WEEKLY_SQL} SELECT artist, song, date, streams FROM weekly ORDER BY artist, song, date",
)
def _sort_date(spark, d):
    return sort_series(weekly_tracks(spark, d), ["artist", "song"])


@query(
    "topn_genres",
    "genre:s total:f2",
    f"""WITH {GENRE_SQL} SELECT genre, sum(total) AS total FROM genre_weekly GROUP BY genre
        ORDER BY total DESC, genre LIMIT 10""",
)
def _topn_genres(spark, d):
    return topn_genres(total_per_group(genre_weekly(spark, d)))


@query(
    "topn_series",
    "artist:s song:s n:i",
    f"""WITH {WEEKLY_SQL} SELECT artist, song, count(*) AS n FROM weekly GROUP BY ALL
        ORDER BY n DESC, artist, song LIMIT 200""",
)
def _topn_series(spark, d):
    return topn_series(series_length(weekly_tracks(spark, d)))


@query(
    "nlargest_labels",
    "label:s n:i",
    f"""WITH {TRACKS_SQL} SELECT label, count(*) AS n FROM (SELECT unnest(genres) AS label FROM tracks)
        GROUP BY label ORDER BY n DESC, label LIMIT 5""",
)
def _nlargest_labels(spark, d):
    return nlargest_labels(label_occurrences(tracks(spark, d)))


@query(
    "model_order_in_group",
    "genre:s model:s mae:f2 place:i",
    f"""WITH {SCORED_SQL} SELECT genre, model, mae, row_number() OVER (PARTITION BY genre ORDER BY mae, model) AS place
        FROM scored""",
)
def _model_order_in_group(spark, d):
    return model_order_in_group(scored(spark, d))


@query(
    "sort_metric",
    "genre:s model:s mape:f6",
    f"WITH {SCORED_SQL} SELECT genre, model, mape FROM scored ORDER BY mape",
)
def _sort_metric(spark, d):
    return sort_metric(scored(spark, d), "mape", ties=["genre", "model"]).select("genre", "model", F.col("mape"))
