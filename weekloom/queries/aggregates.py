from pyspark.sql import functions as F

from weekloom.functions.labels import split_labels
from weekloom.operators.aggregates import (
    avg_mape_by_window,
    best_per_group_composite,
    best_per_group_row,
    complete_groups,
    distinct_labels,
    genre_prediction_sum,
    joined_copies,
    joined_tag_frequency,
    label_occurrences,
    most_frequent,
    overall_avg_mape,
    series_length,
    total_by_date,
    total_per_group,
    value_counts,
    weekly_keys_only,
)
from weekloom.operators.forecast import moving_average
from weekloom.operators.scoring import evaluate_forecast
from weekloom.plans.clean_chart import WEEK_KEYS, clean_chart, clean_rows, track_list
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import (
    CLEAN_SQL,
    GENRE_SQL,
    MA_BEST_SQL,
    SCORED_SQL,
    TRACKS_SQL,
    WEEKLY_SQL,
    genre_grid,
    genre_weekly,
    raw_chart,
    scored,
    table,
    tracks,
    weekly_tracks,
)


@query(
    "weekly_mean",
    "year_week:s artist:s song:s spotify_position:f6 spotify_peak_position:f6 spotify_weeks_on_chart:f6 spotify_streams:f4",
    f"""WITH {CLEAN_SQL} SELECT year_week, artist, song, avg("Position") AS spotify_position,
        avg(TRY_CAST("Peak Position" AS DOUBLE)) AS spotify_peak_position,
        avg(TRY_CAST("Weeks on Chart" AS DOUBLE)) AS spotify_weeks_on_chart, avg("Streams") AS spotify_streams
        FROM keyed GROUP BY ALL""",
)
def _weekly_mean(spark, d):
    return clean_chart(raw_chart(spark, d))


@query(
    "weekly_keys_only",
    "year_week:s artist:s song:s",
    f"WITH {CLEAN_SQL} SELECT DISTINCT year_week, artist, song FROM keyed",
)
def _weekly_keys_only(spark, d):
    return weekly_keys_only(clean_rows(raw_chart(spark, d)), WEEK_KEYS)


@query("unique_tracks", "artist:s song:s", f"WITH {CLEAN_SQL} SELECT DISTINCT artist, song FROM keyed")
def _unique_tracks(spark, d):
    return track_list(clean_rows(raw_chart(spark, d)))


@query("genre_weekly_sum", "genre:s date:d total:f2", f"WITH {GENRE_SQL} SELECT genre, date, total FROM genre_weekly")
def _genre_weekly_sum(spark, d):
    return genre_weekly(spark, d)


@query(
    "group_total_rank",
    "genre:s total:f2",
    f"WITH {GENRE_SQL} SELECT genre, sum(total) AS total FROM genre_weekly GROUP BY genre ORDER BY total DESC",
)
def _group_total_rank(spark, d):
    return total_per_group(genre_weekly(spark, d)).orderBy(F.desc("total"), "genre")


@query(
    "tag_frequency_topn",
    "tag:s n:i",
    f"""WITH {TRACKS_SQL} SELECT tag, count(*) AS n FROM
        (SELECT unnest(string_split(p_name, ' ')) AS tag FROM tracks JOIN part ON artist = p_brand AND song = p_name)
        GROUP BY tag ORDER BY n DESC, tag LIMIT 10""",
)
def _tag_frequency_topn(spark, d):
    tagged = table(spark, d, "part").select(
        F.col("p_brand").alias("artist"), F.col("p_name").alias("song"), F.split("p_name", " ").alias("tags")
    )
    return most_frequent(joined_tag_frequency(tracks(spark, d), tagged, ["artist", "song"], "tags"), 10)


@query(
    "tag_frequency_all_copies",
    "tag:s n:i",
    """WITH base AS (SELECT l_orderkey, p_brand, p_name, CASE WHEN l_linenumber > 2 THEN l_suppkey END AS mbid
            FROM lineitem JOIN part ON l_partkey = p_partkey),
        albums AS (SELECT upper(p_brand) AS brand, upper(p_name) AS name, unnest(range(p_size % 4)) AS copy FROM part)
        SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(t.p_name, ' ')) AS tag FROM base b
            LEFT JOIN orders a ON b.mbid = a.o_custkey
            LEFT JOIN albums d ON upper(b.p_brand) = d.brand AND upper(b.p_name) = d.name
            JOIN part t ON b.p_brand = t.p_brand AND b.p_name = t.p_name)
        GROUP BY tag""",
)
def _tag_frequency_all_copies(spark, d):
    part = table(spark, d, "part")
    names = part.select(F.col("p_partkey").alias("l_partkey"), F.upper("p_brand").alias("artist"), F.upper("p_name").alias("song"))
    base = table(spark, d, "lineitem").join(names, "l_partkey").withColumn("mbid", F.when(F.col("l_linenumber") > 2, F.col("l_suppkey")))
    acoustic = table(spark, d, "orders").select(F.col("o_custkey").alias("mbid"))
    copies = F.explode(F.array_repeat(F.lit(1), (F.col("p_size") % 4).cast("int")))
    albums = part.select(F.upper("p_brand").alias("artist"), F.upper("p_name").alias("song"), copies.alias("copy")).drop("copy")
    tags = part.select(F.upper("p_brand").alias("artist"), F.upper("p_name").alias("song"), F.split("p_name", " ").alias("tags"))
    base = base.select("mbid", "artist", "song")
    counted = joined_copies(base, [(acoustic, ["mbid"]), (albums, ["artist", "song"])], "copies")
    return joined_tag_frequency(counted, tags, ["artist", "song"], "tags", "copies")


@query("distinct_labels", "label:s", f"WITH {TRACKS_SQL} SELECT DISTINCT unnest(genres) AS label FROM tracks")
def _distinct_labels(spark, d):
    return distinct_labels(tracks(spark, d), "genres")


@query("total_by_date", "date:d total:f2", f"WITH {GENRE_SQL} SELECT date, sum(v) AS total FROM tracks GROUP BY date")
def _total_by_date(spark, d):
    from weekloom.functions.dates import week_end

    rows = table(spark, d, "lineitem").select(week_end(F.col("l_shipdate")).alias("date"), "l_extendedprice")
    return total_by_date(rows, metric="l_extendedprice")


@query(
    "series_length",
    "artist:s song:s n:i",
    f"WITH {WEEKLY_SQL} SELECT artist, song, count(*) AS n FROM weekly GROUP BY ALL",
)
def _series_length(spark, d):
    return series_length(weekly_tracks(spark, d))


@query(
    "genre_pred_sum",
    "genre:s date:d actual:f2 predicted:f2",
    f"""WITH {TRACKS_SQL} SELECT genre, date, sum(v) AS actual, sum(coalesce(p, 0)) AS predicted FROM
        (SELECT unnest(genres) AS genre, date, v, CASE WHEN l_linenumber <> 3 THEN v * 2 END AS p FROM tracks)
        GROUP BY ALL""",
)
def _genre_pred_sum(spark, d):
    rows = tracks(spark, d).select(
        "genres", "date", F.col("v").alias("actual"), F.when(F.col("l_linenumber") != 3, F.col("v") * 2).alias("predicted")
    )
    return genre_prediction_sum(rows)


@query(
    "avg_mape_by_window",
    "ma_window:i avg_mape:f6",
    f"WITH {MA_BEST_SQL} SELECT ma_window, avg_mape FROM window_mape",
)
def _avg_mape_by_window(spark, d):
    return avg_mape_by_window(evaluate_forecast(moving_average(genre_grid(spark, d)), ["genre", "ma_window"]))


@query(
    "overall_avg_mape",
    "model:s avg_mape:f6 n_scored:i",
    f"WITH {SCORED_SQL} SELECT model, avg(mape) AS avg_mape, count(mape) AS n_scored FROM scored GROUP BY model",
)
def _overall_avg_mape(spark, d):
    return overall_avg_mape(scored(spark, d))


_PARTIAL = "rows AS (SELECT *, CASE WHEN model = 'MovingAverage' THEN 4 END AS ma_window FROM scored)"


@query(
    "best_per_group",
    "genre:s model:s rmse:f2 mape:f6",
    f"""WITH {SCORED_SQL} SELECT genre, model, rmse, mape FROM scored
        QUALIFY row_number() OVER (PARTITION BY genre ORDER BY rmse, model) = 1""",
)
def _best_per_group(spark, d):
    return best_per_group_row(scored(spark, d), "genre", "rmse", ["model"])


@query(
    "best_per_group_composite",
    "genre:s model:s rmse:f2 ma_window:f0",
    f"""WITH {SCORED_SQL}, {_PARTIAL} SELECT genre, first(model ORDER BY rmse, model) AS model, min(rmse) AS rmse,
        first(ma_window ORDER BY rmse) FILTER (ma_window IS NOT NULL) AS ma_window FROM rows GROUP BY genre""",
)
def _best_per_group_composite(spark, d):
    rows = scored(spark, d).withColumn("ma_window", F.when(F.col("model") == "MovingAverage", F.lit(4)))
    return best_per_group_composite(rows, "genre", "rmse", ["model", "rmse", "ma_window"], ["model"])


@query(
    "complete_groups",
    "genre:s",
    f"""WITH {SCORED_SQL}, named AS (SELECT genre, CASE WHEN model <> 'Naive' OR mape < 20 THEN model END AS model FROM scored)
        SELECT genre FROM named GROUP BY genre HAVING count(DISTINCT model) = (SELECT count(DISTINCT model) FROM named)""",
)
def _complete_groups(spark, d):
    named = F.expr("CASE WHEN model <> 'Naive' OR mape < 20 THEN model END")  # a weak result counts as none
    return complete_groups(scored(spark, d).withColumn("model", named))


@query(
    "value_counts",
    "kind:s n:i",
    "SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS kind, count(*) AS n FROM orders GROUP BY 1",
)
def _value_counts(spark, d):
    kind = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return value_counts(table(spark, d, "orders").withColumn("kind", kind), "kind")


@query(
    "label_occurrences",
    "label:s n:i",
    f"""WITH {TRACKS_SQL} SELECT label, count(*) AS n FROM (SELECT unnest(genres) AS label FROM tracks)
        GROUP BY label""",
)
def _label_occurrences(spark, d):
    labelled = table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), split_labels(F.replace("p_name", F.lit(" "), F.lit(","))).alias("genres")
    )
    return label_occurrences(table(spark, d, "lineitem").join(labelled, "l_partkey"))
