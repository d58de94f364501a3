from pyspark.sql import functions as F

from weekloom.operators.windows import (
    add_time_series_features,
    centered_ma,
    expanding_folds,
    holdout_last_n,
    lag_columns,
    min_history_gate,
    roll_mean_columns,
    roll_std_columns,
    series_window,
    weekly_grain,
    with_position,
)
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import GRID_SQL, WEEKLY_SQL, genre_grid, tracks, weekly_tracks

SERIES = ["artist", "song"]
_W = "(PARTITION BY artist, song ORDER BY date)"


def _trailing(n: int) -> str:
    return f"(PARTITION BY artist, song ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


@query(
    "lag_k",
    "artist:s song:s date:d " + " ".join(f"streams_lag_{k}:f2" for k in (1, 2, 4, 8, 12)),
    f"WITH {WEEKLY_SQL} SELECT artist, song, date, "
    + ", ".join(f"lag(streams, {k}) OVER {_W} AS streams_lag_{k}" for k in (1, 2, 4, 8, 12))
    + " FROM weekly",
)
def _lag_k(spark, d):
    w = series_window(SERIES)
    return weekly_tracks(spark, d).withColumns(lag_columns("streams", w, (1, 2, 4, 8, 12)))


@query(
    "roll_mean_w",
    "artist:s song:s date:d " + " ".join(f"streams_roll_mean_{n}:f4" for n in (4, 8, 12)),
    f"WITH {WEEKLY_SQL} SELECT artist, song, date, "
    + ", ".join(f"avg(streams) OVER {_trailing(n)} AS streams_roll_mean_{n}" for n in (4, 8, 12))
    + " FROM weekly",
)
def _roll_mean_w(spark, d):
    return weekly_tracks(spark, d).withColumns(roll_mean_columns("streams", series_window(SERIES), (4, 8, 12)))


@query(
    "roll_std_w",
    "artist:s song:s date:d " + " ".join(f"streams_roll_std_{n}:f3" for n in (4, 8, 12)),
    f"WITH {WEEKLY_SQL} SELECT artist, song, date, "
    + ", ".join(f"stddev_samp(streams) OVER {_trailing(n)} AS streams_roll_std_{n}" for n in (4, 8, 12))
    + " FROM weekly",
)
def _roll_std_w(spark, d):
    return weekly_tracks(spark, d).withColumns(roll_std_columns("streams", series_window(SERIES), (4, 8, 12)))


@query(
    "ts_features",
    "artist:s song:s date:d streams:f2 year:i month:i quarter:i weekofyear:i streams_lag_1:f2 streams_lag_8:f2 "
    "streams_roll_mean_4:f4 streams_roll_std_8:f3",
    f"""WITH {WEEKLY_SQL}, filled AS (SELECT artist, song, date, CASE WHEN streams > 5000 THEN streams ELSE 0 END AS streams
        FROM weekly) SELECT *, year(date) AS year, month(date) AS month, quarter(date) AS quarter,
        weekofyear(date) AS weekofyear, lag(streams, 1) OVER {_W} AS streams_lag_1,
        lag(streams, 8) OVER {_W} AS streams_lag_8, avg(streams) OVER {_trailing(4)} AS streams_roll_mean_4,
        stddev_samp(streams) OVER {_trailing(8)} AS streams_roll_std_8 FROM filled""",
)
def _ts_features(spark, d):
    weekly = weekly_tracks(spark, d).withColumn("streams", F.when(F.col("streams") > 5000, F.col("streams")))
    return add_time_series_features(weekly, metric_col="streams", id_cols=SERIES)


@query(
    "holdout_last_n",
    "artist:s song:s date:d v:f2 is_test:i",
    f"""WITH {WEEKLY_SQL} SELECT artist, song, date, streams AS v, CAST(row_number() OVER
        (PARTITION BY artist, song ORDER BY date DESC) <= 8 AS INT) AS is_test FROM weekly""",
)
def _holdout_last_n(spark, d):
    marked = holdout_last_n(weekly_grain(tracks(spark, d), SERIES, "date", "v"), SERIES)
    return marked.withColumn("is_test", F.col("is_test").cast("int"))


_GATES = {"naive": 0, "prophet": 0, "rf": 0, "lgbm": 0, "sarima": 0, "ma": 4}  # and the window of the moving average
_NEEDS = {"naive": 9, "prophet": 60, "rf": 13, "lgbm": 12, "sarima": 112, "ma": 12}


@query(
    "min_history_gate",
    "family:s artist:s song:s n:i",
    f"""WITH {WEEKLY_SQL}, lengths AS (SELECT artist, song, 4 * count(*) - 80 AS n FROM weekly GROUP BY ALL)
        """
    + " UNION ALL ".join(
        f"SELECT '{g}' AS family, artist, song, n FROM lengths WHERE n >= {_NEEDS[g]}" for g in _GATES
    ),
)
def _min_history_gate(spark, d):
    lengths = weekly_tracks(spark, d).groupBy(*SERIES).agg((4 * F.count(F.lit(1)) - 80).alias("n"))
    kept = [min_history_gate(lengths, g, extra=extra).withColumn("family", F.lit(g)) for g, extra in _GATES.items()]
    out = kept[0]
    for part in kept[1:]:
        out = out.unionByName(part)
    return out


@query(
    "centered_ma",
    "genre:s date:d trend:f3",
    f"""WITH {GRID_SQL} SELECT genre, date, CASE WHEN c = 53 THEN (t - (a + b) / 2) / 52 END AS trend FROM
        (SELECT genre, date, count(*) OVER f AS c, sum(total) OVER f AS t, lag(total, 26) OVER s AS a,
         lead(total, 26) OVER s AS b FROM grid WINDOW s AS (PARTITION BY genre ORDER BY date),
         f AS (PARTITION BY genre ORDER BY date ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING))""",
)
def _centered_ma(spark, d):
    return genre_grid(spark, d).withColumn("trend", centered_ma("total", ["genre"]))


@query(
    "expanding_folds",
    "artist:s song:s date:d fold:i",
    f"""WITH {WEEKLY_SQL}, placed AS (SELECT artist, song, date, row_number() OVER {_W} AS rn,
        count(*) OVER (PARTITION BY artist, song) AS n FROM weekly)
        SELECT artist, song, date, CASE WHEN rn > n - (n // 4) THEN 3 WHEN rn > n - 2 * (n // 4) THEN 2
        WHEN rn > n - 3 * (n // 4) THEN 1 ELSE 0 END AS fold FROM placed WHERE n >= 4""",
)
def _expanding_folds(spark, d):
    weekly = with_position(weekly_tracks(spark, d), SERIES).filter("n >= 4").drop("rn", "n")
    return expanding_folds(weekly, SERIES)
