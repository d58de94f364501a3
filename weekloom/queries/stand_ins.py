"""The generated tables in the roles of the library's inputs.

``part`` rows are releases: brand is the artist, the two-word name is the song
and its words are the genres.  ``lineitem`` rows are chart observations of
them.  Each role has its SQL twin as a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.dates import week_end
from weekloom.operators.aggregates import genre_weekly_sum_of_facts
from weekloom.operators.series import fill_missing_weeks


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- raw chart rows: the same expressions run on both sides -----------------

RAW_CHART = {
    "Position": "l_linenumber",
    "Song Title": """CASE WHEN l_orderkey % 97 = 0 THEN ''
        WHEN l_orderkey % 6 = 0 THEN concat(p_name, ' (feat. ', s_name, ')')
        WHEN l_orderkey % 6 = 1 THEN concat(p_name, ' [Live]')
        WHEN l_orderkey % 6 = 2 THEN concat('"', p_name, '"')
        WHEN l_orderkey % 6 = 3 THEN concat(' ', p_name, ' (Remix)')
        WHEN l_orderkey % 6 = 4 THEN concat('“', p_name, '  ”')
        ELSE p_name END""",
    "Artists": "concat(p_brand, ' , ', s_name)",
    "Last Week": "CAST(CAST(l_quantity AS INT) AS STRING)",
    "Peak Position": "CASE WHEN l_linenumber = 7 THEN 'new' ELSE CAST(l_linenumber AS STRING) END",
    "Weeks on Chart": "CAST(CAST(l_quantity AS INT) + 1 AS STRING)",
    "Streams": "CAST(floor(l_extendedprice) AS BIGINT)",
    "Date": "CASE WHEN l_orderkey % 101 = 0 THEN 'n/a' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END",
}
_COLUMNS_SQL = ", ".join(f'{e} AS "{c}"' for c, e in RAW_CHART.items())
RAW_SQL = f"""raw AS (SELECT {_COLUMNS_SQL} FROM lineitem
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


def raw_chart(spark: SparkSession, d: str) -> DataFrame:
    joined = (
        table(spark, d, "lineitem")
        .join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.select(*[F.expr(e).alias(c) for c, e in RAW_CHART.items()])


# Oracle form of the title clean-up (the oracle's engine has its own dialect).
TIDY_SQL = r"""trim(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace({c},
    '\s+\(??feat\..*?$', '', 'gi'), '\s*\[.*?]|\(.*?\)$', '', 'gi'), '""', '"'),
    '^[''"“”‘’]+|[''"“”‘’]+$', '', 'g'), '\s+', ' ', 'g'))"""
WEEK_SQL = "(CAST(date_trunc('week', {c}) AS DATE) + 6)"


def tidy_sql(c: str) -> str:
    return TIDY_SQL.format(c=c)


def week_sql(c: str) -> str:
    return WEEK_SQL.format(c=c)


CLEAN_SQL = f"""{RAW_SQL},
clean AS (SELECT *, trim(string_split({tidy_sql('"Artists"')}, ',')[1]) AS artist, {tidy_sql('"Song Title"')} AS song,
    TRY_CAST("Date" AS DATE) AS day FROM raw WHERE TRY_CAST("Date" AS DATE) IS NOT NULL),
keyed AS (SELECT *, strftime(date_trunc('week', day), '%Y-%m-%d') || '/' ||
    strftime(date_trunc('week', day) + INTERVAL 6 DAY, '%Y-%m-%d') AS year_week
    FROM clean WHERE artist <> '' AND song <> '')"""


# --- observations with their track and genres -------------------------------

TRACKS_SQL = f"""tracks AS (SELECT p_brand AS artist, p_name AS song, string_split(p_name, ' ') AS genres,
    {week_sql("l_shipdate")} AS date, l_extendedprice AS v, l_orderkey, l_linenumber, l_suppkey
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def tracks(spark: SparkSession, d: str) -> DataFrame:
    """Observation rows: artist, song, genres, week, value."""
    fact = table(spark, d, "lineitem")
    dim = table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_brand").alias("artist"),
        F.col("p_name").alias("song"),
        F.split("p_name", " ").alias("genres"),
    )
    return fact.join(dim, "l_partkey").select(
        "artist", "song", "genres", week_end(F.col("l_shipdate")).alias("date"), F.col("l_extendedprice").alias("v"),
        "l_orderkey", "l_linenumber", "l_suppkey",
    )


WEEKLY_SQL = f"""{TRACKS_SQL},
weekly AS (SELECT artist, song, date, sum(v) AS streams FROM tracks GROUP BY ALL)"""


def weekly_tracks(spark: SparkSession, d: str) -> DataFrame:
    """One row per (artist, song, week)."""
    return tracks(spark, d).groupBy("artist", "song", "date").agg(F.sum("v").alias("streams"))


GENRE_SQL = f"""{TRACKS_SQL},
genre_weekly AS (SELECT genre, date, sum(v) AS total FROM
    (SELECT unnest(genres) AS genre, date, v FROM tracks) GROUP BY ALL)"""


def genre_weekly(spark: SparkSession, d: str) -> DataFrame:
    """Weekly total per genre."""
    fact = table(spark, d, "lineitem").select(
        "l_partkey", week_end(F.col("l_shipdate")).alias("date"), F.col("l_extendedprice").alias("v")
    )
    dim = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.split("p_name", " ").alias("genres"))
    return genre_weekly_sum_of_facts(fact, dim, "l_partkey", "genres", "date", "v")


GRID_SQL = f"""{GENRE_SQL},
grid AS (SELECT g.genre, g.date, coalesce(w.total, 0) AS total FROM
    (SELECT genre, CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date
     FROM genre_weekly GROUP BY genre) g LEFT JOIN genre_weekly w ON g.genre = w.genre AND g.date = w.date),
split AS (SELECT *, row_number() OVER (PARTITION BY genre ORDER BY date) AS rn,
    count(*) OVER (PARTITION BY genre) AS n FROM grid)"""


def genre_grid(spark: SparkSession, d: str) -> DataFrame:
    """Weekly total per genre without gaps."""
    return fill_missing_weeks(genre_weekly(spark, d), ["genre"])


# --- forecasts and their scores ---------------------------------------------

NAIVE_SQL = f"""{GRID_SQL},
naive AS (SELECT genre, date, total AS actual,
    max_by(CASE WHEN rn <= n - 8 THEN total END, CASE WHEN rn <= n - 8 THEN date END)
    OVER (PARTITION BY genre) AS predicted, rn, n FROM split QUALIFY rn > n - 8 AND n >= 9)"""

MA_SQL = f"""{NAIVE_SQL},
sizes AS (SELECT unnest([2, 3, 4, 6, 8, 12]) AS ma_window),
means AS (SELECT genre, ma_window, avg(total) AS predicted FROM split, sizes
    WHERE rn <= n - 8 AND rn > n - 8 - ma_window AND n >= 8 + ma_window GROUP BY ALL),
ma AS (SELECT s.genre, s.date, m.ma_window, s.total AS actual, m.predicted
    FROM split s JOIN means m ON s.genre = m.genre WHERE s.rn > s.n - 8)"""

MA_BEST_SQL = f"""{MA_SQL},
window_mape AS (SELECT ma_window, avg(m) AS avg_mape FROM
    (SELECT genre, ma_window, 100 * avg(abs((actual - predicted) / nullif(actual, 0))) AS m FROM ma GROUP BY ALL) GROUP BY ALL),
best_ma AS (SELECT * FROM ma WHERE ma_window =
    (SELECT ma_window FROM window_mape ORDER BY avg_mape, ma_window LIMIT 1))"""

AR_SQL = f"""{MA_BEST_SQL},
moves AS (SELECT *, lag(total, 1) OVER s AS x1, lag(total, 2) OVER s AS x2 FROM split
    WINDOW s AS (PARTITION BY genre ORDER BY date)),
fits AS (SELECT *, regr_slope(total - x1, x1 - x2) OVER h AS slope, regr_intercept(total - x1, x1 - x2) OVER h AS icept
    FROM moves WINDOW h AS (PARTITION BY genre ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ar AS (SELECT genre, date, total AS actual, coalesce(x1 + icept + slope * (x1 - x2), x1, 0) AS predicted
    FROM fits WHERE rn > n - 8 AND n >= 112)"""

ALL_FORECASTS_SQL = f"""{AR_SQL},
forecasts AS (SELECT genre, date, 'Naive' AS model, actual, predicted FROM naive
    UNION ALL SELECT genre, date, 'MovingAverage', actual, predicted FROM best_ma
    UNION ALL SELECT genre, date, 'Autoregression', actual, predicted FROM ar)"""

SCORE_SQL = """avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
    100 * avg(abs((actual - predicted) / nullif(actual, 0))) AS mape"""

SCORED_SQL = f"""{ALL_FORECASTS_SQL},
scored AS (SELECT genre, model, {SCORE_SQL} FROM forecasts GROUP BY ALL)"""


def forecasts(spark: SparkSession, d: str) -> DataFrame:
    """Forecasts of the families that need no fitted model, all genres."""
    from weekloom.plans.genre_forecast import all_forecasts

    return all_forecasts(genre_weekly(spark, d), None, fitted=False)


def scored(spark: SparkSession, d: str) -> DataFrame:
    from weekloom.operators.scoring import evaluate_forecast

    return evaluate_forecast(forecasts(spark, d), ["genre", "model"])
