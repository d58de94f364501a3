from pyspark.sql import Window
from pyspark.sql import functions as F

from weekloom.functions.text import primary_artist, tidy
from weekloom.operators.columns import computed_once
from weekloom.operators.rows import (
    complete_case,
    count_all_null_rows,
    cutoff_from_model,
    drop_bad_dates,
    drop_empty_keys,
    drop_null_key,
    keep_first,
    membership_filter,
    positive_metric,
    series_filter,
)
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import CLEAN_SQL, RAW_SQL, TRACKS_SQL, WEEKLY_SQL, raw_chart, table, tracks, weekly_tracks


@query(
    "drop_bad_dates",
    "Date:d Position:i Streams:i",
    f"""WITH {RAW_SQL} SELECT TRY_CAST("Date" AS DATE) AS "Date", "Position", "Streams" FROM raw
        WHERE TRY_CAST("Date" AS DATE) IS NOT NULL""",
)
def _drop_bad_dates(spark, d):
    return drop_bad_dates(raw_chart(spark, d), "Date")


@query(
    "drop_empty_keys",
    "artist:s song:s Streams:i",
    f'WITH {CLEAN_SQL} SELECT artist, song, "Streams" FROM keyed',
)
def _drop_empty_keys(spark, d):
    dated = drop_bad_dates(raw_chart(spark, d), "Date").select("Artists", "Song Title", "Streams")
    named = computed_once(dated, artist=primary_artist(tidy(F.col("Artists"))), song=tidy(F.col("Song Title")))
    return drop_empty_keys(named, "artist", "song")


@query(
    "positive_metric",
    "artist:s song:s date:d streams:f2 lag_1:f2",
    f"""WITH {WEEKLY_SQL} SELECT * FROM (SELECT artist, song, date, streams - 30000 AS streams,
        lag(streams - 30000) OVER (PARTITION BY artist, song ORDER BY date) AS lag_1 FROM weekly) WHERE streams > 0""",
)
def _positive_metric(spark, d):
    w = Window.partitionBy("artist", "song").orderBy("date")
    shifted = weekly_tracks(spark, d).withColumn("streams", F.col("streams") - 30000)
    return positive_metric(shifted.withColumn("lag_1", F.lag("streams").over(w)), "streams")


@query(
    "membership_filter",
    "artist:s song:s date:d v:f2",
    f"WITH {TRACKS_SQL} SELECT artist, song, date, v FROM tracks WHERE list_contains(genres, 'bolt')",
)
def _membership_filter(spark, d):
    return membership_filter(tracks(spark, d), "bolt")


@query(
    "series_filter",
    "date:d streams:f2",
    f"WITH {WEEKLY_SQL} SELECT date, streams FROM weekly, (SELECT p_brand, p_name FROM part "
    "ORDER BY p_partkey LIMIT 1) WHERE artist = p_brand AND song = p_name",
)
def _series_filter(spark, d):
    artist, song = table(spark, d, "part").orderBy("p_partkey").select("p_brand", "p_name").first()
    return series_filter(weekly_tracks(spark, d), artist, song, "streams")


@query(
    "drop_null_key",
    "genre:s o_orderkey:i",
    """SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS genre, o_orderkey FROM orders
        WHERE o_orderstatus <> 'F'""",
)
def _drop_null_key(spark, d):
    genre = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    return drop_null_key(table(spark, d, "orders").withColumn("genre", genre))


_CUTOFF_ROWS = """rows AS (SELECT l_orderkey, l_linenumber, l_shipdate AS date, CASE WHEN l_returnflag = 'A' AND
    l_shipdate >= TIMESTAMP '1999-01-01' THEN 'SARIMA' ELSE 'Naive' END AS model FROM lineitem)"""


@query(
    "cutoff_from_model",
    "l_orderkey:i l_linenumber:i date:d model:s",
    f"WITH {_CUTOFF_ROWS} SELECT * FROM rows WHERE date >= (SELECT min(date) FROM rows WHERE model = 'SARIMA')",
)
def _cutoff_from_model(spark, d):
    sarima = (F.col("l_returnflag") == "A") & (F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp"))
    rows = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").alias("date"),
        F.when(sarima, "SARIMA").otherwise("Naive").alias("model"),
    )
    return cutoff_from_model(rows)


_GAPPY = {
    "mae": "CASE WHEN l_linenumber <> 2 THEN l_quantity END",
    "rmse": "CASE WHEN l_linenumber <> 2 AND l_discount > 0.02 THEN l_extendedprice END",
}
_GAPPY_SQL = "rows AS (SELECT l_orderkey, " + ", ".join(f"{e} AS {c}" for c, e in _GAPPY.items()) + " FROM lineitem)"


def _gappy(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", *[F.expr(e).alias(c) for c, e in _GAPPY.items()])


@query(
    "complete_case",
    "l_orderkey:i mae:f2 rmse:f2",
    f"WITH {_GAPPY_SQL} SELECT * FROM rows WHERE mae IS NOT NULL AND rmse IS NOT NULL",
)
def _complete_case(spark, d):
    return complete_case(_gappy(spark, d), ["mae", "rmse"])


@query(
    "count_all_null_rows",
    "empty_rows:i rows:i",
    f"""WITH {_GAPPY_SQL} SELECT count(*) FILTER (mae IS NULL AND rmse IS NULL) AS empty_rows,
        count(*) AS "rows" FROM rows""",
)
def _count_all_null_rows(spark, d):
    return count_all_null_rows(_gappy(spark, d), ["mae", "rmse"])


@query(
    "dedup_keep_first",
    "artist:s song:s l_orderkey:i l_linenumber:i v:f2",
    f"""WITH {TRACKS_SQL} SELECT artist, song, l_orderkey, l_linenumber, v FROM tracks QUALIFY row_number() OVER
        (PARTITION BY artist, song ORDER BY l_orderkey, l_linenumber, date, v, l_suppkey) = 1""",
)
def _dedup_keep_first(spark, d):
    order = ["l_orderkey", "l_linenumber", "date", "v", "l_suppkey"]
    return keep_first(tracks(spark, d), ["artist", "song"], order)
