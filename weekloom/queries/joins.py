from pyspark.sql import functions as F

from weekloom.functions.dates import week_end
from weekloom.operators.columns import prefix_columns, select_present
from weekloom.operators.forecast import naive_last
from weekloom.operators.joins import (
    align_on_dates,
    fact_dim_left,
    first_per_clean_key,
    forecast_align,
    join_by_clean_key_left,
    join_by_id_left,
    pending_anti,
    top_semi,
)
from weekloom.operators.aggregates import total_per_group
from weekloom.operators.ranking import topn_genres
from weekloom.operators.windows import holdout_last_n
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import GENRE_SQL, NAIVE_SQL, WEEKLY_SQL, genre_grid, genre_weekly, table, week_sql, weekly_tracks


@query(
    "join_by_id_left",
    "l_orderkey:i l_linenumber:i mbid:f0 acoustic_p_brand:s acoustic_p_size:f0",
    """SELECT l_orderkey, l_linenumber, mbid, p_brand AS acoustic_p_brand, p_size AS acoustic_p_size
        FROM (SELECT *, CASE WHEN l_linenumber > 2 THEN l_partkey END AS mbid FROM lineitem)
        LEFT JOIN (SELECT * FROM part WHERE p_size <> 1) ON mbid = p_partkey""",
)
def _join_by_id_left(spark, d):
    base = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") > 2, F.col("l_partkey")).alias("mbid")
    )
    acoustic = table(spark, d, "part").select(
        F.when(F.col("p_size") != 1, F.col("p_partkey")).alias("mb_recording_id"), "p_brand", "p_size"
    )
    return join_by_id_left(base, prefix_columns(acoustic, "acoustic_", ["mb_recording_id"]), "mbid", "mb_recording_id")


def _shouted(spark, d):
    """Tracks whose names differ from the dimension's by case and blanks."""
    return table(spark, d, "part").select(
        "p_partkey", F.concat(F.lit("  "), F.upper("p_brand")).alias("artist"), F.upper("p_name").alias("song")
    )


@query(
    "join_by_clean_key_left",
    "p_partkey:i deezer_size:f0 deezer_price:f2",
    """SELECT a.p_partkey, b.p_size AS deezer_size, b.p_retailprice AS deezer_price FROM part a LEFT JOIN
        (SELECT *, CASE WHEN p_size > 25 THEN p_name END AS name FROM part QUALIFY row_number() OVER
            (PARTITION BY p_brand, name ORDER BY p_size, p_retailprice) = 1) b
        ON a.p_brand = b.p_brand AND a.p_name = b.name""",
)
def _join_by_clean_key_left(spark, d):
    albums = table(spark, d, "part").select(
        F.col("p_brand").alias("artist"), F.when(F.col("p_size") > 25, F.col("p_name")).alias("song"), F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )
    first = first_per_clean_key(albums, ["size", "price"], ["artist", "song"])
    return join_by_clean_key_left(_shouted(spark, d), prefix_columns(first, "deezer_", ["artist", "song"]))


@query(
    "join_tags_left",
    "p_partkey:i lastfm_listeners:f0 lastfm_tags_str:s",
    """SELECT a.p_partkey, b.n AS lastfm_listeners, b.tags AS lastfm_tags_str FROM part a LEFT JOIN
        (SELECT p_brand, CASE WHEN p_type <> 'PROMO' THEN p_name END AS name, count(*) AS n, replace(name, ' ', '|') AS tags FROM part
         GROUP BY ALL) b ON a.p_brand = b.p_brand AND a.p_name = b.name""",
)
def _join_tags_left(spark, d):
    tags = (
        table(spark, d, "part")
        .groupBy(F.col("p_brand").alias("artist"), F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("song"))
        .agg(F.count(F.lit(1)).alias("listeners"))
        .withColumns({"tags": F.replace("song", F.lit(" "), F.lit("|")), "unused": F.lit(1)})
    )
    wanted = {"listeners": "lastfm_listeners", "tags": "lastfm_tags_str", "album": "lastfm_album_name"}
    return join_by_clean_key_left(_shouted(spark, d), select_present(tags, wanted, ["artist", "song"]))


@query(
    "fact_dim_left",
    "artist:s song:s date:d streams:f2 price:f2",
    f"""WITH {WEEKLY_SQL} SELECT w.artist, w.song, w.date, w.streams, f.price FROM weekly w LEFT JOIN
        (SELECT p_brand, CASE WHEN p_size > 30 THEN p_name END AS name, max(p_retailprice) AS price FROM part GROUP BY ALL) f
        ON w.artist = f.p_brand AND w.song = f.name""",
)
def _fact_dim_left(spark, d):
    features = (
        table(spark, d, "part")
        .groupBy(F.col("p_brand").alias("artist"), F.when(F.col("p_size") > 30, F.col("p_name")).alias("song"))
        .agg(F.max("p_retailprice").alias("price"))
    )
    return fact_dim_left(weekly_tracks(spark, d), features)


@query(
    "pending_anti",
    "l_orderkey:i l_linenumber:i artist:s song:s",
    """SELECT l_orderkey, l_linenumber, p_brand AS artist, p_name AS song FROM lineitem JOIN part p ON l_partkey = p_partkey
        WHERE NOT EXISTS (SELECT 1 FROM part q WHERE q.p_size > 25 AND q.p_brand = p.p_brand AND q.p_name = p.p_name)""",
)
def _pending_anti(spark, d):
    named = table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("artist"), F.col("p_name").alias("song"), "p_size"
    )
    tasks = table(spark, d, "lineitem").join(named.drop("p_size"), "l_partkey")
    return pending_anti(tasks, named.filter("p_size > 25"))


@query(
    "top_semi",
    "genre:s date:d total:f2",
    f"""WITH {GENRE_SQL} SELECT genre, date, total FROM genre_weekly WHERE genre IN
        (SELECT genre FROM genre_weekly GROUP BY genre ORDER BY sum(total) DESC, genre LIMIT 10)""",
)
def _top_semi(spark, d):
    series = genre_weekly(spark, d)
    return top_semi(series, topn_genres(total_per_group(series)))


@query(
    "align_actual_pred",
    "date:d actual:f2 predicted:f2",
    f"""SELECT date, actual, predicted FROM (SELECT {week_sql("l_shipdate")} AS date, sum(l_extendedprice) AS actual,
        sum(CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN l_quantity END) AS predicted
        FROM lineitem GROUP BY 1) WHERE actual IS NOT NULL AND predicted IS NOT NULL""",
)
def _align_actual_pred(spark, d):
    some = (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1)
    rows = table(spark, d, "lineitem").select(
        week_end(F.col("l_shipdate")).alias("date"),
        F.col("l_extendedprice").alias("a"),
        F.when(some, F.col("l_quantity")).alias("p"),
    )
    return align_on_dates(rows, ["date"], "a", "p")


@query(
    "forecast_align",
    "genre:s date:d actual:f2 predicted:f2",
    f"WITH {NAIVE_SQL} SELECT genre, date, actual, predicted FROM naive",
)
def _forecast_align(spark, d):
    grid = genre_grid(spark, d)
    test = holdout_last_n(grid, ["genre"]).filter("is_test").select("genre", "date", F.col("total").alias("actual"))
    return forecast_align(test, naive_last(grid).drop("actual"))
