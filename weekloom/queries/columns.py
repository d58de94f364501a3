from pyspark.sql import functions as F

from weekloom.operators.columns import (
    binary_columns,
    drop_empty_columns,
    drop_listed,
    ml_features,
    near_constant_columns,
    normalise_names,
    prefix_columns,
    rename_snake,
    select_present,
)
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import RAW_SQL, raw_chart, table


@query(
    "rename_snake",
    "spotify_position:i spotify_last_week:s spotify_weeks_on_chart:s spotify_streams:i",
    f"""WITH {RAW_SQL} SELECT "Position" AS spotify_position, "Last Week" AS spotify_last_week,
        "Weeks on Chart" AS spotify_weeks_on_chart, "Streams" AS spotify_streams FROM raw""",
)
def _rename_snake(spark, d):
    raw = raw_chart(spark, d)
    return rename_snake(raw, raw.columns)


@query(
    "normalise_names",
    "orderkey:i totalpriceusd:f2 orderdate:d",
    "SELECT o_orderkey AS orderkey, o_totalprice AS totalpriceusd, o_orderdate AS orderdate FROM orders",
)
def _normalise_names(spark, d):
    messy = table(spark, d, "orders").select(
        F.col("o_orderkey").alias(" Order Key"),
        F.col("o_totalprice").alias("Total Price (USD)"),
        F.col("o_orderdate").alias("ORDER date "),
    )
    return normalise_names(messy)


@query(
    "prefix_columns",
    "c_custkey:i deezer_c_name:s deezer_c_acctbal:f2",
    "SELECT c_custkey, c_name AS deezer_c_name, c_acctbal AS deezer_c_acctbal FROM customer",
)
def _prefix_columns(spark, d):
    return prefix_columns(table(spark, d, "customer"), "deezer_", ["c_custkey"])


@query(
    "select_present",
    "p_partkey:i lastfm_duration_ms:i lastfm_album_name:s",
    "SELECT p_partkey, p_size AS lastfm_duration_ms, p_brand AS lastfm_album_name FROM part",
)
def _select_present(spark, d):
    wanted = {"listeners": "lastfm_listeners", "p_size": "lastfm_duration_ms", "p_brand": "lastfm_album_name"}
    return select_present(table(spark, d, "part"), wanted, ["p_partkey"])


@query(
    "drop_listed",
    "l_orderkey:i l_quantity:f2 width:i",
    "SELECT l_orderkey, l_quantity, 2 AS width FROM lineitem",
)
def _drop_listed(spark, d):
    wide = table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", F.col("l_partkey").alias("mbid"), F.col("l_suppkey").alias("deezer_track_id"),
        F.col("l_tax").alias("acoustic_ab_bpm"),
    )
    slim = drop_listed(wide)
    return slim.withColumn("width", F.lit(len(slim.columns)))


_FLAGS = {
    "deezer_genre_red": "CAST(p_name LIKE '%red%' AS INT)",
    "deezer_genre_bolt": "CASE WHEN p_size > 10 THEN CAST(p_name LIKE '%bolt' AS INT) END",
    "deezer_genre_size": "p_size",
    "deezer_genre_none": "CAST(NULL AS INT)",
    "deezer_genre_text": "p_brand",
}


@query(
    "binary_column_detect",
    "column:s filled:i is_binary:i",
    "WITH f AS (SELECT "
    + ", ".join(f"{e} AS {c}" for c, e in _FLAGS.items())
    + " FROM part) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS filled,
        CAST(coalesce(bool_and({c} IN (0, 1)), false) AS INT) AS is_binary FROM f"""
        for c in list(_FLAGS)[:4]
    ),
)
def _binary_column_detect(spark, d):
    flags = table(spark, d, "part").select(*[F.expr(e).alias(c) for c, e in _FLAGS.items()])
    return binary_columns(flags).withColumn("is_binary", F.col("is_binary").cast("int"))


_PROBS = {"acoustic_ab_mood_prob": "l_discount", "acoustic_ab_dance_prob": "l_extendedprice", "acoustic_ab_voice_prob": "l_tax"}


@query(
    "near_constant_filter",
    "column:s distinct_values:i distinct_ratio:f8 is_near_constant:i",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {e}) AS distinct_values,
        count(DISTINCT {e}) / count(*) AS distinct_ratio,
        CAST(count(DISTINCT {e}) / count(*) < 0.01 AS INT) AS is_near_constant FROM lineitem"""
        for c, e in _PROBS.items()
    ),
)
def _near_constant_filter(spark, d):
    probs = table(spark, d, "lineitem").select(*[F.col(e).alias(c) for c, e in _PROBS.items()])
    found = near_constant_columns(probs, list(_PROBS))
    return found.withColumn("is_near_constant", F.col("is_near_constant").cast("int"))


@query(
    "drop_all_zero_or_null_cols",
    "l_orderkey:i l_discount:f2 zero_or_null:f0 width:i",
    """SELECT l_orderkey, l_discount, CASE WHEN l_linenumber = 1 THEN NULL ELSE 0 END AS zero_or_null, 3 AS width
        FROM lineitem""",
)
def _drop_all_zero_or_null_cols(spark, d):
    wide = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_discount",
        F.when(F.col("l_linenumber") != 1, F.lit(0)).alias("zero_or_null"),
        (F.col("l_quantity") * 0).alias("zero"),
        F.when(F.col("l_quantity") < 0, F.col("l_quantity")).alias("never"),
    )
    slim = drop_empty_columns(wide)
    return slim.withColumn("width", F.lit(len(slim.columns)))


@query(
    "ml_feature_select",
    "l_orderkey:i l_linenumber:i quantity:f2 returned:i spotify_streams:f2 width:i",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 0 ELSE l_quantity END AS quantity,
        CAST(l_returnflag = 'R' AS INT) AS returned, l_extendedprice AS spotify_streams, 5 AS width FROM lineitem""",
)
def _ml_feature_select(spark, d):
    wide = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("quantity"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.col("l_tax").alias("spotify_peak_position"),
        F.col("l_linestatus").alias("song"),
        F.col("l_extendedprice").alias("spotify_streams"),
    )
    slim = ml_features(wide, "spotify_streams", ["l_orderkey", "l_linenumber"])
    return slim.withColumn("width", F.lit(len(slim.columns)))
