from pyspark.sql import functions as F

from weekloom.functions import dates, labels, numbers, payloads, text
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import CLEAN_SQL, RAW_SQL, raw_chart, table, tidy_sql

# --- text -------------------------------------------------------------------

_TITLE = """CASE WHEN doc_id % 5 = 0 THEN concat(text, ' (feat. Guest) live') WHEN doc_id % 5 = 1
    THEN concat('"', text, ' [x]') WHEN doc_id % 5 = 2 THEN concat(text, ' (a) b (c)')
    WHEN doc_id % 5 = 3 THEN concat('“', text, '"" ') ELSE text END"""


@query("tidy", "doc_id:i title:s", f"SELECT doc_id, {tidy_sql(_TITLE)} AS title FROM documents")
def _tidy(spark, d):
    return table(spark, d, "documents").select("doc_id", text.tidy(F.expr(_TITLE)).alias("title"))


@query(
    "primary_artist",
    "Position:i Streams:i artist:s",
    f"""WITH {RAW_SQL} SELECT "Position", "Streams", trim(string_split(trim("Artists"), ',')[1]) AS artist FROM raw""",
)
def _primary_artist(spark, d):
    return raw_chart(spark, d).withColumn("artist", text.primary_artist(F.col("Artists")))


@query(
    "clean_key",
    "doc_id:i key:s",
    r"SELECT doc_id, regexp_replace(lower(concat('  ', text, ' ')), '^\s+|\s+$', '', 'g') AS key FROM documents",
)
def _clean_key(spark, d):
    return table(spark, d, "documents").select("doc_id", text.clean_key(F.concat(F.lit("  "), "text", F.lit(" "))).alias("key"))


_LABELS = "concat(' ', upper(p_name), ', ,', p_type, ' , ', p_brand, ',')"


@query(
    "split_labels",
    "p_partkey:i n:i labels:s",
    f"""SELECT p_partkey, len(l) AS n, list_aggregate(l, 'string_agg', ';') AS labels FROM (SELECT p_partkey, list_filter(
        list_transform(string_split({_LABELS}, ','), lambda x: lower(trim(x))), lambda x: x <> '') AS l FROM part)""",
)
def _split_labels(spark, d):
    found = labels.split_labels(F.expr(_LABELS))
    return table(spark, d, "part").select("p_partkey", F.size(found).alias("n"), F.array_join(found, ";").alias("labels"))


_LABEL = "concat(lower(p_type), '/', p_name, ' & ', p_brand, '-(x)')"


@query(
    "safe_label",
    "p_partkey:i genre:s tag:s",
    f"""SELECT p_partkey, replace(replace(replace({_LABEL}, ' ', '_'), '/', '_'), '&', 'and') AS genre,
        replace(replace(replace(replace(replace(replace({_LABEL}, ' ', '_'), '-', '_'), '/', '_'), '&', 'and'), '(', ''), ')', '')
        AS tag FROM part""",
)
def _safe_label(spark, d):
    c = F.expr(_LABEL)
    return table(spark, d, "part").select(
        "p_partkey", labels.safe_label(c).alias("genre"), labels.safe_label(c, tag=True).alias("tag")
    )


@query(
    "label_from_column",
    "p_partkey:i genre:s shown:s",
    """SELECT p_partkey, concat('espa', 'n', 'ol_', replace(p_name, ' ', '_')) AS genre, concat('Espanol ',
        upper(p_name[1]), string_split(p_name, ' ')[1][2:], ' ', upper(string_split(p_name, ' ')[2][1]),
        string_split(p_name, ' ')[2][2:]) AS shown FROM part""",
)
def _label_from_column(spark, d):
    column = F.concat(F.lit("deezer_genre_espaÃ±ol_"), F.replace("p_name", F.lit(" "), F.lit("_")))
    return table(spark, d, "part").select(
        "p_partkey", labels.label_from_column(column).alias("genre"), labels.display_label(column).alias("shown")
    )


_FILE = """CASE o_orderkey % 9 WHEN 0 THEN 'genre_NAIVE_metrics_top10.csv' WHEN 1 THEN 'BEST_genre_Prophet_metrics.csv'
    WHEN 2 THEN 'genre_sarima_metrics.csv' WHEN 3 THEN 'genre_RF_tscv_metrics.csv' WHEN 4 THEN 'genre_LGBM_metrics.csv'
    WHEN 5 THEN 'BEST_genre_ma4_x.csv' WHEN 6 THEN 'genre_ma12_x.csv' WHEN 7 THEN o_orderpriority
    ELSE concat(o_orderstatus, '_sarima_naive') END"""


@query(
    "model_from_filename",
    "o_orderkey:i metrics:s predictions:s",
    f"""SELECT o_orderkey, CASE WHEN f LIKE '%naive%' THEN 'Naive' WHEN f LIKE '%prophet%' THEN 'Prophet'
        WHEN f LIKE '%sarima%' THEN 'SARIMA' WHEN contains(f, 'genre_rf_') THEN 'RandomForest'
        WHEN contains(f, 'genre_lgbm_') THEN 'LightGBM' WHEN f LIKE '%ma%' THEN 'MovingAverage' ELSE 'Unknown' END AS metrics,
        CASE WHEN f LIKE '%naive%' THEN 'Naive' WHEN f LIKE '%prophet%' THEN 'Prophet'
        WHEN f LIKE '%sarima%' THEN 'SARIMA' WHEN contains(f, 'genre_rf_') THEN 'RandomForest'
        WHEN contains(f, 'genre_lgbm_') THEN 'LightGBM' WHEN f LIKE '%ma4%' THEN 'MovingAverage' ELSE 'Unknown' END
        AS predictions FROM (SELECT o_orderkey, lower({_FILE}) AS f FROM orders)""",
)
def _model_from_filename(spark, d):
    named = table(spark, d, "orders").select("o_orderkey", F.expr(_FILE).alias("f"))
    return named.select(
        "o_orderkey",
        labels.model_from_filename(F.col("f"), "metrics").alias("metrics"),
        labels.model_from_filename(F.col("f"), "predictions").alias("predictions"),
    )


@query(
    "join_names",
    "doc_id:i names:s cut:s",
    """SELECT doc_id, list_aggregate(w, 'string_agg', ', ') AS names, left(list_aggregate(w, 'string_agg', '|'), 255) AS cut
        FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)""",
)
def _join_names(spark, d):
    words = F.split("text", " ")
    return table(spark, d, "documents").select(
        "doc_id", text.join_names(words).alias("names"), text.join_names(words, "|", 255).alias("cut")
    )


# --- dates ------------------------------------------------------------------


@query(
    "iso_date_string",
    "o_orderkey:i date:s",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders",
)
def _iso_date_string(spark, d):
    return table(spark, d, "orders").select("o_orderkey", dates.iso_date(F.col("o_orderdate")).alias("date"))


@query(
    "week_period",
    "o_orderkey:i year_week:s",
    """SELECT o_orderkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') || '/' ||
        strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%Y-%m-%d') AS year_week FROM orders""",
)
def _week_period(spark, d):
    return table(spark, d, "orders").select("o_orderkey", dates.week_period(F.col("o_orderdate")).alias("year_week"))


@query(
    "week_end",
    "year_week:s date:d",
    f"""WITH {CLEAN_SQL} SELECT CASE WHEN "Position" = 7 THEN 'odd' ELSE year_week END AS year_week,
        CASE WHEN "Position" <> 7 THEN CAST(right(year_week, 10) AS DATE) END AS date FROM keyed""",
)
def _week_end(spark, d):
    from weekloom.plans.clean_chart import clean_rows

    rows = clean_rows(raw_chart(spark, d))
    period = F.when(F.col("Position") == 7, "odd").otherwise(F.col("year_week"))
    return rows.select(period.alias("year_week"), dates.period_end(period).alias("date"))


@query(
    "calendar_parts",
    "o_orderkey:i year:i month:i quarter:i weekofyear:i",
    """SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, quarter(o_orderdate) AS quarter,
        weekofyear(o_orderdate) AS weekofyear FROM orders""",
)
def _calendar_parts(spark, d):
    return table(spark, d, "orders").withColumns(dates.calendar_parts(F.col("o_orderdate")))


_RELEASES = """releases AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date,
    CASE WHEN l_linenumber <> 5 THEN CAST(o_orderdate AS DATE) END AS release
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _releases(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return table(spark, d, "lineitem").join(orders, "l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("date"),
        F.when(F.col("l_linenumber") != 5, F.col("o_orderdate").cast("date")).alias("release"),
    )


@query(
    "release_age_days",
    "l_orderkey:i l_linenumber:i date:d age:i",
    f"WITH {_RELEASES} SELECT l_orderkey, l_linenumber, date, coalesce(date - release, -1) AS age FROM releases",
)
def _release_age_days(spark, d):
    return _releases(spark, d).withColumn("age", dates.release_age_days(F.col("date"), F.col("release")))


@query(
    "release_parts",
    "l_orderkey:i l_linenumber:i date:d release_year:i release_month:i release_dayofweek:i",
    f"""WITH {_RELEASES} SELECT l_orderkey, l_linenumber, date, coalesce(year(release), 0) AS release_year,
        coalesce(month(release), 0) AS release_month, coalesce(isodow(release) - 1, -1) AS release_dayofweek FROM releases""",
)
def _release_parts(spark, d):
    return _releases(spark, d).withColumns(dates.release_parts(F.col("date"), F.col("release")))


@query(
    "is_new_release",
    "l_orderkey:i l_linenumber:i date:d is_new:i",
    f"""WITH {_RELEASES} SELECT l_orderkey, l_linenumber, date,
        CASE WHEN date - release BETWEEN 0 AND 28 THEN 1 ELSE 0 END AS is_new FROM releases""",
)
def _is_new_release(spark, d):
    return _releases(spark, d).withColumn("is_new", dates.is_new_release(F.col("date"), F.col("release")))


# --- numbers ----------------------------------------------------------------

_NUMBER = "CASE l_linenumber WHEN 1 THEN concat(l_returnflag, '1') WHEN 2 THEN '' ELSE CAST(l_quantity AS STRING) END"


_SUFFIXED = f"CASE WHEN l_linenumber = 2 THEN '12d' WHEN l_linenumber = 4 THEN '1f' ELSE {_NUMBER} END"


@query(
    "to_number_or_null",
    "l_orderkey:i l_linenumber:i number:f2",
    f"SELECT l_orderkey, l_linenumber, TRY_CAST({_SUFFIXED} AS DOUBLE) AS number FROM lineitem",
)
def _to_number_or_null(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.to_number(F.expr(_SUFFIXED)).alias("number")
    )


@query(
    "zero_to_null",
    "l_orderkey:i l_linenumber:i l_tax:f2",
    "SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS l_tax FROM lineitem",
)
def _zero_to_null(spark, d):
    return table(spark, d, "lineitem").withColumn("l_tax", numbers.zero_to_null(F.col("l_tax")))


@query(
    "weeks_to_days",
    "l_orderkey:i l_linenumber:i days:i",
    "SELECT l_orderkey, l_linenumber, l_quantity * 7 AS days FROM lineitem",
)
def _weeks_to_days(spark, d):
    return table(spark, d, "lineitem").withColumn("days", numbers.weeks_to_days(F.col("l_quantity")))


@query(
    "binarize",
    "l_orderkey:i l_linenumber:i flag:f0",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 4 THEN NULL WHEN l_quantity / 50 > 0.5 THEN 1 ELSE 0 END
        AS flag FROM lineitem""",
)
def _binarize(spark, d):
    prob = F.when(F.col("l_linenumber") != 4, F.col("l_quantity") / 50)
    return table(spark, d, "lineitem").withColumn("flag", numbers.binarize(prob))


_GROUPED = """CASE WHEN l_linenumber = 7 THEN ' ' ELSE concat(CAST(l_partkey AS STRING), ',',
    lpad(CAST(l_suppkey % 1000 AS STRING), 3, '0')) END"""


@query(
    "parse_grouped_int",
    "l_orderkey:i l_linenumber:i streams:i",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN 0 ELSE l_partkey * 1000 + l_suppkey % 1000 END
        AS streams FROM lineitem""",
)
def _parse_grouped_int(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.parse_grouped_int(F.expr(_GROUPED)).alias("streams")
    )


@query(
    "null_fill",
    "l_orderkey:i l_linenumber:i metric:f2 flag:s",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 2 THEN 0 ELSE l_quantity END AS metric,
        CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS flag FROM lineitem""",
)
def _null_fill(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.fill(F.when(F.col("l_linenumber") != 2, F.col("l_quantity")), 0).alias("metric"),
        numbers.fill(F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")), "").alias("flag"),
    )


# --- nested responses -------------------------------------------------------


def _responses(spark, d):
    """Service responses as JSON text, one row per release."""
    p = F.col
    hit = F.struct(p("p_partkey").alias("id"), F.struct(p("p_size").alias("id")).alias("album"))
    names = F.transform(F.split("p_name", " "), lambda n: F.struct(n.alias("name")))
    search = F.struct(F.when(p("p_partkey") % 10 != 0, F.array(hit)).otherwise(F.array()).alias("data"))
    track = F.struct(
        (p("p_size") * 10).alias("duration"), (p("p_size") > 25).alias("explicit_lyrics"),
        p("p_retailprice").alias("bpm"), (-p("p_retailprice") / 100).alias("gain"),
    )
    album = F.struct(
        F.lit("2001-02-03").alias("release_date"), F.struct(names.alias("data")).alias("genres"),
        (p("p_size") % 20).alias("nb_tracks"), p("p_type").alias("record_type"),
        (p("p_size") * 100).alias("duration"), F.lit(False).alias("explicit_lyrics"),
    )
    info = F.struct(
        F.when(p("p_size") > 5, p("p_partkey").cast("string")).alias("listeners"),
        (p("p_partkey") * 3).cast("string").alias("playcount"),
        F.when(p("p_size") > 40, F.struct(p("p_brand").alias("title"))).alias("album"),
        F.struct(names.alias("tag")).alias("toptags"),
    )
    mood = F.struct(p("p_type").alias("value"), (p("p_size") / 50).alias("probability"))
    high = F.struct(mood.alias("mood-party"), F.when(p("p_size") % 2 == 0, mood).alias("voice"), p("p_size").alias("bpm"))
    return table(spark, d, "part").select(
        "p_partkey",
        F.to_json(search).alias("search"),
        F.when(p("p_partkey") % 7 != 0, F.to_json(track)).alias("track"),
        F.when(p("p_partkey") % 9 != 0, F.to_json(album)).alias("album"),
        F.when(p("p_partkey") % 11 != 0, F.to_json(F.struct(info.alias("track")))).alias("info"),
        F.when(p("p_partkey") % 13 != 0, F.to_json(F.struct(high.alias("highlevel")))).alias("scores"),
    )


@query(
    "flatten_track_album",
    "p_partkey:i track_id:f0 duration_sec:f0 explicit_lyrics:s bpm:f2 gain:f4 album_id:f0 release_date:s genres:s "
    "album_track_count:f0 album_record_type:s album_duration_sec:f0",
    """SELECT p_partkey, CASE WHEN t THEN p_partkey END AS track_id, CASE WHEN t THEN p_size * 10 END AS duration_sec,
        CASE WHEN t THEN p_size > 25 END AS explicit_lyrics, CASE WHEN t THEN p_retailprice END AS bpm,
        CASE WHEN t THEN -p_retailprice / 100 END AS gain, CASE WHEN a THEN p_size END AS album_id,
        CASE WHEN a THEN '2001-02-03' END AS release_date, CASE WHEN a THEN replace(p_name, ' ', ',') END AS genres,
        CASE WHEN a THEN p_size % 20 END AS album_track_count, CASE WHEN a THEN p_type END AS album_record_type,
        CASE WHEN a THEN p_size * 100 END AS album_duration_sec
        FROM (SELECT *, p_partkey % 7 <> 0 AS t, p_partkey % 9 <> 0 AS a FROM part WHERE p_partkey % 10 <> 0)""",
)
def _flatten_track_album(spark, d):
    return payloads.flatten_track_album(_responses(spark, d), "search", "track", "album", ["p_partkey"])


@query(
    "flatten_tags",
    "p_partkey:i listeners:i playcount:i duration_ms:i album:s tags:s",
    """SELECT p_partkey, CASE WHEN ok AND p_size > 5 THEN p_partkey ELSE 0 END AS listeners,
        CASE WHEN ok THEN p_partkey * 3 ELSE 0 END AS playcount, 0 AS duration_ms,
        CASE WHEN ok AND p_size > 40 THEN p_brand END AS album, CASE WHEN ok THEN replace(p_name, ' ', '|') ELSE '' END AS tags
        FROM (SELECT *, p_partkey % 11 <> 0 AS ok FROM part)""",
)
def _flatten_tags(spark, d):
    return payloads.flatten_tags(_responses(spark, d), "info", ["p_partkey"])


@query(
    "flatten_scored_map",
    "p_partkey:i ab_mood_party_value:s ab_mood_party_prob:f4 ab_voice_prob:f4 ab_bpm:f1 error:s",
    """SELECT p_partkey, CASE WHEN ok THEN p_type END AS ab_mood_party_value, CASE WHEN ok THEN p_size / 50 END AS ab_mood_party_prob,
        CASE WHEN ok AND p_size % 2 = 0 THEN p_size / 50 END AS ab_voice_prob, CASE WHEN ok THEN p_size END AS ab_bpm,
        CASE WHEN NOT ok THEN 'failed' END AS error FROM (SELECT *, p_partkey % 13 <> 0 AS ok FROM part)""",
)
def _flatten_scored_map(spark, d):
    return payloads.flatten_scored_map(_responses(spark, d), "scores", ["p_partkey"], ["mood_party", "voice"], ["bpm"])


@query(
    "flatten_scored_map_long",
    "event_id:i name:s number:f0",
    """SELECT event_id, 'k' AS name, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS number FROM events""",
)
def _flatten_scored_map_long(spark, d):
    wrapped = table(spark, d, "events").select(
        "event_id", F.concat(F.lit('{"highlevel": '), "props", F.lit("}")).alias("payload")
    )
    return payloads.scored_features(wrapped, "payload", ["event_id"])


@query(
    "error_record",
    "event_id:i error:s",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 'failed' END AS error FROM events",
)
def _error_record(spark, d):
    payload = F.when(F.col("event_type") != "error", F.col("props"))
    return table(spark, d, "events").select("event_id", payloads.error_record(payload).alias("error"))
