from pyspark.sql import functions as F

from weekloom.queries.registry import query
from weekloom.queries.stand_ins import (
    GENRE_SQL,
    RAW_SQL,
    SCORED_SQL,
    genre_weekly,
    raw_chart,
    scored,
    table,
)
from weekloom.session import scratch_path
from weekloom.sources.readers import (
    cell_text,
    load_model_dataset,
    nonnull_keys,
    chart_page_rows,
    projected,
    read_csv_chart,
    read_with_enrichments,
    scan_result_files,
    week_schedule,
)
from weekloom.sources.writers import write_per_group, write_table


@query(
    "read_csv_chart",
    "Position:i Song~Title:s Artists:s Last~Week:s Peak~Position:s Weeks~on~Chart:s Streams:i Date:s",
    f"""WITH {RAW_SQL} SELECT "Position", nullif("Song Title", '') AS "Song Title", "Artists", "Last Week",
        "Peak Position", "Weeks on Chart", "Streams", "Date" FROM raw""",
)
def _read_csv_chart(spark, d):
    path = scratch_path(spark, "chart-csv")
    write_table(raw_chart(spark, d), path, "csv")
    read = read_csv_chart(spark, path)
    return read.withColumn("Song Title", F.nullif(F.col("Song Title"), F.lit("")))


@query(
    "read_optional",
    "o_orderkey:i c_mktsegment:s enrichments:i",
    "SELECT o_orderkey, c_mktsegment, 1 AS enrichments FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def _read_optional(spark, d):
    base, found = read_with_enrichments(
        spark, f"{d}/orders.parquet", {"customer": f"{d}/customer.parquet", "album": f"{d}/absent.parquet"}
    )
    customer = found["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return base.join(customer, "o_custkey", "left").withColumn("enrichments", F.lit(len(found)))


@query(
    "read_nonnull_keys",
    "mbid:s",
    "SELECT CAST(o_custkey AS VARCHAR) AS mbid FROM orders WHERE o_orderstatus <> 'P'",
)
def _read_nonnull_keys(spark, d):
    keyed = table(spark, d, "orders").withColumn("mbid", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    return nonnull_keys(keyed, "mbid")


@query("read_projected", "l_shipdate:d l_extendedprice:f2", "SELECT l_shipdate, l_extendedprice FROM lineitem")
def _read_projected(spark, d):
    return projected(table(spark, d, "lineitem"), "l_shipdate", "l_extendedprice")


@query(
    "scan_many_files",
    "genre:s model:s source_file:s mae:f2 rmse:f2 mape:f6",
    f"""WITH {SCORED_SQL} SELECT genre, CASE model WHEN 'Naive' THEN 'Naive' ELSE 'MovingAverage' END AS model,
        CASE model WHEN 'Naive' THEN 'genre_naive_metrics_test8' ELSE 'genre_ma_metrics_test8' END AS source_file,
        mae, rmse, mape FROM scored WHERE model IN ('Naive', 'MovingAverage')""",
)
def _scan_many_files(spark, d):
    folder = scratch_path(spark, "results")
    scores = scored(spark, d).persist()
    for model, name in (("Naive", "genre_naive"), ("MovingAverage", "genre_ma"), ("Autoregression", "combined_ar")):
        part = scores.filter(F.col("model") == model).drop("model")
        write_table(part, f"{folder}/{name}_metrics_test8", "csv")
    scores.unpersist()
    return scan_result_files(spark, folder, "metrics")


@query(
    "load_model_dataset",
    "artist:s song:s date:d spotify_streams:f2",
    """SELECT o_orderpriority AS artist, o_custkey AS song, o_orderdate AS date,
        o_totalprice AS spotify_streams FROM orders""",
)
def _load_model_dataset(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("artist"),
        F.col("o_custkey").alias("song"),
        F.col("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("spotify_streams"),
    )
    return load_model_dataset(rows)


@query(
    "write_table",
    "o_orderkey:i o_orderdate:d o_totalprice:f2",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders",
)
def _write_table(spark, d):
    path = scratch_path(spark, "table")
    write_table(table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), path)
    return spark.read.parquet(path)


@query("write_per_group", "genre:s date:d total:f2", f"WITH {GENRE_SQL} SELECT genre, date, total FROM genre_weekly")
def _write_per_group(spark, d):
    path = scratch_path(spark, "per-genre")
    write_per_group(genre_weekly(spark, d), path, "genre")
    return spark.read.parquet(path)


@query(
    "chart_page_rows",
    "page_id:i position:i title:s streams:i",
    r"""WITH items AS (SELECT page_id, regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1) AS l FROM pages),
    numbered AS (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS position FROM items)
    SELECT page_id, position + 1 AS position, length(l[position]) * 1001 AS streams, replace(replace(replace(replace(replace(
        trim(regexp_replace(l[position], '(?s)<[^>]*>', '', 'g')),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS title
    FROM numbered""",
)
def _chart_page_rows(spark, d):
    """Each list item of a page becomes a chart row, below a header and a short row."""
    items = F.regexp_extract_all("html", F.lit(r"(?s)<li\b[^>]*>(.*?)</li>"), F.lit(1))
    cell = '<td class="c" data-encore-id="tableCell">'

    def row(item):
        title = F.concat(F.lit('<span class="x StyledTruncatedTitle-y">'), F.regexp_replace(item, "(?s)<[^>]*>", ""), F.lit("</span>"))
        streams = F.format_number(F.length(item) * 1001, 0)
        cells = ["", "", title, "", "", "3", streams]
        return F.concat(
            F.lit('<tr data-encore-id="tableRow">'), *[F.concat(F.lit(cell), F.lit(c) if isinstance(c, str) else c, F.lit("</td>")) for c in cells], F.lit("</tr>")
        )

    short = f'<tr><th>Title</th></tr><tr data-encore-id="tableRow">{cell}short</td></tr>'
    charts = table(spark, d, "pages").select("page_id", F.concat(F.lit(short), F.array_join(F.transform(items, row), "")).alias("chart"))
    return chart_page_rows(charts, "chart", ["page_id"]).select(
        "page_id", F.col("Position").alias("position"), F.col("Song Title").alias("title"), F.col("Streams").alias("streams")
    )


@query(
    "week_schedule",
    "step:i week:d",
    """SELECT row_number() OVER (ORDER BY week DESC) - 1 AS step, week FROM (
        SELECT CAST(unnest(generate_series(hi, lo, INTERVAL '-7' DAY)) AS DATE) AS week
        FROM (SELECT max(o_orderdate) AS hi, min(o_orderdate) AS lo FROM orders))""",
)
def _week_schedule(spark, d):
    bounds = table(spark, d, "orders").agg(
        F.max("o_orderdate").cast("date").alias("start"), F.min("o_orderdate").cast("date").alias("end")
    )
    return week_schedule(bounds, "start", "end")
