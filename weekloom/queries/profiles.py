from pyspark.sql import functions as F

from weekloom.operators.profile import (
    box_stats,
    categorical_profile,
    correlation_matrix,
    correlations_with,
    histogram,
    null_percent,
    numeric_profile,
)
from weekloom.queries.registry import query
from weekloom.operators.aggregates import label_occurrences
from weekloom.operators.joins import top_semi
from weekloom.operators.ranking import nlargest_labels
from weekloom.queries.stand_ins import TRACKS_SQL, table, tracks

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "numeric_profile",
    "column:s count:i mean:f4 std:f4 min:f2 q25:f4 q50:f4 q75:f4 max:f2",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
        quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75,
        max({c}) AS max FROM lineitem"""
        for c in _NUMBERS
    ),
)
def _numeric_profile(spark, d):
    return numeric_profile(table(spark, d, "lineitem"), _NUMBERS)


@query(
    "categorical_profile",
    "column:s count:i unique:i top:s freq:i",
    " UNION ALL ".join(
        f"""(SELECT '{c}' AS "column", (SELECT count({c}) FROM documents) AS count,
        (SELECT count(DISTINCT {c}) FROM documents) AS unique, {c} AS top, count(*) AS freq
        FROM documents GROUP BY {c} ORDER BY freq DESC, {c} LIMIT 1)"""
        for c in ("lang", "source", "text")
    ),
)
def _categorical_profile(spark, d):
    return categorical_profile(table(spark, d, "documents"), ["lang", "source", "text"])


_SPARSE = {"a": "l_quantity", "b": "CASE WHEN l_linenumber <> 2 THEN l_tax END", "c": "CASE WHEN l_discount > 0.05 THEN l_tax END"}


@query(
    "null_percent",
    "column:s pct:f6",
    "WITH s AS (SELECT "
    + ", ".join(f"{e} AS {c}" for c, e in _SPARSE.items())
    + ' FROM lineitem) SELECT * FROM ('
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", 100.0 * count(*) FILTER ({c} IS NULL) / count(*) AS pct FROM s""" for c in _SPARSE
    )
    + ") WHERE pct > 0",
)
def _null_percent(spark, d):
    return null_percent(table(spark, d, "lineitem").select(*[F.expr(e).alias(c) for c, e in _SPARSE.items()]))


@query(
    "box_stats",
    "genre:s n:i q1:f4 median:f4 q3:f4 whisker_low:f2 whisker_high:f2 outliers:i",
    f"""WITH {TRACKS_SQL}, rows AS (SELECT unnest(genres) AS genre, v * v / 1000 AS v FROM tracks),
        top AS (SELECT genre FROM rows GROUP BY genre ORDER BY count(*) DESC, genre LIMIT 5),
        q AS (SELECT genre, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
            quantile_cont(v, 0.75) AS q3 FROM rows WHERE genre IN (SELECT genre FROM top) GROUP BY genre)
        SELECT q.genre, n, q1, median, q3, min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
            max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
            count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
        FROM rows JOIN q ON rows.genre = q.genre GROUP BY ALL""",
)
def _box_stats(spark, d):
    rows = tracks(spark, d)
    top = nlargest_labels(label_occurrences(rows)).withColumnRenamed("label", "genre")
    exploded = rows.select(F.explode("genres").alias("genre"), (F.col("v") * F.col("v") / 1000).alias("v"))
    return box_stats(top_semi(exploded, top), "genre", "v")


@query(
    "histogram",
    "column:s bin:i bin_start:f4 n:i",
    " UNION ALL ".join(
        f"""(WITH r AS (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem), g AS (SELECT unnest(range(0, 30)) AS bin),
        c AS (SELECT CAST(least(floor(({c} - lo) / (hi - lo) * 30), 29) AS BIGINT) AS bin, count(*) AS n FROM lineitem, r GROUP BY 1)
        SELECT '{c}' AS "column", g.bin, lo + g.bin * ((hi - lo) / 30) AS bin_start, coalesce(n, 0) AS n
        FROM g LEFT JOIN c ON g.bin = c.bin, r)"""
        for c in _NUMBERS[:2]
    ),
)
def _histogram(spark, d):
    return histogram(table(spark, d, "lineitem"), _NUMBERS[:2])


_PAIRS = [(a, b) for i, a in enumerate((*_NUMBERS, "tax")) for b in (*_NUMBERS, "tax")[i + 1 :]]


@query(
    "correlation_matrix",
    "x:s y:s r:f6",
    "WITH s AS (SELECT *, CASE WHEN l_linenumber <> 3 THEN l_tax END AS tax FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, corr({a}, {b}) AS r FROM s" for a, b in _PAIRS for x, y in ((a, b), (b, a))
    ),
)
def _correlation_matrix(spark, d):
    tax = F.when(F.col("l_linenumber") != 3, F.col("l_tax"))
    return correlation_matrix(table(spark, d, "lineitem").withColumn("tax", tax), [*_NUMBERS, "tax"])


@query(
    "correlation_ranking",
    "y:s r:f6",
    " UNION ALL ".join(f"SELECT '{c}' AS y, corr(l_extendedprice, {c}) AS r FROM lineitem" for c in ("l_quantity", "l_discount")),
)
def _correlation_ranking(spark, d):
    return correlations_with(correlation_matrix(table(spark, d, "lineitem"), _NUMBERS), "l_extendedprice")
