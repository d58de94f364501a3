from pyspark.sql import functions as F

from weekloom.operators.scoring import actual_vs_predicted, dtw_distance, evaluate_forecast, metric_grid
from weekloom.plans.compare_models import combine_metrics, combine_predictions
from weekloom.plans.genre_forecast import naive_report
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import (
    ALL_FORECASTS_SQL,
    SCORE_SQL,
    SCORED_SQL,
    forecasts,
    genre_weekly,
    scored,
    table,
)
from weekloom.session import scratch_path
from weekloom.sources.writers import write_table


@query(
    "mae_rmse",
    "genre:s model:s mae:f2 rmse:f2",
    f"WITH {SCORED_SQL} SELECT genre, model, mae, rmse FROM scored",
)
def _mae_rmse(spark, d):
    return scored(spark, d)


_ERRORS_SQL = """errors AS (SELECT l_suppkey AS genre, CASE WHEN l_suppkey % 10 = 0 OR l_linenumber = 2 THEN 0
    ELSE l_extendedprice END AS actual, l_quantity * 1500 AS predicted FROM lineitem)"""


@query(
    "mape",
    "genre:i mape:f6",
    f"WITH {_ERRORS_SQL} SELECT genre, mape FROM (SELECT genre, {SCORE_SQL} FROM errors GROUP BY genre)",
)
def _mape(spark, d):
    zero = (F.col("l_suppkey") % 10 == 0) | (F.col("l_linenumber") == 2)
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("genre"),
        F.when(zero, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("actual"),
        (F.col("l_quantity") * 1500).alias("predicted"),
    )
    return evaluate_forecast(rows)


@query(
    "genre_naive_report",
    "genre:s mae:f2 rmse:f2 mape:f6",
    f"""WITH {SCORED_SQL} SELECT genre, mae, rmse, mape FROM scored WHERE model = 'Naive' AND genre IN
        (SELECT genre FROM genre_weekly GROUP BY genre ORDER BY sum(total) DESC, genre LIMIT 10)""",
)
def _genre_naive_report(spark, d):
    return naive_report(genre_weekly(spark, d))


@query(
    "combine_metrics",
    "genre:s model:s mae:f2 rmse:f2 mape:f6 sarima_order:s",
    f"""WITH {SCORED_SQL} SELECT genre, CASE model WHEN 'Autoregression' THEN 'SARIMA' ELSE model END AS model, mae, rmse, mape,
        CASE model WHEN 'Autoregression' THEN '(1,1,0)' END AS sarima_order FROM scored""",
)
def _combine_metrics(spark, d):
    folder = scratch_path(spark, "metrics")
    scores = scored(spark, d).persist()
    for model, name in (("Naive", "genre_naive"), ("MovingAverage", "BEST_genre_ma"), ("Autoregression", "genre_sarima")):
        part = scores.filter(F.col("model") == model).drop("model")
        if model == "Autoregression":
            part = part.withColumn("sarima_order", F.lit("(1,1,0)"))
        write_table(part, f"{folder}/{name}_metrics_top10_test8", "csv")
    scores.unpersist()
    return combine_metrics(spark, folder)


@query(
    "combine_predictions",
    "genre:s date:d model:s actual_streams:f2 predicted_streams_naive:f2 predicted_streams_best_ma:f4 predicted_streams_sarima:f2",
    f"""WITH {ALL_FORECASTS_SQL}, kept AS (SELECT * REPLACE (CASE WHEN model = 'Autoregression' THEN date + 21 ELSE date END AS date) FROM forecasts)
        SELECT genre, date, CASE model WHEN 'Autoregression' THEN 'SARIMA' ELSE model END AS model, actual AS actual_streams,
        CASE WHEN model = 'Naive' THEN predicted END AS predicted_streams_naive,
        CASE WHEN model = 'MovingAverage' THEN predicted END AS predicted_streams_best_ma,
        CASE WHEN model = 'Autoregression' THEN predicted END AS predicted_streams_sarima FROM kept
        WHERE date >= (SELECT min(date) FROM kept WHERE model = 'Autoregression')""",
)
def _combine_predictions(spark, d):
    folder = scratch_path(spark, "predictions")
    # one model's forecasts begin later, so the cut has something to cut
    later = F.expr("CASE WHEN model = 'Autoregression' THEN date_add(date, 21) ELSE date END")
    rows = forecasts(spark, d).withColumn("date", later).persist()
    for model, name, column in (
        ("Naive", "genre_naive", "naive"),
        ("MovingAverage", "BEST_genre_ma4", "best_ma"),
        ("Autoregression", "genre_sarima", "sarima"),
    ):
        part = rows.filter(F.col("model") == model).select(
            "date", "genre", F.col("actual").alias("actual_streams"), F.col("predicted").alias(f"predicted_streams_{column}"),
            F.lit(0.0).alias("unused"),
        )
        write_table(part, f"{folder}/{name}_predictions_top10_test8", "csv")
    rows.unpersist()
    return combine_predictions(spark, folder)


@query(
    "dtw_distance",
    "genre:s model:s dtw_distance:f2",
    f"""WITH RECURSIVE {ALL_FORECASTS_SQL},
        lists AS (SELECT genre, model, list(actual ORDER BY date) AS a, list(predicted ORDER BY date) AS b
            FROM forecasts GROUP BY ALL),
        diagonals AS (SELECT genre, model, 1 AS s, list_transform(range(0, 9), lambda i: CAST('inf' AS DOUBLE)) AS d1,
            list_transform(range(0, 9), lambda i: CASE WHEN i = 0 THEN 0 ELSE CAST('inf' AS DOUBLE) END) AS d2, a, b FROM lists
        UNION ALL SELECT genre, model, s + 1 AS s, list_transform(range(0, 9), lambda i: CASE WHEN i < 1 OR s + 1 - i < 1
            OR s + 1 - i > 8 THEN CAST('inf' AS DOUBLE) ELSE (a[i] - b[s + 1 - i]) * (a[i] - b[s + 1 - i])
            + least(d1[i], d1[i + 1], d2[i]) END) AS d1, d1 AS d2, a, b FROM diagonals WHERE s < 16)
        SELECT genre, model, sqrt(d1[9]) AS dtw_distance FROM diagonals WHERE s = 16""",
)
def _dtw_distance(spark, d):
    return dtw_distance(forecasts(spark, d))


@query(
    "metric_grid",
    "genre:s model:s place:i metric_type:s metric_value:f2",
    f"""WITH {SCORED_SQL}, named AS (SELECT * REPLACE (CASE WHEN model <> 'Naive' OR mape < 20 THEN mae END AS mae) FROM scored),
        kept AS (SELECT * FROM named WHERE mae IS NOT NULL AND rmse IS NOT NULL),
        covered AS (SELECT *, row_number() OVER (PARTITION BY genre ORDER BY mae, model) AS place FROM kept WHERE genre IN
            (SELECT genre FROM kept GROUP BY genre HAVING count(DISTINCT model) = (SELECT count(DISTINCT model) FROM kept)))
        SELECT genre, model, place, 'rmse' AS metric_type, rmse AS metric_value FROM covered
        UNION ALL SELECT genre, model, place, 'mae', mae FROM covered""",
)
def _metric_grid(spark, d):
    known = F.expr("CASE WHEN model <> 'Naive' OR mape < 20 THEN mae END")  # a score that is missing
    return metric_grid(scored(spark, d).withColumn("mae", known))


@query(
    "actual_vs_pred",
    "genre:s date:d actual:f2 Naive:f2 MovingAverage:f4 Autoregression:f2",
    f"""WITH {ALL_FORECASTS_SQL} SELECT genre, date, max(actual) AS actual,
        max(CASE WHEN model = 'Naive' THEN predicted END) AS "Naive",
        max(CASE WHEN model = 'MovingAverage' THEN predicted END) AS "MovingAverage",
        max(CASE WHEN model = 'Autoregression' THEN predicted END) AS "Autoregression" FROM forecasts GROUP BY genre, date""",
)
def _actual_vs_pred(spark, d):
    return actual_vs_predicted(forecasts(spark, d), ["Naive", "MovingAverage", "Autoregression"])
