from itertools import product

from pyspark.sql import Window
from pyspark.sql import functions as F

from weekloom.operators.decompose import acf, decompose_additive, pacf
from weekloom.operators.forecast import (
    CHANGEPOINT_SCALES,
    SEASONALITY_MODES,
    SEASONALITY_SCALES,
    arma_orders,
    autoregressive_forecast,
    drift,
    grid_tuned_trend_season,
    moving_average,
    naive_last,
    seasonal_ar,
    tune_ma_window,
    walk_forward_one_step,
)
from weekloom.functions.dates import week_end
from weekloom.operators.series import asfreq_fill0, resample_inferred_fill0, resample_month, resample_weekly_fill0
from weekloom.operators.trees import tuned_ensemble
from weekloom.plans.track_forecast import track_forecasts, track_model_metrics, track_models_to_genres
from weekloom.queries.registry import query
from weekloom.queries.stand_ins import (
    AR_SQL,
    GENRE_SQL,
    GRID_SQL,
    MA_BEST_SQL,
    MA_SQL,
    NAIVE_SQL,
    WEEKLY_SQL,
    genre_grid,
    genre_weekly,
    table,
    week_sql,
    weekly_tracks,
)


@query(
    "resample_weekly_fill0",
    "artist:s song:s date:d streams:f2",
    f"""WITH {WEEKLY_SQL} SELECT g.artist, g.song, g.date, coalesce(w.streams, 0) AS streams FROM
        (SELECT artist, song, CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date
         FROM weekly GROUP BY artist, song) g LEFT JOIN weekly w ON g.artist = w.artist AND g.song = w.song AND g.date = w.date""",
)
def _resample_weekly_fill0(spark, d):
    return resample_weekly_fill0(weekly_tracks(spark, d), ["artist", "song"], value="streams")


_STEPPED_SQL = f"""stepped AS (SELECT p_brand AS brand, CASE right(p_brand, 1)
        WHEN '5' THEN CAST(l_shipdate AS DATE) WHEN '4' THEN last_day(CAST(l_shipdate AS DATE))
        ELSE {week_sql("l_shipdate")} - CAST(right(p_brand, 1) AS INT) END AS date,
    sum(l_extendedprice) AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


@query(
    "resample_inferred_fill0",
    "brand:s date:d total:f2",
    f"""WITH {_STEPPED_SQL}, gaps AS (SELECT *, date - lag(date) OVER s AS gap, datediff('month', lag(date) OVER s, date) AS months
            FROM stepped WINDOW s AS (PARTITION BY brand ORDER BY date)),
        kinds AS (SELECT brand, count(*) >= 3 AND (min(gap) = max(gap) OR (min(months) = max(months) AND bool_and(date = last_day(date)))) AS regular
            FROM gaps GROUP BY brand),
        placed AS (SELECT brand, regular, CASE WHEN regular THEN date ELSE {week_sql("date")} END AS date, sum(total) AS total
            FROM stepped JOIN kinds USING (brand) GROUP BY ALL),
        every AS (SELECT brand, CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date
            FROM placed WHERE NOT regular GROUP BY brand UNION SELECT brand, date FROM placed WHERE regular)
        SELECT e.brand, e.date, coalesce(total, 0) AS total FROM every e LEFT JOIN placed p ON e.brand = p.brand AND e.date = p.date""",
)
def _resample_inferred_fill0(spark, d):
    ship, digit = F.to_date("l_shipdate"), F.right("p_brand", F.lit(1))
    place = F.when(digit == "5", ship).when(digit == "4", F.last_day(ship)).otherwise(F.date_sub(week_end(ship), digit.cast("int")))
    joined = table(spark, d, "lineitem").join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    rows = joined.groupBy(F.col("p_brand").alias("brand"), place.alias("date")).agg(F.sum("l_extendedprice").alias("total"))
    return resample_inferred_fill0(rows, ["brand"])


@query(
    "asfreq_fill0",
    "artist:s song:s date:d streams:f2",
    f"""WITH {WEEKLY_SQL} SELECT g.artist, g.song, g.date, coalesce(w.streams, 0) AS streams FROM
        (SELECT artist, song, CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date
         FROM weekly GROUP BY artist, song) g LEFT JOIN weekly w ON g.artist = w.artist AND g.song = w.song AND g.date = w.date""",
)
def _asfreq_fill0(spark, d):
    return asfreq_fill0(weekly_tracks(spark, d), ["artist", "song"], value="streams")


@query(
    "resample_month",
    "genre:s date:d total:f2",
    f"""WITH {GENRE_SQL}, months AS (SELECT genre, CAST(date_trunc('month', date) AS DATE) AS m, sum(total) AS total
        FROM genre_weekly GROUP BY 1, 2), every AS (SELECT genre, CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH))
        AS DATE) AS m FROM months GROUP BY genre) SELECT e.genre, last_day(e.m) AS date, coalesce(total, 0) AS total
        FROM every e LEFT JOIN months o ON e.genre = o.genre AND e.m = o.m""",
)
def _resample_month(spark, d):
    return resample_month(genre_weekly(spark, d), ["genre"])


@query(
    "naive_last",
    "genre:s date:d actual:f2 predicted:f2",
    f"WITH {NAIVE_SQL} SELECT genre, date, actual, predicted FROM naive",
)
def _naive_last(spark, d):
    return naive_last(genre_grid(spark, d))


@query(
    "moving_average",
    "genre:s date:d ma_window:i actual:f2 predicted:f4",
    f"WITH {MA_SQL} SELECT genre, date, ma_window, actual, predicted FROM ma",
)
def _moving_average(spark, d):
    return moving_average(genre_grid(spark, d))


@query(
    "tune_ma_window",
    "genre:s date:d ma_window:i actual:f2 predicted:f4",
    f"WITH {MA_BEST_SQL} SELECT genre, date, ma_window, actual, predicted FROM best_ma",
)
def _tune_ma_window(spark, d):
    return tune_ma_window(moving_average(genre_grid(spark, d)))


@query(
    "walk_forward_one_step",
    "genre:s date:d actual:f2 predicted:f2",
    f"""WITH {GRID_SQL}, moves AS (SELECT *, lag(total, 1) OVER s AS x1, lag(total, 2) OVER s AS x2 FROM split
        WINDOW s AS (PARTITION BY genre ORDER BY date)),
        fits AS (SELECT *, x1 + avg(x1 - x2) OVER (PARTITION BY genre ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM moves)
        SELECT genre, date, total AS actual, coalesce(p, x1, 0) AS predicted FROM fits WHERE rn > n - 8 AND n >= 112""",
)
def _walk_forward_one_step(spark, d):
    return walk_forward_one_step(genre_grid(spark, d), drift)


@query(
    "autoregressive_forecast",
    "genre:s date:d actual:f2 predicted:f2",
    f"WITH {AR_SQL} SELECT genre, date, actual, predicted FROM ar",
)
def _autoregressive_forecast(spark, d):
    return autoregressive_forecast(genre_grid(spark, d))


def _eliminated(name: str, source: str, size: int) -> str:
    """Common table expressions name_1 to name_<size>: column ``a`` of ``source``, rows of
    (coefficients, right side), after elimination of each unknown."""
    steps = []
    for k in range(1, size + 1):
        steps.append(
            f"""{name}_{k} AS (SELECT * REPLACE (CASE WHEN len(a) < {k} THEN a ELSE list_transform(a, lambda r, i: CASE WHEN i = {k}
            THEN list_transform(a[{k}], lambda z: z / a[{k}][{k}])
            ELSE list_transform(r, lambda z, j: z - r[{k}] * a[{k}][j] / a[{k}][{k}]) END) END AS a) FROM {name if k > 1 else source}{f"_{k - 1}" if k > 1 else ""})"""
        )
    return ",\n".join(steps)


def _products(columns: list[str], value: str) -> str:
    return "[" + ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in [*columns, value]) + "]" for a in columns) + "]"


_ARMA_TERMS = ["p1", "p2", "ps", "q1", "qs", "one"]
_ARMA_SQL = f"""{GRID_SQL},
changes AS (SELECT genre, date, rn, n, total, lag(total) OVER (PARTITION BY genre ORDER BY date) AS before FROM split WHERE n >= 112),
levels AS (SELECT *, CASE WHEN d = 0 THEN total ELSE total - before END AS x FROM changes, (SELECT unnest([0, 1]) AS d)),
lagged AS (SELECT *, lag(x, 1) OVER s AS x1, lag(x, 2) OVER s AS x2, lag(x, 3) OVER s AS x3, lag(x, 4) OVER s AS x4, lag(x, 52) OVER s AS x52,
    1.0 AS one FROM levels WINDOW s AS (PARTITION BY genre, d ORDER BY date)),
steps AS (SELECT genre, d, rn AS t FROM lagged WHERE rn > n - 8),
history AS (SELECT l.*, s.t FROM steps s JOIN lagged l ON l.genre = s.genre AND l.d = s.d AND l.rn <= s.t),
long_ar AS (SELECT genre, d, t, {_products(["x1", "x2", "x3", "x4", "one"], "x")} AS a FROM history WHERE rn < t AND rn - 4 > d GROUP BY ALL),
{_eliminated("ar", "long_ar", 5)},
shocks AS (SELECT h.*, CASE WHEN rn = h.t OR rn - 4 <= h.d THEN 0.0
    ELSE x - x1 * a[1][6] - x2 * a[2][6] - x3 * a[3][6] - x4 * a[4][6] - a[5][6] END AS e
    FROM history h JOIN ar_5 b ON h.genre = b.genre AND h.d = b.d AND h.t = b.t),
termed AS (SELECT *, x1 AS p1, x2 AS p2, x52 AS ps, lag(e, 1) OVER s AS q1, lag(e, 52) OVER s AS qs
    FROM shocks WINDOW s AS (PARTITION BY genre, d, t ORDER BY rn)),
moments AS (SELECT genre, d, t, count(*) AS m, {_products(_ARMA_TERMS, "x")} AS f, sum(x * x) AS yy
    FROM termed WHERE rn > 53 AND rn < t GROUP BY ALL),
orders AS (SELECT unnest(range(1, 49)) AS k, unnest([{", ".join(str([i + 1 for i in terms]) + "::INT[]" for terms, _ in arma_orders())}]) AS idx,
    unnest([{", ".join("'" + text.replace("%d)", "52)") + "'" for _, text in arma_orders())}]) AS text),
systems AS (SELECT *, list_transform(idx, lambda i: list_append(list_transform(idx, lambda j: f[i][j]), f[i][7])) AS a FROM moments, orders),
{_eliminated("fit", "systems", 6)},
scored_fits AS (SELECT *, m * ln(greatest(yy - coalesce(list_sum(list_transform(idx, lambda i, q: a[q][len(idx) + 1] * f[i][7])), 0), yy * 1e-12) / m)
    + ln(m) * len(idx) AS bic FROM fit_6),
best_fits AS (SELECT * FROM scored_fits QUALIFY row_number() OVER (PARTITION BY genre, t ORDER BY bic, d, k) = 1),
arma AS (SELECT b.genre, h.date, h.total AS actual, replace(b.text, '%d', b.d::VARCHAR) AS sarima_order,
    CASE WHEN b.d = 1 THEN h.before ELSE 0 END + coalesce(list_sum(list_transform(idx, lambda i, q:
        a[q][len(idx) + 1] * [h.p1, h.p2, h.ps, h.q1, h.qs, 1.0][i])), 0) AS predicted
    FROM best_fits b JOIN termed h ON h.genre = b.genre AND h.d = b.d AND h.t = b.t AND h.rn = b.t)"""


@query(
    "seasonal_ar_forecast",
    "genre:s date:d sarima_order:s actual:f2 predicted:f2",
    f"WITH {_ARMA_SQL} SELECT genre, date, sarima_order, actual, predicted FROM arma",
)
def _seasonal_ar_forecast(spark, d):
    return seasonal_ar(genre_grid(spark, d))


_GRID = list(product(CHANGEPOINT_SCALES, SEASONALITY_SCALES, SEASONALITY_MODES))
_FOURIER = [f"{fn}(2 * pi() * {k} * day / {period})" for period, order in ((365.25, 10), (7.0, 3)) for k in range(1, order + 1) for fn in ("sin", "cos")]
_TREND = ["1.0", "t", *(f"greatest(t - {k} * 0.8 / 25, 0.0)" for k in range(1, 26))]
_WIDTH = len(_TREND) + len(_FOURIER)


def _weighted(matrix: str, penalty: str) -> str:
    """A matrix with the penalty of row i on its diagonal."""
    return f"list_transform({matrix}, lambda r, i: list_transform(r, lambda z, j: z + CASE WHEN i = j THEN {penalty} ELSE 0 END))"


def _gram(columns: str, size: int) -> str:
    """Products of the first ``size`` columns with those and the one after."""
    return f"list_transform({columns}[1:{size}], lambda a: list_transform({columns}, lambda b: list_inner_product(a, b)))"


def _solution(size: int) -> str:
    return f"list_transform(a, lambda r: r[{size + 1}])"


_TREND_PENALTY = "CASE WHEN i <= 2 THEN 1e-8 ELSE 0.25 / (cp * cp) END"
_TREND_SEASON_SQL = f"""{GENRE_SQL},
placed AS (SELECT genre, date, total, date - DATE '1970-01-01' AS day, row_number() OVER (PARTITION BY genre ORDER BY date) AS rn,
    count(*) OVER (PARTITION BY genre) AS n FROM genre_weekly),
stages AS (SELECT *, n - 8 * stage AS upto FROM placed, (SELECT unnest([1, 2]) AS stage) WHERE n >= 60),
bases AS (SELECT genre, stage, max(abs(total)) AS scale, min(day) AS start, max(day) - min(day) AS span FROM stages WHERE rn <= upto GROUP BY ALL),
timed AS (SELECT s.*, scale, total / scale AS y, (day - start) / span AS t FROM stages s JOIN bases b ON s.genre = b.genre AND s.stage = b.stage
    WHERE rn <= upto + 8),
drawn AS (SELECT *, [{", ".join(_TREND)}] AS tx, [{", ".join(_FOURIER)}] AS sx FROM timed),
scales AS (SELECT unnest([{", ".join(str(c) for c in CHANGEPOINT_SCALES)}]) AS cp),
trend_rows AS (SELECT genre, stage, list(list_append(tx, y) ORDER BY rn) AS m FROM drawn WHERE rn <= upto GROUP BY ALL),
trend_columns AS (SELECT genre, stage, list_transform(range(1, {len(_TREND) + 2}), lambda i: list_transform(m, lambda r: r[i])) AS c FROM trend_rows),
trend_grams AS (SELECT genre, stage, {_gram("c", len(_TREND))} AS g FROM trend_columns),
trend_systems AS (SELECT genre, stage, cp, {_weighted("g", _TREND_PENALTY)} AS a FROM trend_grams, scales),
{_eliminated("trend", "trend_systems", len(_TREND))},
variants AS (SELECT genre, stage, cp, 'multiplicative' AS mode, {_solution(len(_TREND))} AS level FROM trend_{len(_TREND)}
    UNION ALL SELECT genre, stage, cp, 'additive', CAST(NULL AS DOUBLE[]) FROM trend_grams, scales),
designed AS (SELECT d.genre, d.stage, cp, mode, date, total, rn, upto, scale, y,
    list_concat(tx, list_transform(sx, lambda s: s * coalesce(list_inner_product(tx, level), 1.0))) AS x
    FROM drawn d JOIN variants v ON d.genre = v.genre AND d.stage = v.stage),
design_rows AS (SELECT genre, stage, cp, mode, list(list_append(x, y) ORDER BY rn) AS m FROM designed WHERE rn <= upto GROUP BY ALL),
design_columns AS (SELECT genre, stage, cp, mode, list_transform(range(1, {_WIDTH + 2}), lambda i: list_transform(m, lambda r: r[i])) AS c FROM design_rows),
design_grams AS (SELECT genre, stage, cp, mode, {_gram("c", _WIDTH)} AS g FROM design_columns),
combos AS (SELECT unnest(range({len(_GRID)})) AS k, unnest([{", ".join(str(c) for c, _, _ in _GRID)}]) AS cp,
    unnest([{", ".join(str(s) for _, s, _ in _GRID)}]) AS sp, unnest([{", ".join(f"'{m}'" for *_, m in _GRID)}]) AS mode,
    unnest([{", ".join(f"'changepoint={c}, seasonality={s}, mode={m}'" for c, s, m in _GRID)}]) AS best_params),
ridge AS (SELECT genre, stage, k, g.cp, g.mode, best_params,
    {_weighted("g", f"CASE WHEN i <= 2 THEN 1e-8 WHEN i <= {len(_TREND)} THEN 0.25 / (g.cp * g.cp) ELSE 0.25 / (sp * sp) END")} AS a
    FROM design_grams g JOIN combos c ON g.cp = c.cp AND g.mode = c.mode),
{_eliminated("fitted", "ridge", _WIDTH)},
predictions AS (SELECT f.genre, f.stage, k, best_params, date, total AS actual, list_inner_product(x, {_solution(_WIDTH)}) * scale AS predicted
    FROM fitted_{_WIDTH} f JOIN designed d ON f.genre = d.genre AND f.stage = d.stage AND f.cp = d.cp AND f.mode = d.mode WHERE rn > upto),
tuned AS (SELECT genre, k FROM predictions WHERE stage = 2 GROUP BY genre, k
    QUALIFY row_number() OVER (PARTITION BY genre ORDER BY avg(abs((actual - predicted) / nullif(actual, 0))), k) = 1)"""


@query(
    "grid_tuned_trend_season",
    "genre:s date:d best_params:s actual:f2 predicted:f2",
    f"""WITH {_TREND_SEASON_SQL} SELECT p.genre, date, best_params, actual, predicted
        FROM predictions p JOIN tuned t ON p.genre = t.genre AND p.k = t.k WHERE stage = 1""",
)
def _grid_tuned_trend_season(spark, d):
    return grid_tuned_trend_season(genre_weekly(spark, d))


_LONGEST_SQL = f"""{WEEKLY_SQL},
longest AS (SELECT artist, song, count(*) AS n FROM weekly GROUP BY ALL ORDER BY n DESC, artist, song LIMIT 200),
tested AS (SELECT w.artist, w.song, w.date, w.streams, l.n - row_number() OVER (PARTITION BY w.artist, w.song ORDER BY w.date) < 8 AS is_test
    FROM weekly w JOIN longest l ON w.artist = l.artist AND w.song = l.song)"""


def _genres(spark, d):
    named = table(spark, d, "part").select(F.col("p_brand").alias("artist"), F.col("p_name").alias("song"))
    return named.distinct().withColumn("genres", F.split("song", " "))


@query(
    "track_forest_by_genre",
    "genre:s date:d actual:f2 in_range:s",
    f"""WITH {_LONGEST_SQL} SELECT genre, date, sum(streams) AS actual, 'true' AS in_range
        FROM (SELECT DISTINCT unnest(string_split(song, ' ')) AS genre, * FROM tested WHERE is_test) GROUP BY genre, date""",
)
def _track_forest_by_genre(spark, d):
    # a forest's forecast is a mean of training values: each track's lies between its least and its largest
    rows = weekly_tracks(spark, d)
    forecasts = track_forecasts(rows, "rf", target="streams").drop("best_params")
    last = Window.partitionBy("artist", "song").orderBy(F.desc("date"))
    train = rows.withColumn("_p", F.row_number().over(last)).filter("_p > 8").groupBy("artist", "song")
    bounds = train.agg(F.min("streams").alias("low"), F.max("streams").alias("high"))
    near = 1 + F.lit(1e-9)
    inside = (F.col("predicted") * near >= F.col("low")) & (F.col("predicted") <= F.col("high") * near)
    judged = forecasts.join(bounds, ["artist", "song"]).withColumn("outside", F.when(inside, 0.0).otherwise(1.0))
    genres = _genres(spark, d)
    outside = track_models_to_genres(judged.drop("predicted").withColumnRenamed("outside", "predicted"), genres)
    return outside.withColumn("in_range", F.col("predicted") == 0)


@query(
    "track_model_metrics",
    "genre:s model:s mae:f2 rmse:f2 mape:f4",
)
def _track_model_metrics(spark, d):
    return track_model_metrics(weekly_tracks(spark, d).withColumnRenamed("streams", "spotify_streams"), _genres(spark, d))


@query("tuned_forest", "artist:s song:s date:d actual:f2 predicted:f2 best_params:s")
def _tuned_forest(spark, d):
    return tuned_ensemble(weekly_tracks(spark, d), "rf", target="streams")


@query("tuned_boosting", "artist:s song:s date:d actual:f2 predicted:f2 best_params:s")
def _tuned_boosting(spark, d):
    return tuned_ensemble(weekly_tracks(spark, d), "lgbm", target="streams")


@query(
    "decompose_additive",
    "genre:s date:d observed:f2 trend:f3 seasonal:f3 residual:f3",
    f"""WITH {GRID_SQL}, ma AS (SELECT genre, date, total, rn, n, count(*) OVER f AS c, sum(total) OVER f AS t,
         lag(total, 26) OVER s AS a, lead(total, 26) OVER s AS b FROM split WINDOW s AS (PARTITION BY genre ORDER BY date),
         f AS (PARTITION BY genre ORDER BY date ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING)),
        trended AS (SELECT genre, date, total, (rn - 1) % 52 AS phase,
            CASE WHEN c = 53 THEN (t - (a + b) / 2) / 52 END AS trend FROM ma WHERE n >= 104),
        phases AS (SELECT genre, phase, avg(total - trend) AS m FROM trended GROUP BY ALL),
        centred AS (SELECT genre, phase, m - avg(m) OVER (PARTITION BY genre) AS seasonal FROM phases)
        SELECT t.genre, t.date, total AS observed, trend, seasonal, total - trend - seasonal AS residual
        FROM trended t JOIN centred c ON t.genre = c.genre AND t.phase = c.phase""",
)
def _decompose_additive(spark, d):
    return decompose_additive(genre_grid(spark, d))


_ACF_SQL = f"""{GRID_SQL}, centred AS (SELECT genre, rn, n, total - avg(total) OVER (PARTITION BY genre) AS c FROM split),
    lags AS (SELECT CAST(unnest(range(0, 53)) AS BIGINT) AS lag),
    products AS (SELECT a.genre, lag, sum(a.c * b.c) AS s FROM centred a, lags, centred b
        WHERE a.genre = b.genre AND b.rn = a.rn + lag AND a.n >= 57 GROUP BY ALL),
    acf AS (SELECT genre, lag, s / max(CASE WHEN lag = 0 THEN s END) OVER (PARTITION BY genre) AS acf FROM products)"""


@query("acf", "genre:s lag:i acf:f8", f"WITH {_ACF_SQL} SELECT genre, lag, acf FROM acf WHERE lag > 0")
def _acf(spark, d):
    return acf(genre_grid(spark, d))


@query(
    "acf_overall",
    "series:s lag:i acf:f8",
    f"""WITH {GRID_SQL}, overall AS (SELECT date, sum(total) AS total FROM grid GROUP BY date),
    placed AS (SELECT total - avg(total) OVER () AS c, row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM overall),
    lags AS (SELECT unnest(range(0, least(104, (SELECT count(*) FROM overall) // 2 - 1) + 1)) AS lag),
    products AS (SELECT lag, sum(a.c * b.c) AS s FROM placed a, lags, placed b WHERE b.rn = a.rn + lag GROUP BY lag)
    SELECT 'all' AS series, lag, s / (SELECT s FROM products WHERE lag = 0) AS acf FROM products WHERE lag > 0""",
)
def _acf_overall(spark, d):
    overall = genre_grid(spark, d).groupBy("date").agg(F.sum("total").alias("total")).withColumn("series", F.lit("all"))
    return acf(overall, ["series"], overall=True)


@query(
    "pacf",
    "genre:s lag:i pacf:f6",
    f"""WITH RECURSIVE {_ACF_SQL}, arrays AS (SELECT genre, list(acf ORDER BY lag) AS r FROM acf GROUP BY genre),
        levels AS (SELECT genre, CAST(1 AS BIGINT) AS k, [r[2]] AS phi, 1 - r[2] * r[2] AS v, r FROM arrays
        UNION ALL SELECT genre, k + 1 AS k,
            list_append(list_transform(range(1, k + 1), lambda j: phi[j] - step * phi[k + 1 - j]), step) AS phi,
            v * (1 - step * step) AS v, r
        FROM (SELECT *, (r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j]))) / v AS step
            FROM levels WHERE k < 52))
        SELECT genre, k AS lag, phi[k] AS pacf FROM levels""",
)
def _pacf(spark, d):
    return pacf(genre_grid(spark, d))
