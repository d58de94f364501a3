"""Published figures for one leading series: its last 20 weeks and the errors
of the last-value, four-week-mean and seasonal forecasts of the last eight."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from weekloom.operators.forecast import moving_average, naive_last
from weekloom.operators.scoring import dtw_distance, evaluate_forecast

# Weekly totals up to 2025-03-23.
WEEKS = [
    969283961, 987881905, 988929646, 980879062, 970317716, 979092770, 1001515670, 1080943730, 902575141, 851865088,
    835180136, 810348377, 839163353, 902739739, 930547641, 932557785, 1023973601, 965155242, 1045295348, 811728572,
]
# Published seasonal forecasts of the last eight weeks.
SEASONAL = [
    837418365.4497747, 857508232.4439118, 899596250.000178, 923141226.8640548,
    927141446.2141984, 1010075993.3767064, 1010534764.739738, 1012338497.1122756,
]
# Published MAE, RMSE, MAPE and warping distance.
NAIVE = (121046783.125, 142982671.58314982, 12.404840822867925, 404416066.67445725)
MEAN_OF_FOUR = (93676086.125, 111436820.42279603, 9.620585214322022, 315190925.5793065)
SEASONAL_SCORES = (58058482.22214079, 83623093.88387512, 6.463053367353691, 209801319.01009527)


@pytest.fixture(scope="module")
def series(spark):
    last = date(2025, 3, 23)
    rows = [("pop", last - timedelta(weeks=len(WEEKS) - 1 - i), float(v)) for i, v in enumerate(WEEKS)]
    return spark.createDataFrame(rows, "genre string, date date, total double")


def check(forecast, want):
    scores = evaluate_forecast(forecast).first()
    assert (scores.mae, scores.rmse, scores.mape) == pytest.approx(want[:3], rel=1e-9)
    distance = dtw_distance(forecast, ["genre"]).first().dtw_distance
    assert distance == pytest.approx(want[3], rel=1e-9)


def test_naive(series):
    check(naive_last(series), NAIVE)


def test_moving_average(series):
    check(moving_average(series).filter("ma_window = 4"), MEAN_OF_FOUR)


def test_seasonal_scores(spark, series):
    dates = [r.date for r in series.orderBy("date").collect()][-8:]
    predicted = spark.createDataFrame(list(zip(dates, SEASONAL)), "date date, predicted double")
    check(series.join(predicted, "date").withColumn("actual", F.col("total")), SEASONAL_SCORES)


def test_metric_cases(spark):
    cases = {
        "basic": [(100.0, 90.0), (110.0, 120.0), (120.0, 120.0)],
        "zeros": [(0.0, 5.0), (10.0, 5.0)],
        "all_zero": [(0.0, 1.0), (0.0, 2.0)],
        "perfect": [(3.0, 3.0)],
    }
    rows = [(g, a, p) for g, pairs in cases.items() for a, p in pairs]
    df = spark.createDataFrame(rows, "genre string, actual double, predicted double")
    got = {r.genre: (r.mae, r.rmse, r.mape) for r in evaluate_forecast(df).collect()}
    assert got["basic"] == pytest.approx((20 / 3, (200 / 3) ** 0.5, 100 * (0.1 + 10 / 110) / 3))
    assert got["zeros"] == pytest.approx((5.0, 5.0, 50.0))
    assert got["all_zero"] == (1.5, pytest.approx(2.5**0.5), None)
    assert got["perfect"] == (0.0, 0.0, 0.0)
    empty = evaluate_forecast(df.filter("false"), []).first()
    assert (empty.mae, empty.rmse, empty.mape) == (None, None, None)
