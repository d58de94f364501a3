"""Exact quantiles by counting passes equal the gathered ones, also for heavy
ties, outliers, tiny and dominant groups; columns and label profiles."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weekloom.operators import profile
from weekloom.operators.columns import (
    binary_columns,
    drop_empty_columns,
    drop_near_constant,
    ml_features,
    normalised,
)


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(9)
    rows = [("big", rng.lognormvariate(3, 2)) for _ in range(6000)]
    rows += [("ties", float(rng.choice([1, 1, 1, 2, 5]))) for _ in range(2000)]
    rows += [("outlier", rng.random()) for _ in range(1500)] + [("outlier", 1e12), ("outlier", -1e12)]
    rows += [("few", float(i)) for i in range(7)] + [("one", 4.5), ("none", None), (None, 2.5), (None, 3.5)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


def gathered(values):
    probs = F.array(*[F.lit(p) for p in profile.QUARTILES])
    return {r.g: r.q for r in values.dropna(subset=["v"]).groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_quantiles_are_exact(values, monkeypatch, most):
    """Also where brackets have to be narrowed until three rows or one value are left."""
    monkeypatch.setattr(profile, "BRACKET_ROWS", most)
    got, want = {r.g: r.q for r in profile.exact_quantiles(values, ["g"], "v").collect()}, gathered(values)
    assert set(got) == set(want) == {"big", "ties", "outlier", "few", "one", None}
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12), g


def test_quantiles_at_a_jump(spark):
    """Half of the rows close together, the rest far away."""
    jump = spark.range(8000).select(F.lit("a").alias("g"), F.when(F.col("id") < 6001, F.col("id") / 1e9).otherwise(F.col("id") * 1e9).alias("v"))
    assert profile.exact_quantiles(jump, ["g"], "v").first().q == pytest.approx(gathered(jump)["a"], rel=1e-12)


def test_profile_and_empty_input(values):
    row = profile.numeric_profile(values, ["v"]).first()
    whole = profile.exact_quantiles(values, [], "v").first().q
    assert whole == [row.q25, row.q50, row.q75] == pytest.approx(gathered(values.withColumn("g", F.lit("x")))["x"], rel=1e-12)
    none = values.limit(0)
    assert profile.exact_quantiles(none, [], "v").collect()[0].q is None
    assert profile.exact_quantiles(none, ["g"], "v").collect() == []
    empty = profile.numeric_profile(none, ["v"]).first()
    assert (empty["count"], empty.q25, empty.q50, empty.q75) == (0, None, None, None)


def test_rows_are_not_moved_by_group(values):
    plan = profile.box_stats(values, "g", "v")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_box_stats(values):
    few = profile.box_stats(values, "g", "v").filter("g = 'few'").first()
    assert (few.q1, few["median"], few.q3, few.whisker_low, few.whisker_high, few.outliers) == (1.5, 3.0, 4.5, 0.0, 6.0, 0)
    assert profile.box_stats(values, "g", "v").filter("g = 'outlier'").first().outliers == 2


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 3.0), (10.0, 3.0), (5.0, 3.0), (None, 3.0)], "a double, b double")
    got = {(r.column, r.bin): r.n for r in profile.histogram(df, ["a", "b"], 10).collect() if r.n}
    assert got == {("a", 0): 1, ("a", 5): 1, ("a", 9): 1, ("b", 5): 4}
    assert profile.histogram(df, ["a", "b"], 10).count() == 20


def test_column_choices(spark):
    rows = [(i % 2, i % 3, None, 0, None if i else 0, float(i), 0.5) for i in range(300)]
    df = spark.createDataFrame(
        rows,
        "deezer_genre_a int, deezer_genre_b int, deezer_genre_c int, z int, zn int, acoustic_x_prob double,"
        " acoustic_y_prob double",
    )
    assert {r.column: r.is_binary for r in binary_columns(df).collect()} == {
        "deezer_genre_a": True, "deezer_genre_b": False, "deezer_genre_c": False,
    }
    assert "acoustic_y_prob" not in drop_near_constant(df).columns and "acoustic_x_prob" in drop_near_constant(df).columns
    assert not {"z", "deezer_genre_c"} & set(drop_empty_columns(df).columns)
    assert "zn" in drop_empty_columns(df).columns  # nulls are not zeros
    assert normalised(" Peak (max) Position\t1 ") == "peakmaxposition_1"
    with pytest.raises(ValueError):
        ml_features(df.select("z"), "z")


def test_doubtful_columns_are_counted_exactly(spark, monkeypatch):
    import weekloom.operators.columns as columns

    df = spark.range(20_000).select(
        (F.col("id") % 199).alias("below"), (F.col("id") % 200).alias("at"), (F.col("id") % 201).alias("above"), F.lit(0.5).alias("constant"),
        F.col("id").alias("own"), F.lit(None).cast("double").alias("none"),
    )
    counted = []
    exact = columns.near_constant_columns
    monkeypatch.setattr(columns, "near_constant_columns", lambda d, names, ratio, approximate=False: counted.append((approximate, names)) or exact(d, names, ratio, approximate))
    assert columns.near_constant_names(df, df.columns) == ["below", "constant", "none"]
    assert counted == [(True, df.columns), (False, ["below", "at", "above"])]


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(3)
    wide = rng.normal(size=(400, 300)) * 10.0 ** rng.integers(-3, 4, 300) + 10.0 ** rng.integers(0, 6, 300)
    wide[:, 1] = wide[:, 0] * 2 + rng.normal(size=400) * 1e-3
    wide[:, 2] = 7.1
    frame = pd.DataFrame(wide, columns=[f"c{i}" for i in range(300)])
    frame = frame.mask(rng.random(frame.shape) < 0.1)
    frame["c3"] = np.nan
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"{c} double" for c in frame.columns)).repartition(5)
    got = profile.correlation_matrix(df, df.columns).toPandas().pivot(index="x", columns="y", values="r").loc[frame.columns, frame.columns]
    want = frame.corr()
    want.loc["c2"], want["c2"] = np.nan, np.nan
    expected = want.to_numpy(float, copy=True)
    np.fill_diagonal(expected, np.nan)
    np.testing.assert_allclose(got.to_numpy(float), expected, atol=1e-7)
    few = profile.correlation_matrix(df, ["c0", "c1", "c4"]).collect()
    assert all(r.r == pytest.approx(got.loc[r.x, r.y], abs=1e-9) for r in few)
    none = profile.gram_correlations(df.limit(0), ["c0", "c1"]).collect()
    assert [(r.x, r.y, r.r) for r in none] == [("c0", "c1", None), ("c1", "c0", None)]


def test_categorical_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert tuple(profile.categorical_profile(df, ["c"]).first()) == ("c", 4, 2, "a", 2)
    pct = profile.null_percent(df.withColumn("full", F.lit(1))).collect()
    assert [(r.column, r.pct) for r in pct] == [("c", 20.0)]
