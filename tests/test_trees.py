"""Tree ensembles: every tree of a step against one grown alone by recursion, the
search against a loop over draws and folds, and both registered queries."""


import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL
from weekloom.operators import trees
from weekloom.operators.trees import BOOSTING_RANGES, FAMILIES, FOREST_RANGES, SPLITS, Series, binned, draw_parameters, search, tuned_ensemble

SMALL_RANGES = {
    "rf": {"trees": (2, 6), "depth": (2, 6), "split": (2, 8), "leaf": (1, 5)},
    "lgbm": {"rounds": (2, 9), "rate": (0.1, 0.5), "leaves": (2, 6), "depth": (2, 6), "alpha": (0.0, 1.5), "lambda": (0.0, 1.5), "columns": (0.5, 1.0), "leaf": (1, 6)},
}


def series(n, seed, test=8):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)) * 4)
    y = x[:, 0] * 3 + np.where(x[:, 1] > 0, 20.0, 0.0) + rng.normal(size=n)
    size = (n - test) // (SPLITS + 1)
    first = n - test - SPLITS * size
    fold = np.array([0 if i < first else SPLITS + 1 if i >= n - test else (i - first) // max(size, 1) + 1 for i in range(n)])
    return Series(x, y, fold)


def strength(total, weight, alpha, ridge):
    return max(abs(total) - alpha, 0.0) ** 2 / max(weight + ridge, 1e-12)


def best_split(bins, rows, weight, target, p, features):
    found = [(0.0, None, None)]
    total, mass = sum(weight[i] * target[i] for i in rows), sum(weight[i] for i in rows)
    alpha, ridge, leaf = p.get("alpha", 0.0), p.get("lambda", 0.0), p["leaf"]
    for f in features:
        for cut in sorted({bins[i, f] for i in rows}):
            left = [i for i in rows if bins[i, f] <= cut]
            if len(left) < leaf or len(rows) - len(left) < leaf or len(rows) < p.get("split", 2):
                continue
            t, m = sum(weight[i] * target[i] for i in left), sum(weight[i] for i in left)
            gain = strength(t, m, alpha, ridge) + strength(total - t, mass - m, alpha, ridge) - strength(total, mass, alpha, ridge)
            if gain >= 1e-9:
                found.append((gain, f, cut))
    top = max(gain for gain, *_ in found)
    return next(x for x in found if x[0] >= top * (1 - 1e-9))


def plain_tree(bins, train, others, weight, target, p, features):
    """{row: leaf number}: the leaf with the best split is split next."""
    leaves, made = [(train, others, 0, best_split(bins, train, weight, target, p, features), 0)], 0
    while len(leaves) < p.get("leaves", 10**9):
        ready = [k for k, v in enumerate(leaves) if v[3][1] is not None and v[2] < p["depth"]]
        if not ready:
            break
        k = min(ready, key=lambda k: (-round(np.log(leaves[k][3][0]), 9), leaves[k][4]))
        mine, asked, depth, (_, f, cut), _ = leaves.pop(k)
        for side in (True, False):
            part = [i for i in mine if (bins[i, f] <= cut) == side]
            made += 1
            asked_here = [i for i in asked if (bins[i, f] <= cut) == side]
            leaves.append((part, asked_here, depth + 1, best_split(bins, part, weight, target, p, features), made))
    return {i: k for k, (mine, asked, *_) in enumerate(leaves) for i in [*mine, *asked]}, len(leaves)


def plain_forest(bins, y, first, cut, last, p, seed):
    out = np.zeros(last - cut)
    for t in range(p["trees"]):
        bag = np.bincount(np.random.default_rng([seed, t, cut - first]).integers(0, cut - first, cut - first), minlength=cut - first)
        weight = {first + i: int(n) for i, n in enumerate(bag)}
        train = [i for i in range(first, cut) if weight[i]]
        middle = sum(weight[i] * y[i] for i in train) / sum(weight[i] for i in train)
        target = {i: y[i] - middle for i in train}
        leaf, _ = plain_tree(bins, train, range(cut, last), weight, target, p, range(bins.shape[1]))
        for i in range(cut, last):
            held = [j for j in train if leaf[j] == leaf[i]]
            out[i - cut] += (middle + sum(weight[j] * target[j] for j in held) / sum(weight[j] for j in held)) / p["trees"]
    return out


def plain_boosting(bins, y, first, cut, last, p, seed):
    now = np.full(last - first, np.median(y[first:cut]))
    for k in range(p["rounds"]):
        ranks = np.random.default_rng([seed, k]).random(bins.shape[1]).argsort().argsort()
        features = [f for f in range(bins.shape[1]) if ranks[f] < max(1, np.round(p["columns"] * bins.shape[1]))]
        residual = {i: y[i] - now[i - first] for i in range(first, cut)}
        weight, target = dict.fromkeys(residual, 1), {i: np.sign(r) for i, r in residual.items()}
        leaf, n = plain_tree(bins, list(residual), range(cut, last), weight, target, p, features)
        if n == 1:
            break
        for number in range(n):
            step = np.median([residual[i] for i in residual if leaf[i] == number])
            for i in leaf:
                if leaf[i] == number:
                    now[i - first] += p["rate"] * step
    return now[cut - first :]


@pytest.mark.parametrize("family", ["rf", "lgbm"])
def test_search_equals_a_plain_loop(family):
    kind, fit = FAMILIES[family], plain_forest if family == "rf" else plain_boosting
    candidates = draw_parameters(SMALL_RANGES[family], 4, seed=3)
    many = [series(n, n) for n in (30, 41, 12, 60)]
    found = search(many, kind, candidates, 42)
    for s, (predicted, chosen) in zip(many, found, strict=True):
        bins, _ = binned([s], kind.in_bin)
        edge = [int((s.fold < f).sum()) for f in range(1, SPLITS + 2)]
        errors = [np.mean([np.abs(s.y[a:b] - fit(bins, s.y, 0, a, b, p, 42)).mean() for a, b in zip(edge, edge[1:])]) for p in candidates]
        assert chosen == candidates[int(np.argmin(errors))]
        assert predicted == pytest.approx(fit(bins, s.y, 0, edge[-1], len(s.y), chosen, 42), rel=1e-9, abs=1e-9)


def test_chunks_do_not_change_results(monkeypatch):
    many = [series(20 + k, k) for k in range(6)]
    candidates = draw_parameters(SMALL_RANGES["rf"], 3)
    want = search(many, FAMILIES["rf"], candidates, 42)
    monkeypatch.setattr(trees, "ENTRIES", 40)
    monkeypatch.setattr(trees, "CELLS", 100)
    got = [search([s], FAMILIES["rf"], candidates, 42)[0] for s in many]
    for (p, c), (q, d) in zip(want, got, strict=True):
        assert c == d and p == pytest.approx(q)


def test_a_series_without_folds_takes_the_default():
    s = series(30, 1)
    short = Series(s.x[:11], s.y[:11], np.array([0, 1, 2] + [SPLITS + 1] * 8))
    (predicted, chosen), _ = search([short, s], FAMILIES["rf"], draw_parameters(SMALL_RANGES["rf"], 2), 42)
    assert chosen == trees.FOREST_DEFAULT and len(predicted) == 8
    assert min(short.y[:3]) <= min(predicted) and max(predicted) <= max(short.y[:3])


def chart(spark):
    weeks = spark.range(60).select(F.date_add(F.lit("2020-01-05").cast("date"), (F.col("id") * 7).cast("int")).alias("date"), "id")
    level = (F.col("s") + 1) * 1000
    value = level + F.when(F.col("id") % 2 == 0, level * 0.4).otherwise(0) + F.rand(5) * 10
    rows = weeks.withColumn("s", F.explode(F.array(*[F.lit(i) for i in range(6)]))).select(
        F.lit("x").alias("artist"), F.col("s").cast("string").alias("song"), "date", value.alias("spotify_streams")
    )
    short = rows.filter("song = '0' AND date < '2020-02-20'").withColumn("song", F.lit("short"))
    return rows.union(short)


@pytest.mark.parametrize("family", ["rf", "lgbm"])
def test_trees_learn_the_pattern_of_a_series(spark, family):
    got = tuned_ensemble(chart(spark), family).toPandas()
    assert len(got) == 6 * 8 and set(got.song) == set("012345")
    error = (got.actual - got.predicted).abs().groupby(got.song).mean()
    assert all(error[str(k)] < 0.2 * 0.4 * (k + 1) * 1000 for k in range(6))
    assert got.groupby("song").best_params.nunique().max() == 1


def test_a_forecast_does_not_see_later_weeks_or_other_series(spark):
    rows = chart(spark).filter("song in ('1', '2')").persist()
    whole = tuned_ensemble(rows, "rf", draws=2, ranges=SMALL_RANGES["rf"]).toPandas()
    alone = tuned_ensemble(rows.filter("song = '1'"), "rf", draws=2, ranges=SMALL_RANGES["rf"]).toPandas()
    mine = whole[whole.song == "1"].sort_values("date").reset_index(drop=True)
    pd.testing.assert_frame_equal(mine, alone.sort_values("date").reset_index(drop=True))
    last = rows.agg(F.max("date")).first()[0]
    moved = rows.withColumn("spotify_streams", F.when(F.col("date") == last, 1e9).otherwise(F.col("spotify_streams")))
    again = tuned_ensemble(moved, "rf", draws=2, ranges=SMALL_RANGES["rf"]).toPandas()
    keys = ["song", "date"]
    both = whole.merge(again, on=keys)
    assert (both.predicted_x == both.predicted_y).all()


def test_draws_cover_the_ranges():
    drawn = draw_parameters(FOREST_RANGES, 10)
    assert len(drawn) == 10 and all(50 <= p["trees"] < 150 and 5 <= p["depth"] < 20 for p in drawn)
    assert all(20 <= p["leaves"] < 60 and 50 <= p["rounds"] < 250 for p in draw_parameters(BOOSTING_RANGES, 10))


@pytest.mark.parametrize("name,family", [("tuned_forest", "rf"), ("tuned_boosting", "lgbm")])
def test_registered_queries_run_the_whole_search(spark, name, family):
    got = entry.queries()[name](spark, SMALL).toPandas()
    total, least_train = trees.MIN_HISTORY[family]
    weekly = pd.read_parquet(f"{SMALL}/lineitem.parquet").merge(pd.read_parquet(f"{SMALL}/part.parquet"), left_on="l_partkey", right_on="p_partkey")
    weekly["date"] = weekly.l_shipdate.dt.to_period("W").dt.end_time.dt.date.astype(str)
    weekly = weekly.groupby(["p_brand", "p_name", "date"]).l_extendedprice.sum().reset_index()
    size = weekly.groupby(["p_brand", "p_name"]).date.transform("size")
    test = weekly[(size >= total) & (size - 8 >= least_train)].sort_values("date").groupby(["p_brand", "p_name"]).tail(8)
    want = sorted(zip(test.p_brand, test.p_name, test.date, test.l_extendedprice.round(2)))
    assert [w[:3] for w in want] == sorted(zip(got.artist, got.song, got.date))
    assert [w[3] for w in want] == pytest.approx([v for *_, v in sorted(zip(got.artist, got.song, got.date, got.actual))], abs=0.02)
    drawn = [trees._described(p) for p in draw_parameters(FAMILIES[family].ranges, 10)]
    assert set(got.best_params) <= set(drawn) | {trees._described(FAMILIES[family].default)}
    assert got.predicted.notna().all()


def test_histograms_only_where_a_split_is_allowed(monkeypatch):
    """A node with fewer rows than a split needs, or than two leaves, takes no cells."""
    rng = np.random.default_rng(3)
    looked, bincount = [], np.bincount
    monkeypatch.setattr(trees.np, "bincount", lambda x, *a, **k: looked.append(len(x)) or bincount(x, *a, **k))
    bins, n = rng.integers(0, 8, (60, 5)), 60
    row, tree = np.tile(np.arange(n), 3), np.repeat(np.arange(3), n)
    fits = [trees.Fit(0, n, n, {"leaf": leaf, "split": split}) for leaf, split in ((31, 2), (1, 61), (10, 20))]
    may = trees.Trees(**trees._limits(fits, 5))
    open_ = np.ones(3, bool)
    gain, _, _ = trees._best_splits(bins, row, tree, np.ones(3 * n), rng.normal(size=n)[row], 3, 8, np.arange(3), may, open_)
    assert gain[0] == gain[1] == 0 and gain[2] > 0
    assert max(looked) == n * 5
