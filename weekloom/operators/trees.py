"""Tuned tree ensembles, one for each series.

Every series has a model of its own, searched on its own expanding folds: each
draw of the parameters is fitted on the rows before a fold and scored on it, the
draw with the least mean error is fitted to all training rows and predicts the
test rows.  A model sees no row of another series and none later than it predicts;
features look back only.

A series is never longer than the calendar, so Spark deals whole series to tasks and
no fit needs more than one.  Inside a task the trees of many series, draws and
folds grow in step: one aggregation over (tree, node, feature, bin) finds the best
splits of all of them.  A chunk of series is bounded by ``ENTRIES``.
"""

from __future__ import annotations

import random
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators.columns import feature_columns
from weekloom.operators.windows import (
    MIN_HISTORY,
    MODEL_LAGS,
    MODEL_ROLLS,
    TEST_WEEKS,
    add_time_series_features,
    fold_of,
    with_position,
)
from weekloom.session import spread

# The fit functions travel with their task: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DRAWS = 10
SPLITS = 3
SEED = 42

#: Rows of all trees that grow in step; bounds a worker to some 200 MB.
ENTRIES = 1 << 17
#: Cells of one histogram that are looked at together; a few arrays of so many stay in a core's cache.
CELLS = 1 << 15
#: Most bins of a feature.
BINS = 32

# Ranges of the random search (upper ends exclusive for whole
# numbers) and the parameters used when no draw could be scored.  The source also
# draws a row share for boosting, which its library does not use unless rows are
# drawn anew every so many rounds, and they are not.
FOREST_RANGES = {"trees": (50, 150), "depth": (5, 20), "split": (5, 20), "leaf": (3, 15)}
FOREST_DEFAULT = {"trees": 50, "depth": 10, "split": 10, "leaf": 5}
BOOSTING_RANGES = {
    "rounds": (50, 250), "rate": (0.01, 0.16), "leaves": (20, 60), "depth": (5, 20), "alpha": (0.0, 1.5),
    "lambda": (0.0, 1.5), "columns": (0.6, 1.0), "leaf": (5, 30),
}
BOOSTING_DEFAULT = {"rounds": 100, "rate": 0.1, "leaves": 31, "depth": 64, "alpha": 0.0, "lambda": 0.0, "columns": 1.0, "leaf": 20}


def draw_parameters(ranges: dict, draws: int, seed: int = SEED) -> list[dict]:
    rng = random.Random(seed)

    def one(low, high):
        return rng.randrange(low, high) if isinstance(low, int) else rng.uniform(low, high)

    return [{name: one(*bounds) for name, bounds in ranges.items()} for _ in range(draws)]


# --- trees that grow in step --------------------------------------------------


@dataclass
class Trees:
    """What each tree of a step is allowed: arrays with an entry for each tree."""

    depth: np.ndarray
    leaf: np.ndarray  # least rows of a leaf
    split: np.ndarray  # least rows of a node that is split
    leaves: np.ndarray  # most leaves
    alpha: np.ndarray
    ridge: np.ndarray
    columns: np.ndarray  # (tree, feature): may it be used?


def _strength(total: np.ndarray, weight: np.ndarray, alpha: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    if alpha.any():
        total = np.maximum(np.abs(total) - alpha, 0.0)
    return total * total / np.maximum(weight + ridge, 1e-12)


def _best_splits(
    bins: np.ndarray, row: np.ndarray, node: np.ndarray, weight: np.ndarray, target: np.ndarray,
    n_nodes: int, n_bins: int, tree: np.ndarray, may: Trees, open_: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature, last bin of the left side) of every node 0 to n_nodes - 1, by
    one aggregation over (node, feature, bin); a gain of 0 is no split."""
    n_features = bins.shape[1]
    width = n_features * n_bins
    gain, feature, cut = np.zeros(n_nodes), np.zeros(n_nodes, np.int64), np.zeros(n_nodes, np.int64)
    rows_of = np.bincount(node, minlength=n_nodes)
    able = open_ & (rows_of >= np.maximum(may.split[tree], 2 * may.leaf[tree]))  # the others need no histogram
    asked = np.flatnonzero(able)
    number = np.cumsum(able) - 1
    order = np.flatnonzero(able[node])
    order = order[np.argsort(node[order], kind="stable")]
    place = number[node[order]]
    block = max(1, CELLS // width)
    bounds = np.searchsorted(place, np.arange(0, len(asked) + block, block))
    shifted = bins + np.arange(n_features) * n_bins
    for k, first in enumerate(range(0, len(asked), block)):
        nodes = asked[first : first + block]
        here = slice(bounds[k], bounds[k + 1])
        mine, size = order[here], len(nodes) * width
        cell = shifted[row[mine]]
        cell += ((place[here] - first) * width)[:, None]
        cell = cell.ravel()

        def summed(values: np.ndarray, cell=cell, size=size) -> np.ndarray:
            flat = np.bincount(cell, np.repeat(values, n_features), size).reshape(-1, n_bins)
            return np.cumsum(flat, axis=1, out=flat)

        t = tree[nodes]
        held = np.bincount(cell, None, size).reshape(len(nodes), n_features, n_bins)
        count = held.cumsum(axis=2)
        leaf = may.leaf[t][:, None, None]
        # a cut behind a bin without rows is that before it
        allowed = (held > 0) & (count >= leaf) & (count <= rows_of[nodes][:, None, None] - leaf) & may.columns[t][:, :, None]
        at = np.flatnonzero(allowed)
        if not len(at):
            continue
        weights = weight[mine]
        total = summed(weights * target[mine])
        mass = count.reshape(-1, n_bins) if (weights == 1).all() else summed(weights)
        owner, pair = at // width, at // n_bins
        alpha, ridge = may.alpha[t], may.ridge[t]
        whole = _strength(total[:, -1], mass[:, -1], np.repeat(alpha, n_features), np.repeat(ridge, n_features))
        alpha, ridge = alpha[owner], ridge[owner]
        left, left_mass = total.ravel()[at], mass.ravel()[at]
        value = _strength(left, left_mass, alpha, ridge)
        value += _strength(total[:, -1][pair] - left, mass[:, -1][pair] - left_mass, alpha, ridge)
        value -= whole[pair]
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        most = np.maximum.reduceat(value, starts)
        # of splits that differ by rounding only, the first feature and bin
        least = np.where(most > 0, most * (1 - 1e-9), most)
        near = np.flatnonzero(value >= np.repeat(least, np.diff(np.append(starts, len(at)))))
        best = near[np.searchsorted(near, starts)]
        found = nodes[owner[starts]]
        gain[found] = value[best]
        feature[found], cut[found] = at[best] % width // n_bins, at[best] % n_bins
    gain[gain < 1e-9] = 0.0
    return gain, feature, cut


def grow(bins: np.ndarray, n_bins: int, row: np.ndarray, tree: np.ndarray, weight: np.ndarray, target: np.ndarray, may: Trees) -> np.ndarray:
    """The leaf that every entry falls in, numbered over all trees.  An entry is a row
    of a tree; entries of weight 0 are not trained on.  Trees whose leaves are limited
    split their best leaf first, the others all leaves at once."""
    n_trees = len(may.depth)
    owner, depth = np.arange(n_trees), np.zeros(n_trees, np.int64)
    at = tree.copy()  # node of each entry
    trained = weight > 0
    rows_of = np.bincount(tree[trained], minlength=n_trees)
    one_by_one = rows_of // np.maximum(may.leaf, 1) > may.leaves
    leaves = np.ones(n_trees, np.int64)
    gain, feature, cut = np.zeros(n_trees), np.zeros(n_trees, np.int64), np.zeros(n_trees, np.int64)
    fresh = np.arange(n_trees)
    while True:
        number = np.full(len(owner), -1)
        number[fresh] = np.arange(len(fresh))
        here = np.flatnonzero(trained & (number[at] >= 0))
        found = _best_splits(
            bins, row[here], number[at[here]], weight[here], target[here], len(fresh), n_bins,
            owner[fresh], may, depth[fresh] < may.depth[owner[fresh]],
        )
        gain[fresh], feature[fresh], cut[fresh] = found
        ready = np.flatnonzero(gain > 0)
        if len(ready):
            ranked = np.round(np.log(gain[ready]), 9)  # gains that differ by rounding only are equal
            order = ready[np.lexsort((ready, -ranked, owner[ready]))]
            first = np.concatenate([[True], owner[order][1:] != owner[order][:-1]])
            ready = order[(first | ~one_by_one[owner[order]]) & (leaves[owner[order]] < may.leaves[owner[order]])]
        if not len(ready):
            return at
        n = len(owner)
        child = np.full(n, -1)
        child[ready] = n + 2 * np.arange(len(ready))
        leaves += np.bincount(owner[ready], minlength=n_trees)
        moving = np.flatnonzero(child[at] >= 0)
        old = at[moving]
        at[moving] = child[old] + (bins[row[moving], feature[old]] > cut[old])
        gain[ready] = 0.0
        owner = np.concatenate([owner, np.repeat(owner[ready], 2)])
        depth = np.concatenate([depth, np.repeat(depth[ready] + 1, 2)])
        fresh = np.arange(n, n + 2 * len(ready))
        gain, feature, cut = (np.concatenate([x, np.zeros(len(fresh), x.dtype)]) for x in (gain, feature, cut))


def _medians(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Median of the values of each group 0 to n - 1; 0 for a group without."""
    order = np.lexsort((values, group))
    size = np.bincount(group, minlength=n)
    start = np.cumsum(size) - size
    sorted_ = np.append(values[order], 0.0)
    low, high = start + np.maximum(size - 1, 0) // 2, start + size // 2
    return np.where(size > 0, (sorted_[low] + sorted_[np.minimum(high, len(values))]) / 2, 0.0)


# --- the two families -----------------------------------------------------------


@dataclass
class Fit:
    """One model to fit: rows ``first`` to ``cut`` train it, rows ``cut`` to ``last`` are predicted."""

    first: int
    cut: int
    last: int
    params: dict


def _entries(fits: list[Fit]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, fit, is trained on) of every row of every fit."""
    size = np.array([f.last - f.first for f in fits])
    fit = np.repeat(np.arange(len(fits)), size)
    start = np.cumsum(size) - size
    row = np.arange(size.sum()) - start[fit] + np.array([f.first for f in fits])[fit]
    return row, fit, row < np.array([f.cut for f in fits])[fit]


def _limits(fits: list[Fit], n_features: int, **over: np.ndarray) -> dict:
    def of(name: str, default: float) -> np.ndarray:
        return np.array([f.params.get(name, default) for f in fits])

    big = 1 << 40
    plain = {"depth": of("depth", big), "leaf": of("leaf", 1), "split": of("split", 2), "leaves": of("leaves", big)}
    return plain | {"alpha": of("alpha", 0.0), "ridge": of("lambda", 0.0), "columns": np.ones((len(fits), n_features), bool)} | over


def forest(bins: np.ndarray, n_bins: int, y: np.ndarray, fits: list[Fit], seed: int) -> tuple[np.ndarray, ...]:
    """(row, fit, predicted) of the rows after each fit's cut: the mean over trees that
    are each grown on as many rows drawn with replacement."""
    predicted: dict[int, np.ndarray] = {i: np.zeros(f.last - f.cut) for i, f in enumerate(fits)}
    todo = [(i, t) for i, f in enumerate(fits) for t in range(f.params["trees"])]
    bags: dict[tuple[int, int], np.ndarray] = {}  # times that a tree holds each of so many rows
    while todo:
        size, n = 0, 0
        while n < len(todo) and (not n or size + fits[todo[n][0]].last - fits[todo[n][0]].first <= ENTRIES):
            size += fits[todo[n][0]].last - fits[todo[n][0]].first
            n += 1
        part, todo = todo[:n], todo[n:]
        trees = [fits[i] for i, _ in part]
        row, tree, trained = _entries(trees)
        weight = np.zeros(len(row))
        at = 0
        for f, (_, t) in zip(trees, part, strict=True):
            n_rows = f.cut - f.first
            if (t, n_rows) not in bags:
                drawn = np.random.default_rng([seed, t, n_rows]).integers(0, n_rows, n_rows)
                bags[t, n_rows] = np.bincount(drawn, minlength=n_rows)
            weight[at : at + n_rows] = bags[t, n_rows]
            at += f.last - f.first
        middle = np.bincount(tree, weight * y[row], len(trees)) / np.bincount(tree, weight, len(trees))
        target = y[row] - middle[tree]
        leaf = grow(bins, n_bins, row, tree, weight, target, Trees(**_limits(trees, bins.shape[1])))
        mass = np.bincount(leaf, weight)
        mean = np.bincount(leaf, weight * target) / np.maximum(mass, 1)
        value = mean[leaf] + middle[tree]
        asked = np.flatnonzero(~trained)
        ends = np.flatnonzero(np.concatenate([[True], tree[asked][1:] != tree[asked][:-1], [True]])) if len(asked) else []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            i = part[tree[asked[a]]][0]
            predicted[i] += value[asked[a:b]] / fits[i].params["trees"]
    row, fit, trained = _entries(fits)
    return row[~trained], fit[~trained], np.concatenate([predicted[i] for i in range(len(fits))] or [np.zeros(0)])


def boosting(bins: np.ndarray, n_bins: int, y: np.ndarray, fits: list[Fit], seed: int) -> tuple[np.ndarray, ...]:
    """(row, fit, predicted) of the rows after each fit's cut, for the absolute error:
    a tree fits the signs of the residuals and its leaves take their medians.  All
    fits take their next round together; one that finds no split is finished."""
    row, fit, trained = _entries(fits)
    rounds = np.array([f.params["rounds"] for f in fits])
    rate = np.array([f.params["rate"] for f in fits])
    share = [f.params["columns"] for f in fits]
    n_features = bins.shape[1]
    predicted = _medians(fit[trained], y[row[trained]], len(fits))[fit]
    live = np.arange(len(fits))
    for k in range(int(rounds.max(initial=0))):
        live = live[rounds[live] > k]
        if not len(live):
            break
        number = np.full(len(fits), -1)
        number[live] = np.arange(len(live))
        mine = np.flatnonzero(number[fit] >= 0)
        tree, r, t = number[fit[mine]], row[mine], trained[mine]
        ranks = np.random.default_rng([seed, k]).random(n_features).argsort().argsort()
        n_used = np.maximum(1, np.round(np.array([share[i] for i in live]) * n_features))
        columns = ranks[None, :] < n_used[:, None]
        residual = y[r] - predicted[mine]
        may = Trees(**_limits([fits[i] for i in live], n_features, columns=columns))
        leaf = grow(bins, n_bins, r, tree, t.astype(float), np.sign(residual), may)
        values = _medians(leaf[t], residual[t], int(leaf.max(initial=0)) + 1)
        split = np.zeros(len(live), bool)
        split[tree[leaf >= len(live)]] = True
        step = np.where(split[tree], values[leaf] * rate[fit[mine]], 0.0)
        predicted[mine] += step
        live = live[split]
    return row[~trained], fit[~trained], predicted[~trained]


@dataclass(frozen=True)
class Family:
    fit: Callable
    ranges: dict = field(hash=False)
    default: dict = field(hash=False)
    in_bin: int  # training rows that a bin stands for, on average at least


FAMILIES = {
    "rf": Family(forest, FOREST_RANGES, FOREST_DEFAULT, 1),
    "lgbm": Family(boosting, BOOSTING_RANGES, BOOSTING_DEFAULT, 3),
}


# --- search, one chunk of series at a time -------------------------------------


@dataclass
class Series:
    """Rows of one series in order: features, target, and the fold of each row
    (SPLITS + 1 for test rows)."""

    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray


def binned(series: list[Series], in_bin: int) -> tuple[np.ndarray, int]:
    """Bin of every value; edges lie between the values of the series' training
    rows, evenly among them where there are more than bins."""
    out, most = [], 1
    for s in series:
        train = s.x[s.fold <= SPLITS]
        mine = np.empty(s.x.shape, np.int64)
        n_bins = max(2, min(BINS, len(train) // in_bin))
        for j in range(s.x.shape[1]):
            values = np.unique(train[:, j])
            if len(values) > n_bins:
                values = values[np.linspace(0, len(values) - 1, n_bins).round().astype(int)]
            edges = (values[1:] + values[:-1]) / 2
            mine[:, j] = np.searchsorted(edges, s.x[:, j], "left")
            most = max(most, len(edges) + 1)
        out.append(mine)
    return np.concatenate(out), most


def search(series: list[Series], family: Family, candidates: list[dict], seed: int) -> list[tuple[np.ndarray, dict]]:
    """(predictions of the test rows, chosen parameters) of every series."""
    bins, n_bins = binned(series, family.in_bin)
    y = np.concatenate([s.y for s in series])
    start = np.concatenate([[0], np.cumsum([len(s.y) for s in series])]).tolist()
    fits, names = [], []
    for k, s in enumerate(series):
        edge = [int((s.fold < f).sum()) for f in range(1, SPLITS + 2)]
        if all(a > 0 and b > a for a, b in zip(edge, edge[1:])):
            for d, params in enumerate(candidates):
                fits += [Fit(start[k], start[k] + a, start[k] + b, params) for a, b in zip(edge, edge[1:])]
                names += [(k, d)] * SPLITS
    row, fit, predicted = family.fit(bins, n_bins, y, fits, seed)
    error = np.bincount(fit, np.abs(y[row] - predicted), len(fits)) / np.maximum(np.bincount(fit, minlength=len(fits)), 1)
    scores: dict[int, np.ndarray] = {}
    for (k, d), e in zip(names, error.tolist(), strict=True):
        scores.setdefault(k, np.zeros(len(candidates)))[d] += e / SPLITS
    chosen = [candidates[int(scores[k].argmin())] if k in scores else family.default for k in range(len(series))]
    last = [Fit(start[k], start[k] + int((s.fold <= SPLITS).sum()), start[k + 1], p) for k, (s, p) in enumerate(zip(series, chosen, strict=True))]
    _, fit, predicted = family.fit(bins, n_bins, y, last, seed)
    ends = np.cumsum(np.bincount(fit, minlength=len(last)))
    return list(zip(np.split(predicted, ends[:-1]), chosen, strict=True))


def _described(params: dict) -> str:
    return ", ".join(f"{k}={v:.4g}" for k, v in params.items())


def model_rows(df: DataFrame, family: str, keys: Sequence[str], date: str, target: str, test_weeks: int = TEST_WEEKS) -> DataFrame:
    """Series long enough for the family, with features that look back only, the place
    in the series (``rn`` of ``n``) and the fold of each training row; test rows have
    the fold after the last."""
    keys = list(keys)
    total, least_train = MIN_HISTORY[family]
    featured = add_time_series_features(
        df, date_col=date, metric_col=target, id_cols=keys, lag_windows=MODEL_LAGS, roll_windows=MODEL_ROLLS, shift=1
    )
    placed = with_position(featured, keys, date).filter((F.col("n") >= total) & (F.col("n") - test_weeks >= least_train))
    n_train = F.col("n") - test_weeks
    fold = F.when(F.col("rn") > n_train, F.lit(SPLITS + 1)).otherwise(fold_of(F.col("rn"), n_train, SPLITS))
    return placed.withColumn("fold", fold)


def tuned_ensemble(
    df: DataFrame, family: str, keys: Sequence[str] = ("artist", "song"), date: str = "date",
    target: str = "spotify_streams", draws: int = DRAWS, seed: int = SEED,
    test_weeks: int = TEST_WEEKS, ranges: dict | None = None,
) -> DataFrame:
    """Forecast of the last rows of every series by its best draw: keys, date,
    actual, predicted, and what was chosen."""
    keys, kind = list(keys), FAMILIES[family]
    rows = model_rows(df, family, keys, date, target, test_weeks)
    features = [c for c in feature_columns(rows, target) if c not in {*keys, "rn", "n", "fold"}]
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    y = F.coalesce(F.col(target).cast("double"), F.lit(0.0))
    ready = rows.select(*keys, date, (F.col("rn") == 1).alias("is_first"), "fold", y.alias("y"), x.alias("x"), "n")
    # dealt by another hash than the windows': Spark leaves out a second shuffle by the same one
    dealt = spread(ready, F.xxhash64(*keys)).sortWithinPartitions("n", *keys, date)
    candidates = draw_parameters(ranges or kind.ranges, draws, seed)
    n_keys, n_features = len(keys) + 1, len(features)
    per_row = SPLITS * draws  # entries that a row stands for, at most

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole series, about ``ENTRIES`` entries at a time."""
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            firsts = np.flatnonzero(batch.column(n_keys).to_numpy(zero_copy_only=False))
            done = 0
            for first in firsts.tolist():
                if n + first - done and (n + first - done) * per_row >= ENTRIES:
                    held.append(batch.slice(done, first - done))
                    yield pa.Table.from_batches(held)
                    held, n, done = [], 0, first
            held.append(batch.slice(done))
            n += batch.num_rows - done
        if n:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            start = np.flatnonzero(chunk.column(n_keys).to_numpy())
            fold, y = chunk.column(n_keys + 1).to_numpy(), chunk.column(n_keys + 2).to_numpy()
            x = chunk.column(n_keys + 3).combine_chunks().flatten().to_numpy().reshape(-1, n_features)
            ends = np.append(start[1:], len(y))
            series = [Series(x[a:b], y[a:b], fold[a:b]) for a, b in zip(start, ends, strict=True)]
            found = search(series, kind, candidates, seed)
            asked = chunk.filter(pa.array(fold > SPLITS))
            predicted = np.concatenate([p for p, _ in found])
            chosen = [_described(params) for p, params in found for _ in range(len(p))]
            columns = [*(asked.column(i) for i in range(n_keys)), asked.column(n_keys + 2), pa.array(predicted), pa.array(chosen, pa.string())]
            names = [*keys, date, "actual", "predicted", "best_params"]
            yield from pa.table(dict(zip(names, columns, strict=True))).to_batches()

    types = dict(ready.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in [*keys, date]) + ", actual double, predicted double, best_params string"
    return dealt.mapInArrow(run, schema)
