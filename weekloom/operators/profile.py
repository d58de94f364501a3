"""Data profiles.  Quantiles are exact at any size, by one method: counts of value
buckets narrow the brackets of all wanted ranks together, and only the values
inside the last brackets are put in order."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.columns import _per_column
from weekloom.session import spread, stored

# The functions travel with their task: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUARTILES = (0.25, 0.5, 0.75)
HISTOGRAM_BINS = 30
WHISKER_IQR = 1.5

#: Most rows of one bracket that may be put in order in one task; brackets that
#: hold more are narrowed again.
BRACKET_ROWS = 1_000_000
#: Buckets that a pass counts in a bracket.
BUCKETS = 4096


def _joined(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``by`` in which null is a key like any other; the columns stay once."""
    if not by:
        return left.join(right)  # one row
    renamed = right.withColumnsRenamed({c: f"_b_{c}" for c in by})
    return left.join(renamed, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in by]), how).drop(*[f"_b_{c}" for c in by])


def _narrowed(rows: DataFrame, ranks: DataFrame, by: list[str]) -> DataFrame:
    """``ranks`` with brackets of about a ``BUCKETS``-th of their values: one pass counts
    the rows of every bucket of every bracket.  A new bracket runs from the least to
    the largest value of the bucket that holds the rank."""
    low, high, v = F.col("lo"), F.col("hi"), F.col("_v")
    brackets = ranks.filter("lo < hi").select(*by, "lo", "hi").distinct()
    part = (v / 2 - low / 2) / (high / 2 - low / 2)
    bucket = F.least(F.floor(part * BUCKETS), F.lit(BUCKETS - 1))
    inside = _joined(rows, brackets, by).filter(v.between(low, high))
    counts = inside.groupBy(*by, "lo", "hi", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("c"), F.min(v).alias("_from"), F.max(v).alias("_to"))
    ends = counts.withColumn("_end", F.sum("c").over(Window.partitionBy(*by, "lo", "hi").orderBy("bucket")))
    slots = ends.withColumnsRenamed({"lo": "_lo", "hi": "_hi"})
    met = (F.col("lo") == F.col("_lo")) & (F.col("hi") == F.col("_hi"))
    place = F.col("rank") - F.col("below")
    found = _joined(ranks.filter("lo < hi"), slots, by).filter(met & (place < F.col("_end")) & (place >= F.col("_end") - F.col("c")))
    below = F.col("below") + F.col("_end") - F.col("c")
    moved = found.select(*by, "j", "rank", F.col("_from").alias("lo"), F.col("_to").alias("hi"), below.alias("below"), F.col("c").alias("m"))
    return stored(moved.unionByName(ranks.filter("lo = hi")), "brackets")


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float] = QUARTILES, also: dict[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """``by`` plus the array ``q``: linearly interpolated quantiles of the values
    that are not null, and ``also`` further aggregates of them.  A null key is a group
    of its own, a group without values has no row; without ``by`` there is one row, and
    ``q`` is null if there are no values.

    A quantile lies between two ranks.  Each rank keeps a closed bracket of values
    that holds it and the number of rows below the bracket.  The first pass finds the
    least and the largest value; further passes narrow the brackets until each holds at
    most ``BRACKET_ROWS`` rows or one value.  The rows are stored once; brackets are one
    short row per group and rank, stored, so that Catalyst knows their size when it
    joins them to the rows; rows themselves are only counted, never moved by group."""
    by = list(by)
    number = F.col(value).cast("double")
    rows = stored(df.select(*by, F.when(~F.isnan(number), number).alias("_v")).filter("_v IS NOT NULL"), "values")
    v = F.col("_v")
    extra = {name: made(v) for name, made in (also or {}).items()}
    whole = rows.groupBy(*by).agg(F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"), *[c.alias(n) for n, c in extra.items()])
    whole = stored(whole, "groups")

    # ranks 2i and 2i + 1 are the neighbours of quantile i
    places = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    sides = [side(place).cast("bigint") for place in places for side in (F.floor, F.ceil)]
    listed = F.array(*[F.struct(F.lit(j).alias("j"), rank.alias("rank")) for j, rank in enumerate(sides)])
    ranks = whole.filter("_n > 0").select(
        *by, F.inline(listed), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.lit(0).cast("bigint").alias("below"), F.col("_n").alias("m")
    )
    ranks = ranks.select(*by, "j", "rank", "lo", "hi", "below", "m")

    def widest(now: DataFrame) -> int:
        return now.filter("lo < hi").agg(F.max("m")).first()[0] or 0

    ranks = _narrowed(rows, ranks, by)
    while widest(ranks) > BRACKET_ROWS:
        ranks = _narrowed(rows, ranks, by)

    # brackets of one value are settled; the values inside the others are put in order
    open_ranks = ranks.filter("lo < hi").drop("m")
    held = _joined(rows, open_ranks, by).filter(v.between(F.col("lo"), F.col("hi")))
    values = held.groupBy(*by, "j", "rank", "below", "_v").agg(F.count(F.lit(1)).alias("c"))
    end = F.col("below") + F.sum("c").over(Window.partitionBy(*by, "j").orderBy("_v"))
    at_rank = values.withColumn("end", end).filter((F.col("end") > F.col("rank")) & (F.col("end") - F.col("c") <= F.col("rank")))
    settled = ranks.filter("lo = hi").select(*by, "j", F.col("lo").alias("_v"))
    found = settled.unionByName(at_rank.select(*by, "j", "_v")).groupBy(*by).agg(*[F.max(F.when(F.col("j") == j, v)).alias(f"_at{j}") for j in range(2 * len(probs))])
    between = [
        F.col(f"_at{2 * i}") + (F.col(f"_at{2 * i + 1}") - F.col(f"_at{2 * i}")) * (place - F.floor(place)) for i, place in enumerate(places)
    ]
    q = F.when(F.col("_n") > 0, F.array(*between)).alias("q")
    return stored(_joined(whole, found, by, "left").select(*by, *extra, q), "quantiles")


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles and maximum per column."""
    columns = list(columns)
    basics = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    picks = [F.get("q", F.lit(i)).alias(name) for i, name in enumerate(("q25", "q50", "q75"))]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    found = exact_quantiles(df.select(F.inline(pairs)), ["column"], "value", also=basics)
    listed = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column"))  # a table without rows has columns too
    counted = listed.join(found, "column", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return counted.select("column", *basics, *picks)


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value (the smallest on a tie) and
    its frequency per text column.  Values are counted before any column's
    values meet, so a column with many distinct values stays distributed."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).dropna().groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("top"), F.max("n").alias("freq")
    )


def null_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percent of nulls of the columns that have any, most first."""
    columns = list(columns or df.columns)
    share = _per_column(df, columns, pct=lambda c: 100.0 * F.count_if(c.isNull()) / F.count(F.lit(1)))
    return share.filter("pct > 0").orderBy(F.desc("pct"), "column")


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers (the outermost values within 1.5 IQR of the box) and
    the number of points beyond them, per group."""
    rows = df.select(group, F.col(value).cast("double").alias(value)).dropna()
    quartiles = exact_quantiles(rows, [group], value).select(
        group, *[F.col("q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))]
    )
    reach = WHISKER_IQR * (F.col("q3") - F.col("q1"))
    v, low, high = F.col(value), F.col("q1") - reach, F.col("q3") + reach
    return (
        rows.join(quartiles, group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.when(v >= low, v)).alias("whisker_low"),
            F.max(F.when(v <= high, v)).alias("whisker_high"),
            F.count_if((v < low) | (v > high)).alias("outliers"),
        )
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins from each column's minimum to its maximum,
    the maximum in the last bin; empty bins are listed."""
    columns = list(columns)
    ranges = _per_column(df, columns, lo=lambda c: F.min(c.cast("double")), hi=lambda c: F.max(c.cast("double")))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    width = F.col("hi") - F.col("lo")
    inside = F.least(F.floor((F.col("v") - F.col("lo")) / F.nullif(width, F.lit(0.0)) * bins), F.lit(bins - 1))
    bin_no = F.when(width > 0, inside).otherwise(F.lit(bins // 2)).cast("int")
    # One range per column: the map is as wide as the schema.
    known = ranges.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("lo", "hi"))))).scalar()
    counts = (
        df.select(F.inline(pairs))
        .dropna()
        .withColumn("r", known[F.col("column")])
        .select("column", "v", "r.lo", "r.hi")
        .groupBy("column", "lo", "hi", bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    filled = counts.groupBy("column", "lo", "hi").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    step = (F.col("hi") - F.col("lo")) / bins
    return filled.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).select(
        "column",
        "bin",
        (F.col("lo") + F.col("bin") * step).alias("bin_start"),
        F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).alias("n"),
    )


#: Columns up to which every pair is an expression of one aggregation.
PAIRED_COLUMNS = 24
#: A variance below this share of the mean square is rounding.
_NO_VARIANCE = 1e-12


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, rows complete for the pair; null where a
    column does not vary in them.  One row per ordered pair of different columns.
    Few columns are pairs of expressions in one aggregation, many are blocks of
    products (see :func:`gram_correlations`)."""
    columns = list(columns)
    if len(columns) > PAIRED_COLUMNS:
        return gram_correlations(df, columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one_row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"`{a}|{b}`").alias("r"))
        for a, b in pairs
        for x, y in ((a, b), (b, a))
    ]
    return one_row.select(F.inline(F.array(*cells)))


def gram_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As :func:`correlation_matrix`, for hundreds of columns.  Each task multiplies its
    Arrow batches with their masks of present values, which gives counts, sums, squares
    and products of every pair at once; a task keeps them in one matrix of the width
    of the schema, and the rows of the matrices are added up by column.  Values are
    taken from the column's mean, so that products do not cancel."""
    columns, k = list(columns), len(columns)
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(columns)])
    centred = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).join(F.broadcast(means))  # one row
    values = centred.select(*[(F.col(f"c{i}") - F.col(f"m{i}")).alias(f"c{i}") for i in range(k)])
    kind = "i int, sums array<double>"
    type_ = [pa.int32(), pa.list_(pa.float64())]

    def rows(matrices: np.ndarray) -> pa.RecordBatch:
        n, s, q, p = matrices  # of (i, j): rows with both, sum of i, squares of i, products
        per_row = np.concatenate([n, s, s.T, q, q.T, p], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(range(k), type_[0]), pa.array(list(per_row), type_[1])], ["i", "sums"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, k, k))
        for batch in batches:
            for start in range(0, batch.num_rows, 8192):
                part = batch.slice(start, 8192)
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], axis=1)
                there = ~np.isnan(x)
                x, there = np.where(there, x, 0.0), there.astype(float)
                total += [there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x]
        if total.any():
            yield rows(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                new = sums.values.to_numpy(zero_copy_only=False)
                held[i] = held[i] + new if i in held else new
        for i, sums in held.items():
            n, mine, other, mine2, other2, products = sums.reshape(6, k)
            with np.errstate(invalid="ignore", divide="ignore"):
                a, b = mine2 / n - (mine / n) ** 2, other2 / n - (other / n) ** 2
                r = (products / n - mine / n * (other / n)) / np.sqrt(a * b)
                varies = (a > _NO_VARIANCE * mine2 / n) & (b > _NO_VARIANCE * other2 / n)
            r[~varies] = np.nan
            yield pa.RecordBatch.from_arrays([pa.array([i], type_[0]), pa.array([r], type_[1])], ["i", "sums"])

    spark = df.sparkSession
    found = spread(values.mapInArrow(partial, kind), "i").mapInArrow(added, kind)
    names = F.array(*map(F.lit, columns))
    listed = spark.range(1).select(F.posexplode(names).alias("i", "x"))  # a table without rows has columns too
    cells = listed.join(found, "i", "left").select("i", "x", F.posexplode(names).alias("j", "y"), "sums").filter("i <> j")
    return cells.select("x", "y", F.nanvl(F.get("sums", F.col("j")), F.lit(None)).alias("r"))


def correlations_with(matrix: DataFrame, target: str) -> DataFrame:
    """Correlations with one column, strongest positive first."""
    return matrix.filter(F.col("x") == target).select("y", "r").orderBy(F.desc_nulls_last("r"), "y")
