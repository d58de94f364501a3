"""Column management: renaming, projection and data-driven column choice.

The data-driven choices return a small table with one row per candidate
column; ``chosen`` turns such a table into a list of names, which is bounded
by the width of the schema.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from weekloom.session import stored

# Columns the cleaning step drops when present.
ID_COLUMNS = (
    "mbid", "mb_recording_id", "error", "acoustic_ab_genre_tzanetakis_value",
    "deezer_track_id", "deezer_album_id", "deezer_genres",
)
WEAK_COLUMNS = (
    "acoustic_ab_length", "acoustic_ab_tempo_confidence", "acoustic_ab_tonal_confidence",
    "acoustic_ab_rhythm_level", "acoustic_ab_bpm", "acoustic_ab_mood_aggressive_prob",
    "deezer_genre_list",
)
DURATION_COLUMNS = (
    "album_duration", "album_track_count", "deezer_album_duration", "deezer_album_track_count",
    "lastfm_duration_ms",
)

# Columns that are no model features (both spellings of a name).
NON_FEATURES = (
    "artist", "song", "date", "deezer_release_date", "spotify_position",
    "spotify_peakposition", "spotify_peak_position", "spotify_weeksonchart", "spotify_weeks_on_chart",
    "spotify_days_on_chart", "apple_pos", "apple_days", "apple_pk", "avg_position",
    "avg_peak_position", "combined_days_on_chart", "deezer_album_record_type",
    "spotify_lastweek", "spotify_last_week",
)

NEAR_CONSTANT_RATIO = 0.01


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are evaluated exactly once per row.  A plain projection
    may be merged into every expression or filter that uses its result, which
    repeats costly work; a generator keeps its place in the plan."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def snake(name: str, prefix: str = "spotify_") -> str:
    return prefix + name.lower().replace(" ", "_")


def rename_snake(df: DataFrame, columns: Iterable[str], prefix: str = "spotify_") -> DataFrame:
    return df.withColumnsRenamed({c: snake(c, prefix) for c in columns})


def normalised(name: str) -> str:
    """Blanks and parentheses are removed, other white space becomes ``_``."""
    bare = re.sub(r"[ ()]", "", name.strip().lower())
    return re.sub(r"\s+", "_", bare)


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalised(c) for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    kept = set(keep)
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in kept})


def select_present(df: DataFrame, wanted: dict[str, str], keys: Iterable[str] = ()) -> DataFrame:
    """Keys and those wanted columns that exist, under their new names.  A
    wanted name may come as several spellings mapping to the same new name;
    the first one present wins."""
    taken: dict[str, str] = {}
    for old, new in wanted.items():
        if old in df.columns and new not in taken.values():
            taken[old] = new
    return df.select(*keys, *[F.col(old).alias(new) for old, new in taken.items()])


def drop_listed(df: DataFrame, columns: Iterable[str] = (*ID_COLUMNS, *WEAK_COLUMNS)) -> DataFrame:
    return df.drop(*columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def _per_column(df: DataFrame, columns: list[str], **measures) -> DataFrame:
    """One pass over the table, then one row per column: each measure is a
    function from a column to an aggregate."""
    one_row = df.agg(*[measure(F.col(f"`{c}`")).alias(f"{c}|{m}") for c in columns for m, measure in measures.items()])
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{m}`").alias(m) for m in measures]) for c in columns
    ]
    return one_row.select(F.inline(F.array(*rows)))


def chosen(table: DataFrame, flag: str) -> list[str]:
    """Names of the candidate columns with a true flag (bounded by the schema)."""
    return [r["column"] for r in table.filter(flag).select("column").collect()]


def binary_columns(df: DataFrame, prefix: str = "deezer_genre_") -> DataFrame:
    """Which prefixed numeric or boolean columns hold only 0/1 and at least one
    value; all of them in one aggregation."""
    wanted = [
        f.name
        for f in df.schema.fields
        if f.name.startswith(prefix) and isinstance(f.dataType, (NumericType, BooleanType))
    ]
    table = _per_column(
        df,
        wanted,
        filled=lambda c: F.count(c),
        only_flags=lambda c: F.coalesce(F.bool_and(c.cast("double").isin(0.0, 1.0)), F.lit(False)),
    )
    return table.select("column", "filled", F.col("only_flags").alias("is_binary"))


#: Relative deviation of the sketch that counts distinct values, and how many of them
#: a column must be away from the line to be decided by it.
SKETCH_ERROR = 0.02
CLEAR = 8


def _distinct_share(distinct: DataFrame, ratio: float) -> DataFrame:
    share = F.col("n") / F.col("rows")
    return distinct.select(
        "column", F.col("n").alias("distinct_values"), share.alias("distinct_ratio"), (share < ratio).alias("is_near_constant")
    )


def near_constant_columns(df: DataFrame, columns: list[str], ratio: float = NEAR_CONSTANT_RATIO, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per row of each column; below ``ratio`` the
    column counts as near constant.  Exact by default: (column, value) pairs
    are made distinct first, which Spark does map-side, so no task sees a
    column's raw values twice.  ``approximate`` uses sketches of fixed size."""
    if approximate:
        distinct = _per_column(df, columns, n=lambda c: F.approx_count_distinct(c, SKETCH_ERROR), rows=lambda c: F.count(F.lit(1)))
    else:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
        distinct = (
            df.select(F.inline(pairs))
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .groupBy("column")
            .agg(F.count("value").alias("n"), F.sum("n_rows").alias("rows"))
        )
    return _distinct_share(distinct, ratio)


def doubtful_columns(sketched: DataFrame, ratio: float = NEAR_CONSTANT_RATIO) -> list[str]:
    """Columns whose sketch is too near the line to decide."""
    margin = CLEAR * SKETCH_ERROR
    near = F.col("distinct_ratio").between(ratio * (1 - margin), ratio * (1 + margin))
    return chosen(sketched.withColumn("near", F.coalesce(near, F.lit(False))), "near")


def near_constant_names(df: DataFrame, columns: list[str], ratio: float = NEAR_CONSTANT_RATIO) -> list[str]:
    """The near-constant columns.  Sketches decide those that are clear of the line (by
    eight deviations), without moving a value; only the others are counted exactly."""
    sketched = stored(near_constant_columns(df, columns, ratio, approximate=True), "sketches")
    doubtful = doubtful_columns(sketched, ratio)
    clear = [c for c in chosen(sketched, "is_near_constant") if c not in doubtful]
    exact = chosen(near_constant_columns(df, doubtful, ratio), "is_near_constant") if doubtful else []
    return [c for c in columns if c in clear or c in exact]


def drop_near_constant(df: DataFrame, prefix: str = "acoustic_", suffix: str = "_prob", **kw) -> DataFrame:
    candidates = [c for c in df.columns if c.startswith(prefix) and c.endswith(suffix)]
    if not candidates:
        return df
    return df.drop(*near_constant_names(df, candidates, **kw))


def empty_columns(df: DataFrame) -> DataFrame:
    """Columns that are all zero (a null is not a zero) or all null."""
    numeric = set(numeric_columns(df))

    def column_used(c: str):
        col = F.col(f"`{c}`")
        return F.bool_or(col.isNull() | (col != 0)) if c in numeric else F.lit(True)

    one_row = df.agg(
        *[F.coalesce(column_used(c), F.lit(False)).alias(f"{c}|nonzero") for c in df.columns],
        *[F.count(F.col(f"`{c}`")).alias(f"{c}|filled") for c in df.columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            (~F.col(f"`{c}|nonzero`")).alias("all_zero"),
            (F.col(f"`{c}|filled`") == 0).alias("all_null"),
        )
        for c in df.columns
    ]
    return one_row.select(F.inline(F.array(*rows)))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    return df.drop(*chosen(empty_columns(df), "all_zero OR all_null"))


def feature_columns(df: DataFrame, target: str, drop: Iterable[str] = NON_FEATURES) -> list[str]:
    dropped = {target, *drop}
    return [c for c in numeric_columns(df) if c not in dropped]


def ml_features(df: DataFrame, target: str, keys: Iterable[str] = (), drop: Iterable[str] = NON_FEATURES) -> DataFrame:
    """Keys, numeric features with null as 0, and the target.  Booleans are
    cast to integers first, so that they stay features."""
    flags = {f.name: F.col(f.name).cast("int") for f in df.schema.fields if isinstance(f.dataType, BooleanType)}
    wide = df.withColumns(flags) if flags else df
    features = [c for c in feature_columns(wide, target, drop) if c not in set(keys)]
    if not features:
        raise ValueError("no numeric feature columns")
    return wide.select(*keys, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in features], target)
