"""Multi-label strings, label-derived column names and model names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weekloom.functions.text import strip_space


def split_labels(c: Column, sep: str = ",") -> Column:
    """Delimited string to an array of trimmed lower-case labels without blanks."""
    parts = F.split(F.coalesce(c.cast("string"), F.lit("")), r"\Q" + sep + r"\E")
    labels = F.transform(parts, lambda x: F.lower(strip_space(x)))
    return F.filter(labels, lambda x: x != "")


# Characters replaced when a label becomes part of a column name.
LABEL_REPLACEMENTS = ((" ", "_"), ("/", "_"), ("&", "and"))
TAG_REPLACEMENTS = ((" ", "_"), ("-", "_"), ("/", "_"), ("&", "and"), ("(", ""), (")", ""))


def safe_label(c: Column, tag: bool = False) -> Column:
    """Label as a column-name part."""
    for old, new in TAG_REPLACEMENTS if tag else LABEL_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def safe_label_name(label: str, tag: bool = False) -> str:
    """The same rule for a label already on the driver (column naming)."""
    for old, new in TAG_REPLACEMENTS if tag else LABEL_REPLACEMENTS:
        label = label.replace(old, new)
    return label


def label_from_column(c: Column, prefix: str = "deezer_genre_") -> Column:
    """Column name back to a label: prefix off, the mis-decoded ``ñ`` repaired."""
    return F.replace(F.replace(c, F.lit(prefix), F.lit("")), F.lit("Ã±"), F.lit("n"))


def display_label(c: Column, prefix: str = "deezer_genre_") -> Column:
    """Title-cased label for reports."""
    return F.initcap(F.replace(label_from_column(c, prefix), F.lit("_"), F.lit(" ")))


# File-name parts that name the model family, first match wins.
MODEL_NAME_PARTS = (
    ("naive", "Naive"),
    ("prophet", "Prophet"),
    ("sarima", "SARIMA"),
    ("genre_rf_", "RandomForest"),
    ("genre_lgbm_", "LightGBM"),
)
MOVING_AVERAGE_PART = {"metrics": "ma", "predictions": "ma4"}


def model_from_filename(c: Column, kind: str = "metrics") -> Column:
    """Model family from a result file's name."""
    name = F.lower(c)
    rules = (*MODEL_NAME_PARTS, (MOVING_AVERAGE_PART[kind], "MovingAverage"))
    (part, family), *rest = rules
    chain = F.when(name.contains(part), family)
    for part, family in rest:
        chain = chain.when(name.contains(part), family)
    return chain.otherwise("Unknown")
