"""Quality rules whose cutoffs carry a guarantee.

Every rule rejects documents whose value lies on one side of a cutoff.  Good
documents with labels are the holdout.  For each stratum, rule and cutoff of a
fixed grid an exact binomial test asks whether the share of good documents that
would be rejected can be shown to lie below the rule's part of ``risk``.  The
cutoffs of a rule are tested in a fixed order from loose to strict up to the
first failure, which needs no correction; rules and strata do, so each sequence
runs at ``error / (rules * strata)`` (Bonferroni).  With probability
``1 - error`` all chosen cutoffs together then keep the promise in every stratum
at once.  The strictest proven cutoff of each rule is used; a rule with none
does not reject.

Results by case: a null or empty text has no words and fails the base rules; a
null stratum is a stratum of its own; strata without labels get no cutoffs;
labels without document, repeated or null, count once or not at all (a document
is good if any of its labels says so); a value equal to a cutoff is kept; repeated rows
are judged each; an empty table gives no rows; only the named columns are read, so others
may have any name; long texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import ragged
from weekloom.llm.scratch import written

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[list(b"!?")] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_shouts")

#: rule name -> (value as SQL over COUNTS, cutoffs from strict to loose, side that is rejected)
_SHARES = tuple(round(0.02 * 1.12**k, 4) for k in range(36))
RULES = {
    "symbols_per_word": ("n_symbols / n_words", _SHARES, "above"),
    "repeated_words": ("n_repeat_words / n_words", _SHARES, "above"),
    "repeated_lines": ("n_dup_lines / n_lines", _SHARES, "above"),
    "upper_case": ("n_upper / n_letters", _SHARES, "above"),
    "shouts_per_word": ("n_shouts / n_words", _SHARES, "above"),
    "long_words": ("word_chars / n_words", tuple(6 + 0.25 * k for k in range(40)), "above"),
    "short_words": ("word_chars / n_words", tuple(5 - 0.1 * k for k in range(40)), "below"),
}


@dataclass(frozen=True)
class Risk:
    """``risk``: largest share of good documents of a stratum that all rules
    together may reject; ``error``: chance that the promise fails anywhere."""

    risk: float = 0.05
    error: float = 0.05


def _sums(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def _repeated(grams: np.ndarray, at: np.ndarray, found: ragged.Words, n: int) -> np.ndarray:
    """Words covered by windows that stand twice or more in their text."""
    out = np.zeros(len(at) - 1, np.int64)
    for i in range(len(out)):
        own = grams[at[i] : at[i + 1]]
        if len(own) < 2:
            continue
        order = np.argsort(own, kind="stable")
        same = own[order[1:]] == own[order[:-1]]
        if same.any():
            again = np.zeros(len(own) + n, np.int64)
            hit = np.union1d(order[1:][same], order[:-1][same])
            np.add.at(again, hit, 1)
            np.add.at(again, hit + n, -1)
            out[i] = int((np.cumsum(again) > 0).sum())
    return out


def _line_counts(texts: ragged.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and of those the ones equal to an earlier line of the text."""
    n, dup = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        lines = [x for x in texts.bytes_of(i).split(b"\n") if x and not x.isspace()]
        n[i], dup[i] = len(lines), len(lines) - len(set(lines))
    return n, dup


def slice_counts(texts: ragged.Texts, window: int = 5) -> dict[str, np.ndarray]:
    found = ragged.words(texts, ragged.NOT_SPACE, lower=False)
    raw = texts.data
    inside = ragged.NOT_SPACE[raw]
    grams, at = ragged.ngram_hashes(found.hashes(), found.at, window)
    n_lines, n_dup = _line_counts(texts)
    first = ragged.code_points(raw)
    return {
        "n_words": np.diff(found.at),
        "word_chars": _sums(inside & first, texts.at),
        "n_symbols": _sums(_SYMBOL[raw], texts.at),
        "n_dup_lines": n_dup,
        "n_repeat_words": _repeated(grams, at, found, window),
        "n_lines": n_lines,
        "n_upper": _sums(_UPPER[raw], texts.at),
        "n_letters": _sums(_LETTER[raw] & first, texts.at),
        "n_shouts": _sums(_SHOUT[raw], texts.at),
    }


def counts(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """(id, stratum, COUNTS...) of every row."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{stratum_col}`").cast("string").alias("stratum"), F.col(f"`{text_col}`").cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                made = slice_counts(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array(made[c], pa.int64()) for c in COUNTS]], ["id", "stratum", *COUNTS])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, stratum string, " + ", ".join(f"{c} bigint" for c in COUNTS))


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    c, d = 1.0, 1.0 / max(1e-300, abs(1.0 - (a + b) * x / (a + 1.0))) * (1 if 1.0 - (a + b) * x / (a + 1.0) >= 0 else -1)
    h = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1.0 + step * d or 1e-300)
            c = 1.0 + step / c or 1e-300
            h *= c * d
        if abs(c * d - 1.0) < 1e-13:
            break
    return h


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), as a regularised incomplete beta value."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    a, b, x = n - k, k + 1, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, 1.0 - x) / b


def cutoffs(values: DataFrame, labels: DataFrame, risk: Risk, id_col: str, label_col: str) -> DataFrame:
    """(stratum, rule, cutoff) of the strictest proven cutoffs.

    ``values`` is (id, stratum, COUNTS...).  Spark counts, for every stratum,
    rule and cutoff, how many good documents there are and how many would go;
    only those few counts are tested."""
    good = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.max(f"`{label_col}`").alias("good")).where("good = 1 and id is not null")
    holdout = values.join(good.select("id"), "id")
    tried = []
    for rule, (value, grid, side) in RULES.items():
        for level, cutoff in enumerate(grid):
            sign = ">" if side == "above" else "<"
            gone = F.count(F.when(F.expr(f"{_safe(value)} {sign} {cutoff}D"), 1))
            tried.append(F.struct(F.lit(rule).alias("rule"), F.lit(level).alias("level"), F.lit(float(cutoff)).alias("cutoff"), gone.alias("gone")))
    sums = holdout.groupBy("stratum").agg(F.count("*").alias("n"), F.array(*tried).alias("tried"))
    sums = written(sums, "holdout")
    tests = sums.withColumn("strata", F.lit(sums.count())).select("stratum", "n", "strata", F.explode("tried").alias("t")).select("stratum", "n", "strata", "t.*")
    per_rule, error = risk.risk / len(RULES), risk.error

    @F.pandas_udf("boolean")
    def proven(n: pd.Series, gone: pd.Series, strata: pd.Series) -> pd.Series:
        level = [error / (len(RULES) * s) for s in strata]
        return pd.Series([binomial_cdf(int(g), int(m), per_rule) <= e for m, g, e in zip(n, gone, level, strict=True)])

    # a looser cutoff rejects no more rows, so it is proven whenever a stricter one is
    chosen = tests.where(proven("n", "gone", "strata"))
    return chosen.groupBy("stratum", "rule").agg(F.min_by("cutoff", "level").alias("cutoff"))


def _safe(value: str) -> str:
    top, bottom = value.split(" / ")
    return f"coalesce(try_divide({top}, {bottom}), 0D)"


BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def risk_controlled(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
    risk: Risk | None = None,
) -> DataFrame:
    """(id, COUNTS..., base_failed, rejected_by, kept) of every row."""
    values = written(counts(docs, id_col, text_col, stratum_col), "counts")
    found = cutoffs(values, labels, risk or Risk(), id_col, label_col)
    per_stratum = found.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))
    per_stratum = written(per_stratum, "cutoffs").withColumnRenamed("stratum", "held")
    judged = values.join(per_stratum, F.col("stratum").eqNullSafe(F.col("held")), "left")
    hits = []
    for rule, (value, _, side) in RULES.items():
        sign = ">" if side == "above" else "<"
        hits.append(F.when(F.expr(f"{_safe(value)} {sign} cuts['{rule}']"), F.lit(rule)))
    judged = judged.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("rejected_by", F.array_compact(F.array(*hits)))
    kept = ~F.col("base_failed") & (F.size("rejected_by") == 0)
    return judged.select(F.col("id").alias(id_col), "stratum", *COUNTS, "base_failed", "rejected_by", kept.alias("kept"))
