"""Quality scores from overlapping heuristic labellers.

Some labellers vote good, bad or nothing on every document.  The whole corpus is
added up by vote pattern (at most ``3 ** labellers`` of them), and expectation
maximisation on these counts estimates how often each labeller votes what on
good and on bad documents, without any given label.  The posterior of its
pattern is a document's soft label; a hashed linear scorer over words and word
shapes is trained on soft labels by gradient steps in parallel tasks whose
weights are averaged, and scores every document.

The scorer is fitted on about ``Training.sample`` rows, chosen by a hash of id
and text; votes and estimates cover all rows.

Results by case: a text without words (null, empty) has score 0 and is rejected;
repeated rows get equal scores; a null id is passed on; an empty table gives no
rows; a score equal to the cut is kept; only the id and text columns are read
(``good_rows`` carries the others along under any name); long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm import ragged
from weekloom.llm.quality_rules import slice_counts
from weekloom.llm.scratch import fresh, written

BITS = 16
SIZE = 1 << BITS


@dataclass(frozen=True)
class Training:
    sample: int = 12_000
    rounds: int = 6
    step: float = 0.5
    slice_bytes: int = 1 << 18
    tasks: int = 12
    keep_from: float = 0.3


#: labeller -> (value, bad below, good from, good to, bad above)
LABELLERS = {
    "symbols": ("symbols", -1.0, -1.0, 0.05, 0.3),
    "repeated windows": ("repeated", -1.0, -1.0, 0.1, 0.3),
    "distinct words": ("distinct", 0.15, 0.35, 2.0, 2.0),
    "upper case": ("upper", -1.0, -1.0, 0.2, 0.4),
    "shouts": ("shouts", -1.0, -1.0, 0.05, 0.3),
    "word length": ("length", 2.5, 3.5, 8.0, 10.0),
    "text length": ("words", 3.0, 30.0, 1e12, 1e12),
    "sentence ends": ("ends", 0.005, 0.02, 2.0, 2.0),
    "short words": ("short", 0.05, 0.15, 0.75, 2.0),
    "plain words": ("plain", 0.75, 0.95, 2.0, 2.0),
}

_END = np.zeros(256, bool)
_END[list(b".!?;:")] = True

#: bytes that a plain word may hold inside, and at its end
_INNER = np.zeros(256, bool)
_INNER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b"-'/_@+"]] = True
_LAST = _INNER.copy()
_LAST[list(b".,;:!?)\"]")] = True

_CLASS = np.full(256, 1, np.uint64)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",", b"!?", b"#*$%&|<>"), start=2):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 9


def slice_values(texts: ragged.Texts, found: ragged.Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    made = slice_counts(texts)
    n = np.maximum(made["n_words"], 1)
    sums = np.concatenate([[0], np.cumsum(_END[texts.data], dtype=np.int64)])
    short = np.concatenate([[0], np.cumsum(found.end - found.start <= 3)])
    odd = np.concatenate([[0], np.cumsum(~_INNER[found.data])])
    plain = (odd[found.end - 1] == odd[found.start]) & _LAST[found.data[found.end - 1]] if len(hashes) else np.empty(0, bool)
    plain = np.concatenate([[0], np.cumsum(plain)])
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(found.at[:-1], found.at[1:], strict=True)], np.int64)
    return {
        "words": made["n_words"].astype(float),
        "symbols": made["n_symbols"] / n,
        "repeated": made["n_repeat_words"] / n,
        "distinct": np.minimum(1.0, distinct * np.maximum(1.0, np.log10(n) - 1) / n),
        "upper": made["n_upper"] / np.maximum(made["n_letters"], 1),
        "shouts": made["n_shouts"] / n,
        "length": made["word_chars"] / n,
        "ends": (sums[texts.at[1:]] - sums[texts.at[:-1]]) / n,
        "short": (short[found.at[1:]] - short[found.at[:-1]]) / n,
        "plain": (plain[found.at[1:]] - plain[found.at[:-1]]) / n,
    }


def votes_of(values: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, labellers) of -1 bad, 0 nothing, 1 good."""
    columns = []
    for name, low, good_from, good_to, high in LABELLERS.values():
        v = values[name]
        columns.append(np.where((v < low) | (v > high), -1, np.where((v >= good_from) & (v <= good_to), 1, 0)))
    return np.stack(columns, axis=1)


def pattern_code(votes: np.ndarray) -> np.ndarray:
    return ((votes + 1) * 3 ** np.arange(votes.shape[1])).sum(axis=1)


def pattern_votes(code: np.ndarray) -> np.ndarray:
    return code[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1


def estimate(votes: np.ndarray, count: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good for each vote pattern, and P(vote | class) of each labeller
    as an array (class bad/good, labeller, vote + 1), by expectation maximisation.
    Starts from the number of bad votes, since good votes come cheap."""
    good = np.array([0.95, 0.5, 0.05])[np.minimum((votes < 0).sum(axis=1), 2)]
    table = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        for k, weight in enumerate(((1 - good) * count, good * count)):
            for v in range(3):
                table[k, :, v] = ((votes == v - 1) * weight[:, None]).sum(axis=0) + 1.0
            table[k] /= table[k].sum(axis=1, keepdims=True)
        prior = np.clip((good * count).sum() / count.sum(), 1e-3, 1 - 1e-3)
        picks = np.log(table[:, np.arange(votes.shape[1]), votes + 1]).sum(axis=2)
        now = 1 / (1 + np.exp(np.clip(picks[0] - picks[1] + np.log(1 - prior) - np.log(prior), -500, 500)))
        if np.abs(now - good).max() < 1e-9:
            break
        good = now
    return good, table


class Features:
    """Hashed features of a slice: three of each word, averaged over the text,
    and one for the level of each value of the text."""

    def __init__(self, texts: ragged.Texts):
        found = ragged.words(texts, ragged.NOT_SPACE, lower=False)
        hashes = found.hashes()
        self.at, self.n = found.at, np.diff(found.at)
        shape = np.empty(0, np.uint64)
        if len(hashes):
            size = np.minimum(found.end - found.start, 12).astype(np.uint64)
            shape = _CLASS[found.data[found.start]] * np.uint64(4096) + _CLASS[found.data[found.end - 1]] * np.uint64(256) + size
        follows = np.roll(shape, -1) * np.uint64(65536) + shape
        mask = np.uint64(SIZE - 1)
        self.by_word = [(hashes & mask).astype(np.int64)] + [
            (ragged.mix64(x + np.uint64(salt << 40)) & mask).astype(np.int64) for x, salt in ((shape, 1), (follows, 2))
        ]
        self.values = slice_values(texts, found, hashes)
        levels = []
        for k, name in enumerate(sorted(self.values)):
            v = self.values[name]
            level = np.floor(np.log2(v + 1) * 2) if name == "words" else np.floor(np.minimum(v, 12.0) * (2 if name == "length" else 20))
            levels.append((ragged.mix64(level.astype(np.uint64) + np.uint64((k + 10) << 40)) & mask).astype(np.int64))
        self.by_text = np.stack(levels, axis=1)

    def score(self, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.n) and self.at[-1] + 1)
        for index in self.by_word:
            total[1:] += weights[index]
        sums = np.cumsum(total)
        z = (sums[self.at[1:]] - sums[self.at[:-1]]) / np.maximum(self.n, 1) + weights[self.by_text].sum(axis=1) + weights[SIZE]
        return np.where(self.n > 0, 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0)

    def gradient(self, weights: np.ndarray, target: np.ndarray) -> np.ndarray:
        miss = (self.score(weights) - target) * (self.n > 0) / max(1, len(self.n))
        out = np.zeros(SIZE + 1)
        each = np.repeat(miss / np.maximum(self.n, 1), self.n)
        for index in self.by_word:
            out[:SIZE] += np.bincount(index, each, SIZE)
        for index in self.by_text.T:
            out[:SIZE] += np.bincount(index, miss, SIZE)
        out[SIZE] = miss.sum()
        return out


@dataclass
class Model:
    """Weights of the scorer, posterior by vote pattern, and labeller estimates."""

    weights: np.ndarray
    posterior: dict[int, float]
    labellers: np.ndarray


def _arrow(kind: str, run: Callable[[ragged.Texts], np.ndarray]):
    def column(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        parts = [run(texts) for _, texts in ragged.slices(batch, "text")]
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.int32() if kind == "int" else pa.float64())

    column.__annotations__ = {"text": pa.Array, "return": pa.Array}
    return F.arrow_udf(column, kind)


def votes(text: Column) -> Column:
    """The code of the vote pattern of a text."""

    def run(texts: ragged.Texts) -> np.ndarray:
        found = ragged.words(texts, ragged.NOT_SPACE, lower=False)
        return pattern_code(votes_of(slice_values(texts, found, found.hashes())))

    return _arrow("int", run)(F.coalesce(text.cast("string"), F.lit("")))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Training | None = None) -> Model:
    how, spark = how or Training(), docs.sparkSession
    text = F.col(f"`{text_col}`").cast("string")
    chance = F.pmod(F.xxhash64(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-")), text), F.lit(1 << 30))
    rows = docs.select(F.coalesce(text, F.lit("")).alias("text"), chance.alias("chance")).withColumn("code", votes(F.col("text")))
    counts = rows.groupBy("code").agg(F.count("*").alias("n")).collect()  # at most 3 ** labellers rows
    if not counts:
        return Model(np.zeros(SIZE + 1), {}, np.full((2, len(LABELLERS), 3), 1 / 3))
    code, count = np.array([r.code for r in counts]), np.array([r.n for r in counts], float)
    good, table = estimate(pattern_votes(code), count)
    posterior = dict(zip(code.tolist(), good.tolist(), strict=True))

    share = min(1.0, how.sample / count.sum())
    sample = rows.where(F.col("chance") < int(share * (1 << 30))).select("text", "code", "chance")
    sample = written(sample.repartition(how.tasks, "chance"), "sample")
    weights = np.zeros(SIZE + 1)
    for _ in range(how.rounds):
        shared = spark.sparkContext.broadcast((weights.astype(np.float32), posterior))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            w, label = shared.value[0].astype(float), shared.value[1]
            seen, power = 0, np.full(SIZE + 1, 1e-8)
            for batch in batches:
                for part, texts in ragged.slices(batch, "text", how.slice_bytes):
                    target = np.array([label[c] for c in part.column(1).to_pylist()])
                    g = Features(texts).gradient(w, target)
                    power += g * g
                    w -= how.step * g / np.sqrt(power)
                    seen += part.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([w.astype(np.float32).tobytes()])], ["rows", "weights"])

        made = sample.coalesce(how.tasks).select("text", "code").mapInArrow(run, "rows bigint, weights binary").collect()
        total = sum(r.rows for r in made)
        if total:
            weights = sum(np.frombuffer(r.weights, np.float32).astype(float) * (r.rows / total) for r in made)
    return Model(weights, posterior, table)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Probability that a text is good, as a column expression."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights.astype(np.float32))
    return _arrow("double", lambda texts: Features(texts).score(shared.value))(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Training | None = None) -> DataFrame:
    """(id, score, kept) of every row."""
    how = how or Training()
    model = train(docs, id_col, text_col, how)
    out = docs.select(F.col(f"`{id_col}`").alias("id"), score(docs, model, text_col).alias("score"))
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= how.keep_from).alias("kept"))


def good_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Training | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    how, name = how or Training(), fresh(docs, "score")
    model = train(docs, id_col, text_col, how)
    return docs.withColumn(name, score(docs, model, text_col)).where(F.col(name) >= how.keep_from).drop(name)
