"""Scores of texts under a hashed maximum-entropy language model.

A word's probability is that of its class given the words before it, times that
of the word in its class given the word before it.  The class factor is a softmax
whose weights are hashed features of the history (the last word, the last two words,
and the word before the last, skipping one).  The word factor is a softmax over the
words of the class with two kinds of weights: the word's own bias, whose optimum is
its smoothed frequency in the class, and one for the word after each of the most
frequent words, each form of other words, and the begin of a text.  The optimum of
these, drawn towards the bias by ``prior`` tokens, is a ratio of counts over all
training texts, so it is exact and grows with the vocabulary.  The most frequent words
are classes of their own, the others are classed by form.

Texts are coded once in chunks with their own small vocabularies.  A vocabulary
travels as one row for each part of the word hashes; a part adds up the counts of its
words, and of each word after what stood before it, and sends them back to the chunks,
never to the driver.  Every
training task runs gradient steps over its chunks, and the weights of all tasks
are averaged by how often each feature was met.  Chunks are scored in numpy
batches.

Results by case: a null or empty text is one end token; a null id counts as the
empty text for the held-out rule; without training texts every class is equally
likely; repeated rows are scored (and counted) each; an empty table has no rows; only the
id and text columns are read, so others may have any name; a long text is a chunk of
its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby
from operator import itemgetter
from tempfile import TemporaryFile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import ragged
from weekloom.llm.scratch import partitions, small_batches, written

#: Four Arrow batches of text.
CHUNK_BYTES = 9 << 19
BITS = 15
SIZE = 1 << BITS
HEADS, FORMS = 10, 6
CLASSES = HEADS + FORMS
#: What a word can follow: one of NEAR words, a word of one of the forms, or nothing.
NEAR = 249
BEGIN = NEAR + FORMS
BEFORE = BEGIN + 1
#: Weights travel in blocks of this many features.
BLOCK = 1024
BATCH = 1 << 15
SMOOTH = 0.1

#: token that ends every text
END = np.uint64(0x6A09E667F3BCC908)


@dataclass(frozen=True)
class Training:
    rounds: int = 2
    step: float = 0.25
    prior: float = 10_000.0


def _form(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """0 to FORMS - 1 by characters and length of a word."""
    wide = np.concatenate([[0], np.cumsum(data >= 128)])
    any_wide = wide[end] > wide[start]
    last = data[end - 1]
    letter = ((last >= 97) & (last <= 122)) | (last >= 128)
    size = end - start
    form = np.where(size <= 4, 0, np.where(size <= 8, 1, 2))
    form = np.where(any_wide, 3, form)
    form = np.where(letter, form, np.where(any_wide | (size > 8), 4, 5))
    return form.astype(np.int32)


def _list(values, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


#: Number types of the packed columns of a chunk.
PACKED = {"tokens": np.int32, "vocab": np.int64, "form": np.int8, "counted": np.int32}


def _columns(batch: pa.RecordBatch, row: int, *names: str) -> list[np.ndarray]:
    cells = [batch.column(batch.schema.get_field_index(n))[row] for n in names]
    return [
        ragged.unpacked(x.as_py(), PACKED[n]) if pa.types.is_binary(x.type) else x.values.to_numpy(zero_copy_only=False)
        for n, x in zip(names, cells, strict=True)
    ]


def _encode(docs: DataFrame) -> DataFrame:
    """One row a chunk: ids, held-out flags, token numbers, and its vocabulary,
    most frequent word first, with forms and counts in training texts.  Numbers of
    tokens and of words are packed."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for made, (part, texts) in enumerate(ragged.gathered(batches, "text", CHUNK_BYTES)):
            found = ragged.words(texts, ragged.NOT_SPACE, lower=True)
            n, size = len(texts), np.diff(found.at)
            hashes = np.insert(found.hashes(), found.at[1:], END)
            at = found.at + np.arange(n + 1)
            held = np.array(part.column(1).to_pylist(), bool)
            vocab, first, inverse, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")
            number = np.empty(len(order), np.int32)
            number[order] = np.arange(len(order))
            tokens = number[inverse]
            in_training = np.repeat(~held, size + 1)
            counted = np.bincount(tokens[in_training], minlength=len(vocab))
            # word of each first place; the end token has form 0
            place = first[order] - np.searchsorted(at[1:], first[order], "right")
            is_end = vocab[order] == END
            form = np.zeros(len(order), np.int32)
            form[~is_end] = _form(found.data, found.start[place[~is_end]], found.end[place[~is_end]])
            packed = {"tokens": tokens, "vocab": vocab[order].view(np.int64), "form": form, "counted": counted}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 20) + made], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(0)),
                    _list(held, pa.bool_()),
                    _list(at, pa.int32()),
                    *[pa.array([ragged.packed(x.astype(PACKED[name]))], pa.binary()) for name, x in packed.items()],
                ],
                ["chunk", "ids", "held", "doc_at", *packed],
            )

    schema = (
        f"chunk bigint, ids array<{kind}>, held array<boolean>, doc_at array<int>, tokens binary,"
        " vocab binary, form binary, counted binary"
    )
    return docs.mapInArrow(run, schema)


def _numbered(some: np.ndarray, vocab: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Places of words among ``some`` words, or their number in ``others``."""
    if not len(some):
        return others
    order = np.argsort(some)
    at = order[np.minimum(np.searchsorted(some[order], vocab), len(order) - 1)]
    return np.where(some[at] == vocab, at, others)


@dataclass
class Classes:
    """The NEAR most frequent words, of which the first are heads, and by form the mass
    that smoothed frequencies are divided by."""

    near: np.ndarray
    mass: np.ndarray
    total: int
    distinct: int

    @property
    def heads(self) -> np.ndarray:
        return self.near[:HEADS]

    def of(self, vocab: np.ndarray, form: np.ndarray) -> np.ndarray:
        return _numbered(self.heads, vocab, form.astype(np.int64) + HEADS)

    def pairs(self, vocab: np.ndarray, form: np.ndarray, tokens: np.ndarray, start: np.ndarray) -> np.ndarray:
        """A number for each token's word and what stands before it, words in order."""
        before = np.roll(_numbered(self.near, vocab, form.astype(np.int64) + NEAR)[tokens], 1)
        before[start] = BEGIN
        return tokens.astype(np.int64) * BEFORE + before

    def inside(self, kind: np.ndarray, count: np.ndarray) -> np.ndarray:
        """P(word | class)."""
        mass = self.mass[np.maximum(kind - HEADS, 0)]
        return np.where(kind < HEADS, 1.0, (count + SMOOTH) / mass)


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _narrow(values: np.ndarray) -> bytes:
    """Numbers from 0 on, in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of every range, one range after the other."""
    return np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())


def _blocks(chunks: DataFrame, parts: int, classes: Classes | None = None) -> DataFrame:
    """(part, chunk, words, pos, counted, form): the vocabulary of every chunk in one
    row for each part of the word hashes.  With ``classes`` also (size, before, times):
    how many different things each word follows, which, and how often in training."""
    names = ["chunk", "vocab", "form", "counted"] + ["tokens", "doc_at", "held"] * (classes is not None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(batch.schema.get_field_index("chunk")).to_pylist()
            for i, chunk in enumerate(numbers):
                vocab, form, counted = _columns(batch, i, "vocab", "form", "counted")
                part = (ragged.mix64(vocab.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                at = np.flatnonzero(np.r_[True, np.diff(part[order]) > 0, True]) if len(order) else np.zeros(1, int)
                rows = [
                    pa.array(part[order[at[:-1]]]),
                    pa.array([chunk] * (len(at) - 1), pa.int64()),
                    _lists(at, vocab[order], pa.int64()),
                    _lists(at, order, pa.int32()),
                    _lists(at, counted[order], pa.int64()),
                    _lists(at, form[order], pa.int8()),
                ]
                if classes is not None:
                    tokens, doc_at, held = _columns(batch, i, "tokens", "doc_at", "held")
                    pair, which = np.unique(classes.pairs(vocab, form, tokens, doc_at[:-1]), return_inverse=True)
                    times = np.bincount(which[np.repeat(~held.astype(bool), np.diff(doc_at))], minlength=len(pair))
                    first = np.searchsorted(pair, np.arange(len(vocab) + 1) * BEFORE)
                    size = np.diff(first)[order]
                    mine = _ranges(first[order], size)
                    ends = np.r_[0, np.cumsum(size)][at]
                    for values, cut in ((size, at), ((pair % BEFORE)[mine], ends), (times[mine], ends)):
                        rows.append(pa.array([_narrow(values[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(rows, ["part", "chunk", "words", "pos", "counted", "form", "size", "before", "times"][: len(rows)])

    schema = "part int, chunk bigint, words array<bigint>, pos array<int>, counted array<bigint>, form array<tinyint>"
    return chunks.select(*names).mapInArrow(run, schema + ", size binary, before binary, times binary" * (classes is not None))


#: Words that are gathered before they are added up.
GATHERED = 1 << 20


class _Sums:
    """Counts and forms of the words of one part."""

    def __init__(self):
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *row: np.ndarray) -> None:
        self.rows.append(row)
        self.size += len(row[0])
        if self.size > GATHERED and len(self.rows) > 1:
            self.rows = [self.summed()]
            # a large vocabulary is added up again only after as many new words
            self.size = max(0, len(self.rows[0][0]) - GATHERED // 2)

    def summed(self) -> tuple[np.ndarray, ...]:
        words, counts, forms = (np.concatenate(x) for x in zip(*self.rows, strict=True))
        order = np.argsort(words, kind="stable")
        words = words[order]
        first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.zeros(0, int)
        if not len(first):
            return words, counts, forms
        return words[first], np.add.reduceat(counts[order], first), np.minimum.reduceat(forms[order], first)


def _counted(blocks: DataFrame, parts: int) -> DataFrame:
    """(part, words, counts, top, n, v): the counts of the words of training texts by
    part, its NEAR most frequent words, and tokens and words by form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, _Sums] = {}
        for batch in batches:
            for i, part in enumerate(batch.column(0).to_pylist()):
                words, counted, form = _columns(batch, i, "words", "counted", "form")
                use = counted > 0
                sums.setdefault(part, _Sums()).add(words[use], counted[use], form[use])
        while sums:
            part, held = sums.popitem()
            words, counts, forms = held.summed()
            top = np.lexsort((words, -counts))[:NEAR]
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "words": words,
                        "counts": counts,
                        "top": [{"word": int(words[k]), "c": int(counts[k]), "form": int(forms[k])} for k in top],
                        "n": [int(counts[forms == f].sum()) for f in range(FORMS)],
                        "v": [int((forms == f).sum()) for f in range(FORMS)],
                    }
                ],
                kind,
            )

    head = pa.struct([("word", pa.int64()), ("c", pa.int64()), ("form", pa.int32())])
    lists = [("words", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("top", pa.list_(head)), ("n", pa.list_(pa.int64())), ("v", pa.list_(pa.int64()))]
    kind = pa.schema([("part", pa.int32()), *lists])
    schema = "part int, words array<bigint>, counts array<bigint>, top array<struct<word:bigint,c:bigint,form:int>>, n array<bigint>, v array<bigint>"
    return blocks.select("part", "words", "counted", "form").repartition(parts, "part").mapInArrow(run, schema)


def _known(blocks: DataFrame, counted: DataFrame, parts: int) -> DataFrame:
    """(chunk, known): places in the chunk's vocabulary and their counts in all training
    texts; the counts of a part are held while the blocks of all chunks pass.  For
    blocks with pairs also ``near``: how often each of a word's pairs occurs in all
    training texts.  These blocks pass twice, the second time from a file of the task."""
    pairs = ["size", "before", "times"] if "times" in blocks.columns else []
    none = F.lit(None)
    empty = [none.cast("binary").alias(c) for c in pairs]
    counts = counted.select("part", F.lit(0).alias("role"), none.cast("bigint").alias("chunk"), "words", none.cast("array<int>").alias("pos"), "counts", *empty)
    asked = blocks.select("part", F.lit(1).alias("role"), "chunk", "words", "pos", none.cast("array<bigint>").alias("counts"), *pairs)
    dealt = counts.unionByName(asked).repartition(parts, "part").sortWithinPartitions("part", "role")

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
        """Rows of one part after the other."""
        pieces = ((p, batch.slice(a, b - a)) for batch in batches for p, a, b in _runs(batch.column(0).to_numpy()))
        for part, rows in groupby(pieces, itemgetter(0)):
            yield part, (x for _, x in rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches):
            head = next(rows)
            if head.column(1)[0].as_py() != 0:  # no word of the part is in a training text
                for _ in rows:
                    pass
                continue
            words, counts = _columns(head, 0, "words", "counts")
            asked = chain([head.slice(1)], rows)
            if not pairs:
                yield from answers(words, counts, asked, None)
                continue
            sums = _Sums()
            with TemporaryFile() as file:
                with pa.ipc.new_stream(file, head.schema) as out:
                    for batch in asked:
                        out.write_batch(batch)
                        for i in range(batch.num_rows):
                            mine, at, met = found(words, batch, i)
                            keys, times, _ = keyed(batch, i, len(mine), at, met)
                            sums.add(keys[times > 0], times[times > 0], np.zeros((times > 0).sum(), np.int8))
                file.seek(0)
                with pa.ipc.open_stream(file) as again:
                    yield from answers(words, counts, again, sums.summed()[:2] if sums.rows else (np.zeros(0, np.int64),) * 2)

    def found(words: np.ndarray, batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        (mine,) = _columns(batch, i, "words")
        at = np.minimum(np.searchsorted(words, mine), max(len(words) - 1, 0))
        return mine, at, words[at] == mine if len(words) else np.zeros(len(mine), bool)

    def keyed(batch: pa.RecordBatch, i: int, n: int, at: np.ndarray, met: np.ndarray) -> tuple[np.ndarray, ...]:
        """Keys and counts of the pairs of the words that are met, and the words' sizes."""
        size, before, times = (batch.column(batch.schema.get_field_index(c))[i].as_py() for c in pairs)
        size = _wide(size, n)
        use = np.repeat(met, size)
        return np.repeat(at, size)[use] * BEFORE + _wide(before, len(use))[use], _wide(times, len(use))[use], size[met]

    def answers(words: np.ndarray, counts: np.ndarray, asked: Iterable[pa.RecordBatch], sums: tuple[np.ndarray, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
        for batch in asked:
            for i in range(batch.num_rows):
                mine, at, met = found(words, batch, i)
                (pos,) = _columns(batch, i, "pos")
                row = [batch.column(2).slice(i, 1), _list(pos[met], pa.int32()), _list(counts[at[met]], pa.int64())]
                if sums is not None:
                    keys, _, _ = keyed(batch, i, len(mine), at, met)
                    near = np.zeros(len(keys), np.int64)
                    if len(sums[0]):
                        where = np.minimum(np.searchsorted(sums[0], keys), len(sums[0]) - 1)
                        near = np.where(sums[0][where] == keys, sums[1][where], 0)
                    row.append(pa.array([_narrow(near)], pa.binary()))
                yield pa.RecordBatch.from_arrays(row, ["chunk", "pos", "counts", "near"][: len(row)])

    found_rows = dealt.mapInArrow(run, "chunk bigint, pos array<int>, counts array<bigint>" + ", near binary" * bool(pairs))
    return found_rows.groupBy("chunk").agg(F.collect_list(F.struct("pos", "counts", *["near"] * bool(pairs))).alias("known"))


def _runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, first, end) of each run of equal values."""
    at = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else np.zeros(1, int)
    return [(int(values[a]), int(a), int(b)) for a, b in zip(at[:-1], at[1:], strict=True)]


def _classes(counted: DataFrame) -> Classes:
    """From the counts by part; NEAR words and some sums reach the driver."""
    top = counted.select(F.explode("top").alias("h")).select("h.*")
    near = [(r.word, r.c, r.form) for r in top.orderBy(F.desc("c"), "word").limit(NEAR).collect()]
    by_form = counted.select(F.posexplode(F.arrays_zip("n", "v")).alias("form", "x")).groupBy("form").agg(F.sum("x.n").alias("n"), F.sum("x.v").alias("v"))
    words, mass = np.zeros(FORMS), np.zeros(FORMS)
    total = distinct = 0
    for r in by_form.collect():
        words[r.form], mass[r.form] = r.v, r.n
        total, distinct = total + r.n, distinct + r.v
    for _, c, form in near[:HEADS]:
        words[form] -= 1
        mass[form] -= c
    return Classes(np.array([w for w, _, _ in near], np.int64), mass + SMOOTH * (words + 1), total, distinct)


def _features(words: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(3, tokens) hashed features of the history of each token; ``start`` marks
    the first token of a text, histories do not reach over it."""
    begin = np.uint64(0x3C6EF372FE94F82B)
    back1 = np.roll(words, 1)
    back1[start] = begin
    back2 = np.roll(back1, 1)
    back2[start] = begin
    mask = np.uint64(SIZE - 1)
    last = ragged.mix64(back1 + np.uint64(1))
    skip = ragged.mix64(back2 * np.uint64(3) + np.uint64(2))
    both = ragged.mix64(back1 * np.uint64(5) + skip)
    return np.stack([last & mask, both & mask, skip & mask]).astype(np.uint16)


def _log_softmax(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    z = weights[features[0]]
    z += weights[features[1]]
    z += weights[features[2]]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


class Trainer:
    """Gradient steps with per-feature rates."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, step: float):
        self.weights, self.bias, self.step = weights.copy(), bias.copy(), step
        self.met = np.zeros(SIZE)
        self.power = np.full(SIZE, 1e-6, np.float32)
        self.bias_power = 1e-6

    def learn(self, features: np.ndarray, target: np.ndarray) -> None:
        miss = np.exp(_log_softmax(self.weights, self.bias, features))
        miss[np.arange(len(target)), target] -= 1
        for index in features:
            order = np.argsort(index, kind="stable")
            ranked = index[order]
            first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
            used = ranked[first]
            n = np.diff(np.r_[first, len(ranked)])
            g = np.add.reduceat(miss[order], first, axis=0) / np.sqrt(n)[:, None].astype(np.float32)
            self.power[used] += np.square(g).mean(axis=1)
            self.weights[used] -= self.step * g / np.sqrt(self.power[used])[:, None]
            self.met[used] += n
        g = miss.mean(axis=0)
        self.bias_power += float(np.square(g).mean())
        self.bias -= self.step * g / math.sqrt(self.bias_power)


def _train(chunks: DataFrame, classes: Classes, how: Training) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights and bias of the class factor, and training tokens by class and what
    stands before them."""
    spark = chunks.sparkSession
    after = np.zeros((CLASSES, BEFORE), np.int64)
    weights, bias = np.zeros((SIZE, CLASSES), np.float32), np.zeros(CLASSES, np.float32)
    n_blocks = SIZE // BLOCK
    for turn in range(how.rounds):
        shared = spark.sparkContext.broadcast((weights, bias))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model, seen, after = None, 0, np.zeros(CLASSES * BEFORE, np.int64)
            for batch in batches:
                for i in range(batch.num_rows):
                    model = model or Trainer(*shared.value, how.step)
                    tokens, vocab, form, held, at = _columns(batch, i, "tokens", "vocab", "form", "held", "doc_at")
                    kind = classes.of(vocab, form)[tokens]
                    features = _features(vocab.view(np.uint64)[tokens], at[:-1])
                    use = np.flatnonzero(np.repeat(~held.astype(bool), np.diff(at)))
                    seen += len(use)
                    before = classes.pairs(vocab, form, tokens, at[:-1])[use] % BEFORE
                    after += np.bincount(kind[use] * BEFORE + before, minlength=len(after))
                    for k in range(0, len(use), BATCH):
                        part = use[k : k + BATCH]
                        model.learn(features[:, part], kind[part])
            if seen:
                scaled = model.weights * model.met[:, None].astype(np.float32)
                rows = [scaled[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in range(n_blocks)] + [(model.bias * seen).astype(np.float32).tobytes(), after.tobytes()]
                met = [model.met[b * BLOCK : (b + 1) * BLOCK].astype(np.float32).tobytes() for b in range(n_blocks)] + [np.float32([seen]).tobytes(), b""]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(n_blocks + 2), pa.int32()), pa.array(rows, pa.binary()), pa.array(met, pa.binary())], ["block", "sums", "met"]
                )

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                for block, sums, met in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    sums = np.frombuffer(sums, np.int64) if block > n_blocks else np.frombuffer(sums, np.float32).astype(float)
                    new = [sums, np.frombuffer(met, np.float32).astype(float)]
                    old = totals.get(block)
                    totals[block] = new if old is None else [a + b for a, b in zip(old, new, strict=True)]
            for block, (sums, met) in totals.items():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([sums.tobytes()]), pa.array([met.tobytes()])], ["block", "sums", "met"])

        schema = "block int, sums binary, met binary"
        mine = chunks.where(F.pmod(F.xxhash64("chunk"), F.lit(how.rounds)) == turn).select("tokens", "vocab", "form", "held", "doc_at")
        for r in mine.mapInArrow(run, schema).repartition(n_blocks, "block").mapInArrow(add, schema).collect():
            if r.block > n_blocks:
                after += np.frombuffer(r.sums, np.int64).reshape(after.shape)
                continue
            sums, met = np.frombuffer(r.sums), np.frombuffer(r.met)
            if r.block == n_blocks:
                bias = (sums / met[0]).astype(np.float32)
            else:
                own = weights[r.block * BLOCK : (r.block + 1) * BLOCK]
                own[met > 0] = (sums.reshape(BLOCK, CLASSES)[met > 0] / met[met > 0, None]).astype(np.float32)
    return weights, bias, after


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: F.Column | None = None, how: Training | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    row, in log10.  ``held_out`` says which rows are not learned from (by default a
    tenth by a checksum of the id)."""
    how, spark = how or Training(), docs.sparkSession
    id_ = F.col(f"`{id_col}`")
    if held_out is None:
        held_out = F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 10 == 0
    small_batches(spark)
    rows = docs.select(id_.alias("id"), held_out.alias("held"), F.col(f"`{text_col}`").cast("string").alias("text"))
    chunks = written(_encode(rows), "chunks", large_rows=True)

    parts = partitions(spark)
    blocks = _blocks(chunks, parts)
    counted = written(_counted(blocks, parts), "words")
    classes = _classes(counted)
    # training needs the classes of words only, not their counts
    weights, bias, after = _train(chunks, classes, how)
    known = chunks.drop("counted").join(_known(_blocks(chunks, parts, classes), counted, parts), "chunk", "left")
    shared = spark.sparkContext.broadcast((weights, bias, after))
    base_mass = classes.total + SMOOTH * (classes.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, after = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                tokens, vocab, form, at = _columns(batch, i, "tokens", "vocab", "form", "doc_at")
                count = np.zeros(len(vocab), np.int64)
                pair, which = np.unique(classes.pairs(vocab, form, tokens, at[:-1]), return_inverse=True)
                times, first = np.zeros(len(pair), np.int64), np.searchsorted(pair, np.arange(len(vocab) + 1) * BEFORE)
                found = batch.column(batch.schema.get_field_index("known"))[i]
                for row in found if found.is_valid else ():
                    pos = row["pos"].values.to_numpy(zero_copy_only=False)
                    count[pos] = row["counts"].values.to_numpy(zero_copy_only=False)
                    mine = _ranges(first[pos], first[pos + 1] - first[pos])
                    times[mine] = _wide(row["near"].as_py(), len(mine))
                kinds = classes.of(vocab, form)
                word = pair // BEFORE
                all_after = after[kinds[word], pair % BEFORE]
                inside = np.log10((times + how.prior * classes.inside(kinds, count)[word]) / (all_after + how.prior))[which]
                kind = kinds[tokens]
                features = _features(vocab.view(np.uint64)[tokens], at[:-1])
                ln = np.empty(len(tokens))
                for k in range(0, len(tokens), BATCH):
                    z = _log_softmax(weights, bias, features[:, k : k + BATCH])
                    ln[k : k + BATCH] = z[np.arange(len(z)), kind[k : k + BATCH]]
                base = np.log10((count + SMOOTH) / base_mass)[tokens]
                sums = [np.add.reduceat(x, at[:-1]) for x in (base, ln / math.log(10) + inside, (count > 0)[tokens].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(batch.schema.get_field_index("ids"))[i].values,
                        batch.column(batch.schema.get_field_index("held"))[i].values,
                        pa.array(np.diff(at), pa.int64()),
                        pa.array(sums[2], pa.int64()),
                        pa.array(np.full(len(at) - 1, classes.total), pa.int64()),
                        pa.array(sums[0]),
                        pa.array(sums[1]),
                    ],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return known.mapInArrow(run, schema).withColumnRenamed("id", id_col)
