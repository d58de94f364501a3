"""Removal of long passages that occur twice anywhere, by suffix arrays of shards.

Equal windows of ``length`` bytes must meet in one shard, and a shard must fit a
task.  So every window is owned by an anchor: of its grams (runs of ``gram`` bytes)
the leftmost with the smallest hash.  Equal windows have equal anchors, and one
occurrence of an anchor owns a run of neighbouring windows, its context.  Only
contexts whose anchor occurs elsewhere are moved, each distinct one once with the
number of its occurrences, to the shard of their anchor.

A shard sorts the suffixes of its contexts in two stages: suffixes that are
smaller than their successors are sorted directly, the others are induced from
them by scanning the buckets of first bytes in order.  Common prefixes of
neighbours in that order then tell which windows are equal, and a window whose
equals occur twice or more is a repeat.

Where all occurrences of an anchor have one context, there is nothing to sort: its
windows stand as often as it does.

An anchor with very many distinct contexts (a common short line in many
surroundings) goes on to the next level: its contexts are dealt again by longer
grams, up to the whole window, where all contexts of an anchor are equal.  So a
shard holds at most ``SHARD_BYTES`` and one anchor of at most ``HOT_BYTES``.

Results by case: a null or empty text has no bytes and loses none; a text
shorter than ``length`` stays; repeated rows are occurrences like any other, so all
of them lose what they share; overlapping occurrences in one text count; what is
kept can break a character and is binary; rows keep their ids, null ones too; other
columns of the input are not read, whatever their names; an empty table gives an
empty table; a very long text is cut in pieces of windows, none of which is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import ragged
from weekloom.llm.scratch import bucketed, partitions, written

#: Bytes of contexts in one suffix array; a shard ends with the anchor that fills it.
SHARD_BYTES = 1 << 19

#: Bytes of contexts of one anchor beyond which it goes on to the next level.
HOT_BYTES = 1 << 21

#: Windows of one text that are looked at together.
PIECE = 1 << 22

#: Parts of the window length that a gram has, by level.
GRAMS = (0.08, 0.32, 0.64, 0.84, 0.94, 0.98, 1.0)


def gram_sizes(length: int) -> list[int]:
    return sorted({max(1, round(part * length)) for part in GRAMS} | {length})


# --- suffix arrays ---------------------------------------------------------------


def _smaller_than_successor(symbols: np.ndarray) -> np.ndarray:
    """Is a suffix smaller than the next?  Symbol 0 ends a text and is smaller than
    all others; its own answer is of no use."""
    change = np.flatnonzero(symbols[:-1] != symbols[1:])
    runs = np.diff(np.concatenate([[-1], change]))
    out = np.zeros(len(symbols), bool)
    out[: change[-1] + 1 if len(change) else 0] = np.repeat(symbols[change] < symbols[change + 1], runs)
    return out


def _sorted_directly(raw: bytes, symbols: np.ndarray, at: np.ndarray, stop: np.ndarray, depth: int) -> np.ndarray:
    """``at`` (ascending) in the order of the first ``depth`` symbols of their
    suffixes, which end at ``stop``."""
    first, alive = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    padded = np.concatenate([symbols, np.zeros(7, symbols.dtype)])
    for k in range(7):
        here = padded[k:][at] * alive
        alive = here > 0
        first = (first << 9) | here
    order = np.argsort(first, kind="stable")
    ranked = first[order]
    edge = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]]))
    out = at[order]
    size = np.diff(edge)
    tied = np.flatnonzero(np.repeat(size > 1, size))
    begin, end = (out[tied] + 7).tolist(), np.minimum(stop[order[tied]], out[tied] + depth).tolist()
    rest = [raw[a:b] for a, b in zip(begin, end, strict=True)]
    moved, a = np.arange(len(tied)), 0
    for n in size[size > 1].tolist():
        if n > 2:
            moved[a : a + n] = sorted(range(a, a + n), key=rest.__getitem__)
        elif rest[a] > rest[a + 1]:
            moved[a], moved[a + 1] = a + 1, a
        a += n
    out[tied] = out[tied[moved]]
    return out


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of texts that each end with symbol 0 (others are 1 to 256), ordered
    by at least ``depth`` symbols; suffixes equal up to the end keep their order."""
    ends = np.flatnonzero(symbols == 0)
    small = _smaller_than_successor(symbols)
    small[ends] = False
    at = np.flatnonzero(small)
    raw = (np.maximum(symbols, 1) - 1).astype(np.uint8).tobytes()
    direct = _sorted_directly(raw, symbols, at, ends[np.searchsorted(ends, at)], depth)
    bounds = np.searchsorted(symbols[direct], np.arange(258))
    induced: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    for c in [0, *np.flatnonzero(np.bincount(symbols, minlength=257)[1:]) + 1]:
        if c == 0:
            bucket = ends
        else:
            parts = [np.concatenate(induced[c])] if induced[c] else []
            while parts and len(parts[-1]):
                before = parts[-1] - 1
                parts.append(before[symbols[before] == c])
            bucket = np.concatenate([*parts, direct[bounds[c] : bounds[c + 1]]])
            out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[symbols[before] > c]
        chars = symbols[before]
        order = np.argsort(chars, kind="stable")
        before, chars = before[order], chars[order]
        edge = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1], [True]])) if len(chars) else []
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            induced[chars[a]].append(before[a:b])
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_prefixes(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of what ``data[a:]`` and ``data[b:]`` share, at most ``most``."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data), "<u8", buffer=padded.tobytes(), strides=(1,))
    out, alive = np.full(len(a), most, np.int64), np.arange(len(a))
    for k in range(0, most, 8):
        differ = words[a[alive] + k] ^ words[b[alive] + k]
        dead = differ != 0
        x = differ[dead]
        same = sum(((x & np.uint64((1 << 8 * n) - 1)) == 0).astype(np.int64) for n in range(1, 8))
        out[alive[dead]] = np.minimum(k + same, most)
        alive = alive[~dead]
        if not len(alive):
            break
    return out


def repeated_windows(texts: list[bytes], weights: list[int], length: int) -> list[np.ndarray]:
    """For each text, which of its windows occur twice or more; a text stands for
    ``weight`` occurrences of itself."""
    size = np.array([len(t) for t in texts])
    start = np.concatenate([[0], np.cumsum(size + 1)])
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    symbols = data.astype(np.int16) + 1
    symbols[start[1:] - 1] = 0
    owner = np.repeat(np.arange(len(texts)), size + 1)
    window = np.arange(len(data)) + length <= start[owner + 1] - 1
    order = suffix_array(symbols, length)
    order = order[window[order]]
    twice = np.zeros(len(data), bool)
    if len(order):
        equal = common_prefixes(data, order[:-1], order[1:], length) >= length
        group = np.concatenate([[0], np.cumsum(~equal)])
        held = np.bincount(group, np.asarray(weights, np.float64)[owner[order]])
        twice[order[held[group] >= 2]] = True
    return [twice[a : a + max(n - length + 1, 0)] for a, n in zip(start[:-1].tolist(), size.tolist(), strict=True)]


def _ranges(marks: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return [{"a": a, "b": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


# --- anchors -----------------------------------------------------------------------


def contexts_of(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (text, first window, end, hash of the anchor);
    windows are offsets into ``data``, text i is ``data[at[i]:at[i + 1]]``."""
    count = np.maximum(np.diff(at) - length + 1, 0)
    if not count.any():
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    hashes = ragged.byte_gram_hashes(data, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    least = ragged.sliding_min((hashes & np.uint64(0xFFFFFFFF00000000)) | place, length - gram + 1)
    offsets = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(count)), count)
    start = at[:-1][doc] + np.arange(offsets[-1]) - offsets[doc]
    anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    end = start[np.append(first[1:], len(start)) - 1] + 1
    return doc[first], start[first], end, hashes[anchor[first]]


def _anchored(base: DataFrame, length: int, gram: int) -> DataFrame:
    """(rid, weight, anchor, ctx, size, los): the contexts of every text, equal ones
    of one text in one row with all their offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                found: dict[tuple, tuple[int, list[int]]] = {}
                view = memoryview(texts.data)
                for a in range(0, max(len(texts.data), 1), PIECE):
                    if len(texts) == 1:  # a long text, by pieces
                        data, at = texts.data[a : a + PIECE + length - 1], None
                        at = np.array([0, len(data)])
                    else:
                        data, at = texts.data, texts.at
                    for doc, lo, hi, anchor in zip(*(x.tolist() for x in contexts_of(data, at, length, gram)), strict=True):
                        digest = hashlib.blake2b(view[a + lo : a + hi + length - 1], digest_size=16).digest()
                        found.setdefault((doc, anchor, digest), (hi - lo + length - 1, []))[1].append(a + lo - int(texts.at[doc]))
                    if len(texts) > 1:
                        break
                doc = pa.array([k[0] for k in found], pa.int64())
                anchor = pa.array(np.array([k[1] for k in found], np.uint64).view(np.int64))
                columns = [
                    part.column(0).take(doc),
                    part.column(1).take(doc),
                    anchor,
                    pa.array([k[2] for k in found], pa.binary()),
                    pa.array([v[0] for v in found.values()], pa.int32()),
                    pa.array([v[1] for v in found.values()], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["rid", "weight", "anchor", "ctx", "size", "los"])

    return base.select("rid", "weight", "text").mapInArrow(run, "rid bigint, weight bigint, anchor bigint, ctx binary, size int, los array<int>")


def _fetched(wanted: DataFrame, base: DataFrame) -> DataFrame:
    """(anchor, ctx, weight, hot, text): the bytes of each wanted context, cut from
    the text that stands for it."""
    cut = F.struct("anchor", "ctx", "weight", "hot", "lo", "size")
    by_text = wanted.groupBy("rid").agg(F.collect_list(cut).alias("cuts")).join(base.select("rid", "text"), "rid").select("cuts", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                out: list[tuple] = []
                for i, cuts in enumerate(part.column(0).to_pylist()):
                    raw = texts.bytes_of(i)
                    out += [(c["anchor"], c["ctx"], c["weight"], c["hot"], raw[c["lo"] : c["lo"] + c["size"]]) for c in cuts]
                for k in range(0, len(out), 8192):
                    columns = zip(*out[k : k + 8192], strict=True)
                    types = (pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.binary())
                    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, ["anchor", "ctx", "weight", "hot", "text"])

    return by_text.mapInArrow(run, "anchor bigint, ctx binary, weight bigint, hot boolean, text binary")


def _sorted_shards(contexts: DataFrame, length: int) -> DataFrame:
    """(anchor, ctx, ranges): the windows of each context that are repeats."""
    dealt = contexts.repartition(partitions(contexts.sparkSession), "anchor").sortWithinPartitions("anchor")
    range_type = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, now = 0, None

        def shard() -> pa.RecordBatch:
            marks = repeated_windows([r[3] for r in held], [r[2] for r in held], length)
            rows = [(r[0], r[1], _ranges(m)) for r, m in zip(held, marks, strict=True) if m.any()]
            types = (pa.int64(), pa.binary(), range_type)
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["anchor", "ctx", "ranges"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "ctx", "weight", "text")), strict=True):
                if row[0] != now and size >= SHARD_BYTES:
                    yield shard()
                    held, size = [], 0
                now = row[0]
                held.append(row)
                size += len(row[3])
        if held:
            yield shard()

    return dealt.mapInArrow(run, "anchor bigint, ctx binary, ranges array<struct<a:int,b:int>>")


def _level(base: DataFrame, length: int, grams: list[int], limit: int) -> DataFrame:
    """(rid, a, b): windows a to b - 1 of a text are repeats.  ``base`` is (rid,
    weight, text), in buckets of rid."""
    occurrences = written(_anchored(base, length, grams[0]), "occurrences")
    kinds = occurrences.groupBy("anchor", "ctx").agg(
        F.sum(F.size("los") * F.col("weight")).alias("weight"),
        F.min("rid").alias("rid"),
        F.min_by(F.element_at("los", 1), "rid").alias("lo"),
        F.max("size").alias("size"),
    )
    kinds = written(kinds, "kinds")
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("weight").alias("total"), F.sum("size").alias("bytes"))
    last = len(grams) == 1
    repeated = anchors.where("total > 1").select("anchor", "kinds", (F.lit(not last) & (F.col("bytes") > limit)).alias("hot"))
    wanted = kinds.join(repeated, "anchor")
    alone = F.array(F.struct(F.lit(0).alias("a"), (F.col("size") - (length - 1)).alias("b"))).alias("ranges")
    marks = wanted.where("kinds = 1").select("anchor", "ctx", alone)
    contexts = written(_fetched(wanted.where("kinds > 1").drop("kinds"), base), "contexts")
    marks = marks.unionByName(_sorted_shards(contexts.where("not hot").drop("hot"), length))
    hot = contexts.where("hot").select("anchor", "ctx", "weight", "text")
    if not last and not hot.isEmpty():
        deeper = bucketed(hot.withColumn("rid", F.monotonically_increasing_id()), "hot", "rid")
        found = _level(deeper, length, grams[1:], limit).groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
        marks = marks.unionByName(deeper.join(found, "rid").select("anchor", "ctx", "ranges"))
    marks = written(marks, "marks")
    hits = occurrences.select("rid", "anchor", "ctx", "los").join(marks, ["anchor", "ctx"])
    spans = hits.select("rid", "ranges", F.explode("los").alias("lo")).select("rid", "lo", F.inline("ranges"))
    return spans.select("rid", (F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("b")).alias("b"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row: ``kept`` are the bytes not
    covered by a string of ``length`` bytes that also starts elsewhere, n_spans
    counts the runs of removed ones."""
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    base = base.select(F.monotonically_increasing_id().alias("rid"), F.lit(1).cast("bigint").alias("weight"), "id", F.coalesce("text", F.lit(b"")).alias("text"))
    base = bucketed(base, "texts", "rid")
    marks = _level(base, length, gram_sizes(length), hot_bytes)
    spans = marks.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))
    rows = base.join(spans, "rid", "left").select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                n_bytes = np.diff(texts.at)
                removed, runs, kept = [], [], []
                for i, spans in enumerate(part.column(2).to_pylist()):
                    raw, out, end, count = texts.bytes_of(i), [], 0, 0
                    for span in spans or ():
                        if span["a"] > end or not count:
                            out.append(raw[end : span["a"]])
                            count += 1
                        end = max(end, span["b"] + length - 1)
                    out.append(raw[end:])
                    kept.append(b"".join(out))
                    removed.append(len(raw) - len(kept[-1]))
                    runs.append(count)
                numbers = [pa.array(x, pa.int64()) for x in (n_bytes, removed, runs)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *numbers, pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return made.withColumnRenamed("id", id_col)
