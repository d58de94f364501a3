"""Texts of an Arrow batch as ragged numpy arrays: words, their hashes and n-grams.

Everything works on UTF-8 bytes.  All separators of the word rules are ASCII
bytes, which never occur inside a multi-byte character, so byte classes give
exactly the words that the code point classes name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; bounds a Python worker's memory to some 100 MB
#: (one longer text is taken alone).
SLICE_BYTES = 1 << 21

SPACES = bytes([0x20, *range(0x09, 0x0E)])

#: words ``[^\x20\x09-\x0D]+``
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACES)] = False

#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text: digits, letters, non-ASCII
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE_BYTES:
            _powers[kind] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Texts:
    """Concatenated bytes of some texts; text i is ``data[at[i]:at[i + 1]]``."""

    data: np.ndarray
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.at[i] : self.at[i + 1]].tobytes()


@dataclass
class Words:
    """Words of ``Texts``: byte spans in order, ``at[i]:at[i + 1]`` are those of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def hashes(self) -> np.ndarray:
        """A 64-bit polynomial hash of each word's bytes, finished by ``mix64``."""
        n = len(self.data)
        if not len(self.start):
            return np.empty(0, np.uint64)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.multiply(_BYTE_VALUE[self.data], _power(_PRIME, "up", n), out=sums[1:])
        np.cumsum(sums, out=sums)
        h = sums[self.end] - sums[self.start]
        h *= _power(_INVERSE, "down", n)[self.start]
        h += (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix64(h)


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """Nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"") if pa.types.is_binary(column.type) else column.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return Texts(raw[at[0] : at[-1]], at - at[0])


def slices(batch: pa.RecordBatch, text: str, limit: int | None = None) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of a batch with at most ``limit`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    limit = limit or SLICE_BYTES
    all_texts = texts_of(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(all_texts.at, all_texts.at[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        a, b = all_texts.at[first], all_texts.at[last]
        yield batch.slice(first, last - first), Texts(all_texts.data[a:b], all_texts.at[first : last + 1] - a)
        first = last


def gathered(batches: Iterable[pa.RecordBatch], text: str, limit: int | None = None) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """As ``slices``, over the batches of a task: the rows of small batches go together."""
    limit, held, size = limit or SLICE_BYTES, [], 0

    def whole() -> tuple[pa.RecordBatch, Texts]:
        rows = pa.concat_batches(held)
        return rows, texts_of(rows.column(rows.schema.get_field_index(text)))

    for batch in batches:
        for part, texts in slices(batch, text, limit):
            more = len(texts.data) + 16 * len(texts)  # many empty texts are bounded, too
            if held and size + more > limit:
                yield whole()
                held, size = [], 0
            held.append(part)
            size += more
    if held:
        yield whole()


def packed(values: np.ndarray) -> bytes:
    """Integers as bytes: their number and, compressed, the first byte of each, the second
    of each and so on.  One value for Spark, which handles long arrays number by number."""
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(raw.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(data[8:], n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def words(texts: Texts, kind: np.ndarray, lower: bool) -> Words:
    data = _LOWER[texts.data] if lower else texts.data
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[texts.at] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    here = np.zeros(len(data) + 1, bool)
    here[:-1] = inside
    start = np.flatnonzero(here & (~before | edge))
    end = np.flatnonzero(before & (~here | edge))
    return Words(data, start, end, np.searchsorted(start, texts.at))


def ngram_hashes(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``n`` consecutive words inside each text, and their offsets by text."""
    size = np.diff(at)
    count = np.maximum(size - n + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(count)])
    if len(hashes) < n:
        return np.empty(0, np.uint64), offsets
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(hashes) - n + 1, np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(0xFF51AFD7ED558CCD) + hashes[k : len(hashes) - n + 1 + k]
            rolled ^= rolled >> np.uint64(29)
        rolled = mix64(rolled)
    if len(count) == 1:
        return rolled, offsets
    keep = np.repeat(at[:-1], count) + (np.arange(offsets[-1]) - np.repeat(offsets[:-1], count))
    return rolled[keep], offsets


def byte_gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive bytes."""
    n = len(data)
    if n < size:
        return np.empty(0, np.uint64)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.multiply(_BYTE_VALUE[data], _power(_PRIME, "up", n), out=sums[1:])
    np.cumsum(sums, out=sums)
    h = sums[size:] - sums[:-size]
    h *= _power(_INVERSE, "down", n)[: len(h)]
    return mix64(h)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return values[:0]
    rows = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    rows[:n] = values
    rows = rows.reshape(-1, width)
    up = np.minimum.accumulate(rows, axis=1).ravel()
    down = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[: n - width + 1], up[width - 1 : n])


def binary16(pairs: np.ndarray) -> pa.Array:
    """Rows of two 64-bit words as 16-byte binaries."""
    flat = np.ascontiguousarray(pairs, np.uint64)
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(flat), [None, pa.py_buffer(flat)])
    return fixed.cast(pa.binary())


def code_points(data: np.ndarray) -> np.ndarray:
    """1 where a byte begins a character."""
    return (data & 0xC0) != 0x80
