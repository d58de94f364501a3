"""Token counts by byte-pair merging over ragged arrays.

The words of a slice of texts are looked up once each.  Their pre-tokens become
rows of one flat array of symbol ids; in every round the pair of lowest rank of
each row is merged wherever it stands in that row, all rows at once, until no
row has a known pair.  The symbols that survive are the tokens.

Results by case: a null or empty text has no tokens; a null id is passed on;
repeated rows count each by itself; texts of any length are read whole; an empty table
gives no rows; only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import ragged

_FAR = np.int64(1) << 40

#: words whose counts a worker remembers between slices (some 50 MB)
REMEMBERED = 500_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: visible
    Latin-1 characters stand for themselves, others follow from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    names, spare = [], 0x100
    for b in range(256):
        names.append(chr(b if b in visible else spare))
        spare += b not in visible
    return names


class WordBpe:
    """Lower-casing byte-level BPE whose words end in a marked symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path}: only plain BPE merges are supported")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        names = byte_symbols()
        self.inner = np.array([vocab[c] for c in names], np.int64)
        self.last = np.array([vocab[c + suffix] for c in names], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.width = np.int64(max(vocab.values()) + 1)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made
        self.known: dict[int, int] = {}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # the tokenizer's \s is Unicode white space; Python's also takes \x1c-\x1f
        self.pieces = regex.compile(split.replace("\\s", "\\p{White_Space}"))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def pre_tokens(self, word: str) -> tuple[list[bytes], int]:
        """Byte strings that merges stay within, and the special tokens met."""
        n_special, parts = 0, [word]
        if self.special is not None and "<" in word:
            parts = self.special.split(word)
            n_special, parts = len(parts) // 2, parts[::2]
        out = []
        for part in parts:
            if not part.isascii():
                # lower-casing goes by character, without the rule for a final sigma
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
            # a run of letters is one piece
            out += [part.encode()] if part.isalpha() and part.isascii() else [m.encode() for m in self.pieces.findall(part)]
        return out, n_special

    def ranks(self, pair: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.rank[at], _FAR)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that are left of each pre-token."""
        size = np.array([len(t) for t in tokens], np.int64)
        done = np.zeros(len(tokens), np.int64)
        data = np.frombuffer(b"".join(tokens), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(size) - 1
        symbols[ends] = self.last[data[ends]]
        row = np.repeat(np.arange(len(tokens)), size)
        while len(symbols):
            start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            rank = np.full(len(symbols), _FAR)
            rank[:-1] = np.where(row[1:] == row[:-1], self.ranks(symbols[:-1] * self.width + symbols[1:]), _FAR)
            least = np.minimum.reduceat(rank, start)
            length = np.diff(np.r_[start, len(symbols)])
            idle = least == _FAR
            done[row[start[idle]]] = length[idle]
            if idle.all():
                break
            merge = (rank == np.repeat(least, length)) & (rank < _FAR)
            # of touching places (a a a) the first, third, ... are merged
            at = np.flatnonzero(merge)
            fresh = np.r_[True, at[1:] != at[:-1] + 1]
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.repeat(~idle, length)
            keep[at + 1] = False
            symbols, row = symbols[keep], row[keep]
        return done


@lru_cache(maxsize=2)
def _bpe(path: str) -> WordBpe:
    return WordBpe(path)


def count_slice(texts: ragged.Texts, bpe: WordBpe) -> np.ndarray:
    found = ragged.words(texts, ragged.NOT_SPACE, lower=False)
    distinct, first, inverse = np.unique(found.hashes(), return_index=True, return_inverse=True)
    known = bpe.known
    counts = np.array([known.get(h, -1) for h in distinct.tolist()], np.int64)
    new = np.flatnonzero(counts < 0)
    if len(new):
        tokens: list[bytes] = []
        size: list[int] = []
        special: list[int] = []
        raw = found.data.tobytes()
        for a, b in zip(found.start[first[new]].tolist(), found.end[first[new]].tolist(), strict=True):
            mine, n_special = bpe.pre_tokens(raw[a:b].decode("utf-8", "replace"))
            tokens += mine
            size.append(len(mine))
            special.append(n_special)
        counts[new] = special
        if tokens:
            index: dict[bytes, int] = {}
            ids = np.array([index.setdefault(t, len(index)) for t in tokens])
            np.add.at(counts, np.repeat(new, size), bpe.count(list(index))[ids])
        if len(known) + len(new) > REMEMBERED:
            known.clear()
        known.update(zip(distinct[new].tolist(), counts[new].tolist(), strict=True))
    sums = np.concatenate([[0], np.cumsum(counts[inverse])])
    return sums[found.at[1:]] - sums[found.at[:-1]]


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``tokenizer`` is the
    vocabulary's path, which each executor reads for itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizer)
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                n = pa.array(count_slice(texts, bpe), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(texts.at), pa.int64()), n, pc.greater(n, limit)],
                    ["id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
