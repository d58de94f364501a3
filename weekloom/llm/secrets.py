"""Secrets in documents, weighed by who else holds them.

Three patterns find assigned values, access keys and long hexadecimal runs.
Further candidates are words of mixed characters that look random.  For every
candidate value the whole corpus is asked how many documents (repositories) and
how many owners hold it: a value of many owners or of many documents is a copied
example, one that stays with few of both and looks random is live-looking.  Live-looking further
candidates are added to the spans as kind ``owned``; spans of the patterns stay.

Results by case: a null or empty text has no spans; a null owner is an owner of
its own; values that repeat inside a document count it once; rows of the same id
(null is one id) count as one document, and each has its spans; offsets are in code
points, ends exclusive; an empty table gives no rows; only the id, text and owner columns
are read, so others may have any name; long texts are read whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import ragged
from weekloom.llm.scratch import written

KINDS = ("assign", "access", "hex", "owned")

_ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


@dataclass(frozen=True)
class Ownership:
    """A value is live-looking with at most ``owners`` owners and ``docs`` documents
    (distinct ids, of one owner or several), at least ``length`` characters, letters
    and ``digits`` digits, and ``entropy`` bits a character."""

    owners: int = 1
    docs: int = 10
    length: int = 16
    digits: int = 2
    entropy: float = 3.0


def _runs(mask: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of at least ``least`` equal marks that do not cross texts."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[at] = True
    here, before = np.append(mask, False), np.insert(mask, 0, False)
    start = np.flatnonzero(here & (~before | edge))
    end = np.flatnonzero(before & (~here | edge))
    long = end - start >= least
    return start[long], end[long]


def entropy(value: bytes) -> float:
    """Bits a character."""
    share = np.bincount(np.frombuffer(value, np.uint8)) / len(value)
    share = share[share > 0]
    return float(-(share * np.log2(share)).sum())


def find_spans(texts: ragged.Texts, rule: Ownership) -> list[list[tuple[int, int, int, bytes, bool]]]:
    """For each text (kind number, first byte, end byte, value, random-looking)."""
    out: list[list] = [[] for _ in range(len(texts))]
    data = texts.data
    for mark, least, kind in ((_HEX[data], 24, 2), (_CANDIDATE[data], rule.length, 3)):
        start, end = _runs(mark, texts.at, least)
        if kind == 3:
            digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
            n_digits = digits[end] - digits[start]
            mixed = (n_digits >= rule.digits) & (n_digits < end - start)
            start, end = start[mixed], end[mixed]
        doc = np.searchsorted(texts.at, start, "right") - 1
        for i, a, b in zip(doc.tolist(), start.tolist(), end.tolist(), strict=True):
            value = data[a:b].tobytes()
            random = entropy(value) >= rule.entropy
            if kind == 2 or random:
                out[i].append((kind, a - int(texts.at[i]), b - int(texts.at[i]), value, random))
    for i in range(len(texts)):
        raw = texts.bytes_of(i)
        lowered = raw.lower()
        if any(w in lowered for w in _ASSIGN_WORDS):
            for m in _ASSIGN.finditer(raw):
                if len(m[2]) >= 6:
                    out[i].append((0, m.start(), m.end(), m[2], len(m[2]) >= rule.length and entropy(m[2]) >= rule.entropy))
        if b"AKIA" in raw:
            for m in _ACCESS.finditer(raw):
                if m.end() - m.start() >= 20:
                    out[i].append((1, m.start(), m.end(), m[0], True))
    return out


_SPAN = "struct<start:int,kind:int,stop:int,value:binary,random:boolean>"


def _scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, rule: Ownership) -> DataFrame:
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{owner_col}`").cast("string").alias("owner"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    kind_type = pa.list_(
        pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("value", pa.binary()), ("random", pa.bool_())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                spans, keys = [], []
                ids, owners = part.column(0).to_pylist(), part.column(1).to_pylist()
                for i, found in enumerate(find_spans(texts, rule)):
                    mine = []
                    if found:
                        place = np.concatenate([[0], np.cumsum(ragged.code_points(texts.data[texts.at[i] : texts.at[i + 1]]))])
                        base = [(a, b) for kind, a, b, _, _ in found if kind < 3]
                        for kind, a, b, value, random in sorted(found, key=lambda s: (s[1], s[0])):
                            if kind == 3 and any(a < d and c < b for c, d in base):
                                continue  # part of a span of the patterns
                            digest = hashlib.sha256(value).digest()[:16]
                            mine.append({"start": int(place[a]), "kind": kind, "stop": int(place[b]), "value": digest, "random": random})
                    spans.append(mine)
                    key = repr((ids[i], owners[i])).encode() + texts.bytes_of(i) if mine else b""
                    keys.append(hashlib.sha256(key).digest()[:16] if mine else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(keys, pa.binary()), pa.array(spans, kind_type)], ["id", "owner", "row", "spans"]
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, owner string, row binary, spans array<{_SPAN}>")


def ownership(scanned: DataFrame) -> DataFrame:
    """(value, n_docs, n_owners) of every candidate value: distinct ids and distinct
    owners are added up before they meet by value, so a value of a third of all rows
    is no hot key."""
    held = scanned.select("id", "owner", F.explode(F.array_distinct(F.transform("spans", lambda s: s["value"]))).alias("value"))
    # a null in a struct counts, as one id or owner
    return held.groupBy("value").agg(F.count_distinct(F.struct("id")).alias("n_docs"), F.count_distinct(F.struct("owner")).alias("n_owners"))


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", rule: Ownership | None = None
) -> DataFrame:
    """(id, spans, n_live, n_copied) of every row.  ``spans`` is an array of
    (start, kind, stop) by start and kind, with base spans and owned ones;
    n_live and n_copied count its values by ownership."""
    rule = rule or Ownership()
    scanned = written(_scan(docs, id_col, text_col, owner_col, rule), "spans")
    known = written(ownership(scanned), "ownership")
    held = scanned.where(F.size("spans") > 0).select("row", F.explode("spans").alias("s")).select("row", "s.*").distinct()
    judged = held.join(known, "value").withColumn("live", F.col("random") & (F.col("n_owners") <= rule.owners) & (F.col("n_docs") <= rule.docs))
    span = F.struct("start", "kind", "stop")
    per_row = judged.groupBy("row").agg(
        F.collect_list(F.when((F.col("kind") < 3) | F.col("live"), span)).alias("all"),
        F.count_if(F.col("live")).alias("n_live"),
        F.count_if(~F.col("live") & ((F.col("n_owners") > 1) | (F.col("n_docs") > rule.docs))).alias("n_copied"),
    )
    # rows without spans have no key and stay out of the join
    found = scanned.where("row is not null").select("id", "row").join(per_row, "row")
    out = found.unionByName(scanned.where("row is null").select("id", "row"), allowMissingColumns=True)
    empty = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce(F.array_sort("all"), empty).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )


def kind_name(number: F.Column) -> F.Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), number + 1)


def spans_text(spans: F.Column) -> F.Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_name(s["kind"]), s["start"], s["stop"])), ",")
