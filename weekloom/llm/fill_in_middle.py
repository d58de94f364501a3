"""Fill-in-middle transformation of documents by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` keeps every repetition of the group:
``match.ends(1)`` is the list of unit ends, so its length is the number of units
and its entries are the offsets of both cuts.  A text of more than
``REGION`` units is matched one region after the other, since a match holds some
hundred bytes a unit; the regions together are the same match, and the offsets
are read from the two regions that hold the cuts.

The draws come from the SHA-256 of ``seed:id``, so reruns agree.

Results by case: a null or empty text is plain; a text that contains a marker is
plain; a null id is drawn as the empty string; repeated rows give equal rows, and
rows of one id the same draws; columns of the input other than id and text are
not read, whatever their names; an empty table gives an empty table; a very long
text is held once with its output, and the match of one region.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units of one match; bounds its captures to some 20 MB.
REGION = 1 << 17

#: Text bytes of one result batch; a longer text is a batch of its own.
BATCH_BYTES = 1 << 23

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Middle:
    """How documents are cut.  ``unit`` is the pattern of one unit (a code point
    here; a word with its spaces would do too) and must cover any text; of 100
    documents ``transformed`` are cut, and of 100 cut ones ``suffix_first`` put
    the suffix first."""

    unit: str = r"(?s:.)"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    transformed: int = 90
    suffix_first: int = 20
    seed: str = "1"


class Cutter:
    """Unit count and cut offsets of texts."""

    def __init__(self, unit: str, region: int = REGION):
        self.region = region
        self.whole = regex.compile(f"({unit})*+")
        self.some = regex.compile(f"({unit}){{1,{region}}}+")

    def cut(self, text: str, first: int, second: int) -> tuple[int, int, int]:
        """(n units, offset of the earlier cut, of the later) by two draws."""
        if len(text) <= self.region:
            found = self.whole.fullmatch(text)
            if found is None:
                raise ValueError("the unit pattern does not cover the text")
            ends = [0, *found.ends(1)]
            n = len(ends) - 1
            a, b = sorted((first % (n + 1), second % (n + 1)))
            return n, ends[a], ends[b]
        starts, n, at = [], 0, 0  # (units before, offset) of every region
        while at < len(text):
            found = self.some.match(text, at)
            if found is None:
                raise ValueError("the unit pattern does not cover the text")
            starts.append((n, at))
            n, at = n + len(found.captures(1)), found.end()
        a, b = sorted((first % (n + 1), second % (n + 1)))
        return n, self._offset(text, starts, a), self._offset(text, starts, b)

    def _offset(self, text: str, starts: list[tuple[int, int]], unit: int) -> int:
        before, at = max(s for s in starts if s[0] <= unit)
        return at if unit == before else self.some.match(text, at).ends(1)[unit - before - 1]


def _draws(id_: Column, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers of an id."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(key, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def _batches(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``BATCH_BYTES`` text bytes."""
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if held and held + (n or 0) > BATCH_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Middle | None = None) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row: n counts
    units, the lengths are code points (null if plain), output is the training text."""
    rule = rule or Middle()
    id_ = F.col(f"`{id_col}`")
    rows = docs.select(id_.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *_draws(id_, rule.seed))
    p, s, m = rule.prefix, rule.suffix, rule.middle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(rule.unit)
        for whole in batches:
            for batch in _batches(whole, 1):
                out: list[list] = [[], [], [], [], []]
                for text, h1, h2, h3, h4 in zip(*(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
                    text = text or ""
                    n, a, b = cutter.cut(text, h1, h2)
                    if not text or p in text or s in text or m in text or h3 % 100 >= rule.transformed:
                        row = (n, PLAIN, None, None, text)
                    else:
                        spm = h4 % 100 < rule.suffix_first
                        parts = (s, text[b:], p, text[:a], m, text[a:b]) if spm else (p, text[:a], s, text[b:], m, text[a:b])
                        row = (n, SPM if spm else PSM, a, b - a, "".join(parts))
                    for values, value in zip(out, row, strict=True):
                        values.append(value)
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array(v, t) for v, t in zip(out, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema[id_col].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return made.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column, rule: Middle | None = None) -> Column:
    """The exact text, from output and form alone: a cut text holds no marker, so
    the first of each marker is the one that was put in."""
    rule = rule or Middle()
    p, s, m = (F.lit(x) for x in (rule.prefix, rule.suffix, rule.middle))

    def parts(first: Column, second: Column) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.char_length(first) + 1)
        one, two = F.instr(rest, second), F.instr(rest, m)
        left = F.substr(rest, F.lit(1), one - 1)
        right = F.substr(rest, one + F.char_length(second), two - one - F.char_length(second))
        return left, right, F.substr(rest, two + F.char_length(m))

    prefix, suffix, middle = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(F.concat(prefix, middle, suffix))
