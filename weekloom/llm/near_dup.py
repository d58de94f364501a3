"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

Every document is the set of its distinct word shingles.  Two permutations make
all signature coordinates: one scatters the hashed shingles over a circular
universe, the other gives each place a value; coordinate k is the least value
``values[(place + k) mod size]``, so the coordinates of one shingle are one
contiguous window of the value table.  Bands of coordinates are bucketed and
the members of a bucket are compared with its leader on their full sets.  Members
that are still in different components afterwards are compared with each other:
pair by pair in small buckets, in units of bounded size in large ones.  Equal sets are one class from the start and are never paired.

Results by case: a row without words or text has an empty set, links with
nothing and is its own component; a row without id is linked with nothing and
has no component; rows that repeat an id each carry the component of their own
text; equal sets always link; an empty table has no rows; only the id and text columns
are read (``one_of_each`` carries the others along under any name); a long text is held
with its set of shingles by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm import ragged
from weekloom.llm.components import components
from weekloom.llm.scratch import SPACE_CHARS, fresh, partitions, written

#: Members of a bucket that one task compares with a leader.
MEMBERS_PER_TASK = 2000
#: Pairs of still unconnected members are written out for buckets up to this size.
FEW = 12
#: Members in a block of a larger bucket, and shingles of all its sets.
UNIT = 500
UNIT_SHINGLES = 1 << 20


@dataclass(frozen=True)
class Shape:
    """``shingle`` words a shingle; links at ``percent`` of the union.  With 48
    bands of 6 coordinates a pair at 80 % is missed once in two million."""

    shingle: int = 5
    percent: int = 80
    bands: int = 48
    rows: int = 6
    universe_bits: int = 20
    seed: int = 7


class Sketcher:
    def __init__(self, shape: Shape):
        self.shape = shape
        self.scatter = np.uint64((shape.seed * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        self.drop = np.uint64(64 - shape.universe_bits)

    @cached_property
    def windows(self) -> np.ndarray:
        """Row i: the values of the places i, i + 1, ..., around the circle."""
        size, k = 1 << self.shape.universe_bits, self.shape.bands * self.shape.rows
        values = np.random.default_rng(self.shape.seed).permutation(size).astype(np.uint32)
        return np.lib.stride_tricks.sliding_window_view(np.r_[values, values[: k - 1]], k)

    def sets(self, texts: ragged.Texts) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        found = ragged.words(texts, ragged.NOT_SPACE, lower=True)
        hashes, n = found.hashes(), self.shape.shingle
        grams, at = ragged.ngram_hashes(hashes, found.at, n)
        out = []
        for i in range(len(texts)):
            a, b = found.at[i], found.at[i + 1]
            if a == b:
                out.append(hashes[:0])
            elif b - a < n:  # the whole sequence is the one shingle
                whole, _ = ragged.ngram_hashes(hashes[a:b], np.array([0, b - a]), int(b - a))
                out.append(ragged.mix64(whole + np.uint64(b - a)))
            else:
                out.append(np.unique(grams[at[i] : at[i + 1]]))
        return out

    @staticmethod
    def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
        first = np.bitwise_xor.reduce(ragged.mix64(shingles + np.uint64(len(shingles))))
        return int(ragged.mix64(shingles ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)), int(first)

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        place = ragged.mix64(shingles ^ self.scatter) >> self.drop
        least = self.windows[place[:2048]].min(axis=0)
        for k in range(2048, len(place), 2048):
            np.minimum(least, self.windows[place[k : k + 2048]].min(axis=0), out=least)
        parts = least.reshape(self.shape.bands, self.shape.rows).astype(np.uint64)
        keys = np.arange(1, self.shape.bands + 1, dtype=np.uint64)
        for r in range(self.shape.rows):
            keys = ragged.mix64(keys * np.uint64(0x100000001B3) + parts[:, r])
        return keys


def _sketch(docs: DataFrame, shape: Shape) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Sketcher(shape)
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                sets = maker.sets(texts)
                size = np.array([len(s) for s in sets], np.int64)
                some = size > 0
                prints = np.array([maker.fingerprint(s) if len(s) else (0, 0) for s in sets], np.uint64)
                keys = [maker.bands(s) for s in sets if len(s)]
                flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
                offsets = np.concatenate([[0], np.cumsum(some * shape.bands)]).astype(np.int32)
                node = ragged.binary16(prints)
                empty = pa.array(~some)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(size),
                        pc.if_else(empty, pa.scalar(None, pa.binary()), node),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    ["id", "mark", "n", "node", "bands"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, mark bigint, n bigint, node binary, bands array<bigint>")


def _confirmed(pairs: DataFrame, texts: DataFrame, shape: Shape) -> DataFrame:
    """The pairs (lead, node) whose full sets are similar enough.

    ``texts`` is (node, text).  A leader's text meets its members in tasks of
    at most some thousand members; sets live one at a time.
    """
    parts = pairs.groupBy("lead").agg(F.ceil(F.count("*") / MEMBERS_PER_TASK).cast("int").alias("parts"))
    members = (
        pairs.join(parts, "lead")
        .join(texts, "node")
        .select("lead", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "node", "text")
    )
    leaders = parts.join(texts.withColumnRenamed("node", "lead"), "lead").select(
        "lead", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("lead").alias("node"), "text"
    )
    spread = members.union(leaders).repartition(partitions(pairs.sparkSession), "lead", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, now, own = Sketcher(shape), None, None
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                lead, role, node = (part.column(i).to_pylist() for i in (0, 2, 3))
                good = []
                for i, shingles in enumerate(maker.sets(texts)):
                    if np.array(maker.fingerprint(shingles), np.uint64).tobytes() != node[i]:
                        continue  # another text under the same id
                    if role[i] == 0:
                        now, own = lead[i], shingles
                    elif now == lead[i]:
                        common = len(np.intersect1d(own, shingles, assume_unique=True))
                        if 100 * common >= shape.percent * (len(own) + len(shingles) - common):
                            good.append(i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(good, pa.int64())), part.column(3).take(pa.array(good, pa.int64()))], ["lead", "node"]
                )

    return spread.sortWithinPartitions("lead", "part", "role").mapInArrow(run, "lead binary, node binary")


def _units(members: DataFrame) -> DataFrame:
    """(key, i, j, role, node, label): the members of large buckets, dealt into units.

    Only members outside the largest component of a bucket have links to find
    (role 0).  They are dealt into blocks, and so are all members (role 1); every
    block of the few meets every block of all in a unit, so a bucket ships each text
    about as often as its few fill blocks.  Blocks are bounded in members and in
    shingles.
    """
    shares = members.groupBy("key", "label").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    full = shares.groupBy("key").agg(
        F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("all_c"), F.sum("s").alias("all_s"),
        F.max(F.struct("c", "s")).alias("most"),
    )

    def blocks(count: F.Column, size: F.Column) -> F.Column:
        return F.greatest(F.lit(1), F.ceil(count / UNIT), F.ceil(size / UNIT_SHINGLES)).cast("int")

    sized = full.select(
        "key", "main", blocks(F.col("all_c"), F.col("all_s")).alias("all_blocks"),
        blocks(F.col("all_c") - F.col("most.c"), F.greatest(F.lit(0), F.col("all_s") - F.col("most.s"))).alias("few_blocks"),
    )
    dealt = members.join(sized, "key")

    def block(n: str) -> F.Column:
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def every(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    few = dealt.where("label <> main").select("key", block("few_blocks").alias("i"), every("all_blocks").alias("j"), F.lit(0).alias("role"), "node", "label")
    all_ = dealt.select("key", every("few_blocks").alias("i"), block("all_blocks").alias("j"), F.lit(1).alias("role"), "node", "label")
    return few.unionByName(all_)


def _linked_in_units(members: DataFrame, texts: DataFrame, shape: Shape) -> DataFrame:
    """Links (lead, node) between components inside large buckets.  A unit counts the
    shingles that a member shares with all others through a list of owners of each
    shingle, and returns only links that join parts which were still apart in it,
    fewer than it has members."""
    units = _units(members).join(texts, "node")
    order = ["key", "i", "j"]
    spread = units.select(*order, "role", "node", "label", "text").repartition(partitions(members.sparkSession), *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, now, rows = Sketcher(shape), None, []
        for batch in batches:
            for part, texts in ragged.slices(batch, "text"):
                columns = [part.column(i).to_pylist() for i in range(6)]
                for i, (row, shingles) in enumerate(zip(zip(*columns, strict=True), maker.sets(texts), strict=True)):
                    if row[:3] != now:
                        yield _unit_links(rows, shape)
                        now, rows = row[:3], []
                    if np.array(maker.fingerprint(shingles), np.uint64).tobytes() == row[4]:
                        rows.append((*row[3:], shingles))
        yield _unit_links(rows, shape)

    return spread.sortWithinPartitions(*order).mapInArrow(run, "lead binary, node binary")


def _unit_links(rows: list[tuple[int, bytes, bytes, np.ndarray]], shape: Shape) -> pa.RecordBatch:
    """``rows`` are (role, node, label, set) of one unit; those of role 0 look for links
    to those of role 1."""
    found: list[tuple[bytes, bytes]] = []
    labels = [r[2] for r in rows]
    others = [k for k, r in enumerate(rows) if r[0] == 0]
    if others:
        number = {x: k for k, x in enumerate(dict.fromkeys(labels))}
        part = np.array([number[x] for x in labels])
        size = np.array([len(r[3]) for r in rows])
        to = np.array([r[0] == 1 for r in rows])
        shingles, inverse = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        owners = np.repeat(np.arange(len(rows)), size)[order]
        count = np.bincount(inverse, minlength=len(shingles))
        first = np.cumsum(count) - count
        at = np.cumsum(size) - size
        for k in others:
            mine = inverse[at[k] : at[k] + size[k]]
            n = count[mine]
            places = np.repeat(first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(owners[places], minlength=len(rows))
            near = (100 * both >= shape.percent * (size + size[k] - both)) & (part != part[k]) & to
            for v in np.flatnonzero(near):
                if part[v] != part[k]:
                    found.append((rows[k][1], rows[v][1]))
                    part[part == part[v]] = part[k]
    lead, node = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(lead, pa.binary()), pa.array(node, pa.binary())], ["lead", "node"])


def _mark(text_col: str) -> F.Column:
    """Tells rows that share an id apart."""
    return F.xxhash64(F.col(f"`{text_col}`").cast("string"))


def _assigned(docs: DataFrame, id_col: str, text_col: str, shape: Shape) -> DataFrame:
    """(id, mark, n, component, label, kept) of every row; rows of one id can be in
    several components, which ``label`` tells apart."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    source = source.withColumn("mark", _mark("text"))
    sketch = written(_sketch(source, shape), "sketch")
    named = sketch.where("node is not null and id is not null")

    # one row for each distinct set; the smallest id stands for it
    classes = named.groupBy("node").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.count("*").alias("copies"))
    classes = written(classes, "classes")
    bands = named.join(classes.select("node", F.col("rep").alias("id")), ["node", "id"]).select("node", F.explode("bands").alias("key"))
    bands = bands.distinct() if _repeats(named, classes) else bands
    full = bands.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    buckets = written(bands.join(full, "key").select("key", "node", "m"), "buckets")
    # a bucket is led by the member that meets most others in all its buckets
    weight = buckets.groupBy("node").agg(F.sum("m").alias("weight"))
    leads = buckets.join(weight, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", "node")).alias("lead"))

    candidates = buckets.select("node").distinct().join(classes, "node").select("node", "rep")
    texts = written(source.join(candidates, F.col("id") == F.col("rep")).select("node", "text").dropDuplicates(["node", "text"]), "texts")
    stars = buckets.join(leads, "key").where("lead <> node").select("lead", "node").distinct()
    links = written(_confirmed(written(stars, "pairs"), texts, shape), "links")
    roots = components(links)

    # members of one bucket that are in different components now
    label = roots.select(F.col("u").alias("node"), F.col("v").alias("label"))
    members = buckets.join(label, "node", "left").join(classes.select("node", "n"), "node")
    members = members.select("key", "node", "m", "n", F.coalesce("label", "node").alias("label"))
    mixed = members.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("key")
    apart = written(members.join(mixed, "key"), "apart")
    few = apart.where(F.col("m") <= FEW)
    other = few.select("key", F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("label").alias("label2"))
    fits = f"n * 100 >= n2 * {shape.percent} and n2 * 100 >= n * {shape.percent}"
    rest = few.join(other, "key").where(f"label <> label2 and node < node2 and {fits}").select(F.col("node").alias("lead"), F.col("node2").alias("node"))
    more = written(_confirmed(written(rest.distinct(), "pairs"), texts, shape), "links")
    many = written(_linked_in_units(apart.where(F.col("m") > FEW), texts, shape), "links")
    more = more.union(many)
    if not more.isEmpty():
        roots = components(roots.union(more))

    label = roots.select(F.col("u").alias("node"), F.col("v").alias("label"))
    joined = classes.join(label, "node", "left").select("node", "rep", F.coalesce("label", "node").alias("label"))
    least = joined.groupBy("label").agg(F.min("rep").alias("component"))
    ends = roots.select(F.col("v").alias("node")).union(roots.select(F.col("u").alias("node"))).distinct()
    linked = classes.where("copies > 1").select("node").union(ends).distinct()
    component = joined.join(linked, "node", "left_semi").join(least, "label").select("node", "component", "label")
    result = sketch.join(component, "node", "left").select(
        "id", "mark", "n", F.coalesce("component", "id").alias("component"), F.coalesce("label", "node").alias("label")
    )
    return result.withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(True)))


def _repeats(named: DataFrame, classes: DataFrame) -> bool:
    """Does an id stand twice on the same set (repeated rows)?"""
    twice = named.join(classes.select("node", F.col("rep").alias("id")), ["node", "id"])
    return twice.count() > classes.count()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shape: Shape | None = None) -> DataFrame:
    """(id, n_shingles, component_id, kept): component_id is the smallest id
    reachable over links, kept marks the row that stays."""
    return _assigned(docs, id_col, text_col, shape or Shape()).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shape: Shape | None = None) -> DataFrame:
    """The rows of ``docs`` with one document of each component: one with the
    component's id, where that id names several.  Rows without words or id all stay."""
    found = _assigned(docs, id_col, text_col, shape or Shape())
    mine, mark, order = fresh(docs, "id"), fresh(docs, "mark"), fresh(docs, "order")
    stay = found.where("kept and n > 0 and id is not null").groupBy(F.col("id").alias(mine), "label").agg(F.min("mark").alias(mark)).drop("label")
    id_, own = F.col(f"`{id_col}`"), _mark(text_col)
    free = id_.isNull() | (F.btrim(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit(SPACE_CHARS)) == "")
    rows = docs.join(stay.distinct(), (id_ == F.col(mine)) & (own == F.col(mark)), "left").where(free | F.col(mark).isNotNull())
    once = F.row_number().over(Window.partitionBy(id_, own).orderBy(F.lit(1)))
    return rows.withColumn(order, once).where(free | (F.col(order) == 1)).drop(mine, mark, order)
