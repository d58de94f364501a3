"""Prefix trie of conversations, built as a burst trie.

A conversation is a sequence of turn ids, packed into one binary value of
``CELL`` bytes a turn: 16 bytes of the turn's hash, then its number of words.  The
order of the packed values is the order of the sequences, and a prefix is a
prefix of bytes.  Equal sequences are one row with a count, so copies meet as
partial counts before any shuffle moves them.

At first all sequences lie in one container under the root.  In each round the
containers that are too large burst: the turns that all their suffixes share
become a chain, and the next turn id deals the suffixes into a container for each
child, held under the child as trie head.  Containers that are small enough stay.
In the end shards of containers are sorted and swept: neighbours share a prefix,
so one pass opens every node once.  Sums over subtrees go up inside a container
during the sweep, and from round to round through the trie heads.

Results by case: null roles and texts are empty; rows without conversation id
belong to no conversation and are left out; null turns come first, rows of one
turn number follow the order of their hashes, and repeated rows are turns of their
own; a conversation without turns ends at the root; an empty table has no nodes;
only the named columns are read, so others may have any name.  A conversation is
one row of 20 bytes a turn (its texts are not held), which bounds it to some
hundred million turns; a long text is hashed and counted where it is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.scratch import n_words, partitions, written

CELL, ID = 20, 16

#: Turns in common that one round can pass.
SKIP = 16

#: Ids of one piece of the list that a node's digest is taken over.
PIECE = 4096

ROOT = bytes(ID)
NOTHING = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Burst:
    """A container bursts beyond ``rows`` sequences, or beyond ``size`` bytes
    unless it holds a single one."""

    rows: int = 2048
    size: int = 1 << 24


def turn_cells(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, cell): a cell is 16 bytes of the hash of role and text, and the
    words of the text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.unhex(F.lpad(F.hex(n_words(text)), 2 * (CELL - ID), "0"))
    cell = F.concat(F.substring(F.unhex(F.sha2(both, 256)), 1, ID), words)
    rows = conversations.select(F.col(f"`{id_col}`").cast("bigint").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), cell.alias("cell"))
    return rows.where("conv is not null")


def _part(seq: Column, start: Column | int, length: Column | None = None) -> Column:
    """Cells ``start`` (from 0) and following of a packed sequence."""
    at = F.lit(CELL) * start + 1
    return F.substring(seq, at, F.octet_length(seq) if length is None else F.lit(CELL) * length)


def sequences(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, seq): the packed turns of every conversation in order."""
    cells = turn_cells(conversations, id_col, turn_col, role_col, text_col)
    return _packed(cells, "conv")


def _packed(cells: DataFrame, *keys: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("turn", "cell")))
    return cells.groupBy(*keys).agg(F.unhex(F.array_join(F.transform(ordered, lambda t: F.hex(t["cell"])), "")).alias("seq"))


def grafted(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    family: int = 20, most: int = 4,
) -> DataFrame:
    """(conv, seq): conversation c begins with the first h turns of conversation
    c - c % ``family`` and goes on with its own turns after its first h; h is the
    crc32 of the id, as text, modulo ``most``.  A family meets in one shuffle."""
    cells = turn_cells(conversations, id_col, turn_col, role_col, text_col)
    cells = cells.withColumn("base", F.col("conv") - F.col("conv") % family)
    cells = cells.repartition(partitions(conversations.sparkSession), "base")
    own = _packed(cells, "base", "conv").withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int"))
    head = F.max(F.when(F.col("conv") == F.col("base"), _part(F.col("seq"), 0, F.lit(most - 1)))).over(Window.partitionBy("base"))
    head = F.coalesce(head, F.lit(b""))
    return own.select("conv", F.concat(_part(head, 0, F.col("h")), _part(F.col("seq"), F.col("h"))).alias("seq"))


def _digest(head: Column, cells: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(head, cells), 256)), 1, ID)


def distinct_sequences(rows: DataFrame) -> DataFrame:
    """(seq, n, conv, ends) of (conv, seq): members of every distinct sequence, the
    smallest, and the SHA-256 of all of them, ascending and comma-joined.

    Lists are joined in pieces of neighbouring ids where the rows lie; one task
    then hashes the pieces of a sequence in order as a stream, so a sequence of
    very many conversations takes no more memory than a piece.
    """
    pieces = rows.groupBy(
        F.substring(F.unhex(F.sha2("seq", 256)), 1, ID).alias("key"), "seq", F.floor(F.col("conv") / PIECE).alias("piece")
    ).agg(F.sort_array(F.collect_list("conv")).alias("convs"))
    text = F.array_join(F.transform("convs", lambda c: c.cast("string")), ",")
    pieces = pieces.select("key", "piece", "seq", F.size("convs").cast("bigint").alias("n"), F.element_at("convs", 1).alias("conv"), text.alias("text"))
    dealt = pieces.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seq, n, least, digest = None, b"", 0, 0, None
        for batch in batches:
            out: list[tuple] = []
            for k, s, m, c, t in zip(*(batch.column(x).to_pylist() for x in ("key", "seq", "n", "conv", "text")), strict=True):
                if k == key:
                    digest.update(b"," + t.encode())
                    n += m
                    continue
                if key is not None:
                    out.append((seq, n, least, digest.hexdigest()))
                key, seq, n, least, digest = k, s, m, c, hashlib.sha256(t.encode())
            yield _rows(out)
        if key is not None:
            yield _rows([(seq, n, least, digest.hexdigest())])

    return dealt.mapInArrow(run, "seq binary, n bigint, conv bigint, ends string")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
    types = (pa.binary(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["seq", "n", "conv", "ends"])


def _oversized(rows: DataFrame, limit: Burst) -> DataFrame:
    """(head, skip, chain) of the containers that burst; ``skip`` turns are common
    to all suffixes of the container, ``chain`` holds them."""
    near = _part(F.col("suffix"), 0, F.lit(SKIP))
    sizes = rows.groupBy("head", "depth").agg(
        F.count("*").alias("m"), F.sum(F.octet_length("suffix")).alias("size"), F.min(near).alias("lo"), F.max(near).alias("hi")
    )
    big = sizes.where((F.col("m") > limit.rows) | ((F.col("m") > 1) & (F.col("size") > limit.size)))

    def common(k: Column) -> Column:
        lo, hi = _part(F.col("lo"), 0, k), _part(F.col("hi"), 0, k)
        return (lo == hi) & (F.octet_length(lo) == k * CELL)

    skip = F.size(F.filter(F.sequence(F.lit(1), F.lit(SKIP)), common))
    return big.withColumn("skip", skip).select("head", "depth", "skip", _part(F.col("lo"), 0, F.col("skip")).alias("chain"))


@dataclass
class _Round:
    """One round of bursts: the containers that burst, the children they got, and the
    sequences that end where a container branches."""

    burst: DataFrame
    links: DataFrame
    ended: DataFrame


def _burst(rows: DataFrame, limit: Burst) -> tuple[list[DataFrame], list[_Round]]:
    """(containers that stay, rounds of bursts) of (head, depth, suffix, n, conv,
    ends), all under the root.  A round reads and writes only the
    children of containers that burst in the round before."""
    stay, rounds = [], []
    while True:
        burst = written(_oversized(rows, limit), "burst")
        if burst.isEmpty():
            return [*stay, rows], rounds
        stay.append(rows.join(burst.select("head"), "head", "left_anti"))
        parted = rows.join(burst.select("head", "skip", "chain"), "head")
        ends_here = F.octet_length("suffix") == F.col("skip") * CELL
        ended = written(parted.where(ends_here).select("head", "n", "conv", "ends"), "ended")
        moved = parted.where(~ends_here).select(
            _digest(F.col("head"), _part(F.col("suffix"), 0, F.col("skip") + 1)).alias("head"),
            (F.col("depth") + F.col("skip") + 1).alias("depth"),
            _part(F.col("suffix"), F.col("skip") + 1).alias("suffix"),
            "n",
            "conv",
            "ends",
            F.col("head").alias("parent"),
            F.substring("suffix", F.col("skip") * CELL + ID + 1, F.lit(CELL - ID)).alias("words"),
        )
        moved = written(moved, "containers")
        links = moved.groupBy("head", "parent", "depth", "words").count()
        links = written(links.select("head", "parent", "depth", F.conv(F.hex("words"), 16, 10).cast("bigint").alias("words")), "links")
        rounds.append(_Round(burst, links, ended))
        rows = moved.select(*rows.columns)


_NODE = "conv bigint, depth int, parent_conv bigint, n bigint, children bigint, leaves bigint, saved bigint, ends string"
_FIELDS = ["conv", "depth", "parent_conv", "n", "children", "leaves", "saved", "ends"]
_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string()]


def sweep(depth: int, rows: list[tuple[bytes, int, int, str]]) -> list[list]:
    """Columns of the nodes of one container in preorder, its head first; ``rows``
    are its (suffix, n, conv, ends) in order.  The head's own words are unknown
    here, so its ``saved`` is that of the nodes below."""
    parent, at, words, n, conv, ends = [-1], [depth], [0], [0], [None], [NOTHING]
    path, before = [0], b""
    for suffix, count, least, digest in rows:
        k, cells = 0, len(suffix) // CELL
        while k < cells and suffix[CELL * k : CELL * k + CELL] == before[CELL * k : CELL * k + CELL]:
            k += 1
        del path[k + 1 :]
        for j in range(k, cells):
            parent.append(path[-1])
            path.append(len(at))
            at.append(depth + j + 1)
            words.append(int.from_bytes(suffix[CELL * j + ID : CELL * j + CELL], "big"))
            n.append(0)
            conv.append(None)
            ends.append(NOTHING)
        here = path[-1]
        n[here], conv[here], ends[here] = count, least, digest
        before = suffix
    size = len(at)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for i in range(size - 1, -1, -1):
        if not children[i]:
            leaves[i] = 1
        saved[i] += (n[i] - 1) * words[i]
        p = parent[i]
        if p >= 0:
            n[p] += n[i]
            conv[p] = conv[i] if conv[p] is None else min(conv[p], conv[i])
            children[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    return [conv, at, [None, *(conv[p] for p in parent[1:])], n, children, leaves, saved, ends]


def _swept(containers: DataFrame) -> DataFrame:
    """(top, node columns) of every container; ``top`` is its head in the row of the
    head's node, else null."""
    dealt = containers.repartition(partitions(containers.sparkSession), "head").sortWithinPartitions("head", "suffix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, depth, rows = None, 0, []

        def nodes() -> pa.RecordBatch:
            columns = sweep(depth, rows)
            top = pa.array([head, *[None] * (len(columns[0]) - 1)], pa.binary())
            return pa.RecordBatch.from_arrays([top, *(pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True))], ["top", *_FIELDS])

        for batch in batches:
            made = []
            names = ("head", "depth", "suffix", "n", "conv", "ends")
            for h, d, *row in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
                if h != head:
                    if rows:
                        made.append(nodes())
                    head, depth, rows = h, d, []
                rows.append(row)
            if made:
                yield from pa.Table.from_batches(made).combine_chunks().to_batches()
        if rows:
            yield nodes()

    return dealt.mapInArrow(run, f"top binary, {_NODE}")


def prefix_trie(rows: DataFrame, limit: Burst | None = None) -> DataFrame:
    """One row for each node of the trie over (conv, seq), every conv once: conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, words of a node's turn times its members but
    one) and ends_sha256 (of the members that end here)."""
    limit = limit or Burst()
    paths = distinct_sequences(rows).withColumnRenamed("seq", "suffix")
    # stored with its head: a literal head would turn the joins of the first round into loops
    stay, rounds = _burst(written(paths.withColumns({"head": F.lit(ROOT), "depth": F.lit(0)}), "paths"), limit)
    containers = stay[0]
    for more in stay[1:]:
        containers = containers.unionByName(more)
    swept = written(_swept(containers), "nodes")
    empty = F.lit(NOTHING)

    # from the last round to the first, burst containers sum up their children
    heads = swept.where("top is not null").withColumnRenamed("top", "head").drop("parent_conv", "depth")
    bodies = []  # (head, depth, skip, chain and the sums of the branching node)
    for made in reversed(rounds):
        below = made.links.join(heads, "head").select(
            F.col("parent").alias("head"), "n", "conv", F.lit(1).alias("child"), "leaves", (F.col("saved") + (F.col("n") - 1) * F.col("words")).alias("saved"),
            F.lit(None).cast("string").alias("ends"),
        )
        ended = made.ended.select("head", "n", "conv", F.lit(0).alias("child"), F.lit(0).alias("leaves"), F.lit(0).alias("saved"), "ends")
        sums = below.unionByName(ended).groupBy("head").agg(
            F.sum("n").alias("n"), F.min("conv").alias("conv"), F.sum("child").alias("children"), F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("branch_saved"), F.coalesce(F.max("ends"), empty).alias("ends"),
        )
        words = F.transform(F.sequence(F.lit(1), F.lit(SKIP)), lambda k: _words(F.col("chain"), k))
        body = made.burst.join(sums, "head").withColumn("words", F.slice(words, 1, F.col("skip")))
        total = F.aggregate("words", F.lit(0).cast("bigint"), lambda a, w: a + w)
        bodies.append(written(body.withColumn("saved", F.col("branch_saved") + (F.col("n") - 1) * total), "heads"))
        mine = bodies[-1].select("head", "n", "conv", "children", "leaves", "saved", "ends")
        heads = heads.unionByName(mine)

    out = swept.where("top is null").select(*_FIELDS)
    tops = swept.where("top is not null").withColumnRenamed("top", "head")
    if not rounds:
        return _named(out.unionByName(tops.select(*_FIELDS)))
    links, burst = rounds[0].links, bodies[0]
    for made in rounds[1:]:
        links = links.unionByName(made.links)
    for body in bodies[1:]:
        burst = burst.unionByName(body)
    above = burst.select(F.col("head").alias("parent"), F.col("conv").alias("above"))
    placed = links.join(above, "parent").select("head", F.col("words").alias("own"), "above")
    tops = tops.join(placed, "head", "left").withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.coalesce("own", F.lit(0)))
    out = out.unionByName(tops.withColumn("parent_conv", F.col("above")).select(*_FIELDS))

    # node k of a burst container's chain has the words of turns k and following below it
    chain = burst.join(placed, "head", "left").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("skip"))))
    last = F.col("k") == F.col("skip")
    own = F.concat(F.array(F.coalesce("own", F.lit(0).cast("bigint"))), F.col("words"))
    weight = F.aggregate(F.slice(own, F.col("k") + 1, F.col("skip") - F.col("k") + 1), F.lit(0).cast("bigint"), lambda a, w: a + w)
    chain = chain.select(
        "conv",
        (F.col("depth") + F.col("k")).alias("depth"),
        F.when(F.col("k") == 0, F.col("above")).otherwise(F.col("conv")).alias("parent_conv"),
        "n",
        F.when(last, F.col("children")).otherwise(1).alias("children"),
        "leaves",
        (F.col("branch_saved") + (F.col("n") - 1) * weight).alias("saved"),
        F.when(last, F.col("ends")).otherwise(empty).alias("ends"),
    )
    return _named(out.unionByName(chain))


def _words(chain: Column, k: Column) -> Column:
    return F.conv(F.hex(F.substring(chain, (k - 1) * CELL + ID + 1, F.lit(CELL - ID))), 16, 10).cast("bigint")


def _named(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("bigint").alias("depth"),
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").cast("bigint").alias("n_children"),
        F.col("leaves").cast("bigint").alias("n_leaves"),
        F.col("saved").cast("bigint").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
