"""Mixing sources to target weights as a min-cost flow.

Documents are added up by membership pattern (the set of sources they belong
to).  Words flow from patterns to the quotas of their sources; a pattern offers
its words once for each allowed repetition, each time at a higher cost, so the
cheapest flow repeats as little as the quotas allow.  Inside a pattern, documents
in a seeded order get the last, partial repetition; everything before it all get.

Results by case: a null text has size 0; rows without a source form the source
null, last in order; an empty list of sources takes part in nothing; documents of
size 0 are taken 0 times; rows that tie in the seeded order (same id and size)
share the rest evenly; an empty table mixes to nothing.  Patterns and sources stay
in tables; only sources that share patterns meet in a flow, one task for each
connected component.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.components import components
from weekloom.llm.scratch import dropping, fresh, n_words, partitions, written

#: Hex digits of the seeded key that make a histogram cell.
CELL_DIGITS = 4


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    repeats: int = 2
    seed: int = 17


def fill(sizes: list[int], weights: list[float], total: float, repeats: int) -> list[float]:
    """``total`` by weight, no share above ``repeats`` times its size; what is
    over goes to the others by weight until none is above."""
    tops = [repeats * s for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: tops[i] / weights[i])
    left, weight = total, float(sum(weights))
    out = [0.0] * len(sizes)
    for k, i in enumerate(order):
        if tops[i] * weight <= left * weights[i]:
            out[i] = float(tops[i])
            left, weight = left - tops[i], weight - weights[i]
        else:
            for j in order[k:]:
                out[j] = left * weights[j] / weight
            break
    return out


def min_cost_flow(supply: list[int], member: list[list[int]], quota: list[int], repeats: int) -> list[int]:
    """Words taken of each pattern, at the least sum of repetition numbers.

    Only the arcs into patterns cost anything (the repetition, 1, 2, ...), so a
    cheapest path costs its repetition: each repetition adds a maximum flow
    (Dinic's levels and blocking flows) to those before it."""
    n, m = len(supply), len(quota)
    first, last = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    to: list[int] = []
    cap: list[int] = []

    def arc(a: int, b: int, room: int) -> None:
        graph[a].append(len(to))
        graph[b].append(len(to) + 1)
        to.extend((b, a))
        cap.extend((room, 0))

    for p in range(n):
        arc(first, p, 0)
    for p in range(n):
        for s in member[p]:
            arc(p, n + s, repeats * supply[p])
    for s in range(m):
        arc(n + s, last, quota[s])

    def levels() -> list[int]:
        level = [-1] * len(graph)
        level[first], ring = 0, [first]
        while ring and level[last] < 0:
            ahead = []
            for a in ring:
                for e in graph[a]:
                    if cap[e] and level[to[e]] < 0:
                        level[to[e]] = level[a] + 1
                        ahead.append(to[e])
            ring = ahead
        return level

    for _ in range(repeats):
        for p in range(n):
            cap[2 * p] += supply[p]
        while (level := levels())[last] >= 0:
            at, path = [0] * len(graph), []
            while True:
                a = to[path[-1]] if path else first
                if a == last:
                    room = min(cap[e] for e in path)
                    for e in path:
                        cap[e] -= room
                        cap[e ^ 1] += room
                    path = path[: next(k for k, e in enumerate(path) if not cap[e])]
                    continue
                while at[a] < len(graph[a]) and not (cap[e := graph[a][at[a]]] and level[to[e]] == level[a] + 1):
                    at[a] += 1
                if at[a] < len(graph[a]):
                    path.append(graph[a][at[a]])
                elif path:
                    at[to[path.pop() ^ 1]] += 1
                else:
                    break
    return [cap[2 * p + 1] for p in range(n)]


def _before(ranged: DataFrame, **sums: F.Column) -> dict[str, F.Column]:
    """Sum of each column over all rows of smaller ``part`` or, inside it, smaller
    ``source``; only one row per part comes to the driver."""
    totals = {r.part: r for r in ranged.groupBy("part").agg(*[F.sum(c).alias(k) for k, c in sums.items()]).collect()}
    upto = Window.partitionBy("part").orderBy("source")
    out = {}
    for k, c in sums.items():
        starts, running = [], 0
        for part in range(max(totals, default=0) + 1):
            starts.append(running)
            running += totals[part][k] if part in totals else 0
        start = F.element_at(F.lit(starts).cast("array<bigint>"), F.col("part") + 1)
        out[k] = start + F.sum(c).over(upto) - c
    return out


def _quotas(patterns: DataFrame, how: Mix) -> DataFrame:
    """(source, own, target, quota) of every source: ``fill`` on a table.

    Sources are in order by code point (the null source, whose mark follows the
    letter of the others, is last).  Sums are of whole numbers, so that neither
    the order of rows nor the number of partitions changes a target."""
    spark, m = patterns.sparkSession, len(how.weights)
    own = patterns.select(F.explode("pattern").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("own"))
    own = own.repartitionByRange(partitions(spark), "source").withColumn("part", F.spark_partition_id())
    own = written(own, "own")
    place = _before(own, place=F.lit(1).cast("bigint"))["place"]
    sources = written(own.withColumn("turn", (place % m).cast("int")), "sources")

    total = how.share * (patterns.where(F.size("pattern") > 0).agg(F.sum("size")).first()[0] or 0)
    w = F.element_at(F.lit([float(x) for x in how.weights]), F.col("turn") + 1)
    tops = F.col("own") * how.repeats
    # sources at their top leave the rest to the others until no more reach theirs
    n_full, left, weight, full = -1, total, None, F.lit(False)
    while True:
        rows = sources.groupBy("turn").agg(F.count_if(full).alias("full"), F.count_if(~full).alias("open"), F.sum(F.when(full, tops)).alias("tops")).collect()
        n = sum(r.full for r in rows)
        if n == n_full:
            break
        n_full, left = n, total - sum(r.tops or 0 for r in rows)
        weight = float(sum(r.open * how.weights[r.turn] for r in sorted(rows)))
        full = tops * F.lit(weight) <= w * F.lit(left) if any(r.open for r in rows) else F.lit(True)
    weight = weight or 1.0
    share = F.lit(left) * w / F.lit(weight)
    flagged = sources.withColumn("full", full)
    sums = {"tops": F.when(F.col("full"), tops).otherwise(F.lit(0)).cast("bigint")}
    sums |= {f"open{k}": (~F.col("full") & (F.col("turn") == k)).cast("bigint") for k in range(m)}
    before = _before(flagged, **sums)

    def edge(at: dict[str, F.Column]) -> F.Column:
        weights = sum((at[f"open{k}"] * F.lit(float(how.weights[k])) for k in range(m)), F.lit(0.0))
        return F.rint(at["tops"] + weights * F.lit(left) / F.lit(weight)).cast("bigint")

    quota = edge({k: before[k] + c for k, c in sums.items()}) - edge(before)
    return written(flagged.select("source", "own", F.when(F.col("full"), tops.cast("double")).otherwise(share).alias("target"), quota.alias("quota")), "quotas")


def _taken(patterns: DataFrame, quotas: DataFrame, repeats: int) -> DataFrame:
    """(pattern, size, own, target, taken) of every pattern with a source.

    A source that is in no pattern but its own takes what its quota allows.
    Sources that share patterns form components, each solved in its own task."""
    links = patterns.where(F.size("pattern") > 1).select(F.col("pattern")[0].alias("a"), F.explode(F.expr("slice(pattern, 2, size(pattern) - 1)")).alias("b"))
    group = components(links)
    rows = patterns.where(F.size("pattern") > 0).withColumn("source", F.col("pattern")[0]).join(quotas, "source")
    alone = F.least("quota", F.col("size") * repeats).alias("taken")
    if group.isEmpty():
        return rows.select("pattern", "size", "own", "target", alone)
    group = written(group.union(group.select("v", "v").distinct()).toDF("source", "component"), "linked")
    rows = rows.join(group, "source", "left")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        sources = right.sort_by("source")
        place = {s: k for k, s in enumerate(sources["source"].to_pylist())}
        found = sorted(zip(left["pattern"].to_pylist(), left["size"].to_pylist(), left["own"].to_pylist(), left["target"].to_pylist(), strict=True))
        taken = min_cost_flow([r[1] for r in found], [[place[x] for x in r[0]] for r in found], sources["quota"].to_pylist(), repeats)
        names = ["pattern", "size", "own", "target", "taken"]
        kinds = [pa.list_(pa.string()), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip([*zip(*found, strict=True), taken], kinds, strict=True)], names)

    tangled = rows.where("component is not null").select("component", "pattern", "size", "own", "target")
    limits = quotas.join(group, "source").select(F.col("component").alias("held"), "source", "quota")
    schema = "pattern array<string>, size bigint, own bigint, target double, taken bigint"
    solved = tangled.groupBy("component").cogroup(limits.groupBy("held")).applyInArrow(solve, schema)
    return rows.where("component is null").select("pattern", "size", "own", "target", alone).union(solved)


def mix(docs: DataFrame, sources: F.Column, id_col: str = "doc_id", text_col: str = "text", how: Mix | None = None) -> DataFrame:
    """``docs`` with ``size``, ``pattern``, ``source_size``, ``target`` and
    ``taken``.  ``sources`` is an array of names (a null name is the null source);
    source_size and target belong to the first source of the pattern.  Columns
    of ``docs`` with these names are replaced."""
    how = how or Mix()
    size, key, pat = fresh(docs, "size"), fresh(docs, "key"), fresh(docs, "pattern")
    id_text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    names = F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.coalesce(F.concat(F.lit("s"), s), F.lit("~")))))
    mixed = docs.withColumn(size, n_words(F.col(f"`{text_col}`").cast("string")))
    mixed = mixed.withColumns({key: F.md5(F.concat_ws(":", F.lit(str(how.seed)), id_text, F.col(size).cast("string")).cast("binary")), pat: names})
    sized = written(mixed.select(F.col(pat).alias("pattern"), F.col(size).alias("size"), F.col(key).alias("key")), "sized")
    cells = sized.groupBy("pattern", F.substring("key", 1, CELL_DIGITS).alias("cell")).agg(F.sum("size").alias("size"))
    cells = written(cells, "cells")

    patterns = written(cells.groupBy("pattern").agg(F.sum("size").alias("size")), "patterns")
    taken = _taken(patterns, _quotas(patterns, how), how.repeats)
    whole = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0)
    plan = taken.select("pattern", F.col("own").alias("source_size"), "target", whole.alias("whole"), (F.col("taken") - whole * F.col("size")).alias("rest"))
    plan_df = written(plan, "plan")

    # the cell, and in it the key, at which the partial repetition ends
    upto = Window.partitionBy("pattern").orderBy("cell")
    run = cells.withColumn("above", F.sum("size").over(upto)).join(plan_df, "pattern")
    edge_cell = run.where("above - size <= rest and above > rest").select("pattern", "cell", (F.col("rest") - F.col("above") + F.col("size")).alias("room"))
    near = sized.withColumn("cell", F.substring("key", 1, CELL_DIGITS)).join(edge_cell, ["pattern", "cell"])
    ties = near.groupBy("pattern", "room", "key").agg(F.sum("size").alias("size"), F.count("*").alias("ties"))
    inside = ties.withColumn("above", F.sum("size").over(Window.partitionBy("pattern").orderBy("key")))
    edge = inside.where("above - size <= room and above > room").select(
        "pattern", F.col("key").alias("edge"), F.expr("(room - above + size) div ties").alias("part")
    )
    ends = plan_df.join(edge, "pattern", "left").withColumnRenamed("pattern", "held")
    ends = written(ends, "ends")
    result = dropping(mixed, "size", "pattern", "source_size", "target", "taken").join(ends, F.col(pat) == F.col("held"), "left")
    extra = F.when(F.col(key) < F.col("edge"), F.col(size)).when(F.col(key) == F.col("edge"), F.col("part")).otherwise(0)
    chosen = [F.col(f"`{c}`") for c in dropping(docs, "size", "pattern", "source_size", "target", "taken").columns]
    return result.select(
        *chosen,
        F.col(size).alias("size"),
        F.transform(pat, lambda s: F.when(s != "~", F.substr(s, F.lit(2)))).alias("pattern"),
        F.coalesce("source_size", F.lit(0)).alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        (F.col(size) * F.coalesce("whole", F.lit(0)) + extra).cast("bigint").alias("taken"),
    )
