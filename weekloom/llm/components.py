"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).toDF("u", "v")


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node of ``edges`` (two columns, any orderable type) but the
    smallest of its component, with that smallest.

    Each round is written to the shared folder.  Rounds grow with the logarithm
    of the longest path; only two numbers a round reach the driver.
    """
    a, b = edges.columns
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now = written(now, "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            return now
        before = state
        now = written(_small_star(_large_star(now).distinct()).distinct(), "edges")
