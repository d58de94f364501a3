"""Records of CSV files whose quoted fields hold line breaks, read in parallel.

A byte range of a file cannot tell by itself whether it begins inside a quoted
field.  So quotes are counted first, range by range; the parity of all quotes before
a range says whether it begins inside one.  Then every range finds its records
alone: a line that leaves a quote open goes on in the next.  Records that reach over
the end of a range are left in fragments, two for each range at most, and put
together afterwards.  Doubled quotes count twice and change nothing; a field that
holds a quote must be quoted, as CSV writers do.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The functions travel with their task: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WHOLE, HEAD, MIDDLE, TAIL = range(4)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value, quotes): physical lines and the range each was read in."""
    read = spark.read.option("lineSep", "\n").text(path)
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", quotes.alias("quotes"))


def quote_parity(rows: DataFrame) -> DataFrame:
    """(file, block, begins_open, broken) of every range: does it begin inside a quoted
    field, and how many of its lines end inside one or begin there?"""
    blocks = rows.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.count_if(F.col("quotes") % 2 == 1).alias("odd"))
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return blocks.select("file", "block", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("begins_open"), F.col("odd").alias("broken"))


def _fragments(rows: DataFrame) -> DataFrame:
    """(file, block, kind, text) of (file, block, value, quotes, begins_open), whose
    ranges come whole and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        kind, held, open_ = WHOLE, [], False

        def ended() -> list[tuple]:
            if not held:
                return []
            return [(*now, MIDDLE if kind == TAIL else HEAD, "\n".join(held))]

        for batch in batches:
            out: list[tuple] = []
            for file, block, value, quotes, begins_open in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) != now:
                    out += ended()
                    now, held, open_ = (file, block), [], begins_open
                    kind = TAIL if begins_open else WHOLE
                held.append(value)
                open_ ^= quotes % 2 == 1
                if not open_:
                    out.append((*now, kind, "\n".join(held)))
                    kind, held = WHOLE, []
            yield _batch(out)
        yield _batch(ended())

    return rows.select("file", "block", "value", "quotes", "begins_open").mapInArrow(run, "file string, block bigint, kind int, text string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
    types = (pa.string(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["file", "block", "kind", "text"])


def csv_records(spark: SparkSession, path: str, parity: DataFrame) -> DataFrame:
    """(file, text): every record of the files, headers among them; ``parity`` is
    :func:`quote_parity` of the same lines."""
    # one row for each range that begins inside a field at most: of the size of a file listing
    inside = parity.filter("begins_open").select("file", "block", "begins_open")
    rows = lines(spark, path).join(F.broadcast(inside), ["file", "block"], "left").withColumn("begins_open", F.coalesce("begins_open", F.lit(False)))
    found = _fragments(rows)
    whole = found.filter(F.col("kind") == WHOLE).select("file", "text")
    # a head opens a record; middles and the tail that follow it belong to the same one
    order = Window.partitionBy("file").orderBy("block", (F.col("kind") == HEAD).cast("int"))
    parts = found.filter(F.col("kind") != WHOLE)
    parts = parts.withColumns({"number": F.count_if(F.col("kind") == HEAD).over(order), "place": F.row_number().over(order)})
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda p: p["text"]), "\n")
    glued = parts.groupBy("file", "number").agg(joined.alias("text")).select("file", "text")
    return whole.unionByName(glued).withColumn("text", F.regexp_replace("text", "\r$", "")).filter("text <> ''")
