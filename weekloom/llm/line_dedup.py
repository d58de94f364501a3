"""Lines that stand in many documents, by levelled sorted runs of line hashes.

Counts of line keys are kept as runs: tables of (hash, n_docs, first_id) sorted
by hash.  A batch of documents is counted, keys that the runs already hold as
common are taken off by an anti-join, and the rest becomes a new run of level 0.
Whenever a level holds ``fanout`` runs they are merged into one run of the next
level, so a key is rewritten a logarithmic number of times.  DataFrame functions
only.

Results by case: a null or empty text is one empty line; an empty key is never
common; equal lines of one row count once; repeated rows count as rows; lines
keep their order and their exact characters.  ``keep_first`` leaves a common
line in the document with the smallest id among the batches up to the one in
which it became common (rows without id never count as first, unless no row has
one).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.scratch import SPACE_CHARS, fresh, written


def ascii_lower(text: Column) -> Column:
    """A-Z only; plain ``lower`` serves lines without other characters."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def _hash(key: Column) -> Column:
    """128 bits of SHA-256; null for the empty key."""
    return F.when(key != "", F.substring(F.unhex(F.sha2(key, 256)), 1, 16))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row_key(id_: Column, text: Column) -> Column:
    """Equal for rows that are equal in id and text."""
    both = F.concat(F.coalesce(id_.cast("string"), F.lit("-")), F.lit("\n"), F.coalesce(text, F.lit("")))
    return F.substring(F.unhex(F.sha2(both, 256)), 1, 16)


class LineRuns:
    """Counts of line keys over batches of documents; lives in the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 4):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        everything = runs[0]
        for run in runs[1:]:
            everything = everything.unionByName(run)
        return everything.groupBy("hash").agg(F.sum("n_docs").alias("n_docs"), F.min("first_id").alias("first_id"))

    def _sorted(self, run: DataFrame) -> DataFrame:
        return written(run.sortWithinPartitions("hash"), "run")

    def add(self, keyed: DataFrame) -> None:
        """``keyed`` is (id, hashes): the distinct line hashes of each row."""
        mine = keyed.select("id", F.explode("hashes").alias("hash"))
        mine = mine.groupBy("hash").agg(F.count("*").alias("n_docs"), F.min("id").alias("first_id"))
        if self.runs():
            mine = mine.join(self.common().select("hash"), "hash", "left_anti")
        self.levels[0].append(self._sorted(mine))
        self._compact()

    def _compact(self) -> None:
        for k in range(len(self.levels)):
            if len(self.levels[k]) >= self.fanout:
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self._sorted(self._merged(self.levels[k])))
                self.levels[k] = []

    def common(self) -> DataFrame:
        """(hash, n_docs, first_id) of the keys that reach ``min_docs``; n_docs
        counts the batches up to the one in which they reached it."""
        return self._merged(self.runs()).where(F.col("n_docs") >= self.min_docs)


def drop_common_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, batches: int = 5, keep_first: bool = False
) -> DataFrame:
    """``docs`` with the text rewritten, and columns ``n_lines`` (before) and
    ``n_dropped``; columns of ``docs`` with these names are replaced."""
    spark, id_, text = docs.sparkSession, F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(
        id_.alias("id"),
        _row_key(id_, text).alias("row"),
        F.transform(_lines(text), lambda line: _hash(line_key(line))).alias("line_hashes"),
    )
    keyed = written(keyed.withColumn("batch", F.pmod(F.hash("row"), F.lit(batches))), "lines", "batch")
    runs = LineRuns(spark, min_docs)
    for batch in range(batches):
        mine = keyed.where(F.col("batch") == batch)
        runs.add(mine.select("id", F.array_distinct(F.array_compact("line_hashes")).alias("hashes")))
    common = runs.common().select("hash", "first_id")
    places = keyed.select("id", "row", F.posexplode("line_hashes").alias("pos", "hash")).where("hash is not null")
    hits = places.join(common, "hash")
    if keep_first:
        hits = hits.where(~F.col("id").eqNullSafe(F.col("first_id")))
    # dropped places as bits of 64-bit words, one for every 64 lines of a row, hit or not
    row, drop = fresh(docs, "row"), fresh(docs, "drop")
    bits = hits.select("row", F.expr("pos div 64").cast("int").alias("word"), F.expr("shiftleft(1L, pos % 64)").alias("bits"))
    blank = keyed.select("row", F.explode(F.sequence(F.lit(0), F.expr("cast((size(line_hashes) - 1) div 64 as int)"))).alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = bits.unionByName(blank).groupBy("row", "word").agg(F.bit_or("bits").alias("bits"))
    gone = words.groupBy(F.col("row").alias(row)).agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias(drop))
    joined = docs.withColumn(row + "_", _row_key(id_, text)).join(gone, F.col(row + "_") == F.col(row), "left")
    lines = _lines(text)
    dropped = F.aggregate(F.col(drop), F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w))

    def is_kept(_: Column, i: Column) -> Column:
        return F.getbit(F.get(F.col(drop), F.floor(i / 64).cast("int")), i % 64) == 0

    kept = F.when(dropped == 0, F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.filter(lines, is_kept), "\n"))
    counts = {"n_lines": F.size(lines).cast("bigint"), "n_dropped": dropped}
    return joined.withColumns({**counts, text_col: kept}).drop(row, row + "_", drop)
