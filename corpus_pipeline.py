"""A corpus pipeline of the training-text operators.

Every stage takes the documents that its predecessor kept and returns those it
keeps, with the columns of ``documents``; the last returns the documents of the
mix with the words taken of each.

Results by case (each stage): an empty table gives an empty table; extra columns
are carried along under any name (the mix's own columns replace columns of the
same name); nulls, ties and repeated rows are treated as the operator of the stage
says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.decontaminate import clean_of
from weekloom.llm.line_dedup import drop_common_lines
from weekloom.llm.mixing import mix
from weekloom.llm.near_dup import one_of_each
from weekloom.llm.quality_classifier import good_rows
from weekloom.llm.scratch import SPACE_CHARS, dropping, fresh, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier rejects go."""
    return good_rows(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more documents stay in the first of them only.  A document
    that had words and has lost all of them goes; n_chars follows the text."""
    old, counts = fresh(docs, "old"), ("n_lines", "n_dropped")
    names = {c.lower(): fresh(docs, c) for c in counts if c in [x.lower() for x in docs.columns]}
    kept = docs.withColumnsRenamed({c: names[c.lower()] for c in docs.columns if c.lower() in names})
    kept = drop_common_lines(kept.withColumn(old, F.col("text")), keep_first=True)

    def bare(c: str) -> F.Column:
        return F.btrim(F.coalesce(F.col(c), F.lit("")), F.lit(SPACE_CHARS))

    kept = kept.where((bare("text") != "") | (bare(old) == "")).withColumn("text", F.when(F.col("n_dropped") > 0, F.col("text")).otherwise(F.col(old)))
    if "n_chars" in docs.columns:
        chars = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    kept = kept.drop(*counts).withColumnsRenamed({new: c for c in docs.columns if (new := names.get(c.lower()))})
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, 0.8)."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return clean_of(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with size, source_size, target and taken."""
    return dropping(mix(docs, F.array("source")), "pattern").where("taken > 0")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("source_mix", mixed),
]

#: The classifier's training cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
