"""Intermediate tables in the shared folder, and unclashing column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.session import scratch_path
from weekloom.session import stored as written  # noqa: F401  (the name used by the operators)

#: white space of the word rules, for SQL functions
SPACES_SQL = "\\x20\\x09-\\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``written``, as an unmanaged table in buckets of ``key``: later joins on it
    move the other side only."""
    path, n = scratch_path(df.sparkSession, name), partitions(df.sparkSession)
    table_name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
    rows.option("path", path).option("compression", "zstd").format("parquet").saveAsTable(table_name)
    return df.sparkSession.table(table_name)


#: Bytes of an Arrow batch; a row of more is a batch of its own.
BATCH_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Python is sent some BATCH_BYTES at once, where the session does not say otherwise.
    By default a batch has up to 64 MB, which the executor and its worker both hold."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    name, k = f"__{stem}", 0
    while name.lower() in have:
        k += 1
        name = f"__{stem}{k}"
    return name


def dropping(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator's own output columns would clash with."""
    mine = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in mine])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text) -> F.Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, f"[{SPACES_SQL}]+"))).cast("bigint")
