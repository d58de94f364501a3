"""Session set-up and the two questions plans ask of it: where may a job write
intermediate tables, and is this side of a join small enough to broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "weekloom") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. The cluster names it in
    ``spark.checkpoint.dir``.  Only a local session without one (tests) gets
    a folder of its own; a cluster without one is refused."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="weekloom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nothing else uses, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, *partition_by: str, large_rows: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, no lineage
    above it, safe from lost executors, and of a size that Catalyst knows.
    ``large_rows``: rows of some MB each; a reader then holds one at a time and not a
    row group of them."""
    path = scratch_path(df.sparkSession, name)
    out = df.write.partitionBy(*partition_by).option("compression", "zstd")
    (out.option("parquet.block.row.count.limit", "1") if large_rows else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partitioned by key into the session's full number of shuffle
    partitions.  For steps that compute much on few bytes, whose partitions AQE
    would otherwise merge into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of the optimised plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    if text.lstrip("-").isdigit():
        return int(text)
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def fits_broadcast(df: DataFrame) -> bool:
    """Would Catalyst broadcast this side by itself?"""
    limit = broadcast_limit(df.sparkSession)
    return 0 < limit and estimated_bytes(df) <= limit
