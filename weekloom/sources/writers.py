"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weekloom.sources.readers import CSV_OPTIONS


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Whole table, replacing an earlier version; CSV gets a header."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.save(path)


def write_per_group(df: DataFrame, path: str, group: str, fmt: str = "parquet") -> None:
    """One directory per group.  The rebalance hint sends a group's rows to the
    same writer, and AQE splits a group that is too large for one task, so a
    dominant group costs extra files and not a straggler."""
    writer = df.hint("rebalance", group).write.mode("overwrite").partitionBy(group).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.save(path)
