"""Registration of queries.

``columns`` names the result columns with one-letter types, e.g.
``"genre:s date:d total:f2 n:i"``.  Both sides are brought to it by one last
projection: text, ISO dates, 64-bit integers, doubles rounded to the given
digits.  Engines add floats in different orders, so before rounding a nudge far
below the last digit moves values such as 0.125 off the rounding boundary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _nudge(kind: str) -> float:
    return 1.3713 * 10 ** -(int(kind[1:]) + 2)


def _spark(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    if kind == "d":
        c = F.date_format(c, "yyyy-MM-dd")
    elif kind == "i":
        c = c.cast("bigint")
    elif kind.startswith("f"):
        c = F.round(c.cast("double") + F.lit(_nudge(kind)), int(kind[1:])) + F.lit(0.0)
    else:
        c = c.cast("string")
    return c.alias(name)


def _sql(name: str, kind: str) -> str:
    c = f'"{name}"'
    if kind == "d":
        c = f"strftime({c}, '%Y-%m-%d')"
    elif kind == "i":
        c = f"CAST({c} AS BIGINT)"
    elif kind.startswith("f"):
        c = f"round(CAST({c} AS DOUBLE) + CAST({_nudge(kind)!r} AS DOUBLE), {kind[1:]}) + 0.0"
    else:
        c = f"CAST({c} AS VARCHAR)"
    return f'{c} AS "{name}"'


def query(name: str, columns: str, sql: str | None = None) -> Callable[[Query], Query]:
    spec = [c.rsplit(":", 1) for c in columns.split(" ")]
    spec = [(name.replace("~", " "), kind) for name, kind in spec]

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir).select(*[_spark(c, k) for c, k in spec])

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = f"SELECT {', '.join(_sql(c, k) for c, k in spec)} FROM ({sql}) AS result"
        return fn

    return register
