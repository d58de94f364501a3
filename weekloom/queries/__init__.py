"""Every operator run over whole generated tables, next to the SQL that must
give the same rows."""

from weekloom.queries import (  # noqa: F401  (importing registers the queries)
    aggregates,
    columns,
    forecasts,
    joins,
    plans,
    profiles,
    ranking,
    reshape,
    rows,
    scalars,
    scoring,
    sources,
    windows,
)
from weekloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
