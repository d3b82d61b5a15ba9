"""DuckDB oracle: the same queries as ANSI SQL over the same Parquet tables."""

from shelfscope.oracle import drivers_sql, mart_sql, masters_sql, pos_sql, shipment_sql, sources_sql  # noqa: F401
from shelfscope.oracle.registry import FINALS, compose


def oracle_queries() -> dict[str, str]:
    return {k: compose(k) for k in FINALS}
