"""Column-expression helpers shared by the operators.

All helpers return JVM-side ``Column`` expressions (no Python UDFs), so the
operators stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

def hundred() -> Column:
    return F.lit(100.0)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: str | Column) -> Column:
    return col(c).cast("double")


# Money and quantities stay in the source's own decimal type up to the mart: sums
# are exact, independent of order and never rounded per row.  ``money`` gives the
# double that the mart stores.
def money(c: str | Column) -> Column:
    return col(c).cast("double")


def blank_to(c: str | Column, default: str = "") -> Column:
    """``NVL(c, default)`` for strings."""
    return F.coalesce(col(c), F.lit(default))


def is_filled(c: str | Column) -> Column:
    """``NVL(c, '') != ''``: the value is present and not empty."""
    return blank_to(c) != F.lit("")


def share_or_zero(part: str | Column, total: str | Column) -> Column:
    """``CASE WHEN total = 0 THEN 0 ELSE 100 * part / total END`` (NULL total -> NULL)."""
    t = col(total)
    return F.when(t == 0, F.lit(0.0)).otherwise(hundred() * col(part) / t)


def growth_or_zero(cur: str | Column, year_ago: str | Column) -> Column:
    """``CASE WHEN ya = 0 THEN 0 ELSE 100 * (cur - ya) / ya END``."""
    ya = col(year_ago)
    return F.when(ya == 0, F.lit(0.0)).otherwise(hundred() * (col(cur) - ya) / ya)


def share_or_null(part: str | Column, total: str | Column) -> Column:
    """``CASE WHEN NVL(total, 0) != 0 THEN 100 * part / total END`` (else NULL)."""
    t = col(total)
    return F.when(F.coalesce(t, F.lit(0.0)) != 0, hundred() * col(part) / t)


def not_in_upper(c: str | Column, values: Iterable[str]) -> Column:
    """``UPPER(c) NOT IN (...)`` with SQL NULL semantics (NULL input -> NULL)."""
    return ~F.upper(col(c)).isin(*values)


def not_like_upper(c: str | Column, pattern: str) -> Column:
    return ~F.upper(col(c)).like(pattern)


def sorted_distinct_list(c: str | Column) -> Column:
    """Ordered, de-duplicated, ``', '``-joined list (an aggregate / window function)."""
    return F.array_join(F.array_sort(F.collect_set(col(c))), ", ")


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)
