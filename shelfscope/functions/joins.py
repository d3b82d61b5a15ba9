"""Join helpers that keep SQL key semantics explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_back(df: DataFrame, totals: DataFrame, keys: Sequence[str], how: str = "left",
              null_safe: Sequence[str] = ()) -> DataFrame:
    """Attach per-group aggregates to rows, matching NULL keys in ``null_safe``.

    A window ``PARTITION BY k`` groups NULL keys together; a ``groupBy`` +
    join-back reproduces that only when those keys are compared null-safely.
    """
    prefixed = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[c for c in totals.columns if c not in keys],
    )
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_k_{k}")) if k in null_safe else F.col(k) == F.col(f"_k_{k}")
        cond = c if cond is None else cond & c
    return df.join(prefixed, cond, how).drop(*[f"_k_{k}" for k in keys])
