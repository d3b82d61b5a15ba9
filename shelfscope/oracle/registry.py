"""Composes oracle queries from named CTE bodies (DuckDB SQL).

Each CTE is registered once; a query names its final SELECT and pulls in the
CTEs it references (transitively), in registration order.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}
FINALS: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    if name in CTES:
        raise ValueError(f"duplicate CTE {name}")
    CTES[name] = body


def final(key: str, body: str) -> None:
    FINALS[key] = body


def _refs(sql: str) -> set[str]:
    words = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", sql))
    return {w for w in words if w in CTES}


def compose(key: str) -> str:
    body = FINALS[key]
    ordered: list[str] = []

    def visit(n: str) -> None:  # dependencies first
        if n in ordered:
            return
        for d in sorted(_refs(CTES[n]) - {n}):
            visit(d)
        ordered.append(n)

    for n in sorted(_refs(body)):
        visit(n)
    if not ordered:
        return body
    withs = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in ordered)
    return f"WITH {withs}\n{body}"
