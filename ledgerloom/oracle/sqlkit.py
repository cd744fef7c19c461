"""Assemble self-contained DuckDB queries out of named CTEs.

Each CTE is registered with the names it reads; ``compose(body, deps)``
emits ``WITH`` + every needed CTE in dependency order + the body. Only the
driver tables are assumed to exist as views.
"""

from __future__ import annotations

import re

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    _CTES[name] = (sql.strip(), tuple(deps))


def with_name(name: str, like: str, old: str, new: str) -> None:
    """A CTE like another one that reads ``new`` where that one reads ``old``."""
    sql, deps = _CTES[like]
    cte(name, re.sub(rf"\b{old}\b", new, sql), tuple(new if d == old else d for d in deps))


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n: str, stack: tuple[str, ...] = ()):
        if n in seen:
            return
        if n in stack:
            raise ValueError(f"CTE cycle at {n}")
        for d in _CTES[n][1]:
            visit(d, stack + (n,))
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def compose(body: str, deps: tuple[str, ...] | list[str]) -> str:
    names = _order(deps)
    if not names:
        return body.strip()
    parts = [f"{n} AS (\n{_CTES[n][0]}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def money(expr: str) -> str:
    """Integer cents -> DECIMAL(18,2), exactly as the Spark side does it."""
    return f"CAST(CAST(({expr}) AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def cents(expr: str) -> str:
    return f"CAST(round(({expr}) * 100) AS BIGINT)"


def mon(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


def sql_list(values) -> str:
    def q(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    return "[" + ", ".join(q(v) for v in values) + "]"


def sql_values(rows) -> str:
    def q(v):
        if v is None:
            return "NULL"
        if isinstance(v, (int, float)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows)
