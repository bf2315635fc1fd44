"""Registry of named DuckDB CTE blocks with dependencies."""

from __future__ import annotations

import re

CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def define(name: str, body: str) -> None:
    """Register a block; its dependencies are the earlier blocks it names."""
    CTE[name] = (body.strip(), tuple(refs(body)))


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTE[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def refs(sql: str) -> list[str]:
    """CTE names referenced as identifiers in ``sql``."""
    return [n for n in CTE if re.search(r"\b" + re.escape(n) + r"\b", sql)]


def sql_for(final: str, deps: tuple[str, ...] | list[str] | None = None) -> str:
    names = list(deps) if deps is not None else refs(final)
    ordered = _order(names)
    if not ordered:
        return final.strip()
    blocks = ",\n".join(f"{n} AS (\n{CTE[n][0]}\n)" for n in ordered)
    body = final.strip()
    if re.match(r"(?i)^with\s", body):
        return f"WITH {blocks},\n{body[5:]}"
    return f"WITH {blocks}\n{body}"
