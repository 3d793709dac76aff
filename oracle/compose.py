"""Assemble one statement from named parts.

A part may use the names of other parts like tables; they become CTEs ahead of it.
"""

from __future__ import annotations

import re

_WORD = re.compile(r"\bx_[a-z0-9_]+\b")


def compose(parts: dict[str, str], sql: str) -> str:
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_WORD.findall(text)):
            if name in parts and name not in ordered:
                visit(parts[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{name} AS ({parts[name].strip()})" for name in ordered)
    return f"WITH {ctes}\n{sql.strip()}"
