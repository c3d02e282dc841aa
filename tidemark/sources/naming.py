"""How a mapped source field becomes SQL: one quoted name, or an expression left as written."""

from __future__ import annotations

import re

from tidemark.functions.clean import quoted

# Identifier quotes per kind of source.
QUOTES = {"mssql": ("[", "]"), "postgres": ('"', '"'), "greenplum": ('"', '"')}


def is_quoted(field: str) -> bool:
    return field[:1] + field[-1:] in ('""', "[]")


def is_identifier(field: str) -> bool:
    """Everything is a column name except calls, qualified names and integer constants."""
    return bool(field) and not re.search(r"[().]", field) and not re.fullmatch(r"[+-]?[0-9]+", field)


def field_sql(field: str, dialect: str = "spark") -> str:
    """SQL text of a source field in the given dialect."""
    field = field.strip()
    if dialect != "spark":
        left, right = QUOTES[dialect]
        return left + field + right if is_identifier(field) and not is_quoted(field) else field
    if is_quoted(field):
        names = re.split(r'"\."|\]\.\[', field[1:-1])
        return ".".join(quoted(name.replace('""', '"')) for name in names)
    return quoted(field) if is_identifier(field) else field


def alias_sql(name: str, dialect: str = "spark") -> str:
    if dialect == "spark":
        return quoted(name.strip())
    left, right = QUOTES[dialect]
    return name if is_quoted(name) else left + name.strip() + right
