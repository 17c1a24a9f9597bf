"""Quoting for SQL expression text handed to ``F.expr`` / ``selectExpr``.

Building a wide expression (a dozen rules, a CASE over many values) as SQL
text lets the JVM parse it in one call instead of one Python-to-JVM round
trip per function node.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value) -> str:
    """A numeric literal: integers as written, other numbers as exact doubles."""
    if isinstance(value, bool):
        raise TypeError("boolean bound")
    if isinstance(value, int):
        return str(value)
    return f"CAST({text(repr(float(value)))} AS DOUBLE)"
