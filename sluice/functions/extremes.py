"""Value-at-extreme aggregates with deterministic ties.

``min_by(pos, m)`` returns whichever tied row the aggregation met last, which
depends on partitioning.  Ordering by ``(m, pos)`` makes the earliest position
win a tie for both the minimum and the maximum.  Each helper is one SQL
expression, parsed by the JVM in a single call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.sqltext import ident


def pos_of_min(pos: str, measure: str) -> Column:
    p, m = ident(pos), ident(measure)
    return F.expr(f"min_by({p}, struct({m}, {p}))")


def pos_of_max(pos: str, measure: str) -> Column:
    p, m = ident(pos), ident(measure)
    return F.expr(f"max_by({p}, struct({m}, -{p}))")
