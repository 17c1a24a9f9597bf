"""Text-producing column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.sqltext import ident, text


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_text(c) -> Column:
    """Number as CSV cell text: NULL is an empty cell, whole values lose ``.0``.

    ``1.0`` written into an integer CSV column makes the row malformed for a
    typed reader, so whole doubles are written as integers.
    """
    x = _col(c)
    whole = x == F.floor(x)  # in the column's own type: a wide decimal keeps its digits
    # 38 digits hold every decimal; a double beyond them keeps its own notation
    digits = x.try_cast("decimal(38,0)").cast("string")
    return F.coalesce(F.when(whole, F.coalesce(digits, x.cast("string"))).otherwise(x.cast("string")), F.lit(""))


def distinct_text_list(c: str, sep: str = ",") -> Column:
    """Aggregate: distinct values of column ``c`` as text, sorted as text, joined by ``sep``.

    Text order is deliberate (``19,9``).  The set holds distinct values only,
    so its size is bounded by the value domain, not by the group size.
    """
    return F.expr(f"array_join(array_sort(collect_set(CAST({ident(c)} AS STRING))), {text(sep)})")
