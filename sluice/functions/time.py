"""Time expressions: partition indexes, seasons, local hours, typed literals.

All are plain Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.sqltext import ident, text


#: Years that ``month_set_ranges`` spells out at most.
MOST_YEARS = 64


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: str, dtype: T.DataType | None = None) -> Column:
    """A literal of the column's own timestamp type.

    Casting the literal (not the column) keeps the comparison a plain
    ``ts >= literal`` predicate, which Parquet can push down.
    """
    kind = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    return F.lit(value).cast(kind)


def half_open(df: DataFrame | None, ts: str, start: str | None, end: str | None) -> Column:
    """``start <= ts < end``; either end may be open.

    The bounds are string literals: Spark coerces them to the column's own
    type (timestamp or timestamp_ntz), so the predicate stays a plain
    comparison that Parquet can push down, and no schema lookup is needed.
    """
    parts = []
    if start is not None:
        parts.append(f"{ident(ts)} >= {text(start)}")
    if end is not None:
        parts.append(f"{ident(ts)} < {text(end)}")
    return F.expr(" AND ".join(parts) or "true")


def month_index(ts) -> Column:
    """Months since 1970-01, the value of a ``months(ts)`` partition transform."""
    c = _col(ts)
    return ((F.year(c) - 1970) * 12 + F.month(c) - 1).cast("int")


def day_index(ts) -> Column:
    """Days since 1970-01-01, the value of a ``days(ts)`` partition transform."""
    return F.datediff(F.to_date(_col(ts)), F.lit("1970-01-01").cast("date")).cast("int")


def month_range(df: DataFrame, ts: str, month_col: str, start: str | None,
                end: str | None) -> Column:
    """Range filter on ``ts`` plus the implied range on its month partition column.

    Spark does not derive partition filters from a predicate on the source
    timestamp of a derived partition column; adding ``month_idx BETWEEN`` lets a
    table partitioned by month prune directories.
    """
    cond = half_open(df, ts, start, end)
    if start is not None:
        cond = cond & (F.col(month_col) >= month_index(F.lit(start).cast("timestamp")))
    if end is not None:
        # the month holding the instant just before ``end``
        last = F.lit(end).cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND")
        cond = cond & (F.col(month_col) <= month_index(last))
    return cond


def _months(ms) -> str:
    return ", ".join(str(int(m)) for m in ms)


def season_of_month(ts: str, seasons: Mapping[str, Sequence[int]]) -> Column:
    """CASE over month numbers; months in no season give NULL."""
    branches = " ".join(f"WHEN month({ident(ts)}) IN ({_months(ms)}) THEN {text(label)}"
                        for label, ms in seasons.items())
    return F.expr(f"CASE {branches} END")


def months_in(ts: str, seasons: Mapping[str, Sequence[int]]) -> Column:
    """Filter keeping only months that belong to some season."""
    months = sorted({m for ms in seasons.values() for m in ms})
    return F.expr(f"month({ident(ts)}) IN ({_months(months)})")


def half_of_month(ts: str, split_day: int = 15, labels: tuple[str, str] = ("first", "second")) -> Column:
    """Two-way season by day of month, for data that spans a single month."""
    return F.expr(f"CASE WHEN dayofmonth({ident(ts)}) <= {int(split_day)} THEN {text(labels[0])} "
                  f"ELSE {text(labels[1])} END")


def local_hour(ts, offset_hours) -> Column:
    """``(hour + offset) mod 24``; ``pmod`` also holds for negative offsets."""
    return F.pmod(F.hour(_col(ts)) + _col(offset_hours), F.lit(24)).cast("int")


def month_set_ranges(ts, months, first_year: int, last_year: int) -> Column:
    """``month(ts) IN months`` for years in ``[first_year, last_year]``, as time ranges.

    ``month()`` hides the column from Parquet pushdown; the same set written
    as an OR of half-open ranges on ``ts`` (consecutive months merged) can
    skip row groups by their min/max statistics.  Use it next to the exact
    ``months_in`` filter, with the years the data may hold.  Over more than
    ``MOST_YEARS`` years the ranges say nothing (always true), so that a stray year
    does not make an endless expression.
    """
    if last_year - first_year >= MOST_YEARS:
        return F.lit(True)
    c = _col(ts)
    months = sorted(set(months))
    runs, start = [], None
    for m in range(1, 14):
        inside = m in months
        if inside and start is None:
            start = m
        if not inside and start is not None:
            runs.append((start, m))
            start = None
    cond = F.lit(False)
    for y in range(first_year, last_year + 1):
        for lo, hi in runs:
            end = f"{y + 1}-01-01" if hi == 13 else f"{y}-{hi:02d}-01"
            cond = cond | ((c >= F.lit(f"{y}-{lo:02d}-01")) & (c < F.lit(end)))
    return cond
