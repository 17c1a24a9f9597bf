"""Periodic profiles: hourly, seasonal daily cycle, local-time cycle, summaries.

Every profile is a chain of ``groupBy().agg()`` whose first level collapses
the fact rows with partial (map-side) aggregation, so a hot entity is reduced
to one buffer per task before the shuffle and later levels work on a result
of size entities x seasons x 24.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.extremes import pos_of_max, pos_of_min
from sluice.functions.sqltext import ident
from sluice.functions.text import distinct_text_list
from sluice.functions.time import half_open

MEAN = "_mean"


def _round(sql: str, digits: int | None) -> str:
    """Rounded through an exact decimal, so that a half does not hang on the last bit of a double."""
    return sql if digits is None else f"CAST(round(CAST({sql} AS DECIMAL(18,6)), {int(digits)}) AS DOUBLE)"


def hourly_profile(df: DataFrame, entity: str, ts: str, measure: str, start: str | None,
                   end: str | None, digits: int = 3, mean_name: str = "mean_value") -> DataFrame:
    """Mean and count per entity and UTC hour over ``[start, end)``."""
    return (df.where(half_open(df, ts, start, end))
            .groupBy(F.col(entity), F.expr(f"CAST(hour({ident(ts)}) AS INT) AS hour_utc"))
            .agg(F.expr(f"{_round(f'avg({ident(measure)})', digits)} AS {ident(mean_name)}"),
                 F.expr("count(1) AS observations"))
            .orderBy(entity, "hour_utc"))


def cycle_extremes(level1: DataFrame, group: Sequence[str], pos: str, digits: int | None = 2) -> DataFrame:
    """Second level: min, max, amplitude of the per-position means, and where they occur.

    The positions of the extremes break ties on the earliest position
    (``min_by``/``max_by`` ordered by ``(mean, pos)`` and ``(mean, -pos)``).
    """
    m = ident(MEAN)
    return level1.groupBy(*group).agg(
        F.expr(f"{_round(f'min({m})', digits)} AS min_mean"),
        F.expr(f"{_round(f'max({m})', digits)} AS max_mean"),
        F.expr(f"{_round(f'max({m}) - min({m})', digits)} AS amplitude"),
        pos_of_min(pos, MEAN).alias(f"min_{pos}"),
        pos_of_max(pos, MEAN).alias(f"max_{pos}"),
    )


def seasonal_profile(df: DataFrame, entity: str, measure: str, season: Column, position: Column,
                     where: Column | None = None, pos: str = "hour", digits: int = 2) -> DataFrame:
    """Daily-cycle profile: mean per (entity, season, position), then its extremes.

    ``season`` and ``position`` are expressions (month-based seasons and
    ``hour(ts)`` in the classic form); ``where`` filters rows first.
    """
    rows = df.where(where) if where is not None else df
    level1 = (rows.groupBy(F.col(entity), season.alias("season"), position.cast("int").alias(pos))
              .agg(F.avg(measure).alias(MEAN)))
    return (cycle_extremes(level1, [entity, "season"], pos, digits)
            .orderBy("season", F.desc("amplitude"), entity))


def value_at_extreme(df: DataFrame, entity: str, measure: str, position: Column,
                     pos: str = "hour") -> DataFrame:
    """Position of the lowest and highest mean per entity (earliest wins a tie)."""
    level1 = df.groupBy(F.col(entity), position.cast("int").alias(pos)).agg(F.avg(measure).alias(MEAN))
    return (level1.groupBy(entity)
            .agg(pos_of_min(pos, MEAN).alias(f"min_{pos}"), pos_of_max(pos, MEAN).alias(f"max_{pos}"))
            .orderBy(entity))


def distinct_positions(df: DataFrame, entity: str, position: Column, where: Column,
                       name: str = "hours") -> DataFrame:
    """Per entity, the distinct positions where ``where`` holds, as sorted text."""
    return (df.where(where).select(entity, position.cast("int").alias("_pos")).groupBy(entity)
            .agg(distinct_text_list("_pos").alias(name))
            .orderBy(entity))


def local_profile(fact: DataFrame, dim: DataFrame, key: str, district: str, offset: str, ts: str,
                  measure: str, season: Column, where: Column | None = None,
                  digits: int = 2) -> DataFrame:
    """Three-level local-time profile over fact JOIN dimension (inner).

    1. mean per (district, entity, season, local hour);
    2. per (district, entity, season): amplitude and the local hours of the extremes;
    3. per (district, season): entity count, mean/min/max amplitude, distinct
       extreme hours as text lists.

    The fact is first reduced to (entity, season, UTC hour) sums and counts;
    the join then touches entities x seasons x 24 rows instead of every fact
    row.  For a fixed entity the UTC to local hour map is one-to-one, so the
    groups are the same as joining first.  Level 2 is hashed on all of
    (district, entity, season) and level 3 aggregates partially before its
    shuffle, so a district holding most entities is still spread over tasks.
    """
    rows = fact.where(where) if where is not None else fact
    per_hour = (rows.groupBy(F.col(key), season.alias("season"),
                             F.expr(f"CAST(hour({ident(ts)}) AS INT) AS _utc_hour"))
                .agg(F.expr(f"sum({ident(measure)}) AS _sum"), F.expr(f"count({ident(measure)}) AS _n")))
    return local_cycles(per_hour, dim, key, district, offset, digits)


def local_cycles(per_hour: DataFrame, dim: DataFrame, key: str, district: str, offset: str, digits: int = 2) -> DataFrame:
    """The levels of ``local_profile`` above sums and counts per (key, season, UTC hour)."""
    joined = per_hour.join(dim.select(key, district, offset), key, "inner")
    level1 = joined.selectExpr(
        ident(district), ident(key), "season",
        f"CAST(pmod(_utc_hour + {ident(offset)}, 24) AS INT) AS hour_local",
        f"CASE WHEN _n > 0 THEN _sum / _n END AS {ident(MEAN)}")
    level2 = cycle_extremes(level1, [district, key, "season"], "hour_local", digits=None)
    return (level2.groupBy(district, "season")
            .agg(F.expr("count(1) AS entities"),
                 F.expr(f"{_round('avg(amplitude)', digits)} AS mean_amplitude"),
                 F.expr(f"{_round('min(amplitude)', digits)} AS min_amplitude"),
                 F.expr(f"{_round('max(amplitude)', digits)} AS max_amplitude"),
                 distinct_text_list("min_hour_local").alias("coldest_hours"),
                 distinct_text_list("max_hour_local").alias("warmest_hours"))
            .orderBy("season", F.desc("mean_amplitude"), district))


def season_pivot(profile: DataFrame, entity: str, seasons: Sequence[str], value: str = "amplitude",
                 sort_by: str | None = None) -> DataFrame:
    """Seasons as columns; sorted by ``sort_by`` (missing as 0, in the sort only) descending.

    The pivot values are given, so Spark does not run a distinct job to find them.
    """
    sort_by = sort_by or seasons[0]
    wide = profile.groupBy(entity).pivot("season", list(seasons)).agg(F.max(value))
    return wide.orderBy(F.coalesce(F.col(sort_by), F.lit(0.0)).desc(), entity)


def control_aggregate(df: DataFrame, entity: str, measure: str) -> DataFrame:
    """Order-independent fingerprint: rows, entities, exact decimal sum and mean."""
    dec = f"CAST({ident(measure)} AS DECIMAL(18,6))"
    return df.agg(F.expr("count(1) AS observations"),
                  F.expr(f"count(DISTINCT {ident(entity)}) AS entities"),
                  F.expr(f"CAST(sum({dec}) AS DECIMAL(38,6)) AS sum_value"),
                  F.expr(f"CAST(round(avg({dec}), 6) AS DOUBLE) AS mean_value"))


def table_summary(df: DataFrame, entity: str, ts: str) -> DataFrame:
    return df.agg(F.expr("count(1) AS observations"),
                  F.expr(f"count(DISTINCT {ident(entity)}) AS entities"),
                  F.expr(f"min({ident(ts)}) AS first_observation"),
                  F.expr(f"max({ident(ts)}) AS last_observation"))


def first_rows(df: DataFrame, order: Sequence[str], columns: Sequence[str], n: int = 10) -> DataFrame:
    """Top-k by key; planned as TakeOrderedAndProject (per-task top-k, then merge)."""
    return df.select(*columns).orderBy(*order).limit(n)


def filtered_aggregate(df: DataFrame, where: Column, measure: str) -> DataFrame:
    dec = f"CAST({ident(measure)} AS DECIMAL(18,6))"
    return df.where(where).agg(F.expr("count(1) AS rows"),
                               F.expr(f"CAST(round(avg({dec}), 6) AS DOUBLE) AS mean_value"))


__all__ = [
    "hourly_profile", "seasonal_profile", "value_at_extreme", "distinct_positions", "local_profile",
    "season_pivot", "control_aggregate", "table_summary", "first_rows", "filtered_aggregate",
    "cycle_extremes",
]
