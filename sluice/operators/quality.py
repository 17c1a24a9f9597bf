"""Quality gate: label, split, profile and reconcile rows against a contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.contract import Contract
from sluice.functions.rules import reject_reason, rule_sql
from sluice.functions.sqltext import ident, text
from sluice.functions.time import half_open
from sluice.operators.checks import check_rows

REASON = "reject_reason"


def label(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``reject_reason``: every failing rule's message, ``''`` when accepted."""
    return df.withColumn(REASON, reject_reason(contract, set(df.columns)))


def accepted(labelled: DataFrame, contract: Contract) -> DataFrame:
    drop = [REASON] + ([contract.corrupt_column] if contract.corrupt_column in labelled.columns else [])
    return labelled.where(F.col(REASON) == "").drop(*drop)


def rejected(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col(REASON) != "")


def reject_histogram(labelled: DataFrame) -> DataFrame:
    """Rejected rows per full reason text (a combination is its own group)."""
    return (rejected(labelled).groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), REASON))


def rule_hits(df: DataFrame, contract: Contract, rule_prefix: str, keep: Sequence[str]) -> DataFrame:
    """Rows failing the contract rules whose id starts with ``rule_prefix``.

    Output: ``keep`` columns plus ``rule`` (the message).  One row per failing
    (row, rule) pair, produced by one scan with ``explode`` over the hit list.
    """
    rules = [(rid, cond, msg) for rid, cond, msg in rule_sql(contract, set(df.columns))
             if rid.startswith(rule_prefix)]
    if not rules:
        raise ValueError(f"contract has no rule starting with {rule_prefix!r}")
    hits = ", ".join(f"CASE WHEN {cond} THEN {text(msg)} END" for _, cond, msg in rules)
    return (df.select(*keep, F.expr(f"filter(array({hits}), x -> x IS NOT NULL) AS _hits"))
            .where(F.size("_hits") > 0)
            .select(*keep, F.explode("_hits").alias("rule")))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and share per column, from one aggregate over all columns.

    Output rows ``(column_name, nulls, share)``; share is 0 for an empty input.
    The one-row aggregate is unpivoted with ``stack``.
    """
    columns = list(columns or df.columns)
    counts = df.agg(F.expr("count(1) AS _rows"),
                    *[F.expr(f"CAST(count_if({ident(c)} IS NULL) AS BIGINT) AS _n{i}")
                      for i, c in enumerate(columns)])
    pairs = ", ".join(f"{text(c)}, _n{i}" for i, c in enumerate(columns))
    return counts.selectExpr(
        f"stack({len(columns)}, {pairs}) AS (column_name, nulls)", "_rows").selectExpr(
        "column_name", "nulls",
        "round(CASE WHEN _rows > 0 THEN nulls / _rows ELSE 0.0D END, 6) AS share")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their count (``HAVING count(*) > 1``)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("duplicates"))
            .where(F.col("duplicates") > 1))


def entity_coverage(df: DataFrame, group: Sequence[str], ts: str, measure: str,
                    digits: int = 1) -> DataFrame:
    """Per entity: rows, first and last time, rounded min and max of the measure."""
    t, m = ident(ts), ident(measure)
    return (df.groupBy(*group)
            .agg(F.expr("count(1) AS observations"),
                 F.expr(f"min({t}) AS first_observation"),
                 F.expr(f"max({t}) AS last_observation"),
                 F.expr(f"round(min({m}), {int(digits)}) AS min_value"),
                 F.expr(f"round(max({m}), {int(digits)}) AS max_value"))
            .orderBy(*group))


def completeness(df: DataFrame, entity: str, ts: str, start: str, end: str,
                 roster: DataFrame | None = None) -> DataFrame:
    """Per entity: hourly slots expected in ``[start, end)``, slots seen, slots missing.

    ``roster`` lists the entities to expect (column ``entity``); without it
    they are all entities of the table, also those without a row in the period.
    """
    # whole hours in the period; constant-folded by Catalyst
    expected = (f"CAST(floor((unix_timestamp(CAST({text(end)} AS TIMESTAMP)) - "
                f"unix_timestamp(CAST({text(start)} AS TIMESTAMP))) / 3600) AS BIGINT)")
    hour = F.date_trunc("hour", F.col(ts))
    if roster is None:  # one scan: entities of all rows, hours of the period's rows
        inside = half_open(df, ts, start, end)
        seen = (df.where(F.col(entity).isNotNull()).groupBy(entity)
                .agg(F.count_distinct(F.when(inside, hour)).alias("actual")))
    else:
        found = df.where(half_open(df, ts, start, end)).groupBy(entity).agg(F.count_distinct(hour).alias("_seen"))
        expected_of = roster.select(entity).where(F.col(entity).isNotNull()).distinct()
        seen = expected_of.join(found, entity, "left").withColumn("actual", F.coalesce("_seen", F.lit(0)))
    return (seen.selectExpr(ident(entity), f"{expected} AS expected", "actual",
                            f"{expected} - actual AS missing")
            .orderBy(entity))


def row_counts(labelled: DataFrame, ts: str) -> DataFrame:
    """One row: raw rows, rows whose time parsed, accepted, rejected (one aggregate)."""
    r = ident(REASON)
    return labelled.agg(F.expr("count(1) AS raw"),
                        F.expr(f"count({ident(ts)}) AS ts_parsed"),
                        F.expr(f"count_if({r} = '') AS accepted"),
                        F.expr(f"count_if({r} <> '') AS rejected"))


def reconciliation(labelled: DataFrame) -> DataFrame:
    """raw not empty and raw = accepted + rejected, from one aggregate."""
    r = ident(REASON)
    counts = labelled.agg(F.expr("count(1) AS raw"), F.expr(f"count_if({r} = '') AS acc"),
                          F.expr(f"count_if({r} <> '') AS rej"))
    return check_rows(counts, [
        ("raw_not_empty", "1", "least(raw, 1)"),
        ("raw_equals_accepted_plus_rejected", "raw", "acc + rej"),
    ])


def gate_metrics(contract: Contract, present: set[str]) -> list:
    """Aggregates for ``DataFrame.observe``: rows, accepted, rejected, hits per rule.

    Observing these on the write that splits accepted from rejected rows gives
    the reconciliation numbers without another scan of the raw input.
    """
    r = ident(REASON)
    metrics = [F.expr("count(1) AS raw"), F.expr(f"count_if({r} = '') AS accepted"),
               F.expr(f"count_if({r} <> '') AS rejected")]
    for rid, cond, _ in rule_sql(contract, present):
        metrics.append(F.expr(f"count_if({cond}) AS {ident(f'hits[{rid}]')}"))
    return metrics
