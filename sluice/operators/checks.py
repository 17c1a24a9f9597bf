"""Whole-dataset assertions as small DataFrames.

Each check is a row ``(check, expected, actual, ok)``.  The rows are built on
the executors from one aggregate, so a check over a huge table costs one scan
and returns a handful of rows; ``assert_checks`` raises when any row fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ["check", "expected", "actual", "ok"]


class CheckFailed(ValueError):
    pass


def check_rows(one_row: DataFrame, checks: Sequence[tuple[str, Column | str, Column | str]]) -> DataFrame:
    """Turn a one-row aggregate into one check row per ``(name, expected, actual)``.

    ``expected`` and ``actual`` are Columns or SQL expressions over the
    one-row input; ``ok`` is ``expected = actual`` with NULL-safe equality.
    """
    if all(isinstance(e, str) and isinstance(a, str) for _, e, a in checks):
        from sluice.functions.sqltext import text
        rows = ", ".join(
            f"named_struct('check', {text(name)}, 'expected', CAST({e} AS BIGINT), "
            f"'actual', CAST({a} AS BIGINT), 'ok', CAST({e} AS BIGINT) <=> CAST({a} AS BIGINT))"
            for name, e, a in checks)
        return one_row.selectExpr(f"inline(array({rows}))")
    structs = [
        F.struct(
            F.lit(name).alias("check"),
            exp.cast("bigint").alias("expected"),
            act.cast("bigint").alias("actual"),
            exp.cast("bigint").eqNullSafe(act.cast("bigint")).alias("ok"),
        )
        for name, exp, act in checks
    ]
    return one_row.select(F.inline(F.array(*structs)))


def assert_checks(checks: DataFrame) -> DataFrame:
    """Raise :class:`CheckFailed` listing the failing checks; return the frame otherwise."""
    failed = checks.where(~F.col("ok")).collect()
    if failed:
        detail = ", ".join(f"{r['check']}: expected {r['expected']}, got {r['actual']}" for r in failed)
        raise CheckFailed(detail)
    return checks


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs between two frames, with the difference.

    One aggregation over the union, grouped by every column with a signed
    count: partial aggregation collapses duplicates before the shuffle, and
    no row is replicated (unlike ``exceptAll``).  NULLs group together.
    """
    cols = left.columns
    tagged = (left.select(*cols, F.lit(1).alias("_side"))
              .unionByName(right.select(*cols, F.lit(-1).alias("_side"))))
    return (tagged.groupBy(*cols).agg(F.sum("_side").cast("bigint").alias("multiplicity_diff"))
            .where(F.col("multiplicity_diff") != 0))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent content fingerprint: rows and the exact sum of row hashes.

    Two frames with equal multisets of rows have equal fingerprints; one
    partially aggregated scan per side, no rows shuffled.  Hashes are summed
    as decimals so the sum cannot overflow.
    """
    cols = [F.col(c) for c in sorted(df.columns)]
    # the hash skips NULLs: their places are hashed too
    h = F.xxhash64(*cols, F.concat(*[F.isnull(c).cast("int").cast("string") for c in cols])).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).alias("hash_sum"))


def fingerprint_checks(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """Check rows comparing the row counts and hash sums of two frames (by column name).

    The two one-row fingerprints are stacked and folded by one aggregate (no join).
    """
    cols = sorted(a.columns)
    both = (fingerprint(a.select(*cols)).withColumn("_side", F.lit("a"))
            .unionByName(fingerprint(b.select(*cols)).withColumn("_side", F.lit("b"))))
    side = lambda s, c: F.max(F.when(F.col("_side") == s, F.col(c)))
    folded = both.agg(side("a", "rows").alias("ra"), side("b", "rows").alias("rb"),
                      side("a", "hash_sum").alias("ha"), side("b", "hash_sum").alias("hb"))
    same = F.when(F.col("ha").eqNullSafe(F.col("hb")), F.lit(1)).otherwise(F.lit(0))
    return check_rows(folded, [(f"{names[1]}_rows_equal_{names[0]}", F.col("ra"), F.col("rb")),
                               (f"{names[1]}_content_equals_{names[0]}", F.lit(1), same)])
