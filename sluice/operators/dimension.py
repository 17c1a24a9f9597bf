"""Facts against partially covering dimensions: rollups, key checks, join audits.

No dimension is broadcast by hint: Catalyst broadcasts a side only when its
size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-plans from the sizes measured at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.sqltext import ident, number, text

UNMATCHED = "Unmatched"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return number(value)
    if isinstance(value, dict):
        if not value:
            return "map()"
        return "map(" + ", ".join(f"{_literal(k)}, {_literal(v)}" for k, v in value.items()) + ")"
    return text(str(value))


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Literal rows as a SQL ``VALUES`` relation (str, int, float, bool, None, dict values).

    It is planned as a local relation with exact size statistics: one
    partition and no RDD behind it.
    """
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], st)
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    cols = ", ".join(f"CAST(col{i + 1} AS {f.dataType.simpleString()}) AS {ident(f.name)}"
                     for i, f in enumerate(st.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values}")


def inline_dimension(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small dimension given as literal rows (``VALUES`` in SQL).

    Joins against it broadcast it (its size statistics are exact), and its
    size is bounded by the literal list itself.
    """
    return local_rows(spark, rows, schema)


def register_dimension(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a temp view holding the dimension and return it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def dimension_key_check(dim: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Dimension keys that occur more than once; must be empty before joining."""
    key = [key] if isinstance(key, str) else list(key)
    return (dim.groupBy(*key).agg(F.count(F.lit(1)).alias("key_count"))
            .where(F.col("key_count") > 1))


def measure_partials(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Per-key partial stats: rows, values, exact decimal sum, min, max of the measure.

    Pre-aggregating a fact before it meets a dimension shrinks the join input
    from one row per fact to one row per key; a hot key becomes one row.
    """
    m = ident(measure)
    return df.groupBy(key).agg(
        F.expr("count(1) AS _rows"),
        F.expr(f"count({m}) AS _values"),
        F.expr(f"CAST(sum(CAST({m} AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS _sum"),
        F.expr(f"min({m}) AS _min"),
        F.expr(f"max({m}) AS _max"))


def dimension_rollup(partials: DataFrame, dim: DataFrame, key: str, dim_key: str, group: str,
                     unmatched: str = UNMATCHED, digits: int = 2) -> DataFrame:
    """Left join per-key partials to the dimension, roll up by the coalesced group.

    Output per group: distinct fact keys, rows, decimal mean, rounded min and
    max.  Facts without a dimension row form the ``unmatched`` group.
    ``partials`` may hold several rows per key (partials of a finer key with
    ``key`` attached); they are summed here.
    """
    d = dim.select(F.col(dim_key).alias("_dk"), F.col(group).alias("_grp"))
    joined = partials.join(d, partials[key] == d["_dk"], "left")
    return (joined.groupBy(F.expr(f"coalesce(_grp, {text(unmatched)}) AS {ident(group)}"))
            .agg(F.expr(f"count(DISTINCT {ident(key)}) AS entities"),
                 F.expr("sum(_rows) AS observations"),
                 F.expr(f"CAST(round(sum(_sum) / sum(_values), {int(digits)}) AS DOUBLE) AS mean_value"),
                 F.expr("round(min(_min), 1) AS min_value"),
                 F.expr("round(max(_max), 1) AS max_value"))
            .orderBy(F.desc("observations"), group))


def join_audit(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows before and after a left join, unmatched rows and unmatched keys, in one row.

    Both sides are first reduced to counts per key (fact rows per key, matches
    per key), so the join sees one row per key: fan-out is counted
    (``after_join`` = sum of rows x matches) without being materialised, a hot
    fact key is a single row, and no fact row is shuffled.
    """
    rows = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    matches = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_matches"))
    j = rows.join(matches, key, "left")
    miss = F.col("_matches").isNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")  # noqa: E731 - 0 for no facts
    return j.agg(total(F.col("_rows")).alias("before_join"),
                 total(F.col("_rows") * F.coalesce(F.col("_matches"), F.lit(1))).alias("after_join"),
                 total(F.when(miss, F.col("_rows"))).alias("unmatched_rows"),
                 F.count_if(miss & F.col(key).isNotNull()).alias("unmatched_keys"))
