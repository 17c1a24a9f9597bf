"""Write the same rows as CSV and as partitioned Parquet, then prove they agree.

Parity is checked on names and types, on row counts, and on the result of
one query run over both copies (a multiset difference, computed by one
aggregation on the executors, must be empty).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.checks import check_rows, multiset_diff
from sluice.sources.csv import read_failfast, write_csv


def write_two_formats(df: DataFrame, csv_path: str, parquet_path: str,
                      partition_by: Sequence[str] = ()) -> int:
    """Parquet (snappy, partitioned) first, then CSV from the written Parquet.

    The input plan runs once; its row count is observed on the Parquet write.
    Returns that count.
    """
    obs = Observation("formats")
    rows = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by:  # files follow the data, not tasks x partitions
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(parquet_path)
    written = df.sparkSession.read.schema(df.schema).parquet(parquet_path).select(*df.columns)
    write_csv(written, csv_path)
    return obs.get["rows"]


def read_formats(spark: SparkSession, csv_path: str, parquet_path: str,
                 schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """CSV read fail-fast with the schema; Parquet read with partition discovery."""
    return read_failfast(spark, csv_path, schema), spark.read.parquet(parquet_path)


def schema_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per column name: type in each frame and whether they agree (order ignored)."""
    ta = {f.name: f.dataType.simpleString() for f in a.schema.fields}
    tb = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    rows = [(n, ta.get(n), tb.get(n), ta.get(n) == tb.get(n)) for n in sorted(set(ta) | set(tb))]
    from sluice.operators.dimension import local_rows
    return local_rows(a.sparkSession, rows, "column_name string, csv_type string, parquet_type string, same boolean")


def count_checks(expected_rows: int, frames: dict[str, DataFrame]) -> DataFrame:
    """One check row per frame: ``expected_rows`` against the frame's count."""
    counts = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counts = c if counts is None else counts.unionByName(c)
    wide = counts.agg(*[F.sum(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in frames])
    return check_rows(wide, [(f"{n}_rows", str(int(expected_rows)), f"`{n}`") for n in frames])


def result_parity(query: Callable[[DataFrame], DataFrame], a: DataFrame, b: DataFrame,
                  names: tuple[str, str] = ("csv", "parquet")) -> DataFrame:
    """Rows of ``query(a)`` missing from ``query(b)`` and the reverse; both must be 0."""
    diff = multiset_diff(query(a), query(b))
    counts = diff.agg(F.sum(F.when(F.col("multiplicity_diff") > 0, F.col("multiplicity_diff"))).alias("ab"),
                      F.sum(F.when(F.col("multiplicity_diff") < 0, -F.col("multiplicity_diff"))).alias("ba"))
    return check_rows(counts, [
        (f"{names[0]}_minus_{names[1]}", "0", "coalesce(ab, 0)"),
        (f"{names[1]}_minus_{names[0]}", "0", "coalesce(ba, 0)"),
    ])
