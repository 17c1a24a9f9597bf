"""CSV readers and writers bound to a contract.

* ``read_permissive`` keeps malformed rows: the original line goes to the
  corrupt-record column and the cells that parsed keep their values.
* ``read_failfast`` stops at the first malformed row (for files we wrote).
* Header names are checked against the schema (``enforceSchema=false``), so
  a renamed column fails the read instead of shifting data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.contract import Contract

# Microseconds are written always and read when present, for both timestamp types.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
DATE_FORMAT = "yyyy-MM-dd"


def contract_reader(reader, contract: Contract, timestamp_format: str = TIMESTAMP_FORMAT,
                    date_format: str = DATE_FORMAT, header: bool = True):
    """Options of a permissive read, for ``spark.read`` and ``spark.readStream`` alike."""
    return (reader.schema(contract.read_schema())
            .option("header", header)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", contract.corrupt_column)
            .option("nullValue", "")
            .option("timestampFormat", timestamp_format)
            .option("timestampNTZFormat", timestamp_format)
            .option("dateFormat", date_format))


def pin_verdict(raw: DataFrame, contract: Contract) -> DataFrame:
    """Make the corrupt-record column depend on every contract column.

    The parser converts only the cells a query uses, so a bad cell in an unused
    column would leave its row unmarked and the verdict would change with the
    projection.  Appending no characters of a hash of all columns keeps the
    value and makes every query of the verdict read all of them.
    """
    none = F.substring(F.xxhash64(*[F.col(c) for c in contract.names]).cast("string"), 1, 0)
    return raw.withColumn(contract.corrupt_column, F.concat(F.col(contract.corrupt_column), none))


def read_permissive(spark: SparkSession, path: str, contract: Contract,
                    timestamp_format: str = TIMESTAMP_FORMAT, date_format: str = DATE_FORMAT,
                    header: bool = True) -> DataFrame:
    """Contract columns plus the corrupt-record column; empty cells are NULL."""
    return pin_verdict(contract_reader(spark.read, contract, timestamp_format, date_format, header).csv(path), contract)


def read_failfast(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Files this library wrote.  Without explicit formats Spark's own parser reads
    dates and times to the microsecond, faster than by a pattern."""
    return (spark.read.schema(schema).option("header", header).option("enforceSchema", False)
            .option("mode", "FAILFAST").option("nullValue", "").csv(path))


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """``(file, column_name)`` from the header line of every file under ``path``.

    A file's header is the line at its start: the scan reads no cell, and per
    file one line survives the first task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"), "value")
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    return first.select("file", F.explode(F.split("header", ",")).alias("column_name"))


def header_mismatches(spark: SparkSession, path: str, expected: list[str]) -> DataFrame:
    """One row per file and column: is it in the file, is it expected."""
    found = file_headers(spark, path).groupBy("file").agg(F.collect_set("column_name").alias("found"))
    names = F.array(*[F.lit(n) for n in expected])
    return (found.select("file", "found", F.explode(F.array_union(names, F.col("found"))).alias("column_name"))
            .select("file", "column_name", F.array_contains("found", F.col("column_name")).alias("in_file"),
                    F.array_contains(names, F.col("column_name")).alias("in_contract")))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              timestamp_format: str = TIMESTAMP_FORMAT, date_format: str = DATE_FORMAT, partition_by: list[str] | None = None,
              replace_partitions_only: bool = False) -> str:
    """Headed, uncompressed CSV; NULL is written as an empty cell.

    With ``replace_partitions_only`` an overwrite replaces only the partition
    directories present in ``df`` (dynamic partition overwrite).
    """
    writer = (df.write.mode(mode).option("header", True).option("nullValue", "")
              .option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
              .option("dateFormat", date_format))
    if replace_partitions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return path
