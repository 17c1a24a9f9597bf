"""Loads through the catalog: managed tables created as select, partitioned and bucketed.

The first batch creates the table (schema, partitions and buckets come from the
query), later ones are ``INSERT INTO``.  Writers sort what they write; each gets
about ``WRITER_ROWS`` rows, so a larger batch has more writers and their sorts
need not spill.  The catalog knows how the files are
bucketed, so grouping by the bucket key, or joining two tables bucketed alike,
needs no exchange.  A dimension that is filtered on its own columns prunes the
table's partitions at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.sqltext import ident, text
from sluice.plans.batches import TRANSFORMS

#: Rows that one writer sorts.
WRITER_ROWS = 1 << 20


@dataclass(frozen=True)
class ManagedTable:
    """``database.name``, bucketed by ``key`` and, with a time column, partitioned by its month or day."""

    database: str
    name: str
    key: str
    buckets: int = 8
    ts: str | None = None
    transform: str = "month"

    @property
    def full_name(self) -> str:
        return f"{ident(self.database)}.{ident(self.name)}"

    @property
    def partition(self) -> str | None:
        return f"{self.transform}_idx" if self.ts else None

    def rows(self, batch: DataFrame) -> DataFrame:
        return batch.withColumn(self.partition, TRANSFORMS[self.transform](self.ts)) if self.ts else batch


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident(database)} LOCATION {text(location)}")


def deal(rows: DataFrame, table: ManagedTable) -> DataFrame:
    """The rows dealt to writers: a bucket (of a partition) goes to one, or to several where it exceeds ``WRITER_ROWS``."""
    parts = [table.partition] if table.partition else []
    n, groups = rows.agg(F.count(F.lit(1)), F.count_distinct(*parts) if parts else F.lit(1)).first()
    key = F.col(ident(table.key))
    slices = -(-n // (WRITER_ROWS * table.buckets * max(1, groups))) or 1
    return rows.repartition(max(table.buckets, -(-n // WRITER_ROWS)), F.pmod(F.hash(key), F.lit(table.buckets)), *parts,
                            F.pmod(F.xxhash64(key), F.lit(slices)))


def create_as_select(batch: DataFrame, table: ManagedTable) -> DataFrame:
    """The table made from its first batch; an older table of the name is replaced."""
    spark = batch.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table.full_name}")
    rows = table.rows(batch)
    writer = deal(rows, table).write.format("parquet").bucketBy(table.buckets, table.key).sortBy(table.key)
    if table.partition:
        writer = writer.partitionBy(table.partition)
    writer.saveAsTable(f"{table.database}.{table.name}")
    return spark.table(table.full_name)


def insert_into(batch: DataFrame, table: ManagedTable) -> DataFrame:
    """A later batch; columns are matched by name, as the catalog has them."""
    spark = batch.sparkSession
    into = spark.table(table.full_name)
    view = f"{table.name}__batch"
    deal(table.rows(batch), table).createOrReplaceTempView(view)
    columns = ", ".join(ident(c) for c in into.columns)
    try:
        spark.sql(f"INSERT INTO {table.full_name} SELECT {columns} FROM {ident(view)}")
    finally:
        spark.catalog.dropTempView(view)
    return spark.table(table.full_name)


def pruned_by(table: DataFrame, partition: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows of the partitions that a filtered dimension names.

    The join is on the partition column itself, so Spark runs the dimension's
    filter first and lists only the partitions it left.
    """
    keys = dim.select(F.col(dim_key).alias(partition))
    return table.join(keys, partition, "left_semi")


__all__ = ["ManagedTable", "create_database", "create_as_select", "insert_into", "pruned_by"]
