"""Access to the Parquet tables of a data directory.

Each table is registered once per session as a temp view, so its schema
(from the Parquet footers) and its file listing are resolved once, as with
catalog tables; later reads reuse the resolved relation.  The input tables
are read-only; call ``refresh`` if files under a path change.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _view_name(path: str) -> str:
    return "sluice_t_" + hashlib.sha1(path.encode()).hexdigest()[:16]


# Resolved table frames per (session, path).  A DataFrame is an immutable plan,
# so handing out the same object again is safe; it is executed anew each time.
_RESOLVED: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    path = f"{data_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _RESOLVED.get(key)
    if df is None or df.sparkSession is not spark:
        view = _view_name(path)
        if not spark.catalog.tableExists(view):
            spark.read.parquet(path).createOrReplaceTempView(view)
        df = _RESOLVED[key] = spark.table(view)
    return df


def table_view(spark: SparkSession, data_dir: str, name: str) -> str:
    """Name of the session view holding the table, for use in SQL text."""
    table(spark, data_dir, name)
    return _view_name(f"{data_dir.rstrip('/')}/{name}.parquet")


def refresh(spark: SparkSession, data_dir: str, name: str) -> None:
    path = f"{data_dir.rstrip('/')}/{name}.parquet"
    _RESOLVED.pop((id(spark), path), None)
    spark.catalog.dropTempView(_view_name(path))


def path_relation(spark: SparkSession, path: str, fmt: str = "parquet") -> str:
    """A file path usable as a relation in SQL text: ``parquet.`/path```."""
    if "`" in path:
        raise ValueError("path must not contain backticks")
    return f"{fmt}.`{path}`"


def register_catalog_table(spark: SparkSession, database: str, name: str, path: str,
                           partitioned: bool = True, database_location: str | None = None) -> DataFrame:
    """Expose a loaded Parquet dataset as ``database.name`` in the session catalog.

    The namespace is created if missing (at ``database_location`` when given,
    else in the configured warehouse); the table points at the existing files
    (no copy), and its partitions are recovered from the directories.
    """
    where = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
    if partitioned:
        spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")
    return spark.table(f"{database}.{name}")
