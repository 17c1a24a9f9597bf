"""Raw zones laid out as ``root/<column>=<value>/...``: pick the latest load.

The latest value is found by listing one level of folders; the data read then
opens only that partition's folder.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import child_names, path_exists
from sluice.sources.csv import write_csv


class NoIngestion(LookupError):
    pass


def latest_value(spark: SparkSession, root: str, column: str = "ingestion_date") -> str:
    """Greatest ``column=`` value under ``root``; raises :class:`NoIngestion` when none."""
    prefix = f"{column}="
    names = child_names(spark, root) if path_exists(spark, root) else []
    values = [unquote(n.removeprefix(prefix)) for n in names if n.startswith(prefix)]
    if not values:
        raise NoIngestion(f"no {column}=* directories under {root}")
    return max(values)


def read_latest(spark: SparkSession, root: str, read: Callable[[str], DataFrame],
                column: str = "ingestion_date", value: str | None = None) -> DataFrame:
    """Read the latest (or given) partition of ``root``, with its value as a column.

    ``read`` receives the partition's own folder, so no other date is listed.
    """
    chosen = value or latest_value(spark, root, column)
    folder = f"{root.rstrip('/')}/{column}={quote(chosen)}"
    return read(folder).withColumn(column, F.lit(chosen))


def land(df: DataFrame, root: str, value: str, column: str = "ingestion_date") -> str:
    """Write one load as CSV under ``root/<column>=<value>``.

    Only that partition is replaced (dynamic partition overwrite): landing the
    same load again leaves the raw zone's row count unchanged, and other
    ingestion dates are untouched.
    """
    write_csv(df.withColumn(column, F.lit(value)), root, partition_by=[column], replace_partitions_only=True)
    return f"{root.rstrip('/')}/{column}={value}"


def ingestion_date_from_manifest(spark: SparkSession, manifest_path: str,
                                 field: str = "downloaded_at_utc") -> str:
    """The load's ingestion date: the date part of the manifest's download time.

    Taking it from the manifest (not the clock) makes re-landing the same
    download replace the same ``ingestion_date=`` partition.
    """
    row = (spark.read.option("multiLine", True).json(manifest_path)
           .select(F.substring(F.col(field), 1, 10).alias("d")).first())
    if row is None or not row["d"]:
        raise NoIngestion(f"manifest {manifest_path} has no {field}")
    return row["d"]
