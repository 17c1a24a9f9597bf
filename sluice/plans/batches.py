"""Load a table in disjoint batches with a load ledger and partition inventory.

The table is a Parquet dataset partitioned by a month (or day) index derived
from the time column: the value a ``months(ts)`` / ``days(ts)`` partition
transform would give.  Each load:

1. measures its batch first (rows, rows without a time, partitions; one scan of
   the time column) and refuses rows without a time, which have no partition;
2. writes clustered by partition, so the number of files follows the data and
   not tasks x partitions (AQE splits a partition that is large);
3. only then appends one ledger row, so a failed load leaves no ledger entry.

``overwrite`` writes beside the table and switches, so a failed job leaves the
old table; ``append`` adds rows; ``replace_partitions`` replaces the partitions
the batch holds.  ``two_batch_load`` writes nothing unless both batches hold
rows and together cover the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.time import day_index, half_open, month_index, month_range, ts_literal
from sluice.operators.checks import CheckFailed, assert_checks, check_rows
from sluice.operators.dimension import local_rows
from sluice.session import child_names, path_exists, switch_into_place

MONTH = "month_idx"
TRANSFORMS = {"month": month_index, "day": day_index}
LEDGER_SCHEMA = ("load_no int, parent_load_no int, operation string, added_records bigint, added_files bigint, "
                 "partitions bigint, total_records bigint, committed_at timestamp")
OPERATIONS = ("overwrite", "append", "replace_partitions")


@dataclass(frozen=True)
class PartitionedTable:
    path: str
    ts: str
    transform: str = "month"

    @property
    def partition(self) -> str:
        return f"{self.transform}_idx"

    @property
    def ledger_path(self) -> str:
        return self.path.rstrip("/") + "__ledger"


def split_batches(df: DataFrame, ts: str, boundary: str) -> tuple[DataFrame, DataFrame]:
    b = ts_literal(boundary, df.schema[ts].dataType)
    return df.where(F.col(ts) < b), df.where(F.col(ts) >= b)


def batch_coverage(df: DataFrame, ts: str, boundary: str) -> DataFrame:
    """Both batches non-empty, and together exactly the input (NULL times would be lost)."""
    b = ts_literal(boundary, df.schema[ts].dataType)
    return coverage_checks(df.agg(F.count(F.lit(1)).alias("total"),
                                  F.count_if(F.col(ts) < b).alias("first"),
                                  F.count_if(F.col(ts) >= b).alias("second")))


def coverage_checks(counts: DataFrame) -> DataFrame:
    return check_rows(counts, [
        ("first_batch_not_empty", "1", "least(`first`, 1)"),
        ("second_batch_not_empty", "1", "least(`second`, 1)"),
        ("batches_cover_input", "total", "`first` + `second`"),
    ])


def _check_boundary(spark: SparkSession, boundary: str, transform: str) -> None:
    b = F.lit(boundary).cast("timestamp")
    row = spark.range(1).select((F.date_trunc(transform, b) == b).alias("aligned")).first()
    if not row["aligned"]:
        raise ValueError(f"batch boundary {boundary} is not the start of a {transform} partition")


def ledger(spark: SparkSession, table: PartitionedTable) -> DataFrame:
    """One row per load; ``total_records`` is what the table held after it."""
    if path_exists(spark, table.ledger_path):
        return spark.read.schema(LEDGER_SCHEMA).parquet(table.ledger_path).orderBy("load_no")
    return spark.createDataFrame([], LEDGER_SCHEMA)  # no load yet


def _files(spark: SparkSession, table: PartitionedTable, values: list[int]) -> int:
    """Data files in the given partitions: one listing call for each, no scan."""
    folders = [f"{table.path.rstrip('/')}/{table.partition}={v}" for v in values]
    return sum(not name.startswith(("_", ".")) for f in folders if path_exists(spark, f) for name in child_names(spark, f))


def _rows_in(spark: SparkSession, table: PartitionedTable, values: list[int]) -> int:
    """Rows of the given partitions, from their files' footers."""
    if not values or not path_exists(spark, table.path):
        return 0
    return spark.read.parquet(table.path).where(F.col(table.partition).cast("int").isin(values)).count()


def load_batch(batch: DataFrame, table: PartitionedTable, operation: str) -> dict:
    """Write one batch into the table, then record it in the ledger.

    ``added_files`` counts the files this load left in the table beyond those it
    kept; ``partitions`` those the batch touches.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation {operation}")
    spark = batch.sparkSession
    part = table.partition
    rows = batch.withColumn(part, TRANSFORMS[table.transform](table.ts))
    m = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(part).isNull()).alias("timeless"),
                 F.array_sort(F.collect_set(part)).alias("values")).first()
    values = m["values"]  # the partitions of the batch
    if m["timeless"]:
        raise ValueError(f"{m['timeless']} of {m['rows']} rows have no {table.ts} and so no partition")
    last = ledger(spark, table).orderBy(F.desc("load_no")).select("load_no", "total_records").first()
    before, held, gone = 0, 0, 0
    if operation != "overwrite" and path_exists(spark, table.path):
        held = last["total_records"] if last else spark.read.parquet(table.path).count()
    clustered = rows.hint("rebalance", part)
    writer = clustered.write.partitionBy(part).option("compression", "snappy")
    if operation == "overwrite":
        beside = f"{table.path.rstrip('/')}__new-{uuid.uuid4().hex[:12]}"
        writer.parquet(beside)
        switch_into_place(spark, beside, table.path)
    elif operation == "append":
        before = _files(spark, table, values)
        writer.mode("append").parquet(table.path)
    else:
        gone = _rows_in(spark, table, values)
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(table.path)
    files = _files(spark, table, values) - before
    # counted in the partitions the load touched; the rest is as the last load left it
    total = held - gone + (_rows_in(spark, table, values) if operation != "append" else m["rows"])
    # History is kept across a full overwrite; the parent is the last load.
    parent = last["load_no"] if last else None
    load_no = (parent or 0) + 1
    entry = local_rows(spark, [(load_no, parent, operation, m["rows"], files, len(values), total, None)],
                       LEDGER_SCHEMA).withColumn("committed_at", F.current_timestamp())
    entry.write.mode("append").parquet(table.ledger_path)
    return {"load_no": load_no, "rows": m["rows"], "files": files, "partitions": len(values), "total": total}


def new_entries(before: DataFrame, after: DataFrame) -> DataFrame:
    """Ledger rows present after but not before (``left_anti`` on the load number).

    ``before`` must be a frame created before the loads: a Parquet read fixes
    its file listing when it is created, so later appends are not in it.
    """
    return after.join(before.select("load_no"), "load_no", "left_anti")


def two_batch_load(df: DataFrame, table: PartitionedTable, boundary: str) -> tuple[DataFrame, dict, dict]:
    """First batch as overwrite, second as append; returns checks and both load records.

    Raises :class:`CheckFailed` before anything is written when a batch is empty
    or a row is in neither; the checks after the loads compare with the input.
    """
    spark = df.sparkSession
    _check_boundary(spark, boundary, table.transform)
    b = ts_literal(boundary, df.schema[table.ts].dataType)
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(table.ts) < b).alias("first"),
                    F.count_if(F.col(table.ts) >= b).alias("second")).first()
    assert_checks(coverage_checks(local_rows(spark, [tuple(counts)], "total bigint, first bigint, second bigint")))
    before = ledger(spark, table)
    first, second = split_batches(df, table.ts, boundary)
    r1 = load_batch(first, table, "overwrite")
    r2 = load_batch(second, table, "append")
    final = spark.read.parquet(table.path).agg(F.count(F.lit(1)).alias("rows"))
    added = new_entries(before, ledger(spark, table)).agg(F.count(F.lit(1)).alias("added"))
    folded = (final.select("rows", F.lit(None).cast("bigint").alias("added"))
              .unionByName(added.select(F.lit(None).cast("bigint").alias("rows"), "added"))
              .agg(F.max("rows").alias("rows"), F.max("added").alias("added")))
    checks = check_rows(folded, [
        ("rows_after_first_load", F.lit(counts["first"]), F.lit(r1["total"])),
        ("rows_after_second_load", F.lit(counts["total"]), F.col("rows")),
        ("ledger_entries_added", F.lit(2), F.col("added")),
    ])
    return checks, r1, r2


@dataclass(frozen=True)
class Batch:
    """Rows of ``[start, end)``; a bound of None is open."""

    name: str
    start: str | None
    end: str | None


def sweep_batches(df: DataFrame, ts: str, bounds: Sequence[Batch]) -> DataFrame:
    """Where any number of batches leaves a gap or overlaps: ``start, end, batches, finding, rows``.

    The bounds are swept in order: between two neighbouring ones the same batches
    hold.  Stretches with no batch are gaps, with two or more overlaps; rows are
    counted by one aggregate over the table.  Rows without a time are a gap with no
    bounds.  Bounds are compared as text, so all are written in one notation.
    """
    spark = df.sparkSession
    kind = df.schema[ts].dataType
    points = sorted({p for b in bounds for p in (b.start, b.end) if p is not None})
    stretches = list(zip([None, *points], [*points, None]))

    def holds(batch: Batch, start: str | None, end: str | None) -> bool:
        after = batch.start is None or start is not None and start >= batch.start
        return after and (batch.end is None or end is not None and end <= batch.end)

    found = []
    for k, (start, end) in enumerate(stretches):
        names = [b.name for b in bounds if holds(b, start, end)]
        if len(names) != 1:
            found.append((k, start, end, ",".join(names), "gap" if not names else "overlap"))
    found.append((len(stretches), None, None, "", "no time"))
    places = F.array(*[ts_literal(p, kind) for p in points])  # as many as the batches have bounds
    passed = F.size(F.filter(places, lambda p: p <= F.col(ts))) if points else F.lit(0)
    place = F.when(F.col(ts).isNull(), len(stretches)).otherwise(passed)
    rows = df.groupBy(place.alias("_k")).agg(F.count(F.lit(1)).alias("rows"))
    return (local_rows(spark, found, "_k int, start string, end string, batches string, finding string").join(rows, "_k", "left")
            .select("start", "end", "batches", "finding", F.coalesce("rows", F.lit(0)).alias("rows"))
            .where("finding = 'overlap' OR rows > 0"))


def load_batches(df: DataFrame, table: PartitionedTable, bounds: Sequence[Batch]) -> list[dict]:
    """Load any number of batches, the first as overwrite; refused before anything is written
    unless every row lies in exactly one batch."""
    wrong = sweep_batches(df, table.ts, bounds).collect()
    if wrong:
        raise CheckFailed("; ".join(f"{r['finding']} {r['start']} to {r['end']} ({r['batches']}): {r['rows']} rows" for r in wrong))
    out = []
    for k, b in enumerate(bounds):
        out.append(load_batch(df.where(half_open(df, table.ts, b.start, b.end)), table, "append" if k else "overwrite"))
    return out


def load_key_check(spark: SparkSession, path: str, key: list[str], source: DataFrame) -> DataFrame:
    """Rows and distinct keys in the loaded table must both equal the source's rows."""
    c = (spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*[F.col(k) for k in key]).alias("keys"))
         .select("rows", "keys", F.lit(None).cast("bigint").alias("expected"))
         .unionByName(source.agg(F.count(F.lit(1)).alias("expected"))
                      .select(F.lit(None).cast("bigint").alias("rows"), F.lit(None).cast("bigint").alias("keys"), "expected"))
         .agg(*[F.max(x).alias(x) for x in ("rows", "keys", "expected")]))
    return check_rows(c, [("rows_loaded", "expected", "`rows`"), ("unique_keys_loaded", "expected", "`keys`")])


def table_range(spark: SparkSession, table: PartitionedTable, start: str | None, end: str | None) -> DataFrame:
    """Rows of ``[start, end)``; only the months it touches are read."""
    if table.transform != "month":
        raise ValueError("ranges prune month partitions")
    df = spark.read.parquet(table.path)
    df = df.withColumn(table.partition, F.col(table.partition).cast("int"))
    return df.where(month_range(df, table.ts, table.partition, start, end))


def partition_inventory(spark: SparkSession, path: str, partition: str = MONTH,
                        with_files: bool = True, struct_name: str | None = None) -> DataFrame:
    """Per partition value: record count (and file count).

    Only the partition column and the hidden file path are read, so the scan
    touches Parquet footers, not data pages.  With ``struct_name`` the value
    is returned as ``partition: struct<struct_name int>``, the shape of a
    table format's partitions metadata.
    """
    df = spark.read.parquet(path)
    aggs = [F.count(F.lit(1)).alias("record_count")]
    if with_files:
        aggs.append(F.count_distinct(F.col("_metadata.file_path")).alias("file_count"))
    out = df.groupBy(F.col(partition).cast("int").alias(partition)).agg(*aggs).orderBy(partition)
    if struct_name:
        out = out.select(F.struct(F.col(partition).alias(struct_name)).alias("partition"),
                         *[c for c in out.columns if c != partition])
    return out
