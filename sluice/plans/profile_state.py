"""Profiles kept up per load: mergeable partial state beside a partitioned table.

Every load appends, for its own rows only, one state row per (partition,
entity, season, hour): row and value counts, exact sum, minimum, maximum, first
and last time.  Questions are answered by merging state rows, so a load scans
nothing but its batch and an answer reads no fact row.  The state has one row per
partition, entity, season and hour and load, however many facts there are.

A load that replaces partitions makes their older state rows void; one that
overwrites the table makes all older ones void.  State rows carry their load's
number and operation, so which rows hold follows from the state itself.

The state is written before the load counts as kept up: ``check_state`` compares
it with the ledger, and ``rebuild_state`` makes it anew from the table's rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.sqltext import ident
from sluice.operators import profiles
from sluice.operators.checks import check_rows
from sluice.plans.batches import TRANSFORMS, PartitionedTable, ledger, load_batch
from sluice.session import path_exists, scratch_path, switch_into_place

@dataclass(frozen=True)
class ProfileState:
    """What is kept for one table: ``season`` maps the time column to a label."""

    table: PartitionedTable
    entity: str
    measure: str
    season: Callable[[str], Column]

    @property
    def path(self) -> str:
        return self.table.path.rstrip("/") + "__profile"


def partials(rows: DataFrame, state: ProfileState) -> DataFrame:
    """State rows of a batch: one aggregate with map-side combine over four of its columns."""
    t, m = ident(state.table.ts), ident(state.measure)
    return rows.groupBy(TRANSFORMS[state.table.transform](state.table.ts).alias("partition"), F.col(state.entity).alias("entity"),
                        state.season(state.table.ts).alias("season"), F.hour(F.col(state.table.ts)).cast("int").alias("hour")).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"count({m}) AS n"), F.expr(f"CAST(sum(CAST({m} AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS total"),
        F.expr(f"CAST(min({m}) AS DOUBLE) AS low"), F.expr(f"CAST(max({m}) AS DOUBLE) AS high"), F.expr(f"min({t}) AS first"), F.expr(f"max({t}) AS last"))


def load_with_state(batch: DataFrame, state: ProfileState, operation: str) -> dict:
    """Load one batch and append its state; both read the batch alone."""
    record = load_batch(batch, state.table, operation)
    rows = partials(batch, state).withColumns({"load_no": F.lit(record["load_no"]), "operation": F.lit(operation)})
    rows.write.mode("append").parquet(state.path)
    return record


def valid_state(spark: SparkSession, state: ProfileState) -> DataFrame:
    """State rows that still hold: of no load that was overwritten or replaced later."""
    rows = spark.read.parquet(state.path)
    since = rows.where(F.col("operation") == "overwrite").agg(F.coalesce(F.max("load_no"), F.lit(0)).alias("_since"))
    replaced = rows.where(F.col("operation") == "replace_partitions").groupBy("partition").agg(F.max("load_no").alias("_replaced"))
    kept = rows.join(replaced, "partition", "left").join(F.broadcast(since))  # one row
    return kept.where(F.col("load_no") >= F.greatest(F.coalesce("_replaced", F.lit(0)), "_since")).drop("_replaced", "_since")


def merged(spark: SparkSession, state: ProfileState, *by: str) -> DataFrame:
    """One row per value of ``by``: sums add up, extremes meet."""
    return valid_state(spark, state).groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("first").alias("first"), F.max("last").alias("last"))


def check_state(spark: SparkSession, state: ProfileState) -> DataFrame:
    """The state against the table's ledger: rows of the table, and loads since the state began that left none."""
    loads = ledger(spark, state.table)
    kept = valid_state(spark, state).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("kept"))
    total = loads.agg(F.max_by("total_records", "load_no").alias("total"))
    since = valid_state(spark, state).agg(F.min("load_no").alias("_since"))
    kept_loads = spark.read.parquet(state.path).select("load_no").distinct()
    missing = loads.where("added_records > 0").join(F.broadcast(since), F.col("load_no") >= F.col("_since")).join(kept_loads, "load_no", "left_anti")
    behind = missing.agg(F.count(F.lit(1)).alias("behind"))
    nothing = F.lit(None).cast("bigint")
    one = (kept.select("kept", nothing.alias("total"), nothing.alias("behind"))
           .unionByName(total.select(nothing.alias("kept"), "total", nothing.alias("behind")))
           .unionByName(behind.select(nothing.alias("kept"), nothing.alias("total"), "behind"))
           .agg(*[F.max(c).alias(c) for c in ("kept", "total", "behind")]))
    return check_rows(one, [("state_counts_the_table", "total", "kept"), ("loads_without_their_state", "0", "behind")])


def rebuild_state(spark: SparkSession, state: ProfileState) -> None:
    """State of the whole table as it is, as if one load had written it."""
    last = ledger(spark, state.table).agg(F.max("load_no").alias("last")).first()["last"]
    beside = scratch_path(spark, "profile")
    rows = partials(spark.read.parquet(state.table.path), state)
    rows.withColumns({"load_no": F.lit(last), "operation": F.lit("overwrite")}).write.parquet(beside)
    switch_into_place(spark, beside, state.path)


# ------------------------------------------------------------------ answers
def coverage(spark: SparkSession, state: ProfileState, digits: int = 1) -> DataFrame:
    """As ``quality.entity_coverage`` over the whole table."""
    return (merged(spark, state, "entity")
            .select(F.col("entity").alias(state.entity), F.col("rows").alias("observations"), F.col("first").alias("first_observation"),
                    F.col("last").alias("last_observation"), F.round("low", digits).alias("min_value"), F.round("high", digits).alias("max_value"))
            .orderBy(state.entity))


def _mean() -> Column:
    return F.expr("CASE WHEN n > 0 THEN CAST(total AS DOUBLE) / n END")


def hourly(spark: SparkSession, state: ProfileState, digits: int = 3) -> DataFrame:
    """As ``profiles.hourly_profile`` over the whole table."""
    mean = F.expr(f"CAST(round(CAST(CASE WHEN n > 0 THEN total / n END AS DECIMAL(18,6)), {int(digits)}) AS DOUBLE)")
    return (merged(spark, state, "entity", "hour")
            .select(F.col("entity").alias(state.entity), F.col("hour").alias("hour_utc"), mean.alias("mean_value"), F.col("rows").alias("observations"))
            .orderBy(state.entity, "hour_utc"))


def seasonal(spark: SparkSession, state: ProfileState, digits: int = 2) -> DataFrame:
    """As ``profiles.seasonal_profile`` by hour over the whole table."""
    level1 = merged(spark, state, "entity", "season", "hour").select(F.col("entity").alias(state.entity), "season", "hour", _mean().alias(profiles.MEAN))
    return (profiles.cycle_extremes(level1, [state.entity, "season"], "hour", digits)
            .orderBy("season", F.desc("amplitude"), state.entity))


def local(spark: SparkSession, state: ProfileState, dim: DataFrame, district: str, offset: str, digits: int = 2) -> DataFrame:
    """As ``profiles.local_profile`` over the whole table."""
    per_hour = merged(spark, state, "entity", "season", "hour").select(
        F.col("entity").alias(state.entity), "season", F.col("hour").alias("_utc_hour"), F.col("total").cast("double").alias("_sum"), F.col("n").alias("_n"))
    return profiles.local_cycles(per_hour, dim, state.entity, district, offset, digits)


def has_state(spark: SparkSession, state: ProfileState) -> bool:
    return path_exists(spark, state.path)
