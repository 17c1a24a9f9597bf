"""The quality gate as one job: label, split, write, reconcile.

The raw input is scanned once.  Labelled rows are written in a single
Parquet write partitioned by ``verdict`` (accepted / rejected), and the
reconciliation numbers (rows, accepted, rejected, hits per rule) are
collected by ``DataFrame.observe`` during that same write.  Nothing is
cached: the written dataset is the cut in the lineage, and a lost executor
only re-runs its own write tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.contract import Contract
from sluice.operators import quality
from sluice.operators.checks import assert_checks, check_rows

VERDICT = "verdict"


@dataclass
class GateResult:
    root: str
    schema: T.StructType  # labelled schema, without the verdict column
    metrics: dict

    def _read(self, spark: SparkSession) -> DataFrame:
        full = T.StructType(list(self.schema.fields) + [T.StructField(VERDICT, T.StringType())])
        return spark.read.schema(full).parquet(self.root)

    def accepted(self, spark: SparkSession, contract: Contract) -> DataFrame:
        rows = self._read(spark).where(F.col(VERDICT) == "accepted").drop(VERDICT)
        drop = [quality.REASON] + ([contract.corrupt_column] if contract.corrupt_column in rows.columns else [])
        return rows.drop(*drop)

    def rejected(self, spark: SparkSession) -> DataFrame:
        return self._read(spark).where(F.col(VERDICT) == "rejected").drop(VERDICT)

    def duplicate_keys(self, spark: SparkSession, contract: Contract) -> DataFrame:
        """Accepted rows sharing a contract key (must be empty)."""
        return quality.duplicate_keys(self.accepted(spark, contract), list(contract.key))

    def checks(self, spark: SparkSession, contract: Contract | None = None) -> DataFrame:
        """Observed counts against the written dataset, plus the key check when a
        contract with a key is given."""
        m = self.metrics
        written = self._read(spark).agg(
            F.count_if(F.col(VERDICT) == "accepted").alias("acc"),
            F.count_if(F.col(VERDICT) == "rejected").alias("rej"))
        rows = [
            ("raw_not_empty", F.lit(1), F.lit(min(m["raw"], 1))),
            ("raw_equals_accepted_plus_rejected", F.lit(m["raw"]), F.lit(m["accepted"] + m["rejected"])),
            ("accepted_written", F.lit(m["accepted"]), F.col("acc")),
            ("rejected_written", F.lit(m["rejected"]), F.col("rej")),
        ]
        if contract is not None and contract.key:
            dups = self.duplicate_keys(spark, contract).agg(F.count(F.lit(1)).alias("dups"))
            folded = (written.select("acc", "rej", F.lit(None).cast("bigint").alias("dups"))
                      .unionByName(dups.select(F.lit(None).cast("bigint").alias("acc"),
                                               F.lit(None).cast("bigint").alias("rej"), "dups"))
                      .agg(F.max("acc").alias("acc"), F.max("rej").alias("rej"), F.max("dups").alias("dups")))
            return check_rows(folded, rows + [("accepted_duplicate_keys", F.lit(0), F.col("dups"))])
        return check_rows(written, rows)


def run_gate(raw: DataFrame, contract: Contract, root: str, strict: bool = False) -> GateResult:
    """Label, split and write ``raw``; with ``strict`` raise :class:`CheckFailed`
    when a reconciliation check or the key check fails."""
    labelled = quality.label(raw, contract)
    obs = Observation("gate")
    observed = labelled.observe(obs, *quality.gate_metrics(contract, set(raw.columns)))
    verdict = F.when(F.col(quality.REASON) == "", F.lit("accepted")).otherwise(F.lit("rejected"))
    (observed.withColumn(VERDICT, verdict)
     .write.mode("overwrite").option("compression", "snappy").partitionBy(VERDICT).parquet(root))
    result = GateResult(root, labelled.schema, obs.get)
    if strict:
        assert_checks(result.checks(raw.sparkSession, contract))
    return result


def write_rejects(rejected: DataFrame, path: str) -> int:
    """Overwrite the reject set and return the number of rows written (observed)."""
    obs = Observation("rejects")
    rejected.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return obs.get["rows"]


def reject_roundtrip(spark: SparkSession, rejected: DataFrame, path: str) -> DataFrame:
    """Write rejects, read them back with the explicit schema, compare counts.

    The schema is given on the read because an empty reject set may leave no
    data file to take it from.
    """
    written = write_rejects(rejected, path)
    back = spark.read.schema(rejected.schema).parquet(path).agg(F.count(F.lit(1)).alias("n"))
    return check_rows(back, [("rejects_written", F.lit(written), F.col("n"))])
