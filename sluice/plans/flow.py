"""The whole job: raw files to gate, two formats, batch load and answer.

Every step asserts its checks and raises ``CheckFailed`` before the next one
starts, so a wrong count never reaches the table.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.contract import Contract
from sluice.operators.checks import assert_checks
from sluice.operators.quality import completeness
from sluice.plans import batches, formats, gate
from sluice.sources import ingestion
from sluice.sources.csv import header_mismatches, read_permissive


def run_flow(spark: SparkSession, raw_root: str, contract: Contract, work: str, ts: str, boundary: str,
             query: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = (),
             transform: str = "day", expected: tuple[str, str, str] | None = None) -> DataFrame:
    """``query`` over the table loaded from the latest raw partition of ``raw_root``.

    Files go below ``work``: ``gate``, ``csv``, ``parquet`` and ``table``.  With
    ``expected`` (entity, start, end) the loaded table's hours are counted, and
    entities that lack some are warned about; that alone stops nothing.
    """
    def read(path: str) -> DataFrame:
        wrong = header_mismatches(spark, path, contract.names).where("NOT (in_file AND in_contract)").limit(5).collect()
        if wrong:
            raise ValueError(f"headers differ from the contract: {[tuple(r) for r in wrong]}")
        return read_permissive(spark, path, contract)

    raw = ingestion.read_latest(spark, raw_root, read).drop("ingestion_date")
    gated = gate.run_gate(raw, contract, f"{work}/gate", strict=True)
    accepted = gated.accepted(spark, contract)
    csv_path, parquet_path = f"{work}/csv", f"{work}/parquet"
    written = formats.write_two_formats(accepted, csv_path, parquet_path, partition_by)
    csv_df, parquet_df = formats.read_formats(spark, csv_path, parquet_path, accepted.schema)
    wrong = [r["column_name"] for r in formats.schema_parity(csv_df, parquet_df).collect() if not r["same"]]
    if wrong:
        raise ValueError(f"types differ between the formats: {wrong}")
    assert_checks(formats.count_checks(written, {"csv": csv_df, "parquet": parquet_df}))
    assert_checks(formats.result_parity(query, csv_df, parquet_df))
    table = batches.PartitionedTable(f"{work}/table", ts, transform)
    checks, _, _ = batches.two_batch_load(parquet_df, table, boundary)
    assert_checks(checks)
    assert_checks(batches.load_key_check(spark, table.path, list(contract.key), parquet_df))
    loaded = spark.read.parquet(table.path)
    if expected:
        entity, start, end = expected
        gaps = completeness(loaded, entity, ts, start, end).where("missing > 0")
        n = gaps.agg(F.count(F.lit(1)).alias("entities"), F.coalesce(F.sum("missing"), F.lit(0)).alias("hours")).first()
        if n["entities"]:
            some = ", ".join(f"{r[entity]}: {r['missing']}" for r in gaps.limit(5).collect())
            warnings.warn(f"{n['entities']} entities lack {n['hours']} hours in [{start}, {end}): {some}", stacklevel=2)
    return query(loaded)
