"""The quality gate over a stream of arriving raw files.

New CSV files under a landing folder are read as a file stream with the
contract schema, labelled with the same rules as the batch gate, and written
to a Parquet file sink partitioned by verdict.  The file sink commits every
micro-batch through its metadata log and the checkpoint, so a restarted or
retried batch never duplicates rows (exactly-once), and readers of the sink
see only committed files.  Row counts per batch (raw, accepted, rejected,
hits per rule) come from ``observe`` and arrive with each progress report.
Optionally each micro-batch is written by ``foreachBatch`` to its own
``batch_id=`` folder and recorded in a durable per-batch ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.contract import Contract
from sluice.operators import quality
from sluice.operators.dimension import local_rows
from sluice.plans.gate import VERDICT
from sluice.session import path_exists
from sluice.sources.csv import DATE_FORMAT, TIMESTAMP_FORMAT, contract_reader, pin_verdict


@dataclass
class GateStream:
    query: StreamingQuery
    sink: str

    def batch_metrics(self) -> list[dict]:
        """Observed counts of the last finished micro-batches, in order.

        Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` of them;
        give ``ledger_path`` for a durable count of every batch.
        """
        out = []
        for p in self.query.recentProgress:
            m = p.observedMetrics.get("gate") if p.observedMetrics else None
            if m is not None:
                out.append({"batch": p.batchId, **m.asDict()})
        return out


def read_stream(spark: SparkSession, landing: str, contract: Contract, max_files_per_trigger: int | None = None,
                timestamp_format: str = TIMESTAMP_FORMAT, date_format: str = DATE_FORMAT) -> DataFrame:
    reader = contract_reader(spark.readStream, contract, timestamp_format, date_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return pin_verdict(reader.csv(landing), contract)


STREAM_LEDGER_SCHEMA = "batch_id bigint, raw bigint, accepted bigint, rejected bigint, committed_at timestamp"


def stream_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """One row per committed micro-batch (durable, unlike progress reports)."""
    if not path_exists(spark, ledger_path):
        return spark.createDataFrame([], STREAM_LEDGER_SCHEMA)
    return spark.read.schema(STREAM_LEDGER_SCHEMA).parquet(ledger_path).orderBy("batch_id")


def _batch_writer(contract: Contract, present: set[str], sink: str, ledger_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        obs = Observation(f"gate_batch_{batch_id}")
        # A batch id always re-reads the same files (offset log), so
        # overwriting its own folder makes a retried batch idempotent.
        (batch.observe(obs, *quality.gate_metrics(contract, present))
         .write.mode("overwrite").partitionBy(VERDICT).parquet(f"{sink}/batch_id={batch_id}"))
        m = obs.get
        seen = stream_ledger(spark, ledger_path).where(F.col("batch_id") == batch_id).limit(1).count()
        if not seen:
            (local_rows(spark, [(batch_id, m["raw"], m["accepted"], m["rejected"], None)], STREAM_LEDGER_SCHEMA)
             .withColumn("committed_at", F.current_timestamp())
             .write.mode("append").parquet(ledger_path))
    return write


def start_gate_stream(spark: SparkSession, landing: str, contract: Contract, sink: str, checkpoint: str,
                      available_now: bool = True, max_files_per_trigger: int | None = None,
                      ledger_path: str | None = None) -> GateStream:
    """Start the stream; with ``available_now`` it processes what has landed, then stops.

    Without ``ledger_path`` the rows go to the Parquet file sink (exactly-once
    through its metadata log) and per-batch counts arrive with the progress
    reports.  With ``ledger_path`` each micro-batch is written to
    ``sink/batch_id=<n>/`` by ``foreachBatch`` and its observed counts are
    appended to a durable ledger once per batch id.
    """
    raw = read_stream(spark, landing, contract, max_files_per_trigger)
    labelled = quality.label(raw, contract)
    verdict = F.when(F.col(quality.REASON) == "", F.lit("accepted")).otherwise(F.lit("rejected"))
    if ledger_path:
        writer = (labelled.withColumn(VERDICT, verdict).writeStream
                  .foreachBatch(_batch_writer(contract, set(raw.columns), sink, ledger_path))
                  .option("checkpointLocation", checkpoint))
    else:
        observed = labelled.observe("gate", *quality.gate_metrics(contract, set(raw.columns)))
        writer = (observed.withColumn(VERDICT, verdict).writeStream
                  .format("parquet").partitionBy(VERDICT)
                  .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return GateStream(writer.start() if ledger_path else writer.start(sink), sink)


def accepted_from_sink(spark: SparkSession, sink: str, contract: Contract) -> DataFrame:
    """Accepted rows committed to the sink (read through its metadata log)."""
    rows = spark.read.parquet(sink).where(F.col(VERDICT) == "accepted")
    return rows.drop(VERDICT, "batch_id", quality.REASON, contract.corrupt_column)


def rejected_from_sink(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).where(F.col(VERDICT) == "rejected").drop(VERDICT, "batch_id")
