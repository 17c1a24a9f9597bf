"""The whole flow on the events table: raw JSON -> raw zone -> gate -> formats -> loads -> answer."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.contract import Contract, Period, RangeRule
from sluice.functions.time import half_of_month
from sluice.operators import profiles
from sluice.operators.checks import assert_checks
from sluice.plans import batches, formats, gate
from sluice.sources import columnar_json, ingestion
from sluice.sources.csv import read_permissive
from sluice.sources.tables import table

SF = "/root/testdata/sf0.001"
FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def test_end_to_end(spark, workdir):
    events = table(spark, SF, "events").select("event_id", "ts", "event_type", "value")
    n = events.count()
    # 1. the source delivers columnar JSON; expand it to long rows
    src = os.path.join(workdir, "json")
    columnar_json.write_columnar(events, src, ["event_type"], "ts", ["event_id", "value"], time_format=FMT)
    schema = columnar_json.columnar_schema([T.StructField("event_type", T.StringType())], "time",
                                           [T.StructField("event_id", T.LongType()),
                                            T.StructField("value", T.DoubleType())])
    rows, bad = columnar_json.explode_columnar(columnar_json.read_columnar(spark, src, schema), "time",
                                               ["event_id", "value"], time_format=FMT)
    assert bad.count() == 0
    # 2. land it in the raw zone under an ingestion date, then pick the latest
    raw_root = os.path.join(workdir, "raw")
    ingestion.land(rows.select("event_id", "ts", "event_type", "value"), raw_root, "2024-02-01")
    contract = Contract(
        fields=T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                             T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())]),
        key=("event_id",), required=("ts", "event_type", "value"), blank=("event_type",),
        period=Period("ts", "2024-01-01", "2024-02-01"), ranges=(RangeRule("value", 0.0, 1000.0),))
    raw = ingestion.read_latest(spark, raw_root, lambda p: read_permissive(spark, p, contract)) \
        .drop("ingestion_date")
    # 3. the gate: one pass, strict (raises on lost rows or duplicate keys)
    res = gate.run_gate(raw, contract, os.path.join(workdir, "gate"), strict=True)
    assert res.metrics["raw"] == n and res.metrics["accepted"] == n
    accepted = res.accepted(spark, contract)
    # 4. two formats, parity on schema, counts, content and a query result
    csv_p, pq_p = os.path.join(workdir, "csv"), os.path.join(workdir, "pq")
    written = formats.write_two_formats(accepted, csv_p, pq_p, ["event_type"])
    csv_df, pq_df = formats.read_formats(spark, csv_p, pq_p, accepted.schema)
    assert all(r["same"] for r in formats.schema_parity(csv_df, pq_df).collect())
    assert_checks(formats.count_checks(written, {"csv": csv_df, "parquet": pq_df}))

    def hourly(df):
        return profiles.hourly_profile(df, "event_type", "ts", "value", "2024-01-08", "2024-01-22")
    assert_checks(formats.result_parity(hourly, csv_df, pq_df))
    # 5. load in two day-aligned batches, check keys and the ledger
    t = batches.PartitionedTable(os.path.join(workdir, "table"), "ts", "day")
    checks, r1, r2 = batches.two_batch_load(pq_df, t, "2024-01-16")
    assert_checks(checks)
    assert_checks(batches.load_key_check(spark, t.path, ["event_id"], events))
    assert batches.ledger(spark, t).agg(F.max("total_records")).first()[0] == n
    # 6. answer the question from the loaded table
    loaded = spark.read.parquet(t.path)
    answer = profiles.seasonal_profile(loaded, "event_type", "value", half_of_month("ts"), F.hour("ts")).collect()
    direct = profiles.seasonal_profile(events, "event_type", "value", half_of_month("ts"), F.hour("ts")).collect()
    assert sorted(map(tuple, answer)) == sorted(map(tuple, direct))


def test_flow_warns_of_missing_hours_and_goes_on(spark, workdir):
    import warnings

    from sluice.plans.flow import run_flow
    events = table(spark, SF, "events").select("event_id", "ts", "event_type", "value")
    contract = Contract(
        fields=T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                             T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())]),
        key=("event_id",), required=("ts", "event_type", "value"), period=Period("ts", "2024-01-01", "2024-02-01"))
    raw = os.path.join(workdir, "raw")
    ingestion.land(events, raw, "2024-02-01")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        answer = run_flow(spark, raw, contract, os.path.join(workdir, "flow"), "ts", "2024-01-16", lambda df: df.groupBy("event_type").count(),
                          expected=("event_type", "2024-01-01", "2024-01-03"))
        assert answer.agg(F.sum("count")).first()[0] == events.count()
    assert any("entities lack" in str(w.message) for w in seen)
