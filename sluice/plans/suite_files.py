"""Suite entries that write files: sources, sinks, round trips, batch loads.

Each entry writes the whole input table (or a projection Spark derives from
it) below a fresh folder of the shared scratch root, then returns a
DataFrame read back from what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.contract import Contract, Period, RangeRule, SameDay
from sluice.operators import dimension as dim_ops
from sluice.operators import profiles, quality
from sluice.plans import batches, formats, gate
from sluice.plans.suite import (EVENT_PERIOD, HOURLY_RANGE, LOAD_BOUNDARY, SEASONS, SECOND_HALF_START,
                                events, events_contract, labelled_events, orders_by_nation, register,
                                rollup_dimension)
from sluice.functions.time import months_in, season_of_month
from sluice.session import path_exists, scratch_path
from sluice.sources import columnar_json, files, ingestion
from sluice.sources.csv import (DATE_FORMAT, TIMESTAMP_FORMAT, header_mismatches, read_failfast,
                                read_permissive, write_csv)
from sluice.sources.tables import table

# What several entries read back is written once per application and data folder.
_WRITTEN: dict[tuple[str, str, str], object] = {}


def _once(spark, d, name: str, write):
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _WRITTEN or not path_exists(spark, _WRITTEN[key][0]):
        root = scratch_path(spark, name)
        _WRITTEN[key] = (root, write(root))
    return _WRITTEN[key][1]


# ------------------------------------------------------------ dirty CSV file
CSV_CONTRACT_FIELDS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("k", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("d", T.DateType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("i", T.IntegerType()),
])


def csv_contract() -> Contract:
    return Contract(
        fields=CSV_CONTRACT_FIELDS,
        key=("k", "ts"),
        required=("ts", "d", "k", "v"),
        blank=("k",),
        same_day=(SameDay("d", "ts"),),
        period=Period("ts", *EVENT_PERIOD),
        ranges=(RangeRule("v", 0.0, 100.0), RangeRule("i", 0, 100)),
    )


def dirty_csv_lines(e: DataFrame) -> DataFrame:
    """Events as CSV cell text with defects by value band (same bands in the oracle).

    ts 'notatime' in [1, 1.3); v 'abc' in [2, 2.3); i written as '<n>.0' in
    [3, 3.3); event_id 'x<n>', a column without a rule, in [6, 6.3) -- all four
    make the line malformed; k empty in [4, 4.3); d one day late in [5, 5.3).
    """
    v = F.col("value")
    band = lambda lo, hi: (v >= lo) & (v < hi)
    day = F.to_date("ts")
    return e.select(
        F.when(band(6.0, 6.3), F.concat(F.lit("x"), F.col("event_id").cast("string")))
         .otherwise(F.col("event_id").cast("string")).alias("event_id"),
        F.when(band(4.0, 4.3), F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("k"),
        F.when(band(1.0, 1.3), F.lit("notatime"))
         .otherwise(F.date_format("ts", TIMESTAMP_FORMAT)).alias("ts"),
        F.date_format(F.when(band(5.0, 5.3), F.date_add(day, 1)).otherwise(day), DATE_FORMAT).alias("d"),
        F.when(band(2.0, 2.3), F.lit("abc")).otherwise(v.cast("string")).alias("v"),
        F.when(band(3.0, 3.3), F.concat(F.col("user_id").cast("string"), F.lit(".0")))
         .otherwise(F.col("user_id").cast("string")).alias("i"),
    )


def _dirty_csv(spark, d) -> tuple[str, Contract]:
    path = _once(spark, d, "dirty_csv", lambda root: write_csv(dirty_csv_lines(events(spark, d)), root))
    return path, csv_contract()


@register("csv_permissive_scan")
def csv_permissive_scan(spark, d):
    path, c = _dirty_csv(spark, d)
    raw = read_permissive(spark, path, c)
    lab = quality.label(raw, c)
    return lab.select(*c.names, F.col(c.corrupt_column).isNotNull().alias("corrupt"), quality.REASON)


@register("row_counts")
def row_counts(spark, d):
    """Raw, time-parsed, accepted and rejected rows of the dirty CSV, in one aggregate."""
    path, c = _dirty_csv(spark, d)
    return quality.row_counts(quality.label(read_permissive(spark, path, c), c), "ts")


def _labelled_csv(spark, d):
    path, c = _dirty_csv(spark, d)
    return quality.label(read_permissive(spark, path, c), c), c


@register("csv_histogram")
def csv_histogram(spark, d):
    return quality.reject_histogram(_labelled_csv(spark, d)[0])


@register("csv_accepted")
def csv_accepted(spark, d):
    return quality.accepted(*_labelled_csv(spark, d))


@register("csv_reconciliation")
def csv_reconciliation(spark, d):
    return quality.reconciliation(_labelled_csv(spark, d)[0])


@register("quality_gate")
def quality_gate(spark, d):
    path, c = _dirty_csv(spark, d)
    result = gate.run_gate(read_permissive(spark, path, c), c, scratch_path(spark, "gate"))
    return result.checks(spark, c)


@register("contract_columns")
def contract_columns(spark, d):
    """Header of every file under a folder against the events contract.

    One of two loads was written with a renamed column.
    """
    e = events(spark, d)
    root = scratch_path(spark, "contract_csv")
    late = F.col("ts") >= F.lit(SECOND_HALF_START)
    write_csv(e.where(~late), root)
    write_csv(e.where(late).withColumnRenamed("value", "amount"), root, mode="append")
    rows = header_mismatches(spark, root, events_contract(e).names)
    n_files = rows.select("file").distinct().count()
    return rows.groupBy("column_name").agg((F.count_if("in_file") == n_files).alias("in_every_file"), F.bool_or("in_file").alias("in_some_file"),
                                           F.bool_or("in_contract").alias("in_contract"))


# ------------------------------------------------------------ columnar JSON
JSON_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_VALUES = [T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
               T.StructField("value", T.DoubleType())]


def _json_keys():
    """One object per type and hour."""
    return ["event_type", F.to_date("ts").alias("day"), F.hour("ts").alias("hour")]


@register("columnar_json_explode")
def columnar_json_explode(spark, d):
    path = scratch_path(spark, "columnar_json")
    columnar_json.write_columnar(events(spark, d), path, _json_keys(), "ts", [f.name for f in JSON_VALUES],
                                 time_format=JSON_TIME_FORMAT)
    schema = columnar_json.columnar_schema(
        [T.StructField("event_type", T.StringType()), T.StructField("day", T.StringType())],
        "time", JSON_VALUES)
    objects = columnar_json.read_columnar(spark, path, schema)
    rows, _rejected = columnar_json.explode_columnar(
        objects, "time", [f.name for f in JSON_VALUES], ts_name="ts", date_name="obs_date",
        time_format=JSON_TIME_FORMAT)
    return rows.select("event_id", "event_type", "ts", "user_id", "value", "obs_date")


@register("json_incomplete_objects")
def json_incomplete_objects(spark, d):
    """Objects by outcome when some lack an array, have a short one, or are cut off."""
    path = scratch_path(spark, "objects_json")
    columnar_json.write_columnar(events(spark, d), path, _json_keys(), "ts", [f.name for f in JSON_VALUES],
                                 time_format=JSON_TIME_FORMAT)
    line = F.col("value")
    hour = F.get_json_object(line, "$.hour").cast("int")
    spoilt = (F.when(hour == 3, F.regexp_replace(line, '"user_id"', '"user_no"'))
              .when(hour == 4, F.regexp_replace(line, '"event_id":\\[[0-9]+', '"event_id":[0,0'))
              .when(hour == 5, F.substring(line, 1, 40)).when(hour == 6, F.regexp_replace(line, '"hourly"', '"daily"')).otherwise(line))
    spoilt_path = scratch_path(spark, "spoilt_json")
    spark.read.text(path).select(spoilt.alias("value")).write.text(spoilt_path)
    schema = columnar_json.columnar_schema([T.StructField("event_type", T.StringType()), T.StructField("day", T.StringType())],
                                           "time", JSON_VALUES)
    rows, rejected = columnar_json.explode_columnar(columnar_json.read_columnar(spark, spoilt_path, schema), "time",
                                                    [f.name for f in JSON_VALUES], time_format=JSON_TIME_FORMAT)
    return (rejected.groupBy(F.col("reject_reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
            .unionByName(rows.agg(F.lit("rows").alias("outcome"), F.count(F.lit(1)).alias("n"))))


# ------------------------------------------------------------ raw zone pick
@register("latest_ingestion")
def latest_ingestion(spark, d):
    e = events(spark, d)
    root = scratch_path(spark, "raw_zone")
    ingestion.land(e.where(F.col("ts") < F.lit(SECOND_HALF_START)), root, "2024-01-16")
    ingestion.land(e.where(F.col("ts") >= F.lit(SECOND_HALF_START)), root, "2024-01-31")
    picked = ingestion.read_latest(spark, root, lambda p: read_failfast(spark, p, e.schema))
    return picked.select("event_id", "ts", "event_type", "value", "ingestion_date")


# ------------------------------------------------------------ file inventories
def _daily_rows(spark, d, name: str, where=None) -> str:
    """Whole events as text, sorted, in four files a day: sizes and digests follow from the rows."""
    e = events(spark, d).selectExpr(
        "CAST(to_date(ts) AS STRING) AS day", "CAST(pmod(event_id, 4) AS INT) AS part", "event_id",
        "concat_ws(',', event_id, date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), user_id, event_type, CAST(value AS DECIMAL(18,6)), props) AS value")
    e = e if where is None else e.where(where)
    path = scratch_path(spark, name)
    (e.repartition("day", "part").sortWithinPartitions("day", "part", "event_id").drop("event_id")
     .write.partitionBy("day", "part").text(path))
    return path


def _by_day(files_: DataFrame) -> DataFrame:
    return files_.withColumn("relative_path", F.regexp_replace(F.regexp_extract("relative_path", r"day=([^/]+/part=[0-9]+)/", 1), "part=", ""))


@register("file_manifest")
def file_manifest(spark, d):
    rows = _by_day(files.file_manifest(spark, _daily_rows(spark, d, "manifest")))
    return rows.select(F.col("relative_path").alias("day"), "length", "sha256", "status")


@register("storage_size")
def storage_size(spark, d):
    return files.storage_size(spark, _daily_rows(spark, d, "size"), "daily")


@register("size_ratio")
def size_ratio(spark, d):
    """Bytes of all days over bytes of the first half."""
    whole = files.storage_size(spark, _daily_rows(spark, d, "whole"), "whole")
    half = files.storage_size(spark, _daily_rows(spark, d, "half", F.col("day") < SECOND_HALF_START), "half")
    return files.size_ratio(whole.unionByName(half), "whole", "half")


def _copies(spark, d) -> tuple[DataFrame, DataFrame]:
    """Manifests of a zone and of its copy: one day has lost rows, one is missing, one is more."""
    left = _daily_rows(spark, d, "zone", F.col("day") != "2024-01-07")
    right = _daily_rows(spark, d, "copy", (F.col("day") != "2024-01-05") & ((F.col("day") != "2024-01-06") | (F.col("event_id") % 8 < 4)))
    return _by_day(files.file_manifest(spark, left)), _by_day(files.file_manifest(spark, right))


@register("manifest_diff")
def manifest_diff(spark, d):
    return files.manifest_diff(*_copies(spark, d)).select(F.col("relative_path").alias("day"), "status")


@register("manifest_verify")
def manifest_verify(spark, d):
    """A written manifest of a zone, read again and held against the copy."""
    zone, copy = _copies(spark, d)
    path = scratch_path(spark, "manifest_json")
    zone.select(F.col("relative_path").alias("path"), F.col("length").alias("bytes"), F.upper("sha256").alias("sha256")).write.json(path)
    checked = files.verify_manifest(files.read_manifest(spark, path, nested=False), copy)
    return files.diff_summary(checked)


# ------------------------------------------------------------ format parity
def _two_formats(spark, d):
    lab, c = labelled_events(spark, d)
    acc = quality.accepted(lab, c)

    def write(root):
        paths = f"{root}/csv", f"{root}/parquet"
        return paths, formats.write_two_formats(acc, *paths, ["event_type"])
    paths, written = _once(spark, d, "two_formats", write)
    return written, *formats.read_formats(spark, *paths, acc.schema)


@register("format_roundtrip")
def format_roundtrip(spark, d):
    written, csv_df, pq_df = _two_formats(spark, d)
    same = [r["column_name"] for r in formats.schema_parity(csv_df, pq_df).collect() if not r["same"]]
    if same:
        raise ValueError(f"types differ between the formats: {same}")
    return formats.count_checks(written, {"csv": csv_df, "parquet": pq_df})


@register("result_parity")
def result_parity(spark, d):
    _, csv_df, pq_df = _two_formats(spark, d)

    def q(df):
        return profiles.hourly_profile(df, "event_type", "ts", "value", *HOURLY_RANGE)
    return formats.result_parity(q, csv_df, pq_df)


@register("reject_sink_roundtrip")
def reject_sink_roundtrip(spark, d):
    lab, _ = labelled_events(spark, d)
    return gate.reject_roundtrip(spark, quality.rejected(lab), scratch_path(spark, "rejects"))


# ------------------------------------------------------------ batch loads
def _lineitem_load(spark, d):
    """The two-batch load of lineitem."""
    def load(root):
        t = batches.PartitionedTable(f"{root}/table", "l_shipdate", "month")
        return (t, *batches.two_batch_load(table(spark, d, "lineitem"), t, LOAD_BOUNDARY))
    return _once(spark, d, "lineitem_load", load)


@register("two_batch_load")
def two_batch_load(spark, d):
    return _lineitem_load(spark, d)[1]


@register("batch_coverage")
def batch_coverage(spark, d):
    return batches.batch_coverage(table(spark, d, "lineitem"), "l_shipdate", LOAD_BOUNDARY)


LEDGER_COLUMNS = ["load_no", "parent_load_no", "operation", "added_records", "total_records", "added_files", "partitions"]


@register("load_ledger")
def load_ledger(spark, d):
    return batches.ledger(spark, _lineitem_load(spark, d)[0]).select(*LEDGER_COLUMNS)


@register("load_rejects_uncovered")
def load_rejects_uncovered(spark, d):
    """Events whose time is sometimes unknown: the load refuses and leaves no table."""
    from sluice.operators.checks import CheckFailed, check_rows
    e = events(spark, d).selectExpr("event_id", "CASE WHEN value >= 1.0 AND value < 1.3 THEN NULL ELSE ts END AS ts", "value")
    t = batches.PartitionedTable(scratch_path(spark, "uncovered"), "ts", "day")
    try:
        batches.two_batch_load(e, t, SECOND_HALF_START)
        refused = 0
    except CheckFailed:
        refused = 1
    left = int(path_exists(spark, t.path)) + int(path_exists(spark, t.ledger_path))
    seen = e.agg(F.count(F.lit(1)).alias("total"), F.count("ts").alias("timed"))
    return check_rows(seen, [("batches_cover_input", "total", "timed"), ("refused", "1", str(refused)), ("tables_left", "0", str(left))])


def _late_load(spark, d):
    """Lineitem loaded up to the boundary, then rows of its months that arrive late, then a rerun."""
    li = table(spark, d, "lineitem")
    t = batches.PartitionedTable(scratch_path(spark, "late_table"), "l_shipdate", "month")
    early = F.col("l_linenumber") <= 3
    batches.load_batch(li.where(early), t, "overwrite")
    batches.load_batch(li.where(~early), t, "append")
    return t, li


@register("late_append")
def late_append(spark, d):
    """Late rows of months that are loaded already add to them."""
    t, _ = _late_load(spark, d)
    return batches.partition_inventory(spark, t.path, t.partition, with_files=False)


@register("ledger_after_rerun")
def ledger_after_rerun(spark, d):
    """Both loads run twice, and one month's partitions replaced: totals follow the table."""
    t, li = _late_load(spark, d)
    early = F.col("l_linenumber") <= 3
    batches.load_batch(li.where(early), t, "overwrite")
    batches.load_batch(li.where(~early), t, "append")
    batches.load_batch(li.where(F.col("l_shipdate") >= F.lit(LOAD_BOUNDARY)), t, "replace_partitions")
    return batches.ledger(spark, t).select("load_no", "operation", "added_records", "total_records", "partitions")


@register("partition_inventory")
def partition_inventory(spark, d):
    """Rows and files of every month: a month of one load is one file at this size."""
    t = _lineitem_load(spark, d)[0]
    return batches.partition_inventory(spark, t.path, t.partition)


@register("hourly_from_table")
def hourly_from_table(spark, d):
    """The hourly profile over three months of the loaded table, read from their partitions only."""
    t = _lineitem_load(spark, d)[0]
    rows = batches.table_range(spark, t, "1996-02-01", "1996-05-01")
    return profiles.hourly_profile(rows, "l_returnflag", "l_shipdate", "l_quantity", None, None)


@register("lineitem_months_sql")
def lineitem_months_sql(spark, d):
    """Lines and mean quantity per ship month: SQL text on a file path, grouped and sorted by ordinals."""
    from sluice.sources.tables import path_relation
    return spark.sql(f"""
        SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS ship_month, l_returnflag,
               count(*) AS lines, CAST(round(avg(CAST(l_quantity AS DECIMAL(18,6))), 4) AS DOUBLE) AS mean_quantity
        FROM {path_relation(spark, f"{d.rstrip('/')}/lineitem.parquet")}
        GROUP BY 1, 2
        ORDER BY 1, 3 DESC, 2""")


def _events_load(spark, d):
    def load(root):
        t = batches.PartitionedTable(f"{root}/table", "ts", "day")
        batches.two_batch_load(events(spark, d), t, SECOND_HALF_START)
        return t
    return _once(spark, d, "events_load", load)


@register("load_key_check")
def load_key_check(spark, d):
    return batches.load_key_check(spark, _events_load(spark, d).path, ["event_id"], events(spark, d))


@register("partition_inventory_days")
def partition_inventory_days(spark, d):
    t = _events_load(spark, d)
    return batches.partition_inventory(spark, t.path, t.partition)


# ------------------------------------------------------------ two source kinds
@register("federated_rollup")
def federated_rollup(spark, d):
    """Parquet facts joined to a dimension kept as CSV, in one query."""
    dim = rollup_dimension(spark, d)
    path = write_csv(dim, scratch_path(spark, "dimension_csv"))
    dim_csv = read_failfast(spark, path, dim.schema)
    return dim_ops.dimension_rollup(orders_by_nation(spark, d), dim_csv, "c_nationkey", "n_nationkey", "n_name")


@register("season_pivot")
def season_pivot(spark, d):
    """Amplitude per entity and season, exported as headed CSV, read back, pivoted."""
    o = table(spark, d, "orders")
    prof = profiles.seasonal_profile(
        o, "o_orderpriority", "o_totalprice", season_of_month("o_orderdate", SEASONS),
        F.dayofmonth("o_orderdate"), where=months_in("o_orderdate", SEASONS), pos="day")
    path = write_csv(prof.select("o_orderpriority", "season", "amplitude"), scratch_path(spark, "export"))
    back = (spark.read.schema("o_orderpriority string, season string, amplitude string")
            .option("header", True).csv(path)
            .withColumn("amplitude", F.col("amplitude").try_cast("double")))
    return profiles.season_pivot(back, "o_orderpriority", ["summer", "winter"])


# ------------------------------------------------------------ streaming gate
@register("stream_gate")
def stream_gate(spark, d):
    """Events landed as CSV files, gated by a file stream into an exactly-once sink."""
    import dataclasses

    from sluice.streaming.gate_stream import accepted_from_sink, start_gate_stream
    e = events(spark, d)
    landing = write_csv(e, scratch_path(spark, "landing"))
    contract = dataclasses.replace(events_contract(e), corrupt_column="_corrupt_record")
    sink, ckpt = scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_ckpt")
    stream = start_gate_stream(spark, landing, contract, sink, ckpt)
    stream.query.awaitTermination()
    return accepted_from_sink(spark, sink, contract)


@register("full_flow")
def full_flow(spark, d):
    """Raw files, gate, two formats, load and answer as one job that raises on any failed check."""
    import dataclasses

    from sluice.functions.time import half_of_month
    from sluice.plans.flow import run_flow
    e = events(spark, d)
    contract = dataclasses.replace(events_contract(e), corrupt_column="_corrupt_record")
    raw_root = scratch_path(spark, "flow_raw")
    ingestion.land(e, raw_root, "2024-01-31")

    def answer(df):
        return profiles.seasonal_profile(df, "event_type", "value", half_of_month("ts"), F.hour("ts"))
    return run_flow(spark, raw_root, contract, scratch_path(spark, "flow"), "ts", SECOND_HALF_START, answer, ["event_type"])


@register("content_parity")
def content_parity(spark, d):
    """Whole CSV copy against whole Parquet copy: row count and content fingerprint."""
    from sluice.operators.checks import fingerprint_checks
    _, csv_df, pq_df = _two_formats(spark, d)
    return fingerprint_checks(pq_df, csv_df, ("parquet", "csv"))


@register("catalog_table")
def catalog_table(spark, d):
    """Two-batch load registered as a catalog table, then summarised through the catalog."""
    from sluice.sources.tables import register_catalog_table
    t = _lineitem_load(spark, d)[0]
    tbl = register_catalog_table(spark, "sluice_lake", "lineitem_loaded", t.path,
                                 database_location=scratch_path(spark, "warehouse"))
    return profiles.table_summary(tbl, "l_orderkey", "l_shipdate")
