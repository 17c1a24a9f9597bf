import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from sluice.operators.checks import CheckFailed
from sluice.plans import batches


def make(spark):
    rows = [(i, dt.datetime(2024, 1 + (i % 4), 1 + (i % 20), i % 24)) for i in range(200)]
    return spark.createDataFrame(rows, "id long, ts timestamp")


def test_two_batch_load_and_ledger(spark, workdir):
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    checks, r1, r2 = batches.two_batch_load(make(spark), t, "2024-03-01")
    assert all(r["ok"] for r in checks.collect())
    led = batches.ledger(spark, t).collect()
    assert [(r["load_no"], r["parent_load_no"], r["operation"]) for r in led] == [(1, None, "overwrite"), (2, 1, "append")]
    assert led[-1]["total_records"] == 200
    inv = batches.partition_inventory(spark, t.path).collect()
    assert [r["month_idx"] for r in inv] == [648, 649, 650, 651] and sum(r["record_count"] for r in inv) == 200


def test_append_adds_and_replace_replaces(spark, workdir):
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    df = make(spark)
    first, second = batches.split_batches(df, "ts", "2024-03-01")
    batches.load_batch(first, t, "overwrite")
    batches.load_batch(second, t, "append")
    assert all(r["ok"] for r in batches.load_key_check(spark, t.path, ["id"], df).collect())
    late = second.where("id % 10 = 2").withColumn("id", F.col("id") + 1000)
    r = batches.load_batch(late, t, "append")  # rows of a month that is loaded already
    assert spark.read.parquet(t.path).count() == 200 + late.count() == r["total"]
    assert not all(x["ok"] for x in batches.load_key_check(spark, t.path, ["id"], df).collect())
    r = batches.load_batch(second, t, "replace_partitions")
    assert spark.read.parquet(t.path).count() == 200 == r["total"] and r["partitions"] == r["files"] == 2
    led = batches.ledger(spark, t).collect()
    assert [x["total_records"] for x in led] == [100, 200, 200 + late.count(), 200]


def test_loads_refuse_rows_without_time(spark, workdir):
    df = make(spark).union(spark.createDataFrame([(999, None)], "id long, ts timestamp"))
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    with pytest.raises(CheckFailed):
        batches.two_batch_load(df, t, "2024-03-01")
    with pytest.raises(ValueError):
        batches.load_batch(df, t, "append")
    assert os.listdir(workdir) == []


def test_failed_overwrite_keeps_the_table(spark, workdir):
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    batches.load_batch(make(spark), t, "overwrite")
    broken = make(spark).withColumn("id", F.when(F.col("id") == 150, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")))
    with pytest.raises(Exception):
        batches.load_batch(broken, t, "overwrite")
    assert spark.read.parquet(t.path).count() == 200


def test_files_follow_partitions_not_tasks(spark, workdir):
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    r = batches.load_batch(make(spark).repartition(16), t, "overwrite")
    assert r["files"] == r["partitions"] == 4


def test_range_prunes_partitions(spark, workdir):
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    batches.load_batch(make(spark), t, "overwrite")
    part = batches.table_range(spark, t, "2024-02-10", "2024-03-05")
    want = make(spark).where("ts >= '2024-02-10' AND ts < '2024-03-05'").count()
    assert part.count() == want
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month_idx", plan)


def test_misaligned_boundary_refused(spark, workdir):
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    with pytest.raises(ValueError):
        batches.two_batch_load(make(spark), t, "2024-03-15")


def test_batch_coverage_flags_null_times(spark):
    df = make(spark).union(spark.createDataFrame([(999, None)], "id long, ts timestamp"))
    rows = {r["check"]: r["ok"] for r in batches.batch_coverage(df, "ts", "2024-03-01").collect()}
    assert rows["batches_cover_input"] is False
    assert F is not None


def test_failed_load_leaves_no_ledger_row(spark, workdir):
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    df = make(spark)
    first, second = batches.split_batches(df, "ts", "2024-03-01")
    batches.load_batch(first, t, "overwrite")
    broken = second.withColumn("id", F.when(F.col("id") == 150, F.raise_error(F.lit("bad row")))
                               .otherwise(F.col("id")))
    with pytest.raises(Exception):
        batches.load_batch(broken, t, "append")
    led = batches.ledger(spark, t).collect()
    assert [r["load_no"] for r in led] == [1]
    assert spark.read.parquet(t.path).count() == first.count()


def test_ledger_and_struct_inventory(spark, workdir):
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    batches.two_batch_load(make(spark), t, "2024-03-01")
    hist = batches.ledger(spark, t).collect()
    assert [(r["operation"], r["added_records"], r["total_records"]) for r in hist] == \
        [("overwrite", 100, 100), ("append", 100, 200)]
    assert hist[0]["committed_at"] <= hist[1]["committed_at"]
    inv = batches.partition_inventory(spark, t.path, struct_name="observed_at_month").collect()
    assert inv[0]["partition"]["observed_at_month"] == 648 and inv[0]["file_count"] >= 1


def test_sweep_names_gaps_and_overlaps(spark, workdir):
    from sluice.operators.checks import CheckFailed
    df = spark.createDataFrame([(1, "2024-01-15"), (2, "2024-02-10"), (3, "2024-03-05"), (4, "2024-04-01"), (5, None)], "id long, d string").withColumn(
        "ts", F.to_timestamp("d")).drop("d")
    known = df.where("ts IS NOT NULL")
    B = batches.Batch
    bad = [B("a", None, "2024-02-01"), B("b", "2024-02-01", "2024-03-01"), B("c", "2024-02-05", "2024-03-01"), B("d", "2024-03-10", None)]
    found = [tuple(r) for r in batches.sweep_batches(df, "ts", bad).orderBy("start").collect()]
    assert found == [(None, None, "", "no time", 1), ("2024-02-05", "2024-03-01", "b,c", "overlap", 1), ("2024-03-01", "2024-03-10", "", "gap", 1)]
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    with pytest.raises(CheckFailed, match="overlap 2024-02-05 to 2024-03-01"):
        batches.load_batches(known, t, bad)
    assert not os.path.exists(t.path)
    good = [B("a", None, "2024-02-01"), B("b", "2024-02-01", "2024-03-01"), B("c", "2024-03-01", "2024-04-01"), B("d", "2024-04-01", None)]
    assert [r["total"] for r in batches.load_batches(known, t, good)] == [1, 2, 3, 4]
    assert batches.sweep_batches(known, "ts", [B("all", None, None)]).count() == 0
    assert [r["finding"] for r in batches.sweep_batches(known, "ts", []).collect()] == ["gap"]


def test_totals_follow_the_table(spark, workdir):
    """The ledger's totals come from touched partitions; they equal a count of the table."""
    t = batches.PartitionedTable(os.path.join(workdir, "t"), "ts", "month")
    df = make(spark)
    for rows, operation in [(df, "overwrite"), (df.where("month(ts) = 3"), "append"), (df.where("month(ts) <= 3").limit(5), "replace_partitions"), (df.limit(7), "append"),
                            (df.where("month(ts) = 2"), "overwrite")]:
        done = batches.load_batch(rows, t, operation)
        assert done["total"] == spark.read.parquet(t.path).count()
    files = sum(f.endswith(".parquet") for _, _, fs in os.walk(t.path) for f in fs)
    assert batches.load_batch(df.where("month(ts) = 2"), t, "append")["files"] + files == sum(f.endswith(".parquet") for _, _, fs in os.walk(t.path) for f in fs)
