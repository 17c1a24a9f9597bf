"""Managed, bucketed tables: no exchange on the bucket key, partitions pruned by a dimension."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from sluice.operators import quality
from sluice.plans import catalog


@pytest.fixture()
def managed(spark, workdir):
    database = f"db_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, database, workdir)
    lines = catalog.ManagedTable(database, "lines", "k", buckets=4, ts="ts")
    orders = catalog.ManagedTable(database, "orders", "k", buckets=4)
    rows = spark.range(3000).select((F.col("id") % 700).alias("k"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7200).alias("ts"), F.col("id").alias("v"))
    catalog.create_as_select(rows.where("v < 1500"), lines)
    catalog.insert_into(rows.where("v >= 1500").select("v", "ts", "k"), lines)
    catalog.create_as_select(spark.range(700).select(F.col("id").alias("k"), F.lit("x").alias("name")), orders)
    return rows, lines, orders


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_batches_add_up(spark, managed):
    rows, lines, _ = managed
    loaded = spark.table(lines.full_name)
    assert loaded.select(*rows.columns).exceptAll(rows).count() == 0 and loaded.count() == 3000
    catalog.create_as_select(rows.where("v < 10"), lines)  # made anew
    assert spark.table(lines.full_name).count() == 10


def test_bucket_key_needs_no_exchange(spark, managed):
    _, lines, orders = managed
    loaded = spark.table(lines.full_name)
    assert "Exchange" not in plan(quality.duplicate_keys(loaded, ["k", "v"]))
    joined = plan(loaded.hint("merge").join(spark.table(orders.full_name), "k"))
    assert "SortMergeJoin" in joined and "Exchange" not in joined
    assert quality.duplicate_keys(loaded.unionByName(loaded.where("v < 3")).drop("ts"), ["k", "v"]).count() == 3


def test_large_batches_have_more_writers(spark, managed, monkeypatch):
    """No writer sorts much more than its share, however few the buckets are; these still hold their keys."""
    monkeypatch.setattr(catalog, "WRITER_ROWS", 50, raising=False)
    rows, lines, orders = managed
    catalog.create_as_select(rows.where("v < 1500"), lines)
    catalog.insert_into(rows.where("v >= 1500"), lines)
    catalog.create_as_select(spark.range(700).select(F.col("id").alias("k"), F.lit("x").alias("name")), orders)
    for name, total in ((lines.full_name, 3000), (orders.full_name, 700)):
        loaded = spark.table(name).withColumn("file", F.input_file_name())
        writer = F.regexp_extract("file", r"part-(\d+-[0-9a-f-]{36})", 1)
        sizes = [r["count"] for r in loaded.groupBy(writer).count().collect()]
        assert sum(sizes) == total and max(sizes) <= 250
        bucket = F.regexp_extract("file", r"_(\d+)\.c", 1).cast("int")
        assert loaded.where(bucket != F.expr("pmod(hash(k), 4)")).count() == 0
    loaded = spark.table(lines.full_name)
    assert loaded.select(*rows.columns).exceptAll(rows).count() == 0
    joined = loaded.hint("merge").join(spark.table(orders.full_name), "k")
    assert joined.count() == 3000 and "Exchange" not in plan(joined)


def test_a_filtered_dimension_prunes_partitions(spark, managed):
    rows, lines, _ = managed
    months = rows.groupBy(((F.year("ts") - 1970) * 12 + F.month("ts") - 1).cast("int").alias("m")).agg(F.min("ts").alias("since"))
    chosen = months.where("month(since) = 3")
    pruned = catalog.pruned_by(spark.table(lines.full_name), "month_idx", chosen, "m")
    assert "dynamicpruning" in plan(pruned)
    assert pruned.select(*rows.columns).exceptAll(rows.where("month(ts) = 3")).count() == 0
    assert pruned.count() == rows.where("month(ts) = 3").count()
    files = re.findall(r"number of files read: (\d+)", pruned._jdf.queryExecution().toString())
    assert not files or int(files[0]) <= 8
