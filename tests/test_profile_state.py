"""Answers from kept state equal the full queries, after loads of every kind."""

import pytest
from pyspark.sql import functions as F

from sluice.functions.time import half_of_month
from sluice.operators import dimension, profiles, quality
from sluice.plans import profile_state
from sluice.plans.batches import PartitionedTable, load_batch


def rows(spark, start, days, shift=0.0):
    return spark.range(start * 48, (start + days) * 48).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("ts"), (F.col("id") % 3).cast("string").alias("who"),
        F.when(F.col("id") % 13 != 0, (F.col("id") * 37 % 101) / 4 + shift).alias("v"))


def same(a, b):
    assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]


def test_answers_after_loads_and_a_replaced_partition(spark, workdir):
    state = profile_state.ProfileState(PartitionedTable(f"{workdir}/t", "ts", "day"), "who", "v", half_of_month)
    dim = dimension.inline_dimension(spark, [("0", "A", 3), ("1", "B", -2)], "who string, district string, off int")

    def check():
        t = spark.read.parquet(state.table.path)
        same(profile_state.coverage(spark, state), quality.entity_coverage(t, ["who"], "ts", "v"))
        same(profile_state.hourly(spark, state), profiles.hourly_profile(t, "who", "ts", "v", None, None))
        same(profile_state.seasonal(spark, state), profiles.seasonal_profile(t, "who", "v", half_of_month("ts"), F.hour("ts")))
        same(profile_state.local(spark, state, dim, "district", "off"), profiles.local_profile(t, dim, "who", "district", "off", "ts", "v", half_of_month("ts")))
        assert [r["ok"] for r in profile_state.check_state(spark, state).collect()] == [True, True]

    profile_state.load_with_state(rows(spark, 0, 10), state, "overwrite")
    profile_state.load_with_state(rows(spark, 8, 10, 1.0), state, "append")
    profile_state.load_with_state(rows(spark, 9, 1, 50.0).where("who <> '2'"), state, "replace_partitions")
    check()
    profile_state.load_with_state(rows(spark, 9, 1, -3.0), state, "append")
    check()
    load_batch(rows(spark, 20, 1), state.table, "append")  # a load without its state
    assert [r["ok"] for r in profile_state.check_state(spark, state).collect()] == [False, False]
    profile_state.rebuild_state(spark, state)
    same(profile_state.coverage(spark, state), quality.entity_coverage(spark.read.parquet(state.table.path), ["who"], "ts", "v"))
    profile_state.load_with_state(rows(spark, 3, 2), state, "overwrite")
    check()


def test_a_load_reads_its_batch_alone(spark, workdir):
    state = profile_state.ProfileState(PartitionedTable(f"{workdir}/t", "ts", "day"), "who", "v", half_of_month)
    profile_state.load_with_state(rows(spark, 0, 3), state, "overwrite")
    kept = spark.read.parquet(state.path)
    assert kept.count() == 3 * 48 and kept.where("rows > 1").count() == 0  # two rows an hour, three entities in turn
    plan = profile_state.seasonal(spark, state)._jdf.queryExecution().executedPlan().toString()
    assert f"{workdir}/t__profile" in plan and f"{workdir}/t]" not in plan


@pytest.mark.parametrize("value, text", [("10000000000000000000000", "10000000000000000000000"), ("12.50", "12.50"), ("7.00", "7"), (None, "")])
def test_number_text_of_wide_decimals(spark, value, text):
    from sluice.functions.text import number_text
    assert spark.range(1).select(number_text(F.lit(value).cast("decimal(38,2)"))).first()[0] == text
