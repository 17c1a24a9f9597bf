"""Key counts by bitmaps, filter and footers equal the plain aggregates."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import keys, quality


def table(spark, values, parts=4):
    return spark.createDataFrame([(v, "a" if (v or 0) % 2 else "b") for v in values], "k long, s string").repartition(parts)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-70_000, 70_000), st.sampled_from([0, 1, -1, 32767, 32768, 32769, -32768])), max_size=60))
def test_bitmaps_count_exactly(spark, values):
    got = keys.distinct_by_bitmap(table(spark, values), "k").first()
    assert tuple(got) == (len(values), len({v for v in values if v is not None}))


def test_groups_sparse_keys_and_empty_tables(spark):
    t = table(spark, [1, 1, 2, None, 2**62, -2**62, 5])
    assert {tuple(r) for r in keys.distinct_by_bitmap(t, "k", ["s"]).collect()} == {("a", 3, 2), ("b", 4, 3)}
    assert tuple(keys.distinct_keys(t, "k").first()) == (7, 5)
    assert "bitmap" not in keys.distinct_keys(t, "k")._jdf.queryExecution().executedPlan().toString()  # far apart: counted one by one
    assert tuple(keys.distinct_keys(t.limit(0), "k").first()) == (0, 0)


def test_bitmap_shuffle_does_not_grow_with_rows(spark):
    plan = keys.distinct_by_bitmap(spark.range(0, 100_000, 1, 4).select((F.col("id") % 50).alias("k")), "k")
    partial = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in partial
    assert tuple(plan.first()) == (100_000, 50)


@pytest.mark.parametrize("bits", [None, 15, 4])
def test_duplicates_in_two_passes(spark, bits):
    t = table(spark, [*range(3000), 5, 5, 17, None, None, 2999], 5)
    found = {tuple(r) for r in keys.duplicate_keys(t, ["k"], bits).collect()}
    assert found == {(5, 3), (17, 2), (None, 2), (2999, 2)} == {tuple(r) for r in quality.duplicate_keys(t, ["k"]).collect()}
    assert keys.duplicate_keys(t.where("k < 5"), ["k"], bits).count() == 0 == keys.duplicate_keys(t.limit(0), ["k"], bits).count()


def test_suspects_are_few(spark):
    t = table(spark, [*range(20_000), 1, 2, 3], 4)
    bits = 18
    suspects = {r["slot"] for r in keys.suspect_slots(t, ["k"], bits).collect()}
    assert suspects >= {r[0] for r in t.where("k in (1, 2, 3)").select(keys.slots_of(t, ["k"], bits)).collect()}
    assert t.select(keys.slots_of(t, ["k"], bits).alias("slot")).where(F.col("slot").isin(list(suspects))).count() < 0.2 * 20_000


def test_footers_answer_without_reading_rows(spark, workdir):
    t = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), F.lit("2024-02-03").cast("date").alias("d"))
    t.repartition(3).write.parquet(f"{workdir}/t")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = keys.footer_stats(spark, f"{workdir}/t", ["k", "d"])
    assert "PushedAggregation: [COUNT(*), COUNT(k), MIN(k), MAX(k)" in got._jdf.queryExecution().executedPlan().toString()
    assert tuple(got.first())[:4] == (1000, 900, 1, 999)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
