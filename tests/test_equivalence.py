"""The pre-aggregated plans give the same answers as the naive join-then-aggregate forms."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.extremes import pos_of_max, pos_of_min
from sluice.functions.text import distinct_text_list
from sluice.operators import dimension, profiles

KEYS = ["a", "b", "c", "d", None]
facts = st.lists(st.tuples(st.sampled_from(KEYS), st.integers(0, 47), st.one_of(st.none(), st.integers(-50, 50))), min_size=1, max_size=60)
dims = st.lists(st.tuples(st.sampled_from(KEYS[:4]), st.sampled_from(["X", "Y"]), st.integers(-3, 12)),
                min_size=0, max_size=6)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _facts(spark, rows):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(k, base + dt.timedelta(hours=h), None if v is None else float(v)) for k, h, v in rows],
                                 "k string, ts timestamp, v double")


@SETTINGS
@given(rows=facts, dim_rows=dims)
def test_join_audit_equals_naive(spark, rows, dim_rows):
    f = _facts(spark, rows)
    d = spark.createDataFrame(dim_rows, "k string, grp string, off int")
    got = dimension.join_audit(f, d, "k").first().asDict()
    j = f.alias("f").join(d.alias("d"), F.col("f.k") == F.col("d.k"), "left")
    naive = j.agg(F.count(F.lit(1)).alias("after_join"),
                  F.count_if(F.col("d.k").isNull()).alias("unmatched_rows"),
                  F.count_distinct(F.when(F.col("d.k").isNull(), F.col("f.k"))).alias("unmatched_keys")).first()
    assert got["before_join"] == len(rows)
    assert got["after_join"] == naive["after_join"]
    assert got["unmatched_rows"] == naive["unmatched_rows"]
    assert got["unmatched_keys"] == naive["unmatched_keys"]


@SETTINGS
@given(rows=facts, dim_rows=dims)
def test_local_profile_equals_join_first(spark, rows, dim_rows):
    f = _facts(spark, rows)
    # one row per key in the dimension (the key check requires it)
    uniq = {}
    for k, g, o in dim_rows:
        uniq.setdefault(k, (k, g, o))
    d = spark.createDataFrame(list(uniq.values()), "k string, grp string, off int")
    season = F.when(F.dayofmonth("ts") <= 1, F.lit("first")).otherwise(F.lit("second"))
    got = sorted(tuple(r) for r in profiles.local_profile(f, d, "k", "grp", "off", "ts", "v", season).collect())
    j = f.join(d, "k", "inner")
    l1 = j.groupBy("grp", "k", season.alias("season"),
                   F.pmod(F.hour("ts") + F.col("off"), F.lit(24)).cast("int").alias("hl")).agg(F.avg("v").alias("m"))
    l2 = l1.groupBy("grp", "k", "season").agg((F.max("m") - F.min("m")).alias("amp"),
                                                pos_of_min("hl", "m").alias("lo"), pos_of_max("hl", "m").alias("hi"))
    naive = l2.groupBy("grp", "season").agg(
        F.count(F.lit(1)), F.round(F.avg("amp"), 2), F.round(F.min("amp"), 2), F.round(F.max("amp"), 2),
        distinct_text_list("lo"), distinct_text_list("hi"))
    assert got == sorted(tuple(r) for r in naive.collect())


@SETTINGS
@given(rows=facts, dim_rows=dims)
def test_rollup_from_partials_equals_naive(spark, rows, dim_rows):
    f = _facts(spark, rows)
    uniq = {}
    for k, g, o in dim_rows:
        uniq.setdefault(k, (k, g))
    d = spark.createDataFrame(list(uniq.values()), "k string, grp string")
    got = sorted(tuple(r) for r in dimension.dimension_rollup(
        dimension.measure_partials(f, "k", "v"), d, "k", "k", "grp").collect())
    j = f.alias("f").join(d.alias("d"), F.col("f.k") == F.col("d.k"), "left")
    naive = j.groupBy(F.coalesce(F.col("d.grp"), F.lit("Unmatched")).alias("grp")).agg(
        F.count_distinct(F.col("f.k")), F.count(F.lit(1)),
        F.round(F.avg(F.col("f.v").cast("decimal(18,6)")), 2).cast("double"),
        F.round(F.min("f.v"), 1), F.round(F.max("f.v"), 1))
    assert got == sorted(tuple(r) for r in naive.collect())
