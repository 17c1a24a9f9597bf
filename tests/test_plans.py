"""Plan shape: partial aggregation before every shuffle of fact rows, pushdown, no cross joins."""

import re

from __spark_entry__ import queries
from sluice.plans import suite

SF = "/root/testdata/sf0.001"
QS = queries()


def plan(spark, name):
    return QS[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_profiles_shuffle_partial_aggregates_only(spark):
    for name in ["hourly_profile", "seasonal_profile", "local_profile", "dimension_rollup", "join_audit",
                 "completeness", "control_aggregate", "duplicate_keys", "null_profile"]:
        p = plan(spark, name)
        # every hash exchange's child is a (partial) aggregate, never a raw scan
        for m in re.finditer(r"Exchange hashpartitioning[^\n]*\n\s*\+- ([^\n]*)", p):
            child = m.group(1)
            if "Project" in child:  # a renaming projection: what it projects must be aggregated
                child = p[m.start(1):].split("\n")[1]
            small = name == "dimension_rollup" and ("Filter" in child or "customer" in child or "nation" in child)
            assert "Aggregate" in child or small, (name, child)
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_time_bounds_are_pushed(spark):
    for name, ts in [("hourly_profile", "ts"), ("completeness_roster", "o_orderdate")]:
        p = plan(spark, name)
        assert re.search(rf"PushedFilters: \[IsNotNull\({ts}\), GreaterThanOrEqual\({ts},", p), name


def test_completeness_reads_its_table_once(spark):
    assert plan(spark, "completeness").count("FileScan") == 1


def test_season_filter_takes_no_job_and_any_year(spark):
    from pyspark.sql import functions as F

    from sluice.functions.time import month_set_ranges, months_in
    rows = spark.createDataFrame([("2024-01-05",), ("9999-12-31",), ("0001-07-01",), ("2024-04-01",)], "d string").select(F.to_timestamp("d").alias("ts"))
    seasons = {"winter": [12, 1, 2], "summer": [6, 7, 8]}
    assert rows.where(months_in("ts", seasons)).count() == 3
    assert rows.where(months_in("ts", seasons) & month_set_ranges("ts", [12, 1, 2, 6, 7, 8], 1, 9999)).count() == 3


def test_column_pruning(spark):
    p = plan(spark, "control_aggregate")
    assert "ReadSchema: struct<event_type:string,value:double>" in p


def test_shuffle_joins_take_aggregated_inputs(spark):
    """With broadcast off, the join audit and the rollup join per-key aggregates."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ["join_audit", "dimension_rollup"]:
            p = plan(spark, name)
            assert "SortMergeJoin" in p, name
            fact_scans = re.findall(r"FileScan parquet \[([^\]]*)\]", p)
            assert fact_scans, name
            # the fact side reaches its exchange only through a partial aggregate
            for m in re.finditer(r"Exchange hashpartitioning\((o_custkey|event_type)[^\n]*\n\s*\+- ([^\n]*)", p):
                assert "HashAggregate" in m.group(2), (name, m.group(2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_key_results(spark):
    """One key holding a third of the rows: audit and profile results stay exact."""
    from pyspark.sql import functions as F
    from sluice.operators import dimension
    base = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("k"), (F.col("id") % 24).alias("h"), (F.col("id") % 11).cast("double").alias("v"))
    dim = spark.createDataFrame([("hot", "A"), ("k1", "B")], "k string, grp string")
    a = dimension.join_audit(base, dim, "k").first()
    assert (a["before_join"], a["after_join"]) == (30000, 30000)
    assert a["unmatched_rows"] == 30000 - 10000 - base.where("k = 'k1'").count()


def test_every_query_scans_files(spark):
    """Each registered query reads the given tables or files Spark wrote from them."""
    for name in sorted(suite.REGISTRY):
        p = plan(spark, name)
        assert "FileScan" in p or "BatchScan parquet" in p, name
