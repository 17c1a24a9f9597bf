import datetime as dt

from pyspark.sql import functions as F

from sluice.functions.extremes import pos_of_max, pos_of_min
from sluice.functions.text import distinct_text_list, number_text
from sluice.functions.time import day_index, local_hour, month_index, month_range


def test_partition_indexes(spark):
    r = spark.createDataFrame([(dt.datetime(2024, 1, 15, 5),)], "ts timestamp").select(
        month_index("ts").alias("m"), day_index("ts").alias("d")).first()
    assert r["m"] == 648
    assert r["d"] == (dt.date(2024, 1, 15) - dt.date(1970, 1, 1)).days


def test_local_hour_negative_offset(spark):
    r = spark.createDataFrame([(dt.datetime(2024, 1, 1, 2), -5), (dt.datetime(2024, 1, 1, 22), 3)],
                              "ts timestamp, off int").select(local_hour("ts", "off").alias("h")).collect()
    assert [x["h"] for x in r] == [21, 1]


def test_number_text(spark):
    rows = spark.createDataFrame([(1.0,), (2.5,), (None,), (-3.0,)], "x double") \
        .select(number_text("x").alias("t")).collect()
    assert [r["t"] for r in rows] == ["1", "2.5", "", "-3"]


def test_distinct_text_list_is_text_ordered(spark):
    r = spark.createDataFrame([("a", 9), ("a", 19), ("a", 9)], "k string, h int") \
        .groupBy("k").agg(distinct_text_list("h").alias("l")).first()
    assert r["l"] == "19,9"


def test_extremes_break_ties_on_earliest(spark):
    df = spark.createDataFrame([(5, 1.0), (3, 1.0), (7, 2.0), (1, 2.0)], "p int, m double").repartition(4)
    r = df.agg(pos_of_min("p", "m").alias("lo"), pos_of_max("p", "m").alias("hi")).first()
    assert (r["lo"], r["hi"]) == (3, 1)


def test_month_range_adds_partition_predicate(spark, workdir):
    df = spark.createDataFrame([(dt.datetime(2024, m, 2), m) for m in range(1, 13)], "ts timestamp, v int") \
        .withColumn("month_idx", month_index("ts"))
    df.write.partitionBy("month_idx").parquet(workdir + "/t")
    t = spark.read.parquet(workdir + "/t")
    q = t.where(month_range(t, "ts", "month_idx", "2024-03-01", "2024-05-01"))
    assert sorted(r["v"] for r in q.collect()) == [3, 4]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_idx" in plan


def test_fingerprint_detects_changed_row(spark):
    from sluice.operators.checks import fingerprint_checks
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "id int, s string")
    b = spark.createDataFrame([(2, "y"), (1, "x"), (2, "y")], "s_id int, s string").withColumnRenamed("s_id", "id")
    c = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id int, s string")
    assert all(r["ok"] for r in fingerprint_checks(a, b.select("s", "id")).collect())
    assert [r["ok"] for r in fingerprint_checks(a, c).collect()] == [True, False]


def test_month_set_ranges_matches_month_filter_and_pushes(spark, workdir):
    from sluice.functions.time import month_set_ranges, months_in
    seasons = {"winter": [12, 1, 2], "summer": [6, 7, 8]}
    rows = [(dt.datetime(y, m, 15, 3),) for y in (2023, 2024) for m in range(1, 13)]
    spark.createDataFrame(rows, "ts timestamp").write.parquet(workdir + "/m")
    t = spark.read.parquet(workdir + "/m")
    exact = sorted(r["ts"] for r in t.where(months_in("ts", seasons)).collect())
    ranged = t.where(month_set_ranges("ts", [12, 1, 2, 6, 7, 8], 2023, 2024))
    assert sorted(r["ts"] for r in ranged.collect()) == exact
    assert "PushedFilters: [Or(" in ranged._jdf.queryExecution().executedPlan().toString()


def test_null_profile_empty_and_counts(spark):
    from sluice.operators.quality import null_profile
    empty = spark.createDataFrame([], "a int, b string")
    assert {(r["column_name"], r["nulls"], r["share"]) for r in null_profile(empty).collect()} == \
        {("a", 0, 0.0), ("b", 0, 0.0)}
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    got = {r["column_name"]: (r["nulls"], r["share"]) for r in null_profile(df).collect()}
    assert got == {"a": (1, 0.25), "b": (2, 0.5)}


def test_number_text_keeps_wide_decimals(spark):
    from sluice.functions.text import number_text
    df = spark.sql("SELECT CAST('12345678901234567.5' AS DECIMAL(20,2)) AS a, 2.0D AS b, CAST(NULL AS DOUBLE) AS c, 2.5D AS d")
    assert tuple(df.select(*[number_text(x) for x in "abcd"]).first()) == ("12345678901234567.50", "2", "", "2.5")


def test_fingerprint_tells_null_places_apart(spark):
    from sluice.operators.checks import fingerprint
    one, two = (spark.createDataFrame([r], "a int, b int") for r in ((1, None), (None, 1)))
    assert fingerprint(one).first() != fingerprint(two).first()


def test_rollup_mean_is_over_known_values(spark):
    from sluice.operators.dimension import dimension_rollup, measure_partials
    facts = spark.createDataFrame([("a", 10.0), ("a", None)], "k string, v double")
    row = dimension_rollup(measure_partials(facts, "k", "v"), spark.createDataFrame([("a", "g")], "k string, g string"), "k", "k", "g").first()
    assert (row["observations"], row["mean_value"]) == (2, 10.0)


def test_audit_of_no_facts_is_all_zero(spark):
    from sluice.operators.dimension import join_audit
    none = spark.createDataFrame([], "k string")
    assert tuple(join_audit(none, spark.createDataFrame([("a",)], "k string"), "k").first()) == (0, 0, 0, 0)


def test_completeness_keeps_silent_entities(spark):
    from sluice.operators.quality import completeness
    rows = [("a", dt.datetime(2024, 1, 1, 5)), ("b", dt.datetime(2023, 1, 1))]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    got = [tuple(r) for r in completeness(df, "k", "ts", "2024-01-01", "2024-01-02").collect()]
    assert got == [("a", 24, 1, 23), ("b", 24, 0, 24)]
    roster = spark.createDataFrame([("a",), ("c",)], "k string")
    assert [r["k"] for r in completeness(df, "k", "ts", "2024-01-01", "2024-01-02", roster).collect()] == ["a", "c"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest

    from sluice.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())


def test_season_pivot_sorts_missing_as_zero(spark):
    from sluice.operators.profiles import season_pivot
    prof = spark.createDataFrame([("a", "summer", 2.0), ("a", "winter", 1.0), ("b", "winter", 5.0),
                                  ("c", "summer", 3.5)], "city string, season string, amplitude double")
    rows = [tuple(r) for r in season_pivot(prof, "city", ["summer", "winter"]).collect()]
    assert rows == [("c", 3.5, None), ("a", 2.0, 1.0), ("b", None, 5.0)]


def test_first_rows_is_top_k(spark):
    from __spark_entry__ import queries
    df = queries()["first_rows"](spark, "/root/testdata/sf0.001")
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 10
