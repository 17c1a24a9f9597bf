"""Fingerprint trees: equal for equal rows, and every differing row is found."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import difference


def table(spark):
    return spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("s"), F.when(F.col("id") % 11 != 0, F.col("id") / 3).alias("x"))


def rows_of(frame):
    return sorted(((r["k"], r["side"], r["copies"], r["status"]) for r in frame.collect()), key=repr)


def test_planted_differences_are_found_exactly(spark):
    left = table(spark)
    right = (left.where("k not in (5, 6)").withColumn("x", F.when(F.col("k") == 77, None).otherwise(F.col("x")))
             .withColumn("s", F.when(F.col("k") == 0, "other").otherwise(F.col("s"))).unionByName(left.where("k = 9"))
             .unionByName(left.where("k < 2").withColumn("k", F.col("k") + 10**6)).repartition(5).select("x", "k", "s"))
    found = rows_of(difference.row_differences(left, right, ["k"]))
    assert found == sorted([(5, "left", 1, "missing"), (6, "left", 1, "missing"), (0, "left", 1, "changed"), (0, "right", 1, "changed"), (9, "right", 1, "extra"),
                            (10**6, "right", 1, "extra"), (10**6 + 1, "right", 1, "extra")], key=repr)  # x of 77 was NULL already


def test_nulls_repeated_keys_and_empty_copies(spark):
    schema = "k long, v string"
    left = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (2, "x"), (2, "y")], schema)
    right = spark.createDataFrame([(None, "a"), (1, None), (2, "y"), (2, "z"), (2, "z")], schema)
    assert rows_of(difference.row_differences(left, right, ["k"])) == sorted(
        [(None, "left", 1, "missing"), (2, "left", 1, "changed"), (2, "right", 2, "changed")], key=repr)
    assert difference.row_differences(left, left, ["k"]).count() == 0
    assert len(rows_of(difference.row_differences(left.limit(0), right, ["k"]))) == 4
    assert difference.row_differences(left.limit(0), right.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError, match="columns differ"):
        difference.row_differences(left, right.withColumnRenamed("v", "w"), ["k"])


def test_only_differing_buckets_are_descended_into(spark, workdir):
    left = table(spark)
    right = left.where("k != 123")
    trees = [difference.read_tree(spark, difference.write_tree(difference.fingerprint_tree(t, ["k"]), f"{workdir}/{n}")) for n, t in enumerate((left, right))]
    counts = {r["level"]: r["rows"] for r in trees[0].groupBy("level").agg(F.sum("rows").alias("rows")).collect()}
    assert counts == {level: 4000 for level in range(difference.LEVELS + 1)}
    assert trees[0].count() <= sum(difference.FAN ** level for level in range(difference.LEVELS + 1))
    path = difference.differing_buckets(*trees).orderBy("level").collect()
    assert [r["level"] for r in path] == [0, 1, 2, 3] and all(r["left_rows"] == r["right_rows"] + 1 for r in path)
    assert rows_of(difference.row_differences(left, right, ["k"], tuple(trees))) == [(123, "left", 1, "missing")]
    assert difference.differing_buckets(trees[0], trees[0]).count() == 0
