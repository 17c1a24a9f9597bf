"""Row-level joins: same rows as a plain join, and no task with a hot key's rows alone."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import enrich


@pytest.fixture()
def many_partitions(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def facts(spark, n=6000):
    """A third of the rows has key 1, a tenth none, the rest spread over 500 keys."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500).cast("int").alias("k"))


def dimension(spark):
    d = spark.range(0, 600, 2).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    return d.unionByName(spark.createDataFrame([(1, "one"), (1, "again"), (None, "nothing")], "key long, name string"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, many_partitions, how):
    f, d = facts(spark), dimension(spark).withColumnRenamed("key", "k")
    found, plain = enrich.skew_join(f, d, ["k"], how), f.join(d, "k", how)
    assert found.columns == plain.columns
    assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0


def test_no_task_holds_a_hot_key(spark, many_partitions):
    f = facts(spark)
    sizes = [r["count"] for r in enrich.enrich(f, dimension(spark), "k", "key").groupBy(F.spark_partition_id()).count().collect()]
    rows = f.join(dimension(spark).withColumnRenamed("key", "k"), "k", "left").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in rows) > 4000  # key 1 twice: all in one task
    assert len(sizes) == 16 and max(sizes) < 2 * sorted(sizes)[8]


def test_hot_keys_are_found_and_bounded(spark):
    hot = dict(enrich.hot_keys(facts(spark), ["k"], pieces=16))
    one, none = (spark.range(1).select(F.xxhash64(F.lit(v).cast("int"))).first()[0] for v in (1, None))
    assert hot[one] >= 5 * enrich.FINER and len(hot) == 2 and hot[none] < hot[one] / 3
    assert enrich.hot_keys(spark.range(1000), ["id"], pieces=8) == []
    assert len(enrich.hot_keys(spark.range(5000).select(F.col("id") % 2000), ["(id % 2000)"], pieces=100000)) <= enrich.MOST_HOT
    assert enrich.hot_keys(facts(spark).limit(0), ["k"]) == []


def test_enriched_rows_and_audit(spark, many_partitions):
    f = facts(spark)
    e = enrich.enrich(f, dimension(spark), "k", "key")
    assert e.columns == ["id", "k", "name", "matched"]
    assert e.where("k is null and (matched or name is not null)").count() == 0
    audit = enrich.enrichment_audit(f, e, "k").first()
    lost = f.join(dimension(spark), F.col("k") == F.col("key"), "left_anti")
    assert tuple(audit) == (6000, e.count(), lost.count(), lost.select("k").distinct().where("k is not null").count(), e.count() - 6000)
    with pytest.raises(ValueError, match="both sides"):
        enrich.enrich(f, dimension(spark).withColumnRenamed("name", "id"), "k", "key")
    with pytest.raises(ValueError, match="unknown join"):
        enrich.skew_join(f, f, ["k"], "cross")
    assert enrich.enrichment_audit(f.limit(0), e.limit(0), "k").first()["rows_after"] == 0
