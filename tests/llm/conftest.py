import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """The tables here have at most a thousand rows."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    yield
    spark.conf.set(name, before)
