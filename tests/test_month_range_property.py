import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.time import month_index, month_range

DAYS = st.integers(0, 800)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(a=DAYS, b=DAYS)
def test_month_range_equals_plain_filter(spark, a, b):
    base = dt.datetime(2023, 1, 1)
    start, end = sorted((base + dt.timedelta(days=a, hours=5), base + dt.timedelta(days=b)))
    rows = [(base + dt.timedelta(hours=7 * i),) for i in range(2900)]
    t = spark.createDataFrame(rows, "ts timestamp").withColumn("month_idx", month_index("ts"))
    s, e = start.strftime("%Y-%m-%d %H:%M:%S"), end.strftime("%Y-%m-%d %H:%M:%S")
    got = t.where(month_range(t, "ts", "month_idx", s, e)).count()
    want = t.where((F.col("ts") >= F.lit(s)) & (F.col("ts") < F.lit(e))).count()
    assert got == want
