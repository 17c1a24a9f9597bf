"""Contract of the small dirty CSV used by several tests."""

from pyspark.sql import types as T

from sluice.contract import Contract, Period, RangeRule, SameDay


def fixture_contract() -> Contract:
    """The small dirty-CSV contract used by the tests (k, ts, d, v, i)."""
    return Contract(
        fields=T.StructType([
            T.StructField("k", T.StringType()),
            T.StructField("ts", T.TimestampType()),
            T.StructField("d", T.DateType()),
            T.StructField("v", T.DoubleType()),
            T.StructField("i", T.IntegerType()),
        ]),
        key=("k", "ts"),
        required=("ts", "d", "k", "v"),
        blank=("k",),
        same_day=(SameDay("d", "ts"),),
        period=Period("ts", "2024-01-01", "2025-01-01"),
        ranges=(RangeRule("v", -90.0, 60.0), RangeRule("i", 0, 100)),
    )
