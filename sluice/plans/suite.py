"""The query suite: every operator of the library applied to the driver's tables.

Each entry takes ``(spark, data_dir)`` and returns a DataFrame over whole
tables.  Events stand in for observations (entity ``event_type``, time
``ts``, measure ``value``); orders give multi-year seasons; lineitem is the
large fact for batch loads and key checks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.contract import Contract, Period, RangeRule, SameDay
from sluice.functions.time import half_of_month, half_open, months_in, season_of_month
from sluice.operators import dimension as dim_ops
from sluice.operators import profiles, quality
from sluice.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return wrap


# ---------------------------------------------------------------- fixed values
# Inline dimension for the partial join: three of the five event types, with a
# district and a UTC offset; 'signup' and 'error' stay unmatched.
EVENT_DIMENSION_ROWS = [("view", "A", 3), ("click", "B", 7), ("purchase", "A", 9)]
EVENT_DIMENSION_SCHEMA = "event_type string, district string, utc_offset_hours int"
SEASONS = {"winter": [12, 1, 2], "summer": [6, 7, 8]}
HOURLY_RANGE = ("2024-01-08", "2024-01-22")
EVENT_PERIOD = ("2024-01-01", "2024-01-25")
COMPLETENESS_PERIOD = ("2024-01-01", "2024-01-31")
SECOND_HALF_START = "2024-01-16"
LOAD_BOUNDARY = "1998-01-01"


def events(spark, d):
    return table(spark, d, "events")


def event_dimension(spark) -> DataFrame:
    return dim_ops.inline_dimension(spark, EVENT_DIMENSION_ROWS, EVENT_DIMENSION_SCHEMA)


def events_contract(df: DataFrame) -> Contract:
    """Contract over the events table: value in 0..100, ts inside the period."""
    return Contract(
        fields=df.schema,
        key=("event_id",),
        required=("ts", "event_type", "value"),
        blank=("event_type",),
        period=Period("ts", *EVENT_PERIOD),
        ranges=(RangeRule("value", 0.0, 100.0),),
        corrupt_column=None,
    )


def dirty_events(df: DataFrame) -> DataFrame:
    """Events with defects injected by value band (same bands in the oracle SQL).

    k: blank text in [2, 2.3), NULL in [2.3, 2.5); ts: NULL in [1, 1.3);
    d: the day after in [3, 3.3); v: NULL in [4, 4.3).  Every row is kept.
    """
    return df.selectExpr(
        "event_id",
        "CASE WHEN value >= 2.0 AND value < 2.3 THEN '  ' "
        "WHEN value >= 2.3 AND value < 2.5 THEN CAST(NULL AS STRING) ELSE event_type END AS k",
        "CASE WHEN value >= 1.0 AND value < 1.3 THEN NULL ELSE ts END AS ts",
        "CASE WHEN value >= 3.0 AND value < 3.3 THEN date_add(to_date(ts), 1) ELSE to_date(ts) END AS d",
        "CASE WHEN value >= 4.0 AND value < 4.3 THEN CAST(NULL AS DOUBLE) ELSE value END AS v",
    )


def dirty_contract(df: DataFrame) -> Contract:
    return Contract(
        fields=df.schema,
        key=("event_id",),
        required=("ts", "d", "k", "v"),
        blank=("k",),
        same_day=(SameDay("d", "ts"),),
        period=Period("ts", *EVENT_PERIOD),
        ranges=(RangeRule("v", 0.0, 100.0),),
        corrupt_column=None,
    )


def labelled_events(spark, d) -> tuple[DataFrame, Contract]:
    e = events(spark, d)
    c = events_contract(e)
    return quality.label(e, c), c


# ------------------------------------------------------------------ profiles
@register("seasonal_profile")
def seasonal_profile(spark, d):
    e = events(spark, d)
    return profiles.seasonal_profile(e, "event_type", "value", half_of_month("ts"), F.hour("ts"))


@register("seasonal_profile_orders")
def seasonal_profile_orders(spark, d):
    o = table(spark, d, "orders")
    return profiles.seasonal_profile(
        o, "o_orderpriority", "o_totalprice", season_of_month("o_orderdate", SEASONS),
        F.dayofmonth("o_orderdate"), where=months_in("o_orderdate", SEASONS), pos="day")


@register("hourly_profile")
def hourly_profile(spark, d):
    return profiles.hourly_profile(events(spark, d), "event_type", "ts", "value", *HOURLY_RANGE)


@register("local_profile")
def local_profile(spark, d):
    return profiles.local_profile(events(spark, d), event_dimension(spark), "event_type", "district",
                                  "utc_offset_hours", "ts", "value", half_of_month("ts"))


@register("value_at_extreme")
def value_at_extreme(spark, d):
    return profiles.value_at_extreme(events(spark, d), "event_type", "value", F.hour("ts"))


@register("distinct_text_list")
def distinct_text_list(spark, d):
    return profiles.distinct_positions(events(spark, d), "event_type", F.hour("ts"), F.col("value").isNotNull())


@register("control_aggregate")
def control_aggregate(spark, d):
    return profiles.control_aggregate(events(spark, d), "event_type", "value")


@register("table_summary")
def table_summary(spark, d):
    return profiles.table_summary(table(spark, d, "orders"), "o_custkey", "o_orderdate")


@register("entity_coverage")
def entity_coverage(spark, d):
    return quality.entity_coverage(events(spark, d), ["event_type"], "ts", "value")


@register("first_rows")
def first_rows(spark, d):
    return profiles.first_rows(events(spark, d), ["event_type", "ts", "event_id"],
                               ["event_type", "ts", "event_id", "value"], n=10)


@register("filtered_aggregate")
def filtered_aggregate(spark, d):
    e = events(spark, d)
    return profiles.filtered_aggregate(
        e, (F.col("event_type") == "purchase") & half_open(e, "ts", SECOND_HALF_START, None), "value")


@register("completeness")
def completeness(spark, d):
    return quality.completeness(events(spark, d), "event_type", "ts", *COMPLETENESS_PERIOD)


@register("completeness_roster")
def completeness_roster(spark, d):
    """Customers expected to order on a day of 1996: those without any order show up with 0."""
    o = table(spark, d, "orders")
    return quality.completeness(o, "o_custkey", "o_orderdate", "1996-03-01", "1996-03-02",
                                roster=table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")))


@register("duplicate_keys")
def duplicate_keys(spark, d):
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- dimensions
def nation_dimension(spark, d) -> DataFrame:
    """Every nation with its region's name."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner")
            .select("n_nationkey", "n_name", "r_name"))


def rollup_dimension(spark, d) -> DataFrame:
    """Nations outside region 4: the partially covering dimension of the rollups."""
    return table(spark, d, "nation").where(F.col("n_regionkey") != 4).select("n_nationkey", "n_name")


@register("reference_table")
def reference_table(spark, d):
    return dim_ops.register_dimension(nation_dimension(spark, d), "nation_reference").orderBy("n_nationkey")


@register("dimension_key_check")
def dimension_key_check(spark, d):
    return dim_ops.dimension_key_check(table(spark, d, "nation"), "n_nationkey")


def orders_by_nation(spark, d) -> DataFrame:
    """Order price partials per customer, with the customer's nation key attached.

    Orders are reduced to one row per customer before meeting the customer
    table; the partials stay hash-partitioned on the customer key, so a
    customer table too large to broadcast is the only side shuffled.
    """
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    per_customer = dim_ops.measure_partials(o, "o_custkey", "o_totalprice")
    return per_customer.join(c, per_customer["o_custkey"] == c["c_custkey"], "left")


@register("dimension_rollup")
def dimension_rollup(spark, d):
    return dim_ops.dimension_rollup(orders_by_nation(spark, d), rollup_dimension(spark, d),
                                    "c_nationkey", "n_nationkey", "n_name")


@register("rollup_with_nulls")
def rollup_with_nulls(spark, d):
    """Lineitem quantities per part brand, large ones unknown: the mean is over known values."""
    li = table(spark, d, "lineitem").selectExpr("l_partkey", "CASE WHEN l_quantity <= 30 THEN l_quantity END AS quantity")
    parts = table(spark, d, "part").select("p_partkey", "p_brand")
    return dim_ops.dimension_rollup(dim_ops.measure_partials(li, "l_partkey", "quantity"), parts, "l_partkey", "p_partkey", "p_brand")


@register("join_audit")
def join_audit(spark, d):
    return dim_ops.join_audit(events(spark, d), event_dimension(spark), "event_type")


# ------------------------------------------------------------- quality gate
@register("reject_reasons")
def reject_reasons(spark, d):
    lab, _ = labelled_events(spark, d)
    return lab.select("event_id", "event_type", "ts", "value", quality.REASON)


@register("reject_histogram")
def reject_histogram(spark, d):
    lab, _ = labelled_events(spark, d)
    return quality.reject_histogram(lab)


@register("accepted_rows")
def accepted_rows(spark, d):
    lab, c = labelled_events(spark, d)
    return quality.accepted(lab, c)


@register("rejected_rows")
def rejected_rows(spark, d):
    lab, _ = labelled_events(spark, d)
    return quality.rejected(lab)


@register("reconciliation")
def reconciliation(spark, d):
    lab, _ = labelled_events(spark, d)
    return quality.reconciliation(lab)


def _rule_query(prefix: str) -> Query:
    def run(spark, d):
        dirty = dirty_events(events(spark, d))
        return quality.rule_hits(dirty, dirty_contract(dirty), prefix, ["event_id"])
    return run


for _name, _prefix in [("rule_required", "missing:"), ("rule_blank_key", "blank:"),
                       ("rule_cross_column", "same_day:"), ("rule_period", "period:"),
                       ("rule_range", "range:")]:
    register(_name)(_rule_query(_prefix))


@register("null_profile")
def null_profile(spark, d):
    return quality.null_profile(dirty_events(events(spark, d)))


@register("csv_number_text")
def csv_number_text(spark, d):
    from sluice.functions.text import number_text
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     number_text("l_quantity").alias("quantity_text"),
                     number_text("l_discount").alias("discount_text"),
                     number_text("l_tax").alias("tax_text"))


__all__ = ["REGISTRY", "register"]
