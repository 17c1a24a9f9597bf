"""Suite entries of operators made for large tables: row-level enrichment, located
differences, digests of any size, profiles kept up per load.

Each entry runs its operator over whole tables; what it needs besides (a spoilt
copy, a dimension with gaps and repeats) Spark derives from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.time import half_of_month, month_index
from sluice.operators import difference, enrich, keys, profiles, quality
from sluice.plans import batches, catalog, profile_state
from sluice.plans.suite import LOAD_BOUNDARY, event_dimension, events, register
from sluice.plans.suite_files import _by_day, _daily_rows, _once
from sluice.session import scratch_path
from sluice.sources import digests, files
from sluice.sources.tables import table


# ------------------------------------------------------- row-level enrichment
@register("enriched_events")
def enriched_events(spark, d):
    """Every event with its type's district and local hour; five keys hold all rows."""
    rows = enrich.enrich(events(spark, d).select("event_id", "event_type", "ts", "value"), event_dimension(spark), "event_type")
    return rows.select("event_id", "event_type", "value", F.coalesce("district", F.lit("Unmatched")).alias("district"),
                       F.pmod(F.hour("ts") + F.col("utc_offset_hours"), F.lit(24)).cast("int").alias("hour_local"), "matched")


def hot_lines(spark, d) -> DataFrame:
    """Lines whose supplier is one and the same for a third of them, and unknown for some."""
    return table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CASE WHEN l_quantity <= 17 THEN 1 WHEN l_quantity >= 49 THEN NULL ELSE l_suppkey END AS suppkey", "l_extendedprice")


def patchy_suppliers(spark, d) -> DataFrame:
    """Suppliers with gaps (every third is left out) and repeats (every fifth stands twice)."""
    s = table(spark, d, "supplier")
    kept = s.where("s_suppkey % 3 <> 0").selectExpr("s_suppkey", "s_name", "s_nationkey")
    return kept.unionByName(s.where("s_suppkey % 5 = 0").selectExpr("s_suppkey", "concat('again ', s_name) AS s_name", "s_nationkey"))


def _enriched_lines(spark, d) -> DataFrame:
    return enrich.enrich(hot_lines(spark, d), patchy_suppliers(spark, d), "suppkey", "s_suppkey")


@register("enriched_lines")
def enriched_lines(spark, d):
    return _enriched_lines(spark, d)


@register("enrichment_audit")
def enrichment_audit(spark, d):
    return enrich.enrichment_audit(hot_lines(spark, d), _enriched_lines(spark, d), "suppkey")


# -------------------------------------------------------- located differences
LINE_KEY = ["l_orderkey", "l_linenumber"]
_PLACE = "(l_orderkey * 8 + l_linenumber)"


def _copies(spark, d) -> tuple[DataFrame, DataFrame]:
    """Lineitem and a written copy of it: some rows changed, some missing, some extra."""
    li = table(spark, d, "lineitem")
    kept = li.where(f"{_PLACE} % 991 <> 1").withColumn("l_quantity", F.expr(f"CASE WHEN {_PLACE} % 997 = 0 THEN l_quantity + 1 ELSE l_quantity END"))
    extra = li.where(f"{_PLACE} % 983 = 2").withColumn("l_orderkey", F.col("l_orderkey") + 1000000000)
    path = scratch_path(spark, "copy")
    kept.unionByName(extra).write.parquet(path)
    return li, spark.read.schema(li.schema).parquet(path)


@register("tree_differences")
def tree_differences(spark, d):
    """Changed, missing and extra rows of the copy, found by stored fingerprint trees."""
    left, right = _copies(spark, d)
    root = scratch_path(spark, "trees")
    trees = [difference.read_tree(spark, difference.write_tree(difference.fingerprint_tree(t, LINE_KEY), f"{root}/{name}"))
             for name, t in (("left", left), ("right", right))]
    rows = difference.row_differences(left, right, LINE_KEY, tuple(trees))
    return rows.select(*LINE_KEY, "l_quantity", "side", "copies", "status")


# -------------------------------------------------------------------- digests
@register("manifest_streamed")
def manifest_streamed(spark, d):
    """The file manifest with every file read in pieces."""
    rows = _by_day(files.file_manifest(spark, _daily_rows(spark, d, "streamed"), largest=0))
    return rows.select(F.col("relative_path").alias("day"), "length", "sha256", "status")


@register("file_ranges")
def file_ranges(spark, d):
    """Digests of every 1000 bytes of every file."""
    rows = _by_day(digests.range_digests(spark, _daily_rows(spark, d, "ranges"), size=1000))
    return rows.select(F.col("relative_path").alias("day"), "range_no", "start", "length", "sha256")


@register("file_roots")
def file_roots(spark, d):
    """One digest per file over its ranges' digests."""
    rows = _by_day(digests.tree_digests(digests.range_digests(spark, _daily_rows(spark, d, "roots"), size=1000)))
    return rows.select(F.col("relative_path").alias("day"), "length", "ranges", "root")


# ------------------------------------------------------ profiles kept per load
REPLACED_FROM = "2024-01-20"


def _kept_profile(spark, d) -> profile_state.ProfileState:
    """Events in three loads: two halves, then the last days again with other values."""
    def load(root):
        state = profile_state.ProfileState(batches.PartitionedTable(f"{root}/table", "ts", "day"), "event_type", "value", half_of_month)
        e = events(spark, d)
        profile_state.load_with_state(e.where(F.col("ts") < "2024-01-16"), state, "overwrite")
        profile_state.load_with_state(e.where(F.col("ts") >= "2024-01-16"), state, "append")
        late = e.where(F.col("ts") >= REPLACED_FROM).where("user_id % 3 <> 0").withColumn("value", F.col("value") + 1.5)
        profile_state.load_with_state(late, state, "replace_partitions")
        return state
    return _once(spark, d, "kept_profile", load)


@register("kept_seasonal")
def kept_seasonal(spark, d):
    return profile_state.seasonal(spark, _kept_profile(spark, d))


@register("kept_hourly")
def kept_hourly(spark, d):
    return profile_state.hourly(spark, _kept_profile(spark, d))


@register("kept_coverage")
def kept_coverage(spark, d):
    return profile_state.coverage(spark, _kept_profile(spark, d))


@register("kept_local")
def kept_local(spark, d):
    return profile_state.local(spark, _kept_profile(spark, d), event_dimension(spark), "district", "utc_offset_hours")


@register("kept_state_check")
def kept_state_check(spark, d):
    return profile_state.check_state(spark, _kept_profile(spark, d))




# ----------------------------------------------------- loads through the catalog
def _managed(spark, d) -> tuple[catalog.ManagedTable, catalog.ManagedTable]:
    """Lineitem in two batches and orders, both bucketed by the order."""
    def load(root):
        database = f"sluice_{root[-12:]}"
        catalog.create_database(spark, database, root)
        lines = catalog.ManagedTable(database, "lineitem", "l_orderkey", ts="l_shipdate")
        li = table(spark, d, "lineitem")
        catalog.create_as_select(li.where(F.col("l_shipdate") < LOAD_BOUNDARY), lines)
        catalog.insert_into(li.where(F.col("l_shipdate") >= LOAD_BOUNDARY), lines)
        orders = catalog.ManagedTable(database, "orders", "o_orderkey")
        catalog.create_as_select(table(spark, d, "orders"), orders)
        return lines, orders
    return _once(spark, d, "managed", load)


@register("managed_load")
def managed_load(spark, d):
    """Lines per month of the managed table."""
    lines, _ = _managed(spark, d)
    return spark.table(lines.full_name).groupBy("month_idx").agg(F.count(F.lit(1)).alias("record_count")).orderBy("month_idx")


@register("bucketed_duplicates")
def bucketed_duplicates(spark, d):
    """Repeated line keys, counted inside the buckets."""
    lines, _ = _managed(spark, d)
    return quality.duplicate_keys(spark.table(lines.full_name), ["l_orderkey", "l_linenumber"])


@register("bucketed_join")
def bucketed_join(spark, d):
    """Lines and their orders, bucket by bucket, summed up per priority."""
    lines, orders = _managed(spark, d)
    li, o = spark.table(lines.full_name), spark.table(orders.full_name)
    joined = li.hint("merge").join(o, li["l_orderkey"] == o["o_orderkey"], "left")
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), F.expr("CAST(sum(CAST(l_quantity AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS quantity"))


@register("pruned_by_dimension")
def pruned_by_dimension(spark, d):
    """Lines shipped in the summer months of 1995, from those months' partitions alone."""
    lines, _ = _managed(spark, d)
    months = (table(spark, d, "orders").groupBy(month_index("o_orderdate").alias("month_idx"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
              .agg(F.count(F.lit(1)).alias("orders")))
    summer = months.where("year = 1995 AND month IN (6, 7, 8)")
    rows = catalog.pruned_by(spark.table(lines.full_name), "month_idx", summer, "month_idx")
    return profiles.control_aggregate(rows, "l_suppkey", "l_quantity")


# ------------------------------------------------------------ keys and footers
@register("distinct_keys_bitmap")
def distinct_keys_bitmap(spark, d):
    """Lines and orders per return flag, orders counted by bitmaps."""
    return keys.distinct_by_bitmap(table(spark, d, "lineitem"), "l_orderkey", ["l_returnflag"])


@register("distinct_keys_check")
def distinct_keys_check(spark, d):
    """Rows and keys of the managed table's orders, and of the events."""
    _, orders = _managed(spark, d)
    return (keys.distinct_keys(spark.table(orders.full_name), "o_orderkey").withColumn("name", F.lit("orders"))
            .unionByName(keys.distinct_keys(events(spark, d), "event_id").withColumn("name", F.lit("events"))))


@register("duplicate_keys_filtered")
def duplicate_keys_filtered(spark, d):
    """Repeated line keys, found by a filter first."""
    return keys.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("footer_stats")
def footer_stats(spark, d):
    """Rows, and counts and extremes of two keys, from file footers."""
    return keys.footer_stats(spark, f"{d.rstrip('/')}/lineitem.parquet", ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------- batches, storage
SWEPT = [batches.Batch("a", None, "1994-01-01"), batches.Batch("b", "1994-01-01", "1996-01-01"),
         batches.Batch("c", "1995-06-01", "1997-01-01"), batches.Batch("d", "1997-03-01", None)]


@register("batch_sweep")
def batch_sweep(spark, d):
    """Four batches of lineitem that overlap once and leave a gap once."""
    return batches.sweep_batches(table(spark, d, "lineitem"), "l_shipdate", SWEPT)


@register("storage_prefixes")
def storage_prefixes(spark, d):
    """Files and bytes of every day's folder."""
    return files.prefix_sizes(spark, _daily_rows(spark, d, "prefixes"))
