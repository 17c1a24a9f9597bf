"""Golden numbers at sf0.01 (independent of the SQL oracle)."""

from decimal import Decimal

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.01"
Q = queries()


def rows(spark, name):
    return [r.asDict() for r in Q[name](spark, SF).collect()]


def test_reject_groups(spark):
    hist = {r["reject_reason"]: r["rows"] for r in rows(spark, "reject_histogram")}
    assert hist["value out of range"] == 1059
    assert hist["ts outside period; value out of range"] == 257
    assert sum(hist.values()) == 10000 - 6935
    assert len(rows(spark, "accepted_rows")) == 6935


def test_join_audit(spark):
    assert rows(spark, "join_audit") == [
        {"before_join": 10000, "after_join": 10000, "unmatched_rows": 4031, "unmatched_keys": 2}]


def test_control_and_filtered_aggregates(spark):
    c = rows(spark, "control_aggregate")[0]
    assert (c["observations"], c["entities"], c["sum_value"], c["mean_value"]) == \
        (10000, 5, Decimal("496306.570000"), 49.630657)
    f = rows(spark, "filtered_aggregate")[0]
    assert (f["rows"], f["mean_value"]) == (982, 48.095937)


def test_completeness_purchase(spark):
    p = [r for r in rows(spark, "completeness") if r["event_type"] == "purchase"][0]
    assert (p["expected"], p["actual"], p["missing"]) == (720, 673, 47)


def test_counts(spark):
    assert len(rows(spark, "latest_ingestion")) == 5015
    assert len(rows(spark, "duplicate_keys")) == 11785
    assert len(rows(spark, "partition_inventory")) == 83
    assert len(rows(spark, "partition_inventory_days")) == 30
    assert len(rows(spark, "dimension_rollup")) == 21
    ledger = rows(spark, "load_ledger")
    assert [(r["added_records"], r["total_records"]) for r in ledger] == [(26486, 26486), (33514, 60000)]


@pytest.mark.parametrize("name", ["reconciliation", "quality_gate", "csv_reconciliation", "format_roundtrip",
                                  "result_parity", "content_parity", "reject_sink_roundtrip", "two_batch_load",
                                  "batch_coverage", "load_key_check"])
def test_checks_pass(spark, name):
    out = rows(spark, name)
    key = "ok" if "ok" in out[0] else "same"
    assert all(r[key] for r in out), out
