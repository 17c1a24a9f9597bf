"""sluice: a Spark-native data-quality gate and periodic-profile library.

Contracts turn raw files into checked tables (every rejected row labelled
with all its reasons, nothing lost between stages); profiles answer
periodic questions over those tables with multi-level aggregation.

The most used entry points are re-exported here; the modules hold the rest.
"""

from sluice.contract import Contract, Period, RangeRule, SameDay
from sluice.operators.checks import CheckFailed, assert_checks, fingerprint_checks, multiset_diff
from sluice.operators.dimension import dimension_key_check, dimension_rollup, inline_dimension, join_audit
from sluice.operators.profiles import hourly_profile, local_profile, season_pivot, seasonal_profile
from sluice.operators.quality import (accepted, duplicate_keys, label, null_profile, reconciliation,
                                      reject_histogram, rejected)
from sluice.plans.batches import PartitionedTable, ledger, load_batch, partition_inventory, two_batch_load
from sluice.plans.formats import result_parity, schema_parity, write_two_formats
from sluice.plans.gate import GateResult, run_gate
from sluice.session import apply_conf, build_session, scratch_path
from sluice.sources.csv import read_failfast, read_permissive, write_csv

__version__ = "0.1.0"

__all__ = [
    "Contract", "Period", "RangeRule", "SameDay", "CheckFailed", "assert_checks", "fingerprint_checks",
    "multiset_diff", "dimension_key_check", "dimension_rollup", "inline_dimension", "join_audit",
    "hourly_profile", "local_profile", "season_pivot", "seasonal_profile", "accepted", "duplicate_keys", "label",
    "null_profile", "reconciliation", "reject_histogram", "rejected", "PartitionedTable", "ledger", "load_batch",
    "partition_inventory", "two_batch_load", "result_parity", "schema_parity", "write_two_formats",
    "GateResult", "run_gate", "apply_conf", "build_session", "scratch_path", "read_failfast",
    "read_permissive", "write_csv",
]
