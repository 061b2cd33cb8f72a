"""Backup copies of partitioned tables on Spark, and audits of those copies.

Planning functions are pure ``DataFrame -> DataFrame``; only
:mod:`partsnap.sinks.tables` writes.
"""

from partsnap.operators.diff import (
    differential_summary,
    except_distinct,
    row_counts,
    row_diff,
    union_distinct,
)
from partsnap.operators.fingerprint import changed_keys, partition_fingerprints, pruned_row_diff
from partsnap.operators.gates import full_count, latest_count, same_key_content, same_key_count
from partsnap.operators.profile import distinct_profile
from partsnap.operators.listing import diff_listing
from partsnap.operators.schema import schema_compare, schema_tree
from partsnap.operators.volume import volume_by_partition, volume_summary
from partsnap.plans.batch import Policy, run_batch
from partsnap.plans.load import history_load, incremental_load, snapshot_unpartitioned
from partsnap.plans.retention import apply_eviction, plan_eviction
from partsnap.plans.validate import audit, audit_batch, batch_report, differing_rows, validation_report
from partsnap.streaming.backup_stream import start_backup_stream

__all__ = [
    "Policy",
    "apply_eviction",
    "audit",
    "audit_batch",
    "batch_report",
    "diff_listing",
    "differing_rows",
    "changed_keys",
    "differential_summary",
    "distinct_profile",
    "except_distinct",
    "full_count",
    "history_load",
    "incremental_load",
    "latest_count",
    "partition_fingerprints",
    "plan_eviction",
    "pruned_row_diff",
    "row_counts",
    "row_diff",
    "run_batch",
    "same_key_content",
    "same_key_count",
    "schema_compare",
    "schema_tree",
    "snapshot_unpartitioned",
    "start_backup_stream",
    "union_distinct",
    "validation_report",
    "volume_by_partition",
    "volume_summary",
]
