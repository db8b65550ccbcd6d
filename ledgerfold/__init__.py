"""Keep a type-2 slowly-changing-dimension replica up to date from increments."""

from ledgerfold.operators.checks import new_entities, reconcile, reconcile_counts
from ledgerfold.operators.merge import (
    changes_closed_key,
    changes_closed_key_by_subpartition,
    changes_latest,
    merge_closed_key,
    merge_closed_key_by_subpartition,
    merge_latest,
    touched_months,
    unclosed,
)
from ledgerfold.operators.rank import latest_open, rank_versions
from ledgerfold.operators.slices import (
    closed_keys,
    closed_slice,
    conform,
    open_slice,
    open_subpartitions,
    split_rejects,
    with_months,
)
from ledgerfold.operators.fingerprints import differing_months, fingerprint_by_month
from ledgerfold.plans.jobs import (
    apply_increment,
    compact_replica,
    declare_schema,
    reconcile_chain,
    rejected_rows,
    resume_run,
    undo_run,
)
from ledgerfold.sources.footers import footer_counts
from ledgerfold.sources.replica import read_increment, read_replica, seed
from ledgerfold.sources.staging import (
    append_rest,
    drop_staging,
    publish,
    publish_open_slice,
    publish_subpartitions,
    stage,
)
from ledgerfold.sources.targets import PathReplica, TableReplica, create_replica
from ledgerfold.spec import ScdSpec

__all__ = [
    "PathReplica",
    "ScdSpec",
    "TableReplica",
    "append_rest",
    "apply_increment",
    "changes_closed_key",
    "changes_closed_key_by_subpartition",
    "changes_latest",
    "closed_keys",
    "closed_slice",
    "compact_replica",
    "conform",
    "create_replica",
    "declare_schema",
    "differing_months",
    "drop_staging",
    "fingerprint_by_month",
    "footer_counts",
    "latest_open",
    "merge_closed_key",
    "merge_closed_key_by_subpartition",
    "merge_latest",
    "new_entities",
    "open_slice",
    "open_subpartitions",
    "publish",
    "publish_open_slice",
    "publish_subpartitions",
    "rank_versions",
    "read_increment",
    "read_replica",
    "reconcile",
    "reconcile_chain",
    "reconcile_counts",
    "rejected_rows",
    "resume_run",
    "seed",
    "split_rejects",
    "stage",
    "touched_months",
    "unclosed",
    "undo_run",
    "with_months",
]
