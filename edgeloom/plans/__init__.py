"""Physical helpers: hub splitting, lineage cutting, size checks."""

from edgeloom.plans.hubs import HUB_ROWS, PATHS_PER_PART, ROWS_PER_PART, hub_table, split_join, with_degree, with_values
from edgeloom.plans.ledger import Ledger
from edgeloom.plans.staging import (
    BROADCAST_ROWS,
    STRATEGIES,
    discard,
    fits_broadcast,
    scratch_path,
    shared_dir,
    shuffle_partitions,
    stage,
)

__all__ = [
    "BROADCAST_ROWS", "HUB_ROWS", "Ledger", "PATHS_PER_PART", "ROWS_PER_PART", "STRATEGIES", "discard", "fits_broadcast",
    "hub_table", "scratch_path", "shared_dir", "shuffle_partitions", "split_join", "stage", "with_degree", "with_values",
]
