"""Expression building blocks."""

from edgeloom.functions.columns import (
    ENDPOINTS,
    ID_TYPES,
    all_ids,
    closed_paths,
    id_from,
    ids_of,
    is_id,
    is_one_pair,
    part_of,
    safe_sum,
    total_or_error,
)

__all__ = ["ENDPOINTS", "ID_TYPES", "all_ids", "closed_paths", "id_from", "ids_of", "is_id", "is_one_pair",
           "part_of", "safe_sum", "total_or_error"]
