"""Column-level helpers (all built-in Spark expressions, no Python UDFs)
plus the few composite DataFrame helpers shared by several operators."""

from tidemark.functions.dates import parse_yyyymmdd, format_yyyymmdd, month_padded, as_date
from tidemark.functions.slots import (SLOTS, slot_cols, pack_slots, valid_code_count, first_distinct)
from tidemark.functions.ids import id_token
from tidemark.functions.joins import date_window_join
from tidemark.functions.indexing import smallest_rows, with_dense_index
from tidemark.functions.checks import require_columns
from tidemark.functions.sizing import broadcast_if_small, estimated_bytes

__all__ = [
    "parse_yyyymmdd", "format_yyyymmdd", "month_padded", "as_date",
    "SLOTS", "slot_cols", "pack_slots", "valid_code_count", "first_distinct",
    "id_token",
    "date_window_join", "smallest_rows", "with_dense_index", "require_columns", "broadcast_if_small", "estimated_bytes",
]
