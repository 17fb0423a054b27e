"""The numbered slot family ``x_1 .. x_8`` (J10) and array helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A recommendation row carries eight product slots, and a valid
# item code has six characters.
SLOTS = tuple(range(1, 9))
CODE_LENGTH = 6
SEPARATOR = "|"

# Per-slot column families of a recommendation row.
SLOT_FAMILIES = ("atg_code", "brand_desc", "prod_desc", "Global_Exclusive")


def slot_cols(prefix: str, slots=SLOTS) -> list[str]:
    return [f"{prefix}_{i}" for i in slots]


def pack_slots(prefix: str, sep: str = SEPARATOR, slots=SLOTS) -> Column:
    """``concat(x_1, '|', x_2, ...)``; NULL if any slot is NULL."""
    parts: list[Column] = []
    for i, name in enumerate(slot_cols(prefix, slots)):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.col(name))
    return F.concat(*parts)


def _split(packed: Column, sep: str = SEPARATOR) -> Column:
    return F.split(packed, "[" + sep + "]")


def valid_code_count(packed: Column, code_length: int = CODE_LENGTH, sep: str = SEPARATOR) -> Column:
    """Number of distinct ``code_length``-character codes in a packed list; NULL text counts 0."""
    codes = F.filter(_split(packed, sep), lambda x: F.length(x) == code_length)
    return F.coalesce(F.size(F.array_distinct(codes)), F.lit(0))


def first_distinct(packed: Column, k: int, sep: str = SEPARATOR) -> list[Column]:
    """The first ``k`` distinct values of a packed list as k columns; '' when absent."""
    arr = F.array_distinct(_split(packed, sep))
    return [F.coalesce(F.get(arr, i), F.lit("")) for i in range(k)]
