"""Date helpers (C1-C6).  Dates are always arguments, never current_date()."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F


def as_date(value) -> Column:
    """A date literal from ``datetime.date``, ``'YYYY-MM-DD'`` or ``'YYYYMMDD'``."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, str) and len(value) == 8 and value.isdigit():
        value = _dt.date(int(value[:4]), int(value[4:6]), int(value[6:]))
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def to_pydate(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    if len(value) == 8 and value.isdigit():
        return _dt.date(int(value[:4]), int(value[4:6]), int(value[6:]))
    return _dt.date.fromisoformat(value)


def parse_yyyymmdd(col) -> Column:
    """``yyyyMMdd`` text to date; malformed text gives NULL (never raises under ANSI)."""
    return F.try_to_date(F.col(col) if isinstance(col, str) else col, "yyyyMMdd")


def format_yyyymmdd(col) -> Column:
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyyMMdd")


def month_padded(col) -> Column:
    """``lpad(month(d), 2)`` pads with a space, e.g. ``' 3'``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lpad(F.month(c).cast("string"), 2, " ")
