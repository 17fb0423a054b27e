"""Size-checked broadcast.

A join side is hinted for broadcast only when the optimizer's size estimate
of its plan (file sizes scaled by the projected columns, exact for ranges and
local relations) is under a fixed bound; otherwise, including when the size
is unknown, the frame is returned unchanged and the join is left to the
planner and AQE (a runtime broadcast from the measured size, else a
sort-merge join with AQE's skew split).  The bound never grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_LIMIT_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (no job is run)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated size is at most ``limit_bytes``, else ``df``."""
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df
