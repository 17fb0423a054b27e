"""Identifier composition and parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the prefix of every campaign, audience and customization id.
CAMPAIGN_PREFIX = "lc_fprp_notification"


def id_token(col, index: int) -> Column:
    """Token of an id split by ``_``; negative index counts from the end (``-2``: blast date)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.element_at(F.split(c, "_"), index)
