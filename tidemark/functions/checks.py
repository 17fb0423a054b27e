"""Entry checks on operator inputs (schemas are inferred upstream, so state them)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, columns, what: str = "input") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns {missing}; has {df.columns}")
    return df
