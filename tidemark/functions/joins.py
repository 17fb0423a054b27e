"""Equi join with a date-window residual (N13), bucketed for scale.

``left.d`` must fall in ``[right.start, right.start + days]`` (both ends
inclusive) for rows that agree on ``keys``.  A plain equi-join on the keys
would pair every fact of a key with every window of that key and only then
filter; with many windows per key (monthly blasts over years) or one hot key,
that product is what blows up.  Here both sides also agree on a time bucket of
``days + 1`` days: a fact lands in exactly one bucket and a window spans at
most two, so each window is copied at most twice, every matching pair meets
exactly once, and a hot key is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_BUCKET = "_window_bucket"


def _bucket(day_number, width: int):
    return F.floor(day_number / F.lit(width))


def date_window_join(left: DataFrame, right: DataFrame, keys: list[str], left_date: str,
                     right_date: str, days: int, bucket_days: int | None = None) -> DataFrame:
    """Inner join on ``keys`` where ``right_date <= left_date <= right_date + days``.

    ``left_date`` and ``right_date`` are date columns with different names; the
    key columns appear once in the output (as with ``join(on=[...])``).
    """
    if left_date == right_date:
        raise ValueError("left_date and right_date must have different names")
    width = int(bucket_days or days + 1)
    fact = left.withColumn(_BUCKET, _bucket(F.unix_date(F.col(left_date)), width))
    start = F.unix_date(F.col(right_date))
    windows = right.withColumn(
        _BUCKET, F.explode(F.sequence(_bucket(start, width), _bucket(start + F.lit(days), width))))
    joined = fact.join(windows, on=[*keys, _BUCKET], how="inner")
    in_window = (F.col(left_date) >= F.col(right_date)) & (F.col(left_date) <= F.date_add(F.col(right_date), days))
    return joined.where(in_window).drop(_BUCKET)
