"""Dense 1-based row index in a stated order, computed without a
single-partition window (D7, W1).

Rows are range-partitioned on the order, sorted inside each partition and
numbered locally from ``monotonically_increasing_id`` (partition id in the high
bits, position in the low bits).  That numbered frame is then pinned with a
reliable checkpoint (shared folder from ``spark.checkpoint.dir``): the counts
per partition and the rows both read the pinned copy, so they agree whatever
the range sampling did and however often a task is retried.  One row per
partition is counted, and the running offsets are broadcast back: that table
has at most ``num_partitions`` rows, a bound set here, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import MapType

_PART = "_idx_part"
_LOCAL = "_idx_local"
_LOW_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def with_dense_index(df: DataFrame, order_cols: list[str], index_col: str = "index",
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col`` = 1..N following ``order_cols`` (remaining columns break ties)."""
    spark = df.sparkSession
    n = int(num_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    # remaining columns break ties (map columns cannot be ordered and are skipped)
    sort_cols = list(order_cols) + [f.name for f in df.schema.fields
                                    if f.name not in order_cols and not isinstance(f.dataType, MapType)]
    # range bounds over the full order: a key with many distinct rows can be
    # split across partitions (only identical rows must share one)
    ranged = df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
    mid = F.monotonically_increasing_id()
    numbered = ranged.select(
        "*",
        F.shiftright(mid, _LOW_BITS).alias(_PART),
        (mid.bitwiseAND((1 << _LOW_BITS) - 1) + F.lit(1)).alias(_LOCAL),
    ).checkpoint(eager=True)
    counts = numbered.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (numbered.join(F.broadcast(offsets), on=_PART, how="inner")
            .select(*df.columns, (F.col("_offset") + F.col(_LOCAL)).alias(index_col)))


HISTOGRAM = 4096    # ranges counted in one pass
CHUNK_BYTES = 6     # key bytes compared as one number (exact as a double, so ranges can be divided)


def smallest_rows(df: DataFrame, key: str, wanted: int, slack: int = 10_000) -> DataFrame:
    """A superset of the ``wanted`` rows of ``df`` that come first by ``key`` (text, nulls first).

    At most ``2 * wanted + slack`` rows, and those that share the last key, are
    kept.  They are a beginning of the order, so numbering them gives the same
    first ``wanted`` numbers as numbering everything.

    The place to cut is searched by histogram: keys are compared as numbers of
    six bytes, 4,096 equal ranges are counted at a time, and only the range
    that the cut lies in is counted again.  A pass is one aggregate over the key
    column; the driver sees at most 4,096 counts of it.
    """
    keys, limit = df.select(key), 2 * wanted + slack
    before = keys.where(F.col(key).isNull()).count()
    taken, inside, chunk = F.col(key).isNull(), F.col(key).isNotNull(), 0
    while before < wanted:
        part = F.hex(F.substring(F.encode(F.col(key), "UTF-8"), chunk * CHUNK_BYTES + 1, CHUNK_BYTES))
        value = F.conv(F.rpad(part, 2 * CHUNK_BYTES, "0"), 16, 10).cast("long")
        lo, hi, longest, n = keys.where(inside).agg(F.min(value), F.max(value), F.max(F.octet_length(key)), F.count(F.lit(1))).first()
        if before + n <= max(limit, wanted) or longest <= chunk * CHUNK_BYTES:
            return df.where(taken | inside)
        while lo < hi:
            width = (hi - lo) // HISTOGRAM + 1
            bucket = F.floor((value - F.lit(lo)) / F.lit(width)).alias("bucket")
            counts = dict(keys.where(inside & value.between(lo, hi)).groupBy(bucket).count().collect())
            for b in sorted(counts):
                if before + counts[b] >= wanted:
                    break
                before += counts[b]
            end = min(hi, lo + (b + 1) * width - 1)
            if before + counts[b] <= limit:
                return df.where(taken | inside & (value <= end))
            lo, hi = lo + b * width, end
        taken, inside, chunk = taken | inside & (value < lo), inside & (value == lo), chunk + 1
    return df.where(taken)
