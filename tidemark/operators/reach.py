"""Exact distinct members from stored bitmaps (A4, A5 for P20 and P25).

Members get dense numbers once (``member_numbers``, kept as a table; new
members get the next ones).  A day's reach is stored as bitmaps of 32,768
members each, one row per key and block of numbers.  Any coarser count (the
month, all channels) is an OR of stored rows and a count of bits: it moves
4 KB per key and block, never a member id, and is the exact distinct count.

Defined cases: a null id is no member, but its row keeps its key (with the
count 0, as ``count(distinct)`` gives); repeated rows count once; null keys are
keys; an id without a number is an error, since it would be lost silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import month_padded, require_columns, with_dense_index
from tidemark.operators.funnel import STAGE_BLAST, STAGE_ELIGIBLE, STAGE_RECOMMENDED

NUMBERS_SCHEMA = "vip_no string, member_no bigint"


def member_numbers(ids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(vip_no, member_no): ``known`` and, numbered after it in id order, the members of ``ids`` it lacks.

    Numbers start at 0 and never change, so bitmaps stored earlier stay right.
    """
    fresh = ids.select("vip_no").where(F.col("vip_no").isNotNull()).distinct()
    if known is None:
        start = 0
    else:
        fresh = fresh.join(known, "vip_no", "left_anti")
        top = known.agg(F.max("member_no")).scalar()
        start = F.coalesce(top, F.lit(-1)) + 1
    numbered = with_dense_index(fresh, ["vip_no"], "_n").select("vip_no", (F.col("_n") - 1 + start).cast("long").alias("member_no"))
    return numbered if known is None else known.select("vip_no", "member_no").unionByName(numbered)


def reach_bitmaps(rows: DataFrame, numbers: DataFrame, keys: Sequence[str], member: str = "vip_no") -> DataFrame:
    """(keys..., block, members): which members each key reached, as bitmaps.

    Repeats go before the join, so a member has at most one row per key in it.
    The numbers are dealt out by key and block before they are set: a task holds
    one block's bitmap at a time, and no half-empty bitmaps are shuffled.
    """
    require_columns(rows, [*keys, member], "rows to count")
    distinct = rows.select(*keys, F.col(member).alias("vip_no")).distinct()
    known = numbers.select("vip_no", "member_no")
    unknown = F.when(F.col("vip_no").isNotNull(), F.raise_error(F.concat(F.lit("member without a number: "), F.col("vip_no"))).cast("long"))
    placed = (distinct.join(known, "vip_no", "left").select(*keys, F.coalesce("member_no", unknown).alias("_no"))
              .select(*keys, F.bitmap_bucket_number("_no").alias("block"), F.bitmap_bit_position("_no").alias("_bit")))
    return (placed.repartition(*keys, "block").groupBy(*keys, "block")
            .agg(F.bitmap_construct_agg("_bit").alias("members")))


def merged_reach(bitmaps: DataFrame, keys: Sequence) -> DataFrame:
    """Bitmaps of coarser keys (columns or names): the OR of the rows that fall together."""
    return bitmaps.groupBy(*keys, "block").agg(F.bitmap_or_agg("members").alias("members"))


def reach_counts(bitmaps: DataFrame, keys: Sequence[str], name: str = "members_reached") -> DataFrame:
    """Distinct members per key, of bitmaps that are merged on these keys."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("members")).alias(name))


# --------------------------------------------------------------------------- the KPI report's distinct counts

DAY_KEYS = ["measure", "blast_date", "blast_region", "blast_channel"]


def daily_reach(blasts: DataFrame, revenue: DataFrame, numbers: DataFrame) -> DataFrame:
    """Members blasted and, of these, purchasers, per (date, region, channel); P25 meets purchases on (member, date)."""
    buyers = blasts.join(revenue.select("vip_no", "blast_date"), ["vip_no", "blast_date"], "left_semi")
    both = [df.select(F.lit(m).alias("measure"), *DAY_KEYS[1:], "vip_no") for m, df in (("size", blasts), ("purchaser", buyers))]
    return reach_bitmaps(both[0].unionByName(both[1]), numbers, DAY_KEYS)


def monthly_reach(daily: DataFrame) -> DataFrame:
    """Campaign size, purchasers and conversion of P25 per (month, region, channel), from stored ``daily_reach`` rows alone."""
    months = ["blast_year", "blast_month", "blast_region", "blast_channel"]
    keyed = daily.select("measure", F.year("blast_date").alias("blast_year"), month_padded("blast_date").alias("blast_month"),
                         "blast_region", "blast_channel", "block", "members")
    blocks = merged_reach(keyed, ["measure", *months])
    bits = F.bitmap_count("members")
    count = lambda m: F.coalesce(F.sum(F.when(F.col("measure") == m, bits)), F.lit(0))
    return (blocks.groupBy(*months).agg(count("size").alias("campaign_size"), count("purchaser").alias("number_of_purchaser"))
            .withColumn("conversion_rate", F.try_divide("number_of_purchaser", "campaign_size")))


# --------------------------------------------------------------------------- the funnel's distinct counts

FUNNEL_KEYS = ["source", "blast_date"]


def funnel_members(audience: DataFrame, recs: DataFrame, personalization: DataFrame) -> DataFrame:
    """(source, blast_date, vip_no) of the three stages; a stage without members still has its row."""
    spark, no_date = audience.sparkSession, F.lit(None).cast("date").alias("blast_date")
    stages = [audience.select(F.lit(STAGE_ELIGIBLE).alias("source"), no_date, "vip_no"),
              recs.select(F.lit(STAGE_RECOMMENDED).alias("source"), no_date, "vip_no"),
              personalization.select(F.lit(STAGE_BLAST).alias("source"), "blast_date", F.col("customer_id").alias("vip_no")),
              spark.createDataFrame([(STAGE_ELIGIBLE, None, None), (STAGE_RECOMMENDED, None, None)], "source string, blast_date date, vip_no string")]
    out = stages[0]
    for s in stages[1:]:
        out = out.unionByName(s)
    return out


def funnel_of_bitmaps(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """P20 from stored bitmaps of ``FUNNEL_KEYS`` and ``by``: (source, vips, blast_date, by...)."""
    keys = [*by, *FUNNEL_KEYS]
    return reach_counts(merged_reach(bitmaps, keys), keys, "vips").select("source", "vips", "blast_date", *by)
