"""Blast funnel report (P20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Stage labels of the funnel.
STAGE_ELIGIBLE = "Eligible List"
STAGE_RECOMMENDED = "Recommendation List"
STAGE_BLAST = "Blast"


def blast_funnel(audience: DataFrame, recs: DataFrame, personalization: DataFrame) -> DataFrame:
    """P20: distinct customers at the eligible, recommended and blast stages.

    Typed ``(source string, vips bigint, blast_date date)``; the eligible and
    recommended stages have no date (NULL).  The reference's separator and
    header rows are presentation and are not produced (D11).  The final UNION
    of the reference deduplicates, hence ``distinct``.
    """
    no_date = F.lit(None).cast("date").alias("blast_date")
    eligible = audience.agg(F.count_distinct("vip_no").alias("vips")).select(
        F.lit(STAGE_ELIGIBLE).alias("source"), "vips", no_date)
    recommended = recs.agg(F.count_distinct("vip_no").alias("vips")).select(
        F.lit(STAGE_RECOMMENDED).alias("source"), "vips", no_date)
    blasted = personalization.groupBy("blast_date").agg(F.count_distinct("customer_id").alias("vips")).select(
        F.lit(STAGE_BLAST).alias("source"), "vips", "blast_date")
    return eligible.unionByName(recommended).unionByName(blasted).distinct()
