"""Export feeds of the blast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import SLOTS, broadcast_if_small, require_columns
from tidemark.functions.dates import as_date

PERSONALIZATION_MEDIUM = "email"


def product_recommendation(df: DataFrame, created_date) -> DataFrame:
    """Wide -> long, one row per (customer, slot 1..8).

    One ``posexplode`` over the eight codes replaces eight scans in a UNION ALL.
    The export order (customer_id, display_id) is applied by the sink only.
    """
    require_columns(df, ["campaign_id", "vip_no", "blast_date"] + [f"atg_code_{i}" for i in SLOTS], "blast list")
    codes = F.array(*[F.col(f"atg_code_{i}") for i in SLOTS])
    return (df.select("campaign_id", F.col("vip_no").alias("customer_id"), "blast_date",
                      F.posexplode(codes).alias("_pos", "product_id"))
            .select("campaign_id", "customer_id", "product_id", (F.col("_pos") + 1).alias("display_id"),
                    as_date(created_date).alias("created_date"), "blast_date"))


def export_order(feed: DataFrame) -> DataFrame:
    """Sort of the product_recommendation export (range-partitioned, at the sink)."""
    return feed.orderBy("customer_id", "display_id")


def products(df: DataFrame, item: DataFrame, created_date) -> DataFrame:
    """DISTINCT recommended products with English and Chinese descriptions.

    The reference inner-joins slot 1 and left-joins slots 2-8 to the item
    master, so an unknown item survives only if it also sits in a later slot
    (D9).  The long form is first reduced to its distinct (product, brand,
    exclusive) triples with a flag "seen in a slot after the first"; that
    reduction runs map-side, so the item join sees distinct products, not
    customers x 8.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("slot"), F.col(f"atg_code_{i}").alias("product_id"),
                 F.col(f"brand_desc_{i}").alias("brand_desc_en"), F.col(f"Global_Exclusive_{i}").alias("global_exclusive"))
        for i in SLOTS])))
    triples = (long.groupBy("product_id", "brand_desc_en", "global_exclusive")
               .agg(F.max((F.col("slot") > 1).cast("int")).alias("_later")))
    it = item.select(F.col("atg_code").alias("_code"), "prod_desc_eng", "prod_desc_tc", "brand_desc")
    # the item master is broadcast only while its estimated size is under the fixed bound
    it = broadcast_if_small(it)
    j = triples.join(it, triples.product_id == it._code, "left")
    return (j.where((F.col("_later") == 1) | F.col("_code").isNotNull())
            .select("product_id", "brand_desc_en", F.col("prod_desc_eng").alias("product_description_en"),
                    "global_exclusive",
                    F.coalesce(F.col("prod_desc_tc"), F.col("prod_desc_eng")).alias("product_description_cn"),
                    F.col("brand_desc").alias("brand_description_cn"),
                    as_date(created_date).alias("created_date"))
            .distinct())


def campaign_personalization(df: DataFrame, created_date) -> DataFrame:
    """DISTINCT per-customer message parameters with constant columns."""
    return df.select(
        "campaign_id", F.col("vip_no").alias("customer_id"), "blast_date",
        F.col("customer_name_shortened_chi").alias("customer_name"),
        F.lit("").alias("subject_line"), F.lit("").alias("message"), "Language", F.lit("").alias("title"),
        F.lit(PERSONALIZATION_MEDIUM).alias("utm_medium"), "utm_source", "utm_campaign",
        as_date(created_date).alias("created_date"),
    ).distinct()
