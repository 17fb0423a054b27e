"""Blast assembly and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import SLOTS, first_distinct, pack_slots, require_columns, slot_cols, valid_code_count
from tidemark.functions.dates import as_date, to_pydate

# Fixed values of the blast list.
BLAST_CAMPAIGN_ID = "fprp_notification"
UTM_CAMPAIGN_PREFIX = "gg_prodlisting-fprp_notification_"
UTM_SOURCE_FEMALE = "female_DB"
UTM_SOURCE_MALE = "Male_DB"
TOP_BRANDS = 3

BLAST_SLOT_COLUMNS = (slot_cols("atg_code") + slot_cols("brand_desc") + slot_cols("prod_desc")
                      + slot_cols("Global_Exclusive"))


def blast_base(recs: DataFrame, audience: DataFrame, blast_date, campaign_id: str = BLAST_CAMPAIGN_ID) -> DataFrame:
    """Recommendations joined to the grouped audience USING vip_no.

    ``brand`` and ``atg_code`` pack the eight slots with '|' (NULL if any slot
    is NULL, C8); ``blast_date`` is an argument (D1).
    """
    require_columns(recs, ["vip_no"] + BLAST_SLOT_COLUMNS, "recommendations")
    require_columns(audience, ["vip_no", "promotion_edm_flg", "email", "card_type", "group",
                               "customer_name_shortened_chi", "pref_lang", "cust_type"], "audience")
    r = recs.select("vip_no", *BLAST_SLOT_COLUMNS)
    m = audience.select("vip_no", "promotion_edm_flg", "email", "card_type", "group", "customer_name_shortened_chi",
                        "pref_lang", "cust_type")
    return r.join(m, "vip_no", "inner").select(
        "vip_no", *BLAST_SLOT_COLUMNS,
        pack_slots("brand_desc").alias("brand"),
        pack_slots("atg_code").alias("atg_code"),
        as_date(blast_date).alias("blast_date"),
        "promotion_edm_flg", "email", "card_type", "group", "customer_name_shortened_chi",
        F.col("pref_lang").alias("Language"), "cust_type",
        F.lit(campaign_id).alias("campaign_id"))


def blast_with_seeds(df: DataFrame, seed_ids=("testSeedA_gold", "testSeedB_gold"), salt: str = "seed") -> DataFrame:
    """Copy the rows of ``len(seed_ids)`` members under test ids with a blank email.

    The members are the first ones by ``md5(salt || vip_no)`` (a salted,
    reproducible sample instead of an unseeded one): a distributed top-k over
    ids alone, so at most k ids per task reach the final merge.  The k picked
    ids are broadcast back (a table of k rows), and one pass over the wide rows
    emits each original and, for a picked member, its copy.  A null id is never
    picked; a member with several rows has each of them copied.
    """
    k = len(seed_ids)
    if k == 0:
        return df
    key = F.md5(F.concat(F.lit(salt), F.col("vip_no")))
    picked = df.select("vip_no").where(F.col("vip_no").isNotNull()).distinct().withColumn("_seed_key", key).orderBy("_seed_key", "vip_no").limit(k)
    # k rows only: a window without partitioning is bounded by the seed count
    rank = F.row_number().over(Window.orderBy("_seed_key", "vip_no"))
    seeds = picked.select(F.col("vip_no").alias("_member"), F.element_at(F.array(*[F.lit(s) for s in seed_ids]), rank).alias("_seed"))
    own = F.struct(F.col("vip_no").alias("v"), F.col("email").alias("e"))
    copy = F.struct(F.col("_seed").alias("v"), F.lit("").alias("e"))
    both = df.join(F.broadcast(seeds), F.col("vip_no") == F.col("_member"), "left").withColumn(
        "_row", F.explode(F.when(F.col("_seed").isNull(), F.array(own)).otherwise(F.array(own, copy))))
    return both.withColumn("vip_no", F.col("_row.v")).withColumn("email", F.col("_row.e")).select(*df.columns)


def utm_campaign(blast_date) -> str:
    return UTM_CAMPAIGN_PREFIX + to_pydate(blast_date).strftime("%Y%m%d")


def utm_tags(df: DataFrame, blast_date) -> DataFrame:
    """utm_source from the group prefix, utm_campaign = prefix + blast date (yyyyMMdd)."""
    source = F.when(F.col("group").startswith("Female"), UTM_SOURCE_FEMALE).otherwise(UTM_SOURCE_MALE)
    return df.withColumn("utm_source", source).withColumn("utm_campaign", F.lit(utm_campaign(blast_date)))


def _valid_codes():
    return valid_code_count(F.col("atg_code"))


def slot_quality_ok(df: DataFrame) -> DataFrame:
    """Rows whose packed codes hold exactly eight distinct six-character codes."""
    return df.where(_valid_codes() == len(SLOTS))


def slot_quality_rejects(df: DataFrame) -> DataFrame:
    """P15 report: the rejected rows with their count of valid distinct codes (NULL text -> 0)."""
    return df.where(_valid_codes() != len(SLOTS)).select("vip_no", "atg_code", _valid_codes().alias("valid_codes"))


def quality_marked(df: DataFrame) -> DataFrame:
    """P15 in one pass: every row with its count of valid distinct codes and whether that passes."""
    n = _valid_codes()
    return df.select("*", n.alias("valid_codes"), F.coalesce(n == len(SLOTS), F.lit(False)).alias("accepted"))


def check_rejects(rejects: DataFrame, max_rejects: int | None) -> None:
    """Optional hard stop when more than ``max_rejects`` rows fail the slot check."""
    if max_rejects is None:
        return
    n = rejects.limit(max_rejects + 1).count()
    if n > max_rejects:
        raise ValueError(f"more than {max_rejects} rows with missing or duplicate item codes")


def top_brands(df: DataFrame, k: int = TOP_BRANDS) -> DataFrame:
    """The first ``k`` distinct brands of the packed brand list, '' when absent."""
    cols = first_distinct(F.col("brand"), k)
    for i, c in enumerate(cols, start=1):
        df = df.withColumn(f"top_{i}_brand", c)
    return df


def region_list(base: DataFrame, blast_date, seed_ids=("testSeedA_gold", "testSeedB_gold"),
                salt: str = "seed") -> DataFrame:
    """P13-P16 chained in the reference's order: seeds, utm tags, slot check, top brands."""
    return top_brands(slot_quality_ok(utm_tags(blast_with_seeds(base, seed_ids, salt), blast_date)))


def history_rows(region_lists: dict) -> DataFrame:
    """Rows appended to the blast history: each region's list with its ``region``."""
    frames = [df.withColumn("region", F.lit(region)) for region, df in region_lists.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


__all__ = ["blast_base", "blast_with_seeds", "utm_tags", "slot_quality_ok", "slot_quality_rejects", "quality_marked", "check_rejects",
           "top_brands", "region_list", "history_rows", "utm_campaign"]
