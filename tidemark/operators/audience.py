"""Audience building (P1-P4) and the audience filter table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import broadcast_if_small, parse_yyyymmdd, require_columns

# Fixed values of the audience rules.
CAMPAIGN_CUST_TYPES = ("Hong Kong", "Overseas", "China")
VOUCHER_REGIONS = {"hk": ("HKG",), "cn": ("BJG", "SHG", "CHD")}
# Output columns of the audience, in order; the snapshot must have all of them.
AUDIENCE_COLUMNS = ("data_as_of", "card_start_date", "vip_no", "status", "card_type", "mailing_gp", "cust_type",
                    "gender", "birth_mth", "country_of_residence", "promotion_edm_flg", "promotion_sms_flg", "email",
                    "phone_no", "pref_lang", "customer_name_shortened_chi")
DATE_COLUMNS = ("data_as_of", "card_start_date")
# Audience filter configuration per region and group: allowed nationality codes
# and allowed email-valid flags (the "row" region has no nationality filter).
NATIONALITIES = {"hk": {"female": ("HKC", "HKL"), "male": ("HKC", "HKL")},
                 "cn": {"female": ("ML",), "male": ("ML",)}}
EMAIL_VALID_FLAGS = ("Y", "N")


def fold_residence(col="country_of_residence"):
    c = F.col(col)
    return F.when(c == "CN", "CN").when(c == "HK", "HK").otherwise("Others")


def active_reachable_audience(snapshot: DataFrame, reachable: DataFrame,
                              cust_types=CAMPAIGN_CUST_TYPES) -> DataFrame:
    """DISTINCT active, reachable members of the campaign customer types.

    Residence is folded to CN / HK / Others (NULL -> Others).  Both inputs are
    shuffled on ``vip_no`` once; the DISTINCT reuses that partitioning.
    """
    require_columns(snapshot, list(AUDIENCE_COLUMNS), "member snapshot")
    members = snapshot.where((F.col("status") == "Active") & F.col("cust_type").isin(*cust_types))
    joined = members.join(reachable.select("vip_no"), "vip_no", "inner")
    cols = []
    for c in AUDIENCE_COLUMNS:
        if c in DATE_COLUMNS:
            cols.append(F.col(c).cast("date").alias(c))
        elif c == "country_of_residence":
            cols.append(fold_residence(c).alias(c))
        else:
            cols.append(F.col(c))
    return joined.select(*cols).distinct()


def voucher_audience(audience: DataFrame, voucher: DataFrame, region: str) -> DataFrame:
    """Audience members holding a voucher of the latest collect date in the region's set.

    The latest date is global over the whole voucher table (the subquery does
    not filter by region, D2), planned as one scalar subquery with a partial
    max per task.  ``DISTINCT a.*`` over an inner join is a semi join.
    """
    require_columns(voucher, ["vip_no", "collect_start_date", "region"], "voucher summary")
    codes = VOUCHER_REGIONS[region.lower()]
    collected = parse_yyyymmdd("collect_start_date")
    latest = voucher.select(F.max(collected)).scalar()
    holders = voucher.where((collected >= latest) & F.col("region").isin(*codes)).select("vip_no")
    return audience.join(holders, "vip_no", "left_semi").distinct()


def voucher_audience_of_regions(audience: DataFrame, voucher: DataFrame, regions=tuple(VOUCHER_REGIONS)) -> DataFrame:
    """P2 for several regions in one plan: :func:`voucher_audience` of each, with a ``region`` column.

    The voucher table and the audience are read and shuffled once; a member
    holding vouchers of two regions is in both.
    """
    require_columns(voucher, ["vip_no", "collect_start_date", "region"], "voucher summary")
    place = None
    for r in regions:
        hit = F.col("region").isin(*VOUCHER_REGIONS[r.lower()])
        place = F.when(hit, r) if place is None else place.when(hit, r)
    collected = parse_yyyymmdd("collect_start_date")
    latest = voucher.select(F.max(collected)).scalar()
    codes = [c for r in regions for c in VOUCHER_REGIONS[r.lower()]]
    holders = (voucher.where((collected >= latest) & F.col("region").isin(*codes))
               .select("vip_no", place.alias("region")).distinct())
    return audience.join(holders, "vip_no", "inner").select(*audience.columns, "region").distinct()


def audience_grouped(audience: DataFrame) -> DataFrame:
    """``group`` = Male when gender is 'Male', else Female (NULL gender -> Female)."""
    return audience.withColumn("group", F.when(F.col("gender") == "Male", "Male").otherwise("Female"))


def audience_ids_by_group(grouped: DataFrame) -> DataFrame:
    """DISTINCT (vip_no, group), and region if the audience has one; the sink writes one dataset per group."""
    return grouped.select("vip_no", "group", *[c for c in grouped.columns if c == "region"]).distinct()


def audience_ids_of_group(grouped: DataFrame, group: str) -> DataFrame:
    """P4, single group: DISTINCT vip_no of one group (the reference's per-group view)."""
    return grouped.where(F.col("group") == group).select("vip_no").distinct()


def audience_filter_table(spark: SparkSession, nationalities=None, email_flags=EMAIL_VALID_FLAGS) -> DataFrame:
    """(region, group, attribute, value) rows of the audience filter configuration."""
    nationalities = NATIONALITIES if nationalities is None else nationalities
    rows = []
    for region, groups in nationalities.items():
        for group, codes in groups.items():
            rows += [(region, group, "nationality", code) for code in codes]
            rows += [(region, group, "email_valid_flg", flag) for flag in email_flags]
    return spark.createDataFrame(rows, "region string, `group` string, attribute string, value string")


def apply_audience_filter(members: DataFrame, filters: DataFrame, region: str,
                          attributes=("nationality", "email_valid_flg")) -> DataFrame:
    """Keep members whose value of every configured attribute is allowed for their group.

    ``members`` carries ``group`` (lower or title case) plus one column per
    attribute.  The filter table is configuration (a few rows per region and
    group); it is broadcast only while its estimated size is under the fixed
    bound, else the planner decides.
    """
    if region.lower() not in NATIONALITIES:
        # the configuration has no entry for this region (the reference's lookup fails too, D21)
        raise KeyError(f"no audience filter configured for region '{region}'")
    f = filters.where(F.col("region") == region.lower())
    out = members.withColumn("_grp", F.lower(F.col("group")))
    for attribute in attributes:
        allowed = f.where(F.col("attribute") == attribute).select(F.col("group").alias("_grp"),
                                                                   F.col("value").alias("_val"))
        out = out.join(broadcast_if_small(allowed), (out["_grp"] == allowed["_grp"]) & (out[attribute] == allowed["_val"]),
                       "left_semi")
    return out.drop("_grp")
