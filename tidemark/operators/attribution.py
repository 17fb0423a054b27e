"""Blast list, purchase attribution and email response."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import broadcast_if_small, date_window_join, parse_yyyymmdd, require_columns

# Customer type -> blast region, and the channel rule.
REGION_OF_CUST_TYPE = (("Hong Kong", "HK"), ("China", "CN"), ("Overseas", "ROW"))
CAMPAIGN_NAME_KEYWORD = "fprp_notification"
CAMPAIGN_CATEGORY = "Always On - FPRP"
ATTRIBUTION_DAYS = 7


def blast_region(cust_type="cust_type"):
    c = F.col(cust_type) if isinstance(cust_type, str) else cust_type
    expr = None
    for value, region in REGION_OF_CUST_TYPE:
        expr = F.when(c == value, region) if expr is None else expr.when(c == value, region)
    return expr  # no ELSE: unknown types give NULL (J5)


def blast_channel(edm_flag="promotion_edm_flg", email="email"):
    return F.when((F.col(edm_flag) == "Y") & F.col(email).isNotNull(), "EDM").otherwise("SMS")


def blast_list(history: DataFrame) -> DataFrame:
    """DISTINCT (vip, date, region, channel) of the blast history ('' email counts as EDM)."""
    require_columns(history, ["vip_no", "blast_date", "cust_type", "promotion_edm_flg", "email"], "blast history")
    return history.select(
        "vip_no", "blast_date", blast_region().alias("blast_region"), blast_channel().alias("blast_channel")
    ).distinct()


def individual_campaign_revenue(sales: DataFrame, redeem: DataFrame, blasts: DataFrame,
                                days: int = ATTRIBUTION_DAYS) -> DataFrame:
    """Voucher-redeemed purchases in ``[blast_date, blast_date + days]`` per blast member.

    The reference's two right joins followed by ``HAVING sum(qty) > 0`` keep
    only sales that have a redeem row and a matching blast, i.e. inner joins.
    Duplicate redeem rows multiply a sale (bag semantics), so the redeem side
    is reduced to one row per order with its multiplicity, and sales are
    pre-aggregated to one row per (member, day, order) before the window join:
    the join then moves order-level rows, not line-level ones, and the
    distinct-order count is unchanged.
    """
    require_columns(sales, ["order_no", "vip_no", "order_date", "amt_hkd", "dtl_qty"], "sales")
    redeem_n = redeem.groupBy("order_no").agg(F.count(F.lit(1)).alias("_redeems"))
    orders = (sales.join(redeem_n, "order_no", "inner")
              .select("vip_no", "order_no", parse_yyyymmdd("order_date").alias("_order_day"),
                      (F.col("amt_hkd") * F.col("_redeems")).alias("_amt"),
                      (F.col("dtl_qty") * F.col("_redeems")).alias("_qty"))
              .groupBy("vip_no", "_order_day", "order_no")
              .agg(F.sum("_amt").alias("_amt"), F.sum("_qty").alias("_qty")))
    b = blasts.select("vip_no", "blast_date", "blast_region", "blast_channel")
    hits = date_window_join(orders, b, ["vip_no"], "_order_day", "blast_date", days)
    amt_type = sales.schema["amt_hkd"].dataType
    rev_type = "decimal(%d,%d)" % (min(38, amt_type.precision + 10), amt_type.scale) \
        if hasattr(amt_type, "precision") else "double"
    return (hits.groupBy("blast_date", "blast_region", "blast_channel", "vip_no")
            .agg(F.sum("_amt").cast(rev_type).alias("campaign_revenue_hkd"),
                 F.sum("_qty").alias("campaign_purchase_qty"),
                 F.count_distinct("order_no").alias("campaign_transaction"))
            .where(F.col("campaign_purchase_qty") > 0))


def individual_email_response(details: DataFrame, contact: DataFrame, response: DataFrame,
                              keyword: str = CAMPAIGN_NAME_KEYWORD, category: str = CAMPAIGN_CATEGORY,
                              region_upper: bool = False) -> DataFrame:
    """send/open/click flags per contacted member who has response rows.

    Campaigns are matched by ``lower(name) LIKE '%keyword%'`` (``_`` is a
    one-character wildcard, as in SQL) and by category; ids containing "test"
    are excluded.  ``blast_region`` is the fifth ``_`` token of the name
    (``region_upper=True`` upper-cases it for lower-case names, D19).
    """
    dl = broadcast_if_small(details.where(F.lower(F.col("name")).like(f"%{keyword}%") & (F.col("campaign_category") == category))
                            .select("id", "name", "date_sent"))
    ids = dl.select(F.col("id").alias("campaign_id"))
    # Only this campaign's rows are shuffled: both large sides are cut to the
    # matching campaign ids first (a semi join whose small side is broadcast
    # while its size is under the bound), and the response is reduced to its
    # distinct triples.  Contacts and responses then meet on (campaign, member),
    # a key with one value per member, never on the campaign id alone.
    ct = (contact.where(~F.col("vip_no").like("%test%")).join(broadcast_if_small(ids), "campaign_id", "left_semi")
          .select("campaign_id", "vip_no").alias("CT"))
    rs = (response.join(broadcast_if_small(ids.withColumnRenamed("campaign_id", "id")), "id", "left_semi")
          .select("id", "vip_no", "source").distinct().alias("RS"))
    j = (ct.join(rs, (F.col("RS.id") == F.col("CT.campaign_id")) & (F.col("RS.vip_no") == F.col("CT.vip_no")), "inner")
         .join(dl.alias("DL"), F.col("DL.id") == F.col("CT.campaign_id"), "inner"))
    region = F.split_part(F.col("DL.name"), F.lit("_"), F.lit(5))
    if region_upper:
        region = F.upper(region)
    return j.select(
        F.col("DL.id").alias("campaign_id"),
        F.col("DL.name").alias("campaign_name"),
        F.col("DL.date_sent").cast("date").alias("blast_date"),
        region.alias("blast_region"),
        F.col("CT.vip_no").alias("vip_no"),
        F.when(F.col("CT.vip_no").isNotNull(), 1).otherwise(0).alias("send"),
        F.when(F.col("RS.source") == "mo", 1).otherwise(0).alias("open"),
        F.when(F.col("RS.source") == "click", 1).otherwise(0).alias("click"),
    ).distinct()


def lineitem_attribution(lineitem: DataFrame, orders: DataFrame, redeem: DataFrame, blasts: DataFrame,
                         days: int = ATTRIBUTION_DAYS) -> DataFrame:
    """P23 at order-line scale: members with a voucher-redeemed order in
    ``[blast_date, blast_date + days]`` and the quantity they bought, per blast date.

    ``redeem`` (order_no) multiplies an order by its number of rows, as in P23.
    Lines are summed per order before the order join, orders per (member, day)
    before the window join, so each shuffle moves pre-aggregated rows.
    """
    per_order = (lineitem.groupBy("l_orderkey")
                 .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("_q")))
    redeems = redeem.groupBy(F.col("order_no").alias("l_orderkey")).agg(F.count(F.lit(1)).alias("_redeems"))
    bought = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").cast("string").alias("vip_no"),
        F.col("o_orderdate").cast("date").alias("_order_day"))
    per_day = (per_order.join(redeems, "l_orderkey", "inner").join(bought, "l_orderkey", "inner")
               .groupBy("vip_no", "_order_day").agg(F.sum(F.col("_q") * F.col("_redeems")).alias("_q")))
    hits = date_window_join(per_day, blasts.select("vip_no", "blast_date"), ["vip_no"], "_order_day", "blast_date", days)
    # one row per (blast, member) first: the distinct count becomes a count
    members = hits.groupBy("blast_date", "vip_no").agg(F.sum("_q").alias("_q"))
    return members.groupBy("blast_date").agg(F.count("vip_no").alias("n"), F.sum("_q").alias("q"))
