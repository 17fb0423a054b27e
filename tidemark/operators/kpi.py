"""Monthly campaign KPI (P25) and its fan-out-free variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import month_padded

# Fixed value: the campaign label of the KPI report.
KPI_CAMPAIGN_NAME = "FPRP Notification"

KPI_COLUMNS = ["campaign_name", "blast_year", "blast_month", "blast_region", "blast_channel", "campaign_size",
               "edm_open", "edm_click", "number_of_purchaser", "number_of_transaction", "campaign_revenue",
               "campaign_quantity", "conversion_rate"]


def _kpi(blasts: DataFrame, bought: DataFrame, on, campaign_name: str) -> DataFrame:
    """The report from ``bought``, one row per purchase key with its sums.

    Members are reduced to one row per (month, region, channel, member) before
    the report groups, so the distinct counts become plain counts.
    """
    sums = ["open", "click", "trans", "revenue", "qty"]
    members = (blasts.join(bought, on, "left")
               .groupBy(F.year("C.blast_date").alias("blast_year"), month_padded("C.blast_date").alias("blast_month"),
                        F.col("C.blast_region").alias("blast_region"), F.col("C.blast_channel").alias("blast_channel"),
                        F.col("C.vip_no").alias("vip_no"))
               .agg(*[F.sum(f"AB.{c}").alias(c) for c in sums], F.count("AB.vip_no").alias("buys")))
    buyer = F.when(F.col("buys") > 0, F.lit(1).cast("long"))
    return (members.groupBy(F.lit(campaign_name).alias("campaign_name"), "blast_year", "blast_month", "blast_region", "blast_channel")
            .agg(F.count("vip_no").alias("campaign_size"),
                 F.sum("open").alias("edm_open"),
                 F.sum("click").alias("edm_click"),
                 F.count(buyer).alias("number_of_purchaser"),
                 F.sum("trans").alias("number_of_transaction"),
                 F.sum("revenue").alias("campaign_revenue"),
                 F.round(F.sum("qty"), 0).alias("campaign_quantity"),
                 (F.count(buyer) / F.count("vip_no")).alias("conversion_rate"))
            .select(*KPI_COLUMNS))


def _with_response(revenue: DataFrame, response: DataFrame) -> DataFrame:
    """Revenue rows left-joined to the response of the EDM channel on (vip, date, region)."""
    a, b = revenue.alias("A"), response.alias("B")
    return a.join(b, (F.col("A.vip_no") == F.col("B.vip_no")) & (F.col("A.blast_date") == F.col("B.blast_date"))
                  & (F.col("A.blast_region") == F.col("B.blast_region")) & (F.col("A.blast_channel") == F.lit("EDM")), "left")


def _sums() -> list:
    return [F.sum("B.open").alias("open"), F.sum("B.click").alias("click"), F.sum("A.campaign_transaction").alias("trans"),
            F.sum("A.campaign_revenue_hkd").alias("revenue"), F.sum("A.campaign_purchase_qty").alias("qty")]


def monthly_kpi(blasts: DataFrame, revenue: DataFrame, response: DataFrame,
                campaign_name: str = KPI_CAMPAIGN_NAME) -> DataFrame:
    """P25, reference-exact.

    Revenue joins the blast list on (vip, date) only, and the response joins
    revenue rows of the EDM channel on (vip, date, region).  A buyer with an
    open and a click row therefore counts its transactions, revenue and
    quantity once per response row (fan-out, D5); opens and clicks are only
    seen for buyers (D6).  Sums over groups without rows stay NULL (D18).

    The two small sides meet first (the response condition uses only them) and
    are summed to one row per (vip, date); the large blast list is joined once,
    on keys that are its own, and no join key is null for non-buyers.
    """
    bought = (_with_response(revenue, response).groupBy(F.col("A.vip_no").alias("vip_no"), F.col("A.blast_date").alias("blast_date"))
              .agg(*_sums()).alias("AB"))
    on = (F.col("C.vip_no") == F.col("AB.vip_no")) & (F.col("C.blast_date") == F.col("AB.blast_date"))
    return _kpi(blasts.alias("C"), bought, on, campaign_name)


def monthly_kpi_deduped(blasts: DataFrame, revenue: DataFrame, response: DataFrame,
                        campaign_name: str = KPI_CAMPAIGN_NAME) -> DataFrame:
    """P25 without the response fan-out.

    The response is pre-aggregated to one row per (vip, date, region) with
    ``max(open)``, ``max(click)`` (an opener who also clicks counts once for
    each), and revenue joins on region (null-safe) and channel as well, so a
    member blasted twice on one date is not cross-multiplied.  Buyer-only
    scope of opens and clicks is kept (D6).  Same plan shape as P25.
    """
    resp = (response.groupBy("vip_no", "blast_date", "blast_region")
            .agg(F.max("open").alias("open"), F.max("click").alias("click")))
    keys = ["vip_no", "blast_date", "blast_region", "blast_channel"]
    bought = _with_response(revenue, resp).groupBy(*[F.col(f"A.{k}").alias(k) for k in keys]).agg(*_sums()).alias("AB")
    on = ((F.col("C.vip_no") == F.col("AB.vip_no")) & (F.col("C.blast_date") == F.col("AB.blast_date"))
          & (F.col("C.blast_channel") == F.col("AB.blast_channel")) & F.col("C.blast_region").eqNullSafe(F.col("AB.blast_region")))
    return _kpi(blasts.alias("C"), bought, on, campaign_name)
