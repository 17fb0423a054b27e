"""Session temp views under the step names of the original runs, so ad-hoc
SQL written against those views keeps working (``spark.sql("select * from
monthly_kpi")``).  Each view is the lazy operator output; nothing is computed
until a query reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import attribution as att
from tidemark.operators import audience as aud
from tidemark.operators import feeds
from tidemark.operators import items
from tidemark.operators import kpi


def _register(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def register_kpi_views(history: DataFrame, sales: DataFrame, redeem: DataFrame, details: DataFrame,
                       contact: DataFrame, response: DataFrame) -> dict[str, DataFrame]:
    """blast_list, individual_campaign_revenue, individual_email_response, monthly_kpi."""
    blasts = att.blast_list(history)
    revenue = att.individual_campaign_revenue(sales, redeem, blasts)
    resp = att.individual_email_response(details, contact, response)
    return _register({
        "blast_list": blasts,
        "individual_campaign_revenue": revenue,
        "individual_email_response": resp,
        "monthly_kpi": kpi.monthly_kpi(blasts, revenue, resp),
    })


def register_audience_views(snapshot: DataFrame, reachable: DataFrame, voucher: DataFrame, region: str,
                            pub: DataFrame, start: DataFrame, item: DataFrame, as_of) -> dict[str, DataFrame]:
    """audience0, audience, CUST_LIST_grouped / _male / _female, new_in_list, new_in_list_final."""
    audience0 = aud.active_reachable_audience(snapshot, reachable)
    audience = aud.voucher_audience(audience0, voucher, region)
    grouped = aud.audience_grouped(audience)
    new_in = items.new_in_list_direct(pub, start, item, region, as_of)
    return _register({
        "audience0": audience0,
        "audience": audience,
        "CUST_LIST_grouped": grouped,
        "CUST_LIST_male": aud.audience_ids_of_group(grouped, "Male"),
        "CUST_LIST_female": aud.audience_ids_of_group(grouped, "Female"),
        "new_in_list": new_in,
        "new_in_list_final": items.new_in_list_final(new_in, as_of),
    })


def register_blast_views(region_list: DataFrame, item: DataFrame, region: str, created_date) -> dict[str, DataFrame]:
    """<region>_list, product_recommendation_<region>, products_<region>, campaign_personalization_<region>."""
    return _register({
        f"{region}_list": region_list,
        f"product_recommendation_{region}": feeds.export_order(feeds.product_recommendation(region_list, created_date)),
        f"products_{region}": feeds.products(region_list, item, created_date),
        f"campaign_personalization_{region}": feeds.campaign_personalization(region_list, created_date),
    })
