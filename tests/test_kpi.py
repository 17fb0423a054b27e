import datetime as dt
from decimal import Decimal

from tidemark.operators.kpi import monthly_kpi, monthly_kpi_deduped
from tests.conftest import rows

D = dt.date(2024, 3, 6)
BL = "vip_no string, blast_date date, blast_region string, blast_channel string"
REV = ("blast_date date, blast_region string, blast_channel string, vip_no string, "
       "campaign_revenue_hkd decimal(28,2), campaign_purchase_qty bigint, campaign_transaction bigint")
RESP = "vip_no string, blast_date date, blast_region string, open int, click int"


def _frames(spark, response):
    blasts = spark.createDataFrame([("a", D, "HK", "EDM"), ("b", D, "HK", "EDM"), ("c", D, "HK", "SMS")], BL)
    revenue = spark.createDataFrame([(D, "HK", "EDM", "a", Decimal("100.00"), 3, 2)], REV)
    return blasts, revenue, spark.createDataFrame(response, RESP)


def test_fan_out_exact_vs_deduped(spark):
    # buyer "a" opened and clicked: two response rows; "b" opened but bought nothing
    blasts, revenue, resp = _frames(spark, [("a", D, "HK", 1, 0), ("a", D, "HK", 0, 1), ("b", D, "HK", 1, 0)])
    exact = {r["blast_channel"]: r for r in monthly_kpi(blasts, revenue, resp).collect()}
    dedup = {r["blast_channel"]: r for r in monthly_kpi_deduped(blasts, revenue, resp).collect()}
    e, d = exact["EDM"], dedup["EDM"]
    assert (e.campaign_size, e.number_of_purchaser, e.edm_open, e.edm_click) == (2, 1, 1, 1)
    assert (e.number_of_transaction, e.campaign_revenue, e.campaign_quantity) == (4, Decimal("200.00"), 6)
    assert (d.number_of_transaction, d.campaign_revenue, d.campaign_quantity) == (2, Decimal("100.00"), 3)
    assert (d.edm_open, d.edm_click) == (1, 1)   # non-buyer opener "b" is not counted (buyer scope)
    assert e.blast_month == " 3" and e.blast_year == 2024
    assert e.conversion_rate == 0.5
    sms = exact["SMS"]
    assert sms.number_of_transaction is None and sms.campaign_revenue is None and sms.number_of_purchaser == 0


def test_equal_without_fan_out(spark):
    blasts, revenue, resp = _frames(spark, [("a", D, "HK", 1, 1)])
    assert rows(monthly_kpi(blasts, revenue, resp)) == rows(monthly_kpi_deduped(blasts, revenue, resp))


def test_two_channels_same_date_cross_multiply_only_in_exact(spark):
    # member "a" is in the history twice on one date (EDM and SMS) and bought in both channel rows
    blasts = spark.createDataFrame([("a", D, "HK", "EDM"), ("a", D, "HK", "SMS")], BL)
    revenue = spark.createDataFrame([(D, "HK", "EDM", "a", Decimal("10.00"), 1, 1),
                                     (D, "HK", "SMS", "a", Decimal("30.00"), 2, 1)], REV)
    resp = spark.createDataFrame([], RESP)
    exact = {r.blast_channel: r for r in monthly_kpi(blasts, revenue, resp).collect()}
    dedup = {r.blast_channel: r for r in monthly_kpi_deduped(blasts, revenue, resp).collect()}
    # exact (D6b): each channel row joins both revenue rows of (vip, date)
    assert exact["EDM"].campaign_revenue == Decimal("40.00") and exact["SMS"].campaign_revenue == Decimal("40.00")
    assert dedup["EDM"].campaign_revenue == Decimal("10.00") and dedup["SMS"].campaign_revenue == Decimal("30.00")
