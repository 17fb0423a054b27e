"""Which months of the KPI report new rows can change, and the inputs of those months alone (K3, P25).

A purchase counts for the blasts of the ``days`` days before it, so a late sale
of 3 March can change February.  The months are found from the new rows; the
report of a month is computed from its blasts, the purchases up to ``days`` days
after its last day and the responses to its campaigns, and is then the same as
in a computation over everything.
"""

from __future__ import annotations

import calendar
import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import parse_yyyymmdd
from tidemark.operators import attribution as att
from tidemark.operators import kpi

Month = tuple[int, int]


def months_of_blasts(blast_date: Column) -> Column:
    """The months a blast date is in: itself."""
    return F.array(F.trunc(blast_date, "month"))


def months_of_purchase(order_day: Column, days: int = att.ATTRIBUTION_DAYS) -> Column:
    """The months of all blast dates that a purchase of this day can be attributed to."""
    return F.sequence(F.trunc(F.date_sub(order_day, days), "month"), F.trunc(order_day, "month"), F.expr("interval 1 month"))


def affected_months(new_history: DataFrame | None = None, new_sales: DataFrame | None = None, new_sent: DataFrame | None = None,
                    days: int = att.ATTRIBUTION_DAYS) -> list[Month]:
    """(year, month) pairs whose report the new rows can change, in order.

    ``new_history`` has blast_date; ``new_sales`` has order_date (yyyyMMdd text):
    new sales and the sales of new redemptions; ``new_sent`` has date_sent: the
    campaigns that got new contacts or responses.  Null and malformed dates
    change nothing.  What comes to the driver is one row per month.
    """
    found = []
    if new_history is not None:
        found.append(new_history.select(F.explode(months_of_blasts(F.col("blast_date"))).alias("m")))
    if new_sales is not None:
        day = parse_yyyymmdd("order_date")
        found.append(new_sales.where(day.isNotNull()).select(F.explode(months_of_purchase(day, days)).alias("m")))
    if new_sent is not None:
        found.append(new_sent.select(F.explode(months_of_blasts(F.col("date_sent").cast("date"))).alias("m")))
    if not found:
        return []
    months = reduce(DataFrame.unionByName, found).where(F.col("m").isNotNull()).distinct()
    return sorted((r["m"].year, r["m"].month) for r in months.collect())


def _span(month: Month, days: int = 0) -> tuple[_dt.date, _dt.date]:
    last = _dt.date(*month, calendar.monthrange(*month)[1])
    return _dt.date(*month, 1), last + _dt.timedelta(days)


def _within(months: Sequence[Month], column: Column, days: int = 0) -> Column:
    """Plain range predicates on the stored column, which reach the scan."""
    return reduce(Column.__or__, [column.between(F.lit(a), F.lit(b)) for a, b in (_span(m, days) for m in months)], F.lit(False))


def months_report(months: Sequence[Month], history: DataFrame, sales: DataFrame, redeem: DataFrame, details: DataFrame, contact: DataFrame,
                  response: DataFrame, deduped: bool = False, days: int = att.ATTRIBUTION_DAYS) -> DataFrame:
    """P25 (or P26) of the given months; the inputs may hold any others."""
    blasts = att.blast_list(history.where(_within(months, F.col("blast_date"))))
    texts = [(a.strftime("%Y%m%d"), b.strftime("%Y%m%d")) for a, b in (_span(m, days) for m in months)]
    bought = sales.where(reduce(Column.__or__, [F.col("order_date").between(a, b) for a, b in texts], F.lit(False)))
    sent = details.where(_within(months, F.col("date_sent").cast("date")))
    revenue = att.individual_campaign_revenue(bought, redeem, blasts, days)
    answers = att.individual_email_response(sent, contact, response)
    return (kpi.monthly_kpi_deduped if deduped else kpi.monthly_kpi)(blasts, revenue, answers)


def month_key(month: Month) -> tuple[int, str]:
    """The report's (blast_year, blast_month) of a month."""
    return month[0], f"{month[1]:>2}"
