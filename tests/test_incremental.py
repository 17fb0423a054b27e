import datetime as dt
from decimal import Decimal

import pytest

from tidemark.operators import incremental as inc
from tidemark.plans import catalog, jobs
from tidemark.sinks import read_versioned, versioned
from tidemark.sources.relations import Tables
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def _one(spark, value, schema):
    return spark.createDataFrame([(value,)], schema)


@pytest.mark.parametrize("day, months", [
    ("20240303", [(2024, 2), (2024, 3)]), ("20240307", [(2024, 2), (2024, 3)]), ("20240308", [(2024, 3)]),
    ("20240101", [(2023, 12), (2024, 1)]), ("20240131", [(2024, 1)]), ("not a day", []), (None, [])])
def test_a_sale_touches_the_months_of_its_window(spark, day, months):
    assert inc.affected_months(new_sales=_one(spark, day, "order_date string")) == months
    first, last = (dt.date(2023, 1, 1), dt.date(2025, 1, 1))
    if day and day.isdigit():      # by definition: the months of every blast date that the window join would accept
        d = dt.datetime.strptime(day, "%Y%m%d").date()
        every = [first + dt.timedelta(i) for i in range((last - first).days)]
        assert months == sorted({(b.year, b.month) for b in every if b <= d <= b + dt.timedelta(7)})


def test_blasts_and_campaigns_touch_their_own_month(spark):
    history, sent = _one(spark, dt.date(2024, 2, 29), "blast_date date"), _one(spark, dt.date(2023, 12, 1), "date_sent date")
    assert inc.affected_months(new_history=history, new_sent=sent) == [(2023, 12), (2024, 2)]
    assert inc.affected_months(new_history=history.limit(0)) == [] == inc.affected_months()


def test_second_load_leaves_other_months_alone(spark, scratch):
    """Equal to the report over everything is the oracle's part; here: what the second load touched."""
    path = scratch + "/report"
    first, second = catalog.load_report_twice(Tables(spark, SF), path)
    assert first == [(2023, 12), (2024, 1)] and second == [(2024, 1), (2024, 2)]
    old, new = versioned._manifest(spark, path, 1), versioned._manifest(spark, path, 2)
    data = lambda m: {tuple(p["values"]): p["data"] for p in m["parts"]}
    assert set(data(new)) == {("2023", "12"), ("2024", " 1"), ("2024", " 2")}
    assert data(new)["2023", "12"] == data(old)["2023", "12"] and data(new)["2024", " 1"] != data(old)["2024", " 1"]
    before, after = (rows(read_versioned(spark, path, v).where("blast_month = ' 1'"), "blast_channel", "campaign_revenue") for v in (1, 2))
    assert before != after


def _inputs(spark, sales):
    member = ("a", "Hong Kong", "Y", "a@example.com")
    history = spark.createDataFrame([(member[0], d, *member[1:]) for d in (dt.date(2024, 1, 30), dt.date(2024, 2, 6))],
                                    "vip_no string, blast_date date, cust_type string, promotion_edm_flg string, email string")
    sales = spark.createDataFrame(sales, "order_no string, vip_no string, order_date string, amt_hkd decimal(18,2), dtl_qty bigint")
    details = spark.createDataFrame([], "id string, name string, date_sent date, campaign_category string")
    contact = spark.createDataFrame([], "campaign_id string, vip_no string")
    response = spark.createDataFrame([], "id string, vip_no string, source string")
    return history, sales, sales.select("order_no"), details, contact, response


@pytest.mark.parametrize("deduped", [False, True])
def test_late_sale_changes_the_month_before(spark, scratch, deduped):
    path = scratch + "/report"
    early, late = ("1", "a", "20240206", Decimal("5.00"), 1), ("2", "a", "20240201", Decimal("7.00"), 2)
    jobs.refresh_kpi(path, [(2024, 1), (2024, 2)], *_inputs(spark, [early]), deduped=deduped)
    everything = _inputs(spark, [early, late])
    months = inc.affected_months(new_sales=everything[1].where("order_no = '2'"))
    assert months == [(2024, 1), (2024, 2)]
    jobs.refresh_kpi(path, months, *everything, deduped=deduped)
    got = rows(read_versioned(spark, path), "blast_month", "campaign_revenue", "number_of_purchaser")
    assert got == [(" 1", Decimal("12.00"), 1), (" 2", Decimal("5.00"), 1)]
    assert rows(read_versioned(spark, path)) == rows(jobs.run_kpi_monitor(*everything, deduped=deduped))
    assert jobs.refresh_kpi(path, [], *everything) is None
    gone = (everything[0].where("blast_date > '2024-02-01'"), *everything[1:])
    jobs.refresh_kpi(path, [(2024, 1)], *gone, deduped=deduped)
    assert rows(read_versioned(spark, path), "blast_month") == [(" 2",)]


def test_only_the_months_are_read(spark, scratch):
    history, sales, *others = _inputs(spark, [("1", "a", "20240206", Decimal("5.00"), 1)])
    history.write.parquet(scratch + "/history")
    sales.write.parquet(scratch + "/sales")
    report = inc.months_report([(2024, 2)], spark.read.parquet(scratch + "/history"), spark.read.parquet(scratch + "/sales"), *others)
    plan = spark._jvm.PythonSQLUtils.explainString(report._jdf.queryExecution(), "formatted")
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert any("blast_date,2024-02-01" in p and "blast_date,2024-02-29" in p for p in pushed)
    assert any("order_date,20240201" in p and "order_date,20240307" in p for p in pushed)
