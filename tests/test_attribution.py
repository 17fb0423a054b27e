import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import date_window_join
from tidemark.operators.attribution import (blast_list, individual_campaign_revenue, individual_email_response,
                                            lineitem_attribution)
from tests.conftest import rows

D = dt.date(2024, 1, 3)


def test_blast_list_region_and_channel(spark):
    hist = spark.createDataFrame([
        ("a", D, "Hong Kong", "Y", ""),      # '' email counts as EDM
        ("a", D, "Hong Kong", "Y", ""),      # exact duplicate collapses
        ("b", D, "China", "Y", None),        # NULL email -> SMS
        ("c", D, "Staff", "N", "x@y"),       # unknown type -> NULL region
        ("d", D, "Overseas", "N", "x@y"),
    ], "vip_no string, blast_date date, cust_type string, promotion_edm_flg string, email string")
    assert rows(blast_list(hist)) == sorted([
        ("a", D, "HK", "EDM"), ("b", D, "CN", "SMS"), ("c", D, None, "SMS"), ("d", D, "ROW", "SMS")], key=repr)


def _sales(spark, data):
    return spark.createDataFrame(
        [(o, v, d, Decimal(a), q) for o, v, d, a, q in data],
        "order_no string, vip_no string, order_date string, amt_hkd decimal(18,2), dtl_qty bigint")


def test_revenue_window_redeem_and_having(spark):
    sales = _sales(spark, [
        ("o1", "v1", "20240102", "10.00", 1),   # day -1: outside
        ("o2", "v1", "20240103", "20.00", 2),   # day 0
        ("o3", "v1", "20240110", "30.00", 3),   # day 7: inside (inclusive)
        ("o4", "v1", "20240111", "40.00", 4),   # day 8: outside
        ("o5", "v1", "20240103", "50.00", 5),   # not redeemed
        ("o6", "v1", "20240104", "5.00", 1),    # redeemed twice: counted twice
        ("o7", "v2", "20240103", "1.00", -1),   # qty sums below zero: dropped
        ("o8", "v3", "20240103", "1.00", 0),    # qty sums to zero: dropped
        ("o9", "v1", "2024XX03", "9.00", 9),    # malformed date: never matches
    ])
    redeem = spark.createDataFrame([(o,) for o in ["o1", "o2", "o3", "o4", "o6", "o6", "o7", "o8", "o9"]],
                                   "order_no string")
    blasts = spark.createDataFrame([(v, D, "HK", "EDM") for v in ["v1", "v2", "v3", "v4"]],
                                   "vip_no string, blast_date date, blast_region string, blast_channel string")
    out = individual_campaign_revenue(sales, redeem, blasts)
    assert out.schema["campaign_revenue_hkd"].dataType.simpleString() == "decimal(28,2)"
    assert rows(out) == [(D, "HK", "EDM", "v1", Decimal("60.00"), 7, 3)]


def test_date_window_join_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(2023, 12, 1)
    facts = [(f"k{rnd.randint(0, 5)}", base + dt.timedelta(days=rnd.randint(0, 90)), i) for i in range(400)]
    wins = [(f"k{rnd.randint(0, 5)}", base + dt.timedelta(days=rnd.randint(-10, 90)), j) for j in range(60)]
    left = spark.createDataFrame(facts, "k string, d date, fid int")
    right = spark.createDataFrame(wins, "k string, start date, wid int")
    for days in (0, 1, 7, 30):
        got = rows(date_window_join(left, right, ["k"], "d", "start", days).select("fid", "wid"))
        want = sorted(((f[2], w[2]) for f in facts for w in wins
                       if f[0] == w[0] and w[1] <= f[1] <= w[1] + dt.timedelta(days=days)), key=repr)
        assert got == want, days


def test_email_response_filters(spark):
    details = spark.createDataFrame([
        ("c1", "lc_fprp_notification_20240103_HK", D, "Always On - FPRP"),
        ("c2", "lc_fprpXnotification_20240103_HK", D, "Always On - FPRP"),   # "_" wildcard; 4 tokens
        ("c3", "lc_fprp_notification_20240103_CN", D, "Other"),               # wrong category
        ("c4", "lc_fprp_notification_HK", D, "Always On - FPRP"),             # 4 tokens -> region ''
    ], "id string, name string, date_sent date, campaign_category string")
    contact = spark.createDataFrame([("c1", "v1"), ("c1", "test_v"), ("c2", "v2"), ("c3", "v3"), ("c4", "v4")],
                                    "campaign_id string, vip_no string")
    response = spark.createDataFrame([("c1", "v1", "mo"), ("c1", "v1", "click"), ("c1", "test_v", "mo"),
                                      ("c2", "v2", "error"), ("c3", "v3", "mo"), ("c4", "v4", "click")],
                                     "id string, vip_no string, source string")
    out = individual_email_response(details, contact, response)
    got = rows(out, "campaign_id", "vip_no", "blast_region", "send", "open", "click")
    assert got == sorted([("c1", "v1", "HK", 1, 1, 0), ("c1", "v1", "HK", 1, 0, 1), ("c2", "v2", "", 1, 0, 0),
                          ("c4", "v4", "", 1, 0, 1)], key=repr)


def test_lineitem_attribution_brute_force(spark):
    lines = spark.createDataFrame([(1, 5.0), (1, 2.0), (2, 1.0), (3, 4.0), (4, 8.0)],
                                  "l_orderkey bigint, l_quantity double")
    orders = spark.createDataFrame([
        (1, 10, "1-URGENT", dt.datetime(2000, 1, 3)), (2, 10, "1-URGENT", dt.datetime(2000, 1, 9)),
        (3, 11, "2-HIGH", dt.datetime(2000, 1, 2)), (4, 11, "1-URGENT", dt.datetime(2000, 2, 8))],
        "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderdate timestamp_ntz")
    blasts = spark.createDataFrame([("10", dt.date(2000, 1, 1)), ("11", dt.date(2000, 1, 1)),
                                    ("11", dt.date(2000, 2, 1))], "vip_no string, blast_date date")
    redeem = spark.createDataFrame([(1,), (2,), (4,), (4,)], "order_no bigint")
    out = lineitem_attribution(lines, orders, redeem, blasts)
    # order 2 is on day 8 of the January blast: outside; order 3 is not redeemed; order 4 is on day 7
    # of February: inside, and redeemed twice
    assert rows(out) == [(dt.date(2000, 1, 1), 1, 7), (dt.date(2000, 2, 1), 1, 16)]


def test_window_join_spreads_a_hot_member(spark):
    """A member holding most facts and windows is split over time buckets, not sent to one task."""
    base = dt.date(2024, 1, 1)
    facts = [("hot", base + dt.timedelta(days=i % 360), i) for i in range(3000)] + [("cold", base, -1)]
    wins = [("hot", base + dt.timedelta(days=7 * w), w) for w in range(50)]
    left = spark.createDataFrame(facts, "k string, d date, fid int")
    right = spark.createDataFrame(wins, "k string, start date, wid int")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.coalescePartitions.enabled")
    for k, v in zip(keys, ("-1", "-1", "false")):
        spark.conf.set(k, v)
    try:
        joined = date_window_join(left, right, ["k"], "d", "start", 7)
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert len(per_task) > 1
    total = sum(r["count"] for r in per_task)
    assert max(r["count"] for r in per_task) < total
