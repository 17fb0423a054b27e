import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import reach
from tidemark.operators.funnel import blast_funnel
from tidemark.plans import jobs
from tidemark.sinks import read_versioned, versioned
from tests.conftest import rows

D1, D2, FEB = dt.date(2024, 1, 3), dt.date(2024, 1, 10), dt.date(2024, 2, 7)
BL = "vip_no string, blast_date date, blast_region string, blast_channel string"


def _blasts(spark, seed=7, members=70_000):
    """More members than one block of 32,768 numbers, repeats across dates, channels and a null region."""
    rnd = random.Random(seed)
    data = [(f"v{rnd.randrange(members):06d}", d, rnd.choice(["HK", "CN", None]), rnd.choice(["EDM", "SMS"]))
            for d in (D1, D2, FEB) for _ in range(20_000)]
    return spark.createDataFrame(data + [(None, D1, "HK", "EDM"), (None, FEB, "ROW", "SMS")], BL)


def test_bitmap_counts_equal_distinct_counts(spark):
    blasts = _blasts(spark).cache()
    everyone = spark.range(70_000).select(F.format_string("v%06d", "id").alias("vip_no"))
    numbers = reach.member_numbers(everyone).cache()
    top = numbers.agg(F.min("member_no"), F.max("member_no"), F.count_distinct("member_no")).first()
    assert tuple(top) == (0, 69_999, 70_000)
    bits = reach.reach_bitmaps(blasts, numbers, reach.DAY_KEYS[1:]).cache()
    assert bits.select("block").distinct().count() == 4                     # three blocks, and the null one
    for keys in (reach.DAY_KEYS[1:], ["blast_date"], ["blast_region"], []):
        got = rows(reach.reach_counts(reach.merged_reach(bits, keys), keys, "n"), *keys, "n")
        assert got == rows(blasts.groupBy(*keys).agg(F.count_distinct("vip_no").alias("n")), *keys, "n")


def test_merge_moves_no_member_ids(spark):
    numbers = reach.member_numbers(_blasts(spark).limit(50))
    bits = reach.reach_bitmaps(_blasts(spark).where("vip_no is null"), numbers, ["blast_date"]).checkpoint()
    merged = reach.reach_counts(reach.merged_reach(bits, ["blast_date"]), ["blast_date"])
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "vip_no" not in plan and "member_no" not in plan


def test_numbers_stay_and_new_members_follow(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "vip_no string")
    first = reach.member_numbers(ids("m", "c", "m", None))
    assert rows(first) == [("c", 0), ("m", 1)]
    more = reach.member_numbers(ids("a", "m", "z"), first)
    assert rows(more) == [("a", 2), ("c", 0), ("m", 1), ("z", 3)]
    assert rows(reach.member_numbers(ids(), more)) == rows(more)
    assert rows(reach.member_numbers(ids("b"), reach.member_numbers(ids()))) == [("b", 0)]


def test_unknown_member_is_an_error(spark):
    numbers = spark.createDataFrame([("a", 0)], reach.NUMBERS_SCHEMA)
    blasts = spark.createDataFrame([("a", D1, "HK", "EDM"), ("b", D1, "HK", "EDM")], BL)
    with pytest.raises(PySparkException, match="member without a number: b"):
        reach.reach_bitmaps(blasts, numbers, ["blast_date"]).collect()


def test_stored_reach_by_run(spark, scratch):
    """Two runs, one of them repeated with fewer members: the month follows the last state of each date."""
    numbers, stored = scratch + "/numbers", scratch + "/reach"
    rev = "blast_date date, blast_region string, blast_channel string, vip_no string"
    row = lambda v, d, c="EDM": (v, d, "HK", c)
    frame = lambda *r: spark.createDataFrame(list(r), BL)
    bought = spark.createDataFrame([(D1, "HK", "EDM", "a"), (D2, "HK", "EDM", "c"), (D2, "HK", "EDM", "zz")], rev)
    jobs.store_reach(numbers, stored, frame(row("b", D1), row("a", D1)), bought, [D1])
    jobs.store_reach(numbers, stored, frame(row("a", D2), row("c", D2), row("d", D2)), bought, [D2])
    got = reach.monthly_reach(read_versioned(spark, stored))
    assert rows(got, "blast_month", "campaign_size", "number_of_purchaser", "conversion_rate") == [(" 1", 4, 2, 0.5)]
    jobs.store_reach(numbers, stored, frame(row("a", D2)), bought, [D2])
    got = reach.monthly_reach(read_versioned(spark, stored))
    assert rows(got, "campaign_size", "number_of_purchaser") == [(2, 1)]
    jobs.store_reach(numbers, stored, frame(row("a", D2)).limit(0), bought, [D1, D2])
    assert reach.monthly_reach(read_versioned(spark, stored)).count() == 0
    assert rows(versioned.read_versioned(spark, numbers)) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


@pytest.mark.parametrize("empty", [False, True])
def test_funnel_of_bitmaps_equals_the_funnel(spark, empty):
    people = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("c",)], "vip_no string")
    pers = spark.createDataFrame([("a", D1), ("a", D2), ("seed", D2), (None, FEB)], "customer_id string, blast_date date")
    if empty:
        people, pers = people.limit(0), pers.limit(0)
    recs = people.where("vip_no <> 'c'")
    members = reach.funnel_members(people, recs, pers)
    bits = reach.reach_bitmaps(members, reach.member_numbers(members), reach.FUNNEL_KEYS)
    want = blast_funnel(people, recs, pers)
    assert rows(reach.funnel_of_bitmaps(bits), *want.columns) == rows(want)
