import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import blast as bl
from tidemark.operators import feeds
from tidemark.operators.funnel import blast_funnel
from tidemark.functions.slots import SLOTS
from tests.conftest import rows

BD = dt.date(2024, 1, 10)
RUN = dt.date(2024, 1, 9)


def _recs(spark, data):
    """data: vip -> (codes[8], brands[8])"""
    cols = ["vip_no"] + [f"{p}_{i}" for p in ("atg_code", "brand_desc", "prod_desc", "Global_Exclusive") for i in SLOTS]
    out = []
    for vip, (codes, brands) in data.items():
        out.append((vip, *codes, *brands, *[f"p{i}" for i in SLOTS], *["N"] * 8))
    return spark.createDataFrame(out, ", ".join(f"{c} string" for c in cols))


def _audience(spark, vips):
    return spark.createDataFrame(
        [(v, "Y", f"{v}@x", "gold", "Male" if i % 2 else "Female", f"name{v}", "EN", "Hong Kong") for i, v in enumerate(vips)],
        "vip_no string, promotion_edm_flg string, email string, card_type string, `group` string, "
        "customer_name_shortened_chi string, pref_lang string, cust_type string")


GOOD = ([f"{i:06d}" for i in range(1, 9)], ["A", "B", "A", "C", "D", "D", "E", "F"])


def _base(spark):
    data = {
        "v1": GOOD,
        "v2": ([f"{i:06d}" for i in [1, 2, 3, 4, 5, 6, 7, 7]], ["A"] * 8),          # duplicate code
        "v3": ([f"{i:06d}" for i in range(1, 8)] + ["0000008"], ["B", "A"] + ["A"] * 6),  # 7-char code
        "v4": ([f"{i:06d}" for i in range(1, 8)] + [None], ["A"] * 7 + [None]),     # NULL slot
    }
    return bl.blast_base(_recs(spark, data), _audience(spark, list(data)), BD)


def test_blast_base_packs_with_null_propagation(spark):
    base = _base(spark)
    got = {r.vip_no: (r.atg_code, r.brand, r.blast_date, r.campaign_id) for r in base.collect()}
    assert got["v1"][0] == "|".join(GOOD[0]) and got["v1"][2] == BD and got["v1"][3] == "fprp_notification"
    assert got["v4"][0] is None and got["v4"][1] is None
    assert "Language" in base.columns


def test_slot_quality(spark):
    base = _base(spark)
    assert rows(bl.slot_quality_ok(base), "vip_no") == [("v1",)]
    assert rows(bl.slot_quality_rejects(base), "vip_no", "valid_codes") == [("v2", 7), ("v3", 7), ("v4", 0)]


def test_top_brands(spark):
    base = bl.top_brands(_base(spark))
    got = {r.vip_no: (r.top_1_brand, r.top_2_brand, r.top_3_brand) for r in base.collect()}
    assert got["v1"] == ("A", "B", "C")
    assert got["v2"] == ("A", "", "")
    assert got["v3"] == ("B", "A", "")
    assert got["v4"] == ("", "", "")


def test_seeds_reproducible_and_bounded(spark):
    base = _base(spark)
    s1 = bl.blast_with_seeds(base, ("t1", "t2"), "salt")
    s2 = bl.blast_with_seeds(base, ("t1", "t2"), "salt")
    assert s1.count() == 6
    seeds1 = rows(s1.where(F.col("vip_no").startswith("t")), "vip_no", "atg_code", "email")
    assert seeds1 == rows(s2.where(F.col("vip_no").startswith("t")), "vip_no", "atg_code", "email")
    assert all(r[2] == "" for r in seeds1)
    one = base.where("vip_no = 'v1'")
    assert rows(bl.blast_with_seeds(one, ("t1", "t2"), "salt"), "vip_no") == [("t1",), ("v1",)]


def test_utm_tags(spark):
    tagged = bl.utm_tags(_base(spark), BD)
    got = {r["group"]: (r.utm_source, r.utm_campaign) for r in tagged.collect()}
    assert got["Female"] == ("female_DB", "gg_prodlisting-fprp_notification_20240110")
    assert got["Male"][0] == "Male_DB"


def _list(spark):
    return bl.region_list(_base(spark), BD, ("t1",), "s")


def test_product_recommendation_long_form(spark):
    lst = _list(spark)
    long = feeds.product_recommendation(lst, RUN)
    assert long.count() == 8 * lst.count()
    assert sorted(r.display_id for r in long.where("customer_id = 'v1'").collect()) == list(range(1, 9))
    plain = feeds.product_recommendation(_base(spark), RUN)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    # one Generate over a single read of the list, no 8-way UNION, no Python
    assert "Generate" in plan and "EvalPython" not in plan and "Union" not in plan


def test_products_slot_one_inner_rest_left(spark):
    codes = [f"{i:06d}" for i in range(1, 9)]
    lst = bl.region_list(bl.blast_base(_recs(spark, {"v1": (codes, ["B"] * 8)}), _audience(spark, ["v1"]), BD), BD, ())
    # item master lacks slot 1 (000001) and slot 3 (000003)
    item = spark.createDataFrame([(c, f"en{c}", None if c == "000002" else f"tc{c}", f"br{c}") for c in codes
                                  if c not in ("000001", "000003")],
                                 "atg_code string, prod_desc_eng string, prod_desc_tc string, brand_desc string")
    got = {r.product_id: r for r in feeds.products(lst, item, RUN).collect()}
    assert "000001" not in got                       # unknown in slot 1: inner join drops it
    assert got["000003"].product_description_en is None   # unknown in slot 3: kept by the left join
    assert got["000002"].product_description_cn == "en000002"  # NULL Chinese text falls back to English
    assert len(got) == 7


def test_personalization_and_funnel(spark):
    lst = _list(spark)
    pers = feeds.campaign_personalization(lst, RUN)
    r = pers.collect()[0]
    assert (r.subject_line, r.message, r.title, r.utm_medium, r.created_date) == ("", "", "", "email", RUN)
    audience = _audience(spark, ["v1", "v2", "v3", "v4", "v5"])
    recs = _recs(spark, {"v1": GOOD, "v2": GOOD})
    f = {r.source: (r.vips, r.blast_date) for r in blast_funnel(audience, recs, pers).collect()}
    assert f == {"Eligible List": (5, None), "Recommendation List": (2, None), "Blast": (pers.count(), BD)}


def test_null_id_takes_no_seed_place(spark):
    from tidemark.operators.blast import blast_with_seeds
    df = spark.createDataFrame([("a", "a@x"), (None, "n@x"), ("b", "b@x")], "vip_no string, email string")
    got = [tuple(r) for r in blast_with_seeds(df, ("s1", "s2")).collect()]
    assert sorted((r for r in got if r[0] in ("s1", "s2"))) == [("s1", ""), ("s2", "")] and len(got) == 5 and (None, "n@x") in got
