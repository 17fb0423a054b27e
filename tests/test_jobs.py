import datetime as dt
import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidemark.plans import jobs
from tidemark.sinks import read_versioned
from tidemark.sources import relations as rel

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, scratch):
    t = rel.Tables(spark, SF)
    inputs = jobs.CampaignInputs(rel.member_snapshot(t), rel.member_reachable(t), rel.voucher_summary(t),
                                 rel.publication_status(t), rel.item_start_date(t), rel.item_master(t))
    blast_date = dt.date(2024, 1, 10)
    out, registry_path, history = (os.path.join(scratch, n) for n in ("out", "registry", "history"))
    camps = jobs.prepare_campaign(spark, inputs, blast_date, rel.ITEMS_AS_OF, out, registry_path)
    assert camps == {"hk": "lc_fprp_notification_20240110_hk", "cn": "lc_fprp_notification_20240110_cn"}
    registry = read_versioned(spark, registry_path)
    assert registry.count() == 4
    male_hk = spark.read.parquet(f"{out}/audience/lc_fprp_notification_20240110_hk_male/audience_list")
    grouped_hk = spark.read.parquet(f"{out}/audience/lc_fprp_notification_{'hk'}.parquet")
    assert male_hk.count() == grouped_hk.where("`group` = 'Male'").count()
    assert spark.read.parquet(f"{out}/audience/lc_fprp_notification_20240110_cn_female/filters").count() == 3
    assert spark.read.parquet(f"{out}/campaign/lc_fprp_notification_20240110_hk/layout").count() == 16

    recs = rel.recommendations(t)

    def load_version(campaign_id, group):
        region = campaign_id.split("_")[-1]
        grouped = spark.read.parquet(f"{out}/audience/lc_fprp_notification_{region}.parquet")
        return rel.version_output(rel.recommendations(t), grouped, group.capitalize()).where(F.col("vip_no").cast("bigint") % 6 != 0)

    def load_audience(region):
        return spark.read.parquet(f"{out}/audience/lc_fprp_notification_{region}.parquet")

    report = jobs.run_blast(spark, registry, load_version, load_audience, rel.item_master_partial(t), out, history,
                            dt.date(2024, 1, 9), salt="seed-2024")
    assert report["hk"]["blast_date"] == blast_date
    assert set(report["hk"]["unfilled"]) == {"female", "male"}
    hist = read_versioned(spark, history)
    # the history equals the registered query's rows (same chain, backfilled recommendations here)
    assert hist.where("region = 'hk'").count() > 0
    assert os.path.isdir(f"{out}/blast/products_fprp_notification_20240110_hk.upsert.csv")
    n = hist.count()
    jobs.run_blast(spark, registry, load_version, load_audience, rel.item_master_partial(t), out, history,
                   dt.date(2024, 1, 9), salt="seed-2024")
    assert read_versioned(spark, history).count() == n          # re-run replaces its own partitions
    assert recs is not None


def test_kpi_job_matches_registered_query(spark):
    t = rel.Tables(spark, SF)
    blasts = E.queries()["blast_list"](spark, SF)
    details = rel.campaign_details(spark)
    contact = rel.campaign_contact(t, details, blasts)
    out = jobs.run_kpi_monitor(rel.blast_history(t), rel.sales_dtl(t), rel.voucher_redeem(t), details, contact,
                               rel.campaign_response(t, details, contact))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, E.entry(spark).collect()), key=repr)


def test_both_groups_are_registered_without_an_audience(spark, scratch):
    """A region whose audience is empty (or lacks a group) still gets the new campaign, never last week's."""
    t = rel.Tables(spark, SF)
    only_cn = spark.createDataFrame([("1", "20990101", "BJG")], "vip_no string, collect_start_date string, region string")
    out, registry_path = (os.path.join(scratch, n) for n in ("out", "registry"))
    for day, voucher in ((dt.date(2024, 1, 3), rel.voucher_summary(t)), (dt.date(2024, 1, 10), only_cn)):
        inputs = jobs.CampaignInputs(rel.member_snapshot(t), rel.member_reachable(t), voucher,
                                     rel.publication_status(t), rel.item_start_date(t), rel.item_master(t))
        jobs.prepare_campaign(spark, inputs, day, rel.ITEMS_AS_OF, out, registry_path)
    assert spark.read.parquet(f"{out}/audience/lc_fprp_notification_hk.parquet").count() == 0
    camp, audiences = jobs.lookup_campaign(spark, read_versioned(spark, registry_path), "hk")
    assert camp == "lc_fprp_notification_20240110_hk"
    assert sorted(audiences) == [f"{camp}_female", f"{camp}_male"]
    versions = spark.read.parquet(f"{out}/campaign/{camp}/versions")
    assert sorted(r.version_id for r in versions.collect()) == ["female", "male"]


def test_blast_reports_unfilled_members(spark):
    from tidemark.operators.recommend import unfilled_rows
    out = spark.createDataFrame([("o1",), ("o2",)], "vip_no string")
    aud = spark.createDataFrame([("a1",), ("a2",), ("a3",), ("o1",)], "vip_no string")
    assert unfilled_rows(out, aud).collect()[0]["unfilled"] == 1
    assert unfilled_rows(out, aud.limit(0)).collect()[0]["unfilled"] == 0


def test_views_answer_sql(spark):
    from tidemark.plans.views import register_audience_views, register_kpi_views
    t = rel.Tables(spark, SF)
    blasts = E.queries()["blast_list"](spark, SF)
    details = rel.campaign_details(spark)
    contact = rel.campaign_contact(t, details, blasts)
    register_kpi_views(rel.blast_history(t), rel.sales_dtl(t), rel.voucher_redeem(t), details, contact,
                       rel.campaign_response(t, details, contact))
    got = spark.sql("select blast_region, blast_channel, campaign_size from monthly_kpi").collect()
    assert len(got) == 8
    assert spark.sql("select count(*) from blast_list").collect()[0][0] == blasts.count()
    register_audience_views(rel.member_snapshot(t), rel.member_reachable(t), rel.voucher_summary(t), "cn",
                            rel.publication_status(t), rel.item_start_date(t), rel.item_master(t), rel.ITEMS_AS_OF)
    n_male = spark.sql("select count(*) from CUST_LIST_male").collect()[0][0]
    n_female = spark.sql("select count(*) from CUST_LIST_female").collect()[0][0]
    assert n_male + n_female == spark.sql("select count(*) from CUST_LIST_grouped").collect()[0][0]


def test_blast_backfills_version_tables_in_place(spark, scratch):
    from tidemark.sinks import overwrite_from_self
    t = rel.Tables(spark, SF)
    inputs = jobs.CampaignInputs(rel.member_snapshot(t), rel.member_reachable(t), rel.voucher_summary(t),
                                 rel.publication_status(t), rel.item_start_date(t), rel.item_master(t))
    out, registry_path, history = (os.path.join(scratch, n) for n in ("out", "registry", "history"))
    jobs.prepare_campaign(spark, inputs, dt.date(2024, 1, 10), rel.ITEMS_AS_OF, out, registry_path, regions=("cn",))
    grouped = spark.read.parquet(f"{out}/audience/lc_fprp_notification_cn.parquet")
    tables = os.path.join(scratch, "tables")
    for group in jobs.GROUPS:   # the recommender's tables, missing every sixth member
        (rel.version_output(rel.recommendations(t), grouped, group.capitalize()).where(F.col("vip_no").cast("bigint") % 6 != 0)
         .write.parquet(f"{tables}/{group}"))
    before = {g: spark.read.parquet(f"{tables}/{g}").count() for g in jobs.GROUPS}

    def store(campaign_id, group, filled):
        overwrite_from_self(filled, f"{tables}/{group}")     # filled reads the path it replaces
        return spark.read.parquet(f"{tables}/{group}")

    jobs.run_blast(spark, read_versioned(spark, registry_path), lambda c, g: spark.read.parquet(f"{tables}/{g}"),
                   lambda r: grouped, rel.item_master_partial(t), out, history, dt.date(2024, 1, 9),
                   regions=("cn",), store_version=store)
    for g in jobs.GROUPS:
        after = spark.read.parquet(f"{tables}/{g}")
        ids = grouped.where(F.col("group") == g.capitalize()).select("vip_no").distinct().count()
        assert before[g] < after.count() == ids     # every audience member now has a row
