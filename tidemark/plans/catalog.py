"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query derives its inputs from the scale-factor tables
(``tidemark.sources.relations``) and runs one operator chain over them.
Parameters (dates, regions, salts) are fixed here so results are
reproducible; the operators themselves take them as arguments.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import sinks
from tidemark.operators import attribution as att
from tidemark.operators import audience as aud
from tidemark.operators import blast as bl
from tidemark.operators import documents
from tidemark.operators import feeds
from tidemark.operators import funnel
from tidemark.operators import incremental as inc
from tidemark.operators import items
from tidemark.operators import kpi
from tidemark.operators import reach
from tidemark.operators import recommend as recm
from tidemark.operators import registry as reg
from tidemark.plans import jobs
from tidemark.sources import relations as rel
from tidemark.session import ensure_checkpoint_dir
from tidemark.sinks import versioned
from tidemark.sources.relations import Tables
from tidemark.sources.tables import campaign_output_name, campaign_outputs

# Fixed run parameters of the registered queries.
ITEMS_AS_OF = rel.ITEMS_AS_OF            # catalogue date the item fixtures are aged against
BLAST_DATE = _dt.date(2024, 1, 10)       # blast date of the assembled blast (day after the run)
RUN_DATE = _dt.date(2024, 1, 9)          # created_date of the export feeds
SEED_IDS = ("testSeedA_gold", "testSeedB_gold")
SEED_SALT = "seed-2024"
REGIONS = ("hk", "cn")                   # every region-bound step runs for both, with a region column
PREVIOUS_BLAST_DATE = _dt.date(2024, 1, 3)   # registry content before this run
WRITTEN_AT = 1704787200                  # time stamp of the configuration documents (2024-01-09 08:00 UTC)
# the report loaded in two steps: blasts of three months, the second step with late sales of January
REPORT_DATES = tuple(_dt.date(*d) for d in ((2023, 12, 27), (2024, 1, 3), (2024, 1, 10), (2024, 1, 17), (2024, 1, 24), (2024, 2, 7)))
FIRST_LOAD, LATE_SINCE = _dt.date(2024, 1, 17), "20240108"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# --------------------------------------------------------------------------- attribution / KPI

def _blast_list(t: Tables) -> DataFrame:
    return att.blast_list(rel.blast_history(t))


def _revenue(t: Tables, blasts: DataFrame) -> DataFrame:
    return att.individual_campaign_revenue(rel.sales_dtl(t), rel.voucher_redeem(t), blasts)


def _response(t: Tables, blasts: DataFrame) -> DataFrame:
    details = rel.campaign_details(t.spark)
    contact = rel.campaign_contact(t, details, blasts)
    response = rel.campaign_response(t, details, contact)
    return att.individual_email_response(details, contact, response)


@register("blast_list")
def q_blast_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blast_list(Tables(spark, sf_dir))


@register("individual_campaign_revenue")
def q_individual_campaign_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return _revenue(t, _blast_list(t))


@register("individual_email_response")
def q_individual_email_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return _response(t, _blast_list(t))


@register("monthly_kpi")
def q_monthly_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    blasts = _blast_list(t)
    return kpi.monthly_kpi(blasts, _revenue(t, blasts), _response(t, blasts))


@register("monthly_kpi_deduped")
def q_monthly_kpi_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    blasts = _blast_list(t)
    return kpi.monthly_kpi_deduped(blasts, _revenue(t, blasts), _response(t, blasts))


@register("attribution_lineitem")
def q_attribution_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return att.lineitem_attribution(t.lineitem, t.orders, rel.order_redeem(t), rel.attribution_blasts(t))


# --------------------------------------------------------------------------- region steps

def _regions(step: Callable[[str], DataFrame]) -> DataFrame:
    """One step for every region, told apart by a region column."""
    frames = [step(r).withColumn("region", F.lit(r)) for r in REGIONS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _stored(t: Tables, name: str, build: Callable[[], DataFrame], by: tuple = ()) -> DataFrame:
    """A frame that production reads from a stored table: written once per query, in the shared folder."""
    cache = t.__dict__.setdefault("_built", {})
    if name not in cache:
        path = _new_table(t, name)
        build().write.partitionBy(*by).parquet(path)
        cache[name] = path
    return t.spark.read.parquet(cache[name])


def _new_table(t: Tables, name: str) -> str:
    """Path of a table that a query writes and reads back, in the shared folder."""
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _audience0(t: Tables) -> DataFrame:
    return aud.active_reachable_audience(rel.member_snapshot(t), rel.member_reachable(t))


def _audience(t: Tables, region: str) -> DataFrame:
    return aud.voucher_audience(_audience0(t), rel.voucher_summary(t), region)


def _grouped(t: Tables, region: str) -> DataFrame:
    return aud.audience_grouped(_audience(t, region))


def _all_grouped(t: Tables) -> DataFrame:
    """The grouped audience of all regions from one scan of members and vouchers."""
    return aud.audience_grouped(aud.voucher_audience_of_regions(_audience0(t), rel.voucher_summary(t), REGIONS))


def _stored_audience(t: Tables, region: str) -> DataFrame:
    """The grouped audience as the day -1 run stored it, one folder per region."""
    return _stored(t, "grouped", lambda: _all_grouped(t), ("region",)).where(F.col("region") == region).drop("region")


def _recommendations(t: Tables) -> DataFrame:
    """The recommender's output, which other steps only read."""
    return _stored(t, "recommendations", lambda: rel.recommendations(t))


def _versions(t: Tables, region: str) -> DataFrame:
    grouped, recs = _stored_audience(t, region), _recommendations(t)
    return recm.recommendations_union(*[rel.version_output(recs, grouped, g) for g in ("Female", "Male")])


def _output(t: Tables, region: str) -> DataFrame:
    return rel.rec_output(_recommendations(t), _stored_audience(t, region))


def _new_in(t: Tables) -> DataFrame:
    return items.new_in_list_direct(rel.publication_status(t), rel.item_start_date(t), rel.item_master(t),
                                    REGIONS, ITEMS_AS_OF)


def _blast_base(t: Tables, region: str) -> DataFrame:
    return bl.blast_base(_versions(t, region), _stored_audience(t, region), BLAST_DATE)


def _seeded(t: Tables, region: str) -> DataFrame:
    return bl.blast_with_seeds(_blast_base(t, region), SEED_IDS, SEED_SALT)


def _tagged(t: Tables, region: str) -> DataFrame:
    return bl.utm_tags(_seeded(t, region), BLAST_DATE)


def _region_list(t: Tables, region: str) -> DataFrame:
    return bl.region_list(_blast_base(t, region), BLAST_DATE, SEED_IDS, SEED_SALT)


def _personalization(t: Tables, region: str) -> DataFrame:
    return feeds.campaign_personalization(_region_list(t, region), RUN_DATE)


def _candidates(t: Tables) -> DataFrame:
    return items.new_in_candidates(rel.publication_status(t), rel.item_start_date(t), rel.child_sku(t),
                                   rel.inventory(t), rel.item_master(t), REGIONS, ITEMS_AS_OF)


def _registry_before(t: Tables) -> DataFrame:
    frames = []
    for region in REGIONS:
        versions = reg.audience_versions(_grouped(t, region), PREVIOUS_BLAST_DATE, region)
        frames.append(reg.registry_rows(reg.customization_id(region), reg.campaign_id(PREVIOUS_BLAST_DATE, region),
                                        versions.select("audience_id")))
    return frames[0].unionByName(frames[1])


def _registry_after(t: Tables, region: str = "hk") -> DataFrame:
    versions = reg.audience_versions(_grouped(t, region), BLAST_DATE, region)
    return reg.customization_replace(_registry_before(t), reg.customization_id(region), reg.campaign_id(BLAST_DATE, region),
                                     versions.select("audience_id"))


# name -> step of one region
STEPS: dict[str, Callable[[Tables, str], DataFrame]] = {
    "missing_audience": lambda t, r: recm.missing_audience(_stored_audience(t, r), _output(t, r)),
    "fill_missing_recommendations": lambda t, r: recm.fill_missing_recommendations(_output(t, r), _stored_audience(t, r)),
    "fill_missing_counts": lambda t, r: recm.backfill(_output(t, r), _stored_audience(t, r))[1],
    "recommendations_union": _versions,
    "blast_base": _blast_base,
    "blast_with_seeds": _seeded,
    "utm_tags": _tagged,
    "slot_quality_ok": lambda t, r: bl.slot_quality_ok(_tagged(t, r)),
    "slot_quality_rejects": lambda t, r: bl.slot_quality_rejects(_tagged(t, r)),
    "top_brands": _region_list,
    "product_recommendation": lambda t, r: feeds.product_recommendation(_region_list(t, r), RUN_DATE),
    "products": lambda t, r: feeds.products(_region_list(t, r), rel.item_master_partial(t), RUN_DATE),
    "campaign_personalization": _personalization,
    "blast_funnel": lambda t, r: funnel.blast_funnel(_stored_audience(t, r), _versions(t, r), _personalization(t, r)),
    "customization_lookup": lambda t, r: reg.customization_lookup(_registry_after(t, r), reg.customization_id(r)),
    "campaign_version_table": lambda t, r: reg.campaign_version_table(reg.audience_versions(_grouped(t, r), BLAST_DATE, r), r).drop("region"),
}


def _step_query(step: Callable[[Tables, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = Tables(spark, sf_dir)
        return _regions(lambda region: step(t, region))
    return run


for _name, _step in STEPS.items():
    QUERIES[_name] = _step_query(_step)

# steps that make all regions' rows in one plan
ALL_REGIONS: dict[str, Callable[[Tables], DataFrame]] = {
    "audience_grouped": _all_grouped,
    "audience_ids_by_group": lambda t: aud.audience_ids_by_group(_all_grouped(t)),
    "new_in_candidates": _candidates,
    "new_in_list": _new_in,
    "new_in_list_final": lambda t: items.new_in_list_final(_new_in(t), ITEMS_AS_OF),
}


def _all_regions_query(step: Callable[[Tables], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return step(Tables(spark, sf_dir))
    return run


for _name, _all in ALL_REGIONS.items():
    QUERIES[_name] = _all_regions_query(_all)


@register("active_reachable_audience")
def q_active_reachable_audience(spark, sf_dir):
    return _audience0(Tables(spark, sf_dir))


@register("voucher_audience_hk")
def q_voucher_audience_hk(spark, sf_dir):
    return _audience(Tables(spark, sf_dir), "hk")


@register("voucher_audience_cn")
def q_voucher_audience_cn(spark, sf_dir):
    return _audience(Tables(spark, sf_dir), "cn")


@register("append_blast_history")
def q_append_blast_history(spark, sf_dir):
    """Both regions' lists appended to a new history twice (a re-run must not duplicate), then read back."""
    t = Tables(spark, sf_dir)
    rows = bl.history_rows({r: _region_list(t, r) for r in REGIONS})
    path = _new_table(t, "blast-history")
    for _ in range(2):
        sinks.append_blast_history(rows, path, [(r, BLAST_DATE) for r in REGIONS])
    return sinks.read_versioned(spark, path)


@register("history_rerun")
def q_history_rerun(spark, sf_dir):
    """Two blasts of both regions in the history, then the second re-run with nobody left in cn."""
    t = Tables(spark, sf_dir)
    lists = {r: _region_list(t, r) for r in REGIONS}
    path = _new_table(t, "blast-history")
    earlier = bl.history_rows(lists).withColumn("blast_date", F.lit(PREVIOUS_BLAST_DATE))
    sinks.append_blast_history(earlier, path, [(r, PREVIOUS_BLAST_DATE) for r in REGIONS])
    sinks.append_blast_history(bl.history_rows(lists), path, [(r, BLAST_DATE) for r in REGIONS])
    rerun = bl.history_rows({"hk": lists["hk"], "cn": lists["cn"].limit(0)})
    sinks.append_blast_history(rerun, path, [(r, BLAST_DATE) for r in REGIONS])
    return sinks.read_versioned(spark, path)


@register("registry_by_key")
def q_registry_by_key(spark, sf_dir):
    """Both regions registered, hk registered again for the next blast, a test key registered and emptied, all by key."""
    t = Tables(spark, sf_dir)
    path = _new_table(t, "registry")
    for region, day in (("hk", PREVIOUS_BLAST_DATE), ("cn", PREVIOUS_BLAST_DATE), ("hk", BLAST_DATE)):
        ids = reg.audience_versions(_stored_audience(t, region), day, region).select("audience_id")
        sinks.write_registry(spark, path, reg.customization_id(region), reg.campaign_id(day, region), ids)
        if region == "cn":
            sinks.write_registry(spark, path, "test", "test", ids)
    sinks.write_registry(spark, path, "test", "test", [])
    return sinks.read_versioned(spark, path)


@register("product_recommendation_upload")
def q_product_recommendation_upload(spark, sf_dir):
    """The recommendation feed of each region written as an upload file and read back from its parts."""
    t = Tables(spark, sf_dir)

    def exported(region: str) -> DataFrame:
        feed, path = feeds.product_recommendation(_region_list(t, region), RUN_DATE), _new_table(t, f"upload-{region}")
        sinks.write_upload(feed, path, ["customer_id", "display_id"])
        return sinks.read_upload(spark, path, feed.schema)

    return _regions(exported)


@register("slot_quality_split")
def q_slot_quality_split(spark, sf_dir):
    """Accepted and rejected rows of each region's list, split in one pass and read back."""
    t = Tables(spark, sf_dir)

    def split(region: str) -> DataFrame:
        path = _new_table(t, f"checked-{region}")
        sinks.write_quality_split(bl.quality_marked(_tagged(t, region)), path)
        sides = [sinks.read_versioned(spark, path, where={"accepted": side}) for side in (True, False)]
        return sides[0].unionByName(sides[1]).select("vip_no", "atg_code", "valid_codes", "accepted")

    return _regions(split)


@register("campaign_outputs_by_name")
def q_campaign_outputs_by_name(spark, sf_dir):
    """Version tables with differing columns saved in a catalog schema, found by name and read as one."""
    t = Tables(spark, sf_dir)
    schema = f"outputs_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{_new_table(t, schema)}'")
    for region in REGIONS:
        grouped, recs = _stored_audience(t, region), _recommendations(t)
        for group, change in (("Female", lambda df: df.withColumn("model", F.lit("f1"))), ("Male", lambda df: df.drop("brand_desc_8"))):
            name = campaign_output_name(reg.campaign_id(BLAST_DATE, region), group.lower(), schema)
            change(rel.version_output(recs, grouped, group)).write.saveAsTable(name)
    spark.range(1).write.saveAsTable(f"{schema}.campaign_notes")
    return campaign_outputs(spark, schema)


@register("recommendations_rewritten")
def q_recommendations_rewritten(spark, sf_dir):
    """The recommender's table backfilled in place, twice (the second time nothing is missing any more)."""
    t = Tables(spark, sf_dir)

    def in_place(region: str) -> DataFrame:
        path, grouped = _new_table(t, f"output-{region}"), _stored_audience(t, region)
        versioned.replace(_output(t, region), path)
        for _ in range(2):
            versioned.rewrite(spark, path, lambda output: recm.fill_missing_recommendations(output, grouped))
        return sinks.read_versioned(spark, path)

    return _regions(in_place)


@register("customization_replace")
def q_customization_replace(spark, sf_dir):
    return _registry_after(Tables(spark, sf_dir))


@register("version_documents")
def q_version_documents(spark, sf_dir):
    """The nested documents of both regions' campaigns and of each version present in the audience, written and read back."""
    t = Tables(spark, sf_dir)
    path, cells = _new_table(t, "documents"), reg.layout_slots(reg.layout_grid_table(spark))
    for region in REGIONS:
        versions = reg.campaign_version_table(reg.audience_versions(_stored_audience(t, region), BLAST_DATE, region), region)
        sinks.write_documents(documents.configuration_documents(versions, cells, WRITTEN_AT), path)
    return sinks.read_documents(spark, path)


@register("monthly_reach")
def q_monthly_reach(spark, sf_dir):
    """Reach, purchasers and conversion per month from bitmaps that two runs stored per blast date."""
    t = Tables(spark, sf_dir)
    blasts = _stored(t, "blasts", lambda: _blast_list(t))
    numbers, stored = _new_table(t, "member-numbers"), _new_table(t, "reach")
    for dates in (rel.HISTORY_BLAST_DATES[:2], rel.HISTORY_BLAST_DATES[2:]):
        run = blasts.where(F.col("blast_date").isin(*dates))
        jobs.store_reach(numbers, stored, run, _revenue(t, run), list(dates))
    return reach.monthly_reach(sinks.read_versioned(spark, stored))


@register("reach_funnel")
def q_reach_funnel(spark, sf_dir):
    """The funnel of both regions from stored bitmaps."""
    t = Tables(spark, sf_dir)
    rows = _stored(t, "funnel-members", lambda: _regions(
        lambda r: reach.funnel_members(_stored_audience(t, r), _versions(t, r), _personalization(t, r))))
    numbers = _stored(t, "funnel-numbers", lambda: reach.member_numbers(rows))
    bitmaps = _stored(t, "funnel-bitmaps", lambda: reach.reach_bitmaps(rows, numbers, ["region", *reach.FUNNEL_KEYS]))
    return reach.funnel_of_bitmaps(bitmaps, ["region"])


def load_report_twice(t: Tables, path: str) -> list[list[inc.Month]]:
    """The report loaded in two steps, the second with new blasts, responses and late sales; returns the months of each."""
    history, sales, redeem = rel.blast_history(t, REPORT_DATES), rel.sales_dtl(t), rel.voucher_redeem(t)
    details = rel.campaign_details(t.spark, REPORT_DATES)
    contact = rel.campaign_contact(t, details, att.blast_list(history))
    response = rel.campaign_response(t, details, contact)
    late = ((F.col("order_no").cast("bigint") % 5 == 0) & (F.col("order_date") >= LATE_SINCE)) | (F.col("order_date") > "20240120")
    old, sent = F.col("blast_date") <= FIRST_LOAD, F.col("date_sent") < FIRST_LOAD
    steps = [((history.where(old), sales.where(~late), redeem, details.where(sent), contact, response),
              (history.where(old), sales.where(~late), details.where(sent))),
             ((history, sales, redeem, details, contact, response),
              (history.where(~old), sales.where(late), details.where(~sent)))]
    found = []
    for everything, new in steps:
        found.append(inc.affected_months(*new))
        jobs.refresh_kpi(path, found[-1], *everything)
    return found


@register("monthly_kpi_incremental")
def q_monthly_kpi_incremental(spark, sf_dir):
    """The monthly report loaded in two steps: equal to the report over everything."""
    t = Tables(spark, sf_dir)
    path = _new_table(t, "report")
    load_report_twice(t, path)
    return sinks.read_versioned(spark, path)
