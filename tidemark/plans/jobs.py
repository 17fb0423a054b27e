"""End-to-end jobs: the three scheduled runs of the campaign, built from the
operators and sinks.

* :func:`prepare_campaign` (day -1): audiences, per-group id lists, new-in item
  list, version table, registry entry.
* :func:`run_blast`: registry lookup, recommendation backfill, blast list with
  checks, the three export feeds, funnel report, history append.
* :func:`run_kpi_monitor`: blast list, attribution, email response, monthly KPI.
* :func:`refresh_kpi`: the report of the months that new rows change, in one commit.
* :func:`store_reach`: a run's reach as bitmaps over stored member numbers.

Inputs are DataFrames (read them with ``spark.table`` / ``spark.read`` at the
edge); dates are arguments.  Nothing is collected to the driver except the
registry lookup (a handful of ids) and counts for the run log.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import to_pydate
from tidemark.operators import attribution as att
from tidemark.operators import audience as aud
from tidemark.operators import blast as bl
from tidemark.operators import feeds
from tidemark.operators import documents
from tidemark.operators import funnel
from tidemark.operators import incremental as inc
from tidemark.operators import items
from tidemark.operators import kpi
from tidemark.operators import reach
from tidemark.operators import recommend as recm
from tidemark.operators import registry as reg
from tidemark import sinks
from tidemark.session import ensure_checkpoint_dir
from tidemark.sinks import versioned

GROUPS = ("female", "male")
REGIONS = ("hk", "cn")
MAX_AUDIENCES = 1000


@dataclass
class CampaignInputs:
    member_snapshot: DataFrame
    member_reachable: DataFrame
    voucher_summary: DataFrame
    publication_status: DataFrame
    item_start_date: DataFrame
    item_master: DataFrame


def _ymd(d) -> str:
    return to_pydate(d).strftime("%Y%m%d")


def audience_id(blast_date, region: str, group: str) -> str:
    return f"{reg.campaign_id(blast_date, region)}_{group}"


def prepare_campaign(spark: SparkSession, inputs: CampaignInputs, blast_date, as_of, out_dir: str,
                     registry_path: str, regions=REGIONS, groups=GROUPS, written_at: int | None = None) -> dict:
    """Day -1 run (audience + item list + configuration + registry), one region at a time.

    Layout under ``out_dir``: ``audience/lc_fprp_notification_<region>.parquet``
    (grouped audience), ``audience/<audience_id>/audience_list`` (ids of one
    group) and ``audience/<audience_id>/filters`` (P31 rows),
    ``campaign/<campaign_id>/item_list.csv``, ``.../versions`` (P30),
    ``.../layout`` (P29), and with ``written_at`` (epoch seconds) the JSON
    documents of the campaign and its versions under ``campaign/documents``
    (C20).  The grouped audience is written once and the group
    lists are cut from the written copy, so the audience plan runs once.
    """
    out_dir = out_dir.rstrip("/")
    audience0 = aud.active_reachable_audience(inputs.member_snapshot, inputs.member_reachable)
    filters = aud.audience_filter_table(spark)
    layouts = reg.layout_slots(reg.layout_grid_table(spark))
    written = {}
    for region in regions:
        camp = reg.campaign_id(blast_date, region)
        grouped_path = f"{out_dir}/audience/lc_fprp_notification_{region}.parquet"
        sinks.write_parquet(aud.audience_grouped(aud.voucher_audience(audience0, inputs.voucher_summary, region)),
                            grouped_path)
        grouped = spark.read.parquet(grouped_path)
        for group in groups:
            aid = audience_id(blast_date, region, group)
            sinks.write_parquet(aud.audience_ids_of_group(grouped, group.capitalize()),
                                f"{out_dir}/audience/{aid}/audience_list")
            if region.lower() in aud.NATIONALITIES:
                sinks.write_parquet(filters.where((F.col("region") == region.lower()) & (F.col("group") == group)),
                                    f"{out_dir}/audience/{aid}/filters")
        new_in = items.new_in_list_final(
            items.new_in_list_direct(inputs.publication_status, inputs.item_start_date, inputs.item_master, region,
                                     as_of), as_of)
        item_list = f"{out_dir}/campaign/{camp}/item_list.csv"
        sinks.write_csv(new_in, item_list)
        # every group of the run is registered, whoever is in the audience
        ids = [audience_id(blast_date, region, group) for group in groups]
        versions = reg.version_pairs(spark, camp, list(groups), ids)
        table = reg.campaign_version_table(versions, region, item_list)
        sinks.write_parquet(table, f"{out_dir}/campaign/{camp}/versions")
        if written_at is not None:
            sinks.write_documents(documents.configuration_documents(table, layouts, written_at), f"{out_dir}/campaign/documents")
        sinks.write_parquet(layouts.where(F.col("region") == region.lower()), f"{out_dir}/campaign/{camp}/layout")
        sinks.write_registry(spark, registry_path, reg.customization_id(region), camp, ids)
        written[region] = camp
    return written


def lookup_campaign(spark: SparkSession, registry: DataFrame, region: str) -> tuple[str, list[str]]:
    """P28 at the edge: (campaign_id, audience_ids) of a region; raises when absent."""
    cid = reg.customization_id(region)
    found = reg.require_customization(reg.customization_lookup(registry, cid), cid)
    rows = found.limit(MAX_AUDIENCES + 1).collect()   # registry rows of one key: one per audience group
    if len(rows) > MAX_AUDIENCES:
        raise ValueError(f"more than {MAX_AUDIENCES} audiences registered for '{cid}'")
    return rows[0]["campaign_id"], [r["audience_id"] for r in rows]


def run_blast(spark: SparkSession, registry: DataFrame, load_version: Callable[[str, str], DataFrame],
              load_audience: Callable[[str], DataFrame], item_master: DataFrame, out_dir: str, history_path: str,
              run_date, test: bool = False, regions=REGIONS, seed_ids=("testSeedA_gold", "testSeedB_gold"),
              salt: str = "seed", store_version: Callable[[str, str, DataFrame], DataFrame] | None = None,
              max_rejects: int | None = None) -> dict:
    """Blast run.

    ``load_version(campaign_id, group)`` returns the recommender output of one
    version, ``load_audience(region)`` the grouped audience written by
    :func:`prepare_campaign`.  ``store_version(campaign_id, group, filled)``
    persists a backfilled output and returns it re-read (default: Parquet
    under ``out_dir/recommendations``; to replace the recommender's own table
    in place use :func:`tidemark.sinks.versioned.rewrite`).  The region
    list, used by five outputs, is stored once, accepted and rejected rows apart.  The report names, per
    region, the campaign, its date and how many missing members found no donor
    (``unfilled`` per group); ``max_rejects`` stops a run with more rows that
    fail the slot check.
    """
    ensure_checkpoint_dir(spark)
    out_dir = out_dir.rstrip("/")
    lists, report, rejected = {}, {}, {}
    for region in regions:
        camp, _ = lookup_campaign(spark, registry, region)
        blast_date = _dt.datetime.strptime(camp.split("_")[-2], "%Y%m%d").date()
        grouped = load_audience(region)
        versions, unfilled = [], {}
        for group in GROUPS:
            output = load_version(camp, group)
            ids = aud.audience_ids_of_group(grouped, group.capitalize())
            filled, unfilled[group] = recm.fill_and_report(output, ids)
            if store_version is None:
                path = f"{out_dir}/recommendations/{camp}/{group}"
                sinks.write_parquet(filled, path)
                versions.append(spark.read.parquet(path))
            else:
                versions.append(store_version(camp, group, filled))
        recs = recm.recommendations_union(*versions)
        base = bl.blast_base(recs, grouped, blast_date)
        # one pass over the list writes both sides of the slot check; the accepted side is read by five outputs
        checked = f"{out_dir}/blast/checked_{region}"
        marked = bl.quality_marked(bl.utm_tags(bl.blast_with_seeds(base, seed_ids, salt), blast_date))
        rejected[region] = sinks.write_quality_split(marked, checked, max_rejects)["rejected"]
        lst = bl.top_brands(sinks.read_versioned(spark, checked, where={"accepted": True}).drop("valid_codes", "accepted"))
        pers = feeds.campaign_personalization(lst, run_date)
        sinks.write_blast_exports({
            "campaign_personalization": pers,
            "products": feeds.products(lst, item_master, run_date),
            "product_recommendation": feeds.product_recommendation(lst, run_date),
        }, f"{out_dir}/blast", _ymd(blast_date), region)
        sinks.write_parquet(funnel.blast_funnel(grouped, recs, pers), f"{out_dir}/blast/funnel_{region}")
        lists[region] = lst
        report[region] = {"campaign_id": camp, "blast_date": blast_date, "unfilled": unfilled, "rejected": rejected[region]}
    sinks.append_blast_history(bl.history_rows(lists), history_path, [(r, report[r]["blast_date"]) for r in regions], test=test)
    return report


def run_kpi_monitor(history: DataFrame, sales: DataFrame, redeem: DataFrame, details: DataFrame, contact: DataFrame,
                    response: DataFrame, out_path: str | None = None, deduped: bool = False) -> DataFrame:
    """KPI run: P22 -> P23 / P24 -> P25 (or P26), optionally written to ``out_path``."""
    blasts = att.blast_list(history)
    revenue = att.individual_campaign_revenue(sales, redeem, blasts)
    resp = att.individual_email_response(details, contact, response)
    out = (kpi.monthly_kpi_deduped if deduped else kpi.monthly_kpi)(blasts, revenue, resp)
    if out_path:
        sinks.write_parquet(out, out_path)
    return out


def refresh_kpi(path: str, months: list[inc.Month], history: DataFrame, sales: DataFrame, redeem: DataFrame, details: DataFrame,
                contact: DataFrame, response: DataFrame, deduped: bool = False) -> int | None:
    """K3: replace these months of a stored report (``inc.affected_months`` of the new rows) in one commit; others keep their files.

    A month without blasts any more has no rows afterwards.  Read the report with
    ``sinks.read_versioned``.  Returns the new version, None without months.
    """
    if not months:
        return None
    report = inc.months_report(months, history, sales, redeem, details, contact, response, deduped)
    return versioned.replace(report, path, ["blast_year", "blast_month"], [inc.month_key(m) for m in months])


def store_reach(numbers_path: str, reach_path: str, blasts: DataFrame, revenue: DataFrame, blast_dates: list) -> int:
    """Number the new members of ``blasts`` and replace the stored reach of ``blast_dates`` by these rows'.

    The numbers are one commit, the reach another on top of it: a run lost in
    between has numbered members that no bitmap names yet, which a re-run uses.
    """
    spark = blasts.sparkSession
    version = versioned.current_version(spark, numbers_path)
    known = versioned.read_versioned(spark, numbers_path, version) if version else None
    versioned.replace(reach.member_numbers(blasts, known), numbers_path, base=version)
    numbers = versioned.read_versioned(spark, numbers_path)
    return versioned.replace(reach.daily_reach(blasts, revenue, numbers), reach_path, ["blast_date"], [(d,) for d in blast_dates])
