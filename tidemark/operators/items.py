"""New-in item list."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import require_columns
from tidemark.functions.dates import as_date

# Item exclusions of the new-in list.
CANDIDATE_EXCLUDED_CLASSES = ("Decorative Accessories",)
CANDIDATE_EXCLUDED_SUBCLASSES = ("Objects",)
EXCLUDED_CLASSES = ("Decorative Accessories", "Fitness", "Concession Health & Wellness")
EXCLUDED_SUBCLASSES = ("Objects", "Briefs", "Fitness equipement", "Art & Collectibles")
EXCLUDED_CATEGORIES = ("Swimwear",)
PUBLISHED = 2
NEW_IN_DAYS = 20
# Business units kept for 90 days; every other unit for 60 days.
LONG_RECENCY_BUS = ("HL", "COS", "JWY")
LONG_RECENCY_DAYS = 90
SHORT_RECENCY_DAYS = 60


def site_of_region(region: str) -> str:
    """``zh_`` + upper(region): zh_HK, zh_CN (D3)."""
    return "zh_" + region.upper()


def _sites(region: str | Sequence[str], site: str):
    """(filter on the site column, region column or none) for one region or several."""
    if isinstance(region, str):
        return F.col(site) == site_of_region(region), []
    names = F.create_map(*[F.lit(x) for r in region for x in (site_of_region(r), r)])
    return F.col(site).isin(*[site_of_region(r) for r in region]), [names[F.col(site)].alias("region")]


def _not_in(col: str, values) -> F.Column:
    # `<>` chains and NOT IN both reject NULL
    return ~F.col(col).isin(*values)


def candidate_exclusion():
    return _not_in("class_desc", CANDIDATE_EXCLUDED_CLASSES) & _not_in("subclass_desc", CANDIDATE_EXCLUDED_SUBCLASSES)


def full_exclusion():
    return (_not_in("class_desc", EXCLUDED_CLASSES) & _not_in("subclass_desc", EXCLUDED_SUBCLASSES)
            & _not_in("category_desc", EXCLUDED_CATEGORIES))


def new_in_candidates(pub: DataFrame, start: DataFrame, sku: DataFrame, inv: DataFrame, item: DataFrame,
                      region: str | Sequence[str], as_of: _dt.date, days: int = NEW_IN_DAYS) -> DataFrame:
    """P5, exact bag form: published items of the region's site that started in the last
    ``days`` days (strict), with the class/subclass exclusion.  Several regions
    come from one plan, told apart by a ``region`` column.

    The sku and inventory left joins add rows only (one per sku); they are kept
    here because P5 alone returns that multiset.  The start-date and item left
    joins become inner joins through the WHERE clause (Catalyst does it).

    All joins are sort-merge joins: the sizes that the planner guesses for
    computed ids and for rows multiplied by a generator are those of the scanned
    columns, and a broadcast on such a guess gathers the table in the driver.
    """
    here, place = _sites(region, "pub.site_id")
    p = pub.alias("pub")
    dt = start.alias("dt").hint("merge")
    s = sku.alias("sku").hint("merge")
    inv_ = inv.alias("inv").hint("merge")
    it = item.alias("item").hint("merge")
    j = (p.where(here & (F.col("pub.publication_status") == PUBLISHED))
         .join(dt, (F.col("dt.id") == F.col("pub.id")) & (F.col("dt.site_id") == F.col("pub.site_id")), "left")
         .join(s, F.col("pub.id") == F.col("sku.product_id"), "left")
         .join(inv_, F.col("inv.inventory_id") == F.concat(F.col("sku.sku_id"), F.lit(","), F.col("pub.site_id")), "left")
         .join(it, F.col("item.atg_code") == F.col("pub.id"), "left"))
    return (j.where((F.col("dt.start_date") > F.date_sub(as_date(as_of), days))
                    & ~F.col("item.class_desc").isin(*CANDIDATE_EXCLUDED_CLASSES)
                    & ~F.col("item.subclass_desc").isin(*CANDIDATE_EXCLUDED_SUBCLASSES))
            .select(F.col("pub.id").alias("atg_code"), F.col("dt.start_date").cast("date").alias("start_date"),
                    F.col("item.bu_desc").alias("bu_desc"), *place))


def new_in_list(candidates: DataFrame, item: DataFrame) -> DataFrame:
    """P6 from P5's output: DISTINCT candidates re-joined to the item master under the full exclusion list."""
    it = item.select("atg_code", "bu_desc", "class_desc", "subclass_desc", "category_desc").where(full_exclusion())
    return (candidates.select("atg_code", "start_date")
            .join(it, "atg_code", "inner")
            .select("atg_code", "bu_desc", "start_date").distinct())


def new_in_list_direct(pub: DataFrame, start: DataFrame, item: DataFrame, region: str | Sequence[str], as_of: _dt.date,
                       days: int = NEW_IN_DAYS) -> DataFrame:
    """P5 feeding P6 in one plan.

    Equal to ``new_in_list(new_in_candidates(...), item)``: the sku/inventory
    joins only multiply rows that DISTINCT removes, and P5's exclusion is
    implied by P6's on the same item row, so one item join replaces two.
    Several regions come from one plan, told apart by a ``region`` column.
    """
    require_columns(pub, ["id", "site_id", "publication_status"], "publication status")
    here, place = _sites(region, "site_id")
    p = pub.where(here & (F.col("publication_status") == PUBLISHED)).select("id", "site_id")
    recent = start.where(F.col("start_date") > F.date_sub(as_date(as_of), days)).select("id", "site_id", "start_date")
    it = item.where(full_exclusion()).select(F.col("atg_code").alias("id"), "bu_desc")
    return (p.join(recent, ["id", "site_id"], "inner")
            .join(it, "id", "inner")
            .select(F.col("id").alias("atg_code"), "bu_desc", F.col("start_date").cast("date").alias("start_date"), *place)
            .distinct())


def new_in_list_final(new_in: DataFrame, as_of: _dt.date, long_bus=LONG_RECENCY_BUS,
                      long_days: int = LONG_RECENCY_DAYS, short_days: int = SHORT_RECENCY_DAYS) -> DataFrame:
    """Keep items started within 90 days (HL/COS/JWY) or 60 days (other units), inclusive.

    The reference's UNION ALL of two disjoint filters is one filter; a NULL
    business unit matches neither branch and is dropped.
    """
    days = F.when(F.col("bu_desc").isin(*long_bus), long_days).otherwise(short_days)
    return new_in.where(F.col("bu_desc").isNotNull()
                        & (F.col("start_date") >= F.date_sub(as_date(as_of), days)))
