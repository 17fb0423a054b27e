"""Campaign and version configuration as nested JSON documents.

The documents are built as structs, arrays of arrays and maps from the version
table and the layout cells, and rendered by ``to_json``: one text row per
document.  Layout cells are regrouped in their own order (row, then column),
whatever order they arrive in.

Defined cases: a version without a layout has no rows and no business units; a
missing cell leaves its row one shorter; null audience ids are left out of
``include``; a null version or campaign id has no document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import broadcast_if_small
from tidemark.operators.registry import CAMPAIGN_CONSTANTS, LAYOUT_COLUMNS, VERSION_CONSTANTS

DOCUMENT_COLUMNS = ["campaign_id", "file", "document"]


def layout_grids(cells: DataFrame) -> DataFrame:
    """(region, version_id, products array<array<string>>) from P29's cells (region, version, row, col, bu)."""
    rows = (cells.groupBy("region", "version", "row")
            .agg(F.sort_array(F.collect_list(F.struct("col", "bu"))).alias("_cells"))     # as wide as the layout
            .select("region", "version", F.struct("row", F.col("_cells.bu").alias("bus")).alias("_row")))
    return (rows.groupBy("region", "version").agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
            .select("region", F.col("version").alias("version_id"), F.col("_rows.bus").alias("products")))


def _empty() -> Column:
    return F.create_map().cast("map<string,string>")


def _list(c: Column) -> Column:
    return F.filter(F.array(c), lambda x: x.isNotNull())


def version_documents(versions: DataFrame, cells: DataFrame, written_at: int) -> DataFrame:
    """One document per version: audience, product layout, business units in first-seen order, item list.

    ``versions`` is P30's table, ``written_at`` the run's time in epoch seconds.
    """
    fixed = dict(VERSION_CONSTANTS)
    grids = broadcast_if_small(layout_grids(cells))
    rows = versions.where(F.col("campaign_id").isNotNull() & F.col("version_id").isNotNull()).join(grids, ["region", "version_id"], "left")
    products = F.coalesce("products", F.array().cast("array<array<string>>"))
    units = F.array_distinct(F.filter(F.flatten(products), lambda u: u.isNotNull()))
    v, now = F.col("version_id"), F.lit(written_at)
    # fixed format: field names and nesting that the campaign service reads
    version = F.struct(
        F.lit(fixed["ab_testing_group"]).alias("ab_testing_group"), F.lit(fixed["language"]).alias("language"), v.alias("name"),
        F.lit(fixed["preference"]).alias("preference"), F.array(F.lit(fixed["subject_line"])).alias("subject_line"),
        F.struct(_list(F.col("audience_id")).alias("include")).alias("audience"),
        F.struct(F.lit(LAYOUT_COLUMNS).alias("col"), F.size(products).alias("row"), products.alias("products")).alias("product_sorting"),
        v.alias("id"),
        F.struct(F.struct(_empty().alias("filters")).alias("global"),
                 F.map_from_entries(F.transform(units, lambda u: F.struct(u, _empty()))).alias("bu"),
                 F.struct(F.lit("csv").alias("type"), F.col("item_list_path").alias("path")).alias("list")).alias("product"))
    document = F.struct(version.alias("version"), now.alias("created_at"), v.alias("id"), v.alias("name"),
                        F.lit(dict(CAMPAIGN_CONSTANTS)["status"]).alias("status"), now.alias("updated_at"))
    return rows.select("campaign_id", F.concat(F.lit("version_"), v, F.lit(".json")).alias("file"), F.to_json(document).alias("document"))


def campaign_documents(versions: DataFrame, written_at: int) -> DataFrame:
    """One document per campaign with its versions in name order (a campaign has as many as there are audience groups)."""
    fixed, now = dict(CAMPAIGN_CONSTANTS), F.lit(written_at)
    camps = (versions.where(F.col("campaign_id").isNotNull()).groupBy("campaign_id", "region")
             .agg(F.sort_array(F.collect_set("version_id")).alias("_versions")))
    # fixed format: field names and nesting that the campaign service reads
    campaign = F.struct(
        F.col("campaign_id").alias("id"), F.lit(fixed["campaign_name"]).alias("name"), F.col("region").alias("region"),
        F.lit(fixed["ab_testing"]).alias("ab_testing"), F.lit(fixed["utm_campaign"]).alias("utm_campaign"),
        F.lit(fixed["utm_medium"]).alias("utm_medium"), F.col("region").alias("utm_source"), F.col("_versions").alias("versions"),
        F.lit(fixed["status"]).alias("status"), now.alias("updated_at"), now.alias("created_at"))
    return camps.select("campaign_id", F.lit("campaign.json").alias("file"), F.to_json(F.struct(campaign.alias("campaign"))).alias("document"))


def configuration_documents(versions: DataFrame, cells: DataFrame, written_at: int) -> DataFrame:
    """All documents of the campaigns in ``versions``: (campaign_id, file, document)."""
    return campaign_documents(versions, written_at).unionByName(version_documents(versions, cells, written_at))
