"""Customization registry (P27, P28) and campaign configuration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.ids import CAMPAIGN_PREFIX
from tidemark.functions.dates import to_pydate

REGISTRY_SCHEMA = "customization_id string, audience_id string, campaign_id string"

# Product layout per region and version (rows of business units;
# the layout always has four columns).
PRODUCT_SORTINGS = {
    "hk": {"female": [["WW", "LSA", "WW", "LSA"], ["HL", "COS", "HL", "COS"]],
           "male": [["MW", "MSA", "MW", "MSA"], ["HL", "MW", "HL", "MW"]]},
    "cn": {"female": [["WW", "LSA", "WW", "LSA"], ["HL", "COS", "HL", "COS"]],
           "male": [["MW", "MSA", "MW", "MSA"], ["HL", "MW", "HL", "MW"]]},
}
LAYOUT_COLUMNS = 4
# Campaign and version constants of the campaign configuration.
CAMPAIGN_NAME = "fprp_notification"
CAMPAIGN_CONSTANTS = (("campaign_name", CAMPAIGN_NAME), ("ab_testing", True), ("utm_campaign", "3"),
                      ("utm_medium", "email"), ("status", "Enabled"))
VERSION_CONSTANTS = (("ab_testing_group", "Standalone"), ("language", "EN"), ("preference", "personalized"),
                     ("subject_line", "Hi"))


def customization_id(region: str) -> str:
    return f"{CAMPAIGN_PREFIX}_{region.lower()}"


def campaign_id(blast_date, region: str) -> str:
    return f"{CAMPAIGN_PREFIX}_{to_pydate(blast_date).strftime('%Y%m%d')}_{region.lower()}"


def registry_rows(customization: str, campaign: str, audience_ids: DataFrame | list) -> DataFrame | list:
    """Rows (customization_id, audience_id, campaign_id) for one key.

    ``audience_ids`` is a DataFrame with an ``audience_id`` column (distributed)
    or a list of ids (driver parameters, as in the reference).
    """
    if isinstance(audience_ids, DataFrame):
        return audience_ids.select(F.lit(customization).alias("customization_id"), F.col("audience_id"),
                                   F.lit(campaign).alias("campaign_id"))
    return [(customization, a, campaign) for a in audience_ids]


def customization_replace(registry: DataFrame, customization: str, campaign: str, audience_ids) -> DataFrame:
    """Every row of ``customization`` replaced by one row per new audience id; other keys untouched.

    Rows with a NULL key are kept (``DELETE ... WHERE id = x`` keeps them).
    """
    new = registry_rows(customization, campaign, audience_ids)
    if not isinstance(new, DataFrame):
        new = registry.sparkSession.createDataFrame(new, REGISTRY_SCHEMA)
    kept = registry.where(~F.col("customization_id").eqNullSafe(customization))
    return kept.unionByName(new.select("customization_id", "audience_id", "campaign_id"))


def customization_lookup(registry: DataFrame, customization: str) -> DataFrame:
    """Audience ids and campaign id registered for one key."""
    return registry.where(F.col("customization_id") == customization).select("audience_id", "campaign_id")


def require_customization(found: DataFrame, customization: str) -> DataFrame:
    """Raise when the lookup is empty (one-row probe, not a full count)."""
    if found.isEmpty():
        raise ValueError(f"customization_id '{customization}' not found")
    return found


def audience_versions(grouped: DataFrame, blast_date, region: str) -> DataFrame:
    """(campaign_id, version_id, audience_id) for each group present in a region's audience."""
    camp = campaign_id(blast_date, region)
    return (grouped.select(F.lower(F.col("group")).alias("version_id")).distinct()
            .select(F.lit(camp).alias("campaign_id"), "version_id",
                    F.concat(F.lit(camp + "_"), F.col("version_id")).alias("audience_id")))


def campaign_version_table(versions: DataFrame, region: str, item_list_path: str | None = None) -> DataFrame:
    """One row per version with the campaign and version constants.

    ``versions`` holds (campaign_id, version_id, audience_id) pairs, e.g. from
    :func:`audience_versions`; the region is an argument (D20), and the
    layout row count comes from the product layout of the version.
    """
    cols = [F.col("campaign_id"), F.col("version_id"), F.col("audience_id"), F.lit(region.lower()).alias("region"),
            F.lit(region.lower()).alias("utm_source")]
    cols += [F.lit(v).alias(k) for k, v in CAMPAIGN_CONSTANTS + VERSION_CONSTANTS]
    layout_rows = None
    for version, grid in PRODUCT_SORTINGS.get(region.lower(), {}).items():
        hit = F.col("version_id") == version
        layout_rows = F.when(hit, len(grid)) if layout_rows is None else layout_rows.when(hit, len(grid))
    cols.append((layout_rows if layout_rows is not None else F.lit(None)).cast("int").alias("layout_rows"))
    cols.append(F.lit(LAYOUT_COLUMNS).alias("layout_cols"))
    path = item_list_path or F.concat(F.lit("campaign/"), F.col("campaign_id"), F.lit("/item_list.csv"))
    cols.append((F.lit(path) if isinstance(path, str) else path).alias("item_list_path"))
    return versions.select(*cols)


def layout_grid_table(spark: SparkSession, sortings=None) -> DataFrame:
    """The product layouts as a table: (region, version, grid array<array<string>>)."""
    sortings = PRODUCT_SORTINGS if sortings is None else sortings
    rows = [(r, v, grid) for r, versions in sortings.items() for v, grid in versions.items()]
    return spark.createDataFrame(rows, "region string, version string, grid array<array<string>>")


def layout_slots(grids: DataFrame) -> DataFrame:
    """(region, version, row, col, bu) cells of each layout, 1-based positions."""
    rows = grids.select("region", "version", F.posexplode("grid").alias("_r", "_cells"))
    return rows.select("region", "version", (F.col("_r") + 1).alias("row"),
                       F.posexplode("_cells").alias("_c", "bu")).select(
        "region", "version", "row", (F.col("_c") + 1).alias("col"), "bu")


def layout_summary(grids: DataFrame) -> DataFrame:
    """Grid row count and the distinct business units of each layout (first-seen order)."""
    return grids.select("region", "version", F.size("grid").alias("rows"),
                        F.array_distinct(F.flatten("grid")).alias("bus"))


def version_pairs(spark: SparkSession, campaign: str, version_ids, audience_ids) -> DataFrame:
    """P30 from run parameters: pair version ids with audience ids by position.

    Both lists may be given as Python lists or comma-separated text (the
    form the scheduler passes); extra entries on either side are dropped, as
    a positional zip does.
    """
    def text(v):
        return v if isinstance(v, str) else ",".join(v)
    one = spark.createDataFrame([(campaign, text(version_ids), text(audience_ids))], "c string, v string, a string")
    pairs = F.explode(F.arrays_zip(F.split("v", ",").alias("version_id"), F.split("a", ",").alias("audience_id")))
    return (one.select(F.col("c").alias("campaign_id"), pairs.alias("p"))
            .where(F.col("p.version_id").isNotNull() & F.col("p.audience_id").isNotNull())
            .select("campaign_id", F.col("p.version_id").alias("version_id"), F.col("p.audience_id").alias("audience_id")))


def config_json(df: DataFrame) -> DataFrame:
    """One JSON document per row (C20), e.g. for writing a config table as text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
