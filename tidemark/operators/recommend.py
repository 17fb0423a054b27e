"""Recommendation backfill and version union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import MapType, StringType

from tidemark.functions import require_columns, smallest_rows, with_dense_index


def missing_audience(audience: DataFrame, output: DataFrame) -> DataFrame:
    """Audience ids without a recommendation row (duplicates in the audience stay)."""
    return audience.select("vip_no").join(output.select("vip_no"), "vip_no", "left_anti")


_ROW = "_row_hash"


def _row_hash(df: DataFrame):
    """Tells rows of one id apart (map columns cannot be hashed and are skipped)."""
    return F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)])


def _backfill_parts(output: DataFrame, audience: DataFrame, cycle: bool):
    """(supplement rows, missing audience rows that get no donor).

    Only keys are numbered, and of the donor keys only the first ones, as many
    as are missing (``smallest_rows``).  The i-th missing id meets the i-th
    donor key, and the wide rows are fetched for the donors in use alone; the
    output itself is neither sorted nor shuffled in full.
    """
    require_columns(output, ["vip_no"], "recommendation output")
    keyed = output.withColumn(_ROW, _row_hash(output))
    numbered = with_dense_index(missing_audience(audience, output), ["vip_no"], "_i")
    wanted = numbered.count()
    available = output.count()
    first = keyed.select("vip_no", _ROW)
    if wanted < available and isinstance(output.schema["vip_no"].dataType, StringType):
        first = smallest_rows(first, "vip_no", wanted)
    donors = with_dense_index(first, ["vip_no"], "_i").select(
        F.col("vip_no").alias("_donor"), F.col(_ROW).alias("_donor_row"), "_i")
    if cycle and available:
        numbered = numbered.withColumn("_i", (F.col("_i") - 1) % available + 1)
    pairs = numbered.join(donors, "_i", "inner").drop("_i")
    used = pairs.select(F.col("_donor").alias("vip_no"), F.col("_donor_row").alias(_ROW)).distinct()
    wide = keyed.join(used, ["vip_no", _ROW], "left_semi").dropDuplicates(["vip_no", _ROW])
    wide = wide.withColumnRenamed("vip_no", "_wide_id")
    supplement = pairs.join(wide, (F.col("_donor").eqNullSafe(F.col("_wide_id"))) & (F.col("_donor_row") == F.col(_ROW)))
    unfilled = 0 if cycle and available else max(wanted - available, 0)
    return supplement.select(*output.columns), unfilled


def fill_missing_recommendations(output: DataFrame, audience: DataFrame, cycle: bool = False) -> DataFrame:
    """Give each missing audience id the recommendation of a donor row and append.

    Missing ids and donor rows are both numbered 1..N in ``vip_no`` order with
    the distributed dense index, and the i-th missing id takes the i-th donor
    (D7).  With fewer donors than missing ids only the first ``donors`` are
    filled, as in the reference; ``cycle=True`` reuses donors round-robin
    (``(i - 1) % donors + 1``) so every missing id is filled.
    """
    return fill_and_report(output, audience, cycle)[0]


def fill_and_report(output: DataFrame, audience: DataFrame, cycle: bool = False) -> tuple[DataFrame, int]:
    """P9 and the number of missing audience rows that found no donor."""
    supplement, unfilled = _backfill_parts(output, audience, cycle)
    return output.unionByName(supplement), unfilled


def backfill(output: DataFrame, audience: DataFrame, cycle: bool = False) -> tuple[DataFrame, DataFrame]:
    """P9 and P10 together: ``(merged, counts)`` computed from one supplement."""
    supplement, _ = _backfill_parts(output, audience, cycle)
    return output.unionByName(supplement), fill_missing_counts(output, audience, supplement)


def fill_missing_counts(output: DataFrame, audience: DataFrame, supplement: DataFrame) -> DataFrame:
    """P10: distinct output ids, distinct audience ids, missing rows and distinct merged ids.

    One row per id first (flags and the audience's row count, partially
    aggregated), then one global sum: no distinct count and no Expand.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    tagged = reduce(DataFrame.unionByName, [
        output.select("vip_no", one.alias("o"), zero.alias("a"), zero.alias("m")),
        audience.select("vip_no", zero.alias("o"), one.alias("a"), zero.alias("m")),
        supplement.select("vip_no", zero.alias("o"), zero.alias("a"), one.alias("m")),
    ])
    ids = tagged.groupBy("vip_no").agg(F.max("o").alias("o"), F.sum("a").alias("a"), F.max("m").alias("m"))
    known = F.col("vip_no").isNotNull()
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0).cast("long")), F.lit(0))
    # an audience row whose id is NULL matches no output row and is missing
    return ids.agg(
        count(known & (F.col("o") > 0)).alias("output_ids"),
        count(known & (F.col("a") > 0)).alias("audience_ids"),
        F.coalesce(F.sum(F.when((F.col("o") == 0) | ~known, F.col("a"))), F.lit(0)).alias("missing_rows"),
        count(known & ((F.col("o") > 0) | (F.col("m") > 0))).alias("merged_ids"),
    )


def unfilled_rows(output: DataFrame, audience: DataFrame) -> DataFrame:
    """One row ``unfilled``: missing audience rows beyond the number of donors (never filled without ``cycle``)."""
    donors = output.agg(F.count(F.lit(1))).scalar()
    missing = missing_audience(audience, output).agg(F.count(F.lit(1)).alias("n"))
    return missing.select(F.greatest(F.col("n") - donors, F.lit(0)).alias("unfilled"))


def recommendations_union(*versions: DataFrame) -> DataFrame:
    """UNION ALL of the version outputs of one region (by column name)."""
    return reduce(DataFrame.unionByName, versions)
