"""Scan helpers.

Readers return lazy DataFrames; Catalyst prunes columns and pushes filters
into the Parquet scan, so callers never select columns up front.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.ids import id_token

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet file or directory; a known ``schema`` saves the footer-reading job."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None) -> DataFrame:
    """One base table of a scale-factor folder: ``<sf_dir>/<name>.parquet``."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", schema)


def campaign_output_name(campaign_id: str, group: str, schema: str | None = None) -> str:
    """S3: catalog name of a recommender output for one campaign version."""
    name = f"campaign_{campaign_id}_version_{group}_final_output"
    return f"{schema}.{name}" if schema else name


def campaign_outputs(spark: SparkSession, schema: str | None = None, campaign_id: str | None = None) -> DataFrame:
    """S3/C17: all recommender outputs of the catalog (or of one campaign) as one frame.

    The tables are found by their name pattern.  Each row carries
    ``campaign_id``, ``version``, ``blast_date`` and ``campaign_region``, cut from its
    table's name; columns are matched by name whatever their order, and a
    table without one of them has NULLs there.
    """
    found = sorted(t.name for t in spark.catalog.listTables(schema, campaign_output_name(campaign_id or "*", "*")))
    if not found:
        raise ValueError(f"no recommender output of {campaign_id or 'any campaign'} in the catalog")
    frames = []
    for name in found:
        part = [F.regexp_extract(F.lit(name), campaign_output_name("(.+)", "(.+?)"), i) for i in (1, 2)]
        frames.append(spark.table(f"{schema}.{name}" if schema else name).select(
            "*", part[0].alias("campaign_id"), part[1].alias("version"),
            F.to_date(id_token(part[0], -2), "yyyyMMdd").alias("blast_date"), id_token(part[0], -1).alias("campaign_region")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def campaign_table(spark: SparkSession, campaign_id: str, group: str, schema: str | None = None) -> DataFrame:
    """S3: ``spark.table`` of the recommender output named after campaign and version."""
    return spark.table(campaign_output_name(campaign_id, group, schema))
