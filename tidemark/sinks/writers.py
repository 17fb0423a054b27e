"""Sinks.

* Overwrites replace the whole path (K1, K3, K6), whatever the session's
  partition overwrite mode is.
* The blast history (K2, P21) and the registry (K7) are versioned tables
  (``sinks.versioned``): a run replaces exactly the (region, date) pairs or the
  key it declares, with or without rows for them, in one commit (D13).
* A table rewritten from its own contents (K5) is ``versioned.rewrite``; for a
  plain Parquet folder ``overwrite_from_self`` writes a sibling staging path
  first and swaps it in by two renames.
* The export feeds are upload files written by many tasks (K4, ``sinks.upload``);
  other CSV output is a folder of part files with a header.  Text comes back unchanged from a standard CSV reader: quotes are
  doubled, blanks are kept, NULL is an empty field and '' is quoted.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.operators.registry import REGISTRY_SCHEMA, registry_rows
from tidemark.sinks import versioned
from tidemark.sinks.upload import write_upload


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """K1/K3: Parquet write (the whole path is replaced by default)."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by) -> None:
    """K2: replace only the partitions that ``df`` has rows for."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def append_blast_history(rows: DataFrame, path: str, run: Sequence[tuple], test: bool = False) -> bool:
    """Make ``rows`` the history of the run's (region, blast_date) pairs unless in test mode.

    ``run`` lists the pairs of this run.  Running the same blast twice leaves one
    copy, a pair without rows has none afterwards, and rows of any other pair are
    an error.  Read the table with ``read_versioned``.  Returns whether anything was written.
    """
    if test:
        return False
    versioned.replace(rows, path, ["region", "blast_date"], run)
    return True


def write_quality_split(marked: DataFrame, path: str, max_rejects: int | None = None) -> dict:
    """Accepted and rejected rows of a ``quality_marked`` list to partitions of their own in one pass over it.

    Returns the counts.  With more than ``max_rejects`` rejects nothing is
    committed and a ValueError is raised.  Read either side with
    ``read_versioned(path, where={"accepted": ...})``.
    """
    found: dict = {}

    def check(counts: dict) -> None:
        found.update(accepted=counts[True,], rejected=counts[False,])
        if max_rejects is not None and found["rejected"] > max_rejects:
            raise ValueError(f"{found['rejected']} rows with missing or duplicate item codes, more than {max_rejects}")

    versioned.replace(marked, path, ["accepted"], [(True,), (False,)], check=check)
    return found


def write_documents(documents: DataFrame, path: str) -> None:
    """C20: each (campaign_id, file, document) row as the one line of a text file below ``campaign_id=.../file=...``."""
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("campaign_id", "file").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``write_documents`` wrote."""
    return (spark.read.schema("document string, campaign_id string, file string").text(path)
            .select("campaign_id", "file", "document"))


def _files(spark: SparkSession, path: str):
    """(file system, Hadoop path) of ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _files(spark, source)
    if not fs.rename(p, _files(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.exists(p)


def overwrite_from_self(df: DataFrame, path: str) -> None:
    """K5: overwrite ``path`` with a frame that may be computed from ``path`` itself.

    The result is written completely beside the old files and its row count
    is checked against the rows that went in; only then the two are swapped,
    and the old files go last.  If the second rename fails the old folder is put
    back; a driver lost between the two renames leaves both folders beside the
    path and none at it.  ``versioned.rewrite`` has no such moment.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    tag = uuid.uuid4().hex
    staging, old = f"{path}__staging_{tag}", f"{path}__old_{tag}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(staging)
    if spark.read.parquet(staging).count() != seen.get["n"]:
        raise OSError(f"{staging} does not hold the rows that were written")
    if path_exists(spark, path):
        _rename(spark, path, old)
        try:
            _rename(spark, staging, path)
        except Exception:
            _rename(spark, old, path)
            raise
        fs, p = _files(spark, old)
        fs.delete(p, True)
    else:
        _rename(spark, staging, path)


def overwrite_table(df: DataFrame, name: str) -> None:
    """K5 for a catalog table: create ``name``, or replace it by a frame that may read it.

    The new rows are saved under a staging name first; the old table is
    dropped only after that, and the staging table takes its name.
    """
    spark = df.sparkSession
    staging = f"{name}__staging_{uuid.uuid4().hex}"
    df.write.mode("errorifexists").saveAsTable(staging)
    if spark.catalog.tableExists(name):
        old = f"{name}__old_{uuid.uuid4().hex}"
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
        except Exception:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
            raise
        spark.sql(f"DROP TABLE {old}")
    else:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")


def write_registry(spark: SparkSession, path: str, customization: str, campaign: str, audience_ids) -> None:
    """P27 sink (K7): all rows of ``customization`` are replaced by one row per
    audience id; with no ids the key's rows are gone afterwards.

    Only that key is written; runs of different keys do not get in each other's
    way.  Read the registry with ``read_versioned``.
    """
    rows = registry_rows(customization, campaign, audience_ids)
    if not isinstance(rows, DataFrame):
        rows = spark.createDataFrame(rows, REGISTRY_SCHEMA)
    versioned.replace(rows.select("customization_id", "audience_id", "campaign_id"), path, ["customization_id"], [(customization,)])


def write_audience_lists(ids_by_group: DataFrame, path: str) -> None:
    """P4 sink: one Parquet dataset per audience group (``group=<name>`` folders); the whole path is replaced."""
    write_parquet(ids_by_group, path, partition_by=["group"])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: a folder of CSV part files with header, UTF-8, no index column."""
    (df.write.mode(mode).option("header", True).option("encoding", "UTF-8")
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("nullValue", None).option("emptyValue", '""').csv(path))


# An unquoted empty field is NULL for the reader by itself; this text stands for no value at all.
NULL_FIELD = "\x00"


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read back what :func:`write_csv` wrote: text unchanged, NULL and '' told apart."""
    r = (spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", True)
         .option("quote", '"').option("escape", '"').option("nullValue", NULL_FIELD).option("emptyValue", ""))
    return (r.schema(schema) if schema is not None else r).csv(path)


def write_feed(df: DataFrame, path: str, sort_cols=None) -> None:
    """K4 for export feeds; ``sort_cols`` gives a globally ordered (range-partitioned) export."""
    write_csv(df.orderBy(*sort_cols) if sort_cols else df, path)


def feed_name(kind: str, blast_date: str, region: str) -> str:
    """Folder name of an export feed: ``<kind>_fprp_notification_<yyyyMMdd>_<region>.upsert.csv``.

    The name is that of the upload file; it is a folder whose files, in the
    order of its manifest, make up the file.
    """
    return f"{kind}_fprp_notification_{blast_date}_{region}.upsert.csv"


def write_blast_exports(feeds: dict, base_dir: str, blast_date: str, region: str) -> dict:
    """K4: the three export feeds of one region as upload files (``sinks.upload``).

    ``feeds`` maps kind (campaign_personalization, products,
    product_recommendation) to its DataFrame; product_recommendation is
    written in (customer_id, display_id) order.
    """
    paths = {}
    for kind, df in feeds.items():
        path = f"{base_dir.rstrip('/')}/{feed_name(kind, blast_date, region)}"
        write_upload(df, path, ["customer_id", "display_id"] if kind == "product_recommendation" else ())
        paths[kind] = path
    return paths
