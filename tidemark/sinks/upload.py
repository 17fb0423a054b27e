"""One CSV upload file, written by many tasks (K4, L1).

The file exists as a folder::

    <path>/header.csv             the header line
    <path>/data/part-*.csv        records in sort order, no header
    <path>/manifest.json          the files in order, with rows, bytes and SHA-256

The bytes of the manifest's files, one after the other, are the upload file:
any store's concatenation or an uploader that streams part by part sends it, and
no task holds more than its part.  The manifest is written last, so a folder
without one is an unfinished export.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.sinks import versioned

ROWS_PER_PART = 1_000_000
NULL_FIELD = "\x00"


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if any(c in name for c in ',"\r\n') else name


def write_upload(df: DataFrame, path: str, sort_cols: Sequence[str] = (), rows_per_part: int = ROWS_PER_PART) -> dict:
    """Write ``df`` as an upload file in the order of ``sort_cols``; returns the manifest.

    NULL is an empty field and '' is quoted, quotes are doubled, blanks are kept.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    seen = Observation()
    ordered = df.orderBy(*sort_cols) if sort_cols else df
    # after the sort, whose sampling would count the rows once more
    rows = ordered.observe(seen, F.count(F.lit(1)).alias("n"))
    versioned._delete(spark, path)
    (_csv_options(rows.write).option("header", False)
     .option("maxRecordsPerFile", rows_per_part).csv(f"{path}/data"))
    header = (",".join(map(_quoted, df.columns)) + "\n").encode()
    versioned._create(spark, f"{path}/header.csv", header.decode())
    name = F.substring_index("path", "/", -1).alias("name")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.csv").load(f"{path}/data")
    sums = files.select(name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    counts = _reader(spark, df.schema).csv(f"{path}/data").groupBy(F.col("_metadata.file_name").alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    # a row per part file comes to the driver
    parts = sums.join(counts, F.col("name") == F.col("part"), "left").orderBy("name").collect()
    entries = [{"file": "header.csv", "rows": 0, "bytes": len(header), "sha256": hashlib.sha256(header).hexdigest()}]
    entries += [{"file": f"data/{r['name']}", "rows": r["rows"] or 0, "bytes": r["bytes"], "sha256": r["sha256"]} for r in parts]
    total = sum(e["rows"] for e in entries)
    if total != seen.get["n"]:
        raise OSError(f"{path} holds {total} of {seen.get['n']} records")
    manifest = {"columns": df.columns, "sort": list(sort_cols), "rows": total, "bytes": sum(e["bytes"] for e in entries), "files": entries}
    versioned._create(spark, f"{path}/manifest.json", json.dumps(manifest, indent=1))
    return manifest


def _csv_options(io):
    return (io.option("encoding", "UTF-8").option("quote", '"').option("escape", '"').option("lineSep", "\n")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("nullValue", None).option("emptyValue", '""'))


def _reader(spark: SparkSession, schema):
    return (spark.read.schema(schema).option("encoding", "UTF-8").option("multiLine", True).option("quote", '"').option("escape", '"')
            .option("nullValue", NULL_FIELD).option("emptyValue", ""))


def upload_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files that make up the upload file, in order."""
    text = versioned._text(spark, f"{path.rstrip('/')}/manifest.json")
    if text is None:
        raise FileNotFoundError(f"{path} is no finished export")
    return [f"{path.rstrip('/')}/{e['file']}" for e in json.loads(text)["files"]]


def read_upload(spark: SparkSession, path: str, schema) -> DataFrame:
    """The records of an upload file, read part by part."""
    parts = upload_files(spark, path)[1:]
    return _reader(spark, schema).csv(parts) if parts else spark.createDataFrame([], schema)
