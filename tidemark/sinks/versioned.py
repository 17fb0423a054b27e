"""Tables whose every change is one commit.

A table is a folder of data folders and a list of versions::

    <path>/data/<write>/__part=<i>/part-*.parquet
    <path>/_versions/<number>.json     which data folders make up the table

A change writes its rows to new data folders, checks their counts, and commits
by creating the next version file, which fails if that file exists.  Readers
take the files that the highest complete version names, so at any moment, and
after a failure at any step, they see the old table or the new one.

A table may be split by partition columns.  A change names the partitions it
replaces, whether it has rows for them or not: one without rows is gone
afterwards.  Writers that declare different partitions both succeed, the later
one on top of the earlier; a writer whose partitions were changed by someone
else since it read them is refused.

A version file without its end mark is a commit under way: readers pass over
it, writers wait for it and take its number over after ``STALE_SECONDS``, and
the writer it belonged to notices that it is gone and fails.

Creating a file only if it is absent must be atomic on the store (HDFS, object
stores with conditional writes; on a local disk one machine's writers are told
apart only as well as Hadoop's local file system does).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

STALE_SECONDS = 600
COMMIT_TRIES = 100
PART = "__part"


class ConcurrentWrite(RuntimeError):
    """Someone else changed what this write was about to replace."""


# ---------------------------------------------------------------- files

def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.delete(p, True)


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with ``text``; False if it exists already."""
    fs, p = _files(spark, path)
    try:
        out = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    data = text.encode()
    out.write(data, 0, len(data))
    out.close()
    return True


def _text(spark: SparkSession, path: str) -> str | None:
    fs, p = _files(spark, path)
    try:
        stream = fs.open(p)
    except Exception:
        if fs.exists(p):
            raise
        return None
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _version_file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_versions/{number:020d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Version numbers with a file, highest first."""
    fs, p = _files(spark, f"{path.rstrip('/')}/_versions")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def _manifest(spark: SparkSession, path: str, number: int) -> dict | None:
    """The version's manifest; None while it is being written."""
    text = _text(spark, _version_file(path, number))
    try:
        found = json.loads(text) if text else None
    except ValueError:
        return None
    return found if found and found.get("end") else None


def _newest(spark: SparkSession, path: str) -> dict | None:
    return next((m for n in _numbers(spark, path) if (m := _manifest(spark, path, n))), None)


# ---------------------------------------------------------------- reading

def current_version(spark: SparkSession, path: str) -> int:
    """Number of the newest complete version, 0 if there is none."""
    found = _newest(spark, path)
    return found["version"] if found else 0


def read_versioned(spark: SparkSession, path: str, version: int | None = None, where: dict | None = None) -> DataFrame:
    """The table as of ``version`` (default: the newest); ``where`` reads only the partitions with these values."""
    found = _manifest(spark, path, version) if version else _newest(spark, path)
    if not found:
        raise FileNotFoundError(f"no version of a table at {path}")
    schema = StructType.fromJson(found["schema"])
    parts = found["parts"]
    for name, value in (where or {}).items():
        at = found["partition_by"].index(name)
        parts = [p for p in parts if p["values"][at] == _label(value)]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{p['data']}" for p in parts])


def _label(value) -> str | None:
    return None if value is None else str(value)


# ---------------------------------------------------------------- writing

def _stage(df: DataFrame, folder: str, partition_by: Sequence[str], declared: list[tuple]) -> dict[int, int]:
    """Write the rows below ``folder``, one folder per declared partition; returns rows per partition number."""
    spark = df.sparkSession
    if partition_by:
        fields = [df.schema[c] for c in partition_by]
        kinds = StructType().add(PART, "integer")
        for i, f in enumerate(fields):
            kinds = kinds.add(f"__value{i}", f.dataType)
        # as long as the caller's own list
        names = F.broadcast(spark.createDataFrame([(n, *values) for n, values in enumerate(declared)], kinds))
        same = [F.col(f"`{c}`").eqNullSafe(F.col(f"__value{i}")) for i, c in enumerate(partition_by)]
        on = same[0]
        for x in same[1:]:
            on = on & x
        rows = df.join(names, on, "left").drop(*[f"__value{i}" for i in range(len(fields))])
    else:
        rows = df.withColumn(PART, F.lit(0))
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(PART).isNull()).alias("other"))
    rows.write.mode("errorifexists").partitionBy(PART).parquet(folder)
    if seen.get["other"]:
        raise ValueError(f"{seen.get['other']} rows lie outside the declared partitions")
    stored = spark.read.schema(StructType().add(PART, "integer")).parquet(folder) if seen.get["n"] else None
    counts = {r[PART]: r["count"] for r in stored.groupBy(PART).count().collect()} if stored else {}   # a row per declared partition
    if sum(counts.values()) != seen.get["n"]:
        raise OSError(f"{folder} does not hold the rows that were written")
    return counts


def _commit(spark: SparkSession, path: str, base: dict | None, schema: StructType, partition_by: list[str], values: list[list], parts: list[dict]) -> int:
    for _ in range(COMMIT_TRIES):
        numbers = _numbers(spark, path)
        top = numbers[0] if numbers else 0
        current = _manifest(spark, path, top) if top else None
        if top and current is None:
            fs, p = _files(spark, _version_file(path, top))
            if fs.exists(p) and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 > STALE_SECONDS:
                fs.delete(p, False)
            else:
                time.sleep(0.1)
            continue
        if (current or {}).get("version") != (base or {}).get("version"):
            _refuse_conflicts(base, current, partition_by, values)
        kept = [p for p in (current or {}).get("parts", []) if p["values"] not in values]
        if kept and StructType.fromJson(current["schema"]).simpleString() != schema.simpleString():
            raise ValueError("the new rows have other columns than the partitions that stay")
        token = uuid.uuid4().hex
        text = json.dumps({"version": top + 1, "writer": token, "schema": schema.jsonValue(), "partition_by": partition_by, "parts": kept + parts, "end": True})
        if _create(spark, _version_file(path, top + 1), text):
            written = _manifest(spark, path, top + 1)
            if not written or written["writer"] != token:
                raise ConcurrentWrite(f"version {top + 1} of {path} was taken over by another writer")
            return top + 1
    raise ConcurrentWrite(f"no version number of {path} was free in {COMMIT_TRIES} tries")


def _refuse_conflicts(base: dict | None, current: dict | None, partition_by: list[str], values: list[list]) -> None:
    def mine(manifest: dict | None) -> list[tuple]:
        return sorted((str(p["values"]), p["data"]) for p in (manifest or {}).get("parts", []) if p["values"] in values)

    if current and current["partition_by"] != partition_by or mine(base) != mine(current):
        raise ConcurrentWrite("the partitions to replace were changed by another writer")


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), declared: Sequence[tuple] = ((),), base: int | None = None,
            check: Callable[[dict[tuple, int]], None] | None = None) -> int:
    """Replace the ``declared`` partitions (default: the whole table) by the rows of ``df``; returns the new version.

    ``base`` is the version that ``df`` was made from (default: the newest one
    now; 0: no table yet).  ``check`` sees the rows per declared partition before
    the commit; if it raises a ValueError nothing is committed.
    """
    spark, path, partition_by = df.sparkSession, path.rstrip("/"), list(partition_by)
    numbers = _numbers(spark, path)
    fs, p = _files(spark, path)
    if not numbers and fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".", "data")) for s in fs.listStatus(p)):
        raise ValueError(f"{path} holds files that belong to no version")
    before = _newest(spark, path) if base is None else _manifest(spark, path, base) if base else None
    if before and before["partition_by"] != partition_by:
        raise ValueError(f"the table is partitioned by {before['partition_by']}")
    declared = [tuple(d) for d in declared]
    values = [[_label(x) for x in d] for d in declared]
    write = f"data/{uuid.uuid4().hex}"
    try:
        counts = _stage(df, f"{path}/{write}", partition_by, declared)
        if check:
            check({d: counts.get(i, 0) for i, d in enumerate(declared)})
        parts = [{"values": values[i], "data": f"{write}/{PART}={i}", "rows": n} for i, n in sorted(counts.items())]
        return _commit(spark, path, before, df.schema, partition_by, values, parts)
    except (ConcurrentWrite, ValueError):
        _delete(spark, f"{path}/{write}")                        # surely not named by any version
        raise


def rewrite(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> int:
    """Replace a whole table by a frame made from it; refused if the table changes meanwhile."""
    version = current_version(spark, path)
    return replace(change(read_versioned(spark, path, version)), path, base=version)


def vacuum(spark: SparkSession, path: str, keep: int = 1, older_than: float = 86_400) -> int:
    """Delete versions beyond the ``keep`` newest and the data that no version left names; nothing younger than ``older_than`` seconds goes."""
    path = path.rstrip("/")

    def old(status) -> bool:
        return time.time() - status.getModificationTime() / 1000 >= older_than

    used, whole = set(), 0
    for n in _numbers(spark, path):
        fs, file = _files(spark, _version_file(path, n))
        found = _manifest(spark, path, n)
        whole += bool(found)
        if whole > keep and old(fs.getFileStatus(file)):
            fs.delete(file, False)
        elif found:
            used |= {p["data"].split("/")[1] for p in found["parts"]}
    fs, p = _files(spark, f"{path}/data")
    gone = 0
    for s in fs.listStatus(p) if fs.exists(p) else []:
        if s.getPath().getName() not in used and old(s):
            fs.delete(s.getPath(), True)
            gone += 1
    return gone
