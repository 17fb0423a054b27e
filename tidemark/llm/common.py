"""Shared helpers of the operators: pinned intermediates and size checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import ensure_checkpoint_dir


#: Spark's setting to delete an execution's shuffle files at its end.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Pins:
    """Owner of the frames pinned inside a ``with pins()`` block."""

    def __init__(self, outer: "Pins | None"):
        self.outer, self.paths, self.spark = outer, [], None

    def keep(self, frame: DataFrame) -> DataFrame:
        """Let the pinned ``frame`` live on: the block around this one owns it, or the caller."""
        path = _checkpoint_path(frame)
        self.paths.remove(path)
        if self.outer:
            self.outer.add(frame, path)
        return frame

    def add(self, frame: DataFrame, path: str) -> None:
        self.spark = frame.sparkSession
        self.paths.append(path)

    def drop(self, frame: DataFrame) -> None:
        """Delete the pinned ``frame`` now: what was made of it is pinned itself."""
        path = _checkpoint_path(frame)
        self.paths.remove(path)
        drop_path(self.spark, path)

    def close(self) -> None:
        for path in self.paths:
            drop_path(self.spark, path)


_OWNER: ContextVar[Pins | None] = ContextVar("pins", default=None)


@contextmanager
def pins() -> Iterator[Pins]:
    """Frames pinned in the block are deleted at its end, but for those it keeps."""
    owner = Pins(_OWNER.get())
    token = _OWNER.set(owner)
    try:
        yield owner
    finally:
        _OWNER.reset(token)
        owner.close()


def _checkpoint_path(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().logical().rdd().getCheckpointFile().get()


def pin(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder.

    The shuffle files behind it go once it is written; the checkpoint goes with
    the ``pins`` block around the call (without one it is the caller's).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        out = df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    if owner := _OWNER.get():
        owner.add(out, _checkpoint_path(out))
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _hadoop(spark, path)
    system.mkdirs(place)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no frame reads any more."""
    system, place = _hadoop(spark, path)
    system.delete(place, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of ``rows`` rows where the session leaves Spark's 10,000:
    a row holds a whole text here, and a batch is in memory several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_sample(df: DataFrame, n: int, seed: int, *cols: Column) -> DataFrame:
    """At most ``n`` rows: those with the smallest seeded hash of ``cols``.

    A hash cut expected to pass 4 n rows comes first, so the tasks together send
    about that many rows to the driver's top-n, however many tasks there are.
    """
    total, space = df.count(), 1 << 30
    h = F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(space))
    cut = space if total <= 4 * n else -(-4 * n * space // total)
    return df.filter(h < cut).orderBy(h, *cols).limit(n)


SLICES, FAN_IN = 16, 64


def array_slices(total: np.ndarray):
    """Rows (i, slot, at, c) for ``tree_sum`` from one task's array: its slices,
    as positions and values where most entries are 0."""
    from pyspark import TaskContext
    slot = TaskContext.get().partitionId()
    for i, piece in enumerate(np.array_split(total, SLICES)):
        full = np.flatnonzero(piece)
        if len(full):
            sparse = 2 * len(full) < len(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([slot], pa.int64()), pa.array([full.astype("<u4").tobytes() if sparse else None], pa.binary()),
                 pa.array([(piece[full] if sparse else piece).tobytes()], pa.binary())], names=["i", "slot", "at", "c"])


SLICE_ROWS = "i int, slot long, at binary, c binary"


def tree_sum(rows: DataFrame, tasks: int, size: int, kind) -> np.ndarray:
    """Sum of the tasks' arrays of ``size`` entries (rows of ``array_slices``).

    Slices of 64 tasks are added at a time, level by level, so no group holds
    more than that however many tasks there are; the total has a fixed size and
    comes to the driver.
    """
    widths = [len(x) for x in np.array_split(np.zeros(size, np.int8), SLICES)]

    def add(table: pa.Table) -> pa.Table:
        i, total = table.column("i")[0].as_py(), None
        total = np.zeros(widths[i], kind)
        for at, c in zip(table.column("at").to_pylist(), table.column("c").to_pylist()):
            if at is None:
                total += np.frombuffer(c, kind)
            else:
                total[np.frombuffer(at, "<u4")] += np.frombuffer(c, kind)
        return pa.table({"i": table.column("i")[:1], "slot": table.column("slot")[:1], "at": pa.array([None], pa.binary()),
                         "c": pa.array([total.tobytes()], pa.binary())})

    left = tasks
    while True:
        left = -(-left // FAN_IN)
        rows = rows.withColumn("slot", F.floor(F.col("slot") / FAN_IN)).groupBy("i", "slot").applyInArrow(add, SLICE_ROWS)
        if left <= 1:
            break
    out = [np.zeros(w, kind) for w in widths]
    for r in rows.select("i", "c").collect():
        out[r["i"]] = np.frombuffer(r["c"], kind)
    return np.concatenate(out)


def task_count(df: DataFrame) -> int:
    """Tasks that read ``df`` (cheap for files and checkpoints)."""
    return df._jdf.rdd().getNumPartitions()
