"""Exact top-k inner-product search on an impact-ordered index.

Candidates are packed into blocks of bounded size.  A block's index keeps, for
each dimension, posting segments of equal quantised impact (the component's
magnitude without its low bits).  A batch of queries walks the segments score
at a time, by descending impact, and adds sign * impact * query weight to its
accumulators.  After a level every score is known up to
``sum |q_d| * (level - 1)``.  A query stops only when that bound proves that no
more than ``rescore`` candidates can be members; all possible members, however
many, are then scored exactly.

One block is searched first.  A query's k-th score there is a floor under its
k-th score overall, which every other block gets with the query: a candidate
that cannot reach the floor is no member, and a block in which few can is left
after its first levels.

Query blocks meet candidate blocks through a join on a group number; one row
per pair of blocks, never per pair of vectors.

Defined results: vectors that are null, or hold null or non-finite components,
and rows with a null id take no part; vectors of different length are compared
on their common leading components; equal ids never match each other; repeated
query rows count once, repeated candidate rows each; ties go to the smaller id;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import pin, shuffle_partitions

BLOCK_VECTORS = 4096
BLOCK_QUERIES = 512
LEVEL_BITS = 6
NO_FLOOR = np.iinfo(np.int64).min // 2


def _pack(df: DataFrame, block: int) -> DataFrame:
    """Rows (n, dims, ids, cells): up to ``block`` vectors of one task each."""

    def pack(batches):
        ids, vecs = [], []

        def flush():
            d = max(map(len, vecs))
            cells = np.zeros((len(vecs), d), np.int64)
            for i, v in enumerate(vecs):
                cells[i, :len(v)] = v
            out = pa.RecordBatch.from_arrays([pa.array([len(ids)]), pa.array([d], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()]),
                                              pa.array([cells.tobytes()])], names=["n", "dims", "ids", "cells"])
            ids.clear(), vecs.clear()
            return out

        for b in batches:
            col = b.column(1)
            off, flat = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
            for i, key in enumerate(b.column(0).to_pylist()):
                ids.append(key), vecs.append(flat[off[i]:off[i + 1]])
                if len(ids) == block:
                    yield flush()
        if ids:
            yield flush()

    return df.mapInArrow(pack, "n long, dims int, ids binary, cells binary")


class ImpactIndex:
    """Posting segments of one block in descending impact."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        size = np.abs(cells)
        self.shift = max(0, int(size.max(initial=0)).bit_length() - LEVEL_BITS)
        level = size >> self.shift
        self.levels = []
        for l in range(int(level.max(initial=0)), 0, -1):
            segments = []
            for d in np.flatnonzero((level == l).any(0)):
                docs = np.flatnonzero(level[:, d] == l)
                segments.append((d, docs, np.sign(cells[docs, d]) * (l << self.shift)))
            self.levels.append((l, segments))

    def search(self, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, rescore: int = 64, floor: np.ndarray | None = None):
        """(query row, candidate row, exact score) of all possible top-k members; ``floor`` holds proven lower bounds of the k-th scores."""
        n, m = len(self.cells), len(queries)
        floor = np.full(m, NO_FLOOR) if floor is None else floor
        acc = np.zeros((n, m), np.int64)
        weight, live = np.abs(queries).sum(1), np.arange(m)
        own = ids[:, None] == query_ids[None, :]
        found = []
        for l, segments in [*self.levels, (0, [])]:
            for d, docs, impact in segments:
                acc[docs] += impact[:, None] * queries[live, d][None, :]
            last = l == 0
            if not last and (l & (l - 1) or l > 16):      # proofs are tried at levels 16, 8, 4, 2, 1
                continue
            slack = weight[live] * ((1 << self.shift) - 1 if last else (l << self.shift) - 1)
            shown = np.where(own[:, live], np.iinfo(np.int64).min // 4, acc)
            kth = np.partition(shown, max(0, n - k), axis=0)[max(0, n - k)] if n else np.zeros(len(live), np.int64)
            possible = (shown >= np.maximum(kth - 2 * slack, floor[live] - slack)) & ~own[:, live]
            done = np.full(len(live), True) if last else possible.sum(0) <= max(rescore, k)
            if done.any():
                c, q = np.nonzero(possible[:, done])
                found.append((live[done][q], c))
                acc, live = acc[:, ~done], live[~done]
            if not len(live):
                break
        q = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        c = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        return q, c, np.einsum("ij,ij->i", self.cells[c], queries[q])


def top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): queries are the ids divisible by ``query_every``."""
    x = F.col(vector_col).cast("array<double>")
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    cells = (vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x"), ok.alias("ok"))
             .filter(F.col("id").isNotNull() & F.col("x").isNotNull() & F.col("ok"))
             .select("id", F.transform("x", lambda v: F.floor(v * scale)).alias("x")))
    blocks = pin(_pack(cells, BLOCK_VECTORS).withColumn("block", F.monotonically_increasing_id()))
    asked = pin(_pack(cells.filter(F.col("id") % query_every == 0).distinct(), BLOCK_QUERIES))
    most = 4 * shuffle_partitions(vectors.sparkSession)
    first = blocks.select("block", "n").orderBy(F.desc("n"), "block").first()
    probe = F.col("block") == (first["block"] if first else -1)

    def searches(batches):
        """(pair, query ids, vector ids, scores, query's place) of every pair of blocks."""
        at, index, ids = None, None, None
        for b in batches:
            for row in b.to_pylist():
                if row["block"] != at:
                    at, ids = row["block"], np.frombuffer(row["ids"], np.int64)
                    cells = np.frombuffer(row["cells"], np.int64).reshape(-1, row["dims"])
                    index = ImpactIndex(cells)
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                asked = np.frombuffer(row["q_cells"], np.int64).reshape(len(q_ids), row["q_dims"])
                width = index.cells.shape[1]
                fitted = np.zeros((len(q_ids), width), np.int64)
                fitted[:, :min(width, asked.shape[1])] = asked[:, :width]
                floor = np.frombuffer(row["q_floor"], np.int64) if row["q_floor"] else None
                q, c, s = index.search(ids, fitted, q_ids, k, floor=floor)
                order = np.lexsort((ids[c], -s, q))
                q, c, s = q[order], c[order], s[order]
                keep = np.arange(len(q)) - np.searchsorted(q, q) < k
                yield row, q_ids[q[keep]], ids[c[keep]], s[keep], q[keep]

    def probed(batches):
        for row, q_id, v_id, s, q in searches(batches):
            floor = np.full(len(row["q_ids"]) // 8, NO_FLOOR)
            full = np.flatnonzero(np.arange(len(q)) - np.searchsorted(q, q) == k - 1)      # a query's k-th hit
            floor[q[full]] = s[full]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in (q_id, v_id, s)]
            yield pa.RecordBatch.from_arrays([pa.array([row["q_dims"]], pa.int32()), pa.array([row["q_ids"]]), pa.array([row["q_cells"]]),
                                              pa.array([floor.tobytes()]), *lists],
                                             names=["q_dims", "q_ids", "q_cells", "q_floor", "query_id", "vec_id", "score"])

    def search(batches):
        for _, q_id, v_id, s, _ in searches(batches):
            yield pa.RecordBatch.from_arrays([pa.array(q_id), pa.array(v_id), pa.array(s)], names=["query_id", "vec_id", "score"])

    def dealt(blocks: DataFrame, copied: DataFrame, groups: int) -> DataFrame:
        """Every row of ``copied`` beside every row of ``blocks``, which are dealt over ``groups`` groups."""
        one = blocks.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        return one.join(copied.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))), "g")

    questions = asked.select(F.col("dims").alias("q_dims"), F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"),
                             F.lit(None).cast("binary").alias("q_floor"))
    pair = ["block", "dims", "ids", "cells", "q_dims", "q_ids", "q_cells", "q_floor"]
    floors = pin(dealt(questions, blocks.filter(probe), max(1, min(asked.count(), most))).select(*pair).mapInArrow(
        probed, "q_dims int, q_ids binary, q_cells binary, q_floor binary, query_id array<long>, vec_id array<long>, score array<long>"))
    rest = blocks.filter(~probe)
    pairs = dealt(rest, floors.select("q_dims", "q_ids", "q_cells", "q_floor"), max(1, min(blocks.count() - 1, most))).select(*pair)
    hits = (pairs.mapInArrow(search, "query_id long, vec_id long, score long")
            .unionByName(floors.select(F.inline(F.arrays_zip("query_id", "vec_id", "score")))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def oracle(k: int = 5, query_every: int = 50, scale: int = 256) -> str:
    """DuckDB SQL of ``top_k`` over the table embeddings."""
    return f"""WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x, true), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {query_every} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {k}"""
