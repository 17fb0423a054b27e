"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents may belong to several sources.  They are aggregated by membership
pattern (the set of their sources); a min-cost flow routes each pattern's words
to the sources' quotas.  A pattern offers its words ``max_repeats`` times, and
the r-th repetition of a word costs r - 1, so costs are convex and repetition
is used only where it is needed.  The flow's total per pattern becomes whole
copies of all its documents plus one more copy of a seeded selection.

Only one row per pattern and per histogram bucket reaches the driver; the
selection itself is a threshold on a seeded hash, found by refining a
4096-bucket histogram of word counts three times, and is applied without a
shuffle.

Defined results: a null or empty text has size 0 and nothing is taken from it;
a null source is a source of its own and sorts last; a null id hashes like any
other value; rows that agree in id and text hash alike, so they are selected
together; an empty table gives no rows.
"""

from __future__ import annotations

from collections import deque
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import columns, pin, pins
from tidemark.llm.texts import word_counts

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20240110
MAX_PATTERNS = 200_000
_BITS, _LEVELS = 12, 3
FETCH_ROWS = 1 << 17


def word_sizes(docs: DataFrame, text_col: str = "text", size_col: str = "size", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all but the text) plus the number of words."""
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    cols = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                       F.col(f"`{text_col}`").cast("string").alias("t"))

    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(word_counts(b.column(b.num_columns - 1)))],
                                             names=[*b.schema.names[:-1], "n"])

    schema = cols.drop("t").schema.add("n", "long")
    out = cols.mapInArrow(count, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("n").alias(size_col))


def source_targets(sizes: dict, weights=WEIGHTS, cap: int = CAP) -> dict:
    """Share all words over the sources by weight; a target stops at ``cap`` times
    its source's size and the excess is shared anew by weight."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = Fraction(sum(sizes.values())), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > cap * sizes[s]]
        if not full:
            out.update({s: unit * weight[s] for s in open_})
            break
        for s in full:
            out[s] = Fraction(cap * sizes[s])
            left -= out[s]
            open_.discard(s)
    return out


def min_cost_flow(patterns: list[tuple[tuple, int]], quotas: dict, max_repeats: int) -> list[int]:
    """Words taken from each pattern by a min-cost maximum flow.

    ``patterns``: (sources, words).  Each augmentation follows the cheapest
    residual path (Bellman-Ford queue), costs are 0, 1, 2, ... per repetition.
    """
    sources = list(quotas)
    n_p, sink = len(patterns), 1 + len(patterns) + len(sources)
    head: list[list[int]] = [[] for _ in range(sink + 1)]
    to, room, cost = [], [], []

    def arc(a, b, cap, c):
        for u, v, k, w in ((a, b, cap, c), (b, a, 0, -c)):
            head[u].append(len(to))
            to.append(v), room.append(k), cost.append(w)

    seat = {s: 1 + n_p + i for i, s in enumerate(sources)}
    for i, (members, words) in enumerate(patterns):
        for r in range(max_repeats if words else 0):
            arc(0, 1 + i, words, r)
        for s in members:
            arc(1 + i, seat[s], words * max_repeats, 0)
    for s in sources:
        arc(seat[s], sink, quotas[s], 0)
    while True:
        dist, via, queued = {0: 0}, {}, {0}
        queue = deque([0])
        while queue:
            u = queue.popleft()
            queued.discard(u)
            for e in head[u]:
                if room[e] and dist[u] + cost[e] < dist.get(to[e], 1 << 60):
                    dist[to[e]], via[to[e]] = dist[u] + cost[e], e
                    if to[e] not in queued:
                        queued.add(to[e])
                        queue.append(to[e])
        if sink not in dist:
            break
        path, v = [], sink
        while v:
            path.append(via[v])
            v = to[via[v] ^ 1]
        flow = min(room[e] for e in path)
        for e in path:
            room[e] -= flow
            room[e ^ 1] += flow
    # the reverse room of an arc out of the start node is its flow
    return [sum(room[e ^ 1] for e in head[0] if to[e] == 1 + i) for i in range(n_p)]


def seeded_hash(seed: int, *cols: Column) -> Column:
    """36 seeded bits per document, equal in every run."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 64 - _BITS * _LEVELS)


def plan_mix(sized: DataFrame, pattern_col: str, size_col: str, hash_col: str, seed: int = SEED, weights=WEIGHTS,
             cap: int = CAP, targets: dict | None = None, max_repeats: int = CAP, max_patterns: int = MAX_PATTERNS):
    """Plan the mix of ``sized`` (pattern array, size, seeded hash per document).

    Returns ``(cuts, targets, sizes)``: cuts rows are (pattern, whole copies,
    hash cut: one more copy below it); targets and sizes are per source.
    ``targets`` overrides the weight shares.
    """
    rows = (sized.groupBy(pattern_col).agg(F.sum(size_col).alias("words")).limit(max_patterns + 1).collect())
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = [(tuple(r[0]), int(r[1] or 0)) for r in rows]
    sizes: dict = {}
    for members, words in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + words
    targets = source_targets(sizes, weights, cap) if targets is None else {s: Fraction(t) for s, t in targets.items()}
    flows = min_cost_flow(patterns, {s: int(round(targets.get(s, 0))) for s in sizes}, max_repeats)
    cuts = [{"pattern": list(m), "copies": f // w if w else 0, "left": f - f // w * w if w else 0, "cut": 0}
            for (m, w), f in zip(patterns, flows)]
    _refine(sized, cuts, pattern_col, size_col, hash_col)
    return cuts, targets, sizes


def _refine(sized: DataFrame, cuts: list[dict], pattern_col: str, size_col: str, hash_col: str) -> None:
    """Set each cut so that the words below it come nearest to ``left``."""
    spark = sized.sparkSession
    kind = sized.schema[pattern_col].dataType.simpleString()
    live = [c for c in cuts if c["left"]]
    for level in range(1, _LEVELS + 1):
        if not live:
            return
        shift = _BITS * (_LEVELS - level)
        heads = spark.createDataFrame([(i, c["pattern"], c["cut"] >> (shift + _BITS)) for i, c in enumerate(live)],
                                      f"__mix_i int, __mix_p {kind}, __mix_head long")
        joined = sized.join(F.broadcast(heads), F.col(pattern_col).eqNullSafe(F.col("__mix_p"))
                            & (F.shiftright(hash_col, shift + _BITS) == F.col("__mix_head")))
        sums: dict = {}
        found = joined.groupBy("__mix_i", F.shiftright(hash_col, shift).alias("b")).agg(F.sum(size_col).alias("w"))
        # the iterator runs a job per partition: no more of them than the rows need
        for r in found.repartition(-(-(len(live) << _BITS) // FETCH_ROWS)).toLocalIterator():
            sums.setdefault(r["__mix_i"], []).append((r["b"], r["w"]))
        inside = []
        for i, c in enumerate(live):
            for b, w in sorted(sums.get(i, [])):
                if w <= c["left"]:
                    c["left"] -= w
                    c["cut"] = (b + 1) << shift
                    continue
                # the cut lies in this bucket; at the last level the bucket goes whole to the nearer side
                c["cut"] = (b << shift) + ((1 << shift) if level == _LEVELS and w - c["left"] < c["left"] else 0)
                inside.append(c)
                break
        live = [c for c in inside if c["left"]]


def with_copies(df: DataFrame, cuts: list[dict], pattern_col: str, hash_col: str, copies_col: str = "copies") -> DataFrame:
    """Add the number of copies of each document (map side; cuts are at most one row per pattern)."""
    kind = df.schema[pattern_col].dataType.simpleString()
    table = df.sparkSession.createDataFrame([(c["pattern"], c["copies"], c["cut"]) for c in cuts],
                                            f"__mix_p {kind}, __mix_n long, __mix_cut long")
    return (df.join(F.broadcast(table), F.col(pattern_col).eqNullSafe(F.col("__mix_p")), "left")
            .withColumn(copies_col, F.coalesce("__mix_n", F.lit(0)) + F.when(F.col(hash_col) < F.col("__mix_cut"), 1).otherwise(0))
            .drop("__mix_p", "__mix_n", "__mix_cut"))


def mix_sources(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
                seed: int = SEED, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per document: id, size, its source's size and target, words taken.

    ``source_col`` holds a source or an array of sources; with an array,
    ``source_size`` and ``target`` are those of the first source.
    """
    array = docs.schema[source_col].dataType.typeName() == "array"
    members = F.array_sort(F.array_distinct(F.col(source_col))) if array else F.array(F.col(source_col))
    narrow = docs.select(F.col(id_col).alias("doc_id"), members.alias("p"), seeded_hash(seed, F.col(id_col), F.col(text_col)).alias("u"),
                         F.col(text_col).alias("t"))
    sized = pin(word_sizes(narrow, "t"))
    cuts, targets, sizes = plan_mix(sized, "p", "size", "u", seed, weights, cap)
    table = docs.sparkSession.createDataFrame([(s, sizes[s], float(targets[s])) for s in sizes],
                                              "s string, source_size long, target double")
    out = with_copies(sized, cuts, "p", "u")
    return (out.join(F.broadcast(table), F.try_element_at("p", F.lit(1)).eqNullSafe(F.col("s")), "left")
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"))


def mixed_documents(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id",
                    seed: int = SEED, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """The documents of the mix with their own columns, each as often as it is taken."""
    u, p = "__mix_hash", "__mix_pattern"
    keyed = docs.select("*", F.array(F.col(source_col)).alias(p), seeded_hash(seed, F.col(id_col), F.col(text_col)).alias(u))
    with pins():
        cuts, _, _ = plan_mix(pin(word_sizes(keyed.select(p, u, F.col(text_col).alias("t")), "t")), p, "size", u, seed, weights, cap)
    out = with_copies(keyed, cuts, p, u, "__mix_copies").filter("__mix_copies > 0")
    return out.withColumn("__mix_copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_copies")))).select(*columns(docs))
