"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios.

Features are hashed character 3- to 5-grams of the lower-cased text, as
presence per document.  Document counts per class over the labelled sample give
each n-gram its log-count ratio r; the n-grams that separate the classes best
become features with value r where present, and a logistic regression is
fitted on them.  Scoring walks every whole text once.

Training reads at most ``max_per_class`` labelled documents (clean, toxic),
those with the smallest seeded hash of their id; that bound is the only one.
A sampled row weighs its class's labels over its class's sampled labels, so the
fitted prior is that of all labels at every size.
Labels are learned from ids with crc32(id as text) mod 5 != 0 only.

Defined results: a null or empty text has no n-grams and gets the model's
intercept as its score; repeated label rows count as toxic if any says so, null
labels are ignored; without labels of both classes every score is 0; repeated
documents each keep their row; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import columns, hash_sample, pin, pins
from tidemark.llm.texts import mix64

SIZES = (3, 4, 5)
BITS = 20
FEATURES = 512
#: At most so many training documents labelled 0 and 1.
MAX_PER_CLASS = (9000, 3000)
CHUNK_CHARS = 1 << 19
SMOOTHING = 0.5
_SEAT = mix64(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)


def held_out(id_col: str):
    """True where crc32 of the id as text is divisible by 5 (null ids are held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _chunks(texts: list):
    """(first row, code points of the lower-cased texts each ended by 0, row ends)."""
    i = 0
    while i < len(texts):
        part, size, first = [], 0, i
        while i < len(texts) and (not part or size + len(texts[i] or "") <= CHUNK_CHARS):
            part.append((texts[i] or "").lower().replace("\x00", " "))
            size += len(part[-1])
            i += 1
        points = np.frombuffer(("\x00".join(part) + "\x00").encode("utf-32-le", "surrogatepass"), np.uint32)
        yield first, points, np.cumsum([len(p) + 1 for p in part])


def grams(points: np.ndarray):
    """Yield (position, bucket) arrays of the n-grams of each size; n-grams do not cross texts."""
    wide = points.astype(np.uint64)
    ends = np.flatnonzero(points == 0)
    for n in SIZES:
        m = len(points) - n + 1
        if m <= 0:
            continue
        h = np.full(m, np.uint64(n), np.uint64)
        for j in range(n):
            h += wide[j:j + m] * _SEAT[j]
        bucket = (mix64(h) >> np.uint64(64 - BITS)).astype(np.int32)
        ok = np.ones(m, bool)
        for j in range(n):
            cut = ends - j
            ok[cut[(cut >= 0) & (cut < m)]] = False
        yield ok, bucket


def present(texts: list, slot: np.ndarray):
    """Yield (row, sorted distinct slots) of each text; ``slot`` maps buckets to slots, -1 for none."""
    width = int(slot.max(initial=0)) + 1
    for first, points, ends in _chunks(texts):
        keys = []
        for ok, bucket in grams(points):
            s = slot[bucket]
            at = np.flatnonzero((s >= 0) & ok)
            keys.append(np.searchsorted(ends, at, "right").astype(np.int64) * width + s[at])
        keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        cut = np.searchsorted(keys, np.arange(len(ends) + 1) * width)
        for r in range(len(ends)):
            yield first + r, keys[cut[r]:cut[r + 1]] % width


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    max_per_class: tuple = MAX_PER_CLASS) -> DataFrame:
    """(label, text, weight) of at most ``max_per_class`` labelled documents (clean, toxic), none held out."""
    marked = pin(labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y"))
              .filter("k IS NOT NULL AND y IN (0, 1)").filter(~held_out("k")).groupBy("k").agg(F.max("y").alias("y")))
    # both parts are bounded by max_per_class, so the ids may be broadcast
    picked = [hash_sample(marked.filter(F.col("y") == y), max_per_class[y], 1, F.col("k")) for y in (0, 1)]
    ids = pin(picked[0].unionByName(picked[1]))
    every, taken = ({r["y"]: r["count"] for r in d.groupBy("y").count().collect()} for d in (marked, ids))
    weight = F.when(F.col("y") == 1, every.get(1, 0) / max(taken.get(1, 0), 1)).otherwise(every.get(0, 0) / max(taken.get(0, 0), 1))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(ids), F.col("id") == F.col("k")).select("y", "text", weight.alias("weight"))


def fit(sample: DataFrame, features: int = FEATURES, rounds: int = 300) -> dict | None:
    """Model ``{"slot": bucket -> feature or -1, "weight": per feature, "bias": float}``; None without both classes."""
    sample = pin(sample)
    classes = sample.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")).collect()
    sizes, weights = {r["y"]: r["n"] for r in classes}, {r["y"]: r["weight"] for r in classes}
    if not (sizes.get(0) and sizes.get(1)):
        return None
    every = np.arange(1 << BITS, dtype=np.int32)

    def count(batches):
        seen = np.zeros((2, 1 << BITS), np.int64)
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            for row, slots in present(b.column(1).to_pylist(), every):
                seen[y[row], slots] += 1
        at = np.flatnonzero(seen.any(0))
        for i in range(0, len(at), 50_000):
            part = at[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(seen[1, part]), pa.array(seen[0, part])],
                                             names=["bucket", "pos", "neg"])

    counts = sample.mapInArrow(count, "bucket int, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    p, q = F.col("pos") / sizes[1], F.col("neg") / sizes[0]
    both = (F.col("pos") * weights[1] + F.col("neg") * weights[0]) / (sizes[0] * weights[0] + sizes[1] * weights[1])
    best = (counts.filter(F.col("pos") + F.col("neg") >= 5).withColumn("gain", F.abs(p - q) / F.sqrt(both * (1 - both) + 1e-4))
            .orderBy(F.desc("gain"), "bucket").limit(features).collect())
    pos, neg = (np.array([r[c] for r in best], float) for c in ("pos", "neg"))
    ratio = np.log((pos + SMOOTHING) / (sizes[1] + 2 * SMOOTHING)) - np.log((neg + SMOOTHING) / (sizes[0] + 2 * SMOOTHING))
    slot = np.full(1 << BITS, -1, np.int32)
    slot[[r["bucket"] for r in best]] = np.arange(len(best))

    def extract(batches):
        for b in batches:
            rows = [s.astype(np.int32) for _, s in present(b.column(1).to_pylist(), slot)]
            off = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(rows)))], names=["y", "slots"])

    x, y = [], []
    for r in sample.mapInArrow(extract, "y int, slots array<int>").collect():       # at most sum(max_per_class) rows
        row = np.zeros(len(best), np.float32)
        row[r["slots"]] = ratio[r["slots"]]
        x.append(row), y.append(r["y"])
    order = np.lexsort((np.array([v.sum() for v in x]), np.array(y)))
    x, y = np.stack(x)[order], np.array(y, np.float32)[order]
    weight, bias = _logistic(x, y, np.where(y == 1, weights[1], weights[0]), rounds)
    return {"slot": slot, "weight": (weight * ratio).astype(np.float64), "bias": bias}


def _logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, rounds: int, l2: float = 1e-4, rate: float = 0.05):
    """Logistic regression by Adam on the full sample; rows weigh as in all labels, so a rejection needs real evidence."""
    each = (weights / weights.sum()).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    for t in range(1, rounds + 1):
        e = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) * each
        g = np.append(x.T @ e + l2 * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], float(b - step[-1])
    return w, b


def score_column(df: DataFrame, text_col: str, model: dict | None, score_col: str = "score") -> DataFrame:
    """``df`` plus the score of every whole text (0 to 1, 6 decimals)."""
    keep = [c for c in df.columns if c != score_col]
    at = keep.index(text_col)
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])

    def score(batches):
        for b in batches:
            out = np.zeros(len(b))
            if model is not None:
                for row, slots in present(b.column(at).to_pylist(), model["slot"]):
                    out[row] = 1 / (1 + np.exp(-np.clip(model["bias"] + model["weight"][slots].sum(), -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.round(out, 6))], names=[*b.schema.names, "s"])

    return rows.mapInArrow(score, StructType([*rows.schema.fields, StructField("s", DoubleType())])).toDF(*keep, score_col)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                    max_per_class: tuple = MAX_PER_CLASS) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for every document."""
    with pins():
        model = fit(training_sample(docs, labels, id_col, text_col, label_col, max_per_class))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (score_column(rows, "text", model)
            .select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    with pins():
        model = fit(training_sample(docs, labels, id_col, text_col, label_col))
    return score_column(docs, text_col, model, "__toxicity").filter("__toxicity < 0.5").select(*columns(docs))
