"""Periodic runs of words by an online sparse diagonal recurrence.

A run is a stretch of consecutive words with smallest period q, at least
``min_periods`` periods and ``min_words`` words long, that cannot be extended.
Word i matches an earlier occurrence of itself on the diagonal of lag q = i - j;
going over the words in order, each such occurrence raises its lag's match
length, and a lag that is not raised at a word has ended there: if its length
suffices the run is emitted at once.

All earlier occurrences of a common word would make that quadratic, so an
occurrence is followed only if it can belong to a run: a run of period q in
[K/2, K), K a power of two, is longer than K + q words, and within it the
nearest earlier occurrence of every stretch of K words lies exactly q back (one
nearer by would give the period a divisor, and q were not the smallest).  So
each word follows, for each K, at most the one occurrence that ends the nearest
earlier copy of the K words ending at it, and only when its lag is in [K/2, K).
This loses no run, admits no multiple of a smaller period, and keeps the work
at n log n for any text (the nearest copies come from doubling the stretches,
keeping only repeated ones; ordinary prose has next to none after K = 4).

A text is the unit of work: documents are spread over the tasks and nothing is
shuffled.  Null and empty texts have no words and no runs; repeated documents
and ids give equal rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

MIN_WORDS, MIN_PERIODS = 6, 4
#: Words whose stretches are looked up together.
GROUP_WORDS = 1 << 19
SPACE = "\\x20\\x09-\\x0D"

Run = tuple[int, int, int]


def followed(w: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(K, last word, lag) of the occurrences that can belong to runs, for K = 2, 4, ... while K / 2 periods fit ``longest`` words.

    ``w`` holds word numbers that no two documents share.
    """
    at, K = np.arange(len(w)), 1
    ids = w
    while K <= longest:
        # stretches of 2 K words: two repeated stretches side by side
        pair = np.flatnonzero((ids[:-K] >= 0) & (ids[K:] >= 0)) if len(w) > K else at[:0]
        key = ids[pair] * (ids.max(initial=0) + 1) + ids[pair + K]
        order = np.argsort(key, kind="stable")
        key, pair = key[order], pair[order]
        same = key[1:] == key[:-1]
        lag = np.diff(pair)
        K *= 2
        hit = same & (lag >= K // 2) & (lag < K)
        yield K, pair[1:][hit] + K - 1, lag[hit]
        if not same.any():
            return
        repeated = np.r_[same, False] | np.r_[False, same]
        ids = np.full(len(w), -1, np.int64)
        ids[pair[repeated]] = np.cumsum(np.r_[True, ~same])[repeated]


def diagonal_runs(events: Iterator[tuple[int, int, int]], min_words: int, min_periods: int) -> Iterator[Run]:
    """(start, length, period) of the runs among ``events`` (word, lag, K) in order of words."""
    active: dict[int, int] = {}                                  # lag -> match length up to the last word
    raised: dict[int, int] = {}
    word = -1

    def ended(last: int, gone) -> Iterator[Run]:
        for q, m in gone:
            if m + q >= max(min_words, min_periods * q):
                yield last - m - q + 1, m + q, q

    for i, q, k in events:
        if i != word:
            yield from ended(word - 1, ((x, m) for x, m in active.items() if x not in raised))
            active, raised = raised, {}
            if i != word + 1:
                yield from ended(word, active.items())
                active = {}
            word = i
        raised[q] = active[q] + 1 if q in active else k
    yield from ended(word - 1, ((x, m) for x, m in active.items() if x not in raised))
    yield from ended(word, raised.items())


def text_runs(texts: list[list[bytes]], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[list[Run]]:
    """The runs of each text, by start, then period."""
    number = count()
    ids, starts = [], [0]
    for words in texts:
        own: dict[bytes, int] = defaultdict(number.__next__)
        ids.append(np.fromiter(map(own.__getitem__, words), np.int64, len(words)))
        starts.append(starts[-1] + len(words))
    w = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    longest = max(map(len, texts), default=0)
    found = [(np.full(len(last), K), last, lag) for K, last, lag in followed(w, 2 * longest // max(min_periods, 2))]
    K, last, lag = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((lag, last))
    out: list[list[Run]] = [[] for _ in texts]
    begin = np.asarray(starts)
    for start, length, q in diagonal_runs(zip(last[order].tolist(), lag[order].tolist(), K[order].tolist()), min_words, min_periods):
        doc = int(np.searchsorted(begin, start, "right")) - 1
        out[doc].append((start - starts[doc], length, q))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that repeat a run's first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, q in runs:
        keep[start + q:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(documents: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period) and the collapsed text of every document."""
    if min_periods < 4:
        raise ValueError("runs of fewer than four periods are not followed")
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            begin, words, total = 0, [], 0
            for i in range(len(ids)):
                words.append((texts[i].as_py() or b"").split())    # splits at \\x20 and \\x09-\\x0D
                total += len(words[-1])
                if total > GROUP_WORDS or i == len(ids) - 1:
                    runs = text_runs(words, min_words, min_periods)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(begin, len(words)), pa.array(map(len, words), pa.int64()),
                         pa.array([[{"start": s, "length": n, "period": q} for s, n, q in x] for x in runs], RUNS),
                         pa.array([collapsed(*x) for x in zip(words, runs)], pa.binary())], names=["doc_id", "n_words", "runs", "collapsed"])
                    begin, words, total = i + 1, [], 0

    schema = f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    rows = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def loop_tails(documents: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by crc32 of its id) repeats its words from one on in a loop."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(F.col("text").cast("string"), f"[{SPACE}]+"), lambda x: x != "")
    rows = documents.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.size("words").cast("long")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    looped = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("words", place(i).cast("int"))), " ")
    return rows.select("doc_id", F.when(n > 0, looped).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """The rows of ``periodic_runs`` as counts, the run of greatest exponent and digests."""
    def before(x: Column, y: Column) -> Column:
        # greatest length / period first, compared as products; then smallest start, then period
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(a != b, F.when(a > b, -1).otherwise(1)).when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))

    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = F.get(F.array_sort("runs", before), F.lit(0))
    rows = found.withColumn("top", top)
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"top.{x}").alias(x) for x in ("start", "length", "period")),
                       F.expr("top.length * 1000 div top.period").cast("long").alias("exponent_milli"),
                       F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def oracle() -> str:
    """DuckDB SQL: equal stretches of five words paired, unbroken diagonals kept, multiples of smaller periods dropped."""
    from tidemark.llm.repair import CRC_TABLE, crc32_sql
    return f"""
with {CRC_TABLE},
hashed as (select row_number() over () d, doc_id, {crc32_sql("doc_id::varchar")} h,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') ws from documents, crc),
cut as (select *, len(ws) n, h // 10 g, case when h % 10 = 0 and len(ws) > 0 then (h // 10) % len(ws) else len(ws) end a from hashed),
docs as (select *, 1 + (n - a) // (3 + g % 8) p from cut),
w as (select d, n, i, ws[1 + case when i < a then i else a + (i - a) % p end] word from (select *, unnest(range(n)) i from docs)),
grams as (select d, n, i, hash(word, lag(word, 1) over o, lag(word, 2) over o, lag(word, 3) over o, lag(word, 4) over o) gram
  from w window o as (partition by d order by i)),
pairs as (select y.d, y.i, y.i - x.i q from grams x join grams y on x.d = y.d and x.gram = y.gram and y.i > x.i and 4 * (y.i - x.i) <= x.n
  where x.i >= 4),
diagonals as (select d, q, min(i) - 4 - q s, count(*) + 4 + q len from (select *, i - row_number() over (partition by d, q order by i) island from pairs) group by d, q, island),
stretches as (select * from diagonals where len >= greatest(6, 4 * q)),
runs as (select * from stretches r where not exists (
  select 1 from stretches z where z.d = r.d and z.q < r.q and r.q % z.q = 0 and z.s <= r.s and z.s + z.len >= r.s + r.len)),
top as (select d, s, len, q from (
  select *, row_number() over (partition by d order by len::double / q desc, s, q) k from runs) where k = 1),
told as (select d, count(*) n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) told from runs group by d),
kept as (select d, string_agg(word, ' ' order by i) kept from w
  where not exists (select 1 from runs r where r.d = w.d and w.i >= r.s + r.q and w.i < r.s + r.len) group by d)
select doc_id, coalesce(n_runs, 0)::bigint n_runs, s::bigint as start, len::bigint length, q::bigint as period, (len * 1000 // q)::bigint exponent_milli,
  sha256(coalesce(told, '')) runs_sha256, sha256(coalesce(kept, '')) collapsed_sha256
from docs left join top using (d) left join told using (d) left join kept using (d)"""
