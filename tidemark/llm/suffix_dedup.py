"""Suffix-array dedup: removal of every byte covered by a long repeated string.

A byte goes if some ``length``-byte string over it also starts anywhere else, in
the same document or another; strings are judged on the input.

Sorting a suffix for every byte would move hundreds of bytes per byte of text,
so suffixes are first thinned without losing a match.  Every ``length``-byte
window picks the smallest-hashed ``gram``-byte gram inside it (winnowing); equal
windows pick the same gram at the same offset.  Consecutive windows with one
pick form a family, about one per 170 bytes.

1. Families whose gram occurs once are dropped.  Tasks send each gram once per
   block with its local count, so a common gram is no hot key.
2. The others' suffixes are range-partitioned on their leading gram with sampled
   splitters.  A range comes in gram order (Spark's sort, which spills) and is cut
   between grams into blocks of about a megabyte; a block's suffixes are sorted by
   multikey quicksort and its windows decided by what neighbours have in common,
   byte by byte (``multikey``).  No gram lies on both sides of a splitter.
3. Families of grams with more than ``hot_members`` occurrences would fill a range
   alone, so they are compared across ranges: their windows are combined per block
   and counted by window hash.

Exact copies of whole texts are recognised first and one of them stands for all.

Texts of any length are thinned in pieces of 4 MiB.  Grams, and the windows of
common grams, are compared by 64-bit hashes.  Defined results: a null text is empty;
texts shorter than ``length`` lose nothing; offsets are UTF-8 bytes; repeated
rows are copies of each other and lose everything from ``length`` bytes on; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import pin, pins, shuffle_partitions
from tidemark.llm.multikey import repeated_windows
from tidemark.llm.texts import packed_texts, prefix_hash, span_hash, string_chunks, unpack

LENGTH = 400
GRAM = 64
HOT_MEMBERS = 100
BLOCK_FAMILIES = 1 << 18
BLOCK_WINDOWS = 1 << 20
BLOCK_BYTES = 1 << 20
PIECE_BYTES = 1 << 22
_POS_BITS = np.uint64(28)
_POS = np.uint64((1 << 28) - 1)


def families(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Families of the rows of a chunk: (row, first window, windows, gram position, gram hash);
    positions are relative to the chunk.  A row longer than a piece has a chunk to
    itself and is taken piece by piece; a family across two pieces comes as two."""
    n, width = len(data), length - gram + 1
    if n > 2 * PIECE_BYTES and len(off) == 2:
        pieces = []
        for at in range(0, n - length + 1, PIECE_BYTES):
            end = min(n, at + PIECE_BYTES + length - 1)
            row, first, windows, pick, h = families(data[at:end], np.array([0, end - at]), length, gram)
            pieces.append((row, first + at, windows, pick + at, h))
        return tuple(np.concatenate([p[i] for p in pieces]) for i in range(5))
    sizes = np.maximum(0, np.diff(off) - length + 1)
    empty = np.zeros(0, np.int64)
    if not sizes.any():
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    starts = np.arange(n - gram + 1)
    hashes = span_hash(prefix_hash(data), starts, starts + gram)
    low = (hashes >> _POS_BITS << _POS_BITS) | starts.astype(np.uint64)
    w = 1
    while 2 * w <= width:
        low = np.minimum(low[:-w], low[w:])
        w *= 2
    low = np.minimum(low[:len(low) - (width - w)], low[width - w:]) if width > w else low
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(off[:-1], sizes)
    pick = (low[at] & _POS).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (pick[1:] != pick[:-1]) | (row[1:] != row[:-1])]))
    return row[new], at[new], np.diff(np.append(new, len(at))), pick[new], hashes[pick[new]]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))


_BLOB = "bucket int, block long, keys binary, vals binary"
_NAMES = ["bucket", "block", "keys", "vals"]


def _blob(bucket, block, keys, vals):
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(block, pa.int64()), pa.array(keys, pa.binary()),
                                       pa.array(vals, pa.binary())], names=_NAMES)


def _by_bucket(keys: np.ndarray, vals: np.ndarray, block: int, buckets: int):
    which = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(which, kind="stable")
    cut = np.searchsorted(which[order], np.arange(buckets + 1))
    full = [i for i in range(buckets) if cut[i] < cut[i + 1]]
    keys, vals = keys[order], vals[order]
    return _blob(full, [block] * len(full), [keys[cut[i]:cut[i + 1]].tobytes() for i in full], [vals[cut[i]:cut[i + 1]].tobytes() for i in full])


def shared_families(rows: DataFrame, buckets: int, length: int, gram: int, hot_members: int) -> DataFrame:
    """(key, fams) per document with families whose gram occurs elsewhere: uint32
    quadruples (first window, windows, gram offset in the family, hot)."""

    def emit(batches):
        part, seq = TaskContext.get().partitionId(), 0
        found, keys, count = [], [], 0

        def flush():
            nonlocal seq, count
            block = (part << 24) + seq
            seq += 1
            doc, first, windows, offset = (np.concatenate([f[i] for f in found]).astype(np.uint32) for i in range(4))
            grams, which, n = np.unique(np.concatenate([f[4] for f in found]), return_inverse=True, return_counts=True)
            yield _by_bucket(grams, np.stack([np.arange(len(grams)), n], 1).astype("<u4"), block, buckets)
            table = np.stack([doc, first, windows, offset, which.astype(np.uint32)], 1).astype("<u4")
            head = np.array([len(table), len(keys)], "<i8").tobytes()
            yield _blob([block % buckets], [block], [None], [head + table.tobytes() + np.array(keys, "<i8").tobytes()])
            found.clear(), keys.clear()
            count = 0

        for b in batches:
            all_keys = b.column(0).to_numpy()
            for lo, data, off in string_chunks(b.column(1)):
                doc, first, windows, pick, h = families(data, off, length, gram)
                if not len(doc):
                    continue
                used, local = np.unique(doc, return_inverse=True)
                found.append((local + len(keys), first - off[doc], windows, pick - first, h))
                keys.extend(all_keys[lo + used].tolist())
                count += len(doc)
                if count >= BLOCK_FAMILIES:
                    yield from flush()
        if count:
            yield from flush()

    def tally(table: pa.Table) -> pa.Table:
        block, keys, vals = table.column("block").to_pylist(), table.column("keys").to_pylist(), table.column("vals").to_pylist()
        out = [(block[i], None, vals[i]) for i in range(len(block)) if keys[i] is None]
        at = [i for i in range(len(block)) if keys[i] is not None]
        if at:
            grams = np.frombuffer(b"".join(keys[i] for i in at), np.uint64)
            entry = np.frombuffer(b"".join(vals[i] for i in at), "<u4").reshape(-1, 2)
            cut = np.cumsum([0, *(len(keys[i]) // 8 for i in at)])
            _, which = np.unique(grams, return_inverse=True)
            total = np.bincount(which, weights=entry[:, 1])[which]
            for j, i in enumerate(at):
                mine = slice(cut[j], cut[j + 1])
                shared = total[mine] > 1
                if shared.any():
                    out.append((block[i], entry[mine][shared, 0].astype("<u4").tobytes(), np.minimum(total[mine][shared], 2e9).astype("<u4").tobytes()))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()), "keys": pa.array([o[1] for o in out], pa.binary()),
                         "vals": pa.array([o[2] for o in out], pa.binary())})

    def decide(table: pa.Table) -> pa.Table:
        keys, vals = table.column("keys").to_pylist(), table.column("vals").to_pylist()
        raw = next(v for k, v in zip(keys, vals) if k is None)
        n, docs = np.frombuffer(raw[:16], "<i8")
        fams = np.frombuffer(raw[16:16 + 20 * n], "<u4").reshape(-1, 5)
        doc_keys = np.frombuffer(raw[16 + 20 * n:], "<i8")
        members = np.zeros(int(fams[:, 4].max()) + 1, np.int64)
        for k, v in zip(keys, vals):
            if k is not None:
                members[np.frombuffer(k, "<u4")] = np.frombuffer(v, "<u4")
        m = members[fams[:, 4]]
        kept, hot = fams[m > 1], (m[m > 1] > hot_members).astype("<u4")
        rows = np.concatenate([kept[:, 1:4], hot[:, None]], 1).astype("<u4")
        cut = np.searchsorted(kept[:, 0], np.arange(docs + 1))
        has = [i for i in range(docs) if cut[i] < cut[i + 1]]
        return pa.table({"key": pa.array(doc_keys[has], pa.int64()), "fams": pa.array([rows[cut[i]:cut[i + 1]].tobytes() for i in has], pa.binary())})

    tallied = rows.mapInArrow(emit, _BLOB).groupBy("bucket").applyInArrow(tally, "block long, keys binary, vals binary")
    return tallied.groupBy("block").applyInArrow(decide, "key long, fams binary")


def _spans(key: np.ndarray, p: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge repeated windows (sorted by key, p) into (key, start, end) byte spans."""
    if not len(p):
        return key, p, p
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (p[1:] > p[:-1] + 1)]))
    last = np.append(new[1:], len(p)) - 1
    return key[new], p[new], p[last] + length


def _merged(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans in order, those of one key that touch made one."""
    if not len(key):
        return key, start, end
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], end[order]
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    lift = np.cumsum(new_key) * (np.int64(end.max()) + 1)          # so that no reach crosses into the next key
    reach = np.maximum.accumulate(end + lift) - lift
    new = np.flatnonzero(new_key | np.concatenate([[True], start[1:] > reach[:-1]]))
    return key[new], start[new], reach[np.append(new[1:], len(key)) - 1]


def _span_batch(key, start, end):
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["key", "p0", "p1"])


_SPANS = "key long, p0 long, p1 long"


def _ordinary(texts: DataFrame, n: int, length: int, gram: int) -> DataFrame:
    """Spans from the ordinary families: sorted suffixes, neighbours with equal grams compared."""

    def suffixes(batches):
        seen = set()
        for b in batches:
            offsets, key, first, context = [], [], [], []
            for k, fams, size, data in zip(*[c.to_pylist() for c in b.columns]):
                if k in seen:
                    continue
                seen.add(k)
                raw = unpack(size, data)
                for p, w, offset, hot in np.frombuffer(fams, "<u4").reshape(-1, 4).tolist():
                    if not hot:
                        offsets.append(offset), key.append(k), first.append(p)
                        context.append(raw[p:p + w + length - 1])
            yield pa.RecordBatch.from_arrays([pa.array(offsets, pa.int32()), pa.array(key, pa.int64()), pa.array(first, pa.int64()),
                                              pa.array(context, pa.binary())], names=["offset", "key", "first", "context"])

    def lead(row) -> bytes:
        return row[3][row[0]:row[0] + gram]

    def compare(batches):
        held, size = [], 0

        def spans(rows):
            offset, key, first = (np.array([r[i] for r in rows], np.int64) for i in range(3))
            sizes = np.array([len(r[3]) for r in rows])
            anchor = np.cumsum(sizes) - sizes + offset
            data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
            row, far, near = repeated_windows(data, anchor, offset, sizes - offset, length, gram)
            at = first[row] + offset[row]
            return _span_batch(*_merged(key[row], at - far, at - near + length))

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if held and size >= BLOCK_BYTES and lead(row) != lead(held[-1]):
                    yield spans(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield spans(held)

    # the whole gram lies inside the context, so it need not travel beside it
    order = F.substring("context", F.col("offset") + 1, F.lit(gram))
    return (texts.mapInArrow(suffixes, "offset int, key long, first long, context binary")
            .repartitionByRange(n, order).sortWithinPartitions(order).mapInArrow(compare, _SPANS))


def _hot(texts: DataFrame, buckets: int, length: int) -> DataFrame:
    """Spans from the families of very common grams: windows counted by hash, each at most once per block."""

    def emit(batches):
        hs, keys, ps, size, seen = [], [], [], 0, set()

        def flush():
            nonlocal size
            h, key, p = np.concatenate(hs), np.concatenate(keys), np.concatenate(ps)
            _, first, which, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            local = n[which] > 1
            order = np.lexsort((p[local], key[local]))
            spans = np.stack(_spans(key[local][order], p[local][order], length), 1).astype("<i8")
            yield _by_bucket(h[first], np.stack([key[first], np.where(n > 1, -1, p[first])], 1).astype("<i8"), 0, buckets)
            if len(spans):
                yield _blob([int(h[0] % np.uint64(buckets))], [1], [None], [spans.tobytes()])
            hs.clear(), keys.clear(), ps.clear()
            size = 0

        for b in batches:
            for k, fams, length_, data in zip(*[c.to_pylist() for c in b.columns]):
                f = np.frombuffer(fams, "<u4").reshape(-1, 4).astype(np.int64)
                f = f[f[:, 3] > 0]
                if not len(f) or k in seen:
                    continue
                seen.add(k)
                p = np.repeat(f[:, 0] - (np.cumsum(f[:, 1]) - f[:, 1]), f[:, 1]) + np.arange(f[:, 1].sum())
                hs.append(span_hash(prefix_hash(np.frombuffer(unpack(length_, data), np.uint8)), p, p + length))
                keys.append(np.full(len(p), k)), ps.append(p)
                size += len(p)
                if size >= BLOCK_WINDOWS:
                    yield from flush()
        if hs:
            yield from flush()

    def meet(table: pa.Table) -> pa.Table:
        keys, vals = table.column("keys").to_pylist(), table.column("vals").to_pylist()
        done = [np.frombuffer(v, "<i8").reshape(-1, 3) for k, v in zip(keys, vals) if k is None]
        h = np.frombuffer(b"".join(k for k in keys if k is not None), np.uint64)
        entry = np.frombuffer(b"".join(v for k, v in zip(keys, vals) if k is not None), "<i8").reshape(-1, 2)
        _, which, n = np.unique(h, return_inverse=True, return_counts=True)
        e = entry[(n[which] > 1) & (entry[:, 1] >= 0)] if len(h) else entry
        e = e[np.lexsort((e[:, 1], e[:, 0]))]
        done.append(np.stack(_spans(e[:, 0], e[:, 1], length), 1))
        out = np.concatenate(done)
        return pa.table({"key": out[:, 0], "p0": out[:, 1], "p1": out[:, 2]})

    return texts.mapInArrow(emit, _BLOB).groupBy("bucket").applyInArrow(meet, _SPANS)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   hot_members: int = HOT_MEMBERS) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, spans, kept): spans are the maximal removed
    byte runs as (start, end), kept the remaining bytes."""
    n = shuffle_partitions(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    # one row per (id, text), then classes of equal texts; repeated rows are counted on the way
    with pins() as own:
        every = pin(keyed.groupBy("key", F.md5("text").alias("md5"), F.octet_length("text").alias("size")).agg(F.count(F.lit(1)).alias("rows")))
        classes = pin(every.filter(F.col("size") >= length).groupBy("md5").agg(F.sum("rows").alias("n"), F.min("key").alias("rep")))
        copied = every.join(classes.filter("n > 1").select(F.col("md5").alias("m2")), F.col("md5") == F.col("m2")).select("key")
        wanted = shared_families(keyed.select("key", "text"), n, length, gram, hot_members).groupBy("key").agg(F.first("fams").alias("fams"))
        wanted = wanted.join(classes.select(F.col("rep").alias("key")), "key", "left_semi")
        packed = packed_texts(keyed)
        texts = packed.withColumnRenamed("key", "k2").join(pin(wanted), F.col("k2") == F.col("key")).select("key", "fams", "size", "packed")
        spans = pin(_ordinary(texts, n, length, gram).unionByName(_hot(texts, n, length)))
        spans = spans.unionByName(copied.select("key", F.lit(0).cast("long").alias("p0"), F.lit(1 << 40).alias("p1")))
        per_key = own.keep(pin(spans.groupBy("key").agg(F.collect_list(F.struct("p0", "p1")).alias("found")).withColumnRenamed("key", "k2")))
    joined = packed.join(per_key, F.col("key") == F.col("k2"), "left").select("doc_id", "size", "packed", "found")

    def cut(batches):
        for b in batches:
            sizes, removed, runs, kept = [], [], [], []
            for size, data, found in zip(*[c.to_pylist() for c in b.columns[1:]]):
                raw = unpack(size, data)
                merged = []
                for s in sorted((f["p0"], min(f["p1"], len(raw))) for f in found or []):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                sizes.append(len(raw)), removed.append(sum(e - a for a, e in merged))
                runs.append([{"start": a, "end": e} for a, e in merged])
                at = [0, *(x for m in merged for x in m), len(raw)]
                kept.append(b"".join(raw[a:e] for a, e in zip(at[::2], at[1::2])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, span),
                                              pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    added = StructType.fromDDL("n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")
    schema = StructType(joined.select("doc_id").schema.fields + added.fields)
    return joined.mapInArrow(cut, schema)


def oracle(length: int = LENGTH) -> str:
    """DuckDB SQL of the query over the table documents: every window of ``length`` bytes, as hex."""
    return f"""
with b as (select row_number() over () d, doc_id, hex(encode(coalesce(text, ''))) x from documents),
n as (select d, doc_id, x, (length(x) // 2)::bigint n from b),
w as (select d, i, hash(substr(x, 2 * i + 1, {2 * length})) h from (select d, x, unnest(range(greatest(n - {length - 1}, 0))) i from n)),
r as (select d, i from (select d, i, count(*) over (partition by h) c from w) where c > 1),
g as (select d, i, case when i <= lag(i) over (partition by d order by i) + {length} then 0 else 1 end is_new from r),
s as (select d, min(i) a, max(i) + {length} z from (select d, i, sum(is_new) over (partition by d order by i rows unbounded preceding) k from g) group by d, k),
kept as (select d, sum(z - a)::bigint removed, count(*) spans,
    string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' order by a) || substr(max(x), 2 * max(z) + 1) x
  from (select s.d, a, z, x, coalesce(lag(z) over (partition by s.d order by a), 0) before from s join n using (d)) group by d)
select doc_id, n n_bytes, coalesce(removed, 0) n_removed, coalesce(spans, 0) n_spans, sha256(unhex(coalesce(kept.x, n.x))) kept_sha256
from n left join kept using (d)"""


def plain_reference(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) by a table of all windows, for tests."""
    raws = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for r in raws:
        for i in range(len(r) - length + 1):
            seen[r[i:i + length]] = seen.get(r[i:i + length], 0) + 1
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return out
