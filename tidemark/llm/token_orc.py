"""Token ids as ORC files: integer run-length encoded stripes with row indexes
and Bloom filters on the document ids.

``write_token_orc`` range-partitions the documents on their id (sampled
splitters), sorts inside each partition, encodes the whole texts there and
writes one ORC file per partition, so a stripe holds a contiguous id range.
ORC's integer columns are run-length encoded (RLEv2), which leaves a general
compressor little to gain, so none is used; the row index keeps
min/max per ``row_index_stride`` rows and the Bloom filter decides equality
look-ups, so readers prune stripes and row groups by metadata.  Spark reads
the stripes of one file in parallel.

``part`` and ``seq`` store the place of each document (file and rank inside
it); ``start`` comes from one token count per part plus a running sum inside
it, so no global window is needed.

Defined results: a null or empty text is just the end id; a null doc_id sorts
first; rows with equal ids are ordered by their text; an empty table gives an
empty set of files and no rows.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import drop_path, pin, scratch_path, shuffle_partitions
from tidemark.llm.texts import prefix_hash, span_hash, string_chunks, word_bounds

END_ID = 2
MAX_CACHE = 400_000
CHUNK_BYTES = 3 << 19
_SCHEMA = "doc_id long, part int, seq long, n_tokens int, ids array<int>"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# byte classes of the piece splitter: 0 not told apart here, 1 letter, 2 punctuation, 3 white space
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[list(b".,!?%&*#$;:()-/")] = 2
_CLASS[[32, 9, 10, 11, 12, 13]] = 3


class PieceEncoder:
    """Encodes texts piecewise.

    This vocabulary lower-cases, drops white space, never merges across it, and
    cuts a word at every change between letters and punctuation.  So the ids of
    a text are the ids of its pieces: runs of letters (ASCII and Latin-1,
    lower-cased) or of common punctuation, and whole words where anything else
    occurs (digits, apostrophes, other scripts, special tokens).  The pieces of
    a chunk are told apart by vectorised 64-bit hashes; each distinct one is
    looked up once in a bounded cache, and new ones are encoded together in one
    string and cut apart at the tokens that end a word.
    """

    def __init__(self, path: str, max_cache: int = MAX_CACHE):
        from tokenizers import Tokenizer
        self.tokenizer, self.known, self.max_cache = Tokenizer.from_file(path), {}, max_cache
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _learn(self, runs: list[bytes], odd: list[bytes]) -> None:
        if runs:
            ids = np.asarray(self.tokenizer.encode_batch_fast([b" ".join(runs).decode()], add_special_tokens=False)[0].ids, "<i4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(runs) and cut[-1] == len(ids):
                raw, a = ids.tobytes(), 0
                for run, b in zip(runs, (cut * 4).tolist()):
                    self.known[run] = raw[a:b]
                    a = b
            else:                                   # a vocabulary without word ends
                odd = odd + runs
        for piece, e in zip(odd, self.tokenizer.encode_batch_fast([p.decode() for p in odd], add_special_tokens=False)):
            self.known[piece] = np.asarray(e.ids, "<i4").tobytes()

    @staticmethod
    def pieces(data: np.ndarray, off: np.ndarray):
        """(bytes with lower-cased runs, starts, ends, whether a run, first piece per row)."""
        a, b, _ = word_bounds(data, off)
        kind = _CLASS[data]
        low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        lead = np.flatnonzero(data[:-1] == 0xC3)     # Latin-1 letters are C3 80 to C3 BF but for two signs
        lead = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = 1
        upper = lead[data[lead + 1] <= 0x9E] + 1
        low[upper] = data[upper] + np.uint8(32)
        other = np.concatenate([[0], np.cumsum(kind == 0)])
        whole = other[b] > other[a]                  # words with bytes not told apart stay whole and as they are
        mixed = np.zeros(len(data), bool)
        mixed[kind != 3] = np.repeat(whole, b - a)
        low = np.where(mixed, data, low)
        start = np.zeros(len(data) + 1, bool)
        start[1:-1] = (kind[1:] != kind[:-1]) & (kind[1:] != 3) & ~mixed[1:]
        start[a] = True
        stop = start[1:] & (kind != 3)
        stop[b - 1] = True
        s = np.flatnonzero(start)
        return low, s, np.flatnonzero(stop) + 1, ~mixed[s], np.searchsorted(s, off)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, ids per row) of UTF-8 rows ``data[off[i]:off[i + 1]]``."""
        if not len(data):
            return np.zeros(0, "<i4"), np.zeros(len(off) - 1, np.int64)
        low, a, b, run, first = self.pieces(data, off)
        _, at, which = np.unique(span_hash(prefix_hash(low), a, b), return_index=True, return_inverse=True)
        text, known = low.tobytes(), self.known
        if len(known) > self.max_cache:
            known.clear()
        found = [text[i:j] for i, j in zip(a[at].tolist(), b[at].tolist())]
        new = [i for i, p in enumerate(found) if p not in known]
        if new:
            is_run = run[at]
            self._learn([found[i] for i in new if is_run[i]], [found[i] for i in new if not is_run[i]])
        ids = [known[p] for p in found]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<i4")
        start = np.cumsum(size) - size
        lengths = size[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return flat[np.repeat(start[which] - ends[:-1], lengths) + np.arange(ends[-1])], np.diff(ends[first])

    def __call__(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.encode(raw, np.array([0, len(raw)]))[0]


_encoders: dict[str, PieceEncoder] = {}


def encoder_for(path: str) -> PieceEncoder:
    """One encoder per worker process, so its cache serves all tasks there."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def write_token_orc(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                    partitions: int | None = None, row_index_stride: int = 1000, stripe_bytes: int = 16 << 20) -> None:
    """Write the token ids of every document, in ascending id order, below ``path``."""
    tokenizer = tokenizer or default_tokenizer()
    n = partitions or shuffle_partitions(docs.sparkSession)
    placed = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
              .withColumn("tie", F.xxhash64("text"))
              .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "tie")
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
              .select("doc_id", "text", F.spark_partition_id().alias("part")))

    def encode(batches):
        encoder, seq = encoder_for(tokenizer), 0
        for b in batches:
            for lo, data, off in string_chunks(b.column(1), CHUNK_BYTES):
                ids, lengths = encoder.encode(data, off)
                n, ends = len(lengths), np.cumsum(lengths)
                ids = np.insert(ids, ends, END_ID)
                stops = np.concatenate([[0], ends + np.arange(1, n + 1)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:lo + n], b.column(2)[lo:lo + n], pa.array(np.arange(seq, seq + n)), pa.array((lengths + 1).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(stops), pa.array(ids.astype(np.int32)))],
                    names=["doc_id", "part", "seq", "n_tokens", "ids"])
                seq += n

    (placed.mapInArrow(encode, _SCHEMA).write.mode("overwrite")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", str(row_index_stride)).option("orc.stripe.size", str(stripe_bytes))
     .option("compression", "none").orc(path))


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).orc(path)


def document_digests(tokens: DataFrame) -> DataFrame:
    """Per document: doc_id, start, n_tokens and the crc32 of its ids as
    little-endian unsigned 32-bit integers, computed from the stored ids."""

    def digest(batches):
        for b in batches:
            ids = b.column(3)
            off = ids.offsets.to_numpy()
            data = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(data[a:z].tobytes()) for a, z in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(np.diff(off).astype(np.int64)),
                                              pa.array(crc, pa.int64())], names=["doc_id", "part", "seq", "n_tokens", "ids_crc32"])

    rows = pin(tokens.select("doc_id", "part", "seq", "ids").mapInArrow(
        digest, "doc_id long, part int, seq long, n_tokens long, ids_crc32 long"))
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row per written file
    offsets = sums.select(F.col("part").alias("p"), F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("n_tokens").over(
        Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (rows.withColumn("inside", inside).join(F.broadcast(offsets), F.col("part") == F.col("p"))
            .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def token_orc_roundtrip(docs: DataFrame, tokenizer: str | None = None, path: str | None = None) -> DataFrame:
    """Write the files (below the shared checkpoint folder unless ``path`` is given), read them back, digest them."""
    spark = docs.sparkSession
    folder = path or scratch_path(spark, "token-orc")
    write_token_orc(docs, folder, tokenizer)
    out = document_digests(read_token_orc(spark, folder))
    if not path:
        drop_path(spark, folder)                                 # the digests of the files are pinned
    return out
