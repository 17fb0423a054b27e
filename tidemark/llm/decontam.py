"""Benchmark decontamination by latent semantic retrieval.

1. Texts become sequences of term numbers: words of letters and digits,
   lower-cased, that occur in the benchmark; other words are 0.  In scripts
   written without spaces every character is a term.
2. Idf weights come from the document counts of all documents; every term weighs.
3. Blocks of ``block`` words of all documents, and the benchmark's passages with
   weight ``bench_weight``, are the rows of a TF-IDF matrix A.  A randomised
   one-pass SVD (Nystroem: Y = A'A R for a random R, summed over tasks) gives its
   leading right singular vectors, the latent space.
4. Every pair of neighbouring blocks is searched for near the items' passages: a
   cosine of ``min_cosine`` in the latent space proposes it.  Regions (the pair
   with the item's length on both sides) that hold too few of an item's words to
   reach ``min_lcs`` need no cosine; that count is a bound, so nothing is lost by it.
5. Proposed regions are checked by the longest common subsequence of words with
   the item: at least ``min_lcs`` of the item, and ``min_answer`` of its answer
   (the last sentence, or the last half of a single sentence), wherever the words
   were changed or put in.
6. A paraphrase that changes the rare words can lie far from its item in the
   latent space.  Where no proposed region of a document and item passes, the
   regions that the bound of step 4 left are checked too; ``proposed`` tells
   which way a row was found.
7. Items of fewer than ``MIN_WORDS`` terms are found where all their terms stand
   side by side.

The benchmark is broadcast in batches of about ``max_items`` items.

Defined results: null and empty texts are clean; items that are null or without
a term are not looked for; repeated rows each keep
theirs; documents with equal ids are reported once per row; an empty table on
either side gives no rows; all four languages and any script are words alike.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType

from tidemark.llm.common import SLICE_ROWS, array_slices, columns, pin, pins, task_count, tree_sum
from tidemark.llm.texts import prefix_hash, span_hash, string_chunks

BLOCK = 16
RANK, SKETCH = 96, 128
BENCH_WEIGHT = 30.0
MIN_LCS, MIN_ANSWER = 0.7, 0.6
MIN_WORDS = 8
#: Regions at least so near to a passage are checked first.
MIN_COSINE = 0.35
#: Matches asked of an item's rarest words by the bound on shared terms.
RARE_MATCHES = 4
#: Term pairs are counted in one array of at most so many entries.
MAX_PAIRS = 1 << 25
MAX_ITEMS = 20_000
_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms (letters, digits and non-ASCII; A-Z lower-cased) and the first term index per row."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    w = _TERM[data]
    marks = np.flatnonzero((data[:-1] == 0xE3) & (data[1:] == 0x80))         # ideographic blanks and punctuation
    w[(marks[:, None] + np.arange(3)).ravel()] = False
    first, last = _single_characters(data)
    start, stop = w.copy(), w.copy()
    start[1:] &= ~w[:-1]
    stop[:-1] &= ~w[1:]
    for at, edge, other in ((first, start, -1), (last, stop, 1)):
        edge[at] = True
        beside = at + other
        beside = beside[(beside >= 0) & (beside < len(data))]
        (stop if other < 0 else start)[beside] |= w[beside]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    start[cut] |= w[cut]
    stop[cut - 1] |= w[cut - 1]
    s = np.flatnonzero(start)
    return span_hash(prefix_hash(data, lower=True), s, np.flatnonzero(stop) + 1), np.searchsorted(s, off)


def _single_characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte positions of the characters of scripts written without spaces
    (UTF-8: Thai and Lao, Myanmar and Khmer, kana and ideographs)."""
    lead = np.flatnonzero((data[:-1] >= 0xE0) & (data[:-1] <= 0xF0))
    a, b = data[lead], data[lead + 1]
    wide = (a == 0xF0) & (b >= 0xA0) & (b <= 0xAF)
    single = (wide | (a == 0xE0) & (b >= 0xB8) & (b <= 0xBB) | (a == 0xE1) & ((b >= 0x80) & (b <= 0x82) | (b == 0x9E) | (b == 0x9F))
              | (a == 0xE3) & (b >= 0x81) | (a >= 0xE4) & (a <= 0xE9))
    first = lead[single]
    return first, first + 2 + wide[single]


class Benchmark:
    """Items as term numbers, their answers' first terms and their passages."""

    def __init__(self, rows: list[tuple], block: int = BLOCK, min_words: int = MIN_WORDS):
        self.ids, texts, answers, short = [], [], [], []
        for item, text in rows:
            (hashes, _), = [self._hashes(text or "")]
            if len(hashes) >= min_words:
                self.ids.append(item), texts.append(hashes), answers.append(self._answer(text, len(hashes)))
            elif len(hashes):
                short.append((item, hashes))
        every = texts + [h for _, h in short]
        self.terms = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        # short items by their term numbers: length -> sequence -> item ids
        self.short: dict[int, dict[bytes, list]] = {}
        for item, hashes in short:
            self.short.setdefault(len(hashes), {}).setdefault(self.numbers(hashes).tobytes(), []).append(item)
        self.items = [np.searchsorted(self.terms, t) + 1 for t in texts]
        self.answers = answers
        self.passages, self.owner = [], []
        for i, t in enumerate(self.items):
            for a in range(0, max(1, len(t) - block), block):
                p = t[a:a + 2 * block]
                self.passages.append(np.pad(p, (0, 2 * block - len(p))))
                self.owner.append(i)
        self.passages = np.array(self.passages, np.int64).reshape(-1, 2 * block)
        self.owner = np.array(self.owner, np.int64)

    @staticmethod
    def _hashes(text: str):
        raw = np.frombuffer(text.encode(), np.uint8)
        return term_hashes(raw, np.array([0, len(raw)]))

    @classmethod
    def _answer(cls, text: str, n: int) -> int:
        """Index of the first term of the answer."""
        ends = [m.end() for m in re.finditer(r"[.?!\n]+(?=\s*\S)", text)]
        before = len(cls._hashes(text[:ends[-1]])[0]) if ends else 0
        return before if 0 < before <= n - 3 else n // 2

    def short_matches(self, raw: bytes):
        """(item id, first term, terms) of the short items in a document's term numbers, each where it comes first."""
        seq = np.frombuffer(raw, np.int32)
        for n, items in self.short.items():
            if len(seq) < n:
                continue
            heads = np.unique([np.frombuffer(k, np.int32)[0] for k in items])
            seen = set()
            for i in np.flatnonzero(np.isin(seq[:len(seq) - n + 1], heads)).tolist():
                key = seq[i:i + n].tobytes()
                if key in items and key not in seen:
                    seen.add(key)
                    yield from ((item, i, n) for item in items[key])

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at + 1, 0).astype(np.int32)


def lcs(a: list[int], masks: dict[int, int], n: int) -> int:
    """Positions of the pattern (bit masks per term, n terms) matched by a longest
    common subsequence with ``a``, as a bit set (bit-parallel)."""
    v = full = (1 << n) - 1
    for t in a:
        m = masks.get(t)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return full & ~v


def _masks(item: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, t in enumerate(item.tolist()):
        out[t] = out.get(t, 0) | 1 << i
    return out


def _begin(a: list[int], item: np.ndarray, total: int) -> int:
    """Where the shortest end of ``a`` begins whose common subsequence with the item is ``total`` long."""
    masks, n = _masks(item[::-1]), len(item)
    v = full = (1 << n) - 1
    for i in range(len(a) - 1, -1, -1):
        m = masks.get(a[i])
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
            if n - v.bit_count() >= total:
                return i
    return 0


def term_rows(docs: DataFrame, id_col: str, text_col: str, bench: Benchmark) -> DataFrame:
    """(doc_id, terms): little-endian int32 term numbers of every document with a benchmark term."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col).cast("string")).alias("text"))

    def number(batches):
        for b in batches:
            for lo, data, off in string_chunks(b.column(1)):
                hashes, first = term_hashes(data, off)
                terms = bench.numbers(hashes)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:lo + len(off) - 1], pa.array([terms[a:z].tobytes() for a, z in zip(first[:-1], first[1:])], pa.binary())],
                    names=["doc_id", "terms"])

    return rows.mapInArrow(number, rows.select("doc_id").schema.add("terms", "binary"))


def document_counts(terms: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Documents per term number (0..size-1) and the number of documents."""

    def count(batches):
        total, n = np.zeros(size, np.int64), 0
        for b in batches:
            for raw in b.column(0).to_pylist():
                total[np.unique(np.frombuffer(raw, np.int32))] += 1
                n += 1
        total[0] = n
        yield from array_slices(total)

    total = tree_sum(terms.select("terms").mapInArrow(count, SLICE_ROWS), task_count(terms), size, np.int64)
    return total, int(total[0])


def term_weights(counts: np.ndarray, n_docs: int) -> np.ndarray:
    """Idf by term number; 0 for unknown terms."""
    idf = np.log((n_docs + 1) / (counts + 1)) + 0.1
    idf[0] = 0
    return idf


class SharedTerms:
    """Exact bound on shared terms: where a document can reach the LCS with an item.

    A common subsequence of ``need`` of an item's n terms leaves out n - need of
    them, so of any n - need + k terms it holds k.  The rarest terms are asked
    for, in chunks of a document that overlap so far that every region lies
    whole in one.  Items are taken by size class (powers of two).
    """

    def __init__(self, bench: Benchmark, counts: np.ndarray, min_lcs: float, block: int = BLOCK):
        self.items, self.block = bench.items, block
        self.need = np.array([math.ceil(min_lcs * len(t)) for t in bench.items], np.int64)
        self.classes = []
        sizes = np.array([len(t).bit_length() for t in bench.items])
        for size in np.unique(sizes):
            owned = np.flatnonzero(sizes == size)
            least = np.minimum(self.need[owned], RARE_MATCHES)
            rows = []
            for j, i in enumerate(owned):
                t = bench.items[i]
                rare = t[np.argsort(counts[t], kind="stable")][:len(t) - self.need[i] + least[j]]
                term, times = np.unique(rare, return_counts=True)
                rows.append(np.stack([term, np.full(len(term), j), times]))
            rows = np.concatenate(rows, 1)
            rows = rows[:, np.argsort(rows[0], kind="stable")]
            first = np.searchsorted(rows[0], np.arange(len(counts) + 1))
            step = 2 * max(len(bench.items[i]) for i in owned) + 2 * block
            self.classes.append((owned, least, first, rows[1], rows[2], step))

    def chunks(self, raws: list[bytes]):
        """Yield (document, item, first word, step) of the chunks that may hold a region to check: those that begin within ``step`` words."""
        seqs = [np.frombuffer(r, np.int32) for r in raws]
        sizes = np.array([len(s) for s in seqs])
        terms = np.concatenate(seqs) if seqs else np.zeros(0, np.int32)
        doc = np.repeat(np.arange(len(seqs)), sizes)
        inside = np.arange(len(terms)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        for owned, least, first, item, times, step in self.classes:
            deg = np.diff(first)
            at = np.flatnonzero(deg[terms])
            n_chunks = sizes // step + 1
            base = np.cumsum(n_chunks) - n_chunks
            chunk = base[doc[at]] + inside[at] // step
            cell = chunk * len(deg) + terms[at]
            cell = np.unique(np.concatenate([cell, cell[inside[at] >= step] - len(deg)]))
            chunk, term = cell // len(deg), cell % len(deg)
            many = deg[term]
            post = np.repeat(first[term] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            key = np.repeat(chunk, many) * len(owned) + item[post]
            order = np.argsort(key, kind="stable")
            key, got = key[order], times[post][order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            total = np.add.reduceat(got, starts) if len(key) else got
            key = key[starts]
            key = key[total >= least[key % len(owned)]]
            chunk, j = key // len(owned), key % len(owned)
            d = np.searchsorted(base, chunk, "right") - 1
            yield from zip(d.tolist(), owned[j].tolist(), ((chunk - base[d]) * step).tolist(), [step] * len(d))

    def blocks(self, raws: list[bytes]) -> dict:
        """(document, item) -> blocks whose region, the item's length on both sides, holds ``need`` of the item's terms."""
        out: dict = {}
        for d, i, a, step in self.chunks(raws):
            n, block = len(self.items[i]), self.block
            seq = np.frombuffer(raws[d], np.int32)
            # regions that begin in [a, a + step); those of the first blocks begin at 0
            h = np.arange(0 if a == 0 else -(-(a + n) // block), min(-(-(a + step + n) // block), -(-len(seq) // block)))
            if not len(h):
                continue
            known = np.concatenate([[0], np.cumsum(np.isin(seq[a:a + 2 * step], self.items[i]))])
            lo, hi = np.maximum(h * block - n, 0) - a, np.minimum((h + 2) * block + n, len(seq)) - a
            h = h[known[hi] - known[lo] >= self.need[i]]
            if len(h):
                out.setdefault((d, i), []).extend(h.tolist())
        return out


def _blocks(raws: list[bytes], block: int, weighs: np.ndarray):
    """(terms that weigh, their block, doc of each block, blocks per document): blocks of ``block`` words."""
    seqs = [np.frombuffer(r, np.int32) for r in raws]
    sizes = np.array([len(s) for s in seqs])
    n_blocks = -(-sizes // block)
    terms = np.concatenate(seqs) if seqs else np.zeros(0, np.int32)
    inside = np.arange(len(terms)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = inside // block + np.repeat(np.cumsum(n_blocks) - n_blocks, sizes)
    known = weighs[terms]
    return terms[known], at[known], np.repeat(np.arange(len(seqs)), n_blocks), n_blocks


def _project(terms: np.ndarray, at: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    """Sum of the terms' rows of ``basis`` per block (``at`` ascending)."""
    out = np.zeros((n, basis.shape[1]), np.float32)
    if len(at):
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        out[at[starts]] = np.add.reduceat(basis[terms], starts, 0)
    return out


def _slices(batch_col, words: int = 60_000):
    """Row ranges of a binary column of about so many terms."""
    raws, size, lo = [], 0, 0
    for i, raw in enumerate(batch_col.to_pylist()):
        raws.append(raw)
        size += len(raw) // 4
        if size >= words:
            yield lo, raws
            raws, size, lo = [], 0, i + 1
    if raws:
        yield lo, raws


class _PairCounts:
    """Ordered pairs of terms in a block, counted: A'A without the weights."""

    FLUSH = 1 << 26

    def __init__(self, size: int, weighted: np.ndarray, block: int):
        self.size, self.weighted, self.block, self.seen = size, weighted.astype(np.float64), block, 0
        self.pairs = np.zeros(size * size, np.uint32)

    def add(self, t: np.ndarray, at: np.ndarray, y: np.ndarray):
        """Count the terms ``t`` of the blocks ``at`` (ascending)."""
        if self.seen > self.FLUSH:
            self.flush(y)
        self.seen += len(t)
        t = t.astype(np.int64)
        y += np.bincount(t, minlength=self.size)[:, None] * self.weighted        # a term with itself
        for j in range(1, self.block):
            same = np.flatnonzero(at[j:] == at[:-j])
            np.add.at(self.pairs, t[same] * self.size + t[same + j], np.uint32(1))

    def flush(self, y: np.ndarray):
        c = self.pairs.reshape(self.size, self.size)
        for i in range(0, self.size, 512):
            y[i:i + 512] += c[i:i + 512].astype(np.float64) @ self.weighted
            y[i:i + 512] += c[:, i:i + 512].T.astype(np.float64) @ self.weighted
        self.pairs[:], self.seen = 0, 0


def latent_space(terms: DataFrame, bench: Benchmark, idf: np.ndarray, rank: int = RANK, sketch: int = SKETCH, block: int = BLOCK,
                 bench_weight: float = BENCH_WEIGHT, seed: int = 3, max_pairs: int = MAX_PAIRS) -> np.ndarray:
    """(terms + 1, rank) float32: idf-weighted right singular vectors of the passages' TF-IDF matrix."""
    size = len(idf)
    sketch = min(sketch, size)
    random = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, sketch)))[0].astype(np.float32)
    weighted = (random * idf[:, None]).astype(np.float32)
    weighs = idf > 0

    def partial(batches):
        y = np.zeros((size, sketch))
        pairs = _PairCounts(size, weighted, block) if size * size <= max_pairs else None
        for b in batches:
            for _, raws in _slices(b.column(0)):
                t, at, _, _ = _blocks(raws, block, weighs)
                if pairs:
                    pairs.add(t, at, y)
                elif len(t):
                    _, at = np.unique(at, return_inverse=True)       # blocks with terms only
                    z = _project(t, at, int(at[-1]) + 1, weighted)
                    order = np.argsort(t, kind="stable")
                    starts = np.flatnonzero(np.concatenate([[True], np.diff(t[order]) != 0]))
                    y[t[order][starts]] += np.add.reduceat(z[at[order]], starts, 0)
        if pairs:
            pairs.flush(y)
        yield from array_slices(y.ravel())

    y = tree_sum(terms.select("terms").mapInArrow(partial, SLICE_ROWS), task_count(terms), size * sketch, np.float64).reshape(size, sketch)
    z = weighted[bench.passages].sum(1)
    np.add.at(y, bench.passages.ravel(), bench_weight ** 2 * np.repeat(z, bench.passages.shape[1], 0))
    y *= idf[:, None]
    y += 1e-6 * np.linalg.norm(y) * random
    gram = random.T.astype(np.float64) @ y
    gram = (gram + gram.T) / 2
    root = np.linalg.cholesky(gram + 1e-9 * np.trace(gram) / sketch * np.eye(sketch))
    u, _, _ = np.linalg.svd(np.linalg.solve(root, y.T).T, full_matrices=False)
    return (u[:, :rank] * idf[:, None]).astype(np.float32)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", max_items: int = MAX_ITEMS,
               min_lcs: float = MIN_LCS, min_answer: float = MIN_ANSWER, min_cosine: float = MIN_COSINE, block: int = BLOCK) -> DataFrame:
    """Rows (doc_id, item_id, first_word, lcs, item_words, cosine, proposed): one per document row and item it contains."""
    items = benchmark.select(F.col(item_col).alias("i"), F.lower(F.col(item_text_col).cast("string")).alias("t")).filter("t <> ''").distinct()
    batches = max(1, -(-items.count() // max_items))
    found = []
    for part in range(batches):
        mine = items if batches == 1 else items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(batches)) == part)
        rows = sorted(((r["i"], r["t"]) for r in mine.collect()), key=lambda r: (str(r[0]), r[1]))     # about max_items
        found.append(_find_batch(docs, rows, benchmark.schema[item_col].dataType, id_col, text_col, min_lcs, min_answer, min_cosine, block))
    return reduce(DataFrame.unionByName, found)


def _find_batch(docs: DataFrame, items: list[tuple], item_kind: DataType, id_col: str, text_col: str, min_lcs: float, min_answer: float,
                min_cosine: float, block: int) -> DataFrame:
    """``find_leaks`` for some of the items."""
    bench = Benchmark(items, block)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = narrow.select("doc_id").schema.add("item_id", item_kind)
    for name, kind in (("first_word", "long"), ("lcs", "long"), ("item_words", "long"), ("cosine", "double"), ("proposed", "boolean")):
        schema = schema.add(name, kind)
    if not len(bench.terms):
        return docs.sparkSession.createDataFrame([], schema)
    terms = pin(term_rows(narrow, "doc_id", "text", bench))
    counts, n_docs = document_counts(terms, len(bench.terms) + 1)
    if bench.ids:
        basis = latent_space(terms, bench, term_weights(counts, n_docs), block=block)
        latent = basis[bench.passages].sum(1)
        norm = np.linalg.norm(latent, axis=1) + 1e-9
        unit = (latent / norm[:, None]).T.copy()
    first_passage = np.searchsorted(bench.owner, np.arange(len(bench.ids) + 1))
    shared = SharedTerms(bench, counts, min_lcs, block)
    masks, full = [_masks(t) for t in bench.items], [len(t) for t in bench.items]

    def _cosines(seq, at, item):
        """Cosine of each region's blocks with the nearest of the item's passages."""
        z = np.stack([basis[seq[h * block:(h + 2) * block]].sum(0) for h in at])
        own = unit[:, first_passage[item]:first_passage[item + 1]]
        return ((z @ own) / (np.linalg.norm(z, axis=1) + 1e-9)[:, None]).max(1)

    def _checked(seq, at, item):
        """(lcs, first, end) of the best of the regions that passes, or None."""
        n, best = full[item], None
        for h in at:
            a, z = max(0, h * block - n), (h + 2) * block + n
            bits = lcs(seq[a:z].tolist(), masks[item], n)
            total, answer = bits.bit_count(), (bits >> bench.answers[item]).bit_count()
            if total >= min_lcs * n and answer >= min_answer * (n - bench.answers[item]) and (best is None or total > best[0]):
                best = (total, a, z)
        return best

    def search(batches):
        for b in batches:
            out = []
            for lo, raws in _slices(b.column(1)):
                for (d, item), at in shared.blocks(raws).items() if bench.ids else ():
                    seq, n, at = np.frombuffer(raws[d], np.int32), full[item], np.asarray(at)
                    near = _cosines(seq, at, item)
                    proposed = near >= min_cosine
                    best = _checked(seq, at[proposed].tolist(), item)
                    by_cosine = best is not None
                    best = best or _checked(seq, at[~proposed].tolist(), item)
                    if best:
                        total, a, z = best
                        first = a + _begin(seq[a:z].tolist(), bench.items[item], total)
                        out.append((lo + d, bench.ids[item], first, total, n, round(float(near.max()), 3), by_cosine))
                for d, raw in enumerate(raws) if bench.short else ():
                    out += [(lo + d, item, first, n, n, 1.0, True) for item, first, n in bench.short_matches(raw)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array([o[0] for o in out], pa.int64())), pa.array([o[1] for o in out], item_arrow),
                 *[pa.array([o[i] for o in out], pa.int64()) for i in (2, 3, 4)], pa.array([o[5] for o in out], pa.float64()),
                 pa.array([o[6] for o in out], pa.bool_())],
                names=["doc_id", "item_id", "first_word", "lcs", "item_words", "cosine", "proposed"])

    from pyspark.sql.pandas.types import to_arrow_type
    item_arrow = to_arrow_type(item_kind)
    return terms.mapInArrow(search, schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that contain no benchmark item, with their own columns."""
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    keyed = docs.withColumn("__leak_key", key)
    with pins() as own:
        leaks = own.keep(pin(find_leaks(keyed, benchmark, "__leak_key", text_col).select(F.col("doc_id").alias("__leak_id")).distinct()))
    return keyed.join(leaks, F.col("__leak_key") == F.col("__leak_id"), "left_anti").select(*columns(docs))
