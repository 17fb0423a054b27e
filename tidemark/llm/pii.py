"""Personal data: base patterns plus spans found by a character BiLSTM-CRF.

The base kinds (email, ip, card, phone) are cut exactly as their patterns say.
The tagger is trained here, in numpy, on labelled spans: windows of the given
texts with generated personal data written into them (forms the patterns know
and forms they don't, such as a phone without its plus), and windows without.
It reads every text in overlapping windows; each window is decoded on its own,
and the windows' spans are reconciled over the whole text: spans cut by a
window's edge give way to those that a neighbouring window saw whole, and of
overlapping spans the set with the highest total score is kept (weighted
interval scheduling).  Base spans always stay; a model span is added only where
it touches no base span.

Every span of the four kinds holds a digit or an ``@`` by definition, so windows
without either are not run through the network.

Defined results: a null text is an empty one; offsets are code points, end
exclusive; repeated documents each keep their row; an empty table gives no
rows; training reads windows of at most ``TRAIN_TEXTS`` documents, chosen by a
seeded hash, and works without any.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.bilstm_crf import BiLstmCrf, char_classes
from tidemark.llm.common import hash_sample
from tidemark.llm.texts import string_chunks

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE, BATCH = 64, 32, 512
TRAIN_TEXTS = 300
TRAIN_WINDOWS = 1600
MIN_SCORE = 2.0
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only begin at the first digit of a run, so the look-behind changes no match and keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns, by start, then kind."""
    out = []
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), 0))
            floor = m.end()
        else:
            floor = max(floor, at + 1)
        at = text.find("@", floor)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


# ---------------------------------------------------------------- training

def _generated(r: random.Random, kind: int) -> str:
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
    if kind == 0:
        local = word() + r.choice(["", ".", "_", "-", "+"]) + r.choice([word(), digits(2), ""])
        return f"{local}@{word()}.{r.choice(['com', 'org', 'net', 'co.uk', word()[:3]])}"
    if kind == 1:
        return ".".join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        n = r.choice([14, 15, 16, 16, 16, 19])
        body = digits(n - 1)
        body += next(c for c in "0123456789" if luhn(body + c))
        step = r.choice([0, 0, 4])
        return r.choice([" ", "-"]).join(body[i:i + step] for i in range(0, n, step)) if step else body
    area, a, b = digits(3), digits(3), digits(4)
    plus = r.choice(["+1 ", "+44 ", "+49 ", ""])
    return plus + r.choice([f"({area}) {a}-{b}", f"{area}-{a}-{b}", f"{area} {a} {b}", f"{area}.{a}.{b}"])


def _decoy(r: random.Random) -> str:
    """Strings with digits or @ that are no personal data."""
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    return r.choice([lambda: "version " + str(r.randint(1, 9)), lambda: f"{r.randint(1, 9)}.{r.randint(0, 9)}", lambda: digits(r.randint(1, 6)),
                     lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice([16, 32, 40]))), lambda: digits(r.randint(20, 24)),
                     lambda: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(20)), lambda: "@" + "abcdefg"[:r.randint(1, 7)],
                     lambda: f"{r.randint(1900, 2099)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", lambda: f"({r.randint(1, 99)})"])()


def training_windows(texts: list[str], n: int = TRAIN_WINDOWS, seed: int = 5):
    """(classes, tags), both (time, row): windows of the texts with spans or decoys written in."""
    r = random.Random(seed)
    pool = [t for t in texts if t] or ["of the and in to that is was"]
    x, y = np.zeros((WINDOW, n), np.int64), np.zeros((WINDOW, n), np.int64)
    for row in range(n):
        text = r.choice(pool)
        at = r.randrange(max(1, len(text) - WINDOW))
        ground = "".join(c for c in text[at:at + WINDOW] if not c.isdigit() and c not in "@+").ljust(WINDOW)
        kind = r.choice([None, None, 0, 1, 2, 3])
        insert = _decoy(r) if kind is None else _generated(r, kind)
        p = r.randrange(max(1, WINDOW - len(insert) // 2))
        left, right = r.choice([(" ", " "), (" ", ", "), (" ", ".\n"), (" ", "\n"), ("(", ")")])
        line = (ground[:p] + left + insert + right + ground[p:])[:WINDOW]
        x[:, row] = char_classes(line)
        if kind is not None:
            a, b = p + len(left), min(WINDOW, p + len(left) + len(insert))
            if b - a >= 6:
                y[a:b, row] = 2 + 2 * kind
                y[a, row] = 1 + 2 * kind
    return x, y


def train(texts: list[str], epochs: int = 12) -> BiLstmCrf:
    model = BiLstmCrf(1 + 2 * len(KINDS))
    model.fit(*training_windows(texts), epochs=epochs)
    return model


# ---------------------------------------------------------------- tagging

def window_starts(text_length: int, triggers: np.ndarray) -> np.ndarray:
    """Starts (multiples of the stride) of the windows that hold a trigger."""
    if not len(triggers):
        return np.zeros(0, np.int64)
    last = max(0, -(-(text_length - WINDOW) // STRIDE)) * STRIDE
    first = np.maximum(0, (triggers - WINDOW) // STRIDE + 1) * STRIDE
    return np.unique(np.minimum(np.concatenate([first + k * STRIDE for k in range(WINDOW // STRIDE)]), last)[
        np.concatenate([first + k * STRIDE <= triggers for k in range(WINDOW // STRIDE)])])


def _window_spans(tags: np.ndarray, emissions: np.ndarray, moves: np.ndarray):
    """(start, end, kind, score) of one window's tag path; the score is the CRF's
    gain of the span over leaving the stretch untagged."""
    out, t, n = [], 0, len(tags)
    while t < n:
        if tags[t] == 0:
            t += 1
            continue
        kind, a = (tags[t] - 1) // 2, t
        t += 1
        while t < n and tags[t] == 2 + 2 * kind:
            t += 1
        picked = emissions[np.arange(a, t), tags[a:t]] - emissions[a:t, 0]
        path = np.concatenate([[0] if a else [], tags[a:t], [0] if t < n else []]).astype(int)
        gain = moves[path[:-1], path[1:]].sum() - moves[0, 0] * (len(path) - 1)
        out.append((a, t, int(kind), float(picked.sum() + gain)))
    return out


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """The set of non-overlapping spans with the highest total score (ties: earlier spans)."""
    spans = sorted(set(spans), key=lambda s: (s[1], s[0], s[2]))
    ends, best = [s[1] for s in spans], [(0.0, None, None)]
    for i, s in enumerate(spans):
        j = int(np.searchsorted(ends[:i], s[0], "right"))
        take = best[j][0] + s[3]
        best.append((take, j, s) if take > best[i][0] else (best[i][0], i, None))
    out, i = [], len(spans)
    while i:
        _, j, s = best[i]
        if s is not None:
            out.append(s)
        i = j
    return out[::-1]


_NEEDS = {0: re.compile("@"), 1: re.compile(r"[0-9].*[0-9]"), 2: re.compile(r"(?:[0-9][^0-9]?){12}"), 3: re.compile(r"(?:[0-9][^0-9]{0,2}){7}")}


def _plausible(kind: int, value: str) -> bool:
    return bool(_NEEDS[kind].search(value)) and (kind != 2 or luhn("".join(_DIGIT.findall(value))))


def model_spans(model: BiLstmCrf, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Reconciled spans of whole texts; all their windows run in batches."""
    where, rows = [], []
    found: list[list] = [[] for _ in texts]

    def flush():
        if not rows:
            return
        x = np.zeros((WINDOW, len(rows)), np.int64)
        for i, c in enumerate(rows):
            x[:len(c), i] = c
        e = model.emissions(x)
        tags = model.decode(e)
        for i, (d, at) in enumerate(where):
            size, n = len(rows[i]), len(texts[d])
            for a, b, kind, score in _window_spans(tags[:size, i], e[:size, i], model.p["T"]):
                cut = (a == 0 and at > 0) or (b == size and at + size < n)
                found[d].append((at + a, at + b, kind, score * (0.25 if cut else 1.0)))
        where.clear(), rows.clear()

    for d, text in enumerate(texts):
        classes = char_classes(text)
        trig = np.flatnonzero(((classes >= 49) & (classes <= 58)) | (classes == 65))
        for at in window_starts(len(text), trig):
            where.append((d, int(at))), rows.append(classes[at:at + WINDOW])
            if len(rows) == BATCH:
                flush()
    flush()
    return [_with_brackets(t, [s[:3] for s in reconcile(f) if s[3] >= MIN_SCORE and s[1] - s[0] >= 6 and _plausible(s[2], t[s[0]:s[1]])])
            for t, f in zip(texts, found)]


def _with_brackets(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that close a bracket they do not open begin at that bracket where it stands right before them."""
    out, end = [], 0
    for a, b, k in spans:
        value = text[a:b]
        opened = a > end and text[a - 1] == "(" and value.count(")") > value.count("(")
        out.append((a - opened, b, k))
        end = b
    return out


def merge_spans(base, added):
    """Base spans plus the added ones that touch none of them, by start, then kind."""
    taken = sorted((a, b) for a, b, _ in base)
    starts = np.array([a for a, _ in taken], np.int64)
    reach = np.maximum.accumulate(np.array([b for _, b in taken], np.int64)) if taken else np.zeros(0, np.int64)
    free = []
    for a, b, k in added:
        i = int(np.searchsorted(starts, b))
        if i == 0 or reach[i - 1] <= a:
            free.append((a, b, k))
    return sorted([*base, *free], key=lambda s: (s[0], s[2]))


def span_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def training_texts(docs: DataFrame, id_col: str, text_col: str, n: int = TRAIN_TEXTS, chars: int = 2000) -> list[str]:
    """A bounded training sample: stretches of up to ``n`` texts, chosen by a seeded hash."""
    picked = hash_sample(docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")), n, 9, F.col("i"))
    size = F.length("t")
    start = F.pmod(F.xxhash64(F.lit(3), F.col("i")), F.greatest(F.lit(1), size - chars)).cast("int") + 1
    return sorted(r["t"] for r in picked.select(F.col("t").substr(start, F.lit(chars)).alias("t")).collect())


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: BiLstmCrf | None = None) -> DataFrame:
    """Rows (doc_id, base, spans): arrays of ``kind:start:end`` joined by commas, base and all."""
    model = model or train(training_texts(docs, id_col, text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def tag(batches):
        lut = np.zeros(256, bool)
        lut[48:58] = lut[64] = True
        for b in batches:
            base, spans = [""] * len(b), [""] * len(b)
            for i, data, off in string_chunks(b.column(1)):
                ends = np.concatenate([[0], np.cumsum(lut[data])])
                at = i + np.flatnonzero(ends[off[1:]] > ends[off[:-1]])
                texts = [b.column(1)[int(j)].as_py() for j in at]
                for j, t, added in zip(at, texts, model_spans(model, texts)):
                    own = base_spans(t)
                    base[j], spans[j] = span_text(own), span_text(merge_spans(own, added))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.string()), pa.array(spans, pa.string())], names=["doc_id", "base", "spans"])

    return rows.mapInArrow(tag, rows.select("doc_id").schema.add("base", "string").add("spans", "string"))


def pii_digests(found: DataFrame) -> DataFrame:
    """Counts per kind over the base spans, their sha256, and all spans."""
    kinds = F.filter(F.split("base", ","), lambda s: s != "")
    count = lambda k: F.size(F.filter(kinds, lambda s: s.startswith(k + ":"))).cast("long").alias("n_" + k)
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def plain_reference(text: str) -> str:
    """Base spans straight from the patterns, for tests."""
    text, out = text or "", []
    for k, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                 r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = "".join(_DIGIT.findall(m.group()))
            if (k == 0 or (k == 1 and all(int(p) <= 255 for p in m.group().split("."))) or (k == 2 and 14 <= len(digits) <= 19 and luhn(digits))
                    or (k == 3 and 10 <= len(digits) <= 15)):
                out.append((m.start(), m.end(), k))
    return span_text(sorted(out, key=lambda s: (s[0], s[2])))


def digest(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
