"""Periodic run detection (13)."""

import hashlib
import random
import time
from fractions import Fraction
from zlib import crc32

import pytest

from tests.llm.helpers import documents, no_documents
from tidemark.llm import runs


def brute_runs(w):
    """(start, length, period) straight from the definition."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and w[e] == w[e + q]:
                e += 1
            if e > s:
                length = e - s + q
                smallest = next(d for d in range(1, q + 1) if all(w[x] == w[x + d] for x in range(s, s + length - d)))
                if smallest == q and length >= max(6, 4 * q):
                    out.append((s, length, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    told = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, hashlib.sha256(told.encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def sample():
    r = random.Random(8)
    texts = [None, "", " \t\n\r\x0b\x0c", "a", "a " * 5, "a " * 6, "a " * 700, "ab " * 7 + "c", "x y " * 3, "x y " * 4, "é ß " * 9, "a a " * 6,
             "a a a b " * 40, "a a b a a c " * 25 + "a a b"]
    for k in range(300):
        w = [r.choice("ab" if k % 3 else "abc") for _ in range(r.randrange(1, 60))]
        for _ in range(r.randrange(3)):
            i, p = r.randrange(len(w)), r.randrange(1, 12)
            w[i:i] = [r.choice("abcd") for _ in range(p)] * r.randrange(2, 7)
        texts.append(r.choice([" ", "\n", "  "]).join(w))
    return texts + texts[20:40]


def test_equals_brute_force(spark):
    texts = sample()
    got = {r[0]: tuple(r) for r in runs.run_digests(runs.periodic_runs(runs.loop_tails(documents(spark, texts)))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == brute(i, t), (i, t)


def test_groups_of_texts_do_not_mix(monkeypatch):
    texts = [(t or "").encode().split() for t in sample()]
    assert runs.text_runs(texts) == [brute_runs(w) for w in texts]
    assert [runs.text_runs([w])[0] for w in texts] == runs.text_runs(texts)


def test_spans_and_collapsed_text(spark):
    rows = runs.periodic_runs(documents(spark, ["p q " + "u v w " * 5 + "z", None])).collect()
    by = {r.doc_id: r for r in rows}
    assert [tuple(x) for x in by[0]["runs"]] == [(2, 15, 3)] and by[0].collapsed == "p q u v w z" and by[0].n_words == 18
    assert by[1]["runs"] == [] and by[1].collapsed == "" and by[1].n_words == 0


@pytest.mark.parametrize("words", [["x"] * 300_000, ["x", "y", "x"] * 100_000, ["a"] * 150_000 + ["b"] + ["a"] * 150_000])
def test_very_long_texts_stay_near_linear(words):
    begin = time.time()
    found = runs.text_runs([[x.encode() for x in words]])[0]
    assert time.time() - begin < 20 and 1 <= len(found) < 10


def test_long_period():
    """A period of thousands of words is found exactly."""
    r = random.Random(1)
    period = [str(r.randrange(50)).encode() for _ in range(5003)]
    w = [b"-"] * 3 + period * 4 + period[:17] + [b"!"]
    assert (3, 4 * 5003 + 17, 5003) in runs.text_runs([w])[0]


def test_null_and_repeated_ids(spark):
    docs = documents(spark, ["a " * 9, "a " * 9]).selectExpr("cast(null as long) as doc_id", "text", "lang", "n")
    got = [tuple(r) for r in runs.run_digests(runs.periodic_runs(runs.loop_tails(docs))).collect()]
    assert len(got) == 2 and got[0] == got[1] and got[0][:5] == (None, 1, 0, 9, 1)


def test_empty_table(spark):
    assert runs.run_digests(runs.periodic_runs(runs.loop_tails(no_documents(spark)))).collect() == []
