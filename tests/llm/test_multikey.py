"""Multikey quicksort and the windows it decides, against plain sorting and comparing."""

import random

import numpy as np
import pytest

from tidemark.llm import suffix_dedup
from tidemark.llm.multikey import multikey_sort, neighbour_prefix, repeated_windows, symbols


def strings(seed, n=200):
    r = random.Random(seed)
    out = [bytes(r.choice(b"ab\0\xff") for _ in range(r.randrange(0, 30))) for _ in range(n)]
    return out + [s + b"\0" for s in out[:40]] + out[:20]


def laid_out(rows):
    sizes = np.array([len(s) for s in rows])
    return np.frombuffer(b"".join(rows), np.uint8), np.cumsum(sizes) - sizes, sizes


@pytest.mark.parametrize("seed", range(5))
def test_sorts_like_bytes_and_counts_common_prefixes(seed):
    rows = strings(seed)
    data, at, sizes = laid_out(rows)
    words = symbols(data, at, sizes, 32)
    order = multikey_sort(words, sizes, np.arange(len(rows)), np.array([0]), np.array([len(rows)]))
    got = [rows[i] for i in order]
    assert got == sorted(rows)
    common = [0, *(next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(got, got[1:]))]
    assert neighbour_prefix(words, sizes, order).tolist() == common


def test_sorts_backwards_inside_given_stretches():
    rows = strings(9)
    data, at, sizes = laid_out(rows)
    words = symbols(data, at + sizes - 1, sizes, 32, -1)
    cut = [0, 70, 71, len(rows)]
    order = multikey_sort(words, sizes, np.arange(len(rows)), np.array(cut[:-1]), np.diff(cut))
    for a, z in zip(cut, cut[1:]):
        assert [rows[i][::-1] for i in order[a:z]] == sorted(s[::-1] for s in rows[a:z])


def plain_windows(rows, length, gram):
    """(row, distance) of the windows that another row of the same gram holds at the same distance."""
    seen = {}
    for i, (context, anchor) in enumerate(rows):
        for j in range(max(0, anchor - (len(context) - length)), min(anchor, length) + 1):
            seen.setdefault((context[anchor:anchor + gram], j, context[anchor - j:anchor - j + length]), []).append((i, j))
    return {x for same in seen.values() if len(same) > 1 for x in same}


@pytest.mark.parametrize("seed", range(60))
def test_repeated_windows_equal_brute_force(seed):
    r = random.Random(seed)
    length, gram = r.choice([(40, 8), (30, 10), (24, 3), (64, 16)])
    base = [bytes(r.choice(b"ab\0") for _ in range(2 * length)) for _ in range(3)]
    rows = []
    for _ in range(r.randrange(1, 60)):
        b = bytearray(r.choice(base))
        for _ in range(r.randrange(3)):
            b[r.randrange(len(b))] = r.choice(b"abc\0")
        before = r.randrange(length - gram + 1)
        rows.append((bytes(b[length - before:2 * length - before + r.randrange(before + 1)]), before))
    data, at, sizes = laid_out([c for c, _ in rows])
    before = np.array([o for _, o in rows])
    row, far, near = repeated_windows(data, at + before, before, sizes - before, length, gram)
    got = [(i, j) for i, f, n in zip(row.tolist(), far.tolist(), near.tolist()) for j in range(n, f + 1)]
    assert len(got) == len(set(got)) and set(got) == plain_windows(rows, length, gram)


def test_a_long_text_is_thinned_in_pieces(monkeypatch):
    data = np.random.default_rng(1).integers(97, 100, 60_000).astype(np.uint8)
    whole = suffix_dedup.families(data, np.array([0, len(data)]))
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 9_000)
    pieces = suffix_dedup.families(data, np.array([0, len(data)]))
    pick = [np.repeat(f[3], f[2]) for f in (whole, pieces)]                       # the gram of every window
    assert len(pieces[0]) > len(whole[0]) and (pick[0] == pick[1]).all()
    assert (np.cumsum(pieces[2]) == np.append(pieces[1][1:], len(data) - 399)).all()
