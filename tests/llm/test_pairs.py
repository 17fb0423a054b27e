"""N-gram Jaccard join (1), suffix dedup (8), exact top-k (5)."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, no_documents, table, words
from tidemark.llm import graph, ngram_join, suffix_dedup, topk
from tidemark.llm.graph import connected_components
from tidemark.llm.trie_join import PrefixTree, Forest, linking_edges

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(_LOW))
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def components(texts):
    sets, up = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(seed=1, groups=12, copies=9):
    r = random.Random(seed)
    texts = ["", None, " \t\n", "one", "One", "one two three", "ONE TWO THREE", "a b c d e", "a b c d e f"]
    passage = words(r, 60)
    for _ in range(groups):
        base = words(r, r.choice([8, 30, 120, 400])).split()
        for _ in range(r.randrange(1, copies)):
            w = list(base)
            for _ in range(r.randrange(0, max(2, len(w) // 15))):
                w[r.randrange(len(w))] = f"x{r.randrange(50)}"
            texts.append(" ".join(w) + (" " + passage if r.random() < 0.3 else ""))
    texts += [texts[-1]] * 5 + [words(r, 20_000)]
    return texts


@pytest.mark.parametrize("block_docs", [2, 128])
def test_near_duplicates_equal_brute_force(spark, block_docs):
    texts = near_copies()
    got = ngram_join.near_duplicate_components(documents(spark, texts), block_docs=block_docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == components(texts)


def test_near_duplicates_repeats_nulls_and_empty(spark):
    text = "a b c d e f g h"
    df = documents(spark, [text, text, None]).unionByName(documents(spark, [text, text, None]))
    df = df.unionByName(documents(spark, [text]).withColumn("doc_id", F.lit(None).cast("long")))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicate_components(df).collect()), key=repr)
    assert got == sorted([(0, 4, 0), (0, 4, 0), (1, 4, 0), (1, 4, 0), (2, 0, 2), (2, 0, 2), (None, 4, 0)], key=repr)
    kept = ngram_join.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) in (
        sorted([(0, text), (2, None)], key=repr), sorted([(None, text), (2, None)], key=repr))
    assert ngram_join.near_duplicate_components(no_documents(spark)).count() == 0
    assert ngram_join.drop_near_duplicates(no_documents(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    texts = near_copies(2)
    kept = sorted(r.doc_id for r in ngram_join.drop_near_duplicates(documents(spark, texts)).collect())
    assert kept == sorted({c for _, _, c in components(texts)})


def test_near_copies_of_every_document_fit_on_disk(spark, monkeypatch):
    """All sets stay in the filters and lie in large groups: what is pinned and what is
    dealt to block pairs at once stays in proportion to the texts."""
    r, texts = random.Random(8), []
    passage = words(r, 12)
    for g in range(20):
        base = words(r, 700).split()
        texts += [" ".join(base[:-2] + [f"y{g}c{c}", "end"]) for c in range(8)]
    chain = words(r, 60).split()
    texts += [" ".join(chain[:40] + words(r, 6 + i % 5).split()) + " " + passage for i in range(60)]
    want = components(texts)
    pinned, dealt = [], []

    def weighed(df):
        out = pin(df)
        if "packed" in out.columns or "tokens" in out.columns:
            pinned.append(out.agg(F.sum(F.length("packed" if "packed" in out.columns else "tokens"))).collect()[0][0])
        return out

    def joined(rows, keys, *args):
        if keys == ["component", "pair"]:
            dealt.append(rows.count())
        return join(rows, keys, *args)

    pin, join, resolve = ngram_join.pin, ngram_join._joined_blocks, ngram_join.resolve_groups
    monkeypatch.setattr(ngram_join, "pin", weighed)
    monkeypatch.setattr(ngram_join, "_joined_blocks", joined)
    monkeypatch.setattr(ngram_join, "resolve_groups", lambda *a: resolve(*a, batch_bytes=20_000))
    got = ngram_join.near_duplicate_components(documents(spark, texts), block_docs=4).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == want
    assert max(pinned) < sum(map(len, texts))
    assert len(dealt) > 1


def test_holders_of_neighbouring_size_bands_are_tied():
    r = np.random.default_rng(4)
    t, band, node = r.integers(0, 40, 300).astype(np.uint64), r.integers(0, 9, 300).astype(np.uint16), r.integers(0, 200, 300)
    first, edges = ngram_join._met(t, band, node)
    assert sorted(zip(t[first].tolist(), band[first].tolist())) == sorted(set(zip(t.tolist(), band.tolist())))
    up, want = Forest(200), Forest(200)
    for u, v in edges.tolist():
        up.union(u, v)
    for i in range(300):
        for j in range(i):
            if t[i] == t[j] and abs(int(band[i]) - int(band[j])) <= 1:
                want.union(int(node[i]), int(node[j]))
    assert [up.find(i) for i in range(200)] == [want.find(i) for i in range(200)]
    assert [len(x) for x in ngram_join._met(t[:0], band[:0], node[:0])] == [0, 0]


def test_prefix_tree_finds_every_link():
    r = np.random.default_rng(3)
    sets = []
    for _ in range(25):
        base = r.choice(400, 40, replace=False)
        for _ in range(6):
            s = np.setdiff1d(base, r.choice(base, 4)).astype(np.uint64)
            sets.append(np.union1d(s, r.choice(400, r.integers(0, 6)).astype(np.uint64)))
    up = Forest(len(sets))
    for i, j in linking_edges(sets):
        up.union(i, j)
    want = Forest(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            o = len(np.intersect1d(sets[i], sets[j]))
            if 7 * o >= 3 * (len(sets[i]) + len(sets[j])):
                want.union(i, j)
    assert [up.find(i) for i in range(len(sets))] == [want.find(i) for i in range(len(sets))]
    assert PrefixTree(sets[:3], Forest(3)).probe(0) == []


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_of_few_edges_need_no_star_steps(spark, monkeypatch):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)]
    up = Forest(500)
    for u, v in edges:
        up.union(u, v)
    want = {x: up.find(x) for e in edges if e[0] != e[1] for x in e}
    df = spark.createDataFrame(edges, "u long, v long").repartition(7)
    for block in (1, 3, 50):                              # many blocks: stars across them
        assert {c.node: c.component for c in connected_components(df, block_edges=block).collect()} == want

    def star(*_):
        raise AssertionError("a star step on a handful of edges")
    monkeypatch.setattr(graph, "_star", star)
    rows = connected_components(df).collect()
    assert len(rows) == len(want) and {c.node: c.component for c in rows} == want


# ---------------------------------------------------------------- suffix dedup

def repeated_texts(seed=4):
    r = random.Random(seed)
    passages = [words(r, 120) for _ in range(4)]
    texts = [None, "", "short", "ä" * 500, "ä" * 420, words(r, 90) * 3, "a" * 399, "b" * 400, "b" * 401]
    for _ in range(25):
        p = r.choice(passages)
        cut = r.randrange(0, len(p) // 2)
        texts.append(words(r, r.randrange(5, 200)) + " " + p[cut:cut + r.randrange(300, 700)] + " " + words(r, r.randrange(0, 60)))
    texts += [texts[-1], texts[-1], words(r, 8000)]
    return texts


@pytest.mark.parametrize("hot_members", [0, 3, 100])
def test_removed_bytes_equal_brute_force(spark, hot_members):
    texts = repeated_texts()
    out = suffix_dedup.remove_repeats(documents(spark, texts), hot_members=hot_members)
    got = out.select("doc_id", "n_bytes", "n_removed", F.size("spans").alias("n"), F.sha2("kept", 256).alias("h")).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == suffix_dedup.plain_reference(texts)


def test_repeats_of_equal_rows_and_empty_table(spark):
    text = words(random.Random(1), 200)
    df = documents(spark, [text])
    got = suffix_dedup.remove_repeats(df.unionByName(df)).collect()
    assert [(r.n_removed, r.kept) for r in got] == [(len(text), b"")] * 2
    one = suffix_dedup.remove_repeats(df).collect()[0]
    assert (one.n_removed, bytes(one.kept).decode()) == (0, text)
    assert suffix_dedup.remove_repeats(no_documents(spark)).count() == 0


# ---------------------------------------------------------------- top-k

def brute_topk(vectors, k, every):
    cells = {i: np.floor(256 * np.asarray(v, np.float64)).astype(np.int64) for i, v in vectors}
    out = []
    for q in sorted(i for i in cells if i % every == 0):
        scores = sorted((-int(cells[q] @ c), i) for i, c in cells.items() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 64)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)
    rows = [(r.vec_id, r.embedding) for r in table(spark, "embeddings").collect()]
    got = sorted(tuple(r) for r in topk.top_k(table(spark, "embeddings"), query_every=20).collect())
    assert got == sorted(brute_topk(rows, 5, 20))


def test_topk_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, None, 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
            (6, [None, 1.0], 1), (None, [1.0, 1.0], 1), (50, [-0.001, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, block int")
    got = sorted(tuple(r) for r in topk.top_k(df, query_every=50).collect())
    assert got == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 50, -256), (50, 1, 1, 130816), (50, 2, 2, 130816), (50, 3, 0, -256)]
    same = topk.top_k(df.unionByName(df.where("vec_id = 0")), k=1, query_every=50)
    assert sorted(r.vec_id for r in same.collect()) == [1, 1]                     # a repeated query counts once
    assert topk.top_k(df.limit(0)).count() == 0


def test_index_stops_only_on_proof():
    r = np.random.default_rng(5)
    cells = r.integers(-200, 200, (300, 16))
    q, c, s = topk.ImpactIndex(cells).search(np.arange(300), cells[:10], np.arange(10), 5, rescore=8)
    for i in range(10):
        want = sorted((-int(cells[i] @ cells[j]), j) for j in range(300) if j != i)[:5]
        mine = sorted((-int(s[n]), int(c[n])) for n in np.flatnonzero(q == i))[:5]
        assert mine == want


def test_floors_leave_out_no_member():
    r = np.random.default_rng(6)
    cells, asked, own = r.integers(-200, 200, (300, 16)), r.integers(-200, 200, (12, 16)), np.arange(1000, 1012)
    index, scores = topk.ImpactIndex(cells), cells @ asked.T
    fifth = np.sort(scores, 0)[-5]
    for floor in (fifth, fifth - 3000, np.where(np.arange(12) % 2, fifth, topk.NO_FLOOR)):
        q, c, s = index.search(np.arange(300), asked, own, 5, rescore=0, floor=floor)
        for i in range(12):
            assert set(np.flatnonzero(scores[:, i] >= fifth[i])) <= set(c[q == i])
            assert (s[q == i] == scores[c[q == i], i]).all()
    assert len(index.search(np.arange(300), asked, own, 5, floor=scores.max(0) + 1_000_000)[0]) == 0


def test_many_grams_share_their_leading_bytes(spark):
    """Thousands of grams that begin alike are spread by the rest of the gram."""
    r = random.Random(12)
    texts = []
    for i in range(900):
        t = "".join("x" * 40 + f"{r.randrange(10 ** 24):024d}" for _ in range(10))
        texts += [t, r.choice("ab") * r.randrange(50) + t] if i % 2 else [t]
    got = suffix_dedup.remove_repeats(documents(spark, texts)).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").alias("n"), F.sha2("kept", 256).alias("k")).orderBy("doc_id").collect()
    assert [tuple(x)[1:] for x in got] == suffix_dedup.plain_reference(texts)
    assert sum(x.n_removed > 0 for x in got) == 900
