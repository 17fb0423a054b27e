"""Source mix (2), perspective rotation (6), token files (9), queries and the pipeline."""

import os
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tests.llm.helpers import SF, documents, no_documents, table, words
from tests.llm.test_pairs import components
from tidemark.llm import chat, decontam, mixing, queries, token_orc, toxicity


# ---------------------------------------------------------------- source mix

def mixed(spark, sizes_by_source, seed=1):
    r = random.Random(seed)
    texts, sources = [], []
    for source, sizes in sizes_by_source.items():
        for n in sizes:
            texts.append(words(r, n)), sources.append(source)
    return texts, sources


def test_mix_comes_near_its_targets(spark):
    r = random.Random(9)
    spec = {s: [r.randrange(1, 300) for _ in range(n)] for s, n in (("a", 200), ("b", 60), ("c", 300), (None, 40), ("d", 3), ("e", 150))}
    texts, sources = mixed(spark, spec)
    texts += [None, ""]
    sources += ["a", None]
    docs = documents(spark, texts, sources)
    got = mixing.mix_sources(docs).orderBy("doc_id").collect()
    again = mixing.mix_sources(docs.repartition(7)).orderBy("doc_id").collect()
    assert got == again and len(got) == len(texts)
    size = {s: sum(v) for s, v in spec.items()}
    targets = mixing.source_targets(size)
    assert sum(targets.values()) == sum(size.values()) and all(targets[s] <= 3 * size[s] for s in size)
    assert targets["d"] == 3 * size["d"]
    for s in size:
        taken = sum(x.taken for x, y in zip(got, sources) if y == s)
        assert abs(taken - float(targets[s])) <= max(spec[s])
    for x, s in zip(got, sources):
        assert (x.source_size, x.target) == (size[s], float(targets[s]))
        assert x.taken % max(1, x.size) == 0 and x.taken <= 3 * x.size
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    count = {r_.doc_id: r_["count"] for r_ in out.groupBy("doc_id").count().collect()}
    assert {x.doc_id: x.copies for x in got if x.copies} == count


def test_targets_in_code_point_order_with_reshared_excess():
    t = mixing.source_targets({"b": 100, "a": 10, "é": 50, None: 40})
    # weights a 5, b 2, é 1, null 5; a stops at 30, the 170 left are shared as 2 : 1 : 5
    assert t == {"a": 30, "b": Fraction(85, 2), "é": Fraction(85, 4), None: Fraction(425, 4)}
    # two stop one after the other
    assert mixing.source_targets({"a": 1, "b": 20, "c": 979}) == {"a": 3, "b": 60, "c": 937}


def plain_targets(sizes):
    """Weighted shares under the caps by raising a common level until all words are given out."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, given, level = Fraction(sum(sizes.values())), Fraction(0), Fraction(0)
    stops = sorted((Fraction(3 * sizes[s], weight[s]), s is None, s or "", s) for s in order)
    for k, (stop, _, _, _) in enumerate(stops):
        rate = sum(weight[x[3]] for x in stops[k:])
        if given + (stop - level) * rate >= total:
            level += (total - given) / rate
            break
        given, level = given + (stop - level) * rate, stop
    return {s: min(Fraction(3 * sizes[s]), level * weight[s]) for s in order}


def test_mix_equals_a_plain_selection(spark):
    """Targets, whole copies and the seeded choice, document by document, against plain loops over the same hashes."""
    r = random.Random(3)
    spec = {s: [r.choice([0, 1, 5, 40, 40, 400]) for _ in range(n)] for s, n in (("a", 90), ("B", 50), (None, 30), ("é", 20), ("z", 2))}
    texts, sources = mixed(spark, spec)
    docs = documents(spark, texts, sources)
    docs = docs.unionByName(docs.filter("doc_id % 9 = 0"))                   # repeated rows are documents of their own
    seeded = docs.select("doc_id", "source", mixing.seeded_hash(mixing.SEED, F.col("doc_id"), F.col("text")).alias("u")).collect()
    size = {i: len(t.split()) for i, t in enumerate(texts)}
    of_source: dict = {}
    for x in seeded:
        of_source.setdefault(x.source, []).append((x.u, size[x.doc_id], x.doc_id))
    targets = plain_targets({s: sum(n for _, n, _ in rows) for s, rows in of_source.items()})
    want = []
    for s, rows in of_source.items():
        words_, left = sum(n for _, n, _ in rows), round(targets[s])
        whole, left = divmod(left, words_)
        taken, stopped = set(), False
        for u in sorted({u for u, _, _ in rows}):
            n = sum(m for v, m, _ in rows if v == u)
            stopped = stopped or n > left and n - left >= left
            if not stopped:
                taken.add(u)
                stopped, left = n > left, left - n
        want += [(d, n, words_, float(targets[s]), n * (whole + (u in taken))) for u, n, d in rows]
    got = [tuple(x)[:5] for x in mixing.mix_sources(docs).collect()]
    assert sorted(got) == sorted(want)


def test_flow_prefers_first_copies_and_shares_overlaps():
    # words in both sources go where they are needed; nothing is repeated while fresh words are left
    taken = mixing.min_cost_flow([(("a",), 100), (("a", "b"), 100), (("b",), 50)], {"a": 150, "b": 100}, 3)
    assert taken == [100, 100, 50]
    assert mixing.min_cost_flow([(("a",), 10)], {"a": 100}, 3) == [30]
    assert mixing.min_cost_flow([], {}, 3) == []


def test_mix_of_overlapping_sources_and_empty_table(spark):
    r = random.Random(4)
    rows = [(i, words(r, 50), [["a"], ["a", "b"], ["b"]][i % 3]) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = mixing.mix_sources(df).collect()
    assert len(got) == 90 and all(x.taken <= 3 * x.size for x in got)
    assert mixing.mix_sources(no_documents(spark)).count() == 0
    assert mixing.mixed_documents(no_documents(spark)).count() == 0


def test_mix_runs_no_job_per_shuffle_partition(spark):
    r = random.Random(8)
    docs = documents(spark, [words(r, r.randrange(20)) for _ in range(60)], [r.choice("abc") for _ in range(60)])
    want = sorted(map(tuple, mixing.mix_sources(docs).collect()))
    put = {"spark.sql.shuffle.partitions": "150", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in put}
    sc = spark.sparkContext
    sc.setJobGroup("mix of many partitions", "")
    try:
        for k, v in put.items():
            spark.conf.set(k, v)
        assert sorted(map(tuple, mixing.mix_sources(docs).collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("mix of many partitions")) < 60


# ---------------------------------------------------------------- perspectives

def brute_rotation(rows):
    convs = {}
    for c, t, role, text in set(rows):
        convs.setdefault(c, []).append((t, role or "unknown", (text or "").replace("<|", "< |")))
    out = {}
    for c, msgs in convs.items():
        msgs.sort(key=lambda m: (m[0], __import__("hashlib").md5((m[1] + "\x00" + m[2]).encode()).hexdigest()))
        for s in {m[1] for m in msgs}:
            parts = [(("<|assistant|>\n" if m[1] == s else f"<|user name={m[1]}|>\n") + m[2] + "<|end|>\n", int(m[1] == s)) for m in msgs]
            out[c, s] = ("".join(p for p, _ in parts), [len(p) for p, _ in parts], [k for _, k in parts])
    return out


@pytest.mark.parametrize("segment", [3, 256])
def test_rotation_equals_brute_force(spark, segment):
    rows = [tuple(r) for r in table(spark, "conversations").collect()]
    rows += [(1000, 0, None, None), (1000, 1, "bob", "hi <|end|> é"), (1000, 1, "ann", "tie"), (1000, 1, "ann", "tie"), (1000, 2, "bob", "")]
    rows += [(1001, 5, "ann", f"same turn {i}") for i in range(20)] + [(1002, i, "ab"[i % 2], "x" * i) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit(1)).withColumn("m", F.lit(2))
    got = {}
    for r in chat.rotate_perspectives(df, segment_turns=segment).orderBy("segment", "first_turn", F.length("sub"), "sub").collect():
        text, lengths, mask = got.get((r.conv_id, r.speaker), ("", [], []))
        got[r.conv_id, r.speaker] = (text + r.text, lengths + r.lengths, mask + r.mask)
        assert r.n_messages == len(r.mask) and r.n_trained == sum(r.mask) and sum(r.lengths) == len(r.text)
    want = brute_rotation(rows)
    assert set(got) == set(want)
    for k in want:
        if segment == 256 or k[0] != 1001:
            assert got[k] == want[k], k
        else:                                           # parts of one crowded turn: all its messages, in parts
            assert sorted(got[k][1]) == sorted(want[k][1])


def test_rotation_of_rows_without_a_dialogue(spark):
    schema = "conv_id long, turn long, role string, text string"
    got = chat.rotate_perspectives(spark.createDataFrame([(None, 0, "a", "x"), (None, 0, "b", "y"), (3, None, "a", "z")], schema)).collect()
    assert sorted((r.conv_id is None, r.speaker, r.n_messages) for r in got) == [(False, "a", 1), (True, "a", 1), (True, "b", 1)]
    assert chat.rotate_perspectives(spark.createDataFrame([], schema)).count() == 0


# ---------------------------------------------------------------- token files

TEXTS = ["The quick, brown fox!", None, "", "  \n\t", "it's DON'T 42.5% <|startoftext|>", "çà ÉTÉ ß ½ 中文 🙂 İ", "a" * 3000, "x, y. z! " * 2000,
         "<|STARTOFTEXT|>", "a\u0301 b\u00a0c\u2028d", "K\u212a"]


def plain_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_orc.default_tokenizer())
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_ids_equal_the_library_for_odd_texts():
    enc = token_orc.PieceEncoder(token_orc.default_tokenizer(), max_cache=50)
    r = random.Random(3)
    alphabet = "abcXYZ éÉßẞİK'.,!%&12 \n\t\x1c<|>Σς½²ñ中🙂\u0301×÷ÿÀ-()/;:"
    cases = [t or "" for t in TEXTS] + ["".join(r.choice(alphabet) for _ in range(r.randrange(30))) for _ in range(3000)]
    assert [enc(t).tolist() for t in cases] == [ids[:-1] for ids in plain_ids(cases)]


def test_token_files_round_trip(spark, tmp_path):
    docs = documents(spark, TEXTS).repartition(3)
    path = str(tmp_path / "tokens")
    got = token_orc.token_orc_roundtrip(docs, path=path).orderBy("doc_id").collect()
    start = 0
    for r, ids in zip(got, plain_ids(TEXTS)):
        raw = np.array(ids, "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(raw))
        start += len(ids)
    stored = token_orc.read_token_orc(spark, path)
    assert {r.doc_id: r.ids for r in stored.collect()} == dict(enumerate(plain_ids(TEXTS)))
    # min/max and Bloom filters reach the reader as pushed predicates
    plan = stored.where("doc_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,3)]" in plan
    import pyarrow.orc as orc
    f = next(os.path.join(path, x) for x in os.listdir(path) if x.endswith(".orc"))
    assert orc.ORCFile(f).row_index_stride == 1000


def rows_scanned(df):
    """Rows that the file scan of ``df`` handed on."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_row_groups_are_skipped_by_index_and_bloom_filter(spark, tmp_path):
    docs = spark.range(0, 40_000, 2).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    path = str(tmp_path / "tokens")
    token_orc.write_token_orc(docs, path, partitions=1)
    stored = token_orc.read_token_orc(spark, path)
    assert rows_scanned(stored) == 20_000
    there = stored.where("doc_id = 12344")
    assert rows_scanned(there) <= 2_000 and there.count() == 1            # the row index leaves one row group
    # ids between the stored ones lie within the ranges, so only the Bloom filter can rule their row groups out
    absent = [rows_scanned(stored.where(f"doc_id = {i}")) for i in range(1001, 39_001, 4000)]
    assert sum(a == 0 for a in absent) >= len(absent) - 1


def test_token_files_of_repeated_null_and_no_ids(spark):
    df = documents(spark, ["a b", "a b", "c"]).withColumn("doc_id", F.when(F.col("doc_id") < 2, 7))
    got = sorted(((r.doc_id, r.start, r.n_tokens) for r in token_orc.token_orc_roundtrip(df).collect()), key=lambda r: r[1])
    assert got == [(None, 0, 2), (7, 2, 3), (7, 5, 3)]
    assert token_orc.token_orc_roundtrip(no_documents(spark)).count() == 0


# ---------------------------------------------------------------- queries and pipeline

def test_queries_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == sorted(cur.fetchall(), key=repr)


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = table(spark, "documents")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        rows_in = {r.doc_id: r.text for r in before.collect()}
        rows_out = docs.collect()
        seen.append((name, len(rows_in), len(rows_out)))
        if name == "toxicity":
            scored = toxicity.score_documents(before, table(spark, "labels")).where("predicted = 0")
            assert sorted(r.doc_id for r in rows_out) == sorted(r.doc_id for r in scored.collect())
        elif name == "ngram_jaccard":
            ids = sorted(rows_in)
            stay = {ids[c] for _, _, c in components([rows_in[i] for i in ids])}
            assert sorted(r.doc_id for r in rows_out) == sorted(stay)
        elif name == "decontamination":
            leaks = {r.doc_id for r in decontam.find_leaks(before, table(spark, "benchmark")).collect()}
            assert {r.doc_id for r in rows_out} == set(rows_in) - leaks
        elif name == "source_mix":
            want = {r.doc_id: r.copies for r in mixing.mix_sources(before).collect() if r.copies}
            got = {}
            for r in rows_out:
                got[r.doc_id] = got.get(r.doc_id, 0) + 1
            assert got == want
        else:
            ids = plain_ids([r.text for r in before.orderBy("doc_id").collect()])
            assert [r.n_tokens for r in sorted(rows_out, key=lambda r: r.start)] == [len(x) for x in ids]
            assert {c for c in docs.columns} == {"doc_id", "start", "n_tokens", "ids_crc32"}
    assert [n for n, _, _ in seen] == ["toxicity", "ngram_jaccard", "decontamination", "source_mix", "token_files"]
    run = corpus_pipeline.run(spark, SF)
    assert run.count() == seen[-1][2]
