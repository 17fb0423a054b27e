"""The ``opN_<name>`` queries and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, mixing, ngram_join, pii, repair, runs, suffix_dedup, token_orc, topk, toxicity, url_filter, warc
from tidemark.llm.common import read

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("op1_ngram_jaccard")
def op1(spark, sf_dir):
    return ngram_join.near_duplicate_components(read(spark, sf_dir, "documents")).drop("key", "class")


ORACLES["op1_ngram_jaccard"] = ngram_join.oracle()


@register("op2_source_mix")
def op2(spark, sf_dir):
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


@register("op6_perspective_rotation")
def op6(spark, sf_dir):
    out = chat.rotate_perspectives(read(spark, sf_dir, "conversations"))
    return out.select("conv_id", "speaker", "segment", "sub", "first_turn", "n_messages", "n_trained", "text",
                      F.array_join("lengths", ",").alias("lengths"), F.array_join("mask", ",").alias("mask"))


ORACLES["op6_perspective_rotation"] = chat.oracle()


@register("op9_token_orc")
def op9(spark, sf_dir):
    return token_orc.token_orc_roundtrip(read(spark, sf_dir, "documents"))


@register("op5_exact_topk")
def op5(spark, sf_dir):
    return topk.top_k(read(spark, sf_dir, "embeddings"))


ORACLES["op5_exact_topk"] = topk.oracle()


@register("op10_url_filter")
def op10(spark, sf_dir):
    return url_filter.filter_urls(read(spark, sf_dir, "pages")).drop("score")


ORACLES["op10_url_filter"] = url_filter.oracle()


@register("op3_toxicity")
def op3(spark, sf_dir):
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op4_pii")
def op4(spark, sf_dir):
    return pii.pii_digests(pii.find_pii(read(spark, sf_dir, "documents")))


@register("op8_suffix_dedup")
def op8(spark, sf_dir):
    out = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op8_suffix_dedup"] = suffix_dedup.oracle()


@register("op7_decontaminate")
def op7(spark, sf_dir):
    return decontam.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register("op11_structure_repair")
def op11(spark, sf_dir):
    return repair.repair_conversations(read(spark, sf_dir, "conversations"))


ORACLES["op11_structure_repair"] = repair.oracle()


@register("op12_warc")
def op12(spark, sf_dir):
    return warc.archive_pages(read(spark, sf_dir, "pages"))


ORACLES["op12_warc"] = warc.oracle()


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    return runs.run_digests(runs.periodic_runs(runs.loop_tails(read(spark, sf_dir, "documents"))))


ORACLES["op13_periodic_runs"] = runs.oracle()
