"""What the operators leave in the shared checkpoint folder."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import SF, documents, table
from tidemark.llm import decontam, mixing, ngram_join, repair, suffix_dedup, token_orc, toxicity, url_filter
from tidemark.llm.common import pin, pins
from tidemark.session import ensure_checkpoint_dir


def folders(spark):
    return set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))


@pytest.mark.parametrize("run,left", [
    (lambda s: ngram_join.near_duplicate_components(table(s, "documents")), 2),
    (lambda s: ngram_join.near_duplicate_components(table(s, "documents"), block_docs=2), 2),
    (lambda s: ngram_join.drop_near_duplicates(table(s, "documents")), 2),
    (lambda s: suffix_dedup.remove_repeats(table(s, "documents")), 1),
    (lambda s: token_orc.token_orc_roundtrip(table(s, "documents")), 1),
    (lambda s: repair.repair_conversations(table(s, "conversations")), 1),
    (lambda s: toxicity.drop_toxic(table(s, "documents"), table(s, "labels")), 0),
    (lambda s: decontam.drop_leaks(table(s, "documents"), table(s, "benchmark")), 1),
    (lambda s: mixing.mixed_documents(table(s, "documents")), 0),
    (lambda s: url_filter.filter_urls(table(s, "pages")), 1),
    (lambda s: corpus_pipeline.run(s, SF), 1),
])
def test_only_what_the_result_reads_is_left(spark, run, left):
    before = folders(spark)
    out = run(spark)
    assert len(folders(spark) - before) == left
    rows = out.count()
    assert rows > 0 and out.count() == rows


def test_pins_are_kept_dropped_and_freed_on_errors(spark):
    before = folders(spark)
    with pytest.raises(ValueError):
        with pins() as outer:
            with pins() as own:
                a, b = pin(spark.range(5)), pin(spark.range(6))
                own.drop(b)
                assert len(folders(spark) - before) == 1
                own.keep(a)
            assert a.agg(F.sum("id")).collect()[0][0] == 10
            assert outer.paths and len(folders(spark) - before) == 1
            raise ValueError
    assert folders(spark) == before
    free = pin(documents(spark, ["a", None]))
    assert "odd.name" in free.columns and free.count() == 2 and len(folders(spark) - before) == 1
