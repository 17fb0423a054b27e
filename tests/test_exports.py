"""Upload files of many parts, the one-pass quality split, version tables found by name."""

import csv
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_registry_sinks import AWKWARD
from tidemark import sinks
from tidemark.operators import blast as bl
from tidemark.sinks import versioned
from tidemark.sources.tables import campaign_output_name, campaign_outputs


def one_file(path):
    manifest = json.load(open(os.path.join(path, "manifest.json")))
    out = b""
    for e in manifest["files"]:
        data = open(os.path.join(path, e["file"]), "rb").read()
        assert len(data) == e["bytes"] and hashlib.sha256(data).hexdigest() == e["sha256"]
        out += data
    assert len(out) == manifest["bytes"]
    return out.decode(), manifest


def test_parts_in_order_are_the_sorted_file(spark, scratch):
    path = os.path.join(scratch, "feed.csv")
    feed = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("string").alias("customer_id"), (F.col("id") % 8).alias("display_id"),
                                    F.lit('a,"b"\nc').alias('odd "name", x'))
    sinks.write_upload(feed.repartition(7), path, ["customer_id", "display_id"], rows_per_part=600)
    text, manifest = one_file(path)
    got = list(csv.reader(text.splitlines(keepends=True)))
    assert got[0] == feed.columns and len(got) == 5001 and manifest["rows"] == 5000
    keys = [(r[0], int(r[1])) for r in got[1:]]
    assert keys == sorted(keys) and all(r[2] == 'a,"b"\nc' for r in got[1:])
    assert len(manifest["files"]) > 8 and max(e["rows"] for e in manifest["files"]) <= 600
    assert text.count("customer_id") == 1                                    # one header
    assert rows(sinks.read_upload(spark, path, feed.schema)) == rows(feed)
    sinks.write_upload(feed.limit(3), path, ["customer_id"])                  # a re-run replaces the export
    assert len(one_file(path)[0].splitlines()) == 1 + 2 * 3


def test_text_and_empty_feed(spark, scratch):
    path = os.path.join(scratch, "feed.csv")
    feed = spark.createDataFrame(list(enumerate(AWKWARD)), "i int, t string")
    sinks.write_upload(feed, path, ["i"])
    got = {int(r["i"]): r["t"] for r in csv.DictReader(one_file(path)[0].splitlines(keepends=True))}
    assert [got[i] for i in range(len(AWKWARD))] == [t or "" for t in AWKWARD]
    assert rows(sinks.read_upload(spark, path, feed.schema)) == rows(feed)
    sinks.write_upload(feed.limit(0), path)
    assert one_file(path)[0] == "i,t\n" and sinks.read_upload(spark, path, feed.schema).count() == 0


def test_an_unfinished_export_is_no_file(spark, scratch):
    path = os.path.join(scratch, "feed.csv")
    bad = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))
    with pytest.raises(Exception):
        sinks.write_upload(bad, path)
    with pytest.raises(FileNotFoundError):
        sinks.upload_files(spark, path)


def checked(spark, n_bad):
    good = "|".join(f"c{i:05d}" for i in range(8))
    data = [(str(i), good) for i in range(20)] + [(f"b{i}", None if i % 2 else good[:-7]) for i in range(n_bad)]
    return bl.quality_marked(spark.createDataFrame(data, "vip_no string, atg_code string"))


def test_quality_split(spark, scratch):
    path = os.path.join(scratch, "checked")
    assert sinks.write_quality_split(checked(spark, 3), path) == {"accepted": 20, "rejected": 3}
    side = lambda a: rows(sinks.read_versioned(spark, path, where={"accepted": a}), "vip_no", "valid_codes")
    assert side(False) == [("b0", 7), ("b1", 0), ("b2", 7)] and len(side(True)) == 20
    with pytest.raises(ValueError):                                          # over the threshold: nothing is committed
        sinks.write_quality_split(checked(spark, 5), path, max_rejects=4)
    assert len(side(False)) == 3 and versioned.current_version(spark, path) == 1
    sinks.write_quality_split(checked(spark, 0), path, max_rejects=0)
    assert side(False) == [] and len(side(True)) == 20


def test_quality_split_runs_the_list_once(spark, scratch):
    """Every row of the list is evaluated once for both sides and both counts."""
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    listed = spark.range(100).select(F.col("id").cast("string").alias("vip_no"), F.lit("x").alias("atg_code"))
    marked = bl.quality_marked(listed.mapInArrow(touch, listed.schema))
    sinks.write_quality_split(marked, os.path.join(scratch, "checked"))
    assert seen.value == 100


def test_campaign_outputs(spark, scratch):
    spark.sql(f"CREATE SCHEMA camp LOCATION '{scratch}/camp'")
    try:
        one = spark.createDataFrame([("1", 5)], "vip_no string, score int")
        for camp, group, df in (("lc_x_20240110_hk", "female", one), ("lc_x_20240110_hk", "male", one.select("score", "vip_no")),
                                ("lc_x_20240117_cn", "female", one.drop("score").withColumn("new", F.lit(True)))):
            df.write.saveAsTable(campaign_output_name(camp, group, "camp"))
        one.write.saveAsTable("camp.campaign_lc_x_20240110_hk_items")
        got = campaign_outputs(spark, "camp")
        assert rows(got.select("campaign_id", "version", F.col("blast_date").cast("string"), "campaign_region", "vip_no", "score", "new")) == sorted([
            ("lc_x_20240110_hk", "female", "2024-01-10", "hk", "1", 5, None), ("lc_x_20240110_hk", "male", "2024-01-10", "hk", "1", 5, None),
            ("lc_x_20240117_cn", "female", "2024-01-17", "cn", "1", None, True)], key=repr)
        assert campaign_outputs(spark, "camp", "lc_x_20240117_cn").count() == 1
        with pytest.raises(ValueError):
            campaign_outputs(spark, "camp", "none")
    finally:
        spark.sql("DROP SCHEMA camp CASCADE")
