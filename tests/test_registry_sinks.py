import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import registry as reg
from tidemark.sinks import (append_blast_history, overwrite_from_self, read_csv, read_versioned, write_audience_lists, write_csv, write_feed,
                            write_registry)
from tests.conftest import rows


def _registry(spark):
    return spark.createDataFrame([("k1", "a1", "c1"), ("k1", "a2", "c1"), ("k2", "b1", "c2"), (None, "z", "cz")],
                                 reg.REGISTRY_SCHEMA)


def test_customization_replace_and_lookup(spark):
    r1 = reg.customization_replace(_registry(spark), "k1", "c9", ["n1", "n2", "n3"])
    r2 = reg.customization_replace(r1, "k1", "c9", ["n1", "n2", "n3"])
    assert rows(r1) == rows(r2)                                  # replacing twice == once
    assert rows(r1.where("customization_id = 'k2' or customization_id is null")) == rows(
        _registry(spark).where("customization_id = 'k2' or customization_id is null"))   # other keys untouched
    assert rows(reg.customization_lookup(r1, "k1")) == [("n1", "c9"), ("n2", "c9"), ("n3", "c9")]
    ids = spark.createDataFrame([("d1",)], "audience_id string")
    assert rows(reg.customization_lookup(reg.customization_replace(r1, "k1", "c10", ids), "k1")) == [("d1", "c10")]


def test_lookup_unknown_key_raises(spark):
    with pytest.raises(ValueError):
        reg.require_customization(reg.customization_lookup(_registry(spark), "nope"), "nope")
    assert reg.require_customization(reg.customization_lookup(_registry(spark), "k2"), "k2").count() == 1


def test_ids():
    assert reg.customization_id("HK") == "lc_fprp_notification_hk"
    assert reg.campaign_id(dt.date(2024, 1, 10), "cn") == "lc_fprp_notification_20240110_cn"


def test_layout_tables(spark):
    grids = reg.layout_grid_table(spark)
    slots = reg.layout_slots(grids)
    assert slots.count() == 2 * 2 * 8
    assert rows(slots.where("region='hk' and version='male' and row=2"), "col", "bu") == [
        (1, "HL"), (2, "MW"), (3, "HL"), (4, "MW")]
    summary = {(r.region, r.version): (r.rows, r.bus) for r in reg.layout_summary(grids).collect()}
    assert summary[("hk", "female")] == (2, ["WW", "LSA", "HL", "COS"])


def test_campaign_version_table(spark):
    grouped = spark.createDataFrame([("1", "Male"), ("2", "Female"), ("3", "Female")], "vip_no string, `group` string")
    versions = reg.audience_versions(grouped, dt.date(2024, 1, 10), "hk")
    t = {r.version_id: r for r in reg.campaign_version_table(versions, "hk").collect()}
    assert set(t) == {"male", "female"}
    m = t["male"]
    assert m.audience_id == "lc_fprp_notification_20240110_hk_male"
    assert (m.campaign_name, m.ab_testing, m.utm_medium, m.status, m.layout_rows, m.layout_cols) == (
        "fprp_notification", True, "email", "Enabled", 2, 4)


def test_append_history_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "history")
    d1, d2 = dt.date(2024, 1, 3), dt.date(2024, 1, 10)
    run1 = spark.createDataFrame([("v1", d1, "hk"), ("v2", d1, "hk"), ("v3", d1, "cn")],
                                 "vip_no string, blast_date date, region string")
    run2 = spark.createDataFrame([("v1", d2, "hk")], "vip_no string, blast_date date, region string")
    both = [("hk", d1), ("cn", d1)]
    assert append_blast_history(run1, path, both)
    append_blast_history(run1, path, both)                # re-run of the same blast
    append_blast_history(run2, path, [("hk", d2)])
    assert not append_blast_history(run2, path, [("hk", d2)], test=True)
    got = read_versioned(spark, path)
    assert got.count() == 4
    assert got.where(F.col("blast_date") == d1).count() == 3


def test_registry_sink_replaces_one_key(spark, scratch):
    path = os.path.join(scratch, "registry")
    for key, campaign, ids in (("k1", "c1", ["a1", "a2"]), ("k2", "c2", ["b1"]), ("k1", "c9", ["n1"])):
        write_registry(spark, path, key, campaign, ids)
    read = lambda: rows(read_versioned(spark, path), "customization_id", "audience_id", "campaign_id")
    assert read() == [("k1", "n1", "c9"), ("k2", "b1", "c2")]
    write_registry(spark, path, "k1", "c10", [])              # nothing new: the key's old rows go all the same
    assert read() == [("k2", "b1", "c2")]


def test_audience_lists_leave_no_stale_group(spark, scratch):
    schema, path = "vip_no string, `group` string", os.path.join(scratch, "aud")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")     # whatever the session says
    try:
        write_audience_lists(spark.createDataFrame([("1", "Male"), ("2", "Female")], schema), path)
        assert rows(spark.read.parquet(path), "vip_no", "group") == [("1", "Male"), ("2", "Female")]
        write_audience_lists(spark.createDataFrame([("3", "Female")], schema), path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert rows(spark.read.parquet(path), "vip_no", "group") == [("3", "Female")]


def test_overwrite_from_self(spark, scratch):
    path = os.path.join(scratch, "table")
    spark.range(10).write.parquet(path)
    grown = spark.read.parquet(path).unionByName(spark.read.parquet(path).select((F.col("id") + 10).alias("id")))
    overwrite_from_self(grown, path)
    assert rows(spark.read.parquet(path)) == sorted([(i,) for i in range(20)], key=repr)
    assert os.listdir(scratch) == ["table"]                   # no staging or old folder left


def test_failed_rewrite_leaves_a_readable_table(spark, scratch, monkeypatch):
    from tidemark.sinks import writers
    path = os.path.join(scratch, "table")
    spark.range(10).write.parquet(path)
    bad = spark.read.parquet(path).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))
    with pytest.raises(Exception):
        overwrite_from_self(bad, path)                        # fails while the new rows are written
    assert spark.read.parquet(path).count() == 10
    real, calls = writers._rename, []

    def fail_second(spark_, source, target):
        calls.append(target)
        if len(calls) == 2:
            raise OSError("stop")                             # fails between the two renames
        real(spark_, source, target)

    monkeypatch.setattr(writers, "_rename", fail_second)
    with pytest.raises(OSError):
        overwrite_from_self(spark.read.parquet(path).limit(3), path)
    assert spark.read.parquet(path).count() == 10


def test_catalog_table_by_computed_name(spark):
    from tidemark.sinks import overwrite_table
    from tidemark.sources.tables import campaign_output_name, campaign_table
    name = campaign_output_name("lc_fprp_notification_20240110_hk", "female")
    try:
        overwrite_table(spark.createDataFrame([("1", "a")], "vip_no string, x string"), name)
        old = campaign_table(spark, "lc_fprp_notification_20240110_hk", "female")
        overwrite_table(old.unionByName(old.withColumn("vip_no", F.lit("2"))), name)      # computed from itself
        assert rows(campaign_table(spark, "lc_fprp_notification_20240110_hk", "female")) == [("1", "a"), ("2", "a")]
        assert [t.name for t in spark.catalog.listTables() if "staging" in t.name or "__old" in t.name] == []
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


AWKWARD = ['5" plate, "x"', " lead and trail ", "line\nbreak", "a,b", "", None, "back\\slash", "'single'", "umlaut ä"]


def test_csv_text_comes_back_unchanged(spark, scratch):
    path = os.path.join(scratch, "feed")
    write_csv(spark.createDataFrame([(i, t) for i, t in enumerate(AWKWARD)], "i int, t string"), path)
    got = {r.i: r.t for r in read_csv(spark, path, "i int, t string").collect()}
    assert [got[i] for i in range(len(AWKWARD))] == AWKWARD
    plain = {}
    for f in sorted(os.listdir(path)):
        if f.endswith(".csv"):
            with open(os.path.join(path, f), newline="", encoding="utf-8") as h:
                plain.update({int(r["i"]): r["t"] for r in csv.DictReader(h)})
    assert [plain[i] for i in range(len(AWKWARD))] == [t or "" for t in AWKWARD]       # any standard reader


def test_feed_order(spark, scratch):
    path = os.path.join(scratch, "feed")
    feed = spark.range(500).select((F.col("id") * 7919 % 500).cast("string").alias("customer_id"), (F.col("id") % 8).alias("display_id"))
    write_feed(feed.repartition(5), path, ["customer_id", "display_id"])
    lines = []
    for f in sorted(x for x in os.listdir(path) if x.endswith(".csv")):
        with open(os.path.join(path, f), newline="") as h:
            lines += [(r["customer_id"], int(r["display_id"])) for r in csv.DictReader(h)]
    assert lines == sorted(lines) and len(lines) == 500


def test_id_tokens_and_list_parameters(spark):
    from tidemark.functions.ids import id_token
    df = spark.createDataFrame([("lc_fprp_notification_20240110_hk_male",)], "a string")
    assert df.select(id_token("a", -1), id_token("a", -3)).collect()[0][:] == ("male", "20240110")


def test_checkpoint_folder_must_be_shared(spark):
    from tidemark.session import ensure_checkpoint_dir

    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        conf = {}

        def __init__(self, master):
            self.sparkContext = Context(master)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,512]"):
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(Session(master))


def test_rewritten_table_is_read_with_its_new_columns(spark, scratch):
    from tidemark.sources.relations import Tables
    spark.range(2).withColumnRenamed("id", "a").write.parquet(f"{scratch}/part.parquet")
    assert Tables(spark, scratch).part.columns == ["a"]
    spark.range(2).selectExpr("id as b", "id as c").write.mode("overwrite").parquet(f"{scratch}/part.parquet")
    assert rows(Tables(spark, scratch).part, "b", "c") == [(0, 0), (1, 1)]


def test_cluster_conf_bounds():
    from tidemark.session import cluster_conf
    small = cluster_conf(10 << 20, 8, waves=1)
    assert small["spark.sql.shuffle.partitions"] == "8"
    big = cluster_conf(10 * (1 << 40), 4000)          # 10 TiB shuffle on 4000 cores
    assert big["spark.sql.shuffle.partitions"] == str(40960)
    huge = cluster_conf(100 * (1 << 40), 8000)
    assert huge["spark.sql.shuffle.partitions"] == "50000"
    assert big["spark.sql.autoBroadcastJoinThreshold"] == huge["spark.sql.autoBroadcastJoinThreshold"]


def test_broadcast_if_small(spark):
    from tidemark.functions import broadcast_if_small, estimated_bytes
    small = spark.range(10).selectExpr("id as k", "'a' as v")
    assert estimated_bytes(small) < 1 << 20
    unknown = spark.createDataFrame([(1, "a")], "k bigint, v string")   # no statistics: never hinted
    assert "broadcast" not in str(broadcast_if_small(unknown)._jdf.queryExecution().optimizedPlan()).lower()
    big = spark.range(10 ** 7).selectExpr("id as k", "repeat('x', 100) as v")
    assert estimated_bytes(big) > 64 << 20
    left = spark.range(100).selectExpr("id as k")
    hinted = left.join(broadcast_if_small(small), "k")._jdf.queryExecution().optimizedPlan().toString()
    plain = left.join(broadcast_if_small(big), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_version_pairs_and_json(spark):
    import json
    pairs = reg.version_pairs(spark, "camp", "female,male", "camp_female,camp_male")
    assert rows(pairs) == [("camp", "female", "camp_female"), ("camp", "male", "camp_male")]
    short = reg.version_pairs(spark, "camp", ["female", "male"], ["camp_female"])
    assert rows(short) == [("camp", "female", "camp_female")]
    docs = [json.loads(r.json) for r in reg.config_json(reg.campaign_version_table(pairs, "cn")).collect()]
    assert {d["version_id"] for d in docs} == {"female", "male"} and all(d["region"] == "cn" for d in docs)
