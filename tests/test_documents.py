import json
import random

from pyspark.sql import functions as F

from tidemark.operators import documents, registry as reg
from tidemark.sinks import read_documents, write_documents
from tests.conftest import rows

NOW = 1_700_000_000


def _versions(spark, pairs, region="hk", campaign="lc_x_20240110_hk"):
    frame = spark.createDataFrame([(campaign, v, a) for v, a in pairs], "campaign_id string, version_id string, audience_id string")
    return reg.campaign_version_table(frame, region, "lists/items.csv")


def _cells(spark, shuffled=False):
    cells = reg.layout_slots(reg.layout_grid_table(spark))
    if shuffled:
        data = cells.collect()
        random.Random(2).shuffle(data)
        cells = spark.createDataFrame(data, cells.schema).repartition(5)
    return cells


def test_layout_regrouped_in_its_own_order(spark):
    wide = {"hk": {"female": [[f"{r}.{c}" for c in range(12)] for r in range(11)]}}     # 10 sorts after 9, not after 1
    cells = reg.layout_slots(reg.layout_grid_table(spark, wide)).orderBy(F.rand(4))
    got = documents.layout_grids(cells).collect()
    assert [(g.region, g.version_id, g.products) for g in got] == [("hk", "female", wide["hk"]["female"])]


def test_version_document(spark):
    got = documents.version_documents(_versions(spark, [("female", "aud_f"), ("male", "aud_m")]), _cells(spark, shuffled=True), NOW)
    docs = {r.file: json.loads(r.document) for r in got.collect()}
    assert set(docs) == {"version_female.json", "version_male.json"}
    male = docs["version_male.json"]
    assert {k: male[k] for k in ("id", "name", "status", "created_at", "updated_at")} == {
        "id": "male", "name": "male", "status": "Enabled", "created_at": NOW, "updated_at": NOW}
    v = male["version"]
    assert v["audience"] == {"include": ["aud_m"]} and v["subject_line"] == ["Hi"]
    assert v["product_sorting"] == {"col": 4, "row": 2, "products": reg.PRODUCT_SORTINGS["hk"]["male"]}
    assert v["product"] == {"global": {"filters": {}}, "bu": {"MW": {}, "MSA": {}, "HL": {}}, "list": {"type": "csv", "path": "lists/items.csv"}}
    assert list(v["product"]["bu"]) == ["MW", "MSA", "HL"]                               # first seen first


def test_campaign_document(spark):
    got = documents.campaign_documents(_versions(spark, [("male", "m"), ("female", "f"), ("male", "m2")], region="cn"), NOW).collect()
    assert [r.file for r in got] == ["campaign.json"]
    campaign = json.loads(got[0].document)["campaign"]
    assert campaign["versions"] == ["female", "male"] and campaign["ab_testing"] is True
    assert (campaign["region"], campaign["utm_source"], campaign["updated_at"]) == ("cn", "cn", NOW)


def test_defined_cases(spark):
    """No layout, no audience id, null version, quotes in names, no version at all."""
    versions = _versions(spark, [('new "line"', None), (None, "a")])
    got = documents.version_documents(versions, _cells(spark), NOW).collect()
    assert [r.file for r in got] == ['version_new "line".json']
    v = json.loads(got[0].document)["version"]
    assert v["name"] == 'new "line"' and v["audience"] == {"include": []}
    assert v["product_sorting"] == {"col": 4, "row": 0, "products": []} and v["product"]["bu"] == {}
    assert documents.configuration_documents(versions.limit(0), _cells(spark), NOW).count() == 0


def test_written_and_read_back(spark, scratch):
    docs = documents.configuration_documents(_versions(spark, [("female", "f")]), _cells(spark), NOW)
    other = documents.configuration_documents(_versions(spark, [("male", "m")], "cn", "lc_x_20240110_cn"), _cells(spark), NOW)
    path = scratch + "/documents"
    for frame in (docs, other, docs):                     # a second campaign beside the first, and a re-run
        write_documents(frame, path)
    assert rows(read_documents(spark, path)) == rows(docs.unionByName(other))


def test_run_parameters_make_documents(spark):
    """The scheduler's comma-separated lists, paired by position."""
    pairs = reg.version_pairs(spark, "lc_x_20240110_hk", "female,male", "aud_1,aud_2")
    got = documents.version_documents(reg.campaign_version_table(pairs, "hk"), _cells(spark), NOW).collect()
    found = {r.file: json.loads(r.document)["version"]["audience"]["include"] for r in got}
    assert found == {"version_female.json": ["aud_1"], "version_male.json": ["aud_2"]}
