"""WARC gzip normaliser (12)."""

import glob
import gzip
import hashlib
import io
import json
import random
import zlib

import pytest

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("bytes", "digest", "head", "value", "n", "d", "archive"):
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df.selectExpr("*", "1 as `odd.name`")


def brute(rows):
    bodies = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, b in bodies:
        same = [j for j, c in bodies if c == b and j is not None]
        revisit = len(b) >= 1000 and same and (i is None or i < max(same))
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=repr)


def sample():
    r = random.Random(4)
    base = [None, "", "a", "é" * 499, "é" * 500, "x" * 999, "x" * 1000, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40,
            "\r\n\r\n" * 600, "z" * 3_000_000, "".join(chr(r.randrange(32, 1000)) for _ in range(1_200_000))]
    rows = [(i, r.choice([None, "", "http://a/b c\r\nX: y", "http://é.example/"]), r.choice(base[:9])) for i in range(80)]
    rows += [(100 + i, "u", b) for i, b in enumerate(base)] + [(None, "u", "x" * 1000), (None, None, "only" * 300), (7, "again", rows[7][2]), (110, "u", base[10])]
    return rows


def test_equals_brute_force(spark):
    rows = sample()
    got = sorted((tuple(r) for r in warc.archive_pages(pages(spark, rows)).collect()), key=repr)
    assert got == brute(rows)


def test_members_index_and_payloads(spark, scratch):
    """Every member is a gzip file of its own at its offset; the index covers the archive; payloads come back."""
    rows = sample()
    warc.write_monolithic(pages(spark, rows), f"file:{scratch}/whole")
    index = warc.normalise(spark, f"file:{scratch}/whole", f"file:{scratch}/members")
    for whole in glob.glob(f"{scratch}/whole/*.gz"):
        d = zlib.decompressobj(31)
        text = d.decompress(open(whole, "rb").read())
        assert d.eof and not d.unused_data                                    # one stream before
        name = whole.rsplit("/", 1)[1].removesuffix(".txt.gz")
        data = open(f"{scratch}/members/{name}.warc.gz", "rb").read()
        assert gzip.decompress(data) == text                                  # the same bytes after
        at = 0
        for entry in map(json.loads, open(f"{scratch}/members/{name}.cdxj")):
            assert entry["offset"] == at
            record = zlib.decompress(data[at:at + entry["length"]], 31)
            assert record.startswith(b"WARC/1.1\r\n") and entry["record_id"].encode() in record and record.endswith(b"\r\n\r\n")
            at += entry["length"]
        assert at == len(data)
    assert index.count() == len(rows)
    got = warc.read_records(index, payload=True).collect()
    assert sorted(bytes(r.payload) for r in got if r.record_type == "response") == sorted(
        (h or "").encode() for (i, _, h), b in zip(rows, [brute_type(rows, x) for x in rows]) if b == "response")
    assert all(r.payload == b"" for r in got if r.record_type == "revisit")
    assert all("\r" not in r.target_uri and " " not in r.target_uri for r in got)


def brute_type(rows, row):
    body = (row[2] or "").encode()
    same = [i for i, _, h in rows if (h or "").encode() == body and i is not None]
    return "revisit" if len(body) >= 1000 and same and (row[0] is None or row[0] < max(same)) else "response"


def test_files_rerun_and_already_normal(spark, scratch):
    """A second run over the same files, and one over its own output, give the same index."""
    warc.write_monolithic(pages(spark, sample()[:30]), f"file:{scratch}/whole")
    first = sorted(map(tuple, warc.normalise(spark, f"file:{scratch}/whole", f"file:{scratch}/a").collect()))
    assert sorted(map(tuple, warc.normalise(spark, f"file:{scratch}/whole", f"file:{scratch}/a").collect())) == first
    again = warc.normalise(spark, f"file:{scratch}/a", f"file:{scratch}/b").collect()
    assert sorted(tuple(r)[1:] for r in again) == sorted(t[1:] for t in first)
    assert not [p for p in glob.glob(f"{scratch}/a/*") if "/_" in p]


def record(payload=b"p", length=None):
    return b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(payload) if length is None else length, payload)


def rewritten(data):
    out = io.BytesIO()
    return list(warc.rewrite(io.BytesIO(data).read, out.write)), out.getvalue()


def test_streams(monkeypatch):
    for chunk in (1, 7, 1 << 20):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        plain = record(b"") + record(b"\r\n\r\n") + record(b"\0" * 5000)
        entries, data = rewritten(gzip.compress(plain))
        assert [e["payload_bytes"] for e in entries] == [0, 4, 5000] and gzip.decompress(data) == plain
        mixed = gzip.compress(record(b"1")) + b"\0" * 9 + gzip.compress(record(b"2") + record(b"3"))
        entries, data = rewritten(mixed)
        assert len(entries) == 3 and gzip.decompress(data) == record(b"1") + record(b"2") + record(b"3")
        assert rewritten(b"") == ([], b"")


@pytest.mark.parametrize("bad", [gzip.compress(record(b"abc"))[:-12], gzip.compress(record(b"abc", 2)), gzip.compress(record(b"abc", 9)), gzip.compress(b"no header")])
def test_broken_streams_are_errors(bad):
    with pytest.raises(ValueError):
        rewritten(bad)


def test_inflated_chunks_stay_small():
    """A stream that inflates a thousandfold is held a chunk at a time."""
    stream = warc.Inflated(io.BytesIO(gzip.compress(b"\0" * 50_000_000)).read)
    most = 0
    while stream.more():
        most = max(most, len(stream.buffer))
        stream.take(len(stream.buffer))
    assert most <= warc.CHUNK


def test_empty_table(spark):
    assert warc.archive_pages(pages(spark, [(1, "u", "h")]).limit(0)).collect() == []
