import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from cinestrata.llm import warc


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) of (page_id, url, html) rows."""
    first = {}
    for d, _, h in rows:
        first[h or ""] = max(first.get(h or "", -1), -1 if d is None else d)
    out = []
    for d, _, h in rows:
        h, f = h or "", first[h or ""]
        response = d == f or f == -1
        out.append((d, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(),
                    "response" if response else "revisit", None if response else f))
    return sorted(out, key=str)


ROWS = [(i, f"http://a/{i}", f"<p>é {i % 7}</p>" * (i % 5 + 1)) for i in range(300)] + [
    (300, None, None), (301, "http://b\r\nX: y", ""), (None, "u", "solo"), (None, "v", "<p>é 1</p>"),
    (302, "w", "x" * 300_000), (302, "w", "x" * 300_000), (2**62, "é ü", "far")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows],
                                 "page_id long, url string, html string, sha int")


def test_written_records_come_back(spark, root):
    manifest = warc.write_archives(frame(spark, ROWS), root, shard_bytes=20_000, file_bytes=2_000)
    got = sorted(map(tuple, warc.read_archives(spark, root).collect()), key=str)
    assert got == brute(ROWS)
    files = manifest.collect()
    assert len({r.shard for r in files}) > 3 and max(r.part for r in files) > 0
    assert sum(r.records for r in files) == len(ROWS)
    for r in files:
        data = open(f"{root}/{r.file}", "rb").read()
        assert len(data) == r.bytes and hashlib.sha256(data).hexdigest() == r.sha256
        assert gzip.decompress(data).count(b"WARC/1.0\r\n") == r.records


def test_same_files_whatever_the_partitions(spark, root):
    one = warc.write_archives(frame(spark, ROWS).repartition(3), root + "/a", 20_000, 2_000)
    two = warc.write_archives(frame(spark, ROWS[::-1]).repartition(17), root + "/b", 20_000, 2_000)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_small_payloads_stay_responses(spark, root):
    warc.write_archives(frame(spark, [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyy"),
                                      (4, "d", "yyyy")]), root, least_bytes=3)
    got = {r.page_id: r.record_type for r in warc.read_archives(spark, root).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_renaming_may_run_again(spark, root):
    manifest = warc.write_archives(frame(spark, ROWS[:20]), root)
    pending = spark.read.parquet(f"{root}/_pending")
    assert pending.mapInArrow(warc._renamer(root), warc._FILES).count() == manifest.count()


def test_damage_is_found():
    data = warc.record(1, "u", b"payload", warc.base32_digest(hashlib.sha1(b"payload").hexdigest()),
                       None, False)
    assert [warc.parsed(m)[0] for m in warc.members(io.BytesIO(data * 3))] == [1, 1, 1]
    with pytest.raises(ValueError):
        warc.parsed(gzip.decompress(data).replace(b"payload\r\n", b"paylaod\r\n"))
    with pytest.raises((ValueError, EOFError)):
        list(warc.members(io.BytesIO(data[:-9])))


def test_empty_table(spark, root):
    assert warc.write_archives(frame(spark, ROWS).limit(0), root).count() == 0
    assert warc.read_archives(spark, root).count() == 0


def test_places_equal_a_look_at_every_bound(spark):
    bounds = [(None, "b"), (None, "d"), (1, "a"), (1, "c"), (5, "a"), (2**62, "x")]
    order = lambda k: (k[0] is not None, k[0] or 0, k[1])
    keys = [(p, s) for p in (None, 0, 1, 2, 5, 2**62, 2**62 + 1) for s in "abcdxz"]
    df = spark.createDataFrame(keys, "page_id long, sha string")
    for n in range(1, len(bounds) + 1):
        got = df.select("page_id", "sha", warc.place_among(
            bounds[:n], F.col("page_id"), F.col("sha")).alias("at")).collect()
        for r in got:
            assert r["at"] == sum(order(b) <= order((r.page_id, r.sha)) for b in bounds[:n])


def test_rows_of_one_id_or_none_fill_several_shards_and_tasks_hold_runs(spark, root, monkeypatch):
    rows = [(None if i % 2 else 7, f"u{i}", f"{i}" * 500) for i in range(200)]
    monkeypatch.setattr(warc, "TASKS", 4)
    manifest = warc.write_archives(frame(spark, rows), root, shard_bytes=20_000).collect()
    assert len({r.shard for r in manifest}) > 8
    assert sum(r.records for r in manifest) == 200
    assert sorted(map(tuple, warc.read_archives(spark, root).collect()), key=str) == brute(rows)
