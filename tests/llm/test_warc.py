from __future__ import annotations

import base64
import hashlib
import tempfile

import pytest
from pyspark.sql import functions as F

from lakeshift.llm import warc

PAGES = "page_id long, url string, html string, row string, body string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, rows, **options):
    path = tempfile.mkdtemp(prefix="run-") + "/warc"
    warc.write(spark.createDataFrame([(*r, "r", "b") for r in rows], PAGES), path, **options)
    return warc.assemble(warc.read(spark, path)).collect()


HTML = "<p>x</p>\r\n\r\nWARC/1.1\r\nWARC-Type: request\r\n\r\n" + "é" * 9


def test_round_trip_with_edges(spark):
    rows = [(1, "http://a/x?y", HTML), (2, "http://b", HTML), (3, None, None), (4, "http://c\r\nX: y", ""), (5, "e", "y" * 300_000),
            (None, "http://n", HTML), (None, "http://n", "only"), (6, "http://d/p", "same"), (6, "http://d/p", "same")]
    found = round_trip(spark, rows)
    assert len(found) == len(rows)
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(i, largest.get(h or "", -1))
    for r in found:
        assert len(r["requests"]) == len(r["metadata"]) == 1
        assert r["record_type"] == ("response" if r["refers_to"] is None else "revisit")
    shown = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in found), key=str)
    expected = sorted(((i, len((h or "").encode()), digest(h), None if i is None and (h or "") not in largest or largest.get(h or "") == i else largest[h or ""])
                       for i, _, h in rows), key=str)
    assert shown == expected
    assert {r["payload"] for r in found if r["record_type"] == "response"} >= {HTML, "", "y" * 300_000, "only", "same"}


def test_small_payloads_are_not_revisited(spark):
    found = round_trip(spark, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], min_bytes=4)
    assert {r["page_id"]: r["refers_to"] for r in found} == {1: None, 2: None, 3: 4, 4: None}


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_assembly_reads_links_from_both_sides_and_keeps_orphans(spark):
    record = lambda rid, kind, to: (rid, kind, to, None, None, None, None, None, rid)
    rows = [record("a", "response", ["b"]), record("b", "request", []), record("c", "metadata", ["a"]), record("d", "request", ["gone"]),
            record("e", "metadata", []), record("f", "revisit", []), record("g", "request", ["f"]), record("g", "request", ["f"])]
    found = {r["capture_id"]: r for r in warc.assemble(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert [x["record_id"] for x in found["a"]["requests"]] == ["b"] and [x["record_id"] for x in found["a"]["metadata"]] == ["c"]
    assert found["gone"]["record_type"] is None and found["e"]["metadata"][0]["record_id"] == "e"
    assert [x["record_id"] for x in found["f"]["requests"]] == ["g"]


def test_broken_archives_are_refused():
    good = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <x>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [r["payload"] for r in warc.parse(good)] == ["ab"]
    for bad in (good[:-1], good.replace(b"Length: 2", b"Length: 9"), b"WORC" + good[4:]):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def test_a_stream_is_parsed_whatever_its_pieces():
    import io

    one = lambda n: b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, b"\r\n\r\nWARC/"[:1] * n)
    sizes = [0, 1, 5, 400, 0, 33, 2000]
    content = b"".join(map(one, sizes))
    for ahead in (1, 2, 3, 7, 64, 1 << 20):
        assert [len(r["payload"]) for r in warc.parse_stream(io.BytesIO(content), ahead)] == sizes
        with pytest.raises(ValueError):
            list(warc.parse_stream(io.BytesIO(content[:-1]), ahead))


def test_digest_in_sql(spark):
    texts = ["", "a", "é" * 99]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.payload_digest(F.col("t").cast("binary"))).collect()
    assert [r[0] for r in found] == [digest(t) for t in texts]


def test_large_payloads_have_archives_of_fewer_captures(spark):
    import gzip
    import pathlib

    rows = [(n, "u", f"{n} " + "a" * (n % 90)) for n in range(300)] + [(1000 + n, "u", f"{n} " + "b" * 5_000) for n in range(20)]
    rows += [(2000 + n, "u", f"{n}" + "c" * 90_000) for n in range(4)]
    path = tempfile.mkdtemp(prefix="run-") + "/warc"
    pages = spark.createDataFrame([(*r, "r", "b") for r in rows], PAGES).coalesce(1)
    warc.write(pages, path, archives=((100, 50), (10_000, 7), (None, 1)))
    held = [[r["payload_bytes"] for r in warc.parse(gzip.decompress(f.read_bytes())) if r["record_type"] in ("response", "revisit")]
            for f in pathlib.Path(path).glob("*.gz")]
    assert sorted(map(len, held)) == sorted([50] * 6 + [7, 7, 6] + [1] * 4)
    for sizes in held:
        assert len(sizes) <= (50 if max(sizes) <= 100 else 7 if max(sizes) <= 10_000 else 1)
    found = warc.assemble(warc.read(spark, path)).collect()
    assert sorted((r["page_id"], r["payload"]) for r in found) == sorted((i, h) for i, _, h in rows)


def test_an_archive_larger_than_a_batch_is_read_in_batches(spark):
    rows = [(n, "u", f"{n}" + "d" * 50_000) for n in range(100)]
    path = tempfile.mkdtemp(prefix="run-") + "/warc"
    warc.write(spark.createDataFrame([(*r, "r", "b") for r in rows], PAGES).coalesce(1), path)
    records = warc.read(spark, path, batch_bytes=100_000)
    assert records.where("record_type = 'response'").count() == 100


def test_a_large_payload_does_not_bring_the_small_ones_again(spark, monkeypatch):
    given, look = [], warc.duplicates

    def noted(pages, *rest):
        given.append(sorted(r["page_id"] for r in pages.select("page_id").collect()))
        return look(pages, *rest)

    monkeypatch.setattr(warc, "duplicates", noted)
    rows = [(n, "u", "s" * (n % 3)) for n in range(9)] + [(20 + n, "u", "m" * 50) for n in range(3)] + [(30, "u", "l" * 500), (31, "u", "l" * 500)]
    found = round_trip(spark, [*rows, (40, "u", None)], archives=((10, 4), (100, 2), (None, 1)))
    assert given == [[*range(9), 40], [20, 21, 22], [30, 31]]  # each page in one pass, the one of its size
    assert {r["page_id"]: r["refers_to"] for r in found} == (
        {0: 40, 3: 40, 6: 40, 40: None, 1: 7, 4: 7, 7: None, 2: 8, 5: 8, 8: None} | {20: 22, 21: 22, 22: None, 30: 31, 31: None})


def test_only_large_payloads(spark):
    found = round_trip(spark, [(1, "u", "l" * 500), (2, "u", "l" * 500), (3, "u", "m" * 50)], archives=((10, 4), (100, 2), (None, 1)))
    assert sorted((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found) == [
        (1, "revisit", 2, 500), (2, "response", None, 500), (3, "response", None, 50)]
