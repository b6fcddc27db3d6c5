"""Archives: round trips, a plain model of who refers to whom, chunks, and archives of other makers."""

import hashlib
import io
import json
import os
import random
import tracemalloc
import zlib

import pytest

from affinia.llm import warc
from affinia.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string, record_id string, payload string, chunk int"


def plain(pages):
    """(page_id, bytes, digest, type, refers_to) of every page."""
    held = [(i, (h or "").encode()) for i, h in pages]
    out = []
    for i, data in held:
        ids = [j for j, d in held if d == data and j is not None]
        refers = min(ids) if len(data) >= 100 and ids and i != min(ids) else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def frame(spark, pages):
    return spark.createDataFrame([(i, "http://h/ä b\r\nX: y" if n % 3 else None, h, "r", "p", 1) for n, (i, h) in enumerate(pages)], PAGES)


def trip(spark, pages, path=None):
    got = warc.round_trip(frame(spark, pages), path).collect()
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr)


def odd_pages():
    rng = random.Random(11)
    texts = ["", None, "short", "x" * 99, "x" * 100, "é" * 50, "WARC/1.1\r\n\r\n" * 30, "\r\n" * 200, "日" * 700000, "tail\r\n\r\n" * 20]
    pages = [(i, rng.choice(texts)) for i in rng.sample(range(-50, 400), 120)]
    return pages + [(900, "again " * 40), (900, "again " * 40), (901, "again " * 40), (None, "again " * 40), (None, "no id " * 40), (None, "no id " * 40)]


def test_round_trip_matches_a_plain_model(spark):
    assert trip(spark, odd_pages()) == plain(odd_pages())


def test_round_trip_of_an_empty_table(spark):
    assert trip(spark, []) == []


def test_copies_joined_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(warc, "broadcast_if_small", lambda df: df)
    assert trip(spark, odd_pages()) == plain(odd_pages())


def test_chunks_hold_the_payloads(spark, tmp_path):
    pages = [(i, "".join(random.Random(i).choices("abcé\r\n", k=n))) for i, n in enumerate([0, 1, 999, 1000, 1001, 5000, 40000])]
    path = str(tmp_path / "a")
    warc.write_records(warc.page_records(frame(spark, pages)), path, archive_bytes=300)
    rows = warc.read_chunks(spark, path, chunk_bytes=1000).collect()
    assert len({r["archive"] for r in rows}) > 2 and all(len(r["chunk"]) <= 1000 for r in rows)
    by = {}
    for r in sorted(rows, key=lambda r: r["chunk_no"]):
        data = by.setdefault(r["record_id"], bytearray())
        assert r["chunk_start"] == len(data) == 1000 * r["chunk_no"]
        data += r["chunk"]
        assert r["bytes_so_far"] == len(data) and r["digest_so_far"] == hashlib.sha256(data).hexdigest()
        if r["last"]:
            assert r["intact"] and r["payload_bytes"] == len(data)
    assert sorted(bytes(v) for v in by.values()) == sorted(h.encode() for _, h in pages)
    assert sum(r["last"] for r in rows) == len(pages)


def test_only_committed_archives_are_read(spark, tmp_path):
    path, pages = str(tmp_path / "a"), [(1, "one " * 50), (2, "two")]
    warc.write_records(warc.page_records(frame(spark, pages)), path)
    lost = b"".join(warc.record_head({"record_type": "response", "record_id": "urn:page:9:x", "target_uri": None, "payload_digest": "0",
                                      "payload_bytes": 0}, "d")) + warc.END
    (tmp_path / "a" / "lost-attempt.warc").write_bytes(lost)
    assert warc.read_records(spark, path).count() == 2
    warc.write_records(warc.page_records(frame(spark, [(3, "three")])), path)
    assert sorted(r["record_id"][:10] for r in warc.read_records(spark, path).collect()) == ["urn:page:1", "urn:page:2", "urn:page:3"]
    lists = [n for n in os.listdir(path) if n.endswith(".json")]
    assert len(lists) == 2 and all(json.load(open(f"{path}/{n}")) for n in lists)


FOREIGN = (
    b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:a>\r\nContent-Type: application/warc-fields\r\ncontent-length: 7\r\n\r\na: b\r\n\n\r\n\r\n"
    b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:b>\r\nWARC-Target-URI:  http://b/\r\nX-Long: one\r\n two\r\nContent-Type: text/plain\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:c>\r\nWARC-Payload-Digest: sha256:00\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
)


@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_other_makers(spark, tmp_path, packed):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / ("x.warc.gz" if packed else "x.warc")).write_bytes(zlib.compress(FOREIGN, 9, 31) if packed else FOREIGN)
    (tmp_path / "in" / "cut.warc").write_bytes(FOREIGN[:-7])
    rows = warc.read_records(spark, f"file://{tmp_path}/in").orderBy("archive", "record_no").collect()
    got = [(r["record_type"], r["record_id"], r["target_uri"], r["payload_bytes"], r["intact"]) for r in rows]
    whole = [("warcinfo", "urn:a", None, 7, True), ("resource", "urn:b", "http://b/", 3, True), ("response", "urn:c", None, 4, False)]
    assert got == [*whole[:2], ("response", "urn:c", None, 1, False), *whole]
    assert rows[4]["payload_digest"] == hashlib.sha256(b"xyz").hexdigest()


class Endless(io.RawIOBase):
    """A record of many bytes that are made as they are read."""

    def __init__(self, size):
        self.head = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % size
        self.left = size

    def read(self, n=-1):
        if self.head:
            out, self.head = self.head, b""
            return out
        out = b"z" * min(n, self.left)
        self.left -= len(out)
        return out


def test_memory_does_not_grow_with_a_record():
    peaks = []
    for size in (20 << 20, 200 << 20):
        tracemalloc.start()
        rows = sum(1 for _ in warc.records(warc.Source(warc.inflated(Endless(size))), 1 << 20))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert rows == size >> 20
    assert max(peaks) < 8 << 20


@pytest.mark.parametrize("size", [0, 1, 131071, 131072, 131073, 3000000])
def test_inflating_members_of_any_size(size):
    for data in (bytes(size), random.Random(size).randbytes(size)):
        packed = zlib.compress(data, 6, 31) + b"".join(zlib.compress(data[i:i + 50000], 1, 31) for i in range(0, size, 50000))
        assert b"".join(warc.inflated(io.BytesIO(packed))) == data * 2


def test_registered_query_matches_its_twin(spark):
    import duckdb

    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    result = db.execute(ORACLES["op11_warc"])
    columns = [c[0] for c in result.description]
    got = QUERIES["op11_warc"](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(result.fetchall(), key=repr)
