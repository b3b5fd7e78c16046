import base64
import hashlib
import io
import zipfile
from collections import defaultdict

import duckdb
import pytest

from eventframe.llm import warc
from eventframe.llm.oracles import WARC
from eventframe.llm.queries import op10_warc_packages


def reader(data):
    asked = []

    def read(at, n):
        asked.append((at, n))
        return data[at : at + n]

    return warc.ZipReader(read, len(data)), asked


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_against_standard_library(zip64):
    members = [("a/b.txt", b"hello"), ("ü.bin", bytes(range(256)) * 10), ("empty", b"")]
    data = warc.zip_store(members, b"a comment", zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert [(n, z.read(n)) for n in z.namelist()] == members and z.testzip() is None
    z, _ = reader(data)
    assert [(n, z.range(n, 0, len(b))) for n, b in members] == [(n, b) for n, b in members]
    assert z.range("a/b.txt", 1, 3) == b"ell"
    with pytest.raises(warc.ArchiveError):
        z.range("a/b.txt", 3, 3)


def test_reads_foreign_archives():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("stored", b"x" * 1000)
        z.writestr(zipfile.ZipInfo("wide"), b"y" * 10)
        z.writestr("deflated", b"x" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 not the end"
    z, _ = reader(out.getvalue())
    assert z.range("stored", 10, 5) == b"xxxxx"
    with pytest.raises(warc.ArchiveError, match="compressed"):
        z.range("deflated", 0, 5)


def test_broken_archives():
    good = warc.zip_store([("a", b"b")])
    for bad in (b"", b"nothing", good[:-5], good[:40] + b"zzzz" + good[44:]):
        with pytest.raises((warc.ArchiveError, KeyError, UnicodeDecodeError)):
            reader(bad)[0].range("a", 0, 1)


def test_records_are_read_by_range():
    records = [(str(k), warc.record(k, f"http://x/{k}", b"p" * 5000 * k, warc.payload_digest(b"p" * 5000 * k), False, None)) for k in range(6)]
    data = warc.package(records) + warc.COMMENT
    z, asked = reader(data)
    made = list(warc.read_package(z.read, len(data)))
    assert [len(b) for _, b in made] == [5000 * k for k in range(6)] and [h["x-page-id"] for h, _ in made] == list("012345")
    with pytest.raises(warc.ArchiveError):
        warc.parse_record(records[1][1][:-1])
    with pytest.raises(warc.ArchiveError):
        warc.parse_record(b"no record\r\n\r\n")


ROWS = [(5, "u5", "same"), (3, "u3", "same"), (9, "u9", "same"), (1, "u1", None), (2, None, ""), (4, "a\r\nX: y", "é\r\n\r\n\x00"), (6, "u%6", "other"), (6, "u6", "other"), (None, "n", "same"), (None, "m", "lone"), (7, "u7", "WARC/1.1\r\n\r\n")]


def brute(rows, least):
    by = defaultdict(list)
    for i, _, html in rows:
        by[(html or "").encode()].append(i)
    out = []
    for payload, ids in by.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids.sort(key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            revisit = k > 0 and len(payload) >= least
            out.append((i, len(payload), digest, "revisit" if revisit else "response", ids[0] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast", [100_000, 0])
@pytest.mark.parametrize("least", [0, 3, 5, 1000])
def test_round_trip(spark, tmp_path, clashing, monkeypatch, least, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    df = clashing(spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3))
    back = warc.archive_round_trip(df, f"file://{tmp_path}/w", revisit_bytes=least, package_bytes=700).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == brute(ROWS, least)
    want = {(i, (h or "").encode()) for i, _, h in ROWS}
    assert all((r.page_id, bytes(r.payload)) in want for r in back if r.record_type == "response") and all(r.payload is None for r in back if r.record_type == "revisit")


def test_other_stores_take_the_same_reader(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    warc.write_archives(df, f"file://{tmp_path}/w")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./w", f"file://{tmp_path}/w")
    back = warc.read_archives(spark, "viewfs://store/w").collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == brute(ROWS, 0)


def test_ranges_through_arrow(spark, tmp_path):
    """The way taken for stores that Arrow knows, on the one that a test has."""
    folder = f"file://{tmp_path}/w"
    warc.write_archives(spark.createDataFrame(ROWS, "page_id long, url string, html string"), folder)
    assert warc.way_to_read(spark, folder) == "file"
    back = warc.read_archives(spark, folder, "store").collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == brute(ROWS, 0)
    part = next(p for p in sorted((tmp_path / "w").iterdir()) if p.name.startswith("part-") and p.stat().st_size)
    read, size, close = warc.store_reader(part.as_uri())
    assert read(0, 4) == b"PK\x03\x04" and size == part.stat().st_size
    with pytest.raises(warc.ArchiveError):
        read(size - 2, 4)
    close()


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(df, f"file://{tmp_path}/e").collect() == []


def test_query_against_sql(spark, sf):
    got = sorted(map(tuple, op10_warc_packages(spark, sf).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    assert got == sorted(con.execute(WARC).fetchall(), key=str)
