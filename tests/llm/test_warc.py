"""WARC files and the audit of replicas."""

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cestero.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k // 2, f"http://a/{k}", f"<p>{k}</p>\r\n\r\n" * (k % 5), "x") for k in range(300)]
    rows += [(None, None, None, None), (7, "http://b\r\nX: y", "ü" * 9, "y")] + [(9, "http://c", "", "z")] * 3
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha256 string")


@pytest.fixture(scope="module")
def listed(pages):
    return warc.manifest(warc.records(pages))


def replica(spark, rows, folder):
    warc.write_warc(rows, folder)
    return warc.in_order(warc.read_warc(spark, folder), *warc.READ_ORDER)


def bad(listed, found):
    return sorted(r.ordinal for r in warc.audit(listed, found).collect())


def test_files_hold_the_records_of_the_manifest(spark, pages, listed, tmp_path):
    found = replica(spark, warc.records(pages), str(tmp_path / "a"))
    assert bad(listed, found) == []
    files = sorted(Path(tmp_path / "a").glob("part-*"))
    archive = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    rows = sorted(listed.collect(), key=lambda r: r.ordinal)
    assert [r.ordinal for r in rows] == list(range(pages.count()))
    for r in rows:
        assert hashlib.sha256(archive[r.offset : r.offset + r.length]).hexdigest() == r.sha256
        assert archive[r.offset + r.length :][:4] == b"\r\n\r\n"


def test_an_audit_finds_what_differs(spark, pages, listed, tmp_path):
    altered = F.when(F.col("page_id") % 50 == 3, F.regexp_replace("record", "Date: 2024", "Date: 2025"))
    rows = warc.records(pages).withColumn("record", F.coalesce(altered, F.col("record")))
    found = replica(spark, rows, str(tmp_path / "b"))
    want = sorted(r.ordinal for r in listed.where("page_id % 50 = 3").collect())
    assert want and bad(listed, found) == want


def test_missing_records_and_empty_archives(spark, pages, listed, tmp_path):
    last = listed.agg(F.max("page_id")).first()[0]
    short = listed.where(F.col("page_id").isNull() | (F.col("page_id") < last))
    want = sorted(r.ordinal for r in listed.where(F.col("page_id") == last).collect())
    assert bad(listed, short) == bad(short, listed) == want
    none = warc.manifest(warc.records(pages.limit(0)))
    assert none.count() == 0 and bad(none, none) == []


def test_a_broken_head_is_one_record_to_the_end():
    good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab"
    assert list(warc.parsed(good + b"\r\n\r\n" + good)) == [(0, 33), (37, 33)]
    assert list(warc.parsed(good + b"\r\n\r\nWARC/1.1 broken")) == [(0, 33), (37, 15)]


def record(k, header="Content-Length"):
    body = f"body of {k} ".encode() * (k % 7)
    return f"WARC/1.1\r\n{header}: {len(body)}\r\n\r\n".encode() + body


def lengths(spark, folder, **options):
    rows = warc.read_warc(spark, str(folder), **options).collect()
    return [(r.length, r.sha256) for r in sorted(rows, key=lambda r: (r.file, r.piece, r.name, r.number))]


def test_files_of_others_have_a_member_for_each_record(spark, tmp_path):
    whole = [record(k, ["Content-Length", "content-length", "CONTENT-LENGTH"][k % 3]) for k in range(50)]
    for name, rows in (("a.warc.gz", whole[:30]), ("b.warc.gz", whole[30:])):
        (tmp_path / name).write_bytes(b"".join(gzip.compress(r + b"\r\n\r\n") for r in rows))
    (tmp_path / "c.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in whole[:3]))
    want = [(len(r), hashlib.sha256(r).hexdigest()) for r in whole + whole[:3]]
    assert lengths(spark, tmp_path, pattern="*.warc*") == want


@pytest.mark.parametrize("damage", ["flip", "cut", "head"])
def test_a_damaged_file_is_read_up_to_the_damage(spark, pages, listed, tmp_path, damage):
    folder = tmp_path / damage
    warc.write_warc(warc.records(pages), str(folder))
    path = max(folder.glob("part-*"), key=lambda p: p.stat().st_size)
    raw = bytearray(path.read_bytes())
    if damage == "flip":
        raw[len(raw) // 2] ^= 16
    elif damage == "cut":
        del raw[len(raw) // 2 :]
    else:
        raw[:2] = b"xx"
    path.write_bytes(bytes(raw))
    (folder / f".{path.name}.crc").unlink(missing_ok=True)
    found = warc.in_order(warc.read_warc(spark, str(folder)), *warc.READ_ORDER)
    assert 0 < len(bad(listed, found)) <= listed.count()


def test_members_divided_at_any_length(monkeypatch):
    rows = [record(k) + b"\r\n\r\n" for k in range(9)]
    content = b"".join(map(gzip.compress, rows)) + b"trailing"
    for piece in (1, 7, 64, 1 << 16):
        monkeypatch.setattr(warc, "_PIECE", piece)
        assert list(warc.members(content)) == rows
    assert list(warc.members(b"")) == [b""] and list(warc.records_of(b"")) == []
