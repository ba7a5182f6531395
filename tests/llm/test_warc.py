"""WARC archives: records beside a plain reader of whole files, cut at many places, with magic words in payloads."""

import glob
import hashlib
import random
import re

import duckdb
import pytest

from tracklight.llm import checks, queries, warc
from tracklight.runtime import new_path

SCHEMA = "page_id long, url string, html string, file string, block string, digest string, length string, at string, value string"


def hostile(rng):
    """A payload with whole records, bare magic words and half headers inside."""
    parts = ["<p>text</p>", "\r\n", "WARC/1.1\r\n", "\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\r\n\r\n", "\r\nWARC/1.", "é😀"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))


def page_rows():
    rng = random.Random(3)
    long = "x" * 1000
    rows = [(1, "http://a/", long), (2, "http://b/WARC/1.1", long), (3, None, long), (4, "", "y" * 999), (5, "u", "y" * 999), (6, "a\r\nWARC/1.0\r\nb", None)]
    rows += [(7, "u", ""), (7, "u", ""), (8, "u", "z" * 1500), (8, "u", "z" * 1500), (9, "u", "é" * 500), (None, "u", "é" * 500), (None, "n", "n" * 2000), (None, "n", "n" * 2000)]
    rows += [(10, "u", "\r\nWARC/1.1\r\n" * 200), (11, "u", "w" * 70_000 + "\r\nWARC/1.1\r\nWARC-Type: x\r\nContent-Length: 1\r\n\r\n" + "v" * 70_000)]
    rows += [(100 + i, f"u{i}", hostile(rng)) for i in range(60)]
    return [(*r, "f", "b", "d", "l", "a", "v") for r in rows]


def expected(rows):
    largest = {}
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        if len(body) >= 1000:
            ids = largest.setdefault(body, [])
            ids.append(i)
    out = []
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        known = [k for k in largest.get(body, []) if k is not None]
        keep = max(known) if known else i
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "response" if i == keep else "revisit", None if i == keep else keep))
    return sorted(out, key=str)


def plain_reader(folder):
    """All records of whole files, by their lengths alone."""
    out = []
    for name in sorted(glob.glob(f"{folder}/part-*")):
        data, at = open(name, "rb").read(), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at) + 4
            length = int(re.search(rb"\r\nContent-Length: (\d+)", data[at:end])[1])
            assert data[end + length : end + length + 4] == b"\r\n\r\n"
            block = data[end : end + length]
            out.append((at, re.search(rb"WARC-Record-ID: (\S+)", data[at:end])[1].decode(), block[block.index(b"\r\n\r\n") + 4 :]))
            at = end + length + 4
    return sorted(out)


@pytest.fixture(scope="module")
def archive(spark):
    path = new_path(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(page_rows(), SCHEMA).coalesce(1), path)
    return path


@pytest.mark.parametrize("split", ["128m", "40000", "4001"])
def test_records_wherever_the_files_are_cut(spark, archive, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = warc.read_archives(spark, archive)
        assert sorted(warc.page_records(found).collect(), key=str) == [tuple(r) for r in expected(page_rows())]
        assert sorted((r.offset, r.record_id, bytes(r.payload)) for r in found.collect()) == plain_reader(archive.removeprefix("file:"))
        assert found.where("not whole").count() == 0
        assert found.where("record_type = 'response' and declared_digest <> concat('sha1:', payload_digest)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_shuffled_splits_keep_their_order(spark, archive, monkeypatch):
    monkeypatch.setattr(warc, "fits", lambda df, width: False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2500")
    try:
        found = warc.read_archives(spark, archive)
        assert sorted((r.offset, r.record_id, bytes(r.payload)) for r in found.collect()) == plain_reader(archive.removeprefix("file:"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_archives_from_elsewhere(spark, tmp_path):
    """Folded header lines, a block that starts with the magic, other types, an end that is cut off."""
    one = b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <a>\r\nX: 1\r\n  2\r\nContent-Length: 8\r\n\r\nWARC/1.0\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <b>\r\nContent-Length: 2\r\n\r\n\xff\xfe\r\n\r\n"
    three = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <c>\r\nContent-Length: 90\r\n\r\nshort"
    (tmp_path / "a.warc").write_bytes(one + two + three)
    (tmp_path / "b.warc").write_bytes(b"no archive\r\nWARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    (tmp_path / "c.warc").write_bytes(b"")
    found = {r.record_id: (r.record_type, bytes(r.payload), r.whole) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert found == {"<a>": ("warcinfo", b"WARC/1.0", True), "<b>": ("resource", b"\xff\xfe", True), "<c>": ("resource", b"short", False)}


def test_no_pages(spark):
    path = new_path(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0


def test_query_beside_sql(spark, folder):
    found = queries.op13_warc(spark, folder).toPandas()
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
        wanted = db.execute(checks.WARC).df()
    order = lambda t: t.sort_values("page_id").reset_index(drop=True)[sorted(t.columns)].astype(str)
    assert order(found).replace("<NA>", "nan").equals(order(wanted).replace("<NA>", "nan"))
