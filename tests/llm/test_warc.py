"""WARC archives and the two-level index: round trips and lookups."""

import base64
import gzip
import hashlib

import pytest

from hazeline.llm.warc import address, look_up, read_records, surt_key, write_archives, write_index
from hazeline.session import stored, work_dir

SCHEMA = "page_id long, url string, html string, file string, offset int, digest string"


@pytest.fixture(scope="module")
def rows():
    out = [(i, f"http://h{i % 7}.example.{'org' if i % 2 else 'com'}/p{i % 40}?q={i % 3}", f"<p>é {i % 50}</p>" * (i % 9)) for i in range(400)]
    out += [(1000 + i, "https://Hot.example.net:443/same#x", f"hot {i % 4}") for i in range(200)]
    return out + [(2000, None, None), (2001, "not a url", ""), (2002, "http://[bad", "x\r\n\r\ny"), (None, "http://n.org/", "hot 1"), (2003, "a\nb", "z"), (2004, "http://big.org", "y" * 300_000)]


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame([(p, u, h, "f", 1, "d") for p, u, h in rows], SCHEMA)


@pytest.fixture(scope="module")
def archived(spark, pages):
    captures = write_archives(pages.repartition(3))
    return captures, write_index(captures, block_lines=7)


def plain(rows):
    largest = {}
    for p, _, h in rows:
        if p is not None:
            largest[h or ""] = max(p, largest.get(h or "", p))
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        again = p is not None and p < largest[h or ""]
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", largest[h or ""] if again else None, None if again else data))
    return sorted(out, key=str)


def test_round_trip_through_the_index(pages, rows, archived):
    found = stored(look_up(pages, archived[1]), "found")
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in read_records(found).collect()]
    assert sorted(got, key=str) == plain(rows)


def test_lookups_by_url_alone(spark, pages, rows, archived):
    wanted = spark.createDataFrame([("http://hot.EXAMPLE.net/same",), ("http://h3.example.org/p3?q=0",), ("http://absent.org/",), (None,)], "url string")
    got = sorted(((r.surt, r.page_id) for r in look_up(wanted, archived[1]).collect()))
    keys = {surt_key(u) for u in ("https://hot.example.net/same", "http://h3.example.org/p3?q=0", "about:blank")}
    want = sorted((surt_key("about:blank" if u is None else u), p) for p, u, _ in rows if surt_key("about:blank" if u is None else u) in keys)
    assert got == want and len(got) > 200


def test_every_member_is_a_gzip_record(archived):
    by_file = {}
    for r in archived[0].collect():
        by_file.setdefault(r.file, []).append((r.offset, r.length))
    for file, places in by_file.items():
        data = open(file.removeprefix("file://"), "rb").read()
        at = 0
        for offset, length in sorted(places):
            assert offset == at and gzip.decompress(data[offset:offset + length]).startswith(b"WARC/1.1\r\n")
            at += length
        assert at == len(data)


def test_surt_keys():
    assert surt_key("http://www.A.org:80/x?y#z") == "org,a,www)/x?y" and surt_key("https://a.org:8443") == "org,a:8443)/"
    assert surt_key("mailto:x") == "mailto:x" and surt_key("http://[bad") == "http://[bad"


def test_repeated_largest_rows_are_responses(spark):
    rows = [(1, "http://a.org", "same"), (5, "http://a.org", "same"), (5, "http://a.org", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = stored(look_up(pages, write_index(write_archives(pages))), "found")
    assert sorted((r.page_id, r.record_type) for r in read_records(found).collect()) == [(1, "revisit"), (5, "response"), (5, "response")]


def test_empty_table(spark, pages):
    none = pages.limit(0)
    files = write_index(write_archives(none))
    assert files == [] and look_up(pages, files).count() == 0 and read_records(stored(look_up(none, files), "found")).count() == 0


def test_files_lie_in_the_given_folder(spark, pages, rows):
    folder = work_dir(spark, "own")
    captures = write_archives(pages.limit(5), folder)
    assert all(folder.split(":")[-1].lstrip("/") in r.file for r in captures.collect())


def test_addresses_name_their_file_system(spark):
    """A bare path lies in Spark's default file system, whatever that is; whole addresses stay."""
    assert address(spark, "/shared/x") == "file:///shared/x" and address(spark, "file:/shared/x") == "file:///shared/x"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "viewfs://store/")
        conf.set("fs.viewfs.mounttable.store.link./shared", "file:///tmp")
        assert address(spark, "/shared/x") == "viewfs://store/shared/x" and address(spark, "file:///shared/x") == "file:///shared/x"
    finally:
        conf.set("fs.defaultFS", before)
