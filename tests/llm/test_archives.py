import base64
import gzip
import hashlib
from collections import defaultdict

import pytest

from tidemark.llm import archives
from tidemark.llm.common import table
from tidemark.llm.files import files_folder, whole_files
from tidemark.llm.queries import QUERIES


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(pages, least=0):
    groups = defaultdict(list)
    for i, html in pages:
        groups[(html or "").encode()].append(i)
    out = {}
    for payload, ids in groups.items():
        for i in ids:
            again = len(payload) >= least and i != min(ids)
            out[i] = (len(payload), digest(payload), "revisit" if again else "response", min(ids) if again else None)
    return out


def results(df):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()}


def test_query(spark, small):
    pages = [tuple(r) for r in table(spark, small, "pages").select("page_id", "html").collect()]
    got = QUERIES["op7_arc_to_warc"](spark, small)
    assert got.columns[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert results(got) == expected(pages) and all(r.sound for r in got.collect())


@pytest.mark.parametrize("least, size", [(0, 1 << 24), (0, 200), (5, 1000)])
def test_edge_rows(spark, least, size):
    pages = [(1, None), (2, ""), (3, "same"), (4, "same text"), (5, "same text"), (6, "é\r\n\r\nx"), (7, "HTTP/1.1 200 OK\r\n\r\nsame"),
             (8, "y" * 500_000), (9, "same"), (10, "y" * 500_000)]
    urls = [None, "", "http://a b/\n c", "http://é.org/?q=1#x", "dns:x", "x" * 3000, "http://h/%20", "https://h", "ftp://f", " "]
    df = spark.createDataFrame([(*p, u, "z", 1) for p, u in zip(pages, urls)], "page_id long, html string, url string, name string, offset int")
    got = archives.archived(df, least_bytes=least, archive_bytes=size)
    assert results(got) == expected(pages, least)
    assert {r.page_id: r.url for r in got.collect()}[3] == "http://a%20b/%0A%20c"
    assert archives.archived(df.limit(0)).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, "u", "a"), (None, "u", "a"), (4, "u", "a"), (4, "u", "a"), (2, "u", "b")]
    got = archives.archived(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got.collect()) == [
        (0, "revisit", 4), (0, "revisit", 4), (2, "response", None), (4, "response", None), (4, "revisit", 4)]
    kinds = [(r.page_id, r.record_type) for r in got.collect()]
    assert kinds.count((4, "response")) == 1 and kinds.count((4, "revisit")) == 1 and kinds.count((None, "revisit")) == 2


def arc(version, records, first=None):
    fields = archives.ARC_FIELDS[version]
    about = f"{version} 0 old crawler\n{fields}\n\n".encode()
    out = (first or f"filedesc://x.arc 1.2.3.4 19990101000000 text/plain {len(about)}").encode() + b"\n" + about + b"\n"
    for line, block in records:
        out += line.encode() + b"\n" + block + b"\n"
    return out


ONE = [("http://h/a b 9.8.7.6 20000229123456 text/html 26", b"HTTP/1.0 200 OK\r\n\r\n\nbody\n\n"), ("dns:h 1.1.1.1 2000 text/dns 3", b"\n\nx")]
TWO = [("http://h/a 9.8.7.6 20000229123456 text/html 200 AB - 120 x.arc 25", b"HTTP/1.0 200 OK\r\n\r\n200 2\n"),
       ("http://h/b - bad text/html 404 - - 9 x.arc 0", b"")]


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
@pytest.mark.parametrize("version, records", [(1, ONE), (2, TWO)])
def test_versions_by_hand(version, records, pack):
    found = list(archives.arc_records("x.arc", pack(arc(version, records))))
    assert [f["version"] for f in found] == [version] * 3
    assert [(f["URL"], f["block"]) for f in found[1:]] == [(line.rsplit(" ", 4 if version == 1 else 9)[0], block) for line, block in records]
    warc = b"".join(archives.converted("x.arc", f, None) for f in found)
    back = list(archives.warc_records("x.warc", warc))
    assert [f["warc-type"] for f, _ in back] == ["warcinfo", "response", "resource"]
    assert [b for _, b in back[1:]] == [block for _, block in records]
    fields = back[1][0]
    assert fields["warc-date"] == "2000-02-29T12:34:56Z" and fields["warc-ip-address"] == "9.8.7.6"
    assert fields["warc-payload-digest"] == "sha1:" + digest(records[0][1].split(b"\r\n\r\n", 1)[1])
    assert fields["warc-record-id"].startswith("<urn:uuid:") and len({f["warc-record-id"] for f, _ in back}) == 3
    assert back[2][0]["warc-date"] == ("2000-01-01T00:00:00Z" if version == 1 else "1970-01-01T00:00:00Z")


def test_broken_archives():
    short = arc(1, [("http://h/ 1.1.1.1 20000101000000 text/html 99", b"HTTP/1.0 200 OK\r\n\r\nx")])
    assert list(archives.arc_records("x", short))[1]["truncated"]
    assert b"WARC-Truncated" in archives.converted("x", list(archives.arc_records("x", short))[1], None)
    for bad in (b"WARC/1.0\r\n", arc(1, [("http://h/ 1.1.1.1 20000101000000 text/html many", b"")]), b"filedesc://x 1 2 3 2\n7 \n", b"filedesc://x"):
        with pytest.raises(ValueError):
            list(archives.arc_records("x", bad))
    assert list(archives.arc_records("x", b"")) == []


def test_conversion_repeats(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i % 5}") for i in range(40)], "page_id long, url string, html string")
    arcs = files_folder(spark, "arc")
    archives.write_arcs(pages, arcs, archive_bytes=300)
    made = []
    for _ in range(2):
        warcs = files_folder(spark, "warc")
        assert archives.convert(spark, arcs, warcs).agg({"n_revisits": "sum"}).first()[0] == 35
        made.append({r.name: bytes(r.content) for r in whole_files(spark, warcs, "*").collect()})
    assert made[0] == made[1] and len(made[0]) > 2
