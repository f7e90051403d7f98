"""Legacy archives: ARC files of versions 1 and 2 become WARC files, equal payloads become revisits."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.files import files_folder, whole_files, written

#: Bytes of blocks after which an archive ends, at the end of a record.
ARCHIVE_BYTES = 16 << 20
_STEP = 1 << 13
# Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PAGE_HEADER = b"X-Page-Id"


def sha1(data: bytes) -> str:
    """Base32 digest, upper case."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(record: bytes) -> bytes:
    """A gzip member of its own, as both formats ask for."""
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def members(content: bytes) -> Iterator[tuple[int, bytes]]:
    """``(offset, data)`` of the gzip members of a file; a file that is not compressed is one member."""
    if content[:2] != b"\x1f\x8b":
        if content:
            yield 0, content
        return
    at, view = 0, memoryview(content)
    while at < len(content):
        unpacker, start, parts = zlib.decompressobj(31), at, []
        while not unpacker.eof and at < len(content):  # what a member leaves over is copied: offer little at once
            parts.append(unpacker.decompress(view[at:at + _STEP]))
            at = min(at + _STEP, len(content))
        at -= len(unpacker.unused_data)
        yield start, b"".join(parts)


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """Head (with its empty line) and payload of an HTTP response; a block of another kind is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[:end + 4], block[end + 4:])


def http_value(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower():
            return value.strip().decode("latin-1")
    return None


def page_id(head: bytes) -> int | None:
    found = http_value(head, PAGE_HEADER)
    return int(found) if found else None


# ARC

def arc_header(version: int, url: str, when: str, kind: str, length: int, name: str, offset: int) -> bytes:
    fields = [quote(url, safe="!#$%&'()*+,/:;=?@[]~") or "unknown:", "0.0.0.0", when, kind]
    if version == 2:
        fields += ["200", "-", "-", str(offset), name]
    return " ".join([*fields, str(length)]).encode() + b"\n"


def write_arcs(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages as they stand in a legacy crawl: gzipped ARC files of both versions, ``(name, n_records)`` for each.

    A page is an HTTP response whose payload is the html in UTF-8 (null: empty); its id stands in a header
    of the response. The crawl's clock runs with the id.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    started = datetime(2004, 1, 1)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3))))
        task, number = TaskContext.get().partitionId(), 0
        page = next(found, None)
        while page is not None:
            version = 1 + (task + number) % 2
            name = f"crawl-{task:07d}-{number:05d}.arc.gz"
            with written(folder, name) as out:
                about = f"{version} 0 tidemark\n{ARC_FIELDS[version]}\n\n".encode()
                size, n = out.write(_member(arc_header(version, f"filedesc://{name}", "20040101000000", "text/plain", len(about), name, 0)
                                            + about + b"\n")), 0
                total = 0
                while page is not None and total < archive_bytes:
                    key, url, html = page
                    payload = (html or "").encode()
                    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    head += b"" if key is None else PAGE_HEADER + b": %d\r\n" % key
                    block = head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
                    when = (started + timedelta(seconds=(key or 0) % (1 << 28))).strftime("%Y%m%d%H%M%S")
                    header = arc_header(version, url or f"unknown:{key}", when, "text/html", len(block), name, size)
                    size += out.write(_member(header + block + b"\n"))
                    total, n, page = total + len(block), n + 1, next(found, None)
            number += 1
            yield pa.RecordBatch.from_pydict({"name": [name], "n_records": pa.array([n], pa.int64())})

    return stored(rows.mapInArrow(write, "name string, n_records long"), "arcs")


def arc_records(name: str, content: bytes) -> Iterator[dict]:
    """Records of an ARC file: the fields of its header line and the declared number of bytes after it.

    The first record says by which version the lines are built. Fields are counted from the end of a line,
    for an old URL may hold blanks. A block shorter than declared (the file ends) is marked ``truncated``.
    """
    version = None
    for offset, data in members(content):
        at = 0
        while at < len(data):
            if data[at:at + 1] in (b"\n", b"\r"):  # between records
                at += 1
                continue
            end = data.find(b"\n", at)
            if end < 0:
                raise ValueError(f"{name}: header line without an end in the record at {offset}")
            line = data[at:end].decode("latin-1").rstrip("\r")
            if version is None:
                if not line.startswith("filedesc:"):
                    raise ValueError(f"{name}: not an ARC file")
                version = int(data[end + 1:].lstrip()[:1] or b"0")
                if version not in ARC_FIELDS:
                    raise ValueError(f"{name}: ARC version {version} is not known")
                # In many files of version 2, the first line still has the fields of version 1.
                names = ARC_FIELDS[1 if line.count(" ") == 4 else version].split()
            else:
                names = ARC_FIELDS[version].split()
            fields = line.rsplit(" ", len(names) - 1)
            if len(fields) != len(names) or not fields[-1].isdigit():
                raise ValueError(f"{name}: a header line of version {version} should have {len(names)} fields: {line[:200]}")
            length = int(fields[-1])
            block = data[end + 1:end + 1 + length]
            yield dict(zip(names, fields)) | {"version": version, "offset": offset, "at": at, "block": block, "truncated": len(block) < length}
            at = end + 1 + length


# WARC

def warc_id(name: str, record: dict) -> str:
    """The same identifier for the same place in the same archive, whenever it is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{name}#{record['offset']}+{record['at']}')}>"


def warc_date(when: str) -> str:
    """ISO 8601 in UTC from a date of 14 digits; a shorter one is filled up, an unreadable one is the epoch."""
    digits = (when + "00000101000000"[len(when):])[:14]
    try:
        return datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def converted(name: str, record: dict, first: dict | None) -> bytes:
    """The WARC record of an ARC record; ``first`` describes the record whose payload it repeats."""
    block, url, when = record["block"], record["URL"], warc_date(record["Archive-date"])
    common = [("WARC-Record-ID", warc_id(name, record)), ("WARC-Date", when)]
    if url.startswith("filedesc:"):
        about = f"software: tidemark\r\nformat: WARC File Format 1.1\r\ndescription: converted from {name}, ARC version {record['version']}\r\n"
        return warc_record([("WARC-Type", "warcinfo"), *common, ("WARC-Filename", name.replace(".arc", ".warc")),
                            ("Content-Type", "application/warc-fields")], about.encode())
    head, payload = http_parts(block)
    common += [("WARC-Target-URI", url)]
    if record["IP-address"] not in ("", "-", "0.0.0.0"):
        common.append(("WARC-IP-Address", record["IP-address"]))
    common.append(("WARC-Payload-Digest", f"sha1:{sha1(payload)}"))
    if record["truncated"]:
        common.append(("WARC-Truncated", "unspecified"))
    if first is not None:
        return warc_record([("WARC-Type", "revisit"), *common, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", first["record_id"]),
                            ("WARC-Refers-To-Target-URI", first["url"]), ("WARC-Refers-To-Date", first["date"]),
                            ("WARC-Block-Digest", f"sha1:{sha1(head)}"), ("Content-Type", "application/http; msgtype=response")], head)
    kind, content = ("response", "application/http; msgtype=response") if head else ("resource", record["Content-type"])
    return warc_record([("WARC-Type", kind), *common, ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Type", content)], block)


def warc_records(name: str, content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of a WARC file."""
    for _, data in members(content):
        at = 0
        while at < len(data):
            end = data.find(b"\r\n\r\n", at)
            if end < 0 or not data.startswith(b"WARC/", at):
                raise ValueError(f"{name}: not a WARC record")
            lines = data[at:end].decode().split("\r\n")[1:]
            fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            length = int(fields["content-length"])
            yield fields, data[end + 4:end + 4 + length]
            at = end + 4 + length + 4


def _each(use, schema: pa.Schema):
    """Apply ``use(*row)``, an iterator of output rows, to every row of the input; output in small batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = []
                for row in use(*(batch.column(c)[i].as_py() for c in range(batch.num_columns))):
                    made.append(row)
                    if len(made) == 512:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)
                        made = []
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)
    return run


_INDEX = pa.schema([("name", pa.string()), ("offset", pa.int64()), ("at", pa.int64()), ("record_id", pa.string()), ("url", pa.string()),
                    ("date", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.string())])


def _index(name: str, content: bytes) -> Iterator[tuple]:
    for r in arc_records(name, content):
        if not r["URL"].startswith("filedesc:"):
            head, payload = http_parts(r["block"])
            yield (name, r["offset"], r["at"], warc_id(name, r), r["URL"], warc_date(r["Archive-date"]), page_id(head), len(payload), sha1(payload))


def convert(spark: SparkSession, arcs: str, warcs: str, least_bytes: int = 0) -> DataFrame:
    """Convert the ARC files of a folder into WARC files of another, one for one; ``(name, n_records, n_revisits)``.

    Every ARC file is read twice. The first pass lists the records: place, page id, payload digest. Of the
    records with equal payloads of ``least_bytes`` bytes or more, the one with the smallest page id (then by
    file and place) stays a response; for the others, what they refer to is gathered by ARC file, so the
    second pass writes each file where it is read. Payloads are not shuffled by digest, and a payload that
    stands in a third of all records is a third of the narrow list only. Identifiers and dates follow from
    the archive alone; a repeated run writes the same files.
    """
    ddl = "name string, offset long, at long, record_id string, url string, date string, page_id long, payload_bytes long, digest string"
    files = whole_files(spark, arcs, "*.arc*")
    index = stored(files.mapInArrow(_each(_index, _INDEX), ddl), "arc-index")
    rank = F.struct(F.col("page_id").isNull(), "page_id", "name", "offset", "at")
    large = index.where(F.col("payload_bytes") >= least_bytes)
    firsts = large.groupBy("digest", "payload_bytes").agg(
        F.min_by(F.struct("record_id", "url", "date"), rank).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = large.join(firsts, ["digest", "payload_bytes"]).where(F.col("record_id") != F.col("first.record_id"))
    by_file = stored(again.groupBy("name").agg(F.collect_list(F.struct("record_id", "first")).alias("again")), "revisits")

    def write(name: str, content: bytes, repeats: list[dict] | None) -> Iterator[tuple]:
        first_of = {r["record_id"]: r["first"] for r in repeats or ()}
        target, n = name.replace(".arc", ".warc"), 0
        with written(warcs, target) as out:
            for r in arc_records(name, content):
                out.write(_member(converted(name, r, first_of.get(warc_id(name, r)))))
                n += 1
        yield target, n, len(first_of)

    made = files.join(by_file, "name", "left").select("name", "content", "again").mapInArrow(
        _each(write, pa.schema([("name", pa.string()), ("n_records", pa.int64()), ("n_revisits", pa.int64())])),
        "name string, n_records long, n_revisits long")
    return stored(made, "warcs")


_RECORD = pa.schema([("name", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("date", pa.string()),
                     ("refers_to_id", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("sound", pa.bool_())])


def _read(name: str, content: bytes) -> Iterator[tuple]:
    for fields, block in warc_records(name, content):
        kind = fields["warc-type"]
        if kind == "warcinfo":
            continue
        head, payload = http_parts(block) if fields.get("content-type", "").startswith("application/http") else (b"", block)
        declared = fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "revisit":
            n = int(http_value(head, b"Content-Length") or 0)
            sound = fields["warc-block-digest"] == f"sha1:{sha1(block)}"
        else:
            n, sound = len(payload), declared == sha1(payload) and fields["warc-block-digest"] == f"sha1:{sha1(block)}"
        yield (name, fields["warc-record-id"], kind, fields.get("warc-target-uri"), fields["warc-date"], fields.get("warc-refers-to"),
               page_id(head), n, declared, sound)


def read_warcs(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the WARC files of a folder, without the descriptions of the files.

    ``payload_bytes`` and ``payload_digest`` are those of the whole payload, for a revisit as its headers
    state them; ``sound`` says whether the digests fit the bytes that are there; ``refers_to`` is the page id
    of the record that a revisit refers to.
    """
    ddl = ("name string, record_id string, record_type string, url string, date string, refers_to_id string, page_id long, "
           "payload_bytes long, payload_digest string, sound boolean")
    rows = stored(whole_files(spark, folder, "*.warc*").mapInArrow(_each(_read, _RECORD), ddl), "warc-records")
    named = rows.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    plain = rows.where("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.unionByName(rows.where("refers_to_id is not null").join(named, "refers_to_id", "left"))


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0,
             archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages as ARC files, converted to WARC files and read back (``read_warcs``): one row for each page.

    A null html is an empty payload, a null url is ``unknown:`` and the id, blanks in urls are escaped. Rows
    without id are archived without one; rows that repeat an id are records of their own. An empty table
    gives no records.
    """
    spark = pages.sparkSession
    arcs, warcs = files_folder(spark, "arc"), files_folder(spark, "warc")
    write_arcs(pages, arcs, id_col, url_col, html_col, archive_bytes)
    convert(spark, arcs, warcs, least_bytes)
    return read_warcs(spark, warcs)
