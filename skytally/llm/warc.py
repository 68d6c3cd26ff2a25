"""Legacy archive converter: ARC files in, WARC files out.

An ARC file opens with a version block whose body states the version and the fields of every
record's header line; version 1 has five fields, version 2 ten. Records follow each other by
their declared length alone. The converter reads both versions, and writes WARC/1.0 records
with identifiers, timestamps, types and digests derived from what the header line and the
payload hold, so converting again gives the same bytes. Archives are bounded volumes, each one
row and one gzip file, in a folder all executors share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.common import prepare, stored
from skytally.session import scratch_path

VOLUME_BYTES = 4 << 20       # payload per volume; a longer record has a volume of its own
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:skytally:archive")

# The field lists that ARC version blocks state.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location",
        "Offset", "Filename", "Archive-length"],
}
UNKNOWN_IP = "0.0.0.0"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def clean(field: str | None) -> str:
    """A header field holds no blanks; empty ones are a dash."""
    return "%20".join((field or "").split()) or "-"


def arc_record(version: int, url: str, when: str, kind: str, body: bytes, digest: str, at: int, volume: str) -> bytes:
    fields = {"URL": clean(url), "IP-address": UNKNOWN_IP, "Archive-date": when, "Content-type": kind,
              "Result-code": "200", "Checksum": digest, "Location": "-", "Offset": str(at),
              "Filename": volume, "Archive-length": str(len(body))}
    return " ".join(fields[f] for f in FIELDS[version]).encode() + b"\n" + body + b"\n"


def arc_head(version: int, volume: str, when: str) -> bytes:
    body = f"{version} 0 skytally\n{' '.join(FIELDS[version])}\n".encode()
    fields = {"URL": f"filedesc://{volume}", "IP-address": UNKNOWN_IP, "Archive-date": when,
              "Content-type": "text/plain", "Result-code": "200", "Checksum": "-", "Location": "-",
              "Offset": "0", "Filename": volume, "Archive-length": str(len(body))}
    return " ".join(fields[f] for f in FIELDS[version]).encode() + b"\n" + body + b"\n"


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, body) of every record after the version block.

    Bodies may hold anything, also lines that look like headers: only the declared length
    counts. A header that does not fit the stated fields, or a length past the end, raises.
    """
    fields, at = None, 0
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"no header line at byte {at}")
        parts = data[at:end].decode().split()
        length = int(parts[-1]) if parts[-1].isdigit() else -1
        body = data[end + 1:end + 1 + length]
        if length < 0 or len(body) < length:
            raise ValueError(f"wrong length in the header at byte {at}")
        at = end + 1 + length
        if fields is None:
            if not parts[0].startswith("filedesc:"):
                raise ValueError("no version block")
            version, names = body.decode().split("\n")[:2]
            fields = names.split()
            if FIELDS.get(int(version.split()[0])) != fields:
                raise ValueError(f"unknown version block: {version}")
            continue
        if len(parts) != len(fields):
            raise ValueError("a header with other fields than the version block states")
        yield dict(zip(fields, parts, strict=True)), body


def record_id(url: str, when: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{url} {when} {digest}')}>"


def warc_record(fields: list[tuple[str, str]], body: bytes) -> bytes:
    """A record without its closing line ends."""
    lines = ["WARC/1.0", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body


END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, body) of every record, by declared lengths; raises on anything malformed."""
    at = 0
    while at < len(data):
        head = data.find(END, at)
        lines = data[at:head].decode().split("\r\n")
        if head < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        begin = head + len(END)
        at = begin + int(fields["Content-Length"])
        if data[at:at + len(END)] != END:
            raise ValueError(f"record at byte {begin} does not end where it says")
        yield fields, data[begin:at]
        at += len(END)


def volumes(df: DataFrame, columns: list[str], record) -> DataFrame:
    """Pack rows into volumes: ``record(name, offset, row)`` gives the bytes, ``record(name, 0, None)`` the head.

    Rows (volume, content); the content is valid UTF-8 text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def volume() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "content": pa.array([b"".join(parts)], pa.binary())})

        for batch in batches:
            for row in batch.to_pylist():
                name = f"volume-{part:05d}-{number:05d}"
                if not parts:
                    parts.append(record(name, 0, None))
                    size = len(parts[0])
                parts.append(record(name, size, row))
                size += len(parts[-1])
                if size >= VOLUME_BYTES:
                    yield volume()
                    parts, size, number = [], 0, number + 1
        if parts:
            yield volume()

    return df.select(*columns).mapInArrow(run, "content binary")


def write_volumes(packed: DataFrame, path: str, end: str) -> None:
    """One gzip file per row, the row's bytes and ``end``; Spark's text writer keeps the bytes as they are."""
    (packed.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1)
     .option("lineSep", end).option("compression", "gzip").text(path))


def read_volumes(spark: SparkSession, path: str, parse, schema: str) -> DataFrame:
    """Rows of ``parse(content)`` over all volumes of a folder, gzip or plain; no volumes give no rows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                content = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                if content.strip():
                    yield pa.RecordBatch.from_pylist(list(parse(content)), schema=arrow)

    return prepare(spark).read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def write_arc(pages: DataFrame, path: str, when: datetime) -> None:
    """Pages as ARC volumes, version 1 and 2 in turn by volume.

    Reads page_id, url and html. A null url becomes a dash, null html an empty body. The page's
    id stands behind its address, as the fragment ``#page=<id>``.
    """
    stamp = when.strftime("%Y%m%d%H%M%S")

    def record(name: str, offset: int, row: dict | None) -> bytes:
        version = 1 + int(name[-1]) % 2
        if row is None:
            return arc_head(version, name, stamp)
        html = row["html"] or b""
        url = f"{clean(row['url'])}#page={'' if row['page_id'] is None else row['page_id']}"
        return arc_record(version, url, stamp, "text/html", HTTP + html, base32_sha1(html), offset, name)

    write_volumes(volumes(pages.select("page_id", "url", F.col("html").cast("binary").alias("html")),
                          ["page_id", "url", "html"], record), path, "\n")


def http_payload(body: bytes) -> bytes:
    """The entity of an HTTP response; a body without HTTP head is its own payload."""
    return body.partition(END)[2] if body.startswith(b"HTTP/") else body


def page_of(url: str) -> int | None:
    number = url.rpartition("#page=")[2]
    return int(number) if number.lstrip("-").isdigit() else None


ARC_ROW = ("page_id long, url string, archive_date string, content_type string, digest string, "
           "payload_bytes long, body binary")


def arc_rows(content: bytes) -> Iterator[dict]:
    for fields, body in parse_arc(content):
        payload = http_payload(body)
        yield {"page_id": page_of(fields["URL"]), "url": fields["URL"], "archive_date": fields["Archive-date"],
               "content_type": fields["Content-type"], "digest": base32_sha1(payload),
               "payload_bytes": len(payload), "body": body}


def responses(records: DataFrame, least_bytes: int) -> DataFrame:
    """Of each payload that occurs more than once: its digest, length, and largest page id with its header.

    Only payloads of at least ``least_bytes`` take part. Combined before the shuffle, so a payload
    that a third of all pages share reaches its task as one row per map task.
    """
    return (records.where(F.col("payload_bytes") >= least_bytes)
            .groupBy("digest", "payload_bytes")
            .agg(F.max("page_id").alias("kept"), F.count("*").alias("n"),
                 F.max_by("url", "page_id").alias("kept_url"), F.max_by("archive_date", "page_id").alias("kept_date"))
            .where("n > 1").drop("n"))


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> None:
    """Convert ARC volumes to WARC volumes.

    Records with equal payloads of at least ``least_bytes`` bytes: the one with the largest page
    id is a ``response``, the others are ``revisit`` records that name it and carry no payload.
    """
    rows = read_volumes(spark, arc_path, arc_rows, ARC_ROW)
    repeated = stored(responses(rows.drop("body"), least_bytes), "responses")

    def record(name: str, offset: int, row: dict | None) -> bytes:
        if row is None:
            body = b"software: skytally\r\nformat: WARC file version 1.0\r\n"
            return warc_record([
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("warcinfo", name, "")),
                ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Filename", name),
                ("Content-Type", "application/warc-fields")], body)
        date = lambda s: datetime.strptime(s, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        revisit = row["kept"] is not None and row["kept"] != row["page_id"]
        fields = [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(row["url"], row["archive_date"], row["digest"])),
            ("WARC-Date", date(row["archive_date"])), ("WARC-Target-URI", row["url"]),
            ("WARC-Payload-Digest", f"sha1:{row['digest']}")]
        body = row["body"]
        if revisit:
            fields += [
                ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                ("WARC-Refers-To", record_id(row["kept_url"], row["kept_date"], row["digest"])),
                ("WARC-Refers-To-Target-URI", row["kept_url"]), ("WARC-Refers-To-Date", date(row["kept_date"])),
                ("X-Payload-Length", str(row["payload_bytes"]))]
            body = body[:len(body) - row["payload_bytes"]]
        fields += [("WARC-Block-Digest", f"sha1:{base32_sha1(body)}"),
                   ("Content-Type", "application/http; msgtype=response")]
        # the closing line ends of the record before come first, those of the last from the writer
        return END + warc_record(fields, body)

    joined = rows.join(repeated, ["digest", "payload_bytes"], "left")
    packed = volumes(joined, ["page_id", "url", "archive_date", "digest", "payload_bytes", "body",
                              "kept", "kept_url", "kept_date"], record)
    write_volumes(packed, warc_path, END.decode())


WARC_ROW = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
            "refers_to long, url string, record_id string, payload string")


def warc_rows(content: bytes) -> Iterator[dict]:
    """Response and revisit records; declared digests are checked against what was read."""
    for fields, body in parse_warc(content):
        if fields["WARC-Type"] == "warcinfo":
            continue
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(body)}":
            raise ValueError(f"block digest differs: {fields['WARC-Record-ID']}")
        revisit = fields["WARC-Type"] == "revisit"
        payload = None if revisit else http_payload(body)
        if not revisit and base32_sha1(payload) != digest:
            raise ValueError(f"payload digest differs: {fields['WARC-Record-ID']}")
        yield {"page_id": page_of(fields["WARC-Target-URI"]),
               "payload_bytes": int(fields["X-Payload-Length"]) if revisit else len(payload),
               "payload_digest": digest, "record_type": fields["WARC-Type"],
               "refers_to": page_of(fields["WARC-Refers-To-Target-URI"]) if revisit else None,
               "url": fields["WARC-Target-URI"], "record_id": fields["WARC-Record-ID"],
               "payload": None if revisit else payload.decode()}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of a folder of WARC volumes, payloads of responses included."""
    return read_volumes(spark, path, warc_rows, WARC_ROW)


def archive_pages(pages: DataFrame, when: datetime, least_bytes: int = 0) -> DataFrame:
    """Pages through ARC and WARC and back: the rows of ``read_warc``.

    Null html is an empty payload and null urls are a dash. Rows with the same page id and payload
    are all kept: equal ids make all of them responses. An empty table gives no rows; other
    columns are ignored. Rows without page id keep a null one and are never referred to unless
    no other row has their payload.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, when)
    convert(spark, arc, warc, least_bytes)
    return read_warc(spark, warc)
