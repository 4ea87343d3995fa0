"""Legacy ARC archives to WARC archives.

An ARC file opens with a version block (``filedesc:``), whose second line names the version; each record is one
header line, as many bytes as the line declares, and a line feed. Version 1 lines end in IP address, date, content
type and length; version 2 lines have result code, checksum, location, offset and file name in between. Fields are
taken from the right, as old URLs may hold blanks. Files may be plain or hold one gzip member a record.

Conversion runs in two passes over the archives. The first parses all records and returns one narrow row each, with
the place of the record and the SHA-1 of its payload (the entity body of an HTTP response, else the whole data). Rows
with equal payloads meet in a grouped minimum, so payloads never shuffle. The second pass reads each record again by
its place, and writes a WARC record with synthesised identifier, date, type and digests: ``response``, or ``revisit``
without payload where an equal payload is kept elsewhere.

Defined cases: a null payload counts as empty; null or empty URLs become ``urn:page:<id>``; blanks and control
characters in URLs are percent-encoded; repeated rows are records of their own, of which one is the response; a null
page id sorts last; a record that ends before its declared length raises; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.llm.batches import bounded, pieces
from shopscope.llm.storage import Output, reader
from shopscope.sources.workspace import Workspace

#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 16 << 20
# Header fields by ARC version, from the right.
ARC_FIELDS = {
    1: ("ip", "date", "mime", "length"),
    2: ("ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
ARC_LINES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
UNSAFE_IN_URL = re.compile(r"[\s\x00-\x1f\x7f]")


def packed(data: bytes) -> bytes:
    """One gzip member."""
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Start, size and content of each gzip member of a file.

    A member gets the file in blocks about as large as the member before, as whatever follows it in a block is copied.
    """
    view, start, block = memoryview(data), 0, 1 << 12
    while start < len(data):
        press, parts, at = zlib.decompressobj(31), [], start
        while not press.eof and at < len(data):
            parts.append(press.decompress(view[at : at + block]))
            at = min(at + block, len(data))
        if not press.eof:
            raise ValueError(f"the member at {start} is cut off")
        end = at - len(press.unused_data)
        yield start, end - start, b"".join(parts)
        start, block = end, max(1 << 9, min(1 << 16, end - start))


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- ARC ---------------------------------------------------------------------------------------------------------


def arc_version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 shopscope\n{ARC_LINES[version]}\n".encode()
    return f"filedesc://{name} 0.0.0.0 {date} text/plain".encode() + (b" 200 - - 0 " + name.encode() if version == 2 else b"") + f" {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, url: str, date: str, data: bytes, name: str, offset: int, ip: str = "0.0.0.0", mime: str = "text/html") -> bytes:
    fields = [url, ip, date, mime]
    if version == 2:
        fields += ["200", base32_sha1(data), "-", str(offset), name]
    return f"{' '.join([*fields, str(len(data))])}\n".encode() + data + b"\n"


def parse_arc(content: bytes, version: int | None, at: int = 0) -> tuple[dict, bytes, int]:
    """Header fields, data and end of the record that begins at ``at``; the first record's version tells the format."""
    line_end = content.index(b"\n", at)
    line = content[at:line_end].decode("utf-8", "surrogateescape")
    if version is None:  # the version block declares it in its body; its own line has the same number of fields
        version = int(content[line_end + 1 : content.index(b" ", line_end + 1)])
    names = ARC_FIELDS[version]
    url, *values = line.rsplit(" ", len(names))
    if len(values) != len(names):
        raise ValueError(f"no header line of version {version}: {line[:200]!r}")
    fields = dict(zip(names, values), url=url, version=version)
    begin, length = line_end + 1, int(fields["length"])
    if begin + length > len(content):
        raise ValueError(f"{url[:200]!r} declares {length} bytes; {len(content) - begin} are there")
    end = begin + length
    return fields, content[begin:end], end + (content[end : end + 1] == b"\n")


def arc_records(data: bytes) -> Iterator[tuple[int, int, dict, bytes]]:
    """Start, size, header fields and data of each record after the version block; of plain or compressed files."""
    version = None
    if data[:2] == b"\x1f\x8b":
        for start, size, content in members(data):
            fields, body, _ = parse_arc(content, version)
            if version is None:
                version = fields["version"]
            else:
                yield start, size, fields, body
        return
    at = 0
    while at < len(data):
        fields, body, end = parse_arc(data, version, at)
        if version is not None:
            yield at, end - at, fields, body
        version, at = fields["version"], end


def split_http(data: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """Header block, entity body and headers of an HTTP response; no block if the data aren't one."""
    if not data.startswith(b"HTTP/"):
        return b"", data, {}
    end = data.find(b"\r\n\r\n")
    end = len(data) if end < 0 else end + 4
    lines = data[:end].decode("latin-1").split("\r\n")[1:]
    return data[:end], data[end:], {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def write_arcs(pages: DataFrame, folder: str, date: str = "20000101000000") -> DataFrame:
    """Archives of the pages' HTML as HTTP responses, one path a row, lazily; versions alternate by partition and archive."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, closed = None, []
        for batch in pieces(batches, 4000):
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out, version = Output(folder, ".arc.gz"), 1 + (TaskContext.get().partitionId() + len(closed)) % 2
                    name = out.uri.rsplit("/", 1)[1]
                    out.write(packed(arc_version_block(name, version, date)))
                body = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page is None else page}\r\nContent-Length: {len(body)}\r\n\r\n"
                target = UNSAFE_IN_URL.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or f"urn:page:{page}")
                out.write(packed(arc_record(version, target, date, head.encode() + body, name, out.size)))
                if out.size >= ARCHIVE_BYTES:
                    out.close()
                    closed, out = [*closed, out.uri], None
        if out is not None:
            out.close()
            closed.append(out.uri)
        yield pa.RecordBatch.from_pydict({"archive": closed}, schema=pa.schema([("archive", pa.string())]))

    bounded(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(task, "archive string")


def _spread(rows: DataFrame, *order: str) -> DataFrame:
    """Evenly dealt in the given order: tasks get as many rows each, of few archives."""
    return rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)


RECORD = "archive string, version int, start long, size long, page_id long, url string, date string, ip string, mime string, payload_bytes long, payload_digest string"


def scan_arcs(archives: DataFrame) -> DataFrame:
    """A row a record: its place, header fields and payload digest."""
    schema = pa.schema([("archive", pa.string()), ("version", pa.int32()), ("start", pa.int64()), ("size", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("ip", pa.string()), ("mime", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with reader(path) as file:
                    data, rows = file.read(), []
                for start, size, fields, content in arc_records(data):
                    _, payload, headers = split_http(content)
                    page = headers.get("x-page-id", "")
                    rows.append({"archive": path, "start": start, "size": size, "page_id": int(page) if page else None, "payload_bytes": len(payload), "payload_digest": base32_sha1(payload)} | {k: fields[k] for k in ("version", "url", "date", "ip", "mime")})
                    if len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _spread(archives, "archive").mapInArrow(task, RECORD)


# ---- WARC --------------------------------------------------------------------------------------------------------


def record_id(archive: Column, start: Column) -> Column:
    """A stable name-based identifier: of the place of the legacy record."""
    digest = F.md5(F.concat_ws("@", archive, start.cast("string")))
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-3$3-a$4-$5"))


def decide(records: DataFrame, workspace: Workspace, revisit_from: int = 0) -> DataFrame:
    """Adds ``id``, and for payloads kept elsewhere ``refers_page``, ``refers_id``, ``refers_url``, ``refers_date``.

    Of equal payloads of at least ``revisit_from`` bytes, the record with the smallest page id is kept.
    """
    records = records.withColumn("id", record_id(F.col("archive"), F.col("start")))
    order = F.struct(F.col("page_id").isNull().alias("missing"), "page_id", "archive", "start", "id", "url", "date")
    kept = (
        records.where(F.col("payload_bytes") >= revisit_from)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    # written, so that the join is a plain one, in which the partition of a payload that most records share may be split
    kept = workspace.store("kept", kept)
    joined = records.join(kept, ["payload_digest", "payload_bytes"], "left")
    other = F.col("first").isNotNull() & (F.col("first.id") != F.col("id"))
    return joined.select(
        *records.columns,
        other.alias("revisit"),
        *[F.when(other, F.col(f"first.{name}")).alias(f"refers_{alias}") for name, alias in (("page_id", "page"), ("id", "id"), ("url", "url"), ("date", "date"))],
    )


def iso_date(date: str) -> str:
    """A 14-digit ARC date, or the beginning of one, as a WARC date."""
    full = (date + "19700101000000"[len(date) :])[:14]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(fields: dict, data: bytes) -> bytes:
    """The WARC record of a legacy record's data."""
    head, _, _ = split_http(data)
    block = head if fields["revisit"] else data
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if fields['revisit'] else 'response' if head else 'resource'}",
        f"WARC-Record-ID: <{fields['id']}>",
        f"WARC-Date: {iso_date(fields['date'])}",
        f"WARC-Target-URI: {fields['url']}",
        f"WARC-IP-Address: {fields['ip']}",
        f"Content-Type: {'application/http; msgtype=response' if head else fields['mime']}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"WARC-Payload-Digest: sha1:{fields['payload_digest']}",
        f"Payload-Length: {fields['payload_bytes']}",
        f"Page-Id: {'' if fields['page_id'] is None else fields['page_id']}",
    ]
    if fields["revisit"]:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: <{fields['refers_id']}>",
            f"WARC-Refers-To-Target-URI: {fields['refers_url']}",
            f"WARC-Refers-To-Date: {iso_date(fields['refers_date'])}",
            f"Refers-To-Page-Id: {'' if fields['refers_page'] is None else fields['refers_page']}",
        ]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode("utf-8", "surrogateescape") + block + b"\r\n\r\n"


def write_warcs(records: DataFrame, folder: str) -> DataFrame:
    """Read each record again by its place and write it; one WARC path a row, lazily."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, closed, source, path = None, [], None, None
        for batch in pieces(batches, 4000):
            for fields in batch.to_pylist():
                if fields["archive"] != path:
                    if source is not None:
                        source.close()
                    path, source = fields["archive"], reader(fields["archive"])
                source.seek(fields["start"])
                data = source.read(fields["size"])
                content = next(members(data))[2] if data[:2] == b"\x1f\x8b" else data
                _, body, _ = parse_arc(content, fields["version"])
                if out is None:
                    out = Output(folder, ".warc.gz")
                    out.write(packed(warcinfo(out.uri.rsplit("/", 1)[1], fields["date"])))
                out.write(packed(warc_record(fields, body)))
                if out.size >= ARCHIVE_BYTES:
                    out.close()
                    closed, out = [*closed, out.uri], None
        if source is not None:
            source.close()
        if out is not None:
            out.close()
            closed.append(out.uri)
        yield pa.RecordBatch.from_pydict({"archive": closed}, schema=pa.schema([("archive", pa.string())]))

    return _spread(records, "archive", "start").sortWithinPartitions("archive", "start").mapInArrow(task, "archive string")


def warcinfo(name: str, date: str) -> bytes:
    body = b"software: shopscope\r\nformat: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Date: {iso_date(date)}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def parse_warc(content: bytes) -> tuple[dict[str, str], bytes]:
    end = content.index(b"\r\n\r\n")
    first, *lines = content[:end].decode("utf-8", "surrogateescape").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:100]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = content[end + 4 : end + 4 + int(headers["content-length"])]
    if len(block) != int(headers["content-length"]):
        raise ValueError(f"{headers.get('warc-record-id')} is cut off")
    return headers, block


def read_warcs(archives: DataFrame) -> DataFrame:
    """A row a record that isn't ``warcinfo``, with digests verified against the bytes."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("target_uri", pa.string()), ("date", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with reader(path) as file:
                    data, rows = file.read(), []
                for _, _, content in members(data):
                    headers, block = parse_warc(content)
                    kind = headers["warc-type"]
                    if kind == "warcinfo":
                        continue
                    digest, length = headers["warc-payload-digest"].removeprefix("sha1:"), int(headers["payload-length"])
                    if f"sha1:{base32_sha1(block)}" != headers["warc-block-digest"]:
                        raise ValueError(f"{headers['warc-record-id']} is damaged")
                    if kind != "revisit":
                        payload = split_http(block)[1]
                        if (len(payload), base32_sha1(payload)) != (length, digest):
                            raise ValueError(f"{headers['warc-record-id']} has another payload than declared")
                    number = lambda name: int(headers[name]) if headers.get(name) else None
                    rows.append({"page_id": number("page-id"), "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": number("refers-to-page-id"), "record_id": headers["warc-record-id"].strip("<>"), "target_uri": headers["warc-target-uri"], "date": headers["warc-date"]})
                    if len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _spread(archives, "archive").mapInArrow(task, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string, date string")


def convert(arcs: DataFrame, workspace: Workspace, revisit_from: int = 0) -> DataFrame:
    """The WARC archives of a table of ARC paths (column ``archive``)."""
    records = workspace.store("records", scan_arcs(arcs))
    return workspace.store("warcs", write_warcs(decide(records, workspace, revisit_from), workspace.location("warc")))


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages to ARC archives, these to WARC archives, and the records read back."""
    workspace = Workspace(spark)
    arcs = workspace.store("arcs", write_arcs(pages, workspace.location("arc")))
    return read_warcs(convert(arcs, workspace))
