"""Legacy ARC archives converted to WARC, written as per-record gzip members and read back."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import lean, shared_dir, text_bytes, write_table
from vitrine.sources.tables import table

#: Field names of the two header lines, as the version blocks of the two formats state them.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code",
        "Checksum", "Location", "Offset", "Filename", "Archive-length",
    ),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this many bytes are always responses.
MIN_REVISIT = 100
_EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)


# --- ARC ------------------------------------------------------------------------------------------


def _token(value: str) -> str:
    """A value as one field of a header line: blanks and controls percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value) or "-"


def arc_header(version: int, name: str) -> bytes:
    """The version block that opens an archive."""
    body = f"{version} 0 vitrine\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    if version == 1:
        line = f"filedesc://{name} 0.0.0.0 20000101000000 text/plain {len(body)}\n"
    else:
        line = f"filedesc://{name} 0.0.0.0 20000101000000 text/plain 200 - - 0 {name} {len(body)}\n"
    return line.encode() + body


def arc_record(version: int, url: str, date: str, mime: str, content: bytes, offset: int, name: str) -> bytes:
    """One document record: header line, content of the declared length, separating newline."""
    fields = [_token(url), "0.0.0.0", date, mime]
    if version == 2:
        fields += ["200", hashlib.md5(content).hexdigest(), "-", str(offset), name]
    return (" ".join([*fields, str(len(content))]) + "\n").encode() + content + b"\n"


def read_arc(data: bytes) -> Iterator[dict]:
    """Document records of an archive.

    The version block names the fields of the header lines that follow; every record ends after
    its declared length, whatever its content looks like. A header line with another number of
    fields, or a length beyond the archive, raises ValueError.
    """
    fields, at = None, 0
    while at < len(data):
        end = data.index(b"\n", at)
        line, at = data[at:end].decode("utf-8", "replace").split(" "), end + 1
        if at == end + 1 and line == [""]:
            continue  # separating newlines between records
        length = int(line[-1])
        if at + length > len(data):
            raise ValueError(f"record of {length} bytes goes beyond the archive")
        content, at = data[at : at + length], at + length
        if fields is None:
            version = int(content[:1])
            fields = ARC_FIELDS[version]
            if content.split(b"\n")[1].decode().split(" ") != list(fields):
                raise ValueError("version block and header line disagree")
            continue
        if len(line) != len(fields):
            raise ValueError(f"header line of {len(line)} fields in an archive of version {version}")
        yield dict(zip(fields, line, strict=True)) | {"version": version, "content": content}


# --- WARC -----------------------------------------------------------------------------------------


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its empty line) and payload of a block; no head where there is none."""
    if block[:5] != b"HTTP/":
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block[: end + 4], block[end + 4 :]) if end >= 0 else (block, b"")


def warc_from_arc(record: dict, refers_to: int | None) -> bytes:
    """The WARC record that stands for an ARC record: identifier, timestamp, type and digests are
    synthesised from what the ARC header and content say. ``refers_to`` makes it a revisit, which
    keeps the HTTP head and drops the payload."""
    head, payload = split_http(record["content"])
    date = datetime.strptime(record["Archive-date"], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    digest = hashlib.sha256(payload).hexdigest()
    ident = uuid.uuid5(uuid.NAMESPACE_URL, f"{record['URL']} {record['Archive-date']} {digest} {head.hex()}")
    block = head if refers_to is not None else record["content"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{ident}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {record['URL']}",
        f"WARC-IP-Address: {record['IP-address']}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest() if head else digest}",
        f"WARC-Identified-Payload-Type: {record['Content-type']}",
        f"X-Payload-Length: {len(payload)}",
        f"X-Source-Format: ARC/{record['version']}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one WARC record, by its declared length."""
    end = record.index(b"\r\n\r\n")
    version, *lines = record[:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = record[end + 4 : end + 4 + int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]):
        raise ValueError("record shorter than it declares")
    return fields, block


def members(file: pa.NativeFile, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The gzip members of a file one by one, read in small chunks."""
    left, unzip, parts = b"", zlib.decompressobj(31), []
    while left or (left := file.read(chunk)):
        parts.append(unzip.decompress(left))
        left = b""
        if unzip.eof:
            yield b"".join(parts)
            left, unzip, parts = unzip.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("truncated archive")


# --- operator -------------------------------------------------------------------------------------


def revisits(pages: DataFrame) -> DataFrame:
    """Pages whose payload a page of smaller id holds already: page_id, digest, refers_to.

    The first page of a payload is a partial aggregate over digests, so that a payload with a
    third of all pages is no task's burden.
    """
    keys = pages.select(
        "page_id", F.sha2(text_bytes("html"), 256).alias("digest"), F.length(text_bytes("html")).alias("n")
    ).where(F.col("n") >= MIN_REVISIT)
    first = keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
    later = keys.join(first.where("copies > 1"), "digest").where("page_id <> refers_to")
    return later.select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, directory: str, version: int = 1) -> DataFrame:
    """Put pages through ARC of ``version`` and write them as WARC; returns the manifest (uri, records).

    A page is archived at a date told by its id, with its html behind an HTTP head that carries the
    id. Null html is an empty payload; a null or empty url becomes ``-``; repeated rows are records
    of their own; a null page_id has no id header; an empty table writes no archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        uri = f"{directory}/{part:06d}.warc.gz"
        out = fs = path = temporary = None
        n, name = 0, f"{part:06d}.arc"
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                rows = batch.slice(i, 200).to_pydict()
                arc = bytearray(arc_header(version, name))
                for page_id, url, html in zip(rows["page_id"], rows["url"], rows["html"], strict=True):
                    mark = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
                    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{mark}\r\n".encode()
                    date = (_EPOCH + timedelta(seconds=(page_id or 0) % 10**9)).strftime("%Y%m%d%H%M%S")
                    arc += arc_record(version, url or "", date, "text/html", head + html, len(arc), name)
                for record, refers_to in zip(read_arc(bytes(arc)), rows["refers_to"], strict=True):
                    if out is None:
                        fs, path = pyarrow.fs.FileSystem.from_uri(uri)
                        fs.create_dir(path.rpartition("/")[0], recursive=True)
                        temporary = f"{path}.{TaskContext.get().taskAttemptId()}.part"
                        out = fs.open_output_stream(temporary)
                    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
                    out.write(squeeze.compress(warc_from_arc(record, refers_to)) + squeeze.flush())
                    n += 1
        if out is not None:
            out.close()
            fs.move(temporary, path)
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([n], pa.int64())], names=["uri", "records"])

    digest = F.sha2(text_bytes("html"), 256).alias("digest")
    marked = pages.select("page_id", "url", text_bytes("html").alias("html"), digest).join(
        revisits(pages), ["page_id", "digest"], "left"
    )
    manifest = marked.select("page_id", "url", "html", "refers_to").mapInArrow(lean(write), "uri string, records long")
    return write_table(manifest, "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to,
    record_id, date, target_uri, with the digest of a response computed anew from its payload."""
    spark = manifest.sparkSession
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "date", "target_uri"]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, date string, target_uri string"
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def row(record: bytes) -> tuple:
        fields, block = parse_warc(record)
        head, payload = split_http(block)
        page = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
        declared = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        size = int(fields["X-Payload-Length"])
        if fields["WARC-Type"] == "response":
            if hashlib.sha256(payload).hexdigest() != declared:
                raise ValueError(f"payload and digest of {fields['WARC-Record-ID']} disagree")
            size = len(payload)
        refers_to = int(fields["X-Refers-To-Page"]) if "X-Refers-To-Page" in fields else None
        page_id = int(page[1]) if page else None
        return (page_id, size, declared, fields["WARC-Type"], refers_to, fields["WARC-Record-ID"], fields["WARC-Date"], fields["WARC-Target-URI"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = pyarrow.fs.FileSystem.from_uri(uri)
                with fs.open_input_file(path) as file:
                    rows = [row(record) for record in members(file)]
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    tasks = max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.select("uri").repartition(tasks).mapInArrow(lean(read), schema)


def op1_arc_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC into WARC archives and back: what the archives say of each payload."""
    manifest = write_archives(table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op1_arc_warc": op1_arc_warc}
ORACLE_SQL = {
    "op1_arc_warc": f"""WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= {MIN_REVISIT} GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id <> first THEN first END AS refers_to FROM p LEFT JOIN f USING (payload_digest)"""
}
