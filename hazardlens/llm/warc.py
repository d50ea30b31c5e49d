"""WARC archives of pages: written as one gzip stream each, then normalised to a gzip member per record with an index.

Equal payloads of some size are stored once: the page with the largest id is the response, the others are revisits
that refer to it. Archives and indexes lie in a folder that all executors share; every file has a name of its
attempt, and only files that a finished task has reported are used.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.llm.storage import file_system, new_path, save, ship

#: Payloads shorter than this are never revisits; bytes of payload after which an archive is closed.
LEAST_REVISIT, ARCHIVE_BYTES = 1000, 64 << 20
LEVEL, CHUNK = 2, 1 << 18
END = b"\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d" % len(block) + END + block + END


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The record of a page; a revisit has the HTTP head only, with the size and digest of the full payload."""
    digest = hashlib.sha1(payload).digest()
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'none' if page_id is None else page_id}>",
        "WARC-Target-URI": target or "about:blank",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(),
        "Content-Type": "application/http; msgtype=response",
    }
    head = HTTP_HEAD % len(payload)
    if not revisit:
        return record(fields, head + payload)
    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    fields["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
    return record(fields, head)


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(line.split(": ", 1) for line in lines[1:])


def inflate(source) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, part by part."""
    unpack = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            if out := unpack.decompress(data, CHUNK):
                yield out
            if unpack.eof:
                data, unpack = unpack.unused_data, zlib.decompressobj(31)
            else:
                data = unpack.unconsumed_tail
    while out := unpack.flush():
        yield out


def records(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and bytes of each record of a stream; one record is held at a time."""
    held = bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            more = next(parts, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(1):
        at, looked = -1, 0
        while (at := held.find(END, looked)) < 0:
            looked = max(0, len(held) - len(END) + 1)
            if not fill(len(held) + 1):
                raise ValueError("a record ends in its head")
        fields = parse_head(bytes(held[:at]))
        size = at + len(END) + int(fields["Content-Length"]) + len(END)
        if not fill(size):
            raise ValueError("a record ends in its block")
        yield fields, bytes(held[:size])
        del held[:size]


def normalise(fs, source: str, target: str) -> list[list[int]]:
    """Rewrite an archive so that every record is a gzip member of its own; offset and length of each member.

    The input is inflated once, as a stream; a sidecar ``.idx`` file (JSON, a row per record) keeps the result.
    """
    index, at = [], 0
    with fs.open_input_stream(source, compression=None) as data, fs.open_output_stream(target, compression=None) as out:
        for _, content in records(inflate(data)):
            pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            member = pack.compress(content) + pack.flush()
            out.write(member)
            index.append([at, len(member)])
            at += len(member)
    with fs.open_output_stream(f"{target}.idx", compression=None) as out:
        out.write(json.dumps(index).encode())
    return index


def read_member(source, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Fields and block of the record at an offset: random access through the index."""
    source.seek(offset)
    content = zlib.decompress(source.read(length), 31)
    at = content.index(END)
    fields = parse_head(content[:at])
    start = at + len(END)
    return fields, content[start : start + int(fields["Content-Length"])]


def _write(folder: str):
    def run(batches):
        fs, path = file_system(folder)
        out, pack, size, name, count = None, None, 0, None, 0

        def close():
            out.write(pack.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], ["file", "n"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to", "revisit")]
            for i in range(batch.num_rows):
                page_id, url, html, refers_to, revisit = (c[i].as_py() for c in columns)
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    pack, size, count = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0
                payload = (html or "").encode()
                out.write(pack.compress(page_record(page_id, url, payload, refers_to, revisit)))
                size, count = size + len(payload), count + 1
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return run


def _normalise(folder: str):
    def run(batches):
        fs, path = file_system(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                target = f"records-{uuid.uuid4().hex}.warc.gz"
                index = normalise(fs, f"{path}/{name}", f"{path}/{target}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([target]), pa.array([len(index)], pa.int64())], ["file", "n"]
                )

    return run


def _page_number(field: str | None) -> int | None:
    return None if field is None or field == "<urn:page:none>" else int(field[len("<urn:page:") : -1])


def _read(folder: str):
    def run(batches):
        fs, path = file_system(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with fs.open_input_stream(f"{path}/{name}.idx", compression=None) as source:
                    index = json.loads(source.read())
                rows = [], [], [], [], [], []
                with fs.open_input_file(f"{path}/{name}") as source:
                    for offset, length in index:
                        fields, block = read_member(source, offset, length)
                        http, _, payload = block.partition(END)
                        size = int(http.rsplit(b"Content-Length: ", 1)[1])
                        digest = base64.b32decode(fields["WARC-Payload-Digest"][len("sha1:") :]).hex()
                        kind = fields["WARC-Type"]
                        if kind == "response" and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, size):
                            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
                        row = (
                            _page_number(fields["WARC-Record-ID"]),
                            size,
                            digest,
                            kind,
                            _page_number(fields.get("WARC-Refers-To")),
                            fields["WARC-Target-URI"],
                        )
                        for column, value in zip(rows, row, strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, kinds, strict=True)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"],
                )

    return run


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Write the pages to whole-stream archives and normalise them; ``file, n`` per normalised archive.

    Pages with equal payloads of at least ``LEAST_REVISIT`` bytes: those with the largest id are responses (rows that
    repeat it as well), the others revisit it. Rows without an id are responses unless a row with an id has the same
    payload. A null payload is an empty one. An empty table gives no archive. Other columns are not looked at.
    """
    spark = pages.sparkSession
    ship(spark)
    pages = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    large = F.octet_length("html") >= LEAST_REVISIT
    # Small payloads stand alone: they take no part in the join, where they would all meet under the key null.
    none = [F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("revisit")]
    small = pages.where(~F.coalesce(large, F.lit(False))).select("page_id", "url", "html", *none)
    marked = pages.where(large).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    latest = (
        pages.where(large)
        .groupBy(F.sha1(F.col("html").cast("binary")).alias("digest"))
        .agg(F.max("page_id").alias("latest"), F.count("*").alias("copies"))
        .where("copies > 1 and latest is not null")
        .drop("copies")
    )
    revisit = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    placed = marked.join(latest, "digest", "left").select(
        "page_id", "url", "html", F.when(revisit, F.col("latest")).alias("refers_to"), revisit.alias("revisit")
    ).union(small)
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    written = save(placed.mapInArrow(_write(folder), "file string, n long"), "archives")
    # A row per archive of some megabytes: each is normalised by a task of its own.
    listed = written.repartition(max(1, written.count()), "file")
    return save(listed.mapInArrow(_normalise(folder), "file string, n long"), "records")


def read_archives(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url`` per record, through the indexes."""
    ship(spark)
    listed = files.repartition(max(1, files.count()), "file")
    return listed.mapInArrow(
        _read(folder),
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of the pages to the shared folder and read them back."""
    folder = new_path(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, folder, write_archives(pages, folder))
