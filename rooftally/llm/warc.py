"""WARC archives: monolithic gzip files made into one gzip member for each record, with an offset index.

A crawler may write a whole file as one gzip stream, which can only be read from its start. The
normaliser inflates such a stream once, rewrites every record as a member of its own, and writes a
sidecar with each member's offset and length, so that any record can be read alone. In passing it
turns records whose payload another record has into revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import run_folder
from . import storage
from .common import ready, staged

FILE_BYTES = 1 << 27        # a file is closed at the first record that ends beyond as many bytes, inflated
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_READ = 1 << 20
_PIECE = 1 << 22            # bytes inflated at a time, however well a stream is squeezed
_LEVEL = 6


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _plain(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1F\x7F]", lambda m: f"%{ord(m.group()):02X}", value)


def record(kind: str, number: str, fields: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-record:{number}>", f"WARC-Date: {DATE}"]
    lines += [f"{name}: {_plain(value)}" for name, value in fields.items() if value is not None]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block + _END


def http_block(payload: bytes, with_payload: bool = True) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + _END
    return head + payload if with_payload else head


def parse_head(head: bytes) -> dict[str, str]:
    return {name.strip(): value.strip() for name, _, value in (line.partition(":") for line in head.decode().split("\r\n")[1:])}


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, in pieces of at most ``_PIECE`` bytes."""
    inflate = zlib.decompressobj(31)
    while raw := source.read(_READ):
        while raw:
            yield inflate.decompress(raw, _PIECE)
            if inflate.eof:
                raw, inflate = inflate.unused_data, zlib.decompressobj(31)
            else:
                raw = inflate.unconsumed_tail


def records(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of a gzip file of any number of members, inflated as it is read: one record and one piece are held at a time."""
    held, fields, need = bytearray(), None, 0
    for piece in inflated(source):
        held += piece
        at = 0
        while True:
            if fields is None:
                end = held.find(_END, at)
                if end < 0:
                    break
                fields = parse_head(bytes(held[at:end]))
                at, need = end + 4, int(fields["Content-Length"])
            if len(held) - at < need + 4:
                break
            yield fields, bytes(held[at:at + need])
            at, fields = at + need + 4, None
        del held[:at]
    if fields is not None or held:
        raise ValueError("the archive ends within a record")


def write_monolithic(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Write a response record for each row, whole files as single gzip streams, from the tasks that read the rows.

    Gives a row for each record: ``path``, ``ordinal`` (its place in the file), ``page``, ``bytes``, ``digest``.
    Null html is an empty payload; a null url or id leaves its header out. Rows that repeat have a record each.
    """
    rows = pages.select(
        F.col(f"`{id_column}`").alias("page"), F.col(f"`{url_column}`").cast("string").alias("_url"), F.col(f"`{html_column}`").alias("_html"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = path = squeeze = None
        size = count = 0
        for batch in batches:
            found = []
            for page, url, html in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None:
                    path = storage.new_name(folder, "crawl", ".warc.gz")
                    out, squeeze, size, count = storage.create(path), zlib.compressobj(_LEVEL, zlib.DEFLATED, 31), 0, 0
                payload = (html or "").encode()
                mark = digest(payload)
                raw = record("response", f"{path.rsplit('/', 1)[1]}:{count}", {
                    "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{mark}", "X-Page-ID": None if page is None else str(page),
                }, http_block(payload))
                out.write(squeeze.compress(raw))
                found.append((path, count, page, len(payload), mark))
                size, count = size + len(raw), count + 1
                if size >= FILE_BYTES:
                    out.write(squeeze.flush())
                    out.close()
                    out = None
            columns = list(zip(*found)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([
                pa.array(list(columns[0]), pa.string()), pa.array(list(columns[1]), pa.int64()), pa.array(list(columns[2]), batch.column(0).type),
                pa.array(list(columns[3]), pa.int64()), pa.array(list(columns[4]), pa.string()),
            ], ["path", "ordinal", "page", "bytes", "digest"])
        if out is not None:
            out.write(squeeze.flush())
            out.close()

    ready(pages.sparkSession)
    schema = rows.selectExpr("'' path", "0L ordinal", "page", "0L bytes", "'' digest").schema
    return rows.mapInArrow(write, schema)


def choose_revisits(written: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records that revisit another: ``path``, ``ordinal``, ``refers_to`` (a page) and ``refers_record``.

    Of records with equal payloads of ``least_bytes`` or more, that of the largest page stays a response;
    of rows that repeat a page, the last written. Null pages rank lowest.
    """
    large = written.where(F.col("bytes") >= least_bytes)
    groups = large.groupBy("digest").agg(
        F.max(F.struct("page", "path", "ordinal")).alias("_kept"), F.count(F.lit(1)).alias("_records"),
    ).where("_records > 1").select(F.col("digest").alias("_digest"), "_kept")
    # Written first, so that both sides of the join come straight from an exchange and a frequent payload can be split.
    joined = large.join(staged(groups, "payload-groups"), F.col("digest") == F.col("_digest"))
    return joined.where("path <> _kept.path OR ordinal <> _kept.ordinal").select(
        "path", "ordinal", F.col("_kept.page").cast("string").alias("refers_to"),
        F.concat(F.element_at(F.split("_kept.path", "/"), -1), F.lit(":"), F.col("_kept.ordinal")).alias("refers_record"),
    )


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives, a row each of ``path`` and ``revisits`` (ordinal, refers_to, refers_record), with a member for each record.

    Gives ``path`` (new), ``sidecar`` (its index) and ``records``. The sidecar has a line for each record:
    offset, length, type and record id, separated by tabs. A file of no records gives an empty archive.
    """
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, revisits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                turned = {item["ordinal"]: item for item in revisits or []}
                target, sidecar = storage.new_name(folder, "archive", ".warc.gz"), storage.new_name(folder, "archive", ".idx")
                offset = count = 0
                with storage.stream(path) as source, storage.create(target) as out, storage.create(sidecar) as index:
                    for ordinal, (fields, block) in enumerate(records(source)):
                        kind, number = fields["WARC-Type"], fields["WARC-Record-ID"][len("<urn:x-record:"):-1]
                        kept = {name: fields.get(name) for name in ("WARC-Target-URI", "WARC-Payload-Digest", "X-Page-ID")}
                        if ordinal in turned:
                            kind, other = "revisit", turned[ordinal]
                            payload = block[block.index(_END) + 4:]
                            kept |= {
                                "WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:x-record:{other['refers_record']}>",
                                "X-Refers-To-Page-ID": other["refers_to"], "X-Payload-Length": str(len(payload)),
                            }
                            block = http_block(payload, with_payload=False)
                        squeeze = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
                        member = squeeze.compress(record(kind, number, kept, block)) + squeeze.flush()
                        out.write(member)
                        index.write(f"{offset}\t{len(member)}\t{kind}\t{number}\n".encode())
                        offset, count = offset + len(member), count + 1
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([sidecar]), pa.array([count], pa.int64())], ["path", "sidecar", "records"])

    return files.select("path", "revisits").mapInArrow(rewrite, "path string, sidecar string, records bigint")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row for each record of normalised archives, each member read by its index.

    ``page``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``html`` (null for revisits).
    A response whose payload does not have the digest in its header is an error.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(zip(*found), types)], names)

        for batch in batches:
            for path, sidecar in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with storage.stream(sidecar) as lines:
                    entries = [line.split("\t") for line in lines.read().decode().splitlines()]
                found, held = [], 0
                with storage.random_access(path) as file:
                    for offset, length, kind, _ in entries:
                        file.seek(int(offset))
                        raw = zlib.decompress(file.read(int(length)), 31)
                        head, _, rest = raw.partition(_END)
                        fields = parse_head(head)
                        payload = rest[:int(fields["Content-Length"])].partition(_END)[2]
                        mark = fields["WARC-Payload-Digest"][len("sha1:"):]
                        if kind == "response" and digest(payload) != mark:
                            raise ValueError(f"a payload in {path} has changed")
                        size = len(payload) if kind == "response" else int(fields["X-Payload-Length"])
                        found.append((
                            fields.get("X-Page-ID"), fields.get("WARC-Target-URI"), size, mark, kind, fields.get("X-Refers-To-Page-ID"),
                            payload.decode() if kind == "response" else None,
                        ))
                        held += len(raw)
                        if held > 1 << 23:
                            yield rows(found)
                            found, held = [], 0
                if found:
                    yield rows(found)

    return archives.select("path", "sidecar").mapInArrow(
        read, "page string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, html string",
    )


def _spread(files: DataFrame) -> DataFrame:
    """A task for each few files: a row stands for a whole file."""
    return files.repartition(max(1, min(files.count(), 10_000)))


def archive(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", *, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to monolithic archives, normalise those, and return the manifest of :func:`normalise`.

    Payloads never move between tasks: which records are revisits is found from ids and digests alone.
    The monolithic files are scratch, and removed once their rewriting is on record.
    """
    spark = ready(pages.sparkSession)
    written = staged(write_monolithic(pages, run_folder(spark, "crawl"), id_column, url_column, html_column), "written")
    revisits = choose_revisits(written, least_bytes).groupBy("path").agg(
        F.collect_list(F.struct("ordinal", "refers_to", "refers_record")).alias("revisits"),
    )
    files = staged(written.groupBy("path").agg(F.count(F.lit(1)).alias("records")).join(revisits, "path", "left"), "files")
    manifest = staged(normalise(_spread(files), run_folder(spark, "archives")), "archives")

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                storage.remove(path)
            yield batch

    files.select("path").mapInArrow(clear, "path string").count()
    return manifest


def round_trip(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", *, least_bytes: int = 0) -> DataFrame:
    """The records of ``pages`` as read back from their archives, with ids in their own type again.

    Null and empty html are equal payloads of no bytes. Of equal payloads the record with the largest id is the response,
    and rows that repeat have a record each; a very long payload is one record, held whole by the task that writes or reads it.
    An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    kind = pages.schema[id_column].dataType
    found = read_archives(_spread(archive(pages, id_column, url_column, html_column, least_bytes=least_bytes)))
    return found.withColumns({"page": F.col("page").cast(kind), "refers_to": F.col("refers_to").cast(kind)}).withColumnRenamed("page", id_column)
