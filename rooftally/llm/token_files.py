"""Token files: ids of all documents in ascending id order, Huffman-coded by their global counts.

Layout of a file: ``MAGIC``; then blocks, each ``ids, bits' bytes, checkpoints`` as unsigned 32-bit
numbers, the checkpoints as unsigned 32-bit bit offsets and the bits; then the documents' index (keys
and id counts as an Arrow stream), and a footer with the offset of the index, the number of blocks and
ids. All numbers are little-endian. The code lengths are a file of their own, one byte for each id.
Blocks do not depend on one another, and documents may span them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import run_folder
from . import storage
from .common import ready, running_before, staged
from .huffman import Code, code_lengths, decode
from .tokenize import END_ID, as_bytes, batches_of, checksums, encoder, tokenizer_path

MAGIC = b"TOKHUF01"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 23      # a file is closed at the first document that ends beyond as many, and tasks write about as many each
REMEMBERED = 700_000    # pieces; tasks here have little else to hold
_FOOTER = struct.Struct("<QQQ")


def encode_texts(documents: DataFrame, id_column: str, text_column: str, tokenizer: str | None = None) -> DataFrame:
    """``_id``, ``_tokens`` (with the end id), ``_ids`` (16-bit if the vocabulary allows, else 32) and ``_crc`` of every row."""
    path = tokenizer or tokenizer_path()
    rows = documents.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text_column}`").alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, REMEMBERED)
        width = 2 if own.vocabulary <= 1 << 16 else 4
        for whole in batches:
            for start, length in batches_of(whole.column(1)):
                batch = whole.slice(start, length)
                ids, bounds = own.encode(batch.column(1), END_ID)
                sums = checksums(ids, bounds)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(np.diff(bounds)), as_bytes(ids, bounds, width), pa.array(sums, pa.int64()),
                    pa.array(np.full(length, width, np.int32)),
                ], ["_id", "_tokens", "_ids", "_crc", "_width"])

    ready(documents.sparkSession)
    schema = rows.selectExpr("_id", "0L _tokens", "cast('' as binary) _ids", "0L _crc", "0 _width").schema
    return rows.mapInArrow(encode, schema)


def count_ids(encoded: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all rows. Tasks send their sums, one row for each id at most."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for ids, width in zip(batch.column(0), batch.column(1)):
                total += np.bincount(np.frombuffer(ids.as_buffer(), f"<u{width.as_py()}"), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["token", "times"])

    sums = encoded.select("_ids", "_width").mapInArrow(tally, "token bigint, times bigint").groupBy("token").agg(F.sum("times").alias("times")).toPandas()
    counts = np.zeros(vocabulary, dtype=np.int64)
    counts[sums["token"].to_numpy(np.int64)] = sums["times"].to_numpy(np.int64)
    return counts


class _Writer:
    """One token file. Ids are buffered up to a block."""

    def __init__(self, uri: str, code: Code) -> None:
        self.uri, self.code, self.out, self.offset = uri, code, storage.create(uri), len(MAGIC)
        self.out.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = self.blocks = self.documents = 0
        self.keys: list[pa.Array] = []
        self.sizes: list[int] = []

    def add(self, key: pa.Array, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.sizes.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        self.documents += 1
        if self.held >= BLOCK_IDS:
            everything = np.concatenate(self.waiting)
            full = len(everything) // BLOCK_IDS * BLOCK_IDS
            for start in range(0, full, BLOCK_IDS):
                self._block(everything[start:start + BLOCK_IDS])
            self.waiting, self.held = [everything[full:]], len(everything) - full

    def _block(self, ids: np.ndarray) -> None:
        bits, checkpoints = self.code.encode(ids)
        raw = struct.pack("<III", len(ids), len(bits), len(checkpoints)) + checkpoints.astype("<u4").tobytes() + bits
        self.out.write(raw)
        self.offset += len(raw)
        self.blocks += 1

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        keys = pa.concat_arrays(self.keys)
        index = pa.record_batch([keys, pa.array(self.sizes, pa.int64())], ["key", "ids"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_batch(index)
        raw = sink.getvalue().to_pybytes()
        self.out.write(raw + _FOOTER.pack(self.offset, self.blocks, self.ids) + MAGIC)
        self.out.close()


@dataclass
class TokenFiles:
    """A manifest of files (``part``, ``file``, ``path``, ``ids``, ``documents``) in document order, and the file of code lengths."""

    manifest: DataFrame
    lengths_path: str


def write_files(
    documents: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None, *, file_ids: int = FILE_IDS,
) -> TokenFiles:
    """Encode every row of ``documents`` into token files of about ``file_ids`` ids under ``folder``, in ascending order of ids.

    Null texts count as empty and have the end id alone. Null ids come first. Rows of equal ids are
    ordered by their checksums. No rows make no file.
    """
    encoded = staged(encode_texts(documents, id_column, text_column, tokenizer), "token-ids")
    vocabulary = encoder(tokenizer or tokenizer_path()).vocabulary
    counts = count_ids(encoded, vocabulary)
    lengths = code_lengths(counts)
    lengths_path = storage.new_name(folder, "lengths", ".u1")
    with storage.create(lengths_path) as out:
        out.write(lengths.tobytes())
    key_type = encoded.schema["_id"].dataType

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with storage.stream(lengths_path) as lengths_file:
            code = Code(np.frombuffer(lengths_file.read(), np.uint8))
        writer, done, part = None, [], 0

        def finish() -> None:
            writer.close()
            done.append((part, len(done), writer.uri, writer.ids, writer.documents))

        for batch in batches:
            for at in range(batch.num_rows):
                if writer is None:
                    part = batch.column(3)[at].as_py()
                    writer = _Writer(storage.new_name(folder, f"part-{part:06d}-{len(done):06d}", ".huf"), code)
                width = batch.column(2)[at].as_py()
                writer.add(batch.column(0).slice(at, 1), np.frombuffer(batch.column(1)[at].as_buffer(), f"<u{width}").astype(np.int64))
                if writer.ids >= file_ids:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        if done:
            names = ["part", "file", "path", "ids", "documents"]
            yield pa.RecordBatch.from_arrays([pa.array(list(column)) for column in zip(*done)], names)

    # Ranges of ids, not of rows: ties are cut by checksum, so one id with many rows does not fill a part.
    parts = max(1, -(-int(counts.sum()) // file_ids))
    ordered = encoded.repartitionByRange(parts, "_id", "_crc").sortWithinPartitions("_id", "_crc")
    files = ordered.select("_id", "_ids", "_width", F.spark_partition_id().alias("_part")).mapInArrow(
        write, "part bigint, file bigint, path string, ids bigint, documents bigint",
    )
    return TokenFiles(staged(files, "token-manifest"), lengths_path)


def read_files(spark: SparkSession, files: TokenFiles, key_type: str = "bigint") -> DataFrame:
    """One row per document, from the files alone: ``key``, ``start`` (ids before it), ``n_tokens`` and ``ids_crc32``."""
    lengths_path = files.lengths_path
    # Parts are numbered without gaps, and hold few files each.
    parts = staged(files.manifest.groupBy("part").agg(F.sum("ids").alias("ids")), "token-parts")
    before = running_before(parts, "part", "ids", "before").select(F.col("part").alias("of"), "before")
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    tasks = files.manifest.join(before, F.col("part") == F.col("of")).select(
        "path", (F.col("before") + F.coalesce(F.sum("ids").over(inside), F.lit(0))).alias("start"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with storage.stream(lengths_path) as lengths_file:
            code = Code(np.frombuffer(lengths_file.read(), np.uint8))
        table = code.table()
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _read_file(path, start, table, code.depth)

    ready(spark)
    return tasks.repartition(max(1, files.manifest.count())).mapInArrow(read, f"key {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def _read_file(path: str, start: int, table: tuple[np.ndarray, np.ndarray], depth: int) -> Iterator[pa.RecordBatch]:
    with storage.random_access(path) as file:
        size = file.size()
        file.seek(size - _FOOTER.size - len(MAGIC))
        tail = file.read()
        index_at, blocks, _ = _FOOTER.unpack(tail[:_FOOTER.size])
        if tail[_FOOTER.size:] != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        file.seek(index_at)
        index = pa.ipc.open_stream(file.read(size - index_at - _FOOTER.size - len(MAGIC))).read_all().combine_chunks()
        keys, sizes = index.column("key"), index.column("ids").to_pylist()
        file.seek(len(MAGIC))
        at, crc, left, rows = 0, 0, sizes[0] if sizes else 0, []
        for _ in range(blocks):
            count, length, marks = struct.unpack("<III", file.read(12))
            checkpoints = np.frombuffer(file.read(4 * marks), "<u4")
            ids = decode(file.read(length), checkpoints, count, table, depth).astype("<u4")
            here = 0
            while here < len(ids):
                piece = ids[here:here + left]
                crc = zlib.crc32(piece.tobytes(), crc)
                here, left = here + len(piece), left - len(piece)
                if not left:
                    rows.append((start, sizes[at], crc))
                    start, at, crc = start + sizes[at], at + 1, 0
                    left = sizes[at] if at < len(sizes) else 0
        columns = list(zip(*rows)) or [[]] * 3
    chunk = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) and keys.num_chunks else keys
    yield pa.RecordBatch.from_arrays(
        [chunk, *[pa.array(list(column), pa.int64()) for column in columns]], ["key", "start", "n_tokens", "ids_crc32"],
    )


def round_trip(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None, *, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the token files of ``documents`` to a fresh shared folder and read them back, a row for each document.

    A null or empty text is its end id alone, very long texts are encoded whole, rows that repeat are written each, and
    an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    spark = documents.sparkSession
    folder = run_folder(spark, "token-files")
    files = write_files(documents, folder, id_column, text_column, tokenizer, file_ids=file_ids)
    key_type = documents.schema[id_column].dataType.simpleString()
    return read_files(spark, files, key_type).withColumnRenamed("key", id_column)
