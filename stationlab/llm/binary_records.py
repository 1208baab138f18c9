"""Token-ID / binary output: length-delimited binary records with an offset index.

``write_records`` encodes whole texts, deals the rows out by ranges of doc_id and
lets every task write one record file and one index file into a shared folder:

* record file: 8 bytes of header (``TOKREC``, version, bytes per id), then per
  record  u64 length | u32 masked checksum of the length | payload | u32 masked
  checksum of the payload;
* payload: u8 (1 if there is a doc_id) | i64 doc_id | ids, little-endian;
* index file: one entry per record (u64 offset, u64 length, i64 doc_id, u32 ids),
  so a reader can fetch records in any order;
* ``manifest`` (Parquet): one row per file, in doc_id order.

A checksum is the CRC-32 of the bytes, rotated by 15 bits plus a constant, so
that checksums of data that hold checksums stay telling.  A task that runs again
writes files of other names; only files that the manifest names count.

Defined results: null and empty texts give a record with the end id alone; rows
without doc_id come first; rows with the same doc_id are ordered by the hash of
their text; an empty table gives an empty manifest; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlab.llm.common import column_bytes, column_list, shared_folder, slices, tokenizer_path
from stationlab.llm.word_tokens import WordEncoder

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
# The file's header and the constant of masked checksums.
MAGIC, VERSION, MASK = b"TOKREC", 1, 0xA282EAD8
INDEX = np.dtype([("offset", "<u8"), ("length", "<u8"), ("doc_id", "<i8"), ("n_ids", "<u4")])

_ENCODERS: dict = {}


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(stream) -> bytes | None:
    """The next payload, both checksums verified; None at the end."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError("damaged record length")
    n = struct.unpack("<Q", head[:8])[0]
    body = stream.read(n + 4)
    if len(body) < n + 4 or masked(body[:n]) != struct.unpack("<I", body[n:])[0]:
        raise ValueError("damaged record")
    return body[:n]


def file_system(path: str):
    """(file system, path in it) of a folder name with or without a scheme."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_records(docs: DataFrame, folder: str, vocabulary: str | None = None, text: str = "text", id_column: str = "doc_id",
                  end_id: int = END_ID) -> DataFrame:
    """Write all rows in ascending doc_id order; returns the manifest
    (part, file, index, n_records, n_ids, width, first_id: ids in all files before)."""
    spark = docs.sparkSession
    path = vocabulary or tokenizer_path(VOCABULARY)
    # the text's hash and the row's place spread rows of one doc_id over several ranges
    rows = (docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id()))
    ranged = rows.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(batches):
        enc = encoder(path)
        end = np.array([end_id], enc.width).tobytes()
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        fs, root = file_system(folder)
        out, entries, n_ids, at = None, [], 0, 8
        for batch in batches:
            for piece in slices(batch):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}.rec")
                    out.write(MAGIC + bytes((VERSION, enc.width.itemsize)))
                for doc_id, data in zip(column_list(piece, "doc_id"), column_bytes(piece, "text"), strict=True):
                    ids = enc.encode(data) + end
                    record = frame(struct.pack("<Bq", doc_id is not None, doc_id or 0) + ids)
                    out.write(record)
                    n = len(ids) // enc.width.itemsize
                    entries.append((at, len(record), doc_id or 0, n))
                    at += len(record)
                    n_ids += n
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{root}/{name}.idx") as f:
                f.write(np.array(entries, INDEX).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (part, f"{name}.rec", f"{name}.idx", len(entries), n_ids, enc.width.itemsize)],
                ["part", "file", "index", "n_records", "n_ids", "width"])

    made = ranged.mapInArrow(write, "part long, file string, index string, n_records long, n_ids long, width long")
    made.write.mode("errorifexists").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file; ``first_id`` counts the ids in the files before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema("part long, file string, index string, n_records long, n_ids long, width long")
            .parquet(f"{folder}/manifest").withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0))))


def _dealt(manifest: DataFrame) -> DataFrame:
    """One file a task."""
    return manifest.repartition(max(1, manifest.count()))


def scan_records(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Per record, read back in file order and verified: doc_id, start (ids before it), n_tokens,
    ids_crc32 (over the ids as 32-bit integers) and, on request, the ids."""
    def read(batches):
        fs, root = file_system(folder)
        for batch in batches:
            for file, first in zip(column_list(batch, "file"), column_list(batch, "first_id"), strict=True):
                with fs.open_input_stream(f"{root}/{file}", buffer_size=1 << 20) as stream:
                    head = stream.read(8)
                    if head[:6] != MAGIC or head[6] != VERSION:
                        raise ValueError(f"{file} is no record file")
                    kind, rows, start, held = np.dtype(f"<u{head[7]}"), [], first, 0
                    while (payload := unframe(stream)) is not None:
                        has_id, doc_id = struct.unpack("<Bq", payload[:9])
                        ids = np.frombuffer(payload, kind, offset=9).astype("<u4")
                        row = (doc_id if has_id else None, start, len(ids), zlib.crc32(ids.tobytes()))
                        rows.append((*row, ids.astype(np.int64)) if with_ids else row)
                        start += len(ids)
                        held += len(ids) * with_ids
                        if len(rows) >= 10_000 or held > 1 << 20:
                            yield _batch(rows, with_ids)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, with_ids)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return _dealt(read_manifest(spark, folder).select("file", "first_id")).mapInArrow(read, schema)


def _batch(rows: list, with_ids: bool) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    arrays = [pa.array(c, pa.int64()) for c in cols[:4]]
    if with_ids:
        names.append("ids")
        arrays.append(pa.array(list(cols[4]), pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays(arrays, names)


def shuffled_records(spark: SparkSession, folder: str, seed: int = 0) -> DataFrame:
    """Records in a seeded random order, fetched through the index: (order_key, doc_id, ids).

    Every file's records are read at random offsets by its own task; ``order_key``
    is the place of a record in the global random order.
    """
    def read(batches):
        fs, root = file_system(folder)
        for batch in batches:
            for file, index, part, width in zip(*(column_list(batch, c) for c in ("file", "index", "part", "width")), strict=True):
                with fs.open_input_stream(f"{root}/{index}") as f:
                    entries = np.frombuffer(f.read(), INDEX)
                rng = np.random.default_rng((seed, part))
                with fs.open_input_file(f"{root}/{file}") as f:
                    for i in rng.permutation(len(entries)):
                        f.seek(int(entries["offset"][i]))
                        payload = unframe(f)
                        has_id, doc_id = struct.unpack("<Bq", payload[:9])
                        ids = np.frombuffer(payload, np.dtype(f"<u{width}"), offset=9).astype(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([float(rng.random())]), pa.array([doc_id if has_id else None], pa.int64()),
                             pa.array([ids], pa.list_(pa.int64()))], ["order_key", "doc_id", "ids"])

    return _dealt(read_manifest(spark, folder).select("file", "index", "part", "width")).mapInArrow(
        read, "order_key double, doc_id long, ids array<long>")


def binary_output(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write ``docs`` to ``folder`` (default: a new folder in the shared one) and read the files back."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    write_records(docs, folder, vocabulary)
    return scan_records(spark, folder)
