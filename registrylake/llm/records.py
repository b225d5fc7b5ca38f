"""Token-ID / binary output: length-delimited binary records with masked checksums and an offset index.

File format (all numbers little-endian). A record is

    length  u64      bytes of the payload
    check   u32      masked crc32 of the eight length bytes
    payload          flags u8 (1: doc_id is null), doc_id i64, then the ids, u16 or u32
    check   u32      masked crc32 of the payload

and the index beside it is ``u64 count``, ``count`` offsets u64, ``count`` token counts u64 and a masked
crc32 u32 of all before; a reader can fetch records in any order with it. A masked checksum is the crc
rotated right by 15 bits plus 0xA282EAD8, so that checksums of data holding checksums stay useful.
Each task writes files under names of its own (an attempt that is lost leaves files nobody lists); the
manifest names those of the attempts that finished.

Nulls, empties and ties: a null text is an empty document (its record has the end id alone); a null
doc_id sorts first; rows that share a doc_id follow one another, by a digest of the text and the text; an empty table gives no shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.common import partitions_of, scratch
from registrylake.llm.encode import crc_of_ids, encoder, row_chunks

MASK_DELTA = 0xA282EAD8
MANIFEST = "part int, records string, offsets string, n_docs long, n_tokens long, width int"
READ_BYTES, SHARD_BYTES = 8 << 20, 64 << 20
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    payload = struct.pack("<Bq", doc_id is None, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(data, at: int) -> tuple[int | None, bytes, int]:
    """doc_id, id bytes and the next offset of the record at ``at``; raises on damage."""
    length = bytes(data[at : at + 8])
    (n,) = struct.unpack("<Q", length)
    if struct.unpack_from("<I", data, at + 8)[0] != masked_crc(length):
        raise ValueError(f"length of the record at {at} is damaged")
    payload = bytes(data[at + 12 : at + 12 + n])
    if len(payload) != n or struct.unpack_from("<I", data, at + 12 + n)[0] != masked_crc(payload):
        raise ValueError(f"payload of the record at {at} is damaged")
    null, doc_id = struct.unpack_from("<Bq", payload)
    return (None if null else doc_id), payload[9:], at + 16 + n


def pack_index(offsets: list[int], counts: list[int]) -> bytes:
    body = struct.pack("<Q", len(offsets)) + np.array(offsets, "<u8").tobytes() + np.array(counts, "<u8").tobytes()
    return body + struct.pack("<I", masked_crc(body))


def unpack_index(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if struct.unpack("<I", data[-4:])[0] != masked_crc(data[:-4]):
        raise ValueError("the index is damaged")
    (n,) = struct.unpack_from("<Q", data)
    both = np.frombuffer(data, "<u8", 2 * n, 8)
    return both[:n], both[n:]


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, shard_bytes: int = SHARD_BYTES) -> list:
    """Encodes ``docs`` (doc_id, text) in doc_id order into record files under ``folder``; returns the manifest.

    One range shuffle of the texts by doc_id, into shards of about ``shard_bytes`` of text; encoding and writing are one
    step after it. Records are read back ``READ_BYTES`` at a time. The manifest has a row for each shard (not for each document), in order of doc_id.
    """

    def write(batches):
        enc, own = encoder(tokenizer), f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        end = np.array([end_id], enc.dtype).tobytes()
        records, index = f"{folder}/{own}.rec", f"{folder}/{own}.idx"
        out, at, offsets, counts = None, 0, [], []
        for batch in batches:
            for part in row_chunks(batch, 1):
                for doc_id, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1))):
                    if out is None:
                        fs_, name = _opened(records)
                        fs_.create_dir(name.rsplit("/", 1)[0], recursive=True)
                        out = fs_.open_output_stream(name)
                    data = frame(doc_id, ids + end)
                    out.write(data)
                    offsets.append(at)
                    counts.append(len(ids) // enc.dtype.itemsize + 1)
                    at += len(data)
        if out is not None:
            out.close()
            fs_, name = _opened(index)
            with fs_.open_output_stream(name) as f:
                f.write(pack_index(offsets, counts))
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "records": [records], "offsets": [index], "n_docs": [len(counts)], "n_tokens": [sum(counts)], "width": pa.array([enc.dtype.itemsize], pa.int32())})

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("t"))
    parts = partitions_of(ordered, F.octet_length("text"), shard_bytes)
    # The digest lets a doc_id that very many rows share (or lack) span several shards.
    ordered = ordered.repartitionByRange(parts, "doc_id", "t").sortWithinPartitions("doc_id", "t", "text").select("doc_id", "text")
    return sorted(ordered.mapInArrow(write, MANIFEST).collect(), key=lambda r: r.part)


def read_records(spark: SparkSession, manifest: list) -> DataFrame:
    """What the files hold: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    if not manifest:
        return spark.createDataFrame([], READ)
    rows, start = [], 0
    for m in manifest:
        rows.append((m.records, m.offsets, int(m.width), start))
        start += m.n_tokens

    def read(batches):
        for batch in batches:
            for records, index, width, base in zip(*(c.to_pylist() for c in batch.columns)):
                fs_, name = _opened(index)
                with fs_.open_input_stream(name) as f:
                    offsets, counts = unpack_index(f.read())
                starts = base + np.concatenate(([0], np.cumsum(counts)[:-1])).astype("i8")
                fs_, name = _opened(records)
                with fs_.open_input_file(name) as f:
                    ends = np.append(offsets[1:], f.size()).astype("i8")
                    lo = 0
                    while lo < len(offsets):
                        at = int(offsets[lo])
                        hi = max(lo + 1, int(np.searchsorted(ends, at + READ_BYTES, side="right")))
                        f.seek(at)
                        block = f.read(int(ends[hi - 1]) - at)
                        got = [unframe(memoryview(block), int(o) - at) for o in offsets[lo:hi]]
                        ids = [np.frombuffer(g[1], f"<u{width}") for g in got]
                        if [len(i) for i in ids] != counts[lo:hi].tolist():
                            raise ValueError("index and records differ")
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array([g[0] for g in got], pa.int64()), "start": starts[lo:hi], "n_tokens": pa.array([len(i) for i in ids], pa.int64()), "ids_crc32": pa.array([crc_of_ids(i) for i in ids], pa.int64())})
                        lo = hi

    shards = spark.createDataFrame(rows, "records string, offsets string, width int, start long")
    return shards.repartition(len(rows)).mapInArrow(read, READ)


def op3_token_records(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """op3: every whole text of ``documents`` through the record files and back."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    manifest = write_records(docs, scratch(spark, "records"), tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    return read_records(spark, manifest)
