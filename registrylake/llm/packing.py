"""Packing by space-filling-curve order.

Each document's token ids are hashed onto ``DIMS`` Gaussian directions and averaged, the normal
distribution function spreads each coordinate evenly over the unit interval, and the Hilbert index of
that point is the document's key. A range sort by key puts documents that are alike next to one
another; each range is then one stream of ids that is cut into sequences. A sequence is padded to
``length`` unless its own length is a power of two, so the end of a stream is cut into powers of two
and nothing is padded.

Nulls, empties and ties: a null text is an empty document, which is its end id alone; equal keys are
ordered by doc_id (null first), then by the ids; repeated rows are packed as often as they occur; an
empty table gives no rows. ``sequence_id`` is unique and need not be dense.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.common import partitions_of, written
from registrylake.llm.encode import encoder, row_chunks

DIMS, BITS, HASHED, RANGE_BYTES = 4, 12, 1 << 14, 64 << 20
DIGESTS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of rows of integer coordinates below 2**bits, by axis transposition."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


_DIRECTIONS: dict = {}


def directions(size: int = HASHED, dims: int = DIMS) -> np.ndarray:
    if (size, dims) not in _DIRECTIONS:
        _DIRECTIONS[size, dims] = np.random.default_rng(20240229).standard_normal((size, dims)).astype("f4")
    return _DIRECTIONS[size, dims]


def bucket(tokens: np.ndarray) -> np.ndarray:
    """Token ids, of a vocabulary of any size, hashed to ``HASHED`` directions (multiply and take the high bits)."""
    return (tokens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - (HASHED.bit_length() - 1))).astype(np.int64)


def curve_point(ids: np.ndarray) -> np.ndarray:
    """Projection of the document's hashed counts, scaled by their length: near N(0, 1) for any text."""
    if not len(ids):
        return np.zeros(DIMS)
    tokens, counts = np.unique(ids, return_counts=True)
    weights = np.sqrt(counts.astype("f8"))
    return weights @ directions()[bucket(tokens)] / math.sqrt(float(weights @ weights))


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, key, n, ids: the sort table of the packer."""

    def encode(batches):
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for part in row_chunks(batch, 1):
                ids = enc.encode(part.column(1))
                points = np.array([curve_point(np.frombuffer(i, enc.dtype)) for i in ids])
                unit = np.array([[0.5 * (1 + math.erf(v / math.sqrt(2))) for v in p] for p in points])
                keys = hilbert_key(np.minimum(unit * (1 << BITS), (1 << BITS) - 1))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "key": keys, "n": pa.array([len(i) // enc.dtype.itemsize + 1 for i in ids], pa.int64()), "ids": pa.array([i + end for i in ids], pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encode, "doc_id long, key long, n long, ids binary")


def sequence_lengths(total: int, length: int):
    """Full sequences, then the powers of two of the rest."""
    for _ in range(total // length):
        yield length
    rest = total % length
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            yield 1 << bit


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048, digests: bool = False) -> DataFrame:
    """Pieces of packed sequences; see the module's text. One shuffle, of ids by curve key.

    ``digests``: a checksum of each piece's ids (as unsigned 32-bit integers) in place of the ids.
    """
    width = encoder(tokenizer).dtype.itemsize
    digest = (lambda part: zlib.crc32(np.frombuffer(part, f"<u{width}").astype("<u4").tobytes())) if digests else (lambda part: part)
    name = "ids_crc32" if digests else "ids"
    table = written(encoded(docs, tokenizer, end_id), "packing")

    def cut(batches):
        part = TaskContext.get().partitionId() << 40
        stream: list = []  # documents, not yet in a sequence: doc_id, ids, start
        held = seq = 0
        rows: dict = {k: [] for k in ("doc_id", "start", "length", name, "doc_tokens", "sequence_id", "offset")}

        def emit(size: int) -> None:
            nonlocal held, seq
            offset = at = 0
            while offset < size:
                doc_id, ids, start = stream[at]
                total = len(ids) // width
                take = min(total - start, size - offset)
                for k, v in zip(rows, (doc_id, start, take, digest(ids[start * width : (start + take) * width]), total, part + seq, offset)):
                    rows[k].append(v)
                offset += take
                if start + take == total:
                    at += 1
                else:
                    stream[at] = (doc_id, ids, start + take)
            del stream[:at]
            held -= size
            seq += 1

        def full() -> pa.RecordBatch:
            kinds = {"ids": pa.binary()}
            made = pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()})
            for v in rows.values():
                v.clear()
            return made

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stream.append((doc_id, ids, 0))
                held += len(ids) // width
                while held >= length:
                    emit(length)
                if len(rows["start"]) >= 4096:
                    yield full()
        for size in sequence_lengths(held, length):
            emit(size)
        yield full()

    parts = partitions_of(table, F.col("n") * width, RANGE_BYTES)
    return table.repartitionByRange(parts, "key", "doc_id").sortWithinPartitions("key", "doc_id", "ids").select("doc_id", "ids").mapInArrow(cut, DIGESTS if digests else PIECES)


def packed_rows(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The contract's columns for ``docs``."""
    import public_tokenizers

    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return pack(docs, path, digests=True)


def op6_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: all ``documents`` packed into sequences of at most 2048 tokens."""
    return packed_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
