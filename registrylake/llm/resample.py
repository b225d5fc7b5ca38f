"""Importance resampling towards a target distribution, with n-gram hashes by CRC combination.

A feature is a run of 1 to ``most`` words; its bucket is the CRC-32 of the words joined by one space, modulo ``buckets``.
CRC-32 is linear over GF(2): appending k bytes to a text multiplies its CRC by a fixed matrix to the power of k and adds
the CRC of what was appended. So the CRC of each distinct word of a slice of texts is computed once, and those of longer
runs are put together from them with powers of that matrix; no run's text is ever made.

A bucket's gain is the logarithm of its share in the target over its share in the documents, both with one added; a
document's weight is the sum over its features. Adding Gumbel noise, a function of seed and doc_id alone, and taking the
highest scores draws without replacement in proportion to exp(weight).

Features are made once and kept as a table of bucket numbers. What tasks hold beside a slice of texts is the gains, one
number a bucket. Ranks come from a range sort: a row's place in its range and the sizes of the ranges before.

Nulls, empties, ties and repeats: a null or empty text has no words, weight 0 and no rank; equal scores go by doc_id, null
last, and rows of one doc_id and score by their numbers of words and features; repeated rows are drawn as often as they occur; a
null doc_id draws its noise from the text ``null``; an empty target or an empty table gives gains of shares that are all
equal or no rows. Extra columns are not carried; ``drawn`` returns the rows themselves.
"""

from __future__ import annotations

import math
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registrylake.llm.common import partitions_of, read_table, written
from registrylake.llm.encode import row_chunks

BUCKETS, LEAST_WORDS, PERCENT, SEED, RANGE_BYTES = 10_000, 20, 10, 2024, 64 << 20
#: The reversed polynomial of CRC-32 (a fixed value).
POLYNOMIAL = 0xEDB88320
#: Every byte that is no letter, digit or part of a longer character becomes a space; A-Z become small.
WORD_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()
SPACE_CRC = zlib.crc32(b" ")


def words_of(text: str | None) -> list:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split(b" ")


def _times(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A 32 x 32 bit matrix (as its results for each byte at each of the four places) times a vector of CRCs."""
    return tables[0][x & 255] ^ tables[1][x >> 8 & 255] ^ tables[2][x >> 16 & 255] ^ tables[3][x >> 24]


def _tables(columns: np.ndarray) -> np.ndarray:
    """The results of a matrix, given by its 32 columns, for each byte at each place."""
    out = np.zeros((4, 256), np.uint32)
    for place in range(4):
        for bit in range(8):
            out[place] ^= np.where(np.arange(256) >> bit & 1, columns[8 * place + bit], 0).astype(np.uint32)
    return out


@cache
def shift(power: int) -> np.ndarray:
    """The matrix that appends 2**power zero bytes to a text whose CRC is known; each is the square of the one before."""
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    if power == 0:
        columns = unit
        for _ in range(8):  # bit by bit: a division step of the reversed polynomial
            columns = np.where(columns & 1, (columns >> 1) ^ np.uint32(POLYNOMIAL), columns >> 1).astype(np.uint32)
        return _tables(columns)
    half = shift(power - 1)
    return _tables(_times(half, _times(half, unit)))


def appended(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRCs after ``lengths`` zero bytes each: one matrix for each bit of a length."""
    out = crcs.astype(np.uint32)
    for power in range(int(lengths.max(initial=0)).bit_length()):
        on = (lengths >> power & 1) == 1
        out[on] = _times(shift(power), out[on])
    return out


def joined(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs of ``left + b" " + right`` from those of both sides and the lengths of the right ones."""
    spaced = appended(left, np.ones(len(left), np.int64)) ^ np.uint32(SPACE_CRC)
    return appended(spaced, lengths) ^ right


def run_crcs(words: np.ndarray, lengths: np.ndarray, doc: np.ndarray, most: int):
    """For each number of words up to ``most``: (document, CRC) of each run inside a document, in order of its first word."""
    crcs = words
    yield doc, crcs
    for n in range(2, min(most, len(crcs)) + 1):
        crcs = joined(crcs[:-1], words[n - 1 :], lengths[n - 1 :])
        inside = doc[: len(crcs)] == doc[n - 1 :]
        yield doc[: len(crcs)][inside], crcs[inside]


def features(docs: DataFrame, most: int, buckets: int) -> DataFrame:
    """doc_id, n_words, n_features and the buckets of all features of each row."""

    def run(batches):
        for part in (p for batch in batches for p in row_chunks(batch, 1)):
            texts = [[w for w in words_of(t) if w] for t in part.column(1).to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            coded = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            code = coded.indices.to_numpy()
            crcs = np.array([zlib.crc32(w) for w in distinct], np.uint32)[code] if distinct else np.zeros(0, np.uint32)
            lengths = np.array([len(w) for w in distinct], np.int64)[code] if distinct else np.zeros(0, np.int64)
            runs = list(run_crcs(crcs, lengths, np.repeat(np.arange(len(texts)), sizes), most))
            doc = np.concatenate([d for d, _ in runs])
            bucket = (np.concatenate([c for _, c in runs]) % np.uint32(buckets)).astype(np.int32)
            ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
            held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(bucket[np.argsort(doc, kind="stable")], pa.int32()))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "n_words": pa.array(sizes), "n_features": pa.array(np.diff(ends, prepend=0), pa.int64()), "buckets": held})

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_words long, n_features long, buckets array<int>")


def bucket_counts(held: DataFrame) -> dict:
    """How often each bucket occurs: at most one row a bucket comes to the driver."""
    return {r[0]: r[1] for r in held.select(F.explode("buckets").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()}


def gains(of_docs: dict, of_target: dict, buckets: int) -> np.ndarray:
    """Of each bucket, floor(1000 ln(share in the target / share in the documents)), both counts with one added."""
    s, t = sum(of_docs.values()) + buckets, sum(of_target.values()) + buckets
    ratio = lambda b: float((of_target.get(b, 0) + 1) * s) / float((of_docs.get(b, 0) + 1) * t)
    return np.array([math.floor(1000 * math.log(ratio(b))) for b in range(buckets)], np.int64)


def weighted(held: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight, the sum of the gains of a row's features."""

    def run(batches):
        for batch in batches:
            at = batch.column(3)
            total = np.concatenate([[0], np.cumsum(gain[at.flatten().to_numpy()])]).astype(np.int64)
            ends = at.offsets.to_numpy() - at.offsets[0].as_py()
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_words": batch.column(1), "n_features": batch.column(2), "weight": pa.array(np.diff(total[ends]), pa.int64())})

    return held.select("doc_id", "n_words", "n_features", "buckets").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id, seed: int):
    """A Gumbel variate in thousandths, from the first 32 bits of the SHA-256 of ``seed:doc_id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, fits, order: list) -> DataFrame:
    """``rows`` with ``rank``: from 1 by ``order`` among those that ``fits``, null for the others. One shuffle, by ranges."""
    parts = partitions_of(rows, F.lit(64), RANGE_BYTES)
    cut = rows.withColumn("__rl_fits", fits).repartitionByRange(parts, F.desc("__rl_fits"), *order).withColumn("__rl_range", F.spark_partition_id())
    cut = written(cut, "score-ranges")
    sizes = cut.groupBy("__rl_range").agg(F.count_if("__rl_fits").alias("n"))  # one row a range
    before = F.coalesce(F.sum("n").over(W.orderBy("__rl_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(W.partitionBy("__rl_range").orderBy(F.desc("__rl_fits"), *order)) + F.col("__rl_before")
    both = cut.join(sizes.select("__rl_range", before.alias("__rl_before")), "__rl_range")
    return both.withColumn("rank", F.when(F.col("__rl_fits"), place.cast("long"))).drop("__rl_range", "__rl_before", "__rl_fits")


def importance(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``; ``target`` needs a column ``text``.

    Drawn, that is ranked, are the ``percent`` of the rows with at least ``least_words`` words that score highest.
    """
    held = written(features(docs, most, buckets), "features")
    wanted = features(target.select(F.lit(0).cast("long").alias("doc_id"), "text"), most, buckets)
    scored = written(weighted(held, gains(bucket_counts(held), bucket_counts(wanted), buckets)), "weights")
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    fits = F.col("n_words") >= least_words
    take = percent * scored.filter(fits).count() // 100
    rows = ranked(scored, fits, [F.desc("score"), F.asc_nulls_last("doc_id"), "n_words", "n_features"])
    return rows.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))


def drawn(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose doc_id was drawn."""
    ids = importance(docs, target, **how).filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__rl_id")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("__rl_id")), "left_semi")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every document's weight, score and rank, with the benchmark's texts as the target."""
    out = importance(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = r"""
WITH RECURSIVE step(i, c) AS (
  SELECT i, i::BIGINT AS c FROM range(256) t(i)
), table_(i, c) AS (
  SELECT i, list_reduce(range(8)::BIGINT[], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, c) FROM step
), docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), aims AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark
), used AS (SELECT doc_id, unnest(ws) AS w FROM docs),
word AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM (SELECT w FROM used UNION ALL SELECT w FROM aims)),
crc(w, x, pos, c) AS (
  SELECT w, x, 0, 4294967295::BIGINT FROM word
  UNION ALL
  SELECT w, x, pos + 1, xor(t.c, k.c // 256) FROM crc k JOIN table_ t ON t.i = xor(k.c % 256, ('0x' || substr(x, 2 * pos + 1, 2))::BIGINT) WHERE 2 * pos < length(x)
), bucket AS (SELECT w, xor(c, 4294967295) % 10000 AS b FROM crc WHERE 2 * pos = length(x)),
s AS (SELECT b, count(*) AS n FROM used JOIN bucket USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM aims JOIN bucket USING (w) GROUP BY b),
gain AS (
  SELECT b.b, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000))::DOUBLE
         / ((coalesce(s.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000))::DOUBLE))::BIGINT AS g
  FROM (SELECT DISTINCT b FROM bucket) b LEFT JOIN s USING (b) LEFT JOIN t USING (b)
), weight AS (SELECT doc_id, sum(g)::BIGINT AS weight FROM used JOIN bucket USING (w) JOIN gain USING (b) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weight USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""
