"""Benchmark decontamination on a distributed positional inverted index.

The index is cut by documents into *shards* of about ``SHARD_WORDS`` words, each an inverted index of its
own: a row for each term with its posting list (addresses within the shard, as differences), and a row for each
document with the address of its first word. Between two documents one address stays empty, so that no phrase
crosses them. The index is a Parquet table in the shared folder.

A search reads the postings of the phrases' terms only, once, and goes through the phrases in blocks of bounded size, which are
a table of the shared folder too; within each shard it intersects offset-adjusted lists, starting from the phrase's rarest term there: a start that the
rarest term proposes lives on while each next-rarest term has a posting at its offset.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z to a-z. Nulls, empties, ties and repeats: a
null text has no words; an item without words has no windows, one of fewer than ``width`` words is one
window; a null item_id hits words but is not listed; items that share a window are all listed; rows that
share a doc_id are separate documents; an empty table of documents gives no rows, an empty benchmark hits
nothing.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.common import rows_at, written, written_at
from registrylake.llm.encode import row_chunks

SHARD_WORDS = 400_000
INDEX = "shard long, term binary, postings array<int>, doc_id long, base int, n_words int"
MATCHES = "doc_id long, n_words long, starts array<int>, ends array<int>, items array<string>"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index of ``docs`` (doc_id, text); one pass over the texts, no shuffle."""

    def shard(number: int, terms: dict, ids: list, docs_: list) -> pa.RecordBatch:
        doc_ids, bases, sizes = (list(x) for x in zip(*docs_))
        starts = np.repeat(np.array(bases, np.int64), sizes)
        local = np.arange(len(starts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        both = np.concatenate(ids).astype(np.int64) << 32 | (starts + local)
        both.sort()
        term, at = both >> 32, (both & 0xFFFFFFFF).astype(np.int32)
        cuts = np.flatnonzero(np.diff(term, prepend=-1))
        gaps = np.diff(at, prepend=0).astype(np.int32)
        gaps[cuts] = at[cuts]
        n, m = len(docs_), len(terms)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate((cuts, np.full(n + 1, len(at)))).astype(np.int32)), pa.array(gaps))
        return pa.RecordBatch.from_pydict({
            "shard": np.full(n + m, number), "term": pa.array([*terms, *[None] * n], pa.binary()), "postings": lists,
            "doc_id": pa.array([*[None] * m, *doc_ids], pa.int64()), "base": pa.array([*[None] * m, *bases], pa.int32()), "n_words": pa.array([*[None] * m, *sizes], pa.int32()),
        })

    def build(batches):
        numbers = count(TaskContext.get().partitionId() << 24)
        terms: dict = defaultdict(count().__next__)
        ids, docs_, at = [], [], 0
        for part in (p for batch in batches for p in row_chunks(batch, 1)):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = words_of(text)
                ids.append(np.fromiter(map(terms.__getitem__, words), np.int32, len(words)))
                docs_.append((doc_id, at, len(words)))
                at += len(words) + 1
                if at >= shard_words:
                    yield shard(next(numbers), terms, ids, docs_)
                    terms, ids, docs_, at = defaultdict(count().__next__), [], [], 0
        if docs_:
            yield shard(next(numbers), terms, ids, docs_)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(plain.mapInArrow(build, INDEX), "index")


class Postings:
    """The lists of one shard, as one sorted array of (term, address)."""

    def __init__(self, terms: list, lists: list):
        self.number = {t: i for i, t in enumerate(terms)}
        self.lists = [np.cumsum(x) for x in lists]
        self.sizes = np.array([len(x) for x in self.lists], np.int64)
        self.keys = np.concatenate([np.zeros(0, np.int64), *[x + (i << 32) for i, x in enumerate(self.lists)]])

    def phrases(self, phrases: list, most: int = 2_000_000):
        """Yields ``(phrase numbers, start addresses)`` of the exact matches; ``most`` starts at a time."""
        whole = []
        for p, terms in enumerate(phrases):
            got = [self.number.get(t, -1) for t in terms]
            if -1 not in got:
                whole.append((p, got, np.argsort(self.sizes[got], kind="stable").tolist()))
        at = 0
        while at < len(whole):
            upto, total = at, 0
            while upto < len(whole) and (upto == at or total + self.sizes[whole[upto][1][whole[upto][2][0]]] <= most):
                total += self.sizes[whole[upto][1][whole[upto][2][0]]]
                upto += 1
            part = whole[at:upto]
            at = upto
            longest = max(len(g) for _, g, _ in part)
            terms, offsets = np.full((len(part), longest), -1, np.int64), np.zeros((len(part), longest), np.int64)
            for i, (_, g, order) in enumerate(part):
                terms[i, : len(g)] = np.array(g)[order]
                offsets[i, : len(g)] = order
            firsts = [self.lists[t] for t in terms[:, 0]]
            who = np.repeat(np.arange(len(part)), [len(x) for x in firsts])
            start = np.concatenate(firsts) - offsets[who, 0]
            for k in range(1, longest):
                need = terms[who, k]
                key = (need << 32) + start + offsets[who, k]
                found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                keep = (need < 0) | ((self.keys[found] == key) & (start >= 0))
                who, start = who[keep], start[keep]
                if not len(who):
                    break
            if len(who):
                yield np.array([p for p, _, _ in part])[who], start

    def together(self, terms: list, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last address of each place where all ``terms`` lie within ``width`` addresses."""
        got = [self.number.get(t, -1) for t in set(terms)]
        if not got or -1 in got:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        got.sort(key=lambda t: self.sizes[t])
        first = np.unique(np.concatenate([self.lists[t] for t in got]))
        last = first.copy()
        for t in got:
            at = np.searchsorted(self.lists[t], first)
            ok = at < len(self.lists[t])
            first, last, at = first[ok], last[ok], at[ok]
            last = np.maximum(last, self.lists[t][at])
            ok = last - first < width
            first, last = first[ok], last[ok]
        return first, last


def _opened(table: pa.Table):
    """Postings and documents (sorted by address) of one shard's rows."""
    docs = [r for r in zip(*(table.column(c).to_pylist() for c in ("term", "base", "doc_id", "n_words"))) if r[1] is not None]
    docs.sort(key=lambda r: r[1])
    rows = table.filter(pc.is_valid(table.column("term")))
    lists = rows.column("postings").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int32()))
    values, cuts = lists.flatten().to_numpy(), (lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]) if len(lists) else np.zeros(1, np.int64)
    return Postings(rows.column("term").to_pylist(), [values[a:b].astype(np.int64) for a, b in zip(cuts, cuts[1:])]), docs


def _for_terms(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Document rows and the posting rows of ``terms`` (term); the optimizer broadcasts the terms if their written size allows it."""
    return index.filter(F.col("term").isNull()).unionByName(index.filter(F.col("term").isNotNull()).join(terms, "term", "left_semi").select(index.columns))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint ascending spans that cover the same places."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.concatenate(([True], starts[1:] > ends[:-1])) if len(starts) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return starts[at], ends[np.append(at[1:], len(ends)) - 1] if len(at) else ends


def phrase_matches(index: DataFrame, path: str, terms: DataFrame) -> DataFrame:
    """A row for each document: spans of exact matches of the phrases at ``path`` (see ``phrase_blocks``), and their names.

    ``terms``: the phrases' terms. A task holds the postings of one shard and one block of phrases at a time.
    """

    def search(table: pa.Table) -> pa.Table:
        postings, docs = _opened(table)
        bases = np.array([r[1] for r in docs], np.int64)
        spans, names = defaultdict(list), defaultdict(set)
        for items in _phrases_at(path):
            lengths = np.array([len(p) for p, _ in items], np.int64)
            for which, start in postings.phrases([p for p, _ in items]):
                doc = np.searchsorted(bases, start, side="right") - 1
                order = np.argsort(doc, kind="stable")
                which, start, doc = which[order], start[order], doc[order]
                cuts = np.flatnonzero(np.diff(doc, prepend=-1))
                for a, b in zip(cuts, [*cuts[1:], len(doc)]):
                    d = int(doc[a])
                    lo = start[a:b] - bases[d]
                    spans[d].append((lo, lo + lengths[which[a:b]]))
                    for w in np.unique(which[a:b]):
                        names[d].update(items[w][1])
        rows: dict = {k: [] for k in ("doc_id", "n_words", "starts", "ends", "items")}
        for d, (_, _, doc_id, n) in enumerate(docs):
            lo, hi = merged(*(np.concatenate(x) for x in zip(*spans[d]))) if d in spans else ((), ())
            for k, v in zip(rows, (doc_id, n, list(lo), list(hi), sorted(names.get(d, ())))):
                rows[k].append(v)
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()))
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), kinds)})

    return _for_terms(index, terms).groupBy("shard").applyInArrow(search, MATCHES)


_LAST: dict = {}


def _phrases_at(path: str):
    """The blocks of phrases at ``path``; a worker keeps the only block of a small benchmark."""
    if path in _LAST:
        yield _LAST[path]
        return
    blocks = 0
    for (data,) in rows_at(path):
        items = pickle.loads(data)
        blocks += 1
        yield items
    if blocks == 1:
        _LAST.clear()
        _LAST[path] = items


def proximity_matches(index: DataFrame, terms: list, width: int) -> DataFrame:
    """doc_id, start, end of the places where all ``terms`` occur within ``width`` words, in any order."""
    wanted = [t if isinstance(t, bytes) else t.encode() for t in terms]

    def search(table: pa.Table) -> pa.Table:
        found, docs = _opened(table)
        first, last = found.together(wanted, width)
        bases = np.array([r[1] for r in docs], np.int64)
        doc = np.searchsorted(bases, first, side="right") - 1
        same = doc == np.searchsorted(bases, last, side="right") - 1
        first, last, doc = first[same], last[same], doc[same]
        return pa.table({"doc_id": pa.array([docs[d][2] for d in doc], pa.int64()), "start": pa.array(first - bases[doc], pa.int64()), "end": pa.array(last - bases[doc] + 1, pa.int64())})

    asked = index.sparkSession.createDataFrame([(bytearray(t),) for t in sorted(set(wanted))], "term binary")
    return _for_terms(index, asked).groupBy("shard").applyInArrow(search, "doc_id long, start long, end long")


def windows_of(words: list, width: int) -> list:
    if not words:
        return []
    return [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]


def phrase_blocks(benchmark: DataFrame, width: int, block_chars: int = 4_000_000) -> tuple[str, DataFrame]:
    """The benchmark's windows: the path of a table of blocks, each a list of (window, item ids) from about ``block_chars`` of text; and their terms."""
    plain = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))

    def build(batches):
        phrases: dict = {}
        size = 0
        for part in (p for batch in batches for p in row_chunks(batch, 1)):
            for item_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for window in windows_of(words_of(text), width):
                    phrases.setdefault(window, set()).update([item_id] if item_id is not None else [])
                size += len(text or "")
                if size >= block_chars:
                    yield pa.RecordBatch.from_pydict({"phrases": pa.array([pickle.dumps(list(phrases.items()))], pa.binary())})
                    phrases, size = {}, 0
        if phrases:
            yield pa.RecordBatch.from_pydict({"phrases": pa.array([pickle.dumps(list(phrases.items()))], pa.binary())})

    def terms(batches):
        for part in (p for batch in batches for p in row_chunks(batch, 1)):
            met = {w for text in part.column(1).to_pylist() for w in words_of(text)}
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(met), pa.binary())})

    _, path = written_at(plain.mapInArrow(build, "phrases binary"), "phrases")
    return path, written(plain.mapInArrow(terms, "term binary").distinct(), "terms")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20, block_chars: int = 4_000_000, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, starts, ends, items, contaminated of every row of ``docs``."""
    path, terms = phrase_blocks(benchmark, width, block_chars)
    rows = phrase_matches(build_index(docs, shard_words), path, terms)
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    hit = rows.withColumn("n_hit", n_hit)
    return hit.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: benchmark hits of every document of ``documents``."""
    rows = contamination(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows
), grams AS (
  SELECT doc_id, s.n, i, array_to_string(w[i : i + s.n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n) s
), hits AS (
  SELECT doc_id, item_id, i, g.n FROM grams g JOIN windows USING (n, g)
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""
