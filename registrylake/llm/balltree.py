"""Exact top-k inner-product search by branch and bound on one ball tree per shard.

Every component x becomes floor(1024 * x). Vectors are dealt by the cells of a top tree, which is split by the widest dimension of a sample of some
``SAMPLE`` vectors and says only which vectors lie together; cells are range-sorted, so that a cell of any size is the work of several tasks. A shard, at
most ``shard_size`` neighbours of that order, is a balanced ball tree, kept as one row of a table in the shared folder, its own ball in another; so are blocks of queries, in the same order.

No shard meets all queries. Each block compares its queries with the balls of the shards, a chunk of balls at a time: at first a query's best shard is searched; the k-th score found there
bounds the query's k-th score from below, and only (shard, block) pairs in which some query's bound ``q.center + |q| * radius`` reaches that score are read, an eighth of them first, whose scores
are shared before the others are chosen. Within a shard the search goes down the tree with all queries of a block at once, drops (query, node) pairs
whose bound falls below the shared or its own k-th score, and takes the leaves that are
left in order of their bounds. Scores are exact integers; bounds are widened by more than their rounding.

Nulls, empties and ties: vectors that are null, or hold a null or a non-finite component, take no part;
vectors of unequal length are padded with zeros (an empty one scores 0); equal scores are ordered by
vec_id; rows that share a vec_id are all candidates, but never of a query with that id, and such queries
are each answered; a null vec_id is a candidate only, after all others among equals; scores beyond 64 bits are cut to the largest
or smallest long; an empty table gives no rows.
"""

from __future__ import annotations

import io
import itertools
import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registrylake.llm.common import rows_at, written, written_at

K, LEAF, SHARD, BLOCK, SAMPLE, CHUNK = 10, 64, 16_384, 4_096, 8_192, 512
BLOCKS = "b long, queries binary, kth binary"
TREES = "s long, tree binary, center binary, radius double, scale double"
FOUND = "b long, q int, query_id long, vec_id long, score long"
LOW, HIGH = -(1 << 63), (1 << 63) - 1
NO_ID = HIGH  # stands for a null vec_id inside a shard


def usable(table: DataFrame) -> DataFrame:
    """vec_id and embedding (double) of the vectors that take part."""
    e = F.col("embedding").cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).filter(F.col("embedding").isNotNull() & fine)


def whole(rows: list) -> np.ndarray:
    """Matrix of floor(1024 * x), zero-padded; int64, or Python integers where those are too small."""
    out = padded(rows)
    width = out.shape[1]
    out = np.floor(1024 * out)
    if not np.isfinite(out).all():
        import math

        return np.array([[math.floor(x * 1024) if abs(x) < 1e300 else math.floor(x) * 1024 for x in [*r, *[0.0] * (width - len(r))]] for r in rows], object)
    return out.astype(np.int64) if not out.size or np.abs(out).max() < 2.0**62 else np.array([[int(x) for x in r] for r in out], object)


def padded(rows: list, width: int = 0) -> np.ndarray:
    out = np.zeros((len(rows), max(width, max(map(len, rows), default=0))))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of q and v, as int64."""
    d = min(q.shape[1], v.shape[1])
    q, v = q[:, :d], v[:, :d]
    if not d or not q.size or not v.size:
        return np.zeros((len(q), len(v)), np.int64)
    most = d * int(np.abs(q).max()) * int(np.abs(v).max())
    if most < 1 << 53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    got = q.astype(object) @ v.astype(object).T
    return np.clip(got, LOW, HIGH).astype(np.int64)


class BallTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        # Scaled so that squares of the largest components stay finite.
        top = max((abs(int(x)) for x in (vectors.max(), vectors.min())), default=1) if vectors.size else 1
        self.scale = 2.0 ** max(0, top.bit_length() - 60)
        real = (vectors / self.scale).astype(np.float64) if vectors.dtype == object else vectors.astype(np.float64) / self.scale
        nodes, spans, todo = [], [], [(0, len(ids), 0)]
        self.first_child: list = []
        while todo:
            rest = []
            for lo, hi, _ in todo:
                part = real[order[lo:hi]]
                center = part.mean(axis=0) if hi > lo else np.zeros(real.shape[1])
                radius = float(np.sqrt(((part - center) ** 2).sum(axis=1).max())) if part.size else 0.0
                nodes.append((center, radius * (1 + 1e-9) + 1e-9))
                spans.append((lo, hi))
                if hi - lo > leaf and radius > 0:
                    dim = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                    mid = (hi - lo) // 2
                    order[lo:hi] = order[lo:hi][np.argpartition(part[:, dim], mid)]
                    self.first_child.append(len(nodes) + len(todo) - todo.index((lo, hi, _)) - 1 + len(rest))
                    rest += [(lo, lo + mid, 0), (lo + mid, hi, 0)]
                else:
                    self.first_child.append(-1)
            todo = rest
        self.ids, self.vectors = ids[order], vectors[order]
        self.centers = np.array([c for c, _ in nodes]).reshape(len(nodes), real.shape[1])
        self.radii, self.spans = np.array([r for _, r in nodes]), np.array(spans)
        self.first_child = np.array(self.first_child)

    def dump(self) -> bytes:
        out = io.BytesIO()
        vectors = self.vectors if self.vectors.dtype != object else np.array([[str(x) for x in r] for r in self.vectors])
        np.savez(out, ids=self.ids, vectors=vectors, centers=self.centers, radii=self.radii, spans=self.spans, first_child=self.first_child, scale=self.scale)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> BallTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as z:
            for k in z.files:
                setattr(tree, k, z[k])
        if tree.vectors.dtype.kind == "U":
            tree.vectors = np.array([[int(x) for x in r] for r in tree.vectors], object)
        tree.scale = float(tree.scale)
        return tree

    def _bounds(self, q: np.ndarray, norm: np.ndarray, who: np.ndarray, node: np.ndarray) -> np.ndarray:
        d = min(q.shape[1], self.centers.shape[1])
        out = np.empty(len(who))
        for lo in range(0, len(who), 1 << 15):
            a, b = who[lo : lo + (1 << 15)], node[lo : lo + (1 << 15)]
            out[lo : lo + (1 << 15)] = np.einsum("ij,ij->i", q[a, :d], self.centers[b, :d]) + norm[a] * self.radii[b]
        size = norm[who] * (np.sqrt((self.centers[node] ** 2).sum(axis=1)) + self.radii[node])
        return (out + 1e-9 * size + 1e-9) * self.scale

    def search(self, query_ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int = K, first_only: bool = False):
        """``(query numbers, vec_ids, scores)`` of at most k a query that can be among its best.

        ``kth``: a score that the query's k-th best reaches surely (-inf: none known). ``first_only``
        scores each query's most promising leaf alone.
        """
        q = queries.astype(np.float64)
        norm = np.sqrt((q**2).sum(axis=1)) * (1 + 1e-12)
        kth = kth.astype(np.float64).copy()
        who, node = np.arange(len(q)), np.zeros(len(q), np.int64)
        bound = self._bounds(q, norm, who, node)
        leaves = []
        while len(who):
            keep = bound >= kth[who]
            who, node, bound = who[keep], node[keep], bound[keep]
            end = self.first_child[node] < 0
            leaves.append((who[end], node[end], bound[end]))
            who, node = who[~end], node[~end]
            if not len(who):
                break
            left = self.first_child[node]
            two = np.stack((self._bounds(q, norm, who, left), self._bounds(q, norm, who, left + 1)))
            if first_only:  # follow the better child alone
                better = np.argmax(two, axis=0)
                node, bound = left + better, two[better, np.arange(len(who))]
            else:
                who, node, bound = np.concatenate((who, who)), np.concatenate((left, left + 1)), two.ravel()
        who, node, bound = (np.concatenate(x) for x in zip(*leaves)) if leaves else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((-bound, who))
        who, node, bound = who[order], node[order], bound[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        done, step = 0, 1
        while len(who):
            now = (place < done + step) & (bound >= kth[who])
            later = (place >= done + step) & (bound >= kth[who])
            if now.any():
                best = self._scored(query_ids, queries, who[now], node[now], kth, best, k)
            who, node, bound, place = who[later], node[later], bound[later], place[later]
            done, step = done + step, step * 2
        return best

    def _scored(self, query_ids, queries, who, node, kth, best, k):
        found = [best]
        order = np.argsort(node, kind="stable")
        who, node = who[order], node[order]
        cuts = np.flatnonzero(np.diff(node, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(node)]):
            lo, hi = self.spans[node[a]]
            for from_ in range(lo, hi, 8192):  # a leaf of equal vectors may be large
                upto = min(hi, from_ + 8192)
                score = products(queries[who[a:b]], self.vectors[from_:upto])
                ids = self.ids[from_:upto]
                i, j = np.nonzero((score >= kth[who[a:b], None]) & (ids[None, :] != query_ids[who[a:b], None]))
                found.append((who[a:b][i], ids[j], score[i, j]))
                if sum(len(f[0]) for f in found) > 1 << 21:
                    found = [top(found, k)]
        best = top(found, k)
        number, size = np.unique(best[0], return_counts=True)
        last = np.cumsum(size) - 1
        full = size >= k
        kth[number[full]] = np.maximum(kth[number[full]], best[2][last[full]])
        return best


def top(found: list, k: int) -> tuple:
    who, ids, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((ids, ~score, who))
    who, ids, score = who[order], ids[order], score[order]
    keep = np.arange(len(who)) - np.searchsorted(who, who) < k
    return who[keep], ids[keep], score[keep]


def top_cells(vectors: DataFrame, n: int, size: int) -> list:
    """Splits (dimension, threshold, left, right) of a top tree whose cells hold about ``size`` of the ``n`` vectors; a cell is a number below zero, -1 first.

    It is learned from some ``SAMPLE`` vectors, chosen by their ids' hashes, and decides only which vectors share a shard, never a result.
    """
    some = vectors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(-(-n // SAMPLE) or 1)) == 0).limit(2 * SAMPLE)
    rows = padded([r[0] for r in some.select("embedding").collect()])
    splits: list = []
    cells = itertools.count(1)

    def cut(part: np.ndarray, depth: int) -> int:
        spread = np.ptp(part, axis=0) if part.size else np.zeros(0)
        if depth == 64 or len(part) <= max(8, size * len(rows) // max(n, 1)) or not spread.size or not spread.max():
            return -next(cells)
        dim = int(np.argmax(spread))
        line = np.sort(part[:, dim])
        lo, hi = len(line) // 4, max(len(line) - len(line) // 4, len(line) // 4 + 2)
        gaps, most = np.diff(line[lo:hi]), line[len(line) // 2]
        if gaps.max():  # the widest gap of the middle half, so that few clusters are cut
            limit = float(line[lo + int(np.argmax(gaps)) + 1])
        else:  # one value fills it: what lies on the fuller side of it is parted
            above = line[line > most]
            limit = float(above[0] if 2 * len(above) >= (line != most).sum() else most)
        left = part[:, dim] < limit
        at = len(splits)
        splits.append(None)
        splits[at] = (dim, limit, cut(part[left], depth + 1), cut(part[~left], depth + 1))
        return at

    cut(rows, 0)
    return splits


def cell_of(rows: np.ndarray, splits: list) -> np.ndarray:
    """The cell of each row: 1 and up, in the order of the tree's leaves."""
    cell = np.ones(len(rows), np.int32)
    todo = [(0, np.arange(len(rows)))] if splits else []
    while todo:
        at, who = todo.pop()
        if at < 0:
            cell[who] = -at
        elif len(who):
            dim, limit, left, right = splits[at]
            below = (rows[who, dim] if dim < rows.shape[1] else np.zeros(len(who))) < limit
            todo += [(left, who[below]), (right, who[~below])]
    return cell


def arranged(vectors: DataFrame, splits: list, n: int, size: int) -> DataFrame:
    """``vectors`` sorted by cell; partitions hold up to about 2 * ``size`` of the ``n`` rows, whatever the cells' sizes."""

    def place(batches):
        for batch in batches:
            cell = cell_of(padded(batch.column(1).to_pylist()), splits)
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column(0), "embedding": batch.column(1), "cell": pa.array(cell)})

    least = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-n // (2 * size)), min(least, -(-4 * n // size)))
    placed = vectors.mapInArrow(place, "vec_id long, embedding array<double>, cell int")
    return placed.repartitionByRange(parts, "cell", F.xxhash64("vec_id")).sortWithinPartitions("cell")


def build_trees(vectors: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """s, tree, and the tree's own ball (center, radius, scale) of each shard of ``vectors`` in their order; a shard a quarter full ends with its cell, if there is a column of cells."""
    cells = "cell" in vectors.columns

    def build(batches):
        ids, rows, made, last = [], [], TaskContext.get().partitionId() << 24, 0

        def out() -> pa.RecordBatch:
            nonlocal made
            tree = BallTree(np.array([NO_ID if i is None else i for i in ids], np.int64), whole(rows))
            ids.clear(), rows.clear()
            made += 1
            ball = {"center": pa.array([tree.centers[0].tobytes()], pa.binary()), "radius": pa.array([tree.radii[0]]), "scale": pa.array([tree.scale])}
            return pa.RecordBatch.from_pydict({"s": pa.array([made], pa.int64()), "tree": pa.array([tree.dump()], pa.binary()), **ball})

        for batch in batches:
            for i, r, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist() if cells else itertools.repeat(0)):
                if len(ids) >= shard_size or (cell != last and 4 * len(ids) >= shard_size):
                    yield out()
                ids.append(i)
                rows.append(r)
                last = cell
        if ids:
            yield out()

    return written(vectors.mapInArrow(build, TREES), "trees")


def pairs(blocks: DataFrame, balls: str, best: bool = False) -> DataFrame:
    """(s, b) of the shards, whose balls are the table at ``balls``, that some query of a block may find more in; ``best``: of each query's shard with the highest bound alone."""

    def choose(batches):
        for batch in batches:
            for b, queries, kth in zip(*(batch.column(i).to_pylist() for i in range(3))):
                q = pickle.loads(queries)[1].astype(np.float64)
                norm = np.sqrt((q**2).sum(axis=1)) * (1 + 1e-12)
                known = np.full(len(q), -np.inf) if kth is None else np.frombuffer(kth, np.float64)
                high, where = np.full(len(q), -np.inf), np.full(len(q), -1, np.int64)
                for some in itertools.batched(rows_at(balls), CHUNK):
                    s, centers, radii, scales = zip(*some)
                    bound = ball_bounds(q, norm, padded([np.frombuffer(c, np.float64) for c in centers]), np.array(radii), np.array(scales))
                    s = np.array(s)
                    if best:
                        at = np.argmax(bound, axis=1)
                        top_ = bound[np.arange(len(q)), at]
                        better = (where < 0) | (top_ > high)
                        high[better], where[better] = top_[better], s[at[better]]
                    else:
                        s = s[~(bound < known[:, None]).all(axis=0)]
                        yield pa.RecordBatch.from_pydict({"s": pa.array(s, pa.int64()), "b": pa.array(np.full(len(s), b), pa.int64())})
                if best:
                    s = np.unique(where[where >= 0])
                    yield pa.RecordBatch.from_pydict({"s": pa.array(s, pa.int64()), "b": pa.array(np.full(len(s), b), pa.int64())})

    return blocks.select("b", "queries", "kth").mapInArrow(choose, "s long, b long")


def ball_bounds(q: np.ndarray, norm: np.ndarray, centers: np.ndarray, radii: np.ndarray, scales: np.ndarray) -> np.ndarray:
    """Of each query and ball, a number that no inner product with a vector in the ball exceeds."""
    d = min(q.shape[1], centers.shape[1])
    size = norm[:, None] * (np.sqrt((centers**2).sum(axis=1)) + radii)
    return (q[:, :d] @ centers[:, :d].T + norm[:, None] * radii + 1e-9 * size + 1e-9) * scales


def with_blocks(trees: DataFrame, chosen: DataFrame, parts: int) -> DataFrame:
    """The trees that ``chosen`` (s, b) names, each with its blocks ``bs``: one number for each block of queries at most."""
    return trees.select("s", "tree").join(chosen.groupBy("s").agg(F.sort_array(F.collect_list("b")).alias("bs")), "s").repartition(parts, "s")


def query_blocks(queries: DataFrame, block: int) -> tuple[DataFrame, str]:
    """b, queries (ids and matrix of at most ``block`` rows), kth (none yet): a table of the shared folder with a folder for each b, and its path."""

    def build(batches):
        ids, rows, made = [], [], TaskContext.get().partitionId() << 24

        def out() -> pa.RecordBatch:
            nonlocal made
            data = pickle.dumps((np.array(ids, np.int64), whole(rows)))
            ids.clear(), rows.clear()
            made += 1
            return pa.RecordBatch.from_pydict({"b": pa.array([made], pa.int64()), "queries": pa.array([data], pa.binary()), "kth": pa.array([None], pa.binary())})

        for batch in batches:
            for i, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                rows.append(r)
                if len(ids) >= block:
                    yield out()
        if ids:
            yield out()

    return written_at(queries.mapInArrow(build, BLOCKS), "queries", ["b"])


def block_numbers(path: str) -> list:
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(path)
    return sorted(int(i.base_name[2:]) for i in store.get_file_info(fs.FileSelector(folder)) if i.base_name.startswith("b="))


def found(trees: DataFrame, path: str, k: int, first_only: bool = False) -> DataFrame:
    """What the shards of ``trees`` find for the query blocks ``bs`` (without that column: for all) at ``path``: a task holds one tree and one block at a time."""
    chosen = "bs" in trees.columns

    def search(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                tree = BallTree.load(batch.column(0)[at].as_py())
                for b in batch.column(1)[at].as_py() if chosen else block_numbers(path):
                    for queries, kth in rows_at(f"{path}/b={b}"):
                        ids, matrix = pickle.loads(queries)
                        known = np.full(len(ids), -np.inf) if kth is None else np.frombuffer(kth, np.float64)
                        who, near, score = tree.search(ids, matrix, known, k, first_only)
                        yield pa.RecordBatch.from_pydict({"b": pa.array(np.full(len(who), b), pa.int64()), "q": pa.array(who, pa.int32()), "query_id": pa.array(ids[who], pa.int64()), "vec_id": pa.array(near, pa.int64()), "score": pa.array(score, pa.int64())})

    return trees.select("tree", *(["bs"] if chosen else [])).mapInArrow(search, FOUND)


def shared_scores(blocks: DataFrame, rows: DataFrame, k: int) -> tuple[DataFrame, str]:
    """``blocks`` with the k-th best score of each query among ``rows`` (no candidate twice) where that is above the one known; and the table's path."""
    best = W.partitionBy("b", "q").orderBy(F.desc("score"))
    last = rows.select("b", "q", "score").withColumn("r", F.row_number().over(best)).filter(F.col("r") == k)
    each = last.groupBy("b").agg(F.collect_list("q").alias("qs"), F.collect_list("score").alias("scores"))

    def put(batches):
        for batch in batches:
            kth = []
            for queries, old, qs, scores in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                known = np.full(len(pickle.loads(queries)[0]), -np.inf) if old is None else np.frombuffer(old, np.float64).copy()
                exact = np.array(scores or [], np.int64)
                # A double below a large score, so that nothing that equals it is dropped.
                value = np.where(np.abs(exact) < 1 << 53, exact, np.nextafter(exact.astype(float), -np.inf))
                at = np.array(qs or [], np.int64)
                known[at] = np.maximum(known[at], value)
                kth.append(known.tobytes())
            yield pa.RecordBatch.from_pydict({"b": batch.column(0), "queries": batch.column(1), "kth": pa.array(kth, pa.binary())})

    return written_at(blocks.join(each, "b", "left").select("b", "queries", "kth", "qs", "scores").mapInArrow(put, BLOCKS), "queries", ["b"])


def top_k(table: DataFrame, queries: DataFrame, k: int = K, shard_size: int = SHARD, block: int = BLOCK) -> DataFrame:
    """The k best vectors of ``table`` for every row of ``queries`` (both: vec_id, embedding).

    Three waves, whatever the sizes: each query's best shard, an eighth of the pairs of shards and blocks that are left, then the others that are left; the
    k-th scores that a wave brings decide which pairs the next one reads.
    """
    vectors, asked = usable(table), usable(queries)
    n = vectors.count()
    splits = top_cells(vectors, n, shard_size)
    trees = build_trees(arranged(vectors, splits, n, shard_size), shard_size)
    balls = written_at(trees.select("s", "center", "radius", "scale"), "balls")[1]
    parts = max(int(trees.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // (4 * shard_size))
    blocks, path = query_blocks(arranged(asked, splits, asked.count(), block), block)
    first = written(pairs(blocks, balls, best=True), "pairs")
    every = written(found(with_blocks(trees, first, parts), path, k), "found")
    blocks, path = shared_scores(blocks, every, k)
    left = written(pairs(blocks, balls).join(first, ["s", "b"], "left_anti").withColumn("early", F.pmod(F.xxhash64("s", "b"), F.lit(8)) == 0), "pairs")
    every = every.unionByName(written(found(with_blocks(trees, left.filter("early"), parts), path, k), "found"))
    blocks, path = shared_scores(blocks, every, k)
    last = pairs(blocks, balls).join(left.filter("NOT early"), ["s", "b"], "left_semi")
    every = every.unionByName(found(with_blocks(trees, last, parts), path, k))
    order = W.partitionBy("b", "q").orderBy(F.desc("score"), "vec_id")
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")


def op5_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: the ten best of all vectors for each vector whose vec_id is divisible by 100."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(table, table.filter(F.col("vec_id") % 100 == 0))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 10
"""
