"""SimHash near-dedup by a self-join of binary tries.

Fingerprints of at most ``budget`` differing bits agree on at least one of ``budget + 1`` blocks of
bits, so each distinct fingerprint goes to that many tries, one for each block and block value. A task
holds the tries of its block values as one sorted array: a trie node is an interval of it, and the join
goes down pairs of nodes level by level, adds up the bits in which the two paths differ and drops a
pair as soon as they exceed the budget. A pair of nodes whose members are known to be one class already
is dropped as well, and a trie's members that differ in one bit are linked first; a large group of near
copies thus costs its members, not its pairs. The join returns a spanning forest of links, never the
pairs of a group. A block value with very many fingerprints is split: what lies behind the block is cut into blocks in
turn, and each fingerprint goes to as many tries as there are of them.

Nulls, empties and ties: a text without words (null, empty, white space) has fingerprint zero and is
linked like any other; equal texts share their fingerprint and class; the class id is the smallest
doc_id, null only if all its doc_ids are; repeated rows are returned as often as they occur; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.common import written
from registrylake.llm.components import components
from registrylake.llm.encode import row_chunks

WORDS, BUDGET = 4, 4


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of the text, repeats included."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    starts = np.concatenate(([0], np.cumsum(sizes)))
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    lo, hi = starts[: len(parts) - words + 1].tolist(), (starts[words:] - 1).tolist()
    return np.array([digest(view[a:b], 42) for a, b in zip(lo, hi)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if more than half of the hashes have it."""
    if not len(hashes):
        return 0
    total = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo : lo + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def text_digest(text):
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, t (a digest of the text), fp (the 64 bits as a signed long)."""

    def run(batches):
        for part in (p for batch in batches for p in row_chunks(batch, 1)):
            fps = np.array([fingerprint(shingle_hashes(t, words)) for t in part.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "t": part.column(2), "fp": fps.view(np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_digest(F.col("text")).alias("t")).mapInArrow(run, "doc_id long, t long, fp long")


class Classes:
    """Least-member labels of 0..n-1 under growing sets of links, in numpy."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def _link_one_bit(values: np.ndarray, classes: Classes) -> None:
    for bit in range(64):
        other = values ^ np.uint64(1 << bit)
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        hit = np.flatnonzero(values[at] == other)
        classes.link(hit, at[hit])


def trie_join(values: np.ndarray, shared: int, budget: int = BUDGET, leaf: int = 64, block: int = 1 << 20, sides: np.ndarray | None = None, classes: Classes | None = None) -> Classes:
    """Classes of sorted distinct ``values`` (uint64) linked within ``budget`` bits in tries of ``shared`` leading bits.

    Only values that agree on the leading ``shared`` bits meet. Node pairs wait on a stack and are taken
    in blocks of ``block`` pairs, so that memory stays bounded; pairs whose members are few enough
    (product of at most ``leaf``) are compared directly.
    """
    n = len(values)
    classes = classes or Classes(n)
    if n < 2:
        return classes
    _link_one_bit(values, classes)
    heads = values >> np.uint64(64 - shared) if shared else np.zeros(n, np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
    ends = np.append(starts[1:], n)
    zeros: dict[int, np.ndarray] = {}

    def below(depth: int) -> np.ndarray:
        if depth not in zeros:
            zeros[depth] = np.concatenate(([0], np.cumsum((values >> np.uint64(63 - depth)) & np.uint64(1) == 0)))
        return zeros[depth]

    pairs = np.stack([starts, ends, starts, ends, np.zeros(len(starts), np.int64)])
    stack = [(shared, pairs[:, ends - starts > 1])]
    while stack:
        depth, p = stack.pop()
        if p.shape[1] > block:
            stack += [(depth, p[:, i : i + block]) for i in range(0, p.shape[1], block)]
            continue
        if not p.shape[1]:
            continue
        a, b, c, d, _ = p
        label = classes.label
        # Labels are least members, so a node is one class if its extremes agree; only then may it be skipped.
        ra, rc = _range_label(label, a, b), _range_label(label, c, d)
        p = p[:, (ra < 0) | (ra != rc)]
        a, b, c, d, e = p
        small = ((b - a) * (d - c) <= leaf) | (depth >= 64)
        if small.any():
            s = p[:, small]
            na, nb = s[1] - s[0], s[3] - s[2]
            of = np.repeat(np.arange(s.shape[1]), na * nb)
            k = np.arange(len(of)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
            x, y = s[0][of] + k // nb[of], s[2][of] + k % nb[of]
            near = (x < y) & (np.bitwise_count(values[x] ^ values[y]) <= budget)
            classes.link(x[near], y[near])
        p = p[:, ~small]
        if p.shape[1]:
            a, b, c, d, e = p
            z = below(depth)
            m, o = a + z[b] - z[a], c + z[d] - z[c]
            same = (a == c) & (b == d)
            kids = [np.stack(k) for k in ((a, m, c, o, e), (m, b, o, d, e), (a, m, o, d, e + 1))]
            kids.append(np.stack((m, b, c, o, e + 1))[:, ~same])
            kids = np.concatenate(kids, axis=1)
            own = (kids[0] == kids[2]) & (kids[1] == kids[3])
            size = kids[1] - kids[0]
            stack.append((depth + 1, kids[:, (size > own) & (kids[3] > kids[2]) & (kids[4] <= budget)]))
    return classes


def _range_label(label: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The one label of each interval, -1 where it has several (found from neighbours that differ)."""
    changes = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
    return np.where(changes[hi - 1] == changes[lo], label[lo], -1)


def split_columns(budget: int) -> list:
    """For each of the ``budget + 1`` blocks of the bits behind the first ``f`` of ``x``: (``x`` with the block moved up behind those, new ``f``), as SQL.

    Two values that agree in their first ``f`` bits and differ in at most ``budget`` of the others agree in one of the blocks.
    """
    out = []
    for i in range(budget + 1):
        at = f"(f + CAST(round({i} * (64 - f) / {budget + 1}.0) AS INT))"
        end = f"(f + CAST(round({i + 1} * (64 - f) / {budget + 1}.0) AS INT))"
        width = f"({end} - {at})"
        first = "(CASE WHEN f > 0 THEN x & ~(shiftleft(1L, 64 - f) - 1L) ELSE 0L END)"
        block = f"shiftleft(shiftrightunsigned(shiftleft(x, {at}), 64 - {width}), 64 - f - {width})"
        between = f"(CASE WHEN {at} > f THEN shiftleft(shiftrightunsigned(shiftleft(x, f), 64 - ({at} - f)), 64 - {end}) ELSE 0L END)"
        rest = f"(x & (shiftleft(1L, 64 - {end}) - 1L))"
        rest = f"(CASE WHEN {end} < 64 THEN {rest} ELSE 0L END)"
        out.append((f"{first} | {block} | {between} | {rest}", f"f + {width}"))
    return out


def spread(rows: DataFrame, budget: int) -> DataFrame:
    """fp, x, f, path, k: each value once for every block; ``k`` stands for the path of blocks and the bits agreed on."""
    every = F.explode(F.array(*[F.struct(F.expr(x).alias("x"), F.expr(f).cast("int").alias("f"), (F.col("path") * 8 + i + 1).alias("path")) for i, (x, f) in enumerate(split_columns(budget))])).alias("t")
    out = rows.select("fp", every).select("fp", "t.x", "t.f", "t.path")
    return out.withColumn("k", F.xxhash64("path", F.expr("shiftrightunsigned(x, 64 - f)")))


def links(distinct: DataFrame, budget: int = BUDGET, most: int = 2_000_000, levels: int = 3) -> DataFrame:
    """Edges ``(u, v)`` of a spanning forest of each trie, from a table of distinct ``fp``.

    The values of a crowded trie (more than ``most``) go on to tries of one block more, ``budget + 1`` of them for each
    value, at most ``levels`` times; a trie that is crowded still then holds values of one tight group and is one task's.
    """
    parts = []
    rows = distinct.select("fp", F.col("fp").alias("x"), F.lit(0).alias("f"), F.lit(0).cast("long").alias("path"))
    for level in range(levels):
        rows = spread(rows, budget)
        if level + 1 == levels:
            parts.append(rows)
            break
        crowded = written(rows.groupBy("k").count().filter(F.col("count") > most).select("k"), "crowded")
        if crowded.limit(1).count() == 0:
            parts.append(rows)
            break
        parts.append(rows.join(crowded, "k", "left_anti"))
        rows = written(rows.join(crowded, "k", "left_semi").select("fp", "x", "f", "path"), "crowded-values")

    def join(batches):
        held: dict = {}
        for batch in batches:
            path, f, x, fp = (batch.column(i).to_numpy() for i in range(1, 5))
            for one in np.unique(path):
                pick = path == one
                held.setdefault((int(one), int(f[pick][0])), []).append((x[pick].view(np.uint64), fp[pick]))
        for (_, shared), parts_ in held.items():
            x, fp = (np.concatenate(c) for c in zip(*parts_))
            order = np.argsort(x)
            x, fp = x[order], fp[order]
            label = trie_join(x, shared, budget).label
            moved = np.flatnonzero(label != np.arange(len(x)))
            yield pa.RecordBatch.from_pydict({"u": fp[moved], "v": fp[label[moved]]})

    out = None
    for part in parts:
        edges = part.select("k", "path", "f", "x", "fp").repartition("k").mapInArrow(join, "u long, v long")
        out = edges if out is None else out.unionByName(edges)
    return out


def near_classes(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """doc_id, t, fp, root (a fingerprint that stands for the class) and component_id of every row of ``docs``."""
    prints = written(fingerprints(docs, words), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), budget))
    rooted = distinct.join(roots.select(F.col("u").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = written(rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "classes")
    return prints.join(of, "fp")


def keep_one(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """The row with the smallest doc_id of each class of ``docs``; all its columns.

    Of rows that share that doc_id the one whose text's digest is least stays; of equal rows, one.
    """
    classes = near_classes(docs, words, budget)
    firsts = classes.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.first("component_id").alias("__rl_id"), F.min("t").alias("__rl_t"), F.count("*").alias("__rl_n"))
    firsts = written(firsts.select("__rl_id", "__rl_t", "__rl_n"), "kept")
    mine = docs.withColumn("__rl_text", text_digest(F.col("text")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__rl_id")) & (F.col("__rl_text") == F.col("__rl_t"))
    if firsts.filter("__rl_n > 1").limit(1).count() == 0:
        return mine.join(firsts, same, "left_semi").drop("__rl_text")
    single = mine.join(firsts.filter("__rl_n = 1"), same, "left_semi")
    shared = mine.join(firsts.filter("__rl_n > 1"), same, "left_semi").dropDuplicates(["doc_id", "__rl_text"])
    return single.unionByName(shared).drop("__rl_text")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: fingerprint and class of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
