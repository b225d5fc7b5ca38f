import random

import numpy as np
from pyspark.sql import functions as F
import xxhash

from registrylake.llm import simhash


def brute_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(values, budget=4):
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= budget:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def cloud(seed, n=300):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        base = r.choice(out) if out and r.random() < 0.7 else r.getrandbits(64)
        for _ in range(r.choice((0, 1, 2, 3, 4, 5, 6))):
            base ^= 1 << r.randrange(64)
        out.append(base)
    return sorted(set(out))


def test_trie_join_is_exact():
    for seed in range(8):
        values = cloud(seed)
        got = simhash.trie_join(np.array(values, np.uint64), 0, leaf=1 + seed).label.tolist()
        assert got == classes(values)


def test_trie_join_bounded_blocks():
    values = cloud(99, 500)
    assert simhash.trie_join(np.array(values, np.uint64), 0, block=7, leaf=2).label.tolist() == classes(values)


def expected(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = classes(prints)
    ids = {}
    for (i, _), r in zip(rows, roots):
        ids.setdefault(r, []).append(i)
    least = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return sorted(((i, p, least[r]) for (i, _), p, r in zip(rows, prints, roots)), key=repr)


def result(docs):
    return sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_classes(docs).collect()), key=repr)


def test_documents_against_brute_force(docs_of, odd_rows):
    r = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    rows = list(odd_rows)
    for g in range(12):
        base = [r.choice(words) for _ in range(120)]
        for k in range(5):
            copy = list(base)
            for _ in range(k):
                copy[r.randrange(120)] = r.choice(words)
            rows.append((1000 + 10 * g + k, " ".join(copy)))
    assert result(docs_of(rows, "root")) == expected(rows)


def test_crowded_blocks_are_split(spark):
    values = cloud(3, 250)
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    for most, levels in ((4, 3), (4, 2), (1, 4), (40, 3), (10_000, 3)):
        edges = simhash.links(frame, most=most, levels=levels).collect()
        at = {int(np.uint64(v).astype(np.int64)): i for i, v in enumerate(values)}
        c = simhash.Classes(len(values))
        c.link(np.array([at[e.u] for e in edges]), np.array([at[e.v] for e in edges]))
        assert c.label.tolist() == classes(values)


def test_values_that_differ_in_few_bits_share_a_block(spark):
    r = np.random.default_rng(2)
    a = r.integers(0, 1 << 63, 200, dtype=np.uint64)
    b = a.copy()
    for i in range(200):
        for bit in r.choice(64, 4, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    rows = spark.createDataFrame([(int(v), i) for i in range(200) for v in (a[i].astype(np.int64), b[i].astype(np.int64))], "fp long, i int")
    level = simhash.spread(rows.select("fp", F.col("fp").alias("x"), F.lit(0).alias("f"), F.lit(0).cast("long").alias("path")), 4)
    for _ in range(3):
        got = level.join(rows, "fp").groupBy("i", "k").agg(F.count_distinct("fp").alias("n")).filter("n = 2").select("i").distinct().count()
        assert got == 200
        bits = level.select((F.bit_count("x") - F.bit_count("fp")).alias("d")).distinct().collect()
        assert [x.d for x in bits] == [0]  # bits move, none is lost
        level = simhash.spread(level.select("fp", "x", "f", "path"), 4)


def test_large_group_of_near_copies_is_quick():
    r = np.random.default_rng(0)
    base = np.uint64(0x123456789ABCDEF0)
    flips = np.uint64(1) << r.integers(0, 24, (20_000, 5)).astype(np.uint64)
    values = np.unique(base ^ np.bitwise_xor.reduce(flips, axis=1))
    import time

    t = time.time()
    label = simhash.trie_join(values, 0).label
    assert time.time() - t < 20 and len(set(label.tolist())) < 30


def test_empty_table(docs_of):
    assert result(docs_of([])) == []
