import math
import random

import numpy as np
import pytest

from registrylake.llm import balltree as bt

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k):
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    def ints(v):
        return [math.floor(1024 * float(np.float32(x))) for x in v]

    good = [(i, ints(v)) for i, v in rows if ok(v)]
    out = []
    for qi, q in [(i, ints(v)) for i, v in queries if ok(v)]:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), math.inf if i is None else i) for i, v in good if i != qi)
        out += [(qi, r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def made(seed, n, d=6, copies=0):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 1) for _ in range(d)]) for i in range(n)]
    return rows + [(n + i, [0.5] * d) for i in range(copies)]


def run(spark, rows, k=10, **how):
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    got = bt.top_k(table, table.filter("vec_id % 100 = 0"), k, **how)
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"shard_size": 70, "block": 3}])
def test_against_brute_force(spark, how):
    rows = made(1, 700, copies=150) + [(5000, None), (5100, [1.0, None]), (5200, [math.nan] * 6), (5300, [math.inf] * 6), (5400, []), (5500, [1.0, 2.0]), (None, [3.0] * 6)]
    assert run(spark, rows, **how) == brute(rows, [(i, v) for i, v in rows if i is not None and i % 100 == 0], 10)


def test_clashing_columns(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(250)]
    table = spark.createDataFrame([(i, v, 1, 2, 3, 4.0) for i, v in rows], "vec_id long, embedding array<float>, b int, q int, rank int, score double")
    got = sorted(map(tuple, bt.top_k(table, table.filter("vec_id % 100 = 0"), 10, shard_size=40).collect()), key=repr)
    assert got == brute(rows, [(i, v) for i, v in rows if i % 100 == 0], 10)


def test_later_waves_know_the_scores_of_earlier_ones(spark):
    rows = made(3, 2000)
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(4)
    trees = bt.build_trees(bt.usable(table), 100)
    blocks, path = bt.query_blocks(bt.usable(table.filter("vec_id % 100 = 0")), 7)
    assert blocks.count() >= 3
    first = bt.found(trees, path, 10).count()
    blocks, path = bt.shared_scores(blocks, bt.found(trees, path, 10, first_only=True), 10)
    second = bt.found(trees, path, 10).count()
    blocks, path = bt.shared_scores(blocks, bt.found(trees, path, 10), 10)
    third = bt.found(trees, path, 10).count()
    assert first > second > third >= 20 * 10


def test_fewer_than_k_and_repeats(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 5.0])]
    assert run(spark, rows) == brute(rows, rows[:2], 10)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_pruning_is_exact_and_prunes():
    rng = np.random.default_rng(0)
    v = (rng.normal(size=(4000, 3)) * 1024).astype(np.int64)
    tree = bt.BallTree.load(bt.BallTree(np.arange(4000), v, leaf=16).dump())
    q = v[:50]
    scored = []
    exact = bt.products
    bt.products = lambda a, b: scored.append(len(a) * len(b)) or exact(a, b)
    try:
        who, ids, score = tree.search(np.arange(50), q, np.full(50, -np.inf), 10)
    finally:
        bt.products = exact
    assert sum(scored) < 0.5 * 50 * 4000
    for i in range(50):
        s = v @ q[i]
        want = sorted((-int(s[j]), j) for j in range(4000) if j != i)[:10]
        assert [(-a, b) for a, b in zip(score[who == i].tolist(), ids[who == i].tolist())] == want


def test_large_components_are_exact(spark):
    rows = [(0, [3e9, 1.0]), (1, [2e9, 7.0]), (2, [2e9, 3.0]), (3, [-1e15, 0.0])]
    got = {r[2]: r[3] for r in run(spark, rows)}
    f = lambda x: math.floor(1024 * float(np.float32(x)))
    assert got[1] == min(bt.HIGH, f(3e9) * f(2e9) + 1024 * 7168) and got[3] == bt.LOW


def clustered(seed, groups, each, d=8):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, d)) * 8
    return [(g * each + i, [float(np.float32(c)) for c in centers[g] + rng.normal(size=d) * 0.2]) for g in range(groups) for i in range(each)]


def test_less_than_half_of_the_pairs_are_read_on_clustered_vectors(spark, monkeypatch):
    rows = clustered(5, 40, 100)
    read = []
    with_blocks = bt.with_blocks
    monkeypatch.setattr(bt, "with_blocks", lambda trees, chosen, parts: read.append((trees.count(), chosen.count())) or with_blocks(trees, chosen, parts))
    blocks = []
    query_blocks = bt.query_blocks
    monkeypatch.setattr(bt, "query_blocks", lambda q, block: blocks.append(query_blocks(q, block)) or blocks[0])
    assert run(spark, rows, shard_size=100, block=4) == brute(rows, rows[::100], 10)
    trees, n = read[0][0], blocks[0][0].count()
    assert trees >= 30 and n >= 8 and sum(c for _, c in read) < 0.5 * trees * n


def test_a_cell_of_equal_vectors_is_cut(spark):
    rows = clustered(6, 4, 100, d=3) + [(1000 + i, [1.0, 2.0, 3.0]) for i in range(300)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    vectors = bt.usable(table)
    splits = bt.top_cells(vectors, len(rows), 50)
    sizes = [len(p) for p in bt.arranged(vectors, splits, len(rows), 50).rdd.glom().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 300
    assert run(spark, rows, shard_size=50) == brute(rows, [(i, v) for i, v in rows if i % 100 == 0], 10)


def test_cells_follow_the_order_of_the_splits():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(500, 3))
    splits = [(0, 0.0, 1, 2), (1, 0.5, -1, -2), (2, -0.5, -3, -4)]
    want = np.where(rows[:, 0] < 0, np.where(rows[:, 1] < 0.5, 1, 2), np.where(rows[:, 2] < -0.5, 3, 4))
    assert bt.cell_of(rows, splits).tolist() == want.tolist() and bt.cell_of(rows, []).tolist() == [1] * 500


def test_no_product_exceeds_the_bound_of_a_ball():
    rng = np.random.default_rng(4)
    q, v = (rng.normal(size=(n, 6)) * 1024 for n in (40, 200))
    center = v.mean(axis=0)
    radius = np.sqrt(((v - center) ** 2).sum(axis=1).max())
    bound = bt.ball_bounds(q, np.sqrt((q**2).sum(axis=1)), center[None, :], np.array([radius]), np.ones(1))
    assert (bound[:, 0] >= (q @ v.T).max(axis=1)).all()


def test_top_cells_of_a_hot_vector_with_strays(spark):
    rows = [(i, [1.0, 2.0]) for i in range(600)] + [(600 + i, [1.0 + 3.0**i, 2.0]) for i in range(60)] + [(700 + i, [1.0, -float(i)]) for i in range(60)]
    vectors = bt.usable(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA))
    splits = bt.top_cells(vectors, len(rows), 20)
    cells = bt.cell_of(np.array([v for _, v in rows]), splits)
    assert len(set(cells[:600])) == 1 and len(set(cells[600:])) >= 3 and cells[0] not in cells[601:]
