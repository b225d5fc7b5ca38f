import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from registrylake.llm import resample as rs

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def feats(text, most, buckets):
    ws = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UP))
    return len(ws), [zlib.crc32(" ".join(ws[i : i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(ws) - n + 1)]


def brute(rows, target, most=1, buckets=10_000, least_words=20, percent=10, seed=2024):
    held = [(i, *feats(t, most, buckets)) for i, t in rows]
    s, t = Counter(b for r in held for b in r[2]), Counter(b for x in target for b in feats(x, most, buckets)[1])
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t)))
    out = []
    for i, n, fs in held:
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(map(gain, fs))
        out.append([i, n, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[5] = place
    return sorted(map(tuple, out), key=repr)


def run(docs, target, **how):
    out = rs.importance(docs, target, **how).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    return sorted(map(tuple, out.collect()), key=repr)


def texts(n, seed=3):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(200)] + ["ÄÖ", "日本", "x", "it's"]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(n)]


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "word1 word2 word3 word1"), (2, None), (3, "ÄÖ x Word1")], "item_id int, text string")


AIM = ["word1 word2 word3 word1", None, "ÄÖ x Word1"]


@pytest.mark.parametrize("how", [{}, {"most": 3, "buckets": 97, "percent": 37}, {"least_words": 0, "percent": 100, "seed": 5}])
def test_against_brute_force(docs_of, odd_rows, target, how):
    rows = odd_rows + [(10_000 + i, t) for i, t in texts(120)] + [(20_000, " ".join(f"distinct{i}" for i in range(30_000)))]
    assert run(docs_of(rows), target, **how) == brute(rows, AIM, **how)


def test_combination_equals_crc_of_the_joined_text():
    rng = random.Random(1)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 3, 7, 64, 300, 5000]))) for _ in range(200)]
    crcs, lengths = np.array([zlib.crc32(w) for w in words], np.uint32), np.array([len(w) for w in words])
    doc = np.arange(200) // 40
    for n, (where, got) in enumerate(rs.run_crcs(crcs, lengths, doc, 5), 1):
        want = [(d, zlib.crc32(b" ".join(words[40 * d + i : 40 * d + i + n]))) for d in range(5) for i in range(40 - n + 1)]
        assert list(zip(where.tolist(), got.tolist())) == want


def test_fewer_words_than_a_run_needs():
    assert [len(c) for _, c in rs.run_crcs(np.zeros(0, np.uint32), np.zeros(0, int), np.zeros(0, int), 3)] == [0]
    assert [len(c) for _, c in rs.run_crcs(np.zeros(2, np.uint32), np.ones(2, int), np.array([0, 1]), 3)] == [2, 0]


def test_empty_tables(spark, docs_of, target):
    assert run(docs_of([]), target) == []
    rows = texts(30)
    assert run(docs_of(rows), spark.createDataFrame([], "text string")) == brute(rows, [])


def test_repeated_rows_and_hot_text(docs_of, target):
    rows = [(i, "word1 " * 25) for i in range(40)] + [(7, "word1 " * 25)] * 5 + texts(60, 9)
    assert run(docs_of(rows), target) == brute(rows, AIM)


def test_drawn_rows_keep_their_columns(docs_of, target):
    rows = texts(80)
    got = rs.drawn(docs_of(rows, "rank"), target, percent=20)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "rank"]
    assert sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in brute(rows, AIM, percent=20) if r[5])


def test_rank_is_by_ranges_and_not_by_one_window(docs_of, target):
    out = rs.importance(docs_of(texts(20)), target)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "rank" in out.columns and "partitionBy" not in plan and "windowspecdefinition(__rl_range" in plan
