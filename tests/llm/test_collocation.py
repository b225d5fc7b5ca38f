import random
import re
from collections import Counter

import numpy as np
import pytest

from registrylake.llm import collocation as co

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most=5, least=100, top=2000, cover=100):
    f, n = {}, Counter()
    for lang, text in rows:
        of = f.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UP)):
            ws = re.findall("[^ \t]+", piece)
            n["und" if lang is None else lang] += len(ws)
            of.update(tuple(ws[i : i + k]) for k in range(1, most + 1) for i in range(len(ws) - k + 1))
    out = []
    for lang, of in f.items():
        cand = {p: a for p, a in of.items() if a >= least}
        got = []
        for p, a in cand.items():
            if len(p) < 2 or any(len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            got.append((-score, -a, " ".join(p).encode(), a, of[p[:k]], of[p[k:]]))
        out += [(lang, i, p.decode(), a, l, r, n[lang], -s) for i, (s, _, p, a, l, r) in enumerate(sorted(got)[:top], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string").repartition(3)


def run(spark, rows, **how):
    return sorted(map(tuple, co.collocations(table(spark, rows), **how).collect()))


def texts(n, seed, vocabulary=12, length=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Ä", "日本", "it's", "x-y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    end = lambda: rng.choices([" ", "  ", "\t", ". ", "\n", ",", "?\r\n"], [30, 2, 1, 2, 1, 1, 1])[0]
    return [(rng.choice(["en", "de", None, "und"]), "".join(w.upper() + end() if rng.random() < 0.1 else w + end() for w in rng.choices(words, weights, k=rng.randrange(length)))) for _ in range(n)]


@pytest.mark.parametrize("how", [{"least": 3}, {"least": 2, "size": 200, "top": 25}, {"least": 4, "cover": 60, "most": 4}, {"least": 2, "most": 2}])
def test_against_brute_force(spark, odd_rows, how):
    rows = [("en", t) for _, t in odd_rows if len(t or "") < 1000] + texts(80, 1)
    given = {k: v for k, v in how.items() if k != "size"}
    assert run(spark, rows, **how) == brute(rows, **given)


def test_dense_and_sparse_bitmaps_agree(spark, monkeypatch):
    rows = texts(40, 2, vocabulary=4)
    want = brute(rows, least=3)
    bitmaps = co.sharded(table(spark, rows))
    words = bitmaps.select("lang", "word").distinct().orderBy("lang", "word").toArrow().to_pylist()
    number = {(r["lang"], r["word"]): i for i, r in enumerate(words)}
    shards, told = {}, {}
    for r in bitmaps.collect():
        shards.setdefault(r.shard, []).append({"shard": r.shard, "uid": r.uid, "n": r.n, "places": bytes(r.places)})
        told.setdefault(r.shard, []).append({"uid": r.uid, "w": number[r.lang, r.word], "f": 10 * r.n, "a": None, "b": None})
    for dense in (1, 4, 10**9):
        monkeypatch.setattr(co, "DENSE", dense)
        got = Counter()
        for part, some in ((co.pa.Table.from_pylist(shards[k]), told[k]) for k in shards):
            rows = co.pairs_of(part, co.pa.Table.from_pylist(some), 7, share=20).to_pylist()
            assert len({r["p"] for r in rows}) == len(rows)
            flat = [x for r in rows for x in zip(r["a"], r["b"], r["n"])]
            assert len({x[:2] for x in flat}) == len(flat)
            for a, b, n in flat:
                got[a, b] += n
            both = co.pa.Table.from_pylist(some + [{"uid": None, "w": None, "f": None, "a": x[0], "b": x[1]} for x in flat])
            longer = co.longer_of(part, both, 5, 7).to_pylist()
            for *ids, n in (x for r in longer for x in zip(*(r[f"w{i}"] for i in range(1, 6)), r["n"])):
                got[tuple(i for i in ids if i >= 0)] += n
        assert want and all(got[tuple(number[r[0], w] for w in r[2].split(" "))] == r[3] for r in want)


def test_gaps_round_trip():
    rng = np.random.default_rng(1)
    gaps = np.concatenate([rng.integers(0, 1 << b, 50) for b in range(1, 35)] + [np.array([0, 127, 128, 16383, 16384, (1 << 35) - 1])])
    data, starts = co.packed(gaps)
    assert (co.unpacked(data) == gaps).all() and starts[-1] == len(data) and len(co.unpacked(data[:0])) == 0


def test_a_very_long_text_is_cut_at_pieces_only(spark):
    long = [("en", "a b c, " * 500 + "a b c " * 500)]
    assert run(spark, long, least=100, size=64) == brute(long)
    distinct = [("en", " ".join(f"d{i}" for i in range(40_000)) + " a b" * 120)]
    assert run(spark, distinct) == brute(distinct)


def test_products_beyond_64_bits(spark):
    told = spark.createDataFrame([([7], 3_000_000_000), ([8], 4_000_000_000), ([7, 8], 2_999_999_999)], "ids array<long>, n long")
    words = spark.createDataFrame([("en", "a", 7), ("en", "b", 8)], "lang string, word string, w long")
    totals = spark.createDataFrame([("en", 9_000_000_000_000)], "lang string, n long")
    real = co.phrase_counts
    try:
        co.phrase_counts = lambda *a: (told, words, totals)
        row = co.collocations(None).first()
    finally:
        co.phrase_counts = real
    assert row.phrase == "a b" and row.score == 1000 * 2_999_999_999 * 9_000_000_000_000 // (3_000_000_000 * 4_000_000_000)


def test_a_frequent_word_is_dealt_to_several_rows(spark):
    rows = texts(60, 5)
    for share in (3, 10**9):
        told, words, _ = co.phrase_counts(table(spark, rows), 3, 3, share=share)
        text = {r.w: (r.lang, r.word) for r in words.collect()}
        got = {(text[r.ids[0]][0], " ".join(text[i][1] for i in r.ids)): r.n for r in told.collect()}
        want = {(r[0], r[2]): r[3] for r in brute(rows, most=3, least=3, cover=10**9)}
        assert want and all(got[k] == n for k, n in want.items())


def test_pairs_are_dealt_once(spark):
    from unittest import mock

    seen = []
    with mock.patch.object(co, "written", side_effect=lambda df, name: seen.append((name, df._jdf.queryExecution().executedPlan().toString())) or real(df, name)) as _:
        co.phrase_counts(table(spark, texts(30, 6)), 3, 3)
    plan = dict(seen)["frequent-pairs"]
    assert plan.count("Exchange hashpartitioning(p#") == 1 and plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan


def test_proposed_phrases_do_not_grow_with_the_square_of_a_group(spark):
    from unittest import mock

    text, made = " ".join(f"w{i}" for i in range(40)), {}
    for copies, size in [(100, 100), (200, 100), (100, co.SHARD_BYTES), (200, co.SHARD_BYTES)]:
        with mock.patch.object(co, "frequent", side_effect=lambda rows, *how: made.update({(copies, size): rows.count()}) or real_frequent(rows, *how)):
            co.phrase_counts(table(spark, [("en", text)] * copies), 5, 100, size=size)
    each = 38 + 37 + 36  # at most three a word in each shard, whatever the number of copies there
    assert made == {(100, 100): 100 * each, (200, 100): 200 * each, (100, co.SHARD_BYTES): 3 * each, (200, co.SHARD_BYTES): 3 * each}


real, real_frequent = co.written, co.frequent


def test_empty_tables_and_nulls(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, None), ("en", ""), ("en", " .,\t\n")], least=1) == []


def test_hot_word_and_clashing_columns(spark):
    rows = [("en", "the the the cat. the dog the")] * 60
    docs = table(spark, rows).selectExpr("*", "1 as shard", "2 as word", "3 as n", "4 as places")
    assert sorted(map(tuple, co.collocations(docs).collect())) == brute(rows)
