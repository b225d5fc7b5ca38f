import re

from pyspark.sql import functions as F

from registrylake.llm import posindex as px

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, width=13):
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for name, text in items:
            b = words(text)
            n = min(width, len(b))
            for g in {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if b else ():
                for k in range(len(w) - n + 1):
                    if tuple(w[k : k + n]) == g:
                        hit.update(range(k, k + n))
                        names.add(name)
        out.append((i, len(w), len(hit), sorted(str(x) for x in names if x is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


ITEMS = [(1, " ".join(f"w{i}" for i in range(30))), (2, "Short, one-liner É!"), (3, None), (4, "..."), (5, "zz"), (11, " ".join(f"W{i}." for i in range(20, 40))), (None, "no name here"), (6, "a a a a")]
DOCS = [
    (1, "x " * 5 + " ".join(f"w{i}" for i in range(4, 22)) + " tail"), (2, None), (3, ""), (4, "!!"), (5, "short one liner É"), (5, "short one liner é"),
    (6, " ".join(f"w{i}" for i in range(12))), (7, "w0 " * 300 + " ".join(f"w{i}" for i in range(13))), (8, "zz"), (9, "no name here zz no name"), (None, "zz"), (10, "a a a a a a b a a a"), (12, "one liner"), (13, "x short"), (14, "w" * 50_000 + " zz"),
]


def run(spark, docs_of, docs, items, **how):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = px.contamination(docs_of(docs, "base"), bench, **how)
    return sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in got.collect()), key=repr)


def test_against_brute_force(spark, docs_of):
    assert run(spark, docs_of, DOCS, ITEMS) == brute(DOCS, ITEMS)


def test_blocks_and_small_shards(spark, docs_of):
    assert run(spark, docs_of, DOCS, ITEMS, block_chars=60, shard_words=20) == brute(DOCS, ITEMS)


def test_empty_tables(spark, docs_of):
    assert run(spark, docs_of, [], ITEMS) == []
    assert run(spark, docs_of, DOCS, []) == brute(DOCS, [])


def test_few_starts_at_a_time():
    found = px.Postings([b"a", b"b"], [[0, 1, 1, 1], [4, 2]])  # a at 0 1 2 3, b at 4 6
    got = [(int(p), int(s)) for which, start in found.phrases([(b"a", b"a"), (b"a", b"b"), (b"b",), (b"c",)], most=1) for p, s in zip(which, start)]
    assert sorted(got) == [(0, 0), (0, 1), (0, 2), (1, 3), (2, 4), (2, 6)]


def test_proximity(spark, docs_of):
    index = px.build_index(docs_of([(1, "red a b green c"), (2, "green red"), (3, "red"), (4, "green x x x x red")]), shard_words=4)
    got = sorted(map(tuple, px.proximity_matches(index, ["red", "green"], 4).collect()))
    assert got == [(1, 0, 4), (2, 0, 2)]


def test_hit_spans(spark, docs_of):
    bench = spark.createDataFrame([(1, "p q")], "item_id long, text string")
    row = px.contamination(docs_of([(1, "p q p q x p q")]), bench).select("starts", "ends", F.size("items")).first()
    assert tuple(row) == ([0, 5], [4, 7], 1) or tuple(row) == ([0, 2, 5], [2, 4, 7], 1)
