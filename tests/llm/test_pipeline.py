import random

import pytest

from tests.llm.test_langmix import TEXTS
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_linededup import key
from tests.llm.test_packing import check
from tests.llm.test_posindex import brute as brute_hits
from tests.llm.test_simhash import brute_print, classes

pipeline = pytest.importorskip("corpus_pipeline")
COMMON = "this very line stands in many of the documents of the garden"


def corpus():
    r = random.Random(11)
    rows = []
    for i in range(120):
        lang = r.choice(sorted(TEXTS))
        lines = [" ".join(r.choice(TEXTS[lang].split()) + r.choice("abcdefgh") for _ in range(r.randrange(30, 50))) for _ in range(3)]
        if i % 6 == 0:
            lines.insert(1, COMMON)
        rows.append((i, "\n".join(lines), lang))
    for k in range(10):  # near copies, exact copies
        rows.append((200 + k, rows[k][1] + " and", rows[k][2]))
        rows.append((300 + k, rows[k][1], rows[k][2]))
    rows += [(400, None, "aa"), (401, "12 34 %%", "aa"), (402, "", "aa"), (403, COMMON, "aa"), (404, rows[5][1].split("\n")[0] + " " + " ".join(f"bench{j}" for j in range(13)), rows[5][2])]
    return rows


def stage_by_stage(rows, items):
    docs = [(i, t) for i, t, _ in rows if t and any(map(str.isalpha, t))]
    digests = {r[0]: r for r in brute_lines(docs)}
    drop = {}
    for i, t in docs:
        for line in t.split("\n"):
            if len(key(line)) >= 40:
                drop.setdefault(key(line), set()).add(i)
    docs = [(i, "\n".join(x for x in t.split("\n") if not (len(drop.get(key(x), ())) >= 5 and i != max(drop[key(x)])))) for i, t in docs]
    assert {i: t.count("\n") for i, t in docs if digests[i][2] == 0} == {i: digests[i][1] - 1 for i, t in docs if digests[i][2] == 0}
    roots = classes([brute_print(t) for _, t in docs])
    least = {}
    for (i, _), c in zip(docs, roots):
        least[c] = min(i, least.get(c, i))
    docs = [(i, t) for (i, t), c in zip(docs, roots) if least[c] == i]
    bad = {r[0] for r in brute_hits(docs, items) if r[4]}
    return [(i, t) for i, t in docs if i not in bad]


def write(spark, tmp_path, rows, items):
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")


def test_stages_against_brute_force(spark, tmp_path):
    rows, items = corpus(), [(1, " ".join(f"bench{j}" for j in range(13))), (2, "not in any document at all")]
    write(spark, tmp_path, rows, items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    want = stage_by_stage(rows, items)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in docs.collect()) == [(i, t, len(t)) for i, t in sorted(want)]
    check(pipeline.run(spark, str(tmp_path)).collect(), want)


def test_repeated_rows_keep_one(spark):
    from registrylake.llm.simhash import keep_one

    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (1, "z"), (None, "q"), (None, "q"), (3, None), (4, "")], "doc_id long, text string")
    got = sorted(map(tuple, keep_one(docs).collect()), key=repr)
    assert got == sorted([(1, "a b c d e f"), (1, "z"), (None, "q"), (3, None)], key=repr)


def test_clashing_names_pass(spark):
    from registrylake.llm.simhash import keep_one

    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y")], "doc_id long, text string, lang string")
    for name in ("_id", "fp", "root", "t", "component_id"):
        assert keep_one(docs.withColumnRenamed("lang", name)).collect() == [(1, "a b c d e f", "x")]


def test_empty_tables(spark, tmp_path):
    write(spark, tmp_path, [], [])
    assert pipeline.run(spark, str(tmp_path)).collect() == []
