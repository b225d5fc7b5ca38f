import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from registrylake.llm import linededup as ld
from registrylake.llm.common import scratch

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UP)


def brute(rows, min_chars=40, min_docs=5):
    docs, top = defaultdict(set), {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                docs[k] |= set() if i is None else {i}
                top[k] = max(top.get(k, float("-inf")), float("-inf") if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(docs[key(x)]) < min_docs or top[key(x)] == (float("-inf") if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


LONG = "This Line Is Common to many documents, ÄÖ, and long enough"


def run(docs, **how):
    out = ld.dedup_lines(docs, **how)
    return sorted(map(tuple, out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256)).collect()), key=repr)


def test_against_brute_force(docs_of, odd_rows):
    rows = odd_rows + [(100 + i, f"own line {i}\n {LONG}\t\n{LONG.lower().replace('äö', 'ÄÖ')}\nend\n") for i in range(7)]
    rows += [(200 + i, f"{'short common line'}\n{'four documents hold this long line of more than 40'}") for i in range(4)]
    for batches in (1, 4, 20):
        assert run(docs_of(rows), batches=batches) == brute(rows)


def test_exactly_forty_code_points_and_five_documents(docs_of):
    rows = [(i, "é" * 40 + "\n" + "é" * 39) for i in range(5)]
    assert [r[2] for r in run(docs_of(rows))] == [1, 1, 1, 1, 0] and run(docs_of(rows)) == brute(rows)


def test_empty_table(docs_of):
    assert run(docs_of([])) == []


def test_rows_of_one_document_count_once(docs_of):
    rows = [(1, LONG)] * 6 + [(2, f"{LONG}\nx"), (2, LONG), (None, LONG)]
    assert all(r[2] == 0 for r in run(docs_of(rows))) and run(docs_of(rows)) == brute(rows)
    rows += [(i, LONG) for i in (3, 4, 5)]
    assert sum(r[2] for r in run(docs_of(rows))) == 11 and run(docs_of(rows)) == brute(rows)


def test_levels_merge_and_anti_join(spark, docs_of):
    runs = ld.LineRuns(spark, scratch(spark, "runs"), buckets=4, fanout=3)
    rows = [(i, f"{LONG}\nline number {i % 4} which is long enough to be judged") for i in range(7)]
    for i, row in enumerate(rows):
        batch = ld.line_hashes(docs_of([row]), 40)
        assert runs.unseen(ld.batch_keys(batch)).count() == (2 if i == 0 else 1 if i < 4 else 0)
        runs.add(batch)
    assert [len(x) for x in runs.levels] == [1, 2]
    figures = sorted((r.n_docs, r.max_doc) for r in runs.merged().collect())
    assert figures == [(1, 3), (2, 4), (2, 5), (2, 6), (7, 6)]
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(runs.name)]


def test_runs_hold_new_keys_beside_the_known_ones(spark, docs_of):
    runs = ld.LineRuns(spark, scratch(spark, "runs"), buckets=4, fanout=9)
    for i in range(3):
        runs.add(ld.line_hashes(docs_of([(i, f"{LONG}\nline number {i} which is long enough to be judged too")]), 40))
    assert [tuple(spark.table(t).count() for t in run) for run in runs.runs] == [(2, 0), (1, 1), (1, 1)]
    assert sorted((r.n_docs, r.max_doc) for r in runs.merged().collect()) == [(1, 0), (1, 1), (1, 2), (3, 2)]
    runs.close()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_meet_in_order_without_a_shuffle(spark, docs_of):
    runs = ld.LineRuns(spark, scratch(spark, "runs"), buckets=4, fanout=9)
    for i in range(2):
        runs.add(ld.line_hashes(docs_of([(i, LONG)]), 40))
    anti = plan_of(runs.unseen(runs.dealt(ld.batch_keys(ld.line_hashes(docs_of([(9, LONG)]), 40)))))
    assert anti.count("LeftAnti") == 2 and anti.count("SortMergeJoin") == 2 and anti.count("Bucketed: true") == 2
    a, b = (spark.table(run[0]) for run in runs.runs)
    both = plan_of(a.hint("merge").join(b, ["h1", "h2"], "full_outer"))
    assert "SortMergeJoin" in both and "Exchange" not in both
    runs.close()


def test_long_documents_take_linear_time(docs_of):
    text = "\n".join(f"line number {k} which is long enough to be judged here" for k in range(60_000))
    got = run(docs_of([(i, text) for i in range(5)]))
    assert [r[2] for r in got] == [60_000] * 4 + [0]


def test_extra_columns_pass(docs_of):
    for name in ("h1", "_id", "_lost", "t", "hs", "pos", "max_doc"):
        out = ld.dedup_lines(docs_of([(1, "a\nb")], name))
        assert out.select(name, "source", "text").first() == ("x", "src", "a\nb")


def test_main_path_is_native(docs_of):
    import inspect

    source = inspect.getsource(ld)
    assert not any(w in source for w in ("udf(", "InPandas", "InArrow", ".rdd", "import pandas"))
