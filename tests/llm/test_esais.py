import random
import tempfile

import numpy as np
import pytest

from registrylake.llm import esais


def texts():
    r = random.Random(4)
    yield from ([r.randrange(1, 1 + k) for _ in range(n)] for k in (1, 2, 3, 9) for n in (1, 2, 5, 40, 300))
    base = [r.randrange(1, 5) for _ in range(120)]
    yield base * 4
    yield [2, 1] * 90
    yield [1] * 150 + [2] * 150 + [1] * 150
    yield [r.choice((3, 3, 3, 7)) for _ in range(500)]


@pytest.mark.parametrize("kind", [np.uint8])
@pytest.mark.parametrize("how", [{}, {"budget": 60, "base": 8, "step": 5}, {"budget": 400, "base": 4}])
def test_all_suffixes_in_order_with_common_prefixes(tmp_path, how, kind):
    for limit in (1000, 7):
        for raw in texts():
            text = np.array([*raw, 0], kind)
            with tempfile.TemporaryDirectory(dir=tmp_path) as path:
                chunks = []
                esais.SuffixSorter(text, esais.Folder(path), limit=limit, **how).visit(lambda c: chunks.append(c.copy()))
            at = np.concatenate([c["at"] for c in chunks]) if chunks else np.zeros(0, int)
            lcp = np.concatenate([c["lcp"] for c in chunks]) if chunks else np.zeros(0, int)
            suffix = {i: tuple(text[i:].tolist()) for i in range(len(text))}
            want = sorted(range(len(raw)), key=suffix.get, reverse=True)
            assert sorted(at.tolist()) == sorted(want)
            assert [suffix[i][:limit] for i in at.tolist()] == [suffix[i][:limit] for i in want]
            for k in range(1, len(at)):
                a, b = suffix[int(at[k - 1])], suffix[int(at[k])]
                same = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                assert lcp[k] == min(same, limit), (raw, limit, k)


def test_queue_spills_and_keeps_order(tmp_path):
    q = esais.BucketQueue(esais.Folder(str(tmp_path)), False, 100, esais.ENTRY[4])
    for i in range(50):
        q.push(i % 3, esais.entries(np.array([i]), np.array([0]), q.dtype))
    got = []
    while q.heap:
        s = q.first()
        got += [(s, int(x)) for part in q.take(s) for x in q.read(part)["at"]]
    assert q.folder.spills and got == sorted((i % 3, i) for i in range(50))


@pytest.mark.parametrize("window, base, budget", [(4096, 4, 1 << 20), (3, 2, 50), (1, 2, 300)])
def test_names_are_sorted_by_recursive_induction(tmp_path, window, base, budget):
    r = random.Random(9)
    raws = [[r.randrange(1, 1 + k) for _ in range(n)] for k in (1, 2, 5, 400) for n in (1, 3, 30, 700)] + [[1, 2] * 200, [5, 4, 3, 2, 1] * 50, [7] * 300 + [3] * 5 + [7] * 300]
    for raw in raws:
        text = np.array([*raw, 0], np.int64)
        with tempfile.TemporaryDirectory(dir=tmp_path) as path:
            folder = esais.Folder(path)
            order = esais.NameSorter(text, len(set(raw)) + 1, folder, budget, 10**6, base, window).order()
            assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
            assert budget > 50 or len(raw) < 300 or len(set(raw)) < 100 or folder.spills


def test_a_run_of_one_name_is_passed_at_once(tmp_path, monkeypatch):
    """A run of thousands of equal names is written in a few steps, not one for each of its places."""
    adds, add = [], esais.Stream.add
    monkeypatch.setattr(esais.Stream, "add", lambda self, values: (adds.append(len(values)), add(self, values))[1])
    raw = [*[5] * 3000, 9, 1, *[4] * 2000, 2, 7]
    order = esais.NameSorter(np.array([*raw, 0], np.int64), 10, esais.Folder(str(tmp_path)), 1 << 20, 10**6, 4).order()
    assert order.tolist() == sorted(range(len(raw) + 1), key=lambda i: [*raw, 0][i:])
    assert len(adds) < 300
