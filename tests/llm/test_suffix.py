import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from registrylake.llm import esais, suffix


def brute(rows, length):
    """Rows that share doc_id and text are one document."""
    t = {}
    order = sorted({(i, x or "") for i, x in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seen, out = set(), {}
    for key in order:
        raw = key[1].encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        edge = np.diff(gone.astype(int), prepend=0)
        out[key] = (key[0], len(raw), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
    return sorted((out[i, x or ""] for i, x in rows), key=repr)


def run(docs, **how):
    return sorted((tuple(r)[:5] for r in suffix.dedup_substrings(docs, **how).collect()), key=repr)


def corpus(seed, n=60):
    r = random.Random(seed)
    words = ["é" + "ab"[r.randrange(2)] * r.randrange(1, 6) for _ in range(60)]
    shared = [" ".join(r.choice(words) for _ in range(r.randrange(5, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 30))) for _ in range(3)]
        if r.random() < 0.6:
            parts.insert(r.randrange(3), r.choice(shared))
        rows.append((i, " ".join(parts)))
        if r.random() < 0.2:
            rows.append((1000 + i, rows[r.randrange(len(rows))][1]))
        if r.random() < 0.2:
            x = list(rows[r.randrange(len(rows))][1] or "x")
            x[r.randrange(len(x))] = "Z"
            rows.append((2000 + i, "".join(x)))
    return rows


ODD = [(5000, None), (5001, ""), (5002, "a" * 900), (5003, "a" * 500), (5004, "abc" * 200), (5005, "xyz" * 10), (None, "a" * 150), (5006, "日本" * 80), (5006, "日本" * 80), (5007, "q" * 60000)]


@pytest.mark.parametrize("how", [{}, {"shard_bytes": 3000, "budget": 500, "base": 50}, {"hot_bytes": 500}, {"hot_bytes": 0, "shard_bytes": 20000, "base": 100}])
def test_against_brute_force(docs_of, how):
    rows = corpus(1) + ODD
    assert run(docs_of(rows, "start"), length=30, gram=8, **how) == brute(rows, 30)


def test_production_length(docs_of):
    rows = corpus(2) + ODD[:6]
    assert run(docs_of(rows)) == brute(rows, 100)


def test_empty_table(docs_of):
    assert run(docs_of([])) == []


def test_equal_windows_share_their_anchor():
    r = random.Random(0)
    piece = bytes(r.randrange(97, 101) for _ in range(160))
    texts = [bytes(r.randrange(97, 101) for _ in range(50)) + piece + bytes(r.randrange(97, 101) for _ in range(70)) for _ in range(2)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    doc, start, n, h, _, _ = suffix.segments(data, np.array([len(x) for x in texts]), 100, 32)
    of = {(int(d), int(s) + k): int(a) for d, s, m, a in zip(doc, start, n, h) for k in range(m)}
    assert len(of) == sum(len(x) - 99 for x in texts)
    assert all(of[0, 50 + k] == of[1, 50 + k] for k in range(61))


def spread(seed, size):
    """Contexts with many repeats among them, as one batch after another."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(300)]
    pool = [" ".join(r.choice(words) for _ in range(200)) for _ in range(50)]
    made = 0
    while made < size:
        rows = []
        for _ in range(500):
            text = r.choice(pool)
            at = r.randrange(len(text) - 170)
            ctx = (text[at : at + r.randrange(100, 169)] if r.random() < 0.5 else " ".join(r.choice(words) for _ in range(30)))[:168].encode()
            rows.append((r.randrange(10**6), r.getrandbits(62), r.randrange(1000), ctx))
            made += len(ctx)
        yield pa.RecordBatch.from_pydict(dict(zip(("doc_id", "t", "start", "ctx"), (pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))))))


def lost_of(batches, length=100):
    """Brute force over the windows of all contexts."""
    best, places = {}, []
    for b in batches:
        for doc, t, start, ctx in zip(*(c.to_pylist() for c in b.columns)):
            for k in range(len(ctx) - length + 1):
                key = (doc, t >> 33 & (1 << 31) - 1, start + k)
                places.append((ctx[k : k + length], key, (doc, t, start + k)))
                best[ctx[k : k + length]] = min(best.get(ctx[k : k + length], key), key)
    return {at for w, key, at in places if key != best[w]}


@pytest.mark.parametrize("how", [(1 << 30, 1 << 30), (2000, 200), (500, 20)])
def test_a_shard_against_brute_force(how):
    batches = list(spread(3, 150_000))
    report: dict = {}
    got = set()
    for b in suffix.sorted_shard(iter(batches), 100, *how, report):
        for doc, t, a, z in zip(*(c.to_pylist() for c in b.columns)):
            got |= {(doc, t, k) for k in range(a, z + 1)}
    assert got == lost_of(batches) and len(got) > 1000
    assert how[0] > 10**6 or (report["spills"] > 0 and report["recursions"] > 0)


def test_production_settings_spill_and_recurse():
    """In a full default shard the queues spill and names are sorted by recursion."""
    report: dict = {}
    rows = sum(b.num_rows for b in suffix.sorted_shard(spread(4, suffix.SHARD_BYTES), 100, suffix.BUDGET, suffix.BASE, report))
    assert report["spills"] > 0 and report["recursions"] > 0 and rows > 0


def test_memory_stays_far_below_the_shard(monkeypatch):
    """All that is allocated in a sort of a shard, with small blocks and budgets: the rest is in files."""
    monkeypatch.setattr(esais, "BLOCK", esais.BLOCK // 32)
    peaks = []
    for size in (3 << 20, 12 << 20):
        report: dict = {}
        tracemalloc.start()
        rows = sum(b.num_rows for b in suffix.sorted_shard(spread(4, size), 100, suffix.BUDGET // 8, suffix.BASE // 32, report))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert rows > 0 and report["spills"] > 0 and report["recursions"] > 0
    assert peaks[1] < 10 << 20 and peaks[1] < 3 * peaks[0], peaks


def contexts_of(texts, length, gram):
    """The contexts of one-text documents with their anchors, as a shard gets them; of equal ones the first."""
    made = {}
    for i, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        _, start, n, h, c, hashes = suffix.segments(data, np.array([len(data)]), length, gram)
        g = suffix.places_of(hashes, start, n, h, length - gram + 1)
        assert ((g < 0) == suffix.stand_twice(hashes, start, n, h, length - gram + 1)).all()
        for a, k, s, d, x in zip(start.tolist(), n.tolist(), h.tolist(), c.tolist(), g.tolist()):
            made.setdefault((s, d), (i, 0, a, text[a : a + k + length - 1], s, x))
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_pydict(dict(zip(("doc_id", "t", "start", "ctx", "s", "g"), (pa.array(c, k) for c, k in zip(zip(*made.values()), kinds)))))


@pytest.mark.parametrize("counters", [suffix.COUNTERS, 1 << 6])
def test_only_windows_that_may_be_equal_are_sorted(tmp_path, monkeypatch, counters):
    """Contexts that share their anchor but no window are left out, and no equal window is; a run of one letter repeats within itself."""
    monkeypatch.setattr(suffix, "COUNTERS", counters)
    r = random.Random(6)
    some = lambda n: bytes(r.choice(b"abcdefgh") for _ in range(n))
    short, whole = some(70), some(260)
    texts = [some(150) + short + some(150) for _ in range(40)] + [some(90) + whole + some(90) for _ in range(4)] + [b"x" * 300, some(50) + b"xy" * 120, some(150)]
    batch = contexts_of(texts, 100, 32)
    kept = [*suffix.shared_windows(iter([batch.slice(0, 50), batch.slice(50)]), str(tmp_path), 100, 69)]
    assert lost_of(kept) == lost_of([batch.select(["doc_id", "t", "start", "ctx"])])
    assert len(lost_of(kept)) > 3 * 161
    size = sum(len(x) for b in kept for x in b.column(3).to_pylist())
    assert counters < 1000 or size < 0.5 * sum(len(x) for x in batch.column(3).to_pylist())


def test_no_contexts_no_windows(tmp_path):
    assert [*suffix.shared_windows(iter([]), str(tmp_path), 100, 69)] == []
