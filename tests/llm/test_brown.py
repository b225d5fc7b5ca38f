import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from registrylake.llm import brown


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base(rows):
    c = Counter(t for i, x in rows if not held(i) for t in brown.tokens_of(x))
    n, v = sum(c.values()), len(c)
    out = []
    for i, x in rows:
        toks = brown.tokens_of(x)
        out.append((i, held(i), len(toks), sum(c[t] > 0 for t in toks), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in toks), 6)))
    return sorted(out, key=repr)


def phrases(n, seed):
    r = random.Random(seed)
    a, b, c = ([f"{k}{i}" for i in range(40)] for k in ("art", "adj", "noun"))
    return [(i, " ".join(r.choice(k) for _ in range(r.randrange(1, 30)) for k in (a, b, c)) + r.choice(("", f" odd{i} Odd{i}"))) for i in range(n)]


def run(docs):
    return brown.score(brown.train(docs)).collect()


def test_base_counts_and_gain(docs_of, odd_rows):
    rows = phrases(200, 1) + [(i and i + 1000, t) for i, t in odd_rows]
    got = run(docs_of(rows, "word"))
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == base(rows)
    test = [r for r in got if r.held_out and r.doc_id < 200]
    assert sum(r.score for r in test) > sum(r.base_score for r in test) + 0.2 * sum(r.n_tokens for r in test)
    assert all(math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens)) for r in got)


def shares(monkeypatch, unit, table):
    monkeypatch.setattr(brown, "UNIT_SHARE", unit)
    monkeypatch.setattr(brown, "TABLE_SHARE", table)


@pytest.mark.parametrize("unit, table", [(1 << 17, 1 << 20), (60, 400), (60, 60)])
def test_score_against_brute_force(docs_of, odd_rows, monkeypatch, unit, table):
    """From the classes alone, all counts and probabilities anew, token by token."""
    shares(monkeypatch, unit, table)
    rows = phrases(120, 2) + [(i and i + 1000, t) for i, t in odd_rows]
    model = brown.train(docs_of(rows))
    of = {r["word"]: (r["c"], r["class"]) for r in model.rare.collect()}
    of = {bytes(w): v for w, v in of.items()} | {w: (int(model.counts[i]), int(model.classes[i])) for w, i in model.numbers.items()}
    train = [brown.tokens_of(x) for i, x in rows if not held(i)]
    n, v = sum(map(len, train)), len({t for d in train for t in d})
    assert {t: k[0] for t, k in of.items()} == Counter(t for d in train for t in d)
    stands = lambda t: of[t][1] if t in model.numbers else brown.RARE  # noqa: E731  as a predecessor
    pairs = Counter((stands(p), of[t][1]) for d in train for p, t in zip([brown.END, *d], d))
    size, left = Counter(), Counter()
    for (p, k), m in pairs.items():
        size[k] += m
        left[p] += m
    u = 1 / (n + v + 1)

    def prob(p, t):
        if t not in of:
            return u
        c, k = of[t]
        step = (pairs[stands(p) if p in of else brown.RARE, k] + size[k] / n) / (left[stands(p) if p in of else brown.RARE] + 1)
        return (1 - u) * (brown.MIX * step * c / size[k] + (1 - brown.MIX) * c / n)

    for r in brown.score(model).collect():
        texts = [x for i, x in rows if i == r.doc_id]
        want = {round(sum(math.log10(prob(p, t)) for p, t in zip([brown.END, *toks], toks)), 5) for toks in map(brown.tokens_of, texts)}
        assert round(r.score, 5) in want
    known = [w for w in of]
    for p in (brown.END, known[0], known[-1]):
        assert abs(u + sum(prob(p, t) for t in known) - 1) < 1e-9


def test_rare_words_get_the_class_of_their_contexts(docs_of, monkeypatch):
    """Words beyond the units are told apart by their neighbours, whether they have numbers or not."""
    r = random.Random(5)
    frequent = [[f"{k}{i}" for i in range(4)] for k in ("a", "b", "c")]
    rare = [[f"{k}rare{i}" for i in range(30)] for k in ("a", "b", "c")]
    pick = lambda k: r.choice(rare[k]) if r.random() < 0.15 else r.choice(frequent[k])
    rows = [(i, " ".join(pick(k) for _ in range(20) for k in range(3))) for i in range(300)]
    for table in (200, 1 << 20):
        shares(monkeypatch, 100, table)
        model = brown.train(docs_of(rows))
        of = {bytes(x["word"]): x["class"] for x in model.rare.collect()} | {w: model.classes[i] for w, i in model.numbers.items()}
        for k in range(3):
            kinds = Counter(of[w.encode()] for w in frequent[k])
            assert sum(of[w.encode()] in kinds for w in rare[k]) > 25


def test_likelihood_never_falls(docs_of):
    docs = docs_of([(i, t) for i, t in phrases(300, 4)])
    model = brown.train(docs, rounds=25)
    values = [v for v, _ in model.history]
    assert len(values) > 3 and all(b > a for a, b in zip(values, values[1:])) and all(m > 0 for _, m in model.history[1:])
    few = brown.train(docs, rounds=2)
    out = lambda m: sum(r.score for r in brown.score(m).collect() if r.held_out)
    assert out(model) > out(few)


def test_a_move_alone_gains_what_is_promised():
    rng = np.random.default_rng(0)
    size, classes = 40, brown.CLASSES
    seq = np.concatenate([[*rng.choice(np.arange(2, size), rng.integers(1, 9)), 0] for _ in range(400)])
    seq[rng.random(len(seq)) < 0.2] = 5  # a word that often follows itself
    cls = np.concatenate(([0, brown.RARE], rng.integers(1, 5, size - 2)))

    def tables(c):
        prev = np.concatenate(([0], seq[:-1]))
        b, a = (np.bincount(x * classes + c[y], minlength=size * classes).reshape(size, -1) for x, y in ((seq, prev), (prev, seq)))
        p = np.zeros((classes, classes))
        np.add.at(p, c, a)
        return b, a, np.bincount(seq[seq == prev], minlength=size), p

    b, a, twice, p = tables(cls)
    new, gain = brown.moves(b, a, twice, p, cls)
    moved = 0
    for u in range(2, size):
        trial = cls.copy()
        trial[u] = new[u]
        assert math.isclose(brown.likelihood(tables(trial)[3]) - brown.likelihood(p), gain[u], abs_tol=1e-6)
        every = []
        for k in range(1, classes - 1):
            trial[u] = k
            every.append(brown.likelihood(tables(trial)[3]))
        assert max(every) - brown.likelihood(p) <= gain[u] + 1e-5
        moved += new[u] != cls[u]
    assert moved > 10


def test_empty_tables(docs_of):
    assert run(docs_of([])) == []
    only = next(i for i in range(100) if held(i))
    (row,) = run(docs_of([(only, "a b")]))
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_words_of_whole_buffers():
    """Each text is cut as ``tokens_of`` cuts it, wherever texts, slices and white space begin and end."""
    import pyarrow as pa

    texts = [None, "", "Ab c", "d", " \t\n\x0b\x0c\re F ", "", "g", "\x1cÄb\xa0C d\x00 É", " ", None, "x  y"]
    for lo in range(len(texts)):
        for hi in range(lo, len(texts) + 1):
            words, n = brown.words_in(pa.array(texts, pa.string()).slice(lo, hi - lo))
            assert [words.to_pylist()[e - k : e] for e, k in zip(np.cumsum(n), n)] == [brown.tokens_of(x)[:-1] for x in texts[lo:hi]]


def test_rounds_read_each_pair_once(docs_of):
    """What the rounds of the exchange read are counted pairs, fewer than the tokens; their sums are those of the tokens."""
    rows = phrases(400, 6)
    table = brown.numbered(docs_of(rows), brown.Numbers([f"{k}{i}".encode() for k in ("art", "adj", "noun") for i in range(40)]))
    sides = brown.unit_pairs(table.select("ids").repartition(2), "<u2", 82)
    sums, entries = Counter(), 0
    for r in sides.collect():
        unit, before, n = (np.frombuffer(x, k).tolist() for x, k in zip(r, ("<u2", "<u2", "<u4")))
        entries += len(n)
        sums.update({(b, u): 0 for b, u in zip(before, unit)})
        for b, u, m in zip(before, unit, n):
            sums[b, u] += m
    number = {brown.END: 0} | {f"{k}{i}".encode(): 2 + 40 * j + i for j, k in enumerate(("art", "adj")) for i in range(40)}
    docs = [[number.get(t, 1) for t in brown.tokens_of(x)] for _, x in rows]
    assert sums == Counter((p, t) for d in docs for p, t in zip([0, *d], d))
    assert entries <= 2 * len(sums) < sum(sums.values()) / 2
