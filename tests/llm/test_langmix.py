import math
import random
from collections import Counter

import numpy as np

from registrylake.llm import langmix

TEXTS = {
    "aa": "the house and the garden with trees where birds sing in the morning light",
    "bb": "das haus und der garten mit bäumen wo die vögel am morgen singen schön",
    "cc": "la maison et le jardin avec des arbres où chantent les oiseaux du matin",
}


def corpus(n, seed, mix=()):
    r, out = random.Random(seed), []
    for i in range(n):
        lang = r.choice(sorted(TEXTS))
        out.append((i, " ".join(r.choice(TEXTS[lang].split()) for _ in range(r.randrange(5, 60))), lang))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_grams_are_those_of_single_words():
    words = ["ab", "c", "déf"]
    whole = sorted(zip(*(x.tolist() for x in langmix.grams(words))))
    single = sorted((b, o, i) for i, w in enumerate(words) for b, o, _ in zip(*(x.tolist() for x in langmix.grams([w]))))
    assert whole == single
    # " ab ": a, b | " a", "ab", "b " | " ab", "ab " | " ab "
    assert len(langmix.grams(["ab"])[0]) == 2 + 3 + 2 + 1


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus(300, 1) + [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !? ²", "bb"), (None, TEXTS["bb"], "bb"), (1003, TEXTS["cc"] * 2000, None), (1004, "x", None)]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in langmix.predict(docs, langmix.fit(docs)).collect()}
    assert len(got) == len(rows)
    held = [(got[i].lang_pred, lang) for i, t, lang in corpus(300, 1) if got[i].held_out]
    assert held and sum(a == b for a, b in held) >= 0.98 * len(held)
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred == "cc" and got[None].lang_pred == "bb" and not got[None].held_out
    assert all(0 <= r.score <= 1 for r in got.values())


def test_mixture_and_penalty(spark):
    docs = frame(spark, corpus(300, 2))
    model = langmix.fit(docs)
    both, one = langmix.letter_words(TEXTS["aa"] * 3 + " " + TEXTS["bb"]), langmix.letter_words(TEXTS["cc"] * 3)
    (name, share, langs, shares), (alone, _, langs1, _), none = model.mixtures([both, one, []])
    assert name == "aa" and langs[:2] == ["aa", "bb"] and abs(shares[0] - 0.75) < 0.12 and abs(sum(shares) - 1) < 1e-9
    assert alone == "cc" and langs1 == ["cc"] and none is None


def brute_mixture(model, words):
    """Word by word in plain Python: EM over each nested set of languages, then the least penalised cost."""
    kinds = Counter(w for w in words if any(map(str.isalpha, w)))
    if not kinds:
        return None
    langs = range(len(model.names))
    log = {w: [langmix.WEIGHT * sum(float(model.logp[o, b, k]) for b, o, _ in zip(*(x.tolist() for x in langmix.grams([w])))) for k in langs] for w in kinds}
    n = sum(kinds.values())

    def em(allowed):
        share = {k: 1 / len(allowed) for k in allowed}
        for _ in range(langmix.STEPS):
            new = dict.fromkeys(allowed, 0.0)
            for w, c in kinds.items():
                top = max(log[w][k] for k in allowed)
                like = {k: share[k] * math.exp(log[w][k] - top) for k in allowed}
                for k in allowed:
                    new[k] += c * like[k] / sum(like.values())
            share = {k: v / n for k, v in new.items()}
        total = 0.0
        for w, c in kinds.items():
            top = max(log[w][k] for k in allowed)
            total += c * (top + math.log(sum(share[k] * math.exp(log[w][k] - top) for k in allowed)))
        return share, total

    full, _ = em(list(langs))
    alone = [sum(c * log[w][k] for w, c in kinds.items()) for k in langs]
    best, cost = {max(langs, key=lambda k: (alone[k], -k)): 1.0}, -max(alone)
    rank = sorted(langs, key=lambda k: (-full[k], k))
    for size in range(2, len(model.names) + 1):
        share, like = em(rank[:size])
        if -like + (size - 1) * 0.5 * math.log(max(n, 2)) < cost - 1e-9:
            best, cost = share, -like + (size - 1) * 0.5 * math.log(max(n, 2))
    pick = max(best, key=lambda k: (best[k], -k))
    return model.names[pick], full[pick], [model.names[k] for k in sorted(best, key=lambda k: (-best[k], k)) if best[k] > 0]


def test_mixtures_against_brute_force(spark):
    docs = frame(spark, corpus(200, 5))
    model = langmix.fit(docs)
    r = random.Random(8)
    texts = [t for _, t, _ in corpus(15, 6)] + [" ".join(r.choice(TEXTS[k].split()) for k in r.choices(sorted(TEXTS), [r.random() for _ in TEXTS], k=n)) for n in (1, 2, 5, 12, 30, 60, 200) for _ in range(4)] + ["", "12 !", "qq zz", "é", "the le der"]
    words = [langmix.letter_words(t) for t in texts]
    sizes = set()
    for got, w in zip(model.mixtures(words), words):
        want = brute_mixture(model, w)
        assert (got is None) == (want is None)
        if want:
            assert got[0] == want[0] and got[2] == want[2] and abs(got[1] - min(1, want[1])) < 1e-4
            sizes.add(len(want[2]))
    assert sizes == {1, 2, 3}


def test_clashing_columns_pass(spark):
    docs = frame(spark, corpus(120, 7))
    model = langmix.fit(docs)
    want = sorted((r.doc_id, r.lang_pred) for r in langmix.predict(docs, model).collect())
    odd = docs.selectExpr("doc_id", "'x' AS lang_pred", "1 AS score", "text", "true AS held_out", "lang", "array(1) AS langs", "2 AS shares")
    assert sorted((r.doc_id, r.lang_pred) for r in langmix.predict(odd, langmix.fit(odd)).collect()) == want
    kept = langmix.accepted(odd, model)
    assert kept.columns == odd.columns and {r.lang_pred for r in kept.collect()} == {"x"}


def test_em_raises_the_likelihood():
    rng = np.random.default_rng(0)
    logs, weight, doc = rng.normal(size=(40, 3)) * 5, rng.integers(1, 5, 40).astype(float), np.repeat([0, 1], 20)
    args = (logs, weight, doc, np.array([0, 20]), np.ones((2, 3)))
    share, full = langmix.expect(*args)
    start = np.log(np.exp(logs).mean(axis=1))
    assert (full >= [np.sum(weight[:20] * start[:20]), np.sum(weight[20:] * start[20:])]).all() and np.allclose(share.sum(axis=1), 1)


def test_nothing_learned_and_empty(spark):
    docs = frame(spark, [(1, "some words", None)])
    assert [(r.lang_pred, r.score) for r in langmix.predict(docs, langmix.fit(docs)).collect()] == [("und", 0.0)]
    empty = frame(spark, []).limit(0)
    assert langmix.predict(empty, langmix.fit(empty)).collect() == []


def test_lang_and_source_are_no_inputs(spark):
    docs = frame(spark, corpus(200, 3))
    model = langmix.fit(docs)
    a = {r.doc_id: tuple(r) for r in langmix.predict(docs, model).collect()}
    b = {r.doc_id: tuple(r) for r in langmix.predict(docs.selectExpr("doc_id", "text", "'bb' AS lang", "'q' AS source"), model).collect()}
    assert a == b
