"""Language ID by multilingual mixture inference.

A language is a smoothed distribution of character n-grams (orders 1 to ``ORDERS``, hashed to
``BUCKETS``). A document is a mixture: each of its words comes from one of the languages, and
expectation-maximisation finds the proportions that make its words most likely. The document's set of
languages is the nested set (by proportion) with the best likelihood less a penalty of half the
logarithm of the number of words for each further language; the prediction is the largest of them.

Fitting may use a bounded sample of the labelled rows: about ``fit_documents`` (default 2,000) of each
language, chosen by a hash of doc_id and text, whole texts. Inference reads every whole text.

Nulls, empties and ties: ``und`` with score 0 for a null text, a text without letters, and any text if
nothing was learned; rows with null lang teach nothing; equal proportions go to the language first in
order; words without a letter carry no weight; repeated rows are judged alike; an empty table gives no
rows; a null doc_id is never a training row and never held out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.encode import row_chunks

ORDERS, BUCKETS, SMOOTH, WEIGHT = 4, 1 << 16, 0.05, 0.5
STEPS, REJECT_BELOW = 12, 0.4
RESULT = "doc_id long, held_out boolean, lang_pred string, score double, langs array<string>, shares array<double>"
_WORD = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list:
    return _WORD.findall(text.lower()) if text else []


def grams(words: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, order (from 0) and word number of every n-gram of ``words``, word edges included."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edge = codes == 32
    word = np.cumsum(edge) - 1
    out, mixed = [], np.zeros(len(codes), np.uint64)
    for n in range(ORDERS):
        size = len(codes) - n
        mixed = (mixed[:size] * np.uint64(0x9E3779B97F4A7C15)) ^ (codes[n:] * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed ^= mixed >> np.uint64(29)
        edges = np.concatenate(([0], np.cumsum(edge)))
        inside = edges[n:][1 : size + 1] - edges[:size]  # edges among the n + 1 characters
        inside = inside - edge[:size] - (edge[n:] if n else 0)
        ok = (inside == 0) & ~(edge[:size] & edge[n:]) if n < 2 else (inside == 0)
        at = np.flatnonzero(ok)
        out.append(((mixed[at] >> np.uint64(7)) % np.uint64(BUCKETS), np.full(len(at), n), word[at]))
    return tuple(np.concatenate(x) for x in zip(*out))


class Languages:
    """Log-probabilities (order, bucket, language) and a bounded memory of words' log-likelihoods."""

    def __init__(self, names: list, counts: np.ndarray, remembered: int = 150_000):
        self.names = names
        totals = counts.sum(axis=1, keepdims=True)
        kinds = (counts.sum(axis=2, keepdims=True) > 0).sum(axis=1, keepdims=True) + 1
        self.logp = np.log((counts + SMOOTH) / (totals + SMOOTH * kinds)).astype(np.float32)
        self.remembered = remembered
        self._clear()

    def _clear(self) -> None:
        self.at: dict = {}
        self.rows = np.zeros((1024, len(self.names)), np.float32)

    def __getstate__(self):
        return {"names": self.names, "logp": self.logp, "remembered": self.remembered}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._clear()

    def numbers(self, texts: list) -> list:
        """For each list of words the row numbers of their log-likelihoods (see ``rows``)."""
        if len(self.at) > self.remembered:
            self._clear()
        new = list({w for words in texts for w in words if w not in self.at and any(map(str.isalpha, w))})
        for lo in range(0, len(new), 50_000):
            part = new[lo : lo + 50_000]
            bucket, order, word = grams(part)
            got = np.zeros((len(part), len(self.names)), np.float32)
            for k in range(len(self.names)):
                got[:, k] = WEIGHT * np.bincount(word, self.logp[order, bucket, k], len(part))
            first = len(self.at)
            self.at.update((w, first + i) for i, w in enumerate(part))
            while len(self.rows) < first + len(part):
                self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
            self.rows[first : first + len(part)] = got
        get = self.at.get
        return [[n for n in map(get, words) if n is not None] for words in texts]

    def mixtures(self, texts: list) -> list:
        """(language, proportion, set, proportions) of each list of words; None without words."""
        numbers = self.numbers(texts)
        full = [i for i, n in enumerate(numbers) if n]
        out: list = [None] * len(texts)
        if not full or not self.names:
            return out
        kinds = [np.unique(np.array(numbers[i]), return_counts=True) for i in full]
        sizes = np.array([len(k) for k, _ in kinds])
        logs = self.rows[np.concatenate([k for k, _ in kinds])].astype(np.float64)
        weight = np.concatenate([c for _, c in kinds]).astype(np.float64)
        doc = np.repeat(np.arange(len(full)), sizes)
        n = np.bincount(doc, weight)
        penalty = 0.5 * np.log(np.maximum(n, 2))
        start = np.cumsum(sizes) - sizes
        share, best = expect(logs, weight, doc, start, np.ones((len(full), len(self.names))))
        alone = np.add.reduceat(weight[:, None] * logs, start, axis=0)
        rank = np.argsort(-share, axis=1, kind="stable")
        chosen = np.zeros_like(share)
        top = np.argmax(alone, axis=1)
        chosen[np.arange(len(full)), top] = 1
        least = -alone.max(axis=1)
        # A larger set gains at most what the full set gains, so others than these stay with one language.
        open_ = np.flatnonzero(best + least > penalty)
        pos = np.empty(len(full), np.int64)
        for k in range(2, len(self.names) + 1):
            if not len(open_):
                break
            pos[:] = -1
            pos[open_] = np.arange(len(open_))
            rows = np.flatnonzero(pos[doc] >= 0)
            allowed = np.zeros((len(open_), len(self.names)))
            np.put_along_axis(allowed, rank[open_, :k], 1, axis=1)
            d = pos[doc[rows]]
            got, like = expect(logs[rows], weight[rows], d, np.searchsorted(d, np.arange(len(open_))), allowed)
            cost = -like + (k - 1) * penalty[open_]
            better = cost < least[open_]
            chosen[open_[better]] = got[better]
            least[open_[better]] = cost[better]
        pick = np.argmax(chosen, axis=1)
        for i, at in enumerate(full):
            order = np.argsort(-chosen[i], kind="stable")
            order = order[chosen[i][order] > 0]
            out[at] = (self.names[pick[i]], float(min(1.0, share[i, pick[i]])), [self.names[k] for k in order], chosen[i][order].tolist())
        return out


def expect(logs: np.ndarray, weight: np.ndarray, doc: np.ndarray, start: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document by EM, over the languages allowed to it."""
    high = np.where(allowed[doc] > 0, logs, -np.inf).max(axis=1)
    like = np.exp(np.clip(logs - high[:, None], -700, 0)) * (allowed[doc] > 0)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    n = np.add.reduceat(weight, start)[:, None]
    for step in range(STEPS + 1):
        part = like * share[doc]
        total = part.sum(axis=1)
        if step == STEPS:
            return share, np.add.reduceat(weight * (high + np.log(np.maximum(total, 1e-300))), start)
        part *= (weight / np.maximum(total, 1e-300))[:, None]
        share = np.add.reduceat(part, start, axis=0) / n


def is_held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, fit_documents: int = 2000) -> Languages:
    """Counts n-grams of a sample of about ``fit_documents`` labelled documents of each language."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    names = sorted(sizes)
    if not names:
        return Languages([], np.zeros((ORDERS, BUCKETS, 0)))
    share = F.create_map(*[x for k in names for x in (F.lit(k), F.lit(min(1.0, fit_documents / sizes[k])))])
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(chance < F.element_at(share, F.col("lang"))).select("lang", "text")

    def tally(batches):
        held: dict = {}
        for batch in (p for b in batches for p in row_chunks(b, 1)):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = letter_words(text)
                if words:
                    bucket, order, _ = grams(words)
                    if lang not in held:
                        held[lang] = np.zeros(ORDERS * BUCKETS, np.int64)
                    held[lang] += np.bincount(order * BUCKETS + bucket.astype(np.int64), minlength=ORDERS * BUCKETS)
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "gram": at, "n": counts[at]})

    counts = np.zeros((ORDERS * BUCKETS, len(names)))
    total = sample.mapInArrow(tally, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = total.toArrow()  # at most ORDERS * BUCKETS rows a language
    number = {k: i for i, k in enumerate(names)}
    counts[got.column("gram").to_numpy(), [number[x] for x in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
    return Languages(names, counts.reshape(ORDERS, BUCKETS, len(names)))


def predict(docs: DataFrame, model: Languages) -> DataFrame:
    """doc_id, held_out, lang_pred, score, langs, shares; text alone decides."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        languages = shared.value
        for batch in batches:
            for part in row_chunks(batch, 2, 256):
                texts = part.column(2).to_pylist()
                got = [g or ("und", 0.0, [], []) for g in languages.mixtures([letter_words(t) for t in texts])]
                names, scores, langs, shares = zip(*got)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "held_out": part.column(1), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64()), "langs": pa.array(langs, pa.list_(pa.string())), "shares": pa.array(shares, pa.list_(pa.float64()))})

    doc_id = F.col("doc_id").cast("long")
    held = F.coalesce(is_held_out(doc_id), F.lit(False))
    return docs.select(doc_id.alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(run, RESULT)


def accepted(docs: DataFrame, model: Languages, least: float = REJECT_BELOW) -> DataFrame:
    """The rows of ``docs`` whose language is told with a proportion of at least ``least``; all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        languages = shared.value
        for batch in batches:
            for part in row_chunks(batch, at, 256):
                texts = part.column(at).cast(pa.string()).to_pylist()
                keep = [g is not None and g[1] >= least for g in languages.mixtures([letter_words(t) for t in texts])]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the language of every document of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, fit(docs))
