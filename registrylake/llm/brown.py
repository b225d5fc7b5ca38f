"""LM scoring with a Brown class-based bigram model.

Words are counted over the whole training corpus. The words with at least 2**-20 of all tokens (so at most 2**20 of them,
whatever the corpus) have numbers; texts are kept as numbers, and the other words beside them.

Exchange clustering works on the *units*, the words with at least 2**-17 of all tokens: what stands side by side is counted
once in each some million tokens, and each round sums over the whole training corpus how often each unit stands before and after each class, proposes to every unit the class that raises the
likelihood of the class bigrams most, and moves a random share of them. As units move together, the new likelihood is
counted, and a round that does not raise it is taken back and tried with a quarter of its moves, at last with the best
one alone; so the likelihood never falls. The share follows what the moves brought together of what they promised alone.
It ends when all promised gains together are below ``TOLERANCE`` nats for each token.

Then every other training word, however rare, gets the class that its own contexts make most likely, with the classes
of the units held still: first the numbered words, then the others in a shuffle by word. Words seen fewer than ``LEAST`` times
have too few contexts and share the class ``RARE``; in the place of a predecessor all words without numbers stand for it.

    P(w | v) = (1 - u) * (MIX * P(class w | class v) * c(w) / n(class w) + (1 - MIX) * c(w) / N)

for known words, with class transitions smoothed by the class's frequency, and u = 1 / (N + V + 1) for
unknown ones, the mass that the base model gives them. Words without numbers meet their counts and classes in a shuffle
join. Every statistic covers every training document. ``perplexity`` is 10 ** (-score / n_tokens).

Nulls, empties and ties: a null or empty text is one end token; a null doc_id is training text, not held
out; equal gains go to the lowest class; repeated rows count, and are scored, as often as they occur; an
empty training corpus gives every token probability one; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.common import written
from registrylake.llm.encode import row_chunks

CLASSES, LEAST, MIX, TOLERANCE, MOST_ROUNDS = 64, 3, 0.95, 0.02, 40
UNIT_SHARE, TABLE_SHARE, BLOCK = 1 << 17, 1 << 20, 256
END = b""  # the end token; no word is empty
#: Numbers 0 and 1 are the end token and any word without a number; so are the classes of both, the first and the last.
FIRST_WORD, RARE = 2, CLASSES - 1
#: White space to blanks, A-Z to a-z.
SPACED = bytes(0x20 if 9 <= c <= 13 else c for c in range(256)).lower()


def tokens_of(text: str | None) -> list:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all ``texts`` one after another, and how many each has: ``tokens_of`` without its ends, on whole buffers."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer((raw[at[0] : at[-1]].to_pybytes() if raw else b"").translate(SPACED), np.uint8)
    at = at - at[0]
    solid = data != 0x20
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    first, last = at[at < len(data)], at[at > 0] - 1  # a word ends with its text
    begin[first], end[last] = solid[first], solid[last]
    starts = np.flatnonzero(begin)
    places = np.append(0, np.cumsum(np.flatnonzero(end) - starts + 1)).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[solid])])
    return words, np.diff(np.searchsorted(starts, at))


def is_held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def count_words(docs: DataFrame, most: int = 6_000_000) -> DataFrame:
    """word, c over all of ``docs``; tasks hold the words of some ``most`` tokens at a time."""

    def counted(held, texts):
        values, n = pc.value_counts(pa.chunked_array(held, pa.binary())).flatten()
        yield pa.RecordBatch.from_arrays([values, n], names=["word", "c"])
        yield pa.RecordBatch.from_pydict({"word": pa.array([END], pa.binary()), "c": pa.array([texts], pa.int64())})

    def tally(batches):
        held, texts = [], 0
        for part in (p for batch in batches for p in row_chunks(batch, 0)):
            held.append(words_in(part.column(0))[0])
            texts += part.num_rows
            if sum(map(len, held)) >= most:
                yield from counted(held, texts)
                held, texts = [], 0
        if texts:
            yield from counted(held, texts)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tally, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Numbers(dict):
    """Word -> number; words without one have 1."""

    def __init__(self, words: list):
        super().__init__((w, i + FIRST_WORD) for i, w in enumerate(words))
        self[END] = 0
        self.size = len(words) + FIRST_WORD

    def __missing__(self, word: bytes) -> int:
        return 1

    def __reduce__(self):
        return (Numbers, (sorted((w for w in self if w), key=self.__getitem__),))


def numbered(docs: DataFrame, numbers: Numbers) -> DataFrame:
    """rid, doc_id, held_out, ids (numbers of all tokens) and rare (the words without one, in order) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    kind = kind_of(numbers.size)

    def run(batches):
        get = shared.value.get
        row = TaskContext.get().partitionId() << 32
        for part in (p for batch in batches for p in row_chunks(batch, 2, 4096, 8 << 20)):
            words, n = words_in(part.column(2))
            coded = words.dictionary_encode()  # a word is looked up once in a part
            u = np.array([get(w, 1) for w in coded.dictionary.to_pylist()], kind)[coded.indices.to_numpy()]
            ends = np.append(0, np.cumsum(n + 1))
            ids = np.zeros(ends[-1], kind)
            ids[np.arange(len(u)) + np.repeat(np.arange(len(n)), n)] = u
            where = np.flatnonzero(u == 1)
            rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(where, np.append(0, np.cumsum(n))), pa.int32()), words.take(pa.array(where)))
            texts = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((ends * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + len(n))), part.column(0), part.column(1), texts, rare], names=["rid", "doc_id", "held_out", "ids", "rare"])
            row += len(n)

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), is_held_out(doc_id).alias("held_out"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(run, "rid long, doc_id long, held_out boolean, ids binary, rare array<binary>"), "numbers")


def kind_of(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def streams(batches, kind: str, least: int = 1 << 20):
    """Arrays of about ``least`` numbers; documents end with 0, which is also what precedes them."""
    held, size = [], 0
    for batch in batches:
        for data in batch.column(0).to_pylist():
            held.append(data)
            size += len(data)
            if size >= least * np.dtype(kind).itemsize:
                yield np.frombuffer(b"".join(held), kind)
                held, size = [], 0
    if held:
        yield np.frombuffer(b"".join(held), kind)


def unit_pairs(sequences: DataFrame, kind: str, size: int, least: int = 1 << 22) -> DataFrame:
    """unit, before, n for the rounds of the exchange: what stands side by side in ``least`` tokens, and how often; numbers from ``size`` on are 1."""

    def run(batches):
        for ids in streams(batches, kind, least):
            u = np.where(ids < size, ids, 1).astype(np.int64)
            key = u * size
            key[1:] += u[:-1]
            key, n = np.unique(key, return_counts=True)
            parts = (key // size).astype(kind_of(size)), (key % size).astype(kind_of(size)), n.astype("<u4")
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], names=["unit", "before", "n"])

    return written(sequences.mapInArrow(run, "unit binary, before binary, n binary"), "unit-pairs")


def phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(pairs: np.ndarray) -> float:
    """Of the class bigrams, in nats; what the classes cannot change is left out."""
    return float(phi(pairs).sum() - phi(pairs.sum(axis=0)).sum() - phi(pairs.sum(axis=1)).sum())


def moves(before: np.ndarray, after: np.ndarray, twice: np.ndarray, pairs: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best class of each unit and what its move alone gains, exactly.

    ``before``/``after`` are a unit's counts of classes on the left and right, ``twice`` how often it follows itself.
    """
    best, gains = own.copy(), np.zeros(len(own))
    kk = np.arange(len(pairs))
    for lo in range(0, len(own), 128):
        o, d = own[lo : lo + 128], twice[lo : lo + 128].astype(np.float64)
        b, a = before[lo : lo + 128].astype(np.float64), after[lo : lo + 128].astype(np.float64)
        n, at = len(o), np.arange(len(o))
        b[at, o] -= d
        a[at, o] -= d
        rest = np.broadcast_to(pairs, (n, *pairs.shape)).copy()  # the pairs without the unit
        rest[at, o, :] -= a
        rest[at, :, o] -= b
        rest[at, o, o] -= d
        more, less = (a.sum(axis=1) + d)[:, None], (b.sum(axis=1) + d)[:, None]
        # Sums of rows and columns: what the unit's neighbours have of it stays wherever the unit goes.
        rows, cols = rest.sum(axis=2) + b, rest.sum(axis=1) + a
        had = phi(rest)
        out, into = phi(rest + a[:, None, :]) - had, phi(rest + b[:, :, None]) - had
        gain = out.sum(axis=2) + into.sum(axis=1) - out[:, kk, kk] - into[:, kk, kk]
        gain += phi(rest[:, kk, kk] + a + b + d[:, None]) - had[:, kk, kk]
        gain -= phi(rows + more) - phi(rows) + phi(cols + less) - phi(cols)
        gain[:, [0, -1]] = -np.inf  # the classes of the end token and of rare words
        pick = np.argmax(gain, axis=1)
        more = gain[at, pick] - gain[at, o]
        best[lo : lo + 128] = np.where(more > 1e-6, pick, o)
        gains[lo : lo + 128] = np.where(more > 1e-6, more, 0)
    return best, gains


def context_counts(sides: DataFrame, size: int, classes: np.ndarray) -> DataFrame:
    """block, data, pairs: counts of (unit, class before), of (unit, class after) and of units that follow themselves, a
    unit's block being its number modulo the number of blocks (frequent ones are spread); and the class pairs that begin there. ``sides`` are the ``unit_pairs``.
    """
    shared = sides.sparkSession.sparkContext.broadcast(classes[:size])
    blocks = -(-size // BLOCK)

    def run(batches):
        cls = shared.value.astype(np.int64)
        # Sums of whole numbers, exact in doubles.
        before, after, twice = np.zeros((size, CLASSES)), np.zeros((size, CLASSES)), np.zeros(size)
        for batch in batches:
            for i in range(batch.num_rows):
                u, prev, n = (np.frombuffer(c[i].as_buffer(), k).astype(np.int64) for c, k in zip(batch.columns, (kind_of(size), kind_of(size), "<u4")))
                before += np.bincount(u * CLASSES + cls[prev], n, before.size).reshape(before.shape)
                after += np.bincount(prev * CLASSES + cls[u], n, after.size).reshape(after.shape)
                twice += np.bincount(u[u == prev], n[u == prev], size)
        for block in range(blocks):
            part = np.concatenate([x[block::blocks].ravel() for x in (before, after, twice)])
            at = np.flatnonzero(part)
            if len(at):
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "at": pa.array([at.astype("<u2").tobytes()], pa.binary()), "n": pa.array([zlib.compress(part[at].astype("<i8").tobytes(), 1)], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        cls = shared.value[block::blocks]
        total = np.zeros(len(cls) * (2 * CLASSES + 1), np.int64)
        for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist()):
            total[np.frombuffer(at, "<u2")] += np.frombuffer(zlib.decompress(n), "<i8")
        pairs = np.zeros((CLASSES, CLASSES), np.int64)
        np.add.at(pairs, cls, total[len(cls) * CLASSES : -len(cls)].reshape(-1, CLASSES))
        return pa.table({"block": pa.array([block], pa.int32()), "data": pa.array([total.tobytes()], pa.binary()), "pairs": pa.array([pairs.tobytes()], pa.binary())})

    counts = sides.mapInArrow(run, "block int, at binary, n binary").groupBy("block").applyInArrow(add, "block int, data binary, pairs binary")
    return written(counts, "contexts")


def class_pairs(table: DataFrame) -> np.ndarray:
    """Sum of the class pair counts over the blocks: at most 2**17 / BLOCK and one, of 32 KB each, in one job."""
    total = np.zeros((CLASSES, CLASSES), np.int64)
    for pairs in table.select("pairs").toArrow().column("pairs").to_pylist():
        total += np.frombuffer(pairs, np.int64).reshape(CLASSES, CLASSES)
    return total.astype(np.float64)


def proposals(counts: DataFrame, size: int, classes: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units that gain by a move, their new classes and what each would gain alone, the largest gains first."""
    shared = counts.sparkSession.sparkContext.broadcast((classes[:size], pairs))
    blocks = -(-size // BLOCK)

    def run(batches):
        cls, pairs = shared.value
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                unit = np.arange(size)[block::blocks]
                own = cls[unit].astype(np.int64)
                counts = np.frombuffer(data, np.int64)
                before, after = counts[: -len(own)].reshape(2, len(own), CLASSES)
                new, gain = moves(before, after, counts[-len(own) :], pairs, own)
                pick = np.flatnonzero((gain > 0) & (unit >= FIRST_WORD))
                yield pa.RecordBatch.from_pydict({"unit": pa.array(unit[pick], pa.int64()), "class": pa.array(new[pick], pa.int32()), "gain": pa.array(gain[pick], pa.float64())})

    got = counts.select("block", "data").mapInArrow(run, "unit long, class int, gain double").toArrow()
    unit, new, gain = (got.column(c).to_numpy() for c in ("unit", "class", "gain"))
    order = np.lexsort((unit, -gain))
    return unit[order], new[order], gain[order]


def exchange(sides: DataFrame, size: int, classes: np.ndarray, rounds: int = MOST_ROUNDS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, list, np.ndarray]:
    """Classes after rounds of checked moves, (likelihood, units moved) at the start and after each round, and the class pairs."""
    counts = context_counts(sides, size, classes)
    pairs = class_pairs(counts)
    tokens, history, share = max(1.0, pairs.sum()), [(likelihood(pairs), 0)], 0.5
    chance = np.random.default_rng(len(classes))
    while len(history) <= rounds:
        unit, new, gain = proposals(counts, size, classes, pairs)
        if gain.sum() < tolerance * tokens:
            break
        before = history[-1][0]
        while True:
            # The largest gain alone raises the likelihood surely; many at once may get in each other's way.
            take = np.flatnonzero(chance.random(len(unit)) < share) if share > 1 / len(unit) else np.arange(1)
            trial = classes.copy()
            trial[unit[take]] = new[take]
            counts_ = context_counts(sides, size, trial)
            pairs_ = class_pairs(counts_)
            value = likelihood(pairs_)
            if value > before or share <= 1 / len(unit):
                break
            share /= 4
        if value <= before:
            break
        classes, counts, pairs = trial, counts_, pairs_
        history.append((value, len(take)))
        kept = (value - before) / gain[take].sum()
        share = min(1.0, share * (0.5 if kept < 0.3 else 3 if kept > 0.7 else 1.3))
    return classes, history, pairs


# -- classes of the words that are no units ----------------------------------------------------------
def by_contexts(codes: np.ndarray, n: np.ndarray, word: np.ndarray, size: int, pairs: np.ndarray) -> np.ndarray:
    """The class of each of ``size`` words from its contexts (code: class before * CLASSES + class after), the pairs held still.

    A word's counts are small against the classes', so its gain in a class is the slope of the likelihood there.
    """
    log = np.log(pairs + 0.5)
    rows, cols = np.log(pairs.sum(axis=1) + 0.5 * CLASSES), np.log(pairs.sum(axis=0) + 0.5 * CLASSES)
    b, a = (np.bincount(word * CLASSES + part, n, size * CLASSES).reshape(size, CLASSES) for part in (codes // CLASSES, codes % CLASSES))
    total = b.sum(axis=1)
    gain = b @ log + a @ log.T - total[:, None] * (rows + cols)[None, :]
    gain[:, [0, -1]] = -np.inf
    return np.where(total >= LEAST, np.argmax(gain, axis=1), RARE)


def shifted(ids: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, and the classes before and after each."""
    u = ids.astype(np.int64)
    c = cls[u].astype(np.int64)
    return u, np.concatenate(([0], c[:-1])), np.concatenate((c[1:], [0]))


def place_numbered(sequences: DataFrame, kind: str, units: int, classes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Classes with those of the numbered words from ``units`` on, of which there are at most 2**20, by their contexts."""
    size = len(classes)
    if units >= size:
        return classes
    shared = sequences.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        for ids in streams(batches, kind):
            u, before, after = shifted(ids, shared.value)
            pick = np.flatnonzero(u >= units)
            key, n = np.unique((u[pick] << 12) | (before[pick] * CLASSES + after[pick]), return_counts=True)
            yield pa.RecordBatch.from_pydict({"unit": pa.array(key >> 12, pa.int64()), "code": pa.array(key & 4095, pa.int32()), "n": pa.array(n, pa.int64())})

    def place(batches):
        for batch in batches:
            unit, contexts = batch.column(0).to_numpy(), batch.column(1)
            codes, n = (contexts.flatten().field(i).to_numpy() for i in (0, 1))
            word = np.repeat(np.arange(len(unit)), pc.list_value_length(contexts).to_numpy())
            yield pa.RecordBatch.from_pydict({"unit": unit, "class": pa.array(by_contexts(codes, n, word, len(unit), pairs), pa.int32())})

    got = grouped(sequences.mapInArrow(run, "unit long, code int, n long"), "unit").select("unit", "contexts").mapInArrow(place, "unit long, class int").toArrow()
    out = classes.copy()
    out[got.column("unit").to_numpy()] = got.column("class").to_numpy()
    return out


def grouped(rows: DataFrame, key: str) -> DataFrame:
    """key, c, contexts: a list of at most CLASSES**2 (code, n) for each word; one shuffle, by word."""
    dealt = rows.repartition(key).groupBy(key, "code").agg(F.sum("n").alias("n"))
    return dealt.groupBy(key).agg(F.sum("n").alias("c"), F.collect_list(F.struct("code", "n")).alias("contexts"))


def rare_contexts(table: DataFrame, kind: str, classes: np.ndarray, schema: str, columns) -> DataFrame:
    """A row for each token without a number, made by ``columns`` (batch, words, row number, class before, class after)."""
    shared = table.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                ids = part.column("ids").to_pylist()
                u, before, after = shifted(np.frombuffer(b"".join(ids), kind), shared.value)
                at = np.flatnonzero(u == 1)
                row = np.repeat(np.arange(len(ids)), [len(i) // np.dtype(kind).itemsize for i in ids])[at]
                if len(at):
                    yield columns(part, part.column("rare").flatten(), row, before[at], after[at])

    return table.mapInArrow(run, schema)


def place_rare(table: DataFrame, kind: str, classes: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """word, c, class, contexts of the training words without a number."""

    def columns(part, words, row, before, after):
        return pa.RecordBatch.from_pydict({"word": words, "code": pa.array(before * CLASSES + after, pa.int32()), "n": pa.array(np.ones(len(row), np.int64))})

    def place(batches):
        for batch in batches:
            contexts = batch.column(2)
            codes, n = (contexts.flatten().field(i).to_numpy() for i in (0, 1))
            word = np.repeat(np.arange(batch.num_rows), pc.list_value_length(contexts).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(by_contexts(codes, n, word, batch.num_rows, pairs), pa.int32())], names=["word", "c", "contexts", "class"])

    rows = rare_contexts(table, kind, classes, "word binary, code int, n long", columns)
    kinds = "word binary, c long, contexts array<struct<code: int, n: long>>, class int"
    return written(grouped(rows, "word").select("word", "c", "contexts").mapInArrow(place, kinds), "rare-words")


# -- the model -----------------------------------------------------------------------------------------
@dataclass
class BrownModel:
    tokens: int
    words: int
    numbers: Numbers
    #: By number: counts and classes.
    counts: np.ndarray
    classes: np.ndarray
    #: log10 of all factors of P(w | v) but c(w), by class of v and class of w.
    factor: np.ndarray
    #: word, c, class of the training words without a number.
    rare: DataFrame
    #: ``docs`` as ``numbered`` gives them.
    table: DataFrame
    history: list = field(default_factory=list)

    @property
    def unknown(self) -> float:
        return -np.log10(self.tokens + self.words + 1.0)


def train(docs: DataFrame, rounds: int = MOST_ROUNDS) -> BrownModel:
    """Counts, clusters and estimates over the rows of ``docs`` that are not held out; the others are only numbered."""
    counts = written(count_words(docs.filter(~is_held_out(F.col("doc_id").cast("long")))), "words")
    tokens, words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("word")).first()
    known = counts.filter((F.col("c") * TABLE_SHARE >= tokens) & (F.length("word") > 0)).orderBy(F.desc("c"), "word").toArrow()
    ends = counts.filter(F.length("word") == 0).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    numbers = Numbers(known.column("word").to_pylist())
    of = np.concatenate(([ends, 0], known.column("c").to_numpy().astype(np.int64)))
    units = FIRST_WORD + int((of[FIRST_WORD:] * UNIT_SHARE >= tokens).sum())
    kind = kind_of(numbers.size)
    classes = np.full(numbers.size, RARE, np.uint8)
    classes[FIRST_WORD:units] = 1 + np.arange(units - FIRST_WORD) % (CLASSES - 2)
    classes[0] = 0
    table = numbered(docs, numbers)
    training = table.filter(~F.col("held_out"))
    sequences = training.select("ids")
    classes, history, pairs = exchange(unit_pairs(sequences, kind, units), units, classes, rounds)
    classes = place_numbered(sequences, kind, units, classes, pairs)
    pairs = pair_counts(sequences, kind, classes)
    rare = place_rare(training, kind, classes, pairs)
    # A word without a number counted as the class RARE; it now counts as a token of its own class.
    pairs[:, RARE] = 0
    each = rare.select("class", F.explode("contexts").alias("x")).groupBy(F.floor(F.col("x.code") / CLASSES).alias("v"), "class").agg(F.sum("x.n").alias("n"))
    for v, w, n in each.collect():  # at most CLASSES**2 rows
        pairs[v, w] += n
    size = pairs.sum(axis=0)  # tokens of each class
    total = max(1.0, size.sum())
    step = (pairs + size[None, :] / total) / (pairs.sum(axis=1, keepdims=True) + 1)
    inside = np.divide(step, size[None, :], out=np.zeros_like(step), where=size[None, :] > 0)
    with np.errstate(divide="ignore"):
        factor = np.log10((1 - 1 / (tokens + words + 1.0)) * (MIX * inside + (1 - MIX) / total))
    return BrownModel(tokens, words, numbers, of, classes, factor, rare.select("word", "c", "class"), table, history)


def pair_counts(sequences: DataFrame, kind: str, classes: np.ndarray) -> np.ndarray:
    """Counts of class pairs over all of ``sequences``."""
    shared = sequences.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for ids in streams(batches, kind):
            c = shared.value[ids].astype(np.int64)
            total += np.bincount(np.concatenate(([0], c[:-1])) * CLASSES + c, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"code": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    out = np.zeros(CLASSES * CLASSES)
    for code, n in sequences.mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n")).collect():  # at most CLASSES**2 rows
        out[code] = n
    return out.reshape(CLASSES, CLASSES)


def score(model: BrownModel) -> DataFrame:
    """The contract's columns, and perplexity, for every row of the model's table.

    A task adds up what a document's numbered words contribute. The other words meet their counts in a join by word; one
    sum for each document ends it.
    """
    table, kind, floor, base_floor = model.table, kind_of(model.numbers.size), float(model.unknown), float(model.unknown)
    shared = table.sparkSession.sparkContext.broadcast((model.counts, model.classes, model.factor))

    def local(batches):
        counts, classes, factor = shared.value
        with np.errstate(divide="ignore"):
            log, more = np.log10(counts.astype(np.float64)), np.log10(counts + 1.0) + base_floor
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                ids = part.column(3).to_pylist()
                size = np.array([len(i) // np.dtype(kind).itemsize for i in ids], np.int64)
                u = np.frombuffer(b"".join(ids), kind)
                cls = classes[u]
                have = counts[u] > 0
                s = np.where(have, log[u] + factor[np.concatenate(([0], cls[:-1])), cls], np.where(u == 0, floor, 0.0))
                b = np.where(have, more[u], np.where(u == 0, base_floor, 0.0))
                first = np.cumsum(size) - size
                s, b, k = (np.add.reduceat(x, first) if len(first) else x for x in (s, b, have.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(size), pa.array(k), pa.array(b), pa.array(s)], names=["rid", "doc_id", "held_out", "n_tokens", "k", "b", "s"])

    def columns(part, words, row, before, after):
        return pa.RecordBatch.from_pydict({"word": words, "rid": part.column("rid").take(pa.array(row)), "v": pa.array(before, pa.int32())})

    own = table.select("rid", "doc_id", "held_out", "ids").mapInArrow(local, "rid long, doc_id long, held_out boolean, n_tokens long, k long, b double, s double")
    rare = rare_contexts(table.select("rid", "ids", "rare"), kind, model.classes, "word binary, rid long, v int", columns).join(model.rare, "word", "left")
    known = F.col("c").isNotNull()
    factor = F.element_at(F.lit(model.factor.ravel()), (F.col("v") * CLASSES + F.col("class") + 1).cast("int"))
    each = rare.select("rid", F.when(known, F.log10("c") + factor).otherwise(floor).alias("s"), F.when(known, F.log10(F.col("c") + 1) + base_floor).otherwise(base_floor).alias("b"), known.cast("long").alias("k"))
    sums = each.groupBy("rid").agg(*[F.sum(c).alias(f"r{c}") for c in "sbk"])
    whole = own.join(sums.hint("shuffle_hash"), "rid", "left")
    both = lambda c: F.col(c) + F.coalesce(f"r{c}", F.lit(0))
    out = whole.select("doc_id", "held_out", "n_tokens", both("k").alias("n_known"), F.lit(int(model.tokens)).cast("long").alias("train_tokens"), both("b").alias("base_score"), both("s").alias("score"))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op1_brown_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: log10 probabilities of every document of ``documents``."""
    return score(train(spark.read.parquet(f"{sf_dir}/documents.parquet")))
