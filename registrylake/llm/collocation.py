"""Phrase collocations by position bitmaps: shift, AND and popcount, depth first, in shards of text.

A shard is some megabytes of one language's texts. Its words are numbered by position; a piece's end takes a
position that no word has, so that no phrase crosses it. Each word of a shard has a bitmap of its positions, stored as gaps in
variable-length bytes. In a task a bitmap is a list of positions or, from one in ``DENSE`` positions on, a bit set (so a shard
has at most ``DENSE`` of these). The bitmap of where a phrase ends, shifted by one and ANDed with a word's, is that of the
longer phrase's ends, and its popcount the phrase's occurrences in the shard. Lists are ANDed with all words at once by
looking up which word holds each shifted position.

Counts are summed over shards in three rounds, each of which cuts what the next one tries: words, pairs of frequent words,
and, depth first from each frequent pair, longer phrases all of whose pairs are frequent. Shards are told what is frequent where it
was counted; nothing is broadcast, and a frequent word is one row in each shard. The shards' bitmaps are tables, so that no text is read twice.

Nulls, empties, ties and repeats: a null text is empty and has no pieces; a null lang is ``und`` and counts with documents that say so;
repeated rows count each; cuts of one score go to the shorter first part, phrases of one score and count by their bytes; an
empty table gives no rows; a very long text is cut into several shards at ends of pieces. Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registrylake.llm.common import read_table, written
from registrylake.llm.encode import row_chunks

MOST_WORDS, LEAST, TOP, COVER, SHARD_BYTES, OPEN_SHARDS, DENSE = 5, 100, 2000, 100, 8 << 20, 4, 32
#: So many occurrences of a word are the work of one task where pairs are counted.
SHARE, TASK_WORDS, PER_TASK = 100_000_000, 4_000_000, 8
#: A byte that UTF-8 never uses stands for the end of a piece.
END = b"\xff"
TOKEN_BYTES = bytes(END[0] if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c for c in range(256)).lower()
WORDS = "lang string, shard long, uid long, word string, n long, places binary"
PAIRS = "shard long, p int, a array<long>, b array<long>, n array<long>"


def packed(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**35 as bytes of seven bits, the last of a number below 128; and where each begins."""
    length = 1 + sum((gaps >= 1 << 7 * j).astype(np.int64) for j in range(1, 5))
    ends = np.cumsum(length)
    starts, out = ends - length, np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    for j in range(5):
        on = length > j
        out[starts[on] + j] = (gaps[on] >> 7 * j & 127) | np.where(length[on] > j + 1, 128, 0)
    return out, np.append(starts, len(out))


def unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.append(0, ends + 1)[:-1]
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * place, starts) if len(ends) else np.zeros(0, np.int64)


def cuts(text: bytes, size: int):
    """A text in parts of about ``size`` bytes that end where a piece ends."""
    start = 0
    while len(text) - start > size and (at := text.find(END, start + size)) >= 0:
        yield text[start:at]
        start = at + 1
    yield text[start:]


def word_bitmaps(lang: str, shard: int, uid: int, texts: list) -> pa.RecordBatch | None:
    """The rows of a shard: each word with a number of its own (from ``uid`` on), how often it occurs, and the gaps of its positions."""
    tokens = END.join(texts).replace(END, b" " + END + b" ").split()
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    code, words = coded.indices.to_numpy(), coded.dictionary
    counts = np.bincount(code, minlength=len(words))
    place = np.argsort(code, kind="stable")
    first = np.cumsum(counts) - counts
    gaps = np.diff(place, prepend=0)
    gaps[first] = place[first]
    data, starts = packed(gaps)
    at = np.append(starts[first], len(data)).astype(np.int64)
    places = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(at), pa.py_buffer(data)]).cast(pa.binary())
    real = pa.array([w != END for w in words.to_pylist()], pa.bool_())
    rows = pa.RecordBatch.from_pydict({"word": words.filter(real).cast(pa.string()), "n": pa.array(counts).filter(real), "places": places.filter(real)})
    if not rows.num_rows:
        return None
    same = {"lang": pa.array([lang] * rows.num_rows), "shard": pa.array(np.full(rows.num_rows, shard)), "uid": pa.array(np.arange(uid, uid + rows.num_rows))}
    return pa.RecordBatch.from_pydict({**same, **dict(zip(rows.schema.names, rows.columns))})


def sharded(docs: DataFrame, size: int = SHARD_BYTES) -> DataFrame:
    """The word bitmaps of all shards, written. A task fills one shard a language, and closes the fullest when several are open."""

    def run(batches):
        task, made, uid, held = TaskContext.get().partitionId(), 0, 0, defaultdict(list)
        full: dict = defaultdict(int)

        def closed(lang):
            nonlocal made, uid
            made += 1
            full.pop(lang)
            rows = word_bitmaps(lang, task << 32 | made, task << 36 | uid, held.pop(lang))
            uid += rows.num_rows if rows else 0
            return rows

        for part in (p for batch in batches for p in row_chunks(batch, 1)):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for cut in cuts((text or "").encode("utf-8", "surrogatepass").translate(TOKEN_BYTES), size):
                    held[lang].append(cut)
                    full[lang] += len(cut) + 1
                    fullest = max(full, key=full.get) if sum(full.values()) >= OPEN_SHARDS * size else lang
                    if (full[lang] >= size or fullest != lang) and (rows := closed(fullest)):
                        yield rows
        for lang in list(held):
            if rows := closed(lang):
                yield rows

    plain = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return written(plain.mapInArrow(run, WORDS), "word-bitmaps")


class Shard:
    """The bitmaps of a shard's frequent words, which have the numbers 0 to ``size``. ``told`` says which of its rows these are (uid, w, f)."""

    def __init__(self, rows: pa.Table, told: pa.Table):
        told = told.sort_by("uid").combine_chunks()
        uid = rows.column("uid").to_numpy()
        at = np.minimum(np.searchsorted(told.column("uid").to_numpy(), uid), len(told) - 1)
        known = told.column("uid").to_numpy()[at] == uid
        rows = rows.filter(pa.array(known)).combine_chunks()
        self.ids, self.f = told.column("w").to_numpy()[at[known]], told.column("f").to_numpy()[at[known]]
        self.size = len(self.ids)
        counts = rows.column("n").to_numpy()
        places = pa.concat_arrays(rows.column("places").chunks).cast(pa.large_binary())
        at = np.frombuffer(places.buffers()[1], np.int64)[places.offset : places.offset + len(places) + 1]
        gaps = unpacked(np.frombuffer(places.buffers()[2], np.uint8)[at[0] : at[-1]])
        first = np.cumsum(counts) - counts
        running = np.cumsum(gaps)
        place = running - np.repeat(running[first] - gaps[first], counts)
        self.span = int(place.max()) + 1
        self.word_at = np.full(self.span + 1, -1, np.int64)
        self.word_at[place] = np.repeat(np.arange(self.size), counts)
        wide = self.dense(counts)
        self.sets = {int(w): self.bits(place[first[w] : first[w] + counts[w]]) for w in np.flatnonzero(wide)}
        listed = ~np.repeat(wide, counts)
        self.listed, self.listed_word = place[listed], self.word_at[place[listed]]

    def dense(self, n):
        return n * DENSE >= self.span

    def bits(self, places: np.ndarray) -> np.ndarray:
        on = np.zeros(-(-(self.span + 1) // 64) * 64, np.uint8)
        on[places] = 1
        return np.packbits(on, bitorder="little").view(np.uint64)

    def places(self, bits: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))

    def after(self, ends: np.ndarray):
        """For a phrase with the bit set ``ends``: (words, popcounts, places of the words one after another) of the phrases that are one word longer."""
        shifted = ends << np.uint64(1) | np.concatenate([np.zeros(1, np.uint64), ends[:-1] >> np.uint64(63)])
        for w, bits in self.sets.items():
            both = shifted & bits
            if n := int(np.bitwise_count(both).sum()):
                yield np.array([w]), np.array([n]), self.places(both)
        on = shifted[self.listed >> 6] >> (self.listed & 63).astype(np.uint64) & np.uint64(1) == 1
        words, counts = np.unique(self.listed_word[on], return_counts=True)
        yield words, counts, self.listed[on]  # the lists stand in order of their words

    def followed(self, phrase: np.ndarray, ends: np.ndarray) -> tuple:
        """For lists, told apart by the number of their phrase: (phrase, next word, its place) wherever a word follows."""
        word = self.word_at[ends + 1]
        on = word >= 0
        return phrase[on], word[on], ends[on] + 1


def pairs_of(rows: pa.Table, told: pa.Table, buckets: int, share: int = SHARE) -> pa.Table:
    """All pairs of the shard's frequent words that stand side by side, with their occurrences, dealt to buckets by their first word.

    A word that is met more than ``share`` times in all shards has its second words dealt to so many more buckets.
    """
    if not told.num_rows:
        none = np.zeros(0, np.int64)
        return dealt(none, {"a": none, "b": none, "n": none}, {"shard": 0})
    shard = Shard(rows, told)
    a, b, _ = shard.followed(shard.listed_word, shard.listed)
    key, n = np.unique(a * shard.size + b, return_counts=True)
    keys, counts = [key], [n]
    for w, bits in shard.sets.items():
        for v, n, _ in shard.after(bits):
            keys.append(w * shard.size + v)
            counts.append(n)
    key, n = np.concatenate(keys), np.concatenate(counts)
    a, b = key // shard.size, shard.ids[key % shard.size]
    of = b % (1 + shard.f // share)[a]
    a = shard.ids[a]
    return dealt(mixed(a, of) % buckets, {"a": a, "b": b, "n": n}, {"shard": rows.column("shard")[0].as_py()})


def mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Numbers, not negative, that spread pairs of numbers."""
    h = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + y.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (h >> np.uint64(33)).astype(np.int64)


def dealt(bucket: np.ndarray, columns: dict, same: dict | None = None) -> pa.Table:
    """One row a bucket with the columns' values as arrays, in their order: what goes to one task is packed, and like values stand side by side."""
    order = np.lexsort((*reversed(columns.values()), bucket))
    bucket = bucket[order]
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    at = pa.array(np.append(first, len(bucket)), pa.int32())
    held = {c: pa.array(np.full(len(first), v, np.int64)) for c, v in (same or {}).items()} | {"p": pa.array(bucket[first], pa.int32())}
    return pa.table(held | {c: pa.ListArray.from_arrays(at, pa.array(v[order], pa.int64())) for c, v in columns.items()})


class _Found:
    """Phrases by their number of words, as rows of words beside their occurrences."""

    def __init__(self):
        self.words, self.n = defaultdict(list), defaultdict(list)

    def add(self, words: np.ndarray, n: np.ndarray) -> None:
        self.words[words.shape[1]].append(words)
        self.n[words.shape[1]].append(n)

    def table(self, ids: np.ndarray, most: int, buckets: int) -> pa.Table:
        """The phrases as columns w1 to w``most``, -1 where a phrase is shorter, dealt to buckets by their first pair."""
        every = [np.pad(w, ((0, 0), (0, most - k)), constant_values=-1) for k in sorted(self.words) for w in self.words[k]]
        words = np.concatenate(every) if every else np.zeros((0, most), np.int64)
        words = np.where(words < 0, -1, ids[words]) if len(words) else words
        n = np.concatenate([x for k in sorted(self.n) for x in self.n[k]]) if every else np.zeros(0, np.int64)
        return dealt(mixed(words[:, 0], words[:, 1]) % buckets, {f"w{i + 1}": words[:, i] for i in range(most)} | {"n": n})


def longer_of(rows: pa.Table, told: pa.Table, most: int, buckets: int) -> pa.Table:
    """The phrases of 3 to ``most`` words whose pairs are all frequent, with their occurrences in the shard; ``told`` has its frequent words and pairs.

    Bit sets are extended depth first, one phrase at a time. What comes out as a list waits until they are done: the lists of one
    length are extended together, since each alone is short.
    """
    found = _Found()
    words, pairs = told.filter(pc.is_valid(told.column("uid"))), told.filter(pc.is_valid(told.column("a")))
    if not pairs.num_rows:
        return found.table(np.zeros(0, np.int64), most, buckets)
    shard = Shard(rows, words)
    order = np.argsort(shard.ids)
    number = lambda name: order[np.searchsorted(shard.ids, pairs.column(name).to_numpy(), sorter=order)]
    allowed = np.unique(number("a") * shard.size + number("b"))
    #: By number of words: (phrases, the phrase of each place, places).
    lists = defaultdict(list)
    lists[1].append((np.arange(shard.size)[:, None], shard.listed_word, shard.listed))

    def may(last, word):
        key = last * shard.size + word
        return allowed[np.minimum(np.searchsorted(allowed, key), len(allowed) - 1)] == key

    def deeper(phrase: list, ends: np.ndarray) -> None:
        for words, counts, places in shard.after(ends):
            keep = may(phrase[-1], words)
            places, words, counts = places[np.repeat(keep, counts)], words[keep], counts[keep]
            longer = np.column_stack([np.tile(np.array(phrase), (len(words), 1)), words])
            if len(phrase) > 1:
                found.add(longer, counts)
            if len(phrase) + 1 < most:
                if len(words) == 1 and shard.dense(counts[0]):
                    deeper(longer[0].tolist(), shard.bits(places))
                elif len(words):
                    lists[len(phrase) + 1].append((longer, np.repeat(np.arange(len(words)), counts), places))

    for w, bits in shard.sets.items():
        deeper([w], bits)
    for k in range(1, most):
        if not lists[k]:
            continue
        base = np.cumsum([0] + [len(p) for p, _, _ in lists[k]])
        phrases = np.concatenate([p for p, _, _ in lists[k]])
        phrase, word, place = shard.followed(np.concatenate([of + b for (_, of, _), b in zip(lists[k], base)]), np.concatenate([x for _, _, x in lists[k]]))
        on = may(phrases[phrase, -1], word)
        key, of, n = np.unique(phrase[on] * shard.size + word[on], return_inverse=True, return_counts=True)
        longer = np.column_stack([phrases[key // shard.size], key % shard.size])
        if k > 1:
            found.add(longer, n)
        lists[k + 1].append((longer, of, place[on]))
    return found.table(shard.ids, most, buckets)


def frequent(counts: DataFrame, keys: list, least: int) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def phrase_counts(docs: DataFrame, most: int, least: int, size: int = SHARD_BYTES, share: int = SHARE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ids, n) of all phrases of 1 to ``most`` words that occur ``least`` times; (lang, word, w) of their words; (lang, n) of all words.

    A frequent word of a language has one number ``w``, so that phrases are rows of numbers until their texts are asked for.
    """
    bitmaps = sharded(docs, size)
    totals = written(bitmaps.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    # The rows of a word, one for each shard, are counted and told so where they meet; its number is the least of theirs.
    word = W.partitionBy("lang", "word")
    each = bitmaps.select("lang", "shard", "uid", "word", F.min("uid").over(word).alias("w"), F.sum("n").over(word).alias("f")).filter(F.col("f") >= least)
    known = written(each, "frequent-words")
    sole = known.filter(F.col("uid") == F.col("w"))
    told, named = sole.select(F.array("w").alias("ids"), F.col("f").alias("n")), sole.select("lang", "word", "w")
    if most < 2:
        return told, named, totals
    # A task's share of pairs and phrases comes in a few buckets, so that buckets of unlike size even out. The session's shuffle partitions,
    # which AQE puts together by size, are enough until the words ask for more.
    least_tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least_tasks, (totals.agg(F.sum("n")).first()[0] or 0) // TASK_WORDS)
    buckets = PER_TASK * tasks
    by_bucket = lambda rows: rows.repartition(tasks, "p") if tasks > least_tasks else rows.repartition("p")
    none = F.lit(None).cast("long")
    of_shard = known.select("shard", "uid", "w", "f", none.alias("a"), none.alias("b"))
    places = bitmaps.select("shard", "uid", "n", "places").groupBy("shard")
    local = by_bucket(places.cogroup(of_shard.groupBy("shard")).applyInArrow(lambda rows, some: pairs_of(rows, some, buckets, share), PAIRS))
    # One exchange: pairs stay in their bucket while they are counted and while they are told to their shards.
    each = local.select("shard", "p", F.inline(F.arrays_zip("a", "b", "n")))
    each = each.withColumn("n", F.sum("n").over(W.partitionBy("p", "a", "b"))).filter(F.col("n") >= least)
    tried = written(each.select("shard", "a", "b", "n"), "frequent-pairs")
    pairs = tried.groupBy("a", "b").agg(F.max("n").alias("n"))
    told = told.unionByName(pairs.select(F.array("a", "b").alias("ids"), "n"))
    if most > 2:
        ws = [f"w{i + 1}" for i in range(most)]
        both = of_shard.unionByName(tried.select("shard", none.alias("uid"), none.alias("w"), none.alias("f"), "a", "b"))
        longer = places.cogroup(both.groupBy("shard")).applyInArrow(lambda rows, some: longer_of(rows, some, most, buckets), f"p int, {', '.join(f'{w} array<long>' for w in ws)}, n array<long>")
        longer = by_bucket(longer).select("p", F.inline(F.arrays_zip(*ws, "n")))
        told = told.unionByName(frequent(longer, ["p", *ws], least).select(F.filter(F.array(*ws), lambda w: w >= 0).alias("ids"), "n"))
    return written(told, "phrases"), named, totals


def collocations(docs: DataFrame, most: int = MOST_WORDS, least: int = LEAST, top: int = TOP, cover: int = COVER, size: int = SHARD_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases by the score of their lowest-scoring cut.

    A phrase is left out if a longer one holds it and has at least ``cover`` per cent of its occurrences. Looking at phrases that
    are one word longer is enough: what lies between the two is at least as frequent as the longer one.
    """
    told, words, totals = phrase_counts(docs, most, least, size)
    told = told.withColumn("k", F.size("ids"))
    cand = told.filter(F.col("k") >= 2).withColumnRenamed("n", "a")
    around = told.filter(F.col("k") >= 3).select(F.explode(F.array(F.slice("ids", F.lit(1), F.col("k") - 1), F.slice("ids", F.lit(2), F.col("k") - 1))).alias("ids"), "n")
    around = around.groupBy("ids").agg(F.max("n").alias("longer"))
    free = cand.join(around, "ids", "left").filter(F.coalesce(100 * F.col("longer") < cover * F.col("a"), F.lit(True))).drop("longer")
    free = free.join(words.select(F.col("w").alias("__rl_w"), "lang"), F.get("ids", F.lit(0)) == F.col("__rl_w")).drop("__rl_w").join(totals, "lang")
    each = free.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    each = each.withColumns({"left": F.slice("ids", F.lit(1), F.col("cut")), "right": F.slice("ids", F.col("cut") + 1, F.col("k") - F.col("cut"))})
    part = lambda side, name: told.select(F.col("ids").alias(side), F.col("n").alias(name))
    each = each.join(part("left", "l"), "left").join(part("right", "r"), "right")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    exact = each.withColumns({"__rl_up": (F.lit(1000) * F.col("a")).cast("decimal(19,0)") * wide("n"), "__rl_down": wide("l") * wide("r")})
    score = F.expr("CAST(__rl_up div __rl_down AS BIGINT)")
    best = exact.withColumn("score", score).groupBy("lang", "ids", "a", "n").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("c"))
    spelt = best.select("*", F.posexplode("ids").alias("at", "w")).join(words.select("w", "word"), "w")
    spelt = spelt.groupBy("ids").agg(F.any_value(F.struct("lang", "a", "c.l", "c.r", "n", "c.score")).alias("r"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("at"))
    flat = spelt.select("r.*", F.array_join(F.transform("at", lambda x: x["word"]), " ").alias("phrase"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return flat.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the collocations of all ``documents``, by language."""
    return collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents WHERE text IS NOT NULL
), worded AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM piece),
total AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM worded),
runs AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM placed, range(1, 6) t(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM runs GROUP BY lang, k, phrase HAVING count(*) >= 100),
cand AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, x.cut, l.a AS l, r.a AS r, t.n, 1000 * c.a * t.n // (l.a * r.a) AS score
  FROM cand c, range(1, 5) x(cut), f l, f r, total t
  WHERE x.cut < c.k AND l.lang = c.lang AND r.lang = c.lang AND t.lang = c.lang
    AND l.phrase = array_to_string(c.ws[1:x.cut], ' ') AND r.phrase = array_to_string(c.ws[x.cut + 1:c.k], ' ')
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM cuts
), held AS (
  SELECT DISTINCT c.lang, array_to_string(c.ws[s.s:s.s + m.m - 1], ' ') AS phrase, c.a
  FROM cand c, range(2, 5) m(m), range(1, 5) s(s) WHERE m.m < c.k AND s.s + m.m - 1 <= c.k
), free AS (
  SELECT * FROM best b WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM held h WHERE h.lang = b.lang AND h.phrase = b.phrase AND 100 * h.a >= 100 * b.a)
)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
         a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
  FROM free
) WHERE rank <= 2000
"""
