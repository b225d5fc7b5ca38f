"""Suffix-array dedup: which bytes lie in a string of ``LENGTH`` bytes that also starts earlier.

Equal strings are brought together by *anchors*: the least of the hashes of the ``GRAM``-byte strings inside
each window of ``LENGTH`` bytes depends on the window's bytes alone. Neighbouring windows with the same
anchor make a segment, whose context is the bytes that its windows cover. Anchors that occur once are
dropped; segments with equal contexts keep the earliest (the windows of the others all start earlier
there), with no more than sums and minima per group; and the different contexts of an anchor go to a
shard. There contexts lose the windows that cannot be equal to others, since no other context of their anchor has a
string that the windows around them have in common (``shared_windows``), and an external induced suffix sort (``esais``) with common-prefix values tells which windows
are equal. The sort streams: a shard's bytes, the places of its contexts and all orders are in files of the task, and the
sorted suffixes are settled chunk by chunk; queues spill and names recurse at the default sizes already. An anchor with more
bytes of contexts than ``hot_bytes`` is spread over the shards by its windows, so that no shard grows with it; the same sort settles
them. Earliest is by (doc_id, start).

Contexts of one anchor count as equal if their 64-bit digests agree: two different ones among n do by chance in one of
2**65 / n**2 cases.

Nulls, empties, ties and repeats: a null text is empty and loses nothing; a null doc_id comes before all
others; rows that share a doc_id come in order of a digest of their text, and rows that also share
the text are one document (each such row gets its result); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm.common import drop_path, written, written_at
from registrylake.llm.encode import in_chunks, row_chunks
from registrylake.llm.esais import Folder, Stream, SuffixSorter

LENGTH, GRAM = 100, 32
SHARD_BYTES, HOT_BYTES, FILTER_BITS = 8 << 20, 64 << 20, 1 << 28
BUDGET, BASE = 1 << 20, 1 << 19
#: Windows that may be equal are told by strings they have in common; so many a context, counted in so many places.
SLOTS, COUNTERS = 8, 1 << 23
PLACE = np.dtype([("doc", "<i8"), ("t", "<i8"), ("start", "<i4"), ("size", "<i4"), ("null", "?")])
SEGMENT = "doc_id long, t long, start int, n int, h long, c long, g int, ctx binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
_ODD = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            out = np.full(n + n // 4, np.uint64(base))
            out[0] = 1
            _POWERS[i] = np.multiply.accumulate(out)
    return _POWERS


def _slide(values: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) of each ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        values = take(values[:-have], values[have:])
        have *= 2
    return take(values[: len(values) - (width - have)], values[width - have :])


def segments(data: np.ndarray, sizes: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Of documents lying end to end in ``data``: document, start, windows, anchor, context digest; and the hashes of all strings of ``gram`` bytes."""
    n, width = len(data), length - gram + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 6
    up, down = _powers(n + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[:n])))
    h = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    least = _slide(h, width, np.minimum)
    doc = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    ends = np.cumsum(sizes)
    ok = np.arange(len(least)) + length <= ends[doc]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | ~ok[:-1]
    start = np.flatnonzero(new & ok)
    if not len(start):
        return (np.zeros(0, np.int64),) * 6
    fine = np.concatenate(([0], np.cumsum(ok)))
    upto = np.append(start[1:], len(least))
    count = fine[upto] - fine[start]
    anchor = least[start]
    digest = (sums[start + count - 1 + length] - sums[start]) * down[start]
    digest ^= digest >> np.uint64(32)
    digest = digest * np.uint64(0xC2B2AE3D27D4EB4F) + count.astype(np.uint64)
    begin = ends - sizes
    return doc[start], start - begin[doc[start]], count, anchor.view(np.int64), digest.view(np.int64), h


def stand_twice(h: np.ndarray, at: np.ndarray, n: np.ndarray, anchor: np.ndarray, width: int) -> np.ndarray:
    """Whether the anchors of segments that begin ``at`` stand there more than once: such a segment may repeat a window within itself."""
    if not len(at):
        return np.zeros(0, bool)
    least, anchor = np.zeros(len(h) + width - 1, np.uint64), anchor.view(np.uint64)
    # Places whose hash is an anchor: the greatest least value of the windows that hold them.
    least[np.repeat(at + width - 1 - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] = np.repeat(anchor, n)
    place = np.flatnonzero(h == _slide(least, width, np.maximum)[: len(h)])
    lo = np.searchsorted(place, at)
    many = np.searchsorted(place, at + n + width - 1) - lo
    of = np.repeat(np.arange(len(at)), many)
    k = np.arange(len(of)) - np.repeat(np.cumsum(many) - many - lo, many)
    return np.bincount(of, h[place[k]] == anchor[of], len(at)) > 1


def places_of(h: np.ndarray, at: np.ndarray, n: np.ndarray, anchor: np.ndarray, width: int) -> np.ndarray:
    """Where in their segments the anchors stand; -1 if more than once."""
    many, out, anchor = n + width - 1, np.full(len(at), -1, np.int64), anchor.view(np.uint64)
    for lo in range(0, len(at), 4096):
        part = many[lo : lo + 4096]
        of = np.repeat(np.arange(lo, lo + len(part)), part)
        k = np.arange(len(of)) - np.repeat(np.cumsum(part) - part, part)
        hit = np.flatnonzero(h[at[of] + k] == anchor[of])
        out[of[hit]] = k[hit]
        again = of[hit]
        out[again[1:][again[1:] == again[:-1]]] = -1
    return out


def _texts(batch):
    """(doc_ids, digests, data, sizes) of a batch's rows, some megabytes at a time."""
    texts = pc.fill_null(batch.column(2), "")
    at = 0
    for part in in_chunks(texts, 4096, 1 << 20):
        rows = slice(at, at + len(part))
        at += len(part)
        binary = part.cast(pa.binary())
        sizes = pc.binary_length(binary).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"".join(binary.to_pylist()), np.uint8)
        yield batch.column(0).slice(rows.start, len(part)), batch.column(1).slice(rows.start, len(part)), data, sizes


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))


def _order(prefix: str = "") -> object:
    """(doc_id, digest, start) as one number, so that its least can be found by partial sums."""
    two = F.lit("4611686018427387904").cast("decimal(38,0)")
    doc = F.coalesce(F.col(f"{prefix}doc_id"), F.lit(-(1 << 63))).cast("decimal(20,0)")
    low = F.shiftright(F.col(f"{prefix}t"), 33).bitwiseAND(F.lit((1 << 31) - 1)) * F.lit(1 << 31) + F.col("start").cast("long")
    return (doc * two + low.cast("decimal(20,0)")).cast("decimal(38,0)")


class Filter:
    """Bits of the anchors that occur more than once, and of those with different contexts."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.words = [np.zeros(max(1, bits >> 6), np.uint64) for _ in range(2)]

    def places(self, h: np.ndarray) -> np.ndarray:
        return (h.view(np.uint64) * np.uint64(_ODD)) >> self.shift

    def holds(self, which: int, h: np.ndarray) -> np.ndarray:
        p = self.places(h)
        return (self.words[which][(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) != 0


def filter_of(groups: DataFrame, most_bits: int = FILTER_BITS) -> Filter:
    """Built by the executors; its size is at most ``most_bits``, beyond which it lets more rows pass to the exact join."""
    count = groups.count()
    bits = min(most_bits, 1 << max(10, (16 * count).bit_length()))
    out = Filter(bits)

    def mark(batches):
        for batch in batches:
            h = batch.column(0).to_numpy()
            mixed = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for which, part in enumerate((h, h[mixed])):
                p = np.sort(out.places(part))
                if len(p):
                    word = (p >> np.uint64(6)).astype(np.int64)
                    cuts = np.flatnonzero(np.diff(word, prepend=-1))
                    value = np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), cuts)
                    yield pa.RecordBatch.from_pydict({"which": pa.array([which] * len(cuts), pa.int32()), "word": word[cuts], "value": value.view(np.int64)})

    words = groups.select("h", "mixed").mapInArrow(mark, "which int, word long, value long").groupBy("which", "word").agg(F.bit_or("value").alias("value")).toArrow()
    which, word, value = (words.column(c).to_numpy() for c in ("which", "word", "value"))
    for i in range(2):
        out.words[i][word[which == i]] = value[which == i].view(np.uint64)
    return out


def anchor_groups(keyed: DataFrame, length: int, gram: int) -> tuple[DataFrame, str]:
    """h, mixed of the anchors that occur more than once, or repeat within a segment; and the table's path."""

    def run(batches):
        for batch in batches:
            for _, _, data, sizes in _texts(batch):
                doc, start, n, h, c, hashes = segments(data, sizes, length, gram)
                twice = stand_twice(hashes, (np.cumsum(sizes) - sizes)[doc] + start, n, h, length - gram + 1)
                yield pa.RecordBatch.from_pydict({"h": pa.array(h, pa.int64()), "c": pa.array(c, pa.int64()), "w": pa.array(1 + twice.astype(np.int64), pa.int64())})

    rows = keyed.mapInArrow(run, "h long, c long, w long").groupBy("h").agg(F.sum("w").alias("w"), F.max("w").alias("most"), F.min("c").alias("c1"), F.max("c").alias("c2"))
    return written_at(rows.filter("w > 1").select("h", ((F.col("c1") != F.col("c2")) | (F.col("most") > 1)).alias("mixed")), "anchors")


def candidates(keyed: DataFrame, groups: DataFrame, length: int, gram: int) -> DataFrame:
    """The segments of ``groups``; those of mixed anchors with their bytes and the anchor's place (``g``) in them."""
    shared = keyed.sparkSession.sparkContext.broadcast(filter_of(groups))

    def run(batches):
        seen = shared.value
        for batch in batches:
            for doc_id, t, data, sizes in _texts(batch):
                doc, start, n, h, c, hashes = segments(data, sizes, length, gram)
                keep = np.flatnonzero(seen.holds(0, h)) if len(h) else np.zeros(0, np.int64)
                if not len(keep):
                    continue
                doc, start, n, h, c = (x[keep] for x in (doc, start, n, h, c))
                begin = (np.cumsum(sizes) - sizes)[doc] + start
                raw, mixed = data.tobytes(), seen.holds(1, h)
                ctx = [raw[b : b + k + length - 1] if m else None for b, k, m in zip(begin.tolist(), n.tolist(), mixed.tolist())]
                g = np.zeros(len(doc), np.int64)
                g[mixed] = places_of(hashes, begin[mixed], n[mixed], h[mixed], length - gram + 1)
                rows = pa.array(doc)
                yield pa.RecordBatch.from_pydict({"doc_id": doc_id.take(rows), "t": t.take(rows), "start": pa.array(start, pa.int32()), "n": pa.array(n, pa.int32()), "h": pa.array(h, pa.int64()), "c": pa.array(c, pa.int64()), "g": pa.array(g, pa.int32()), "ctx": pa.array(ctx, pa.binary())})

    return written(keyed.mapInArrow(run, SEGMENT).join(groups, "h").withColumn("ctx", F.when(F.col("mixed"), F.col("ctx"))), "segments")


def shared_windows(batches, path: str, length: int, width: int):
    """Of a shard's contexts (doc_id, t, start, ctx, s, g) those stretches whose windows may be equal to others of the shard, as (doc_id, t, start, ctx).

    Equal windows have their anchor, if it stands once in either context, at one place; windows with the anchor at neighbouring places
    (a slot) have a string in common that is little shorter than they are. Where no other context of the anchor ``s`` has that string, no
    window of the slot is equal to another one. Strings are told apart by digests in a fixed number of counters, so that a full shard keeps more, never less.
    Contexts wait in a file. An anchor that stands twice in a context (``g`` below 0) keeps all of its contexts whole.
    """
    edges = np.arange(SLOTS + 1) * width // SLOTS
    lo, hi = edges[:-1][::-1], edges[1:][::-1] - 1  # places of the anchor, from the first windows of a context to its last
    times, whole = np.zeros(COUNTERS, np.uint8), np.zeros(COUNTERS >> 3, bool)
    shift = np.uint64(64 - (COUNTERS.bit_length() - 1))
    counter = lambda key: ((key ^ key >> np.uint64(29)) * np.uint64(_ODD) >> shift).astype(np.int64)
    anchors = lambda batch: batch.column(4).to_numpy().view(np.uint64)

    def ranges(batch):
        """First and last window of each context in each slot, none if the first comes behind the last."""
        sizes, g = pc.binary_length(batch.column(3)).to_numpy().astype(np.int64), batch.column(5).to_numpy().astype(np.int64)
        n = sizes - length + 1
        first, last = np.maximum(g[:, None] - hi, 0), np.minimum(g[:, None] - lo, n[:, None] - 1)
        return sizes, n, g, first, last, (first <= last) & (g >= 0)[:, None]

    def counters(batch):
        sizes, _, g, _, _, there = ranges(batch)
        sizes = np.where(g < 0, 0, sizes)  # these alone may be long
        data = np.frombuffer(b"".join(b for b, k in zip(batch.column(3).to_pylist(), sizes.tolist()) if k), np.uint8)
        up, down = _powers(len(data) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)])))
        row, slot = np.nonzero(there)
        at = (np.cumsum(sizes) - sizes + g)[row]
        digest = (sums[at - hi[slot] + length] - sums[at - lo[slot]]) * down[at - lo[slot]]
        out = np.zeros(there.shape, np.uint32)
        out[row, slot] = counter(digest ^ anchors(batch)[row] ^ slot.astype(np.uint64) << np.uint64(56))
        return out, there

    held, writer = os.path.join(path, "contexts"), None
    with open(held, "wb") as sink:
        for batch in (b.slice(k, 4096) for b in batches for k in range(0, b.num_rows, 4096)):
            if writer is None:
                writer = pa.ipc.new_stream(sink, batch.schema)
            writer.write_batch(batch)
            whole[counter(anchors(batch)[batch.column(5).to_numpy() < 0]) >> 3] = True
            at, there = counters(batch)
            value, many = np.unique(at[there], return_counts=True)
            times[value] = np.minimum(times[value] + many, 2)
        if writer is None:
            return
        writer.close()
    with pa.ipc.open_stream(pa.OSFile(held)) as reader:
        os.unlink(held)
        for batch in reader:
            _, n, _, first, last, there = ranges(batch)
            at, _ = counters(batch)
            keep = there & (times[at] > 1)
            all_ = whole[counter(anchors(batch)) >> 3]
            keep[all_] = False
            edge = np.diff(np.pad(keep, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            (row, a), (_, b) = np.nonzero(edge == 1), np.nonzero(edge == -1)
            one = np.flatnonzero(all_)
            of = np.concatenate((row, one))
            a, b = np.concatenate((first[row, a], np.zeros(len(one), np.int64))), np.concatenate((last[row, b - 1], n[one] - 1))
            text = batch.column(3).to_pylist()
            ctx = [text[i][x : y + length] for i, x, y in zip(of.tolist(), a.tolist(), b.tolist())]
            start = batch.column(2).to_numpy()[of] + a
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).take(pa.array(of)), "t": batch.column(1).take(pa.array(of)), "start": pa.array(start, pa.int32()), "ctx": pa.array(ctx, pa.binary())})


class Shard:
    """Contexts of one shard: their bytes in a file, their places beside it; and which of their windows are lost."""

    def __init__(self, folder: Folder, length: int):
        self.folder, self.length = folder, length
        self.bytes, self.meta = Stream(folder, np.uint8), Stream(folder, PLACE)

    def add(self, batch: pa.RecordBatch) -> None:
        """A batch of (doc_id, t, start, ctx)."""
        binary = batch.column(3)
        sizes = pc.binary_length(binary).to_numpy(zero_copy_only=False).astype(np.int64)
        # 0 is the end, 1 stands behind each context; no UTF-8 byte is above 0xF4.
        text = np.full(int(sizes.sum()) + len(sizes), 1, np.uint8)
        inside = np.ones(len(text), bool)
        inside[np.cumsum(sizes + 1) - 1] = False
        text[inside] = np.frombuffer(b"".join(binary.to_pylist()), np.uint8) + np.uint8(2)
        self.bytes.add(text)
        made = np.empty(len(sizes), PLACE)
        made["null"] = np.asarray(batch.column(0).is_valid())
        made["doc"] = pc.fill_null(batch.column(0), 0).to_numpy()
        made["t"], made["start"], made["size"] = batch.column(1).to_numpy(), batch.column(2).to_numpy(), sizes
        self.meta.add(made)

    def lost_runs(self, budget: int, base: int):
        """Yields (doc_id, t, first window, last window) arrays, doc_id with the mask of those that are there."""
        self.bytes.add(np.zeros(1, np.uint8))
        text, meta = self.bytes.done(), self.meta.done()
        n = len(meta)
        first = np.zeros(n + 1, np.int64)
        first[0] = 0
        np.cumsum(meta["size"] + 1, out=first[1:])
        # Documents in order of (doc_id, null first, digest); a context's number is its document's.
        low = meta["t"] >> 33 & ((1 << 31) - 1)
        by = np.lexsort((low, meta["doc"], meta["null"]))
        new = np.ones(n, bool)
        for key in (low, meta["doc"], meta["null"]):
            new[1:] &= key[by[1:]] == key[by[:-1]]
        new[1:] = ~new[1:]
        doc_of = self.folder.array("<i8", n)
        doc_of[by] = np.cumsum(new)
        del by, new, low
        lost = self.folder.array(bool, len(text))
        start_of, sizes, length = meta["start"], np.append(meta["size"], 0), self.length
        best: tuple | None = None  # of the run that may go on: document, place, positions

        def settle(chunk: np.ndarray) -> None:
            """Sorted suffixes: of each run of equal windows only the earliest place is kept; the last run may go on."""
            nonlocal best
            at, head = chunk["at"].astype(np.int64), chunk["lcp"] < length
            run = np.cumsum(head)
            goes_on = run[-1] == 0  # no new run began in this chunk
            many = ~head
            many[:-1] |= ~head[1:]
            many[-1] = True  # others may follow
            at, run = at[many], run[many]
            ctx = np.searchsorted(first, at, side="right") - 1
            inner = at - first[np.minimum(ctx, n)]
            fine = (ctx < n) & (inner + length <= sizes[np.minimum(ctx, n)])
            at, ctx, inner, run = at[fine], ctx[fine], inner[fine], run[fine]
            if len(at):
                d, p = doc_of[ctx], start_of[ctx] + inner
                sort = np.lexsort((p, d, run))
                run, at, d, p = run[sort], at[sort], d[sort], p[sort]
                lead = np.flatnonzero(np.diff(run, prepend=-1))
                group = np.repeat(lead, np.diff(np.append(lead, len(run))))
                same = (d == d[group]) & (p == p[group])
                lost[at[~same]] = True
                if best is not None and run[0] == 0:  # the run from before goes on
                    mine, here = (int(d[0]), int(p[0])), at[(run == 0) & same]
                    if mine < best[:2]:
                        lost[best[2]] = True
                        kept = (*mine, here)
                    elif mine > best[:2]:
                        lost[here] = True
                        kept = best
                    else:
                        kept = (*mine, np.concatenate((best[2], here)))
                else:
                    kept = best if goes_on else None
                last = run == run[-1]
                if run[-1] == np.sum(head):
                    best = kept if run[-1] == 0 and kept is not None else (int(d[lead[-1]]), int(p[lead[-1]]), at[last & same])
                else:
                    best = None
            elif not goes_on:
                best = None

        SuffixSorter(text, self.folder, budget, length, base).visit(settle)
        for lo in range(0, n, 1 << 12):
            hi = min(lo + (1 << 12), n)
            here = np.asarray(lost[first[lo] : first[hi]])
            edge = np.diff(here.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
            begin, end = np.flatnonzero(edge == 1) + first[lo], np.flatnonzero(edge == -1) - 1 + first[lo]
            ctx = np.searchsorted(first, begin, side="right") - 1
            yield meta["doc"][ctx], meta["null"][ctx], meta["t"][ctx], start_of[ctx] + (begin - first[ctx]), start_of[ctx] + (end - first[ctx])


def sorted_shard(batches, length: int, budget: int, base: int, report: dict | None = None):
    """doc_id, t, a, b: the windows of the shard's contexts that start earlier elsewhere in it, by the external suffix sort."""
    with tempfile.TemporaryDirectory() as path:
        folder = Folder(path)
        shard, any_ = Shard(folder, length), False
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                shard.add(batch.slice(lo, 4096))
                any_ = True
        if any_:
            for doc, there, t, a, b in shard.lost_runs(budget, base):
                if len(doc):
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc, pa.int64(), mask=~there.astype(bool)), "t": pa.array(t, pa.int64()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32())})
        if report is not None:
            report.update(spills=folder.spills, recursions=folder.recursions)


def lost_windows(rows: DataFrame, length: int, gram: int, shard_bytes: int, hot_bytes: int, budget: int, base: int) -> DataFrame:
    """doc_id, t, a, b: windows a to b of a document start earlier elsewhere; from ``candidates``."""
    keyed = rows.withColumn("o", _order())
    # Written, so that it is made once and the joins have a shuffle on either side, whose hot keys AQE may split.
    firsts = written(keyed.groupBy("h", "c").agg(F.min("o").alias("first")), "firsts")
    met = keyed.drop("ctx").join(firsts, ["h", "c"]).filter("o <> first")
    copies = met.select("doc_id", "t", F.col("start").alias("a"), (F.col("start") + F.col("n") - 1).alias("b"))
    mixed = keyed.filter(F.col("ctx").isNotNull()).join(firsts, ["h", "c"]).filter("o = first").dropDuplicates(["h", "c"]).select("h", "doc_id", "t", "start", "n", "g", "ctx")
    mixed = written(mixed, "contexts")
    hot = mixed.groupBy("h").agg(F.sum(F.length("ctx")).alias("bytes"), F.sum("n").alias("windows")).filter(F.col("bytes") > hot_bytes)
    hot = written(hot, "hot-anchors")
    more, least, any_hot = hot.agg(F.coalesce(F.sum("windows"), F.lit(0)) * (length + 1), F.coalesce(F.sum("bytes"), F.lit(0)), F.count("h")).first()
    total = (mixed.agg(F.sum(F.length("ctx") + 1)).first()[0] or 0) - least + more
    shards = max(1, -(-total // shard_bytes))
    shard = mixed.select("doc_id", "t", "start", "ctx", F.xxhash64("h").alias("s"), "g")
    if any_hot:
        # A hot anchor is spread by its windows: equal ones meet in one shard, where the sort settles them as any others.
        each = mixed.join(hot.select("h"), "h", "left_semi").select("doc_id", "t", "start", "ctx", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
        window = F.substring("ctx", F.col("k") + 1, length)
        single = each.select("doc_id", "t", (F.col("start") + F.col("k")).cast("int").alias("start"), window.alias("ctx"), F.xxhash64(window).alias("s"), F.lit(0).alias("g"))
        shard = mixed.join(hot.select("h"), "h", "left_anti").select("doc_id", "t", "start", "ctx", F.xxhash64("h").alias("s"), "g").unionByName(single)

    def sort(batches):
        with tempfile.TemporaryDirectory() as path:
            yield from sorted_shard(shared_windows(batches, path, length, length - gram + 1), length, budget, base)

    sorted_ = shard.repartition(shards, "s").mapInArrow(sort, "doc_id long, t long, a int, b int")
    return copies.unionByName(sorted_)


def dedup_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, hot_bytes: int = HOT_BYTES, budget: int = BUDGET, base: int = BASE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of every row of ``docs`` (doc_id, text)."""
    keyed = _keyed(docs)
    groups, path = anchor_groups(keyed, length, gram)
    rows = candidates(keyed, groups, length, gram)
    drop_path(docs.sparkSession, path)
    lost = lost_windows(rows, length, gram, shard_bytes, hot_bytes, budget, base)
    whole = lost.groupBy(F.col("doc_id").alias("i"), F.col("t").alias("d")).agg(F.collect_list(F.struct("a", "b")).alias("lost"))
    both = keyed.join(whole.hint("shuffle_hash"), keyed["doc_id"].eqNullSafe(F.col("i")) & (keyed["t"] == F.col("d")), "left").select("doc_id", "text", "lost")

    def cut(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        for batch in batches:
            for part in row_chunks(batch, 1, 512):
                lists = part.column(2)
                flat = lists.flatten()
                a, b = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                upto = np.cumsum(sizes)
                out: list = []
                for doc_id, text, lo, hi in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), (upto - sizes).tolist(), upto.tolist()):
                    raw = text.encode("utf-8")
                    spans: list = []
                    if hi > lo:
                        order = np.argsort(a[lo:hi], kind="stable")
                        s, e = a[lo:hi][order].astype(np.int64), np.maximum.accumulate(b[lo:hi][order].astype(np.int64)) + length
                        new = np.flatnonzero(np.concatenate(([True], s[1:] > e[:-1])))
                        spans = list(zip(s[new].tolist(), e[np.append(new[1:], len(e)) - 1].tolist()))
                    kept, done = hashlib.sha256(), 0
                    for s_, e_ in spans:
                        kept.update(raw[done:s_])
                        done = e_
                    kept.update(raw[done:])
                    out.append((doc_id, len(raw), sum(e_ - s_ for s_, e_ in spans), len(spans), kept.hexdigest(), [{"start": s_, "end": e_} for s_, e_ in spans]))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return both.mapInArrow(cut, RESULT)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: repeated 100-byte strings of ``documents``, as a digest of what stays."""
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
