"""External induced sorting of suffixes, with common-prefix values, for one shard.

The text lies in a file (memory-mapped), and so do the types of its suffixes, the left-most S-type (LMS) places, the
names and every order that is made of them; memory holds blocks of ``BLOCK`` entries, queues up to ``budget`` bytes and
what ``base`` names take. Suffixes are induced from the sorted LMS suffixes by two disk-backed priority
queues: a queue hands out symbols in ascending (L-type pass) or descending (S-type pass) order, and for each symbol its suffixes in
the order of their arrival, which is their order. Queued suffix tuples (position, common prefix with the one before) beyond
the budget are spilled to a file. All suffixes of a symbol that are there are taken at once and induce their
predecessors in one step of array operations; those that fall on the same symbol make the next step.

LMS substrings are sorted by the same two passes and named; equal names make a shorter string of names, which
``NameSorter`` sorts by the same induction, recursively, while it is longer than ``base``. Its alphabet is large, so its
queue goes by ranges of symbols, and the suffixes of a range are sorted by symbol and arrival when the range's turn comes; what
they induce within the window that is worked on is merged into it.

Common prefixes, cut at ``limit``, start with those of neighbouring LMS suffixes; an induced suffix has one more
than the least value passed between its source and the source before it that fell on the same symbol.
Suffixes that agree in their first ``limit`` symbols may stand in any order.
"""

from __future__ import annotations

import heapq
import os
import tempfile
import uuid

import numpy as np

#: Suffix tuples: position and common prefix, or position and name; positions take four bytes in texts below 2 GB.
ENTRY = {4: np.dtype([("at", "<i4"), ("lcp", "<i2")]), 8: np.dtype([("at", "<i8"), ("lcp", "<i2")])}
NAMED = {4: np.dtype([("at", "<i4"), ("symbol", "<i4")]), 8: np.dtype([("at", "<i8"), ("symbol", "<i8")])}
FAR = np.int16(32767)
BLOCK = 1 << 16


def width(text: np.ndarray) -> int:
    """Bytes of a position."""
    return 4 if len(text) < 1 << 31 else 8


def joined(parts: list) -> np.ndarray:
    """Tuples of several arrays in one; as plain bytes, since numpy looks at each field of each array otherwise."""
    if len(parts) == 1:
        return parts[0]
    kind = parts[0].dtype
    plain = np.dtype(f"V{kind.itemsize}")
    return np.concatenate([np.ascontiguousarray(p).view(plain) for p in parts]).view(kind)


class Folder:
    """Files of one sort, and what it did; a file's space is free again when its array is no longer used."""

    def __init__(self, path: str):
        self.path, self.spills, self.recursions = path, 0, 0

    def array(self, dtype, size: int) -> np.ndarray:
        """An array in a file of its own."""
        path = os.path.join(self.path, uuid.uuid4().hex)
        made = np.asarray(np.memmap(path, dtype, "w+", shape=(max(1, size),)))[:size]
        os.unlink(path)
        return made


class Stream:
    """Values appended to a file, then read as an array."""

    def __init__(self, folder: Folder, dtype):
        self.path, self.dtype, self.size = os.path.join(folder.path, uuid.uuid4().hex), np.dtype(dtype), 0
        self.file = open(self.path, "wb")

    def add(self, values: np.ndarray) -> None:
        self.file.write(np.ascontiguousarray(values, self.dtype).tobytes())
        self.size += len(values)

    def done(self) -> np.ndarray:
        self.file.close()
        made = np.asarray(np.memmap(self.path, self.dtype, "r")) if self.size else np.zeros(0, self.dtype)
        os.unlink(self.path)
        return made


class BucketQueue:
    """Symbols in order, each with its tuples in order of arrival; tuples beyond ``budget`` are on disk."""

    def __init__(self, folder: Folder, descending: bool, budget: int, dtype: np.dtype):
        self.sign, self.budget, self.held, self.folder, self.dtype = -1 if descending else 1, budget, 0, folder, dtype
        self.file = tempfile.TemporaryFile(dir=folder.path)
        self.heap, self.chunks = [], {}

    def push(self, symbol: int, items: np.ndarray) -> None:
        if symbol not in self.chunks:
            self.chunks[symbol] = []
            heapq.heappush(self.heap, self.sign * symbol)
        # A small view would keep the whole array that it is cut from.
        self.chunks[symbol].append(items.copy() if items.base is not None and 2 * items.nbytes < getattr(items.base, "nbytes", 0) else items)
        self.held += items.nbytes
        if self.held > self.budget:
            self._spill()

    def _spill(self) -> None:
        self.file.seek(0, os.SEEK_END)
        for parts in self.chunks.values():
            fresh = [p for p in parts if isinstance(p, np.ndarray)]
            if fresh:
                # A symbol's chunks in memory are its last ones; they become one on disk.
                where = self.file.tell()
                one = joined(fresh)
                self.file.write(one.tobytes())
                parts[len(parts) - len(fresh) :] = [(where, len(one))]
        self.held = 0
        self.folder.spills += 1

    def first(self) -> int | None:
        return self.sign * self.heap[0] if self.heap else None

    def take(self, symbol: int) -> list:
        """All chunks of the first symbol now there; later ones of it need another call."""
        parts = self.chunks.pop(symbol)
        heapq.heappop(self.heap)
        return parts

    def read(self, part, lo: int = 0, size: int | None = None) -> np.ndarray:
        if isinstance(part, np.ndarray):
            return part[lo : None if size is None else lo + size]
        n = part[1] - lo if size is None else min(size, part[1] - lo)
        self.file.seek(part[0] + lo * self.dtype.itemsize)
        return np.frombuffer(self.file.read(n * self.dtype.itemsize), self.dtype)

    def gathered(self, parts: list, step: int, backwards: bool = False):
        """Parts joined to arrays of about ``step`` tuples; ``backwards`` from the last on, each in its own order."""
        held: list = []
        size = 0
        for part in reversed(parts) if backwards else parts:
            n = len(part) if isinstance(part, np.ndarray) else part[1]
            if isinstance(part, np.ndarray):
                self.held -= part.nbytes
            spans = [(lo, min(step, n - lo)) for lo in range(0, n, step)]
            for lo, k in reversed(spans) if backwards else spans:
                held.append(self.read(part, lo, k))
                size += k
                if size >= step:
                    yield joined(held[::-1] if backwards else held)
                    held, size = [], 0
        if held:
            yield joined(held[::-1] if backwards else held)

    def close(self) -> None:
        self.file.close()


def entries(at: np.ndarray, lcp: np.ndarray, kind: np.dtype) -> np.ndarray:
    out = np.empty(len(at), kind)
    out["at"], out["lcp"] = at, lcp
    return out


def s_types(text: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Whether each suffix is S-type, from right to left in blocks; the last symbol is the least and S-type."""
    n = len(text)
    out = np.zeros(n, bool) if out is None else out
    out[n - 1] = True
    hi = n - 1
    while hi > 0:
        lo = max(0, hi - BLOCK)
        step = np.sign(text[lo + 1 : hi + 1].astype(np.int64) - text[lo:hi])
        # the next change at or after each place; beyond the block it is the type of the place behind it
        place = np.where(step != 0, np.arange(hi - lo), hi - lo)
        nxt = np.minimum.accumulate(place[::-1])[::-1]
        kind = np.append(step, 1 if out[hi] else -1)
        out[lo:hi] = kind[nxt] > 0
        hi = lo
    return out


def is_lms(kinds: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (at > 0) & kinds[at] & ~kinds[np.maximum(at - 1, 0)]


def lms_places(kinds: np.ndarray, folder: Folder) -> np.ndarray:
    """The LMS places in order of the text."""
    out = Stream(folder, f"<i{width(kinds)}")
    for lo in range(1, len(kinds), BLOCK):
        part = kinds[lo - 1 : lo + BLOCK]
        out.add(np.flatnonzero(part[1:] & ~part[:-1]) + lo)
    return out.done()


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of pairs of different suffixes, at most ``limit``; bytes go by eight at a time."""
    out = np.zeros(len(a), np.int16)
    live, n = np.arange(len(a)), len(text)
    if text.dtype == np.uint8 and len(a) > 64:
        for k in range(0, limit, 8):
            # The unique last value ends a prefix before either suffix runs out.
            x = _words(text, a[live] + k) ^ _words(text, b[live] + k)
            low = x & (~x + np.uint64(1))
            out[live] += np.where(x == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int16)
            live = live[x == 0]
            if not len(live):
                break
        return np.minimum(out, np.int16(min(limit, 32767)))
    for k in range(limit):
        ok = (a[live] + k < n) & (b[live] + k < n)
        live = live[ok]
        live = live[text[a[live] + k] == text[b[live] + k]]
        if not len(live):
            break
        out[live] += 1
    return out


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros stand behind the text."""
    n = len(text)
    whole = np.ndarray((n - 7,), "<u8", text, strides=(1,)) if n >= 8 else None
    fine = at <= n - 8
    out = np.zeros(len(at), np.uint64)
    if whole is not None:
        out[fine] = whole[at[fine]]
    for i in np.flatnonzero(~fine).tolist():
        out[i] = int.from_bytes(bytes(text[min(at[i], n) :][:8]).ljust(8, b"\0"), "little")
    return out


class Induction:
    """One pass over the symbols in either direction."""

    def __init__(self, text: np.ndarray, kinds: np.ndarray, folder: Folder, descending: bool, budget: int, limit: int | None):
        self.text, self.kinds, self.descending, self.limit = text, kinds, descending, limit
        self.kind = ENTRY[width(text)]
        self.queue = BucketQueue(folder, descending, budget, self.kind)
        self.least: dict = {}  # symbol -> least common prefix passed since its last tuple
        self.last: int | None = None  # position passed last

    def scan(self, symbol: int, items: np.ndarray) -> None:
        """Passes sorted suffixes of ``symbol`` and queues the predecessors that are of this pass's kind."""
        text, at = self.text, items["at"]
        prev = at - 1
        ok = prev >= 0
        before = text[np.maximum(prev, 0)]
        ok &= self.kinds[np.maximum(prev, 0)] == self.descending
        k = np.flatnonzero(ok)
        lcp = items["lcp"]
        if self.limit is not None and len(at):
            passed = np.minimum.accumulate(lcp)
            # symbols not met in this step keep the least value passed
            total = passed[-1]
        if len(k):
            x = before[k]
            order = np.argsort(x, kind="stable")
            k, x = k[order], x[order].astype(np.int64)
            cuts = np.flatnonzero(np.diff(x, prepend=-1))
            ends = np.append(cuts[1:], len(x))
            if self.limit is not None:
                new = np.zeros(len(k), np.int16)
                if len(k) > 1:
                    longer = np.append(lcp, FAR)
                    spans = np.empty(2 * (len(k) - 1), np.int64)
                    spans[::2], spans[1::2] = k[:-1] + 1, k[1:] + 1
                    same = x[1:] == x[:-1]
                    spans[1::2] = np.where(same, spans[1::2], spans[::2])
                    new[1:] = np.minimum.reduceat(longer, spans)[::2]
                tail = np.append(np.minimum.accumulate(lcp[::-1])[::-1], FAR)
                got = {}
                for a, b in zip(cuts.tolist(), ends.tolist()):
                    s = int(x[a])
                    old = self.least.get(s)
                    new[a] = -1 if old is None else min(old, passed[k[a]])
                    got[s] = tail[k[b - 1] + 1]
                new = np.minimum(new + np.int16(1), np.int16(self.limit))
                for s in self.least:
                    if s not in got:
                        self.least[s] = min(self.least[s], total)
                self.least.update(got)
            else:
                new = np.zeros(len(k), np.int16)
            made = entries(prev[k], new, self.kind)
            for a, b in zip(cuts.tolist(), ends.tolist()):
                self.queue.push(int(x[a]), made[a:b])
        elif self.limit is not None and len(at):
            for s in self.least:
                self.least[s] = min(self.least[s], total)

    def join(self, items: np.ndarray) -> np.ndarray:
        """``items`` with the first one's common prefix measured against the suffix passed last."""
        if self.limit is not None and len(items):
            items = items.copy()
            first = int(items["at"][0])
            if self.last is None:
                items["lcp"][0] = 0
            else:
                items["lcp"][0] = common(self.text, np.array([self.last]), np.array([first]), self.limit)[0]
        return items


class SuffixSorter:
    """Sorts the suffixes of ``text`` (bytes whose last value is a unique least)."""

    def __init__(self, text: np.ndarray, folder: Folder, budget: int = 4 << 20, limit: int = 100, base: int = 1 << 18, step: int | None = None):
        self.text, self.folder, self.budget, self.limit, self.base, self.step = text, folder, budget, limit, base, step or BLOCK // 2

    def _pass(self, seeds, descending: bool, kinds, limit, out, passed=None) -> None:
        """Drives one induction.

        ``seeds(symbol)`` yields the sorted chunks of the other kind for a symbol, ``out(symbol, chunk)`` gets this
        kind's and ``passed(chunk)`` the seeds; seeds of a symbol follow its induced suffixes in scanning order.
        """
        run = Induction(self.text, kinds, self.folder, descending, self.budget, limit)
        pending = [(-s if descending else s) for s in seeds.symbols]
        heapq.heapify(pending)
        while run.queue.heap or pending:
            mine = run.queue.first()
            other = (-pending[0] if descending else pending[0]) if pending else None
            symbol = mine if other is None else other if mine is None else (max if descending else min)(mine, other)
            fresh = True
            while run.queue.first() == symbol:
                for items in run.queue.gathered(run.queue.take(symbol), self.step):
                    for lo in range(0, len(items), self.step):
                        chunk = items[lo : lo + self.step]
                        if fresh:
                            chunk, fresh = run.join(chunk), False
                        out(symbol, chunk)
                        run.scan(symbol, chunk)
                        run.last = int(chunk["at"][-1])
            if other == symbol:
                heapq.heappop(pending)
                fresh = True
                for items in seeds.chunks(symbol):
                    for lo in range(0, len(items), self.step):
                        chunk = items[lo : lo + self.step]
                        if fresh:
                            chunk, fresh = run.join(chunk), False
                        if passed is not None:
                            passed(chunk)
                        run.scan(symbol, chunk)
                        run.last = int(chunk["at"][-1])
        run.queue.close()

    def _induce(self, seeds, kinds: np.ndarray, limit: int | None, out) -> None:
        """From LMS suffixes by symbol all suffixes; ``out(chunk, is_s)`` in descending order."""
        larges = BucketQueue(self.folder, True, self.budget, ENTRY[width(self.text)])
        self._pass(seeds, False, kinds, limit, larges.push)
        self._pass(_Reversed(larges, self.step), True, kinds, limit, lambda symbol, chunk: out(chunk, True), lambda chunk: out(chunk, False))
        larges.close()

    def sorted_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """LMS suffixes in order, and the types."""
        text, folder = self.text, self.folder
        kinds = s_types(text, folder.array(bool, len(text)))
        lms = lms_places(kinds, folder)
        if len(lms) < 2:
            return lms, kinds
        seeds = BucketQueue(folder, False, self.budget, ENTRY[width(text)])
        for lo in range(0, len(lms), self.step):
            part = np.asarray(lms[lo : lo + self.step])
            heads = text[part]
            order = np.argsort(heads, kind="stable")
            cuts = np.flatnonzero(np.diff(heads[order].astype(np.int64), prepend=-1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]):
                seeds.push(int(heads[order[a]]), entries(part[order[a:b]], np.zeros(b - a, np.int16), seeds.dtype))
        found = Stream(folder, f"<i{width(text)}")

        def keep(chunk, is_s):
            if is_s:
                found.add(chunk["at"][is_lms(kinds, chunk["at"])])

        self._induce(_Queued(seeds, self.step), kinds, None, keep)
        seeds.close()
        by_substring = found.done()[::-1]  # all but the last place, the end mark, which nothing follows
        names, many = self._names(lms, by_substring)
        if many == len(lms):
            return _with_end(by_substring, lms[-1], folder), kinds
        rank = order_of_names(names, many, folder, self.budget, self.limit, self.base)
        return _taken(lms, rank, folder), kinds

    def _names(self, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
        """Names of the LMS substrings in text order, equal substrings sharing one, and how many there are."""
        text, names, number = self.text, self.folder.array(f"<i{width(self.text)}", len(lms)), self.folder.array(f"<i{width(self.text)}", len(self.text))
        names[len(lms) - 1] = 0
        for lo in range(0, len(lms), BLOCK):
            number[lms[lo : lo + BLOCK]] = np.arange(lo, min(lo + BLOCK, len(lms)))
        at, last = 0, None
        for lo in range(0, len(ordered), BLOCK):
            here = np.asarray(ordered[lo : lo + BLOCK])
            where = number[here]
            length = lms[where + 1] - here + 1
            a, na = (np.concatenate(([last[0] if last else here[0]], here[:-1])), np.concatenate(([last[1] if last else -1], length[:-1])))
            same = na == length
            live, k = np.flatnonzero(same), 0
            while len(live):
                live = live[length[live] > k]
                differ = text[a[live] + k] != text[here[live] + k]
                same[live[differ]] = False
                live = live[~differ]
                k += 1
            new = at + np.cumsum(~same)
            names[where] = new
            at, last = int(new[-1]), (int(here[-1]), int(length[-1]))
        return names, at + 1

    def visit(self, out) -> None:
        """``out(positions, common prefix with the suffix before)`` of all suffixes in descending order, chunk by chunk.

        The common prefix is that with the suffix just passed, at most ``limit``.
        """
        order, kinds = self.sorted_lms()
        lcp = self.folder.array("<i2", len(order))
        for lo in range(1, len(order), BLOCK):
            hi = min(lo + BLOCK, len(order))
            lcp[lo:hi] = common(self.text, np.asarray(order[lo - 1 : hi - 1]), np.asarray(order[lo:hi]), self.limit)
        self._induce(_Sorted(self.text, order, lcp, self.step), kinds, self.limit, lambda chunk, is_s: out(chunk))


def _with_end(ordered: np.ndarray, end: int, folder: Folder) -> np.ndarray:
    out = Stream(folder, ordered.dtype)
    out.add(np.array([end]))
    for lo in range(0, len(ordered), BLOCK):
        out.add(ordered[lo : lo + BLOCK])
    return out.done()


def _taken(values: np.ndarray, order: np.ndarray, folder: Folder) -> np.ndarray:
    out = Stream(folder, values.dtype)
    for lo in range(0, len(order), BLOCK):
        out.add(values[np.asarray(order[lo : lo + BLOCK])])
    return out.done()


class _Queued:
    """Seeds in a queue, by symbol."""

    def __init__(self, queue: BucketQueue, step: int):
        self.queue, self.step, self.symbols = queue, step, list(queue.chunks)

    def chunks(self, symbol):
        yield from self.queue.gathered(self.queue.chunks.pop(symbol), self.step)


class _Sorted:
    """Sorted suffixes as seeds, by symbol."""

    def __init__(self, text, order, lcp, step):
        self.order, self.lcp, self.step, self.kind = order, lcp, step, ENTRY[width(text)]
        cuts, heads, before = [], [], -1
        for lo in range(0, len(order), BLOCK):
            head = text[np.asarray(order[lo : lo + BLOCK])].astype(np.int64)
            new = np.flatnonzero(np.diff(head, prepend=before))
            cuts += (new + lo).tolist()
            heads += head[new].tolist()
            before = int(head[-1])
        self.symbols = heads
        self.spans = dict(zip(heads, zip(cuts, [*cuts[1:], len(order)])))

    def chunks(self, symbol):
        first, last = self.spans[symbol]
        for lo in range(first, last, self.step):
            hi = min(lo + self.step, last)
            yield entries(self.order[lo:hi], self.lcp[lo:hi], self.kind)


class _Reversed:
    """L-type suffixes of the first pass, last first; common prefixes shift to the other neighbour."""

    def __init__(self, queue: BucketQueue, step: int):
        self.queue, self.step = queue, step
        self.symbols = list(queue.chunks)

    def chunks(self, symbol):
        behind = FAR  # stands for the first one, which ``join`` measures
        for items in self.queue.gathered(self.queue.chunks.pop(symbol), self.step, backwards=True):
            items = items[::-1].copy()
            shifted = items["lcp"].copy()
            items["lcp"][1:] = shifted[:-1]
            items["lcp"][0] = behind
            behind = shifted[-1]
            yield items


# -- strings of names --------------------------------------------------------------------------------
def order_of_names(names: np.ndarray, many: int, folder: Folder, budget: int, reach: int, base: int) -> np.ndarray:
    """The suffixes of a string of ``many`` different names, in order at least of their first ``reach`` symbols."""
    if len(names) <= base:
        return order_in_memory(names, reach).astype(names.dtype)
    folder.recursions += 1
    return NameSorter(names, many, folder, budget, reach, base).order()


class NameSorter:
    """Induced sorting of a string of names, whose last is the unique least; all but windows and ranges is in files."""

    def __init__(self, text: np.ndarray, many: int, folder: Folder, budget: int, reach: int, base: int, window: int = 4096):
        self.text, self.many, self.folder, self.budget, self.reach, self.base, self.window = text, many, folder, budget, reach, base, window
        self.kind = NAMED[width(text)]
        # Ranges of symbols with about equally many suffixes, by a sample of the text.
        sample = np.sort(np.asarray(text[:: max(1, len(text) // 4096)]))
        self.cuts = np.unique(sample[:: max(1, len(sample) // max(64, len(text) * self.kind.itemsize // max(1, budget)))])

    def order(self) -> np.ndarray:
        text, folder = self.text, self.folder
        kinds = s_types(text, folder.array(bool, len(text)))
        lms = lms_places(kinds, folder)
        if len(lms) < 2:
            return self._induced(lms, kinds, None)
        found = Stream(folder, f"<i{width(text)}")
        self._induced(lms, kinds, lambda at: found.add(at[is_lms(kinds, at)]))
        by_substring = found.done()[::-1]
        names, many = SuffixSorter._names(self, lms, by_substring)
        if many == len(lms):
            order = _with_end(by_substring, lms[-1], folder)
        else:
            order = _taken(lms, order_of_names(names, many, folder, self.budget, self.reach, self.base), folder)
        return self._induced(order, kinds, None)

    def _induced(self, lms: np.ndarray, kinds: np.ndarray, keep) -> np.ndarray | None:
        """All suffixes in order, from LMS suffixes in the order in which those of one symbol shall stand; or, with ``keep``, the S-type ones to it, last first."""
        ranges = len(self.cuts) + 1
        seeds = BucketQueue(self.folder, False, self.budget, self.kind)
        for lo in range(0, len(lms), BLOCK):
            self._deal(seeds, np.asarray(lms[lo : lo + BLOCK]), False)
        larges = [Stream(self.folder, self.kind) for _ in range(ranges)]
        self._pass(kinds, False, lambda r: [*seeds.gathered(seeds.chunks.pop(r, []), BLOCK)], lambda r, at, symbol, seed: larges[r].add(self._named(at[~seed], symbol[~seed])))
        seeds.close()
        whole = None if keep else Stream(self.folder, f"<i{width(self.text)}")

        def out(r, at, symbol, seed):
            if keep:
                keep(at[~seed])
            else:
                whole.add(at)

        self._pass(kinds, True, lambda r: [np.asarray(larges[r].done())[::-1]], out)
        if keep:
            return None
        return _with_end(whole.done()[::-1], len(self.text) - 1, self.folder)

    def _named(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), self.kind)
        out["at"], out["symbol"] = at, symbol
        return out

    def _least(self, at, key, kinds, descending, least, most, sign, bound):
        """The least key that sorted suffixes induce within their window; none if they induce nothing there."""
        before = np.maximum(at - 1, 0)
        symbol = self.text[before].astype(np.int64)
        made = symbol * (2 * sign)
        near = (at > 0) & (kinds[before] == descending) & (symbol >= least) & (symbol < most)
        if bound is not None:
            near &= made < bound
        return int(made[near].min()) if near.any() else None

    def _runs(self, at: np.ndarray):
        """Suffixes of one symbol, then those that stand one place before them in a run of it, and so on; some at a time."""
        symbol, held, size = self.text[at[0]], [], 0
        while len(at):
            held.append(at)
            size += len(at)
            if size >= BLOCK:
                yield np.concatenate(held)
                held, size = [], 0
            at = at[at > 0] - 1
            at = at[self.text[at] == symbol]
        if held:
            yield np.concatenate(held)

    def _deal(self, queue: BucketQueue, at: np.ndarray, descending: bool) -> None:
        """Pushes suffixes to the ranges of their symbols, in their order."""
        symbol = np.asarray(self.text[at])
        r = np.searchsorted(self.cuts, symbol, side="right")
        order = np.argsort(r, kind="stable")
        cuts = np.flatnonzero(np.diff(r[order], prepend=-1))
        made = self._named(at[order], symbol[order])
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
            queue.push(int(r[order[a]]), made[a:b])

    def _pass(self, kinds: np.ndarray, descending: bool, seeds, out) -> None:
        """One induction; keys rise in the direction of the pass, and a symbol's induced suffixes come before its seeds."""
        queue = BucketQueue(self.folder, descending, self.budget, self.kind)
        ranges = len(self.cuts) + 1
        sign = -1 if descending else 1
        for r in range(ranges - 1, -1, -1) if descending else range(ranges):
            mine = [*queue.gathered(queue.take(r), BLOCK)] if queue.first() == r else []
            theirs = seeds(r)
            both = joined([*mine, *theirs]) if mine or theirs else np.zeros(0, self.kind)
            n = sum(map(len, mine))
            at, key = both["at"].astype(np.int64), both["symbol"].astype(np.int64) * (2 * sign)
            key[n:] += 1
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            late_at, late_key = np.zeros(0, np.int64), np.zeros(0, np.int64)
            least, most = self.cuts[r - 1] if r else 0, self.cuts[r] if r < ranges - 1 else np.iinfo(np.int64).max
            lo = 0
            while lo < len(at) or len(late_at):
                hi = min(lo + self.window, len(at))
                # Suffixes induced from now on stand behind those of their symbol that are there already.
                bound = int(key[hi - 1]) if hi < len(at) else None
                join = np.ones(len(late_at), bool) if bound is None else late_key < bound
                now_at, now_key = np.concatenate((at[lo:hi], late_at[join])), np.concatenate((key[lo:hi], late_key[join]))
                late_at, late_key, lo = late_at[~join], late_key[~join], hi
                order = np.argsort(now_key, kind="stable")
                now_at, now_key = now_at[order], now_key[order]
                more: list = []  # what is induced behind this window, but in this range

                def induced(at_: np.ndarray, key_: np.ndarray):
                    """Passes final suffixes; those that they induce in this window."""
                    prev = at_ - 1
                    before = np.maximum(prev, 0)
                    ok = (prev >= 0) & (kinds[before] == descending)
                    out(r, at_, key_ // 2 * sign, (key_ & 1).astype(bool))  # noqa: B023
                    prev = prev[ok]
                    if not len(prev):
                        return prev, prev
                    symbol = self.text[prev].astype(np.int64)
                    own = (symbol >= least) & (symbol < most)  # noqa: B023
                    if not own.all():
                        self._deal(queue, prev[~own], descending)
                        prev, symbol = prev[own], symbol[own]
                    made = symbol * (2 * sign)
                    if bound is None:  # noqa: B023
                        return prev, made
                    near = made < bound  # noqa: B023
                    if not near.all():
                        more.append((prev[~near], made[~near]))  # noqa: B023
                    return prev[near], made[near]

                while len(now_at):
                    # Final are those before the least key that they induce here, and those of that key.
                    here = self._least(now_at, now_key, kinds, descending, least, most, sign, bound)
                    stop = len(now_at) if here is None else int(np.searchsorted(now_key, here, side="right"))
                    new_at, new_key = induced(now_at[:stop], now_key[:stop])
                    now_at, now_key = now_at[stop:], now_key[stop:]
                    wait: list = []
                    next_ = new_key == here
                    if not next_.all():
                        wait.append((new_at[~next_], new_key[~next_]))
                    if next_.any():
                        # Runs of one symbol: what is induced on the key that is being passed comes next, and is known before it is passed.
                        for part in self._runs(new_at[next_]):
                            new_at, new_key = induced(part, np.full(len(part), here))
                            next_ = new_key == here
                            if not next_.all():
                                wait.append((new_at[~next_], new_key[~next_]))
                    if wait:
                        now_at, now_key = np.concatenate([now_at, *(w[0] for w in wait)]), np.concatenate([now_key, *(w[1] for w in wait)])
                        order = np.argsort(now_key, kind="stable")
                        now_at, now_key = now_at[order], now_key[order]
                if more:
                    late_at, late_key = np.concatenate([late_at, *(m[0] for m in more)]), np.concatenate([late_key, *(m[1] for m in more)])
        queue.close()


def order_in_memory(names: np.ndarray, reach: int) -> np.ndarray:
    """Order of the suffixes of a string of names, right at least for their first ``reach`` symbols."""
    n, rank, k = len(names), names.astype(np.int64), 1
    while True:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        rank, k = new, 2 * k
        if k >= min(n, reach) or rank[order[-1]] == n - 1:
            return order
