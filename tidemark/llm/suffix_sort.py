"""Suffix and common-prefix arrays by recursive induced sorting over queues and arrays that go to disk.

A string is reduced to the names of its LMS substrings, the reduced string is sorted the same way, and the
order of its suffixes is induced onto all others. Induction runs through a priority queue of tuples (symbol,
position, common prefix with the tuple before it under that symbol): the queue gives up tuples in suffix
order, each puts in its predecessor, and a running minimum of the common prefixes seen since a symbol's last
tuple, plus one, is the value that the next one carries. The values of a level give those of the LMS suffixes
one level below, so neighbours are never compared over their whole length.

The queue is cut into ranges of symbols. A range's tuples arrive in the order of their suffixes' tails, so
they are appended to a file and sorted by symbol alone once their range is reached. Tuples leave in blocks of
symbols, as many as put nothing into the block itself; a symbol that does is handled in waves. Arrays beyond
a size are files, tuples beyond a sum are spilled, and everything between is done in pieces, so a task holds
a bounded part of a shard of any size. Files are in the task's temporary folder and go with the task.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np

#: Bytes that a sort's queues hold in memory before they spill, the array size from which arrays are files,
#: and the elements of an array that are handled at a time.
QUEUE_BYTES, ARRAY_BYTES, PIECE = 64 << 20, 64 << 20, 1 << 20
#: Tuples of a range of symbols that are sorted together at most, unless one symbol has more, and the names
#: of a reduced string up to which recursion ends in memory.
RANGE, BASE = 1 << 17, 1 << 20


class Space:
    """Where a sort's arrays and spilled queues live; nothing is created before something needs disk."""

    def __init__(self, queue_bytes: int = QUEUE_BYTES, array_bytes: int = ARRAY_BYTES, piece: int = PIECE, base: int = BASE) -> None:
        self.queue_bytes, self.array_bytes, self.piece, self.base = queue_bytes, array_bytes, piece, base
        self.folder: str | None = None
        self.files = 0
        self.held = 0
        self.queues: set[Queue] = set()

    def __enter__(self) -> Space:
        return self

    def __exit__(self, *_) -> None:
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)

    def path(self) -> str:
        self.folder = self.folder or tempfile.mkdtemp(prefix="suffix-")
        self.files += 1
        return os.path.join(self.folder, str(self.files))

    def array(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize > self.array_bytes:
            path = self.path()
            out = np.memmap(path, dtype, "w+", shape=(n,))
            os.unlink(path)  # the mapping keeps the blocks; they go with the array
            return out
        return np.empty(n, dtype)

    def pieces(self, n: int) -> Iterator[tuple[int, int]]:
        for a in range(0, n, self.piece):
            yield a, min(a + self.piece, n)

    def grown(self, by: int) -> None:
        self.held += by
        if self.held > self.queue_bytes:
            for q in sorted(self.queues, key=lambda q: -q.held):
                if self.held <= self.queue_bytes // 2 or not q.held:
                    break
                q.spill()


class Queue:
    """First in, first out; the older part may be in a file."""

    def __init__(self, space: Space) -> None:
        self.space, self.parts, self.held, self.file = space, [], 0, None

    def put(self, items: np.ndarray) -> None:
        if len(items):
            self.space.queues.add(self)
            self.parts.append(items)
            self.held += items.nbytes
            self.space.grown(items.nbytes)

    def spill(self) -> None:
        self.file = self.file or self.space.path()
        with open(self.file, "ab") as out:
            for p in self.parts:
                p.tofile(out)
        self.space.held -= self.held
        self.parts, self.held = [], 0

    def drain(self, dtype) -> Iterator[np.ndarray]:
        """Everything put so far, oldest first, in pieces."""
        path, self.file = self.file, None
        parts, self.parts = self.parts, []
        self.space.held -= self.held
        self.held = 0
        self.space.queues.discard(self)
        if path:
            with open(path, "rb") as old:
                while len(piece := np.fromfile(old, dtype, self.space.piece)):
                    yield piece
            os.unlink(path)
        if parts:
            whole = parts[0] if len(parts) == 1 else np.concatenate(parts)
            del parts
            for a, b in self.space.pieces(len(whole)):
                yield whole[a:b]


def range_minimum(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of values[first[i]..last[i]], both ends included, for every i."""
    power = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    table = [values]
    for k in range(int(power.max()) if len(power) else 0):
        low = table[-1]
        table.append(np.concatenate([np.minimum(low[: -(1 << k)], low[1 << k :]), low[len(low) - (1 << k) :]]))
    if len(table) == 1:
        return values[first]
    table = np.stack(table)
    return np.minimum(table[power, first], table[power, last - (1 << power) + 1])


class Pass:
    """One direction of an induction: ascending over L suffixes, or descending over S suffixes.

    ``key`` of a symbol grows in the direction of the pass. ``later`` are the suffixes that are known: of
    each symbol, they come after those that this pass finds. ``scan`` takes suffixes in order with their
    common prefix with the one before, and puts their predecessors of the wanted type into the queue.
    """

    def __init__(self, level: Level, descending: bool, later: np.ndarray, later_common: np.ndarray, size: int) -> None:
        self.level, self.descending, self.later, self.later_common = level, descending, later, later_common
        space, sigma = level.space, level.sigma
        self.entry = np.dtype([("key", np.int32), ("at", level.kind), ("common", np.int16)])
        count = np.zeros(sigma, np.int64)
        for a, b in space.pieces(len(later)):
            count += np.bincount(self.keys(later[a:b]), minlength=sigma)
        #: Behind the last of ``later`` under each key.
        self.later_end = np.cumsum(count)
        self.ends = _ranges(level.histogram[::-1] if descending else level.histogram)
        self.queues = [Queue(space) for _ in self.ends]
        self.small = np.int16 if sigma < 1 << 15 else np.int32  # short keys are sorted by their digits
        self.range_of = np.searchsorted(self.ends, np.arange(sigma)).astype(np.int16 if len(self.ends) < 1 << 15 else np.int32)
        self.open, self.fresh = -1, []
        #: Least common prefix seen since the last tuple of each key.
        self.least = np.full(sigma, level.limit, np.int16)
        self.at, self.common, self.n = space.array(size, level.kind), space.array(size + 1, np.int16), 0

    def keys(self, at: np.ndarray) -> np.ndarray:
        t = self.level.text[at].astype(np.int64)
        return self.level.sigma - 1 - t if self.descending else t

    def put(self, entries: np.ndarray) -> None:
        if not len(entries):
            return
        where = self.range_of[entries["key"]]
        cuts = [0, *(np.flatnonzero(where[1:] != where[:-1]) + 1).tolist(), len(where)]
        for r, a, b in zip(where[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
            if r == self.open:
                self.fresh.append(entries[a:b])
            else:
                self.queues[r].put(entries[a:b])

    def before(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which suffixes have a predecessor of the wanted type, and the predecessors' keys."""
        own = np.flatnonzero((at > 0) & (self.level.is_s[np.maximum(at, 1) - 1] == self.descending))
        return own, self.keys(at[own] - 1)

    def scan(self, at: np.ndarray, common: np.ndarray, own: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The tuples of the predecessors, by key and in order."""
        entries = np.empty(len(own), self.entry)
        if not len(own):
            np.minimum(self.least, common.min(), out=self.least)
            return entries
        order = np.argsort(key.astype(self.small), kind="stable")
        k, i = key[order], own[order]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        value = np.empty(len(k), np.int16)
        value[new] = np.minimum(self.least[k[new]], np.minimum.accumulate(common)[i[new]])
        rest = np.flatnonzero(~new)
        if len(rest):
            value[rest] = range_minimum(common, i[rest - 1] + 1, i[rest])
        np.minimum(self.least, common.min(), out=self.least)
        final = np.concatenate([k[1:] != k[:-1], [True]])
        after = np.append(np.minimum.accumulate(common[::-1])[::-1], np.int16(self.level.limit))
        self.least[k[final]] = after[i[final] + 1]
        entries["key"], entries["at"], entries["common"] = k, at[i] - 1, np.minimum(value + np.int16(1), np.int16(self.level.limit))
        return entries

    def emit(self, at: np.ndarray, common: np.ndarray) -> None:
        self.at[self.n : self.n + len(at)], self.common[self.n : self.n + len(at)] = at, common
        self.n += len(at)

    def symbol(self, key: int, pieces: Iterator[np.ndarray], a: int, b: int) -> None:
        """All suffixes of one key: its tuples, wave after wave, then those of ``later[a:b]``."""
        last = None
        while True:
            again = []
            for piece in pieces:
                at, common = piece["at"], piece["common"].copy()
                if not len(at):
                    continue
                if last is None:
                    common[0] = 0
                last = int(at[-1])
                self.emit(at, common)
                entries = self.scan(at, common, *self.before(at))
                own = entries["key"] == key
                if own.any():
                    again.append(entries[own])
                    entries = entries[~own]
                self.put(entries)
            if not again:
                break
            pieces = iter(again)
        for s, e in self.level.space.pieces(b - a):
            at, common = np.asarray(self.later[a + s : a + e]), self.later_common[a + s : a + e].astype(np.int16)
            if s == 0:
                common[0] = 0 if last is None else min(self.level.run[last], self.level.run[at[0]])
            self.put(self.scan(at, common, *self.before(at)))

    def range(self, r: int, low: int, high: int) -> None:
        """All suffixes whose keys are in a range, block by block."""
        a, end = self.later_end[low - 1] if low else 0, self.later_end[high]
        a, end = int(a), int(end)
        if low == high:
            self.symbol(low, self.queues[r].drain(self.entry), a, end)
            return
        self.open, guess = r, 512
        held = np.empty(0, self.entry)
        self.fresh += list(self.queues[r].drain(self.entry))
        while True:
            if self.fresh:
                held = np.concatenate([held, *self.fresh])
                held = held[np.argsort(held["key"], kind="stable")]
                self.fresh = []
            if not len(held) and a == end:
                break
            top = int(held["key"][guess]) if len(held) > guess else high
            if end - a > guess:
                top = min(top, int(self.keys(self.later[a + guess : a + guess + 1])[0]))
            x, b = int(np.searchsorted(held["key"], top, "right")), int(self.later_end[top])
            at = np.concatenate([held["at"][:x], self.later[a:b]])
            key = np.concatenate([held["key"][:x], self.keys(self.later[a:b])])
            known = np.arange(len(at)) >= x
            order = np.argsort(key * 2 + known, kind="stable")
            at, key, known = at[order], key[order], known[order]
            common = np.concatenate([held["common"][:x], self.later_common[a:b]])[order].astype(np.int16)
            same = np.concatenate([[False], key[1:] == key[:-1]])
            common[~same] = 0
            seam = np.flatnonzero(same & known & ~np.concatenate([[False], known[:-1]]))
            common[seam] = np.minimum(self.level.run[at[seam]], self.level.run[at[seam - 1]])
            own, to = self.before(at)
            least = np.full(len(at), self.level.sigma, np.int64)
            least[own] = to
            bad = np.flatnonzero(np.minimum.accumulate(least) <= key)
            cut = int(np.searchsorted(key, key[bad[0]])) if len(bad) else len(at)
            if cut == 0:
                c = int(key[0])
                x, b = int(np.searchsorted(held["key"], c, "right")), int(self.later_end[c])
                own_piece, held = held[:x], held[x:]
                self.symbol(c, iter((own_piece,)), a, b)
            else:
                found = ~known[:cut]
                self.emit(at[:cut][found], common[:cut][found])
                fits = own < cut
                self.put(self.scan(at[:cut], common[:cut], own[fits], to[fits]))
                held, b = held[int(found.sum()) :], a + cut - int(found.sum())
                guess = max(512, 2 * cut)
            a = b
        self.open = -1

    def run(self) -> None:
        low = 0
        for r, high in enumerate(self.ends.tolist()):
            self.range(r, low, high)
            low = high + 1


def _ranges(histogram: np.ndarray) -> np.ndarray:
    """Last key of each range: about RANGE suffixes, frequent keys alone; every key alone in a small alphabet."""
    if len(histogram) <= 512:
        return np.arange(len(histogram))
    most = min(RANGE, max(4096, int(histogram.sum()) // 64))
    heavy = histogram > most // 4
    total = np.cumsum(histogram)
    group = total // most
    last = np.concatenate([(group[1:] != group[:-1]) | heavy[1:] | heavy[:-1], [True]])
    return np.flatnonzero(last)


class Level:
    """One string of the recursion: ``text`` of symbols below ``sigma``, of which 0 closes it and is nowhere else."""

    def __init__(self, text: np.ndarray, sigma: int, limit: int, space: Space) -> None:
        self.text, self.sigma, self.limit, self.space = text, sigma, limit, space
        n = len(text)
        self.kind = np.dtype(np.int32 if n < 1 << 31 else np.int64)
        self.histogram = np.zeros(sigma, np.int64)
        #: Whether a suffix is smaller than the next (S), and how often its first symbol stands in a row.
        self.is_s, self.run = space.array(n, bool), space.array(n, np.int16)
        self.is_s[n - 1], self.run[n - 1] = True, 1
        for a, b in reversed(list(space.pieces(n - 1))):
            x = text[a : b + 1].astype(np.int64)
            step = np.sign(x[1:] - x[:-1])
            i = np.arange(b - a)
            turn = np.minimum.accumulate(np.where(step != 0, i, b - a)[::-1])[::-1]
            inside = turn < b - a
            self.is_s[a:b] = np.where(inside, step[np.minimum(turn, b - a - 1)] > 0, self.is_s[b])
            self.run[a:b] = np.minimum(np.where(inside, turn - i + 1, b - a - i + int(self.run[b])), limit)
        lms = [np.empty(0, self.kind)]
        for a, b in space.pieces(n):
            own = self.is_s[a:b] & ~np.concatenate([[True] if a == 0 else self.is_s[a - 1 : a], self.is_s[a : b - 1]])
            lms.append((np.flatnonzero(own) + a).astype(self.kind))
            self.histogram += np.bincount(text[a:b], minlength=sigma)
        self.lms = space.array(sum(map(len, lms)), self.kind)
        np.concatenate(lms, out=self.lms)

    def words(self, own: np.ndarray, length: np.ndarray, skip: int) -> np.ndarray:
        """The symbols of LMS substrings from ``skip`` on, as many as a word holds; a substring's end is largest."""
        bits = self.sigma.bit_length()
        word, at = np.zeros(len(own), np.int64), self.lms[own].astype(np.int64) + skip
        for k in range(self.per_word):
            symbol = np.where(skip + k < length, self.text[np.minimum(at + k, len(self.text) - 1)], self.sigma)
            word = word << bits | symbol
        return word

    @property
    def per_word(self) -> int:
        return 62 // self.sigma.bit_length()

    def parts(self) -> Iterator[np.ndarray]:
        """Numbers of the LMS substrings in parts that are in order; a part fits into memory."""
        m = len(self.lms)
        if m * 40 <= self.space.array_bytes:
            yield np.arange(m)
            return
        length = lambda own: np.where(own + 1 < m, self.lms[np.minimum(own + 1, m - 1)] - self.lms[own] + 1, 1)
        drawn = np.random.default_rng(0).integers(0, m, min(m, 1 << 14))
        count = min(256, -(-m * 40 // self.space.array_bytes) * 2)
        splits = np.unique(np.quantile(self.words(drawn, length(drawn), 0), np.linspace(0, 1, count + 1)[1:-1], method="lower"))
        queues = [Queue(self.space) for _ in range(len(splits) + 1)]
        for a, b in self.space.pieces(m):
            own = np.arange(a, b)
            where = np.searchsorted(splits, self.words(own, length(own), 0), "right")
            for r in np.unique(where).tolist():
                queues[r].put(own[where == r])
        for q in queues:
            if held := list(q.drain(np.int64)):
                yield np.concatenate(held)

    def name(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Numbers of the LMS substrings in order, the name of each by number, and how many names there are."""
        m, done, names = len(self.lms), 0, 0
        kind = self.kind
        ordered, name = self.space.array(m, kind), self.space.array(m, np.int32 if m < 1 << 31 else np.int64)
        for own in self.parts():
            length = np.where(own + 1 < m, self.lms[np.minimum(own + 1, m - 1)] - self.lms[own] + 1, 1)
            word = self.words(own, length, 0)
            order = np.argsort(word, kind="stable")
            own, length, word = own[order], length[order], word[order]
            new = np.concatenate([[True], word[1:] != word[:-1]])
            skip = self.per_word
            while True:
                # a group of equals that goes on is sorted by its next symbols
                shared = ~new | np.concatenate([~new[1:], [False]])
                live = np.flatnonzero(shared & (length >= skip))  # one that ends here has its end yet to compare
                if not len(live):
                    break
                group = np.cumsum(new)[live]
                word = self.words(own[live], length[live], skip)
                order = np.lexsort((word, group))
                own[live], length[live], word = own[live][order], length[live][order], word[order]
                new[live] |= np.concatenate([[True], (word[1:] != word[:-1]) | (group[1:] != group[:-1])])
                skip += self.per_word
            ordered[done : done + len(own)] = own
            name[own] = names + np.cumsum(new) - 1
            done, names = done + len(own), names + int(new.sum())
        return ordered, name, names

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """The LMS suffixes in order and the common prefix of each with the one before."""
        m, text = len(self.lms), self.text
        ordered, name, names = self.name()
        alike = np.zeros(m, np.int16)
        if names < m:
            if m <= self.space.base:
                ordered, alike = sort_in_memory(name, self.limit // 2 + 1)
            else:
                ordered, alike = suffix_array(name, self.space, names, self.limit // 2 + 1)
        del name
        seeds, common = self.space.array(m, self.kind), self.space.array(m, np.int16)
        for a, b in self.space.pieces(m):
            seeds[a:b] = self.lms[ordered[a:b]]
            common[a:b] = 0
            first = max(a, 1)
            if first >= b:
                continue
            # behind ``alike`` equal substrings the suffixes differ within a substring or a run of its end
            k = alike[first:b].astype(np.int64)
            x, y = ordered[first - 1 : b - 1].astype(np.int64), ordered[first:b].astype(np.int64)
            far = np.minimum(x + k, m - 1), np.minimum(y + k, m - 1)
            value = self.lms[far[1]].astype(np.int64) - self.lms[y]
            live = np.flatnonzero((value < self.limit) & (k < self.limit // 2 + 1))
            value[k >= self.limit // 2 + 1] = self.limit
            p, q = self.lms[far[0][live]].astype(np.int64), self.lms[far[1][live]].astype(np.int64)
            while len(live):
                same = (text[np.minimum(p, len(text) - 1)] == text[np.minimum(q, len(text) - 1)]) & (value[live] < self.limit)
                live, p, q = live[same], p[same] + 1, q[same] + 1
                value[live] += 1
            common[first:b] = np.minimum(value, self.limit)
        return seeds, common

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        n, space, kind = len(self.text), self.space, self.kind
        seeds, seed_common = self.seeds()
        n_s = sum(int(self.is_s[a:b].sum()) for a, b in space.pieces(n))
        large = Pass(self, False, seeds, seed_common, n - n_s)
        large.run()
        del seeds, seed_common
        large.common[n - n_s] = 0
        small = Pass(self, True, large.at[::-1], large.common[::-1], n_s)
        closing = np.zeros(1, small.entry)
        closing["key"], closing["at"] = self.sigma - 1, n - 1
        small.put(closing)
        small.run()
        small.common[n_s] = 0
        # of each symbol the L suffixes come first
        count_l = np.zeros(self.sigma, np.int64)
        for a, b in space.pieces(n - n_s):
            count_l += np.bincount(self.text[large.at[a:b]], minlength=self.sigma)
        through_l = np.cumsum(count_l)
        before_s = np.cumsum(self.histogram - count_l) - (self.histogram - count_l)
        out, common = space.array(n, kind), space.array(n, np.int16)
        for a, b in space.pieces(n - n_s):
            at = large.at[a:b]
            to = np.arange(a, b) + before_s[self.text[at]]
            out[to], common[to] = at, large.common[a:b]
        at_s, common_s = small.at[::-1], small.common[::-1]
        for a, b in space.pieces(n_s):
            at = at_s[a:b]
            symbol = self.text[at]
            value = common_s[a:b].astype(np.int16)
            last = symbol[1:] != symbol[:-1]
            first = np.flatnonzero(np.concatenate([[a == 0 or self.text[at_s[a - 1]] != symbol[0]], last]))
            first = first[count_l[symbol[first]] > 0]
            value[first] = np.minimum(self.run[at[first]], self.run[large.at[through_l[symbol[first]] - 1]])
            to = np.arange(a, b) + through_l[symbol]
            out[to], common[to] = at, value
        return out, common


def sort_in_memory(names: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The recursion's base: suffixes of a short string in order of ``limit`` names, and their common prefixes.

    Groups of equals are split by the ranks of ever longer prefixes; the ranks, kept, give common prefixes.
    """
    n = len(names)
    rank = names.astype(np.int64)
    order = np.argsort(names, kind="stable")
    head = np.concatenate([[True], names[order][1:] != names[order][:-1]])
    place = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[order] = place
    kept, step = [rank.astype(np.int32)], 1
    while step < limit:
        live = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
        if not len(live):
            break
        at = order[live]
        beyond = at + step
        key = rank[at] * (n + 1) + np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        turn = np.argsort(key, kind="stable")
        at, key = at[turn], key[turn]
        order[live] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head[live] = new
        rank[at] = np.maximum.accumulate(np.where(new, live, 0))
        step *= 2
        kept.append(rank.astype(np.int32))
    x, y = order[:-1].copy(), order[1:].copy()
    alike = np.zeros(n - 1, np.int64)
    for k in range(len(kept) - 1, -1, -1):
        live = np.flatnonzero((x < n) & (y < n))
        live = live[kept[k][x[live]] == kept[k][y[live]]]
        for move in (x, y, alike):
            move[live] += 1 << k
    return order, np.append(np.zeros(1, np.int16), np.minimum(alike, limit).astype(np.int16))


def suffix_array(text: np.ndarray, space: Space, symbols: int = 258, limit: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the suffixes of ``text`` in order, and the common prefix of each with the one before.

    ``text``: symbols from 1 to ``symbols`` - 1, then one closing 0. Common prefixes are counted up to
    ``limit``, below 2 to the power 15; suffixes that agree so far may stand in either order.
    """
    if len(text) == 1:
        return np.zeros(1, np.int32), np.zeros(1, np.int16)
    return Level(text, symbols, limit, space).sort()


def repeated_windows(suffixes: np.ndarray, common: np.ndarray, width: int, space: Space) -> np.ndarray:
    """Whether the ``width`` symbols from each position begin elsewhere too: one of its suffix's neighbours has them."""
    n = len(suffixes)
    found = space.array(n, bool)
    for a, b in space.pieces(n):
        near = np.append(common[a : b + 1] if b < n else common[a:b], [] if b < n else [0])
        found[suffixes[a:b]] = (near[:-1] >= width) | (near[1:] >= width)
    return found
