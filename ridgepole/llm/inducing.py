"""External induced sorting of suffixes with common-prefix values, for one shard of text.

The suffixes of a text are sorted from the S* suffixes (smaller than the suffix to their
right, to the right of a larger one).  The substrings between S* positions are sorted and
named, and the text of names, at most half as long, is sorted by recursion, until it fits
into memory and is sorted there by doubling.  Then two
scans induce the rest: upwards the suffixes larger than their right neighbour, downwards
the smaller ones.  A scan takes suffix tuples (position, common prefix with the tuple
before, length of the run of its first symbol) in order from a queue and puts the suffix
one place to the left back into it.  The common prefix of two tuples put under the same
symbol is one more than the least value the scan has met since the first of them.

The queue hands out tuples in bulk: the largest head that gets nothing new from its own
tuples.  It is a list of sorted runs, merged as they grow and kept in files beyond
``IN_MEMORY`` tuples; text, names, positions and results are files too.  So memory follows
the size of a batch, not of the shard.  Values stop at ``cap``.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Tuples of a run that stay in memory, and tuples of one step.
IN_MEMORY = 1 << 19
STEP = 1 << 18

_FAR = np.int64(1) << np.int64(62)


class Disk:
    """Arrays in a folder of the running task; small ones stay in memory."""

    def __init__(self, folder: str):
        self.folder = folder

    def array(self, n: int, kind) -> np.ndarray:
        if n <= IN_MEMORY:
            return np.empty(n, kind)
        handle, path = tempfile.mkstemp(dir=self.folder)
        os.close(handle)
        out = np.memmap(path, kind, "w+", shape=(n,))
        os.unlink(path)  # the space is given back with the array
        return out


class Queue:
    """A priority queue of tuples (key, position, common prefix, run); equal keys in order of arrival."""

    KINDS = (np.int64, np.int64, np.uint8, np.uint8)

    def __init__(self, disk: Disk, seeds: tuple[np.ndarray, ...]):
        self._disk = disk
        self._runs: list[list] = []  # [columns, cursor]; the first holds the seeds
        self._runs.append([seeds, 0])

    def push(self, columns: tuple[np.ndarray, ...]) -> None:
        """Columns sorted by key."""
        self._runs.append([columns, 0])
        while len(self._runs) > 2 and 2 * self._left(-1) >= self._left(-2):
            (b, at_b), (a, at_a) = self._runs.pop(), self._runs.pop()
            if at_a == len(a[0]):
                self._runs.append([b, at_b])
                continue
            order = np.argsort(np.concatenate([a[0][at_a:], b[0][at_b:]]), kind="stable")
            merged = []
            for x, y, kind in zip(a, b, self.KINDS):
                out = self._disk.array(len(order), kind)
                out[:] = np.concatenate([x[at_a:], y[at_b:]])[order]
                merged.append(out)
            self._runs.append([tuple(merged), 0])

    def _left(self, i: int) -> int:
        columns, at = self._runs[i]
        return len(columns[0]) - at

    def head(self, want: int):
        """About ``want`` first tuples, whole keys only, and the key after which they end (None: a part of one key)."""
        live = [r for r in self._runs if r[1] < len(r[0][0])]
        self._runs[1:] = [r for r in self._runs[1:] if r[1] < len(r[0][0])]
        if not live:
            return None
        low = min(int(r[0][0][r[1]]) for r in live)
        bound = min((int(r[0][0][r[1] + want]) for r in live if r[1] + want < len(r[0][0])), default=int(_FAR))
        bound = max(low, bound)
        ends = [int(np.searchsorted(r[0][0][r[1] :], bound, side="right")) + r[1] for r in live]
        if sum(e - r[1] for e, r in zip(ends, live)) > STEP and bound > low:
            bound = low
            ends = [int(np.searchsorted(r[0][0][r[1] :], bound, side="right")) + r[1] for r in live]
        if (total := sum(e - r[1] for e, r in zip(ends, live))) > STEP:
            ends, room = [], STEP  # one key has more: its oldest tuples
            for r in live:
                there = int(np.searchsorted(r[0][0][r[1] :], low, side="right"))
                ends.append(r[1] + min(there, room))
                room -= ends[-1] - r[1]
            bound = None
        del total
        columns = [np.concatenate([np.asarray(r[0][i][r[1] : e]) for r, e in zip(live, ends)]) for i in range(4)]
        if bound is None:
            for r, e in zip(live, ends):
                r[1] = e
            return columns, None
        order = np.argsort(columns[0], kind="stable")
        return [c[order] for c in columns], bound

    def advance(self, key: int) -> None:
        for r in self._runs:
            r[1] += int(np.searchsorted(r[0][0][r[1] :], key, side="right"))


def _range_least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of values[first..last], by a table of powers of two."""
    span = last - first + 1
    level = np.floor(np.log2(span)).astype(np.int64)
    out = np.empty(len(first), values.dtype)
    table, width = values, 1
    for k in range(int(level.max()) + 1 if len(level) else 0):
        mine = level == k
        if mine.any():
            out[mine] = np.minimum(table[first[mine]], table[last[mine] - width + 1])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
            width *= 2
    return out


def _induce(disk: Disk, text: np.ndarray, sigma: int, down: bool, seeds: tuple[np.ndarray, ...], cap: int, emit) -> None:
    """One scan.  Keys: twice a symbol's place in scan order, plus 1 for a seed."""
    queue = Queue(disk, seeds)
    last_put = disk.array(sigma, np.int64)
    last_put[:] = -1
    last_under = np.full(cap + 1, -1, np.int64)  # for each value, the last step whose common prefix is not above it
    at, want = 0, 1024
    before = (-1, 0, 0)  # symbol place, seed or not, run of the tuple before
    while (head := queue.head(want)) is not None:
        (key, pos, lcp, run), bound = head
        seed, own = (key & 1).astype(bool), key >> 1
        left = text[np.maximum(pos - 1, 0)].astype(np.int64)
        place = sigma - 1 - left if down else left
        goes = (pos > 0) & ((place > own) | ((place == own) & ~seed))
        if bound is not None:
            new = np.minimum.accumulate(np.where(goes, 2 * place, _FAR))
            ends = np.append(np.flatnonzero(key[1:] != key[:-1]), len(key) - 1)
            ends = ends[new[ends] >= key[ends]]
            n = int(ends[-1]) + 1
            queue.advance(int(key[n - 1]))
            want = min(STEP, max(64, 2 * want if n == len(key) else 2 * n))
            key, pos, lcp, run, seed, own, place, goes = (x[:n] for x in (key, pos, lcp, run, seed, own, place, goes))
        # common prefix with the tuple before
        n = len(pos)
        earlier = np.concatenate([[before[0]], own[:-1]])
        earlier_seed = np.concatenate([[bool(before[1])], seed[:-1]])
        earlier_run = np.concatenate([[before[2]], run[:-1]]).astype(np.uint8)
        seam = np.where(seed & ~earlier_seed, np.minimum(run, earlier_run), lcp)
        lcp = np.where(own == earlier, seam, 0).astype(np.uint8)
        before = (int(own[-1]), int(seed[-1]), int(run[-1]))
        emit(pos, own, seed, lcp, run)
        # what goes back into the queue, symbol by symbol
        i = np.flatnonzero(goes)
        if len(i):
            i = i[np.argsort(place[i], kind="stable")]
            where = place[i]
            fresh = np.ones(len(i), bool)
            fresh[1:] = where[1:] != where[:-1]
            since = np.empty(len(i), np.int64)
            since[~fresh] = i[:-1][~fresh[1:]] + 1
            since[fresh] = 0
            least = _range_least(lcp, since, i).astype(np.int64)
            old = last_put[where[fresh]]
            carried = np.minimum(np.searchsorted(last_under, old, side="right"), cap)
            least[fresh] = np.where(old < 0, -1, np.minimum(least[fresh], carried))
            last_put[where[np.append(fresh[1:], True)]] = at + i[np.append(fresh[1:], True)]
            same = where == own[i]
            runs = np.where(same, np.minimum(run[i].astype(np.int64) + 1, cap), 1)
            queue.push((2 * where, pos[i] - 1, np.minimum(least + 1, cap).astype(np.uint8), runs.astype(np.uint8)))
        latest = np.full(cap + 1, -1, np.int64)
        latest[lcp] = at + np.arange(n)
        np.maximum(last_under, np.maximum.accumulate(latest), out=last_under)
        at += n


def _types(disk: Disk, text: np.ndarray) -> np.ndarray:
    """S* positions in order."""
    n, found = len(text), []
    right_symbol, right_smaller = -1, True  # of the place to the right: its symbol, and whether its suffix is an S
    for high in range(n, 0, -STEP):
        low = max(0, high - STEP)
        part = np.asarray(text[low:high]).astype(np.int64)
        after = np.append(part[1:], right_symbol)
        step = np.sign(after - part)
        if high == n:
            step[-1] = 1  # the sentinel is an S
        # equal neighbours take the type of the next unequal place
        known = np.where(step != 0, np.arange(len(part)), len(part))
        source = np.minimum.accumulate(known[::-1])[::-1]
        small = np.append(step > 0, right_smaller)[source]
        found.append((low, small))
        right_symbol, right_smaller = int(part[0]), bool(small[0])
    places, last = [], True
    for low, small in reversed(found):
        star = small & ~np.concatenate([[last], small[:-1]])
        places.append(np.flatnonzero(star) + low)
        last = bool(small[-1])
    stars = np.concatenate(places)
    out = disk.array(len(stars), np.int64)
    out[:] = stars
    return out


def _words(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, skip: int) -> np.ndarray:
    """The next symbols of substrings as numbers that sort like them; a substring's end sorts last."""
    bits, count = (8, 7) if text.dtype == np.uint8 else (31, 2)
    out = np.zeros(len(starts), np.int64)
    end, limit = (1 << bits) - 1, len(text) - 1
    for k in range(skip, skip + count):
        symbol = text[np.minimum(starts + k, limit)].astype(np.int64)
        out = (out << bits) | np.where(k < lengths, symbol, end)
    return out


def _names(disk: Disk, text: np.ndarray, stars: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for each S* substring, in the order of the substrings, equal for equal ones."""
    count = len(stars)
    width = 7 if text.dtype == np.uint8 else 2
    lengths = np.append(np.diff(stars) + 1, 1)
    group = disk.array(count, np.int64)
    group[:] = 0
    live, skip = np.arange(count), 0
    while len(live):
        word = _words(text, stars[live], lengths[live], skip)
        skip += width
        order = np.lexsort((word, group[live]))
        g, w, at = group[live][order], word[order], live[order]
        turn = np.ones(len(at), bool)
        turn[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1])
        # a group's number is the count of substrings before it, so parts of a group stay between its neighbours
        first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        offset = np.arange(len(at)) - first[np.cumsum(np.append(True, g[1:] != g[:-1])) - 1]
        starts = np.flatnonzero(turn)
        group[at] = g + offset[starts][np.cumsum(turn) - 1]
        sizes = np.diff(np.append(starts, len(at)))
        longer = np.maximum.reduceat(lengths[at], starts) > skip
        live = at[np.repeat((sizes > 1) & longer, sizes)]
        live.sort()
    used = np.unique(group)
    names = disk.array(count, np.uint32)
    names[:] = np.searchsorted(used, group)
    return names, len(used)


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of suffixes that agree on their first ``known`` symbols."""
    out = np.minimum(known, cap)
    live, limit = np.flatnonzero(out < cap), len(text) - 1
    while len(live):
        at = out[live]
        x, y = a[live] + at, b[live] + at
        same = (x <= limit) & (y <= limit) & (text[np.minimum(x, limit)] == text[np.minimum(y, limit)])
        live = live[same]
        out[live] += 1
        live = live[out[live] < cap]
    return out.astype(np.uint8)


class _Sequence:
    """Columns that grow batch by batch; kept in files once they are large."""

    def __init__(self, disk: Disk, kinds):
        self._disk, self._kinds, self._parts, self._held, self._n = disk, kinds, [], 0, 0

    def add(self, *columns: np.ndarray) -> None:
        self._parts.append([np.asarray(c).astype(k) for c, k in zip(columns, self._kinds)])
        self._held += len(columns[0])
        self._n += len(columns[0])
        if self._held > IN_MEMORY:
            self._fold()

    def _fold(self) -> None:
        folded = [p for p in self._parts if isinstance(p, tuple)]
        rest = [p for p in self._parts if not isinstance(p, tuple)]
        if rest:
            n = sum(len(p[0]) for p in rest)
            columns = []
            for i, kind in enumerate(self._kinds):
                out = self._disk.array(n, kind)
                out[:] = np.concatenate([p[i] for p in rest])
                columns.append(out)
            folded.append(tuple(columns))
        self._parts, self._held = folded, 0

    def columns(self) -> list[np.ndarray]:
        out = [self._disk.array(self._n, kind) for kind in self._kinds]
        at = 0
        for part in self._parts:
            for o, c in zip(out, part):
                o[at : at + len(c)] = c
            at += len(part[0])
        return out


def _doubled(names: np.ndarray, distinct: int) -> np.ndarray:
    """Suffixes of a text in memory in order, by doubling the length they are sorted by."""
    n = len(names)
    rank = np.asarray(names).astype(np.int64)
    starts = np.cumsum(np.bincount(rank, minlength=distinct))
    rank = np.concatenate([[0], starts[:-1]])[rank]  # how many suffixes are sure to come before
    live = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    reach = 1
    while len(live):
        ahead = live + reach
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        order = np.lexsort((second, rank[live]))
        at, first, second = live[order], rank[live][order], second[order]
        group = np.append(True, first[1:] != first[:-1])
        turn = group | np.append(True, second[1:] != second[:-1])
        place = np.arange(len(at))
        offset = place - place[group][np.cumsum(group) - 1]
        rank[at] = first + offset[turn][np.cumsum(turn) - 1]
        sizes = np.diff(np.append(np.flatnonzero(turn), len(at)))
        live = at[np.repeat(sizes > 1, sizes)]
        reach *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def sorted_suffixes(disk: Disk, text: np.ndarray, sigma: int, cap: int, emit) -> None:
    """Call ``emit(positions, common prefixes)`` batch by batch, from the largest suffix to the smallest.

    ``text`` ends in its only 0, the least symbol; a common prefix is that with the suffix
    emitted before, up to ``cap`` (under 255).
    """
    n = len(text)
    if n == 1:
        emit(np.zeros(1, np.int64), np.zeros(1, np.uint8))
        return
    stars = _types(disk, text)
    names, distinct = _names(disk, text, stars)
    m = len(stars)
    order, common = disk.array(m, np.int64), disk.array(m, np.uint8)
    if distinct == m:
        order[names] = np.arange(m)
        common[:] = 0
    elif m <= IN_MEMORY:
        order[:] = _doubled(names, distinct)
        common[0] = 0
        common[1:] = _common(names, order[:-1], order[1:], np.zeros(m - 1, np.int64), cap)
    else:
        filled = m

        def take(pos: np.ndarray, lcp: np.ndarray) -> None:
            nonlocal filled
            k = len(pos)
            order[filled - k : filled] = pos[::-1]
            # given with the larger neighbour, kept with the smaller one
            keep = lcp[::-1]
            high = min(filled + 1, m)
            common[filled - k + 1 : high] = keep[: high - (filled - k + 1)]
            filled -= k

        sorted_suffixes(disk, names, distinct, cap, take)
        common[0] = 0
    seeds = [disk.array(m, kind) for kind in Queue.KINDS]
    for low in range(0, m, STEP):
        high = min(m, low + STEP)
        mine = order[low:high]
        previous = order[np.maximum(np.arange(low, high) - 1, 0)]
        shared = common[low:high].astype(np.int64)
        pos = stars[mine]
        known = stars[previous + shared] - stars[previous]
        lcp = _common(text, stars[previous], pos, known, cap)
        if low == 0:
            lcp[0] = 0
        symbol = text[pos].astype(np.int64)
        for column, values in zip(seeds, (2 * symbol + 1, pos, lcp, _runs(text, pos, cap))):
            column[low:high] = values
    larger = _Sequence(disk, Queue.KINDS)
    keep = lambda pos, own, seed, lcp, run: larger.add(own[~seed], pos[~seed], lcp[~seed], run[~seed])
    _induce(disk, text, sigma, False, tuple(seeds), cap, keep)
    symbol, pos, lcp, run = larger.columns()
    count = len(pos)
    back = [disk.array(count, kind) for kind in Queue.KINDS]
    for low in range(0, count, STEP):
        high = min(count, low + STEP)
        a, b = count - high, count - low  # the same tuples, counted from the end
        back[0][low:high] = 2 * (sigma - 1 - symbol[a:b][::-1]) + 1
        back[1][low:high] = pos[a:b][::-1]
        back[2][low:high] = np.append(lcp[a + 1 : b + 1], [0])[: b - a][::-1] if b == count else lcp[a + 1 : b + 1][::-1]
        back[3][low:high] = run[a:b][::-1]
    _induce(disk, text, sigma, True, tuple(back), cap, lambda pos, own, seed, lcp, run: emit(pos, lcp))
    emit(np.array([n - 1]), np.zeros(1, np.uint8))  # the sentinel


def _runs(text: np.ndarray, pos: np.ndarray, cap: int) -> np.ndarray:
    """How often the symbol at a position is repeated from there on."""
    out, limit = np.ones(len(pos), np.int64), len(text) - 1
    live, symbol = np.arange(len(pos)), text[pos]
    while len(live):
        at = pos[live] + out[live]
        live = live[(at <= limit) & (text[np.minimum(at, limit)] == symbol[live])]
        out[live] += 1
        live = live[out[live] < cap]
    return out.astype(np.uint8)


def repeated(text: np.ndarray, length: int, folder: str) -> np.ndarray:
    """Whether the ``length`` symbols from each position also start elsewhere in the text.

    ``text``: uint8 symbols from 1 up (a file or an array), ending in a 0 and holding no other.
    """
    disk = Disk(folder)
    flags = disk.array(len(text), np.bool_)
    flags[:] = False
    last = -1

    def take(pos: np.ndarray, lcp: np.ndarray) -> None:
        nonlocal last
        long = lcp >= length
        flags[pos[long]] = True
        earlier = np.concatenate([[last], pos[:-1]])
        flags[earlier[long]] = True
        last = int(pos[-1])

    sorted_suffixes(disk, text, 256, length, take)
    return flags
