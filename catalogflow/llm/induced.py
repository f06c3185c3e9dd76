"""External induced sorting of the suffixes of many short strings, with common-prefix values.

The strings lie in one array of symbols, each closed by a 0; zeros are ordered by place and equal to none. Sorting goes the
induced way: suffixes that start a valley (smaller than both neighbours, ``seeds``) are sorted first, by sorting the substrings
between them with the same induction and naming equal ones; the string of names, a third as long at most, is sorted in memory by doubling
(``order_of``), not by another level of induction. Then one pass up the symbols derives all suffixes larger than their successor and one pass down all smaller ones.

A pass is a priority queue whose entries arrive in order: for each symbol a first-in-first-out list of blocks (place, common
prefix with the entry before it). Blocks go to a scratch file when those in memory pass a limit, so the queues may
be far larger than memory; the text may be a memory-mapped file. The common prefix of two entries pushed one after the other is one more
than the smallest common prefix between their inducers, found by range minima inside a block and a running minimum across blocks.
"""

from __future__ import annotations

import tempfile
from collections import deque

import numpy as np

SYMBOLS = 257
BLOCK = 1 << 16


class Queues:
    """One first-in-first-out list of (place, common prefix) blocks per symbol, spilled to a scratch file beyond ``limit`` bytes."""

    def __init__(self, limit: int, scratch: str | None = None):
        self.lists = [deque() for _ in range(SYMBOLS)]
        self.limit, self.held, self.file, self.scratch = limit, 0, None, scratch

    def push(self, symbol: int, places: np.ndarray, common: np.ndarray) -> None:
        for at in range(0, len(places), BLOCK):
            block = (places[at:at + BLOCK], common[at:at + BLOCK])
            self.lists[symbol].append(block)
            self.held += 12 * len(block[0])
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=self.scratch)
        self.file.seek(0, 2)
        for blocks in self.lists:
            for k, block in enumerate(blocks):
                if isinstance(block[0], np.ndarray):
                    at, n = self.file.tell(), len(block[0])
                    self.file.write(block[0].astype(np.int64).tobytes())
                    self.file.write(block[1].astype(np.int32).tobytes())
                    blocks[k] = (at, n)
        self.held = 0

    def _load(self, block) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(block[0], np.ndarray):
            self.held -= 12 * len(block[0])
            return block
        at, n = block
        self.file.seek(at)
        return np.frombuffer(self.file.read(8 * n), np.int64), np.frombuffer(self.file.read(4 * n), np.int32)

    def pop(self, symbol: int, last: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The first (or last) entries of a symbol: small blocks that lie side by side come as one."""
        blocks, found, size = self.lists[symbol], [], 0
        while blocks and size < BLOCK:
            found.append(self._load(blocks.pop() if last else blocks.popleft()))
            size += len(found[-1][0])
        if last:
            found.reverse()
        return found[0] if len(found) == 1 else tuple(np.concatenate(x) for x in zip(*found))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _words(text: np.ndarray) -> np.ndarray:
    """The four symbols from each place on as one number; the text must end in three spare symbols."""
    return np.ndarray((len(text) - 3,), "<u8", text, strides=(text.itemsize,))


class Sorter:
    def __init__(self, text: np.ndarray, limit: int, scratch: str | None = None):
        """``text``: uint16 symbols, 0 after each string, three more zeros at the end (which are no strings)."""
        self.text, self.n, self.limit, self.scratch = text, len(text) - 3, limit, scratch
        self.words = _words(text)
        t = text[:self.n]
        self.ends = np.flatnonzero(t == 0)
        # larger than its successor or not: a run of equal symbols follows the first unequal one, a 0 is always smaller
        step = np.empty(self.n, np.int8)
        step[:-1] = np.sign(t[:-1].astype(np.int32) - t[1:].astype(np.int32))
        step[-1] = -1
        step[self.ends] = -1
        known = np.where(step != 0, np.arange(self.n, dtype=np.int32), np.int32(self.n))
        nearest = np.minimum.accumulate(known[::-1])[::-1]
        larger = step[np.minimum(nearest, self.n - 1)] > 0
        before = np.concatenate([[False], larger[:-1]])
        self.seeds = np.flatnonzero(~larger & before)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of suffix pairs, from the text; it ends where either string does."""
        rest = np.minimum(self.ends[np.searchsorted(self.ends, a)] - a, self.ends[np.searchsorted(self.ends, b)] - b)
        out = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        while len(open_):
            x, y, done = a[open_], b[open_], out[open_]
            differ = self.words[x + done] ^ self.words[y + done]
            same = np.where(differ == 0, 4, 0)
            part = np.flatnonzero(differ)
            if len(part):
                low = differ[part] & (~differ[part] + np.uint64(1))
                same[part] = np.log2(low.astype(np.float64)).astype(np.int64) // 16
            out[open_] = np.minimum(done + same, rest[open_])
            open_ = open_[(same == 4) & (out[open_] < rest[open_])]
        return out

    def _spread(self, queues: Queues, places: np.ndarray, common: np.ndarray, symbol: int, up: bool, state) -> None:
        """Push the predecessors that are larger (up) or smaller (down) than the block's suffixes to their symbols."""
        keep = np.flatnonzero(places > 0)
        before = self.text[places[keep] - 1]
        good = (before >= symbol) if up else ((before <= symbol) & (before > 0))
        keep, before = keep[good], before[good]
        track = state is not None
        if track:
            running, pushed = state
            soonest = np.minimum.accumulate(common)
        if len(keep):
            order = np.argsort(before, kind="stable")
            at, of = keep[order], before[order].astype(np.int64)
            heads = np.flatnonzero(np.diff(of, prepend=-1))
            if track:
                value = np.empty(len(at), np.int64)
                value[heads] = np.where(pushed[of[heads]], 1 + np.minimum(running[of[heads]], soonest[at[heads]]), 0)
                inner = np.ones(len(at), bool)
                inner[heads] = False
                inner = np.flatnonzero(inner)
                if len(inner):
                    value[inner] = 1 + _range_min(common, at[inner - 1] + 1, at[inner] + 1)
            else:
                value = np.zeros(len(at), np.int64)
            moved = places[at] - 1
            stops = np.append(heads[1:], len(at))
            for head, stop in zip(heads.tolist(), stops.tolist()):
                queues.push(int(of[head]), moved[head:stop], value[head:stop])
        if track and len(common):
            np.minimum(running, soonest[-1], out=running)
            if len(keep):
                latest = np.minimum.accumulate(common[::-1])[::-1]
                last = at[stops - 1]
                running[of[heads]] = np.where(last + 1 < len(common), latest[np.minimum(last + 1, len(common) - 1)], _FAR)
                pushed[of[heads]] = True

    def induce(self, seeds: np.ndarray, seed_common: np.ndarray | None, emit) -> None:
        """Both passes from the seeds in their order by first symbol; ``emit(places, common)`` gets all suffixes downwards.

        Without ``seed_common`` no common prefixes are followed.
        """
        track = seed_common is not None
        firsts = np.searchsorted(self.text[seeds], np.arange(SYMBOLS + 1))
        state = (np.full(SYMBOLS, _FAR, np.int64), np.zeros(SYMBOLS, bool)) if track else None
        larger, ups = Queues(self.limit, self.scratch), Queues(self.limit, self.scratch)
        for c in range(SYMBOLS):
            last = None
            while larger.lists[c]:
                places, common = larger.pop(c)
                ups.push(c, places, common)
                self._spread(larger, places, common, c, True, state)
                last = places[-1:]
            lo, hi = firsts[c], firsts[c + 1]
            for at in range(lo, hi, BLOCK):
                places = seeds[at:min(hi, at + BLOCK)]
                common = np.zeros(len(places), np.int64)
                if track:
                    common[:] = seed_common[at:at + len(places)]
                    if at == lo:
                        common[0] = 0 if last is None else self.common(last, places[:1])[0]
                self._spread(larger, places, common, c, True, state)
        larger.close()
        state = (np.full(SYMBOLS, _FAR, np.int64), np.zeros(SYMBOLS, bool)) if track else None
        smaller = Queues(self.limit, self.scratch)
        for c in range(SYMBOLS - 1, 0, -1):
            last = None
            while smaller.lists[c]:
                places, common = smaller.pop(c)
                emit(places, common)
                self._spread(smaller, places, common, c, False, state)
                last = places[-1:]
            following = None
            while ups.lists[c]:
                places, common = ups.pop(c, last=True)
                places = places[::-1]
                # downwards, an entry's common prefix is with the larger one before it
                down = np.empty(len(places), np.int64)
                down[1:] = common[:0:-1]
                if following is not None:
                    down[0] = following
                else:
                    down[0] = self.common(last, places[:1])[0] if track and last is not None else 0
                following = common[0]
                emit(places, down)
                self._spread(smaller, places, down, c, False, state)
        smaller.close()
        ups.close()

    def sorted_seeds(self) -> np.ndarray:
        """Places of the seeds in the order of their suffixes."""
        seeds = self.seeds
        by_symbol = seeds[np.argsort(self.text[seeds], kind="stable")]
        number = np.full(self.n + 1, -1, np.int32)
        number[seeds] = np.arange(len(seeds))
        found: list[np.ndarray] = []

        def keep(places: np.ndarray, _) -> None:
            found.append(number[places[number[places] >= 0]])

        self.induce(by_symbol, None, keep)
        order = np.concatenate([np.flatnonzero(self.text[seeds] == 0), np.concatenate(found)[::-1] if found else np.empty(0, np.int64)]).astype(np.int64)
        # equal substrings (up to the next seed, included) get equal names; those of zeros are all different
        size = np.append(np.diff(seeds), 1)[order]
        start = seeds[order]
        same = np.zeros(len(order), bool)
        like = np.flatnonzero((size[1:] == size[:-1]) & (self.text[start[1:]] != 0)) + 1
        same[like] = self.common(start[like - 1], start[like]) > size[like]
        # a substring that ends in a 0 ends its string: it equals another only without that 0, so it never does
        names = np.empty(len(order), np.int64)
        names[order] = np.cumsum(~same) - 1
        return seeds[order_of(names)]


_FAR = 1 << 30


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Smallest of values[lo:hi] for each pair, lo < hi, from minima over powers of two."""
    out = np.empty(len(lo), np.int64)
    level = np.log2(hi - lo).astype(np.int64)
    table, width = values, 1
    for k in range(int(level.max()) + 1):
        pick = np.flatnonzero(level == k)
        out[pick] = np.minimum(table[lo[pick]], table[hi[pick] - width])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


def order_of(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: those that are still alike are told apart by twice as many names each time."""
    rank, reach, n = names, 1, len(names)
    order = np.argsort(rank, kind="stable")
    while n and rank[order[-1]] != n - 1:
        after = np.zeros(n, np.int64)
        after[:-reach or None] = rank[reach:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.diff(key[order], prepend=-1) != 0) - 1
        reach *= 2
    return order


def repeats(text: np.ndarray, length: int, limit: int = 256 << 20, scratch: str | None = None) -> np.ndarray:
    """True at each place whose ``length`` symbols, inside one string, also start at an earlier place."""
    flags = np.zeros(len(text), bool)
    sorter = Sorter(text, limit, scratch)
    if not len(sorter.seeds):
        return flags
    seeds = sorter.sorted_seeds()
    common = np.zeros(len(seeds), np.int64)
    common[1:] = sorter.common(seeds[:-1], seeds[1:])
    first = [-1]  # earliest place of the run that the last block ended in

    def emit(places: np.ndarray, common: np.ndarray) -> None:
        new = common < length
        starts = np.flatnonzero(new)
        if not len(starts) or starts[0]:
            stop = starts[0] if len(starts) else len(places)
            run = np.append(places[:stop], first[0])
            flags[run] = True
            first[0] = run.min()
            flags[first[0]] = False
        if len(starts):
            least = np.minimum.reduceat(places, starts)
            sizes = np.diff(np.append(starts, len(places)))
            body = places[starts[0]:]
            flags[body] = body != np.repeat(least, sizes)
            first[0] = int(least[-1])

    sorter.induce(seeds, common, emit)
    return flags
