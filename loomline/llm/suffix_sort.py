"""Suffixes of a text on disk in sorted order, with common-prefix lengths, by induced sorting.

The text's leftmost smaller-type suffixes are ranked first: their substrings get
names, and the string of names is ranked by refining groups of equal rank, with
twice as many names each round. Then larger-type suffixes are induced in ascending and
smaller-type ones in descending order. A queue a symbol holds what is to come:
suffixes arrive in the order in which they are read, so the queue of all symbols
together is a priority queue by symbol and rank. Its entries are a suffix's place and
its common prefix with the entry before it, which is one more than the least
common prefix among the suffixes read between the two that induced them.

Order and common prefixes are exact up to a cap; beyond it suffixes count as
equal. Everything whose size follows the text's lies in files that grow past a
bounded buffer; what is sorted passes through sorted runs that are merged.

Symbols are 0 to 254. The text ends with 0, and no two 0 stand together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np

#: Entries that are handled at a time.
CHUNK = 1 << 19
#: Rows that a spool holds before they go to its files.
HELD = 1 << 16
PAD = 0xFF


class Spool:
    """Rows of a few columns, appended and read in order; past a bounded buffer they lie in a file a column."""

    def __init__(self, folder: Path, name: str, kinds: tuple, held: int | None = None):
        self.paths = [folder / f"{name}.{i}" for i in range(len(kinds))]
        self.kinds, self.held = [np.dtype(k) for k in kinds], HELD if held is None else held
        self.parts: list[tuple] = []
        self.waiting = self.written = self.taken = 0

    def __len__(self) -> int:
        return self.written + self.waiting

    def append(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.parts.append(columns)
            self.waiting += len(columns[0])
            if self.waiting > self.held:
                self.flush()

    def flush(self) -> None:
        for i, path in enumerate(self.paths):
            with path.open("ab") as f:
                for part in self.parts:
                    f.write(np.ascontiguousarray(part[i], self.kinds[i]).tobytes())
        self.written += self.waiting
        self.parts, self.waiting = [], 0

    def read(self, start: int, end: int) -> list[np.ndarray]:
        if start >= self.written and self.parts:
            at = [start - self.written, end - self.written]
            if len(self.parts) > 1:
                self.parts = [tuple(np.concatenate([p[i] for p in self.parts]) for i in range(len(self.kinds)))]
            return [self.parts[0][i][at[0] : at[1]].astype(k, copy=False) for i, k in enumerate(self.kinds)]
        if self.parts and end > self.written:
            self.flush()
        return [np.fromfile(p, k, end - start, offset=start * k.itemsize) if end > start else np.empty(0, k) for p, k in zip(self.paths, self.kinds)]

    def take(self) -> list[np.ndarray] | None:
        """The next rows that weren't taken, or None."""
        if self.taken >= len(self):
            return None
        end = min(len(self), self.taken + CHUNK)
        if self.taken < self.written:
            end = min(end, self.written)
        out = self.read(self.taken, end)
        self.taken = end
        return out

    def forward(self) -> Iterator[list[np.ndarray]]:
        if self.written:
            self.flush()
        for start in range(0, len(self), CHUNK):
            yield self.read(start, min(len(self), start + CHUNK))

    def backward(self) -> Iterator[list[np.ndarray]]:
        for end in range(len(self), 0, -CHUNK):
            yield [c[::-1] for c in self.read(max(0, end - CHUNK), end)]

    def drop(self) -> None:
        self.parts = []
        for path in self.paths:
            path.unlink(missing_ok=True)


def merged_sort(folder: Path, name: str, chunks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, value) chunks in order of key: sorted runs, merged by blocks."""
    runs: list[Spool] = []
    for key, value in chunks:
        order = np.argsort(key, kind="stable")
        run = Spool(folder, f"{name}{len(runs)}", (np.uint64, np.int64), CHUNK)
        run.append(key[order], value[order])
        runs.append(run)
        if len(runs) > 1:  # a single run stays in memory
            runs[-2].flush()
            run.flush()
    block = max(256, CHUNK // max(1, len(runs)))
    places = [0] * len(runs)
    heads: list = [None] * len(runs)
    while True:
        for i, run in enumerate(runs):
            if heads[i] is None and places[i] < len(run):
                end = min(len(run), places[i] + (block if len(runs) > 1 else len(run)))
                heads[i] = run.read(places[i], end)
                places[i] = end
        live = [i for i, h in enumerate(heads) if h is not None]
        if not live:
            break
        # Up to the least last key of runs that go on, nothing smaller can come.
        bound = min((heads[i][0][-1] for i in live if places[i] < len(runs[i])), default=None)
        keys, values = [], []
        for i in live:
            key, value = heads[i]
            n = len(key) if bound is None else int(np.searchsorted(key, bound, "right"))
            keys.append(key[:n])
            values.append(value[:n])
            heads[i] = [key[n:], value[n:]] if n < len(key) else None
        key, value = np.concatenate(keys), np.concatenate(values)
        if len(live) > 1:
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        if len(key):
            yield key, value
    for run in runs:
        run.drop()


class SuffixSorter:
    """text: a file of symbols, as an array that may be a memory map. cap: the longest prefix that counts."""

    def __init__(self, text: np.ndarray, cap: int, folder: Path):
        self.t, self.n, self.cap, self.folder = text, len(text), cap, folder
        self.made = 0

    def _name(self, what: str) -> str:
        self.made += 1
        return f"{what}-{self.made}"

    def _array(self, what: str, size: int, kind: type) -> np.ndarray:
        """An array of the text's order of size: in memory while it is small, else mapped from a file."""
        if size <= CHUNK * 8:
            return np.zeros(size, kind)
        return np.lib.format.open_memmap(self.folder / self._name(what), "w+", kind, (size,))

    def starred(self) -> np.ndarray:
        """Places of the smaller-type suffixes behind a larger-type one, ascending."""
        found = Spool(self.folder, self._name("found"), (np.int64,))  # from the end
        after, small_after = -1, True  # the end counts as smaller than all
        for end in range(self.n, 0, -CHUNK):
            start = max(0, end - CHUNK)
            c = self.t[start:end].astype(np.int16)
            diff = np.diff(np.append(c, after))  # above 0: smaller type
            decided = np.where(diff != 0, np.arange(len(c)), len(c))
            nearest = np.minimum.accumulate(decided[::-1])[::-1]
            small = np.where(nearest < len(c), diff[np.minimum(nearest, len(c) - 1)] > 0, small_after)
            if end < self.n and small_after and not small[-1]:
                found.append(np.array([end], np.int64))
            found.append(np.flatnonzero(small[1:] & ~small[:-1])[::-1] + 1 + start)
            after, small_after = int(c[0]), bool(small[0])
        out = self._array("starred", len(found), np.int64)
        at = 0
        for (part,) in found.backward():
            out[at : at + len(part)] = part
            at += len(part)
        found.drop()
        return out

    def _spool(self, parts: Iterator[np.ndarray]) -> Spool:
        out = Spool(self.folder, self._name("places"), (np.int64,))
        for part in parts:
            out.append(part)
        return out

    def _refine(self, rank: np.ndarray, active: Spool, low: Callable[[np.ndarray], np.ndarray]) -> Spool:
        """Split groups of equal rank by a second key. A rank is the place of its group's first member; gives the members of groups that stay together."""
        # All keys are made and sorted into runs before the first of them comes back, so ranks can be put in place at once.
        chunks = ((rank[a].astype(np.uint64) << np.uint64(32) | low(a).astype(np.uint64), a) for (a,) in active.forward())
        kept = Spool(self.folder, self._name("places"), (np.int64,))
        seen = 0
        last_key = last_high = None
        group_at = high_at = 0
        open_ = np.empty(0, np.int64)  # the last one's group, if it stands alone so far
        for key, who in merged_sort(self.folder, self._name("refine"), chunks):
            high = key >> np.uint64(32)
            new = np.append(True if last_key is None else key[0] != last_key, key[1:] != key[:-1])
            new_high = np.append(True if last_high is None else high[0] != last_high, high[1:] != high[:-1])
            index = np.arange(seen, seen + len(key))
            first = np.maximum.accumulate(np.where(new, index, group_at))
            first_high = np.maximum.accumulate(np.where(new_high, index, high_at))
            rank[who] = high.astype(np.int64) + first - first_high
            if len(open_) and not new[0]:
                kept.append(open_)
            together = ~new
            together[:-1] |= ~new[1:]
            kept.append(who[together])
            open_ = who[-1:].copy() if new[-1] else np.empty(0, np.int64)
            seen += len(key)
            last_key, last_high, group_at, high_at = key[-1], high[-1], int(first[-1]), int(first_high[-1])
        active.drop()
        return kept

    def ranked(self, starred: np.ndarray) -> Iterator[np.ndarray]:
        """Indexes of starred suffixes in sorted order, in chunks."""
        m = len(starred)

        sizes = self._array("sizes", m, np.int64)  # to the next one, which is included
        for i in range(0, m, CHUNK):
            part = starred[i : i + CHUNK + 1]
            sizes[i : i + CHUNK] = (np.diff(part) if len(part) > CHUNK else np.diff(np.append(part, self.n))) + 1
        rank = self._array("rank", m + 1, np.int64)
        active = self._spool(np.arange(i, min(i + CHUNK, m)) for i in range(0, m, CHUNK))
        at = 0
        while len(active):

            def letters(who: np.ndarray) -> np.ndarray:
                out = np.zeros(len(who), np.uint64)
                place, size = starred[who] + at, sizes[who]
                for j in range(4):
                    inside = at + j < size
                    c = np.where(inside, self.t[np.minimum(place + j, self.n - 1)], PAD)
                    c[inside & (place + j >= self.n)] = 0
                    out = out << np.uint64(8) | c.astype(np.uint64)
                return out

            same = self._refine(rank, active, letters)
            at += 4
            active = self._spool(a[sizes[a] >= at] for (a,) in same.forward())
            same.drop()
        # Groups of equal names, from the ranks alone.
        active = self._groups(rank, m)
        span = 1
        while len(active) and span * 2 <= 2 * self.cap:
            behind = lambda who: np.where(who + span < m, rank[np.minimum(who + span, m - 1)] + 1, 0)  # noqa: B023, E731
            active = self._refine(rank, active, behind)
            span *= 2
        active.drop()
        for _, who in merged_sort(self.folder, self._name("order"), ((rank[i : min(i + CHUNK, m)].astype(np.uint64), np.arange(i, min(i + CHUNK, m))) for i in range(0, m, CHUNK))):
            yield who

    def _groups(self, rank: np.ndarray, m: int) -> Spool:
        counts = self._array("counts", m + 1, np.int32)
        for i in range(0, m, CHUNK):
            np.add.at(counts, rank[i : min(i + CHUNK, m)], 1)
        return self._spool(i + np.flatnonzero(counts[rank[i : min(i + CHUNK, m)]] > 1) for i in range(0, m, CHUNK))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of suffixes in pairs, by comparison."""
        out = np.zeros(len(a), np.int16)
        live = np.flatnonzero(np.maximum(a, b) + self.cap + 8 <= self.n)
        if len(live):
            eight = np.ndarray((self.n - 7,), "<u8", np.asarray(self.t), strides=(1,))
            for k in range(0, self.cap, 8):
                differ = eight[a[live] + k] ^ eight[b[live] + k]
                lowest = np.frexp((differ & (~differ + np.uint64(1))).astype(np.float64))[1] - 1
                out[live] = k + np.where(differ > 0, lowest >> 3, 8)
                live = live[differ == 0]
                if not len(live):
                    break
        for i in np.flatnonzero(np.maximum(a, b) + self.cap + 8 > self.n).tolist():  # the text's last ones
            x, y = (self.t[p : p + self.cap] for p in (a[i], b[i]))
            short = min(len(x), len(y))
            differ = np.flatnonzero(x[:short] != y[:short])
            out[i] = differ[0] if len(differ) else short
        return np.minimum(out, self.cap).astype(np.uint8)

    def sorted(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, common prefix with the one before) of all suffixes, in descending order."""
        starred = self.starred()
        by_symbol = [Spool(self.folder, self._name("seed"), (np.int64, np.uint8)) for _ in range(256)]
        last = None
        for who in self.ranked(starred):
            place = np.asarray(starred[who])
            before = np.concatenate(([place[0] if last is None else last], place[:-1]))
            lcp = self.common(before, place)
            if last is None:
                lcp[0] = 0
            last = place[-1]
            first = self.t[place]
            edges = np.flatnonzero(np.diff(first)) + 1
            for part, values in zip(np.split(place, edges), np.split(lcp, edges)):
                by_symbol[int(self.t[part[0]])].append(part, values)
        larger = self._induce_larger(by_symbol)
        for s in by_symbol:
            s.drop()
        yield from self._induce_smaller(larger)

    def _push(self, queues: list[Spool], carry: np.ndarray, place: np.ndarray, lcp: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> None:
        """Queue the suffixes before those just read. carry: for each symbol the least common prefix since its last entry."""
        ok = place > 0
        symbol = self.t[np.maximum(place - 1, 0)]
        chosen = np.flatnonzero(ok & wanted(symbol, self.t[np.minimum(place, self.n - 1)], place))
        if len(chosen):
            order = chosen[np.argsort(symbol[chosen], kind="stable")]
            of = symbol[order]
            start = np.append(True, of[1:] != of[:-1])
            since = np.where(start, 0, np.append(0, order[:-1] + 1))  # the least of lcp[since..order] counts
            least = _range_min(lcp, since, order)
            least[start] = np.minimum(least[start], carry[of[start]])
            entry = np.minimum(least.astype(np.int16) + 1, self.cap).astype(np.uint8)
            edges = np.flatnonzero(start)
            ends = np.append(edges[1:], len(order))
            tails = np.full(256, lcp.min(), np.uint8)
            rest = order[ends - 1] + 1
            inside = rest < len(lcp)
            tail = np.full(len(rest), 255, np.uint8)
            if inside.any():
                tail[inside] = _range_min(lcp, rest[inside], np.full(int(inside.sum()), len(lcp) - 1))
            np.minimum(carry, tails, out=carry)
            carry[of[edges]] = tail
            before = place[order] - 1
            for a, b in zip(edges.tolist(), ends.tolist()):
                queues[int(of[a])].append(before[a:b], entry[a:b])
        elif len(lcp):
            np.minimum(carry, lcp.min(), out=carry)

    def _induce_larger(self, seeds: list[Spool]) -> list[Spool]:
        queues = [Spool(self.folder, self._name("larger"), (np.int64, np.uint8)) for _ in range(256)]
        carry = np.full(256, 255, np.uint8)
        preceding = lambda symbol, own, place: symbol >= own
        # The end is the least suffix; the last symbol stands before it.
        queues[int(self.t[self.n - 1])].append(np.array([self.n - 1]), np.array([0], np.uint8))
        for c in range(256):
            first = True
            tail = -1
            while (got := queues[c].take()) is not None:
                place, lcp = got
                if first:
                    lcp = lcp.copy()
                    lcp[0] = 0
                    first = False
                self._push(queues, carry, place, lcp, preceding)
                tail = int(place[-1])
            between = True
            while (got := seeds[c].take()) is not None:
                place, lcp = got
                if between:
                    lcp = lcp.copy()
                    lcp[0] = 0 if tail < 0 else self.common(np.array([tail]), place[:1])[0]
                    between = False
                self._push(queues, carry, place, lcp, lambda symbol, own, place: symbol > own)
        return queues

    def _induce_smaller(self, larger: list[Spool]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        queues = [Spool(self.folder, self._name("smaller"), (np.int64, np.uint8)) for _ in range(256)]
        carry = np.full(256, 255, np.uint8)
        for c in range(255, -1, -1):
            first = True
            tail = -1
            while (got := queues[c].take()) is not None:
                place, lcp = got
                lcp = lcp.copy()
                if first:
                    lcp[0] = 0
                    first = False
                yield place, lcp
                self._push(queues, carry, place, lcp, lambda symbol, own, place: symbol <= own)
                tail = int(place[-1])
            queues[c].drop()
            held = None  # the common prefix of the entry read last with the one below it
            for place, lcp in larger[c].backward():
                down = np.empty_like(lcp)
                down[1:] = lcp[:-1]
                down[0] = held if held is not None else 0 if tail < 0 else self.common(np.array([tail]), place[:1])[0]
                held = lcp[-1]
                yield place, down
                self._push(queues, carry, place, down, lambda symbol, own, place: symbol < own)
            larger[c].drop()


def _range_min(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least of values[start..end], both included, by tables of doubling spans."""
    span = end - start + 1
    level = np.frexp(span.astype(np.float64))[1] - 1
    out = np.empty(len(start), values.dtype)
    table = values
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[start[at]], table[end[at] - (1 << k) + 1])
    return out
