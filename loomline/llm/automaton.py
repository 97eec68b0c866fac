"""Generalised suffix automaton over sequences of integers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class SuffixAutomaton:
    """States hold the longest length, the suffix link and the transitions. State 0 is the empty string."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.len: list[int] = [0]

    def extend(self, last: int, c: int) -> int:
        """The state of the current sequence with c after it; sequences share states where they agree."""
        nxt, link, length = self.next, self.link, self.len
        q = nxt[last].get(c)
        if q is not None:
            if length[q] == length[last] + 1:
                return q
            return self._split(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def add(self, sequence: Iterable[int]) -> int:
        state = 0
        for c in sequence:
            state = self.extend(state, c)
        return state

    def prefixes(self, sequence: Iterable[int]) -> Iterator[int]:
        """States of the prefixes of a sequence that was added."""
        state = 0
        for c in sequence:
            state = self.next[state][c]
            yield state

    def matches(self, sequence: Iterable[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest match that ends at each place."""
        nxt, link, length = self.next, self.link, self.len
        state = n = 0
        for c in sequence:
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            to = nxt[state].get(c)
            if to is None:
                n = 0
            else:
                state = to
                n += 1
            yield state, n

    def holding(self, state: int, n: int) -> int:
        """The state that holds the suffix of length n of a state's strings."""
        link, length = self.link, self.len
        while length[link[state]] >= n:
            state = link[state]
        return state
