"""A suffix automaton over word sequences that knows where each substring occurs first."""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Sequence


class SuffixAutomaton:
    """Generalised: sequences are added one after the other; ``first[v]`` is the position (number of
    the sequence, end in it) at which the substrings of state ``v`` ended first in order of adding."""

    def __init__(self) -> None:
        self.next: list[dict[Hashable, int]] = [{}]
        self.length = [0]
        self.link = [-1]
        self.first: list[tuple[int, int]] = [(0, 0)]

    def _state(self, length: int, link: int, edges: dict, first: tuple[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, p: int, word: Hashable, q: int) -> int:
        """The state of the strings of q that are at most one longer than p's."""
        if self.length[q] == self.length[p] + 1:
            return q
        part = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), self.first[q])
        self.link[q] = part
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = part
            p = self.link[p]
        return part

    def add(self, number: int, words: Sequence[Hashable]) -> None:
        last = 0
        for end, word in enumerate(words, 1):
            known = self.next[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
                continue
            state, p = self._state(self.length[last] + 1, 0, {}, (number, end)), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p >= 0:
                self.link[state] = self._split(p, word, self.next[p][word])
            last = state

    def matches(self, words: Sequence[Hashable], least: int) -> Iterator[tuple[int, tuple[int, int]]]:
        """Streams words: for each end where the matching statistic reaches ``least``, that end and the
        position at which the last ``least`` words ended first."""
        state, size = 0, 0
        for end, word in enumerate(words, 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                size += 1
            if size >= least:
                size = least
                while self.length[self.link[state]] >= least:
                    state = self.link[state]
                yield end, self.first[state]
