"""An online suffix automaton over integer symbols that reports matching statistics as it reads."""

from __future__ import annotations


class SuffixAutomaton:
    """Holds all substrings of the texts read so far. ``extend`` appends a symbol to the current text and
    returns its matching statistic: the length of the longest suffix of the current text that had been
    read before (in an earlier text, or ending earlier in this one)."""

    def __init__(self) -> None:
        self._next: list[dict[int, int]] = [{}]
        self._link = [-1]
        self._length = [0]
        self._last = 0

    def start(self) -> None:
        """Begin another text; no match crosses from one text into the next."""
        self._last = 0

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The state of the longest string of ``p`` followed by ``symbol``, split off ``q`` if need be."""
        length = self._length[p] + 1
        if self._length[q] == length:
            return q
        state = len(self._next)
        self._next.append(dict(self._next[q]))
        self._link.append(self._link[q])
        self._length.append(length)
        self._link[q] = state
        while p >= 0 and self._next[p].get(symbol) == q:
            self._next[p][symbol] = state
            p = self._link[p]
        return state

    def extend(self, symbol: int) -> int:
        p = self._last
        known = self._next[p].get(symbol)
        if known is not None:
            self._last = self._split(p, symbol, known)
            return self._length[self._last]
        state = len(self._next)
        self._next.append({})
        self._link.append(0)
        self._length.append(self._length[p] + 1)
        while p >= 0 and symbol not in self._next[p]:
            self._next[p][symbol] = state
            p = self._link[p]
        if p >= 0:
            self._link[state] = self._split(p, symbol, self._next[p][symbol])
        self._last = state
        return self._length[self._link[state]]
