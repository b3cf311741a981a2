"""Generalised suffix automaton over the words of many items (pure Python, plain dicts).

Built once per block of items; its states carry what ends there, so that streaming a text
yields, at every word, the longest run of words that also occurs in some item, and the item
windows that end at that word.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """``step[state]`` maps a word to the next state; ``link`` is the suffix link, ``length`` the longest run.

    ``ends[state]`` lists ``(window length, item ids)`` of all windows that are suffixes of the state's runs.
    """

    def __init__(self, items: Iterable[tuple[object, Sequence[bytes]]], window: int):
        self.step: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        items = [(i, w) for i, w in items if w]
        self.shortest = min((min(window, len(w)) for _, w in items), default=0)
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        own: dict[int, dict[int, set]] = {}
        for item, words in items:
            k = min(window, len(words))
            for at in range(len(words) - k + 1):
                state = 0
                for w in words[at : at + k]:
                    state = self.step[state][w]
                own.setdefault(state, {}).setdefault(k, set()).add(item)
        self.ends: list[tuple | None] = [None] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            found = tuple((k, frozenset(own[state][k])) for k in sorted(own[state])) if state in own else ()
            above = self.ends[self.link[state]] or ()
            self.ends[state] = (found + above) or None

    def _state(self, length: int) -> int:
        self.step.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, p: int, q: int, w: bytes) -> int:
        """The part of state ``q`` that ends after ``p`` becomes a state of its own."""
        part = self._state(self.length[p] + 1)
        self.step[part] = dict(self.step[q])
        self.link[part] = self.link[q]
        self.link[q] = part
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = part
            p = self.link[p]
        return part

    def _extend(self, last: int, w: bytes) -> int:
        q = self.step[last].get(w)
        if q is not None:  # the run is already known from an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def search(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged runs of words covered by item windows, as ``(first, end)``, and the items found.

        A word that no item has takes the automaton back to its root, so only the stretches
        between such words are walked, and of those only the ones that have room for a window.
        """
        runs: list[tuple[int, int]] = []
        items: set = set()
        if not self.shortest:
            return runs, items
        known = self.step[0]
        strange = [i for i, w in enumerate(words) if w not in known]
        strange.append(len(words))
        last = -1
        for at in strange:
            if at - last > self.shortest:
                self._walk(words, last + 1, at, runs, items)
            last = at
        return runs, items

    def _walk(self, words: Sequence[bytes], first: int, end: int, runs: list[tuple[int, int]], items: set) -> None:
        step, link, length, ends = self.step, self.link, self.length, self.ends
        state = matched = 0
        for i in range(first, end):
            w = words[i]
            here = step[state]
            if w in here:
                matched += 1
            else:
                while w not in step[state]:  # the root has every word of a stretch
                    state = link[state]
                matched = length[state] + 1
                here = step[state]
            state = here[w]
            if ends[state] is None:
                continue
            longest = 0
            for k, of in ends[state]:
                if k <= matched:
                    longest = max(longest, k)
                    items |= of
            if longest:
                a = i + 1 - longest
                while runs and runs[-1][1] >= a:
                    a = min(a, runs.pop()[0])
                runs.append((a, i + 1))
