"""Suffix arrays of many texts at once by linear grouping of Lyndon prefixes.

A suffix's Lyndon prefix is its longest prefix that is a Lyndon word; it ends where the next
smaller suffix begins.  Suffixes start in groups of equal first symbol.  Groups are taken in
descending order.  All greater groups have been taken out of a doubly linked list of
positions by then, so a member's left neighbour in it, past members of the same group, is
its previous smaller suffix, and its right neighbour the next smaller one.  Each group that
holds such previous suffixes is split by how many members point at them: more members make
a longer prefix, so they go behind.  Afterwards groups hold suffixes of equal Lyndon prefix
in the order of these prefixes, and ascending over the groups the members of each are put in
the order of what follows their prefix, whose place is known by then.  No symbols are
renamed and nothing is solved recursively.

Texts are independent: a step takes the next group of every text, so that numpy works on
as many members as there are texts in a batch.
"""

from __future__ import annotations

import numpy as np


def _ramps(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, sizes long."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(before[-1] + sizes[-1] if len(sizes) else 0)


class _Groups:
    """Positions of all texts, each followed by its end, in groups of their Lyndon prefixes so far.

    Position 0 is an end before the first text.  A group is named by its first place.
    """

    def __init__(self, symbols: np.ndarray, begins: np.ndarray):
        self.begins = begins
        n = len(symbols)
        text = np.zeros(n, np.int64)
        text[begins[1:]] = 1
        np.cumsum(text, out=text)
        key = text * (int(symbols.max()) + 1) + symbols
        key[0] = -1
        self.order = np.argsort(key, kind="stable")
        key = key[self.order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, n))
        self.place = np.empty(n, np.int64)
        self.place[self.order] = np.arange(n)
        self.group = np.empty(n, np.int64)
        self.group[self.order] = np.repeat(first, size)
        self.end = np.zeros(n + 1, np.int64)
        self.end[first] = first + size
        self.is_end = symbols == 0
        self.left = np.arange(-1, n - 1)
        self.right = np.arange(1, n + 1)
        self.depth = np.ones(n, np.int64)
        self.hit = np.zeros(n, bool)

    def take(self, first: np.ndarray, behind: np.ndarray) -> None:
        """Take one group [first, behind) of each of some texts out of the list and split what they point at."""
        left, right, depth, group = self.left, self.right, self.depth, self.group
        size = behind - first
        members = self.order[_ramps(first, size)]
        own = np.repeat(first, size)
        runs = False
        chained = members[group[left[members]] == own]
        while len(chained):
            runs = True
            left[chained] = left[left[chained]]
            chained = chained[group[left[chained]] == group[chained]]
        chained = members[group[right[members]] == own] if runs else members[:0]
        while len(chained):
            through = right[chained]
            more, beyond = depth[through], right[through]
            depth[chained] += more
            right[chained] = beyond
            chained = chained[group[beyond] == group[chained]]
        smaller, beyond = left[members], right[members]
        right[smaller] = beyond
        left[beyond] = smaller
        smaller = smaller[~self.is_end[smaller]]
        if len(smaller):
            self._split(smaller, runs)

    def _split(self, hit: np.ndarray, repeated: bool) -> None:
        """Move the hit positions behind the rest of their groups, by ascending number of hits."""
        group, order, place, end = self.group, self.order, self.place, self.end
        if repeated:
            hit, times = np.unique(hit, return_counts=True)
            sort = np.lexsort((times, group[hit]))
            times = times[sort]
        else:
            sort = np.argsort(group[hit], kind="stable")
        hit = hit[sort]
        was = group[hit]
        new = np.concatenate([[True], was[1:] != was[:-1]])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(hit)))
        first = was[at]
        tail = end[first] - count
        target = _ramps(tail, count)
        self.hit[hit] = True
        pushed = order[target]
        pushed = pushed[~self.hit[pushed]]
        self.hit[hit] = False
        if len(pushed):
            free = place[hit]
            free = free[free < np.repeat(tail, count)]
            order[free] = pushed
            place[pushed] = free
        order[target] = hit
        place[hit] = target
        if repeated:
            new[1:] |= times[1:] != times[:-1]
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(hit)))
        end[first] = tail
        begun = target[at]
        end[begun] = begun + count
        group[hit] = np.repeat(begun, count)

    def descend(self) -> None:
        behind = np.append(self.begins[1:], len(self.order))
        low = self.begins + 1  # a text's end is its lowest place
        while True:
            active = behind > low
            if not active.all():
                behind, low = behind[active], low[active]
            if not len(behind):
                return
            first = self.group[self.order[behind - 1]]
            self.take(first, behind)
            behind = first

    def ascend(self) -> np.ndarray:
        """Positions in order, from the groups' order and the places of the suffixes behind their prefixes."""
        order, place = self.order, self.place
        first = np.flatnonzero(self.group[order] == np.arange(len(order)))
        several = first[self.end[first] - first > 1]
        if not len(several):
            return order
        text = np.searchsorted(self.begins, several, "right")
        start = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        turn = np.arange(len(several)) - np.repeat(start, np.diff(np.append(start, len(several))))
        several = several[np.argsort(turn, kind="stable")]
        cuts = np.cumsum(np.bincount(turn))
        for a, b in zip(np.concatenate([[0], cuts[:-1]]), cuts):
            groups = several[a:b]
            size = self.end[groups] - groups
            at = _ramps(groups, size)
            members = order[at]
            follows, depth = place[self.right[members]], self.depth[members]
            if (depth > 1).any():
                sort = np.lexsort((follows, depth, np.repeat(groups, size)))
            else:  # places of one text stand together, in the order of the texts
                sort = np.argsort(follows)
            members = members[sort]
            order[at] = members
            place[members] = at
        return order


def suffix_arrays(texts: list[bytes]) -> list[np.ndarray]:
    """Start positions of each text's suffixes in ascending order; a suffix precedes those it begins."""
    lengths = np.array([len(t) for t in texts], np.int64)
    if not len(texts):
        return []
    begins = 1 + np.cumsum(lengths + 1) - (lengths + 1)
    symbols = np.zeros(1 + int((lengths + 1).sum()), np.int64)
    symbols[_ramps(begins, lengths)] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
    groups = _Groups(symbols, begins)
    groups.descend()
    order = groups.ascend()
    return [order[b + 1:b + 1 + n] - b for b, n in zip(begins.tolist(), lengths.tolist())]
