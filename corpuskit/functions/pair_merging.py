"""Merging neighbouring symbols in a block of words, with an index from pair to places.

``flat`` holds the symbol ids of all words one after the other.  A merge visits only the places of its
pair: it is found in the index, its neighbours change, and the pairs lost and made there are reported as
signed changes.  Nothing else is counted again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NEVER = np.iinfo(np.int64).max  # a place after every real one
GONE = -1  # what is left of the right symbol of a merge
SHIFT = 32


def code_of(left: int, right: int) -> int:
    return int(left) << SHIFT | int(right)


@dataclass
class Changes:
    """Places at which pairs came (+) and went (-), one row each."""

    code: np.ndarray
    weight: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    merged: float  # how often the pair itself was merged, weighted


class PairIndex:
    """Words of a block as linked symbols, and where each pair stands.

    ``word`` is the word of each symbol, ``offset`` the character it begins at, which merges leave alone.
    """

    def __init__(self, flat: np.ndarray, lengths: np.ndarray, freq: np.ndarray, first: np.ndarray, sizes: np.ndarray):
        self.symbol = flat.astype(np.int64)
        self.freq, self.first = freq, first
        self.word = np.repeat(np.arange(len(lengths)), lengths)
        ends = np.cumsum(sizes[self.symbol]) if len(flat) else np.zeros(0, np.int64)
        begins = ends - sizes[self.symbol]
        starts = np.cumsum(lengths) - lengths
        self.offset = begins - (begins[np.minimum(starts, max(0, len(flat) - 1))][self.word] if len(flat) else 0)
        place = np.arange(len(flat))
        same = self.word[1:] == self.word[:-1]
        self.next, self.before = np.full(len(flat), GONE), np.full(len(flat), GONE)
        self.next[:-1][same] = place[1:][same]
        self.before[1:][same] = place[:-1][same]
        at = np.flatnonzero(self.next >= 0)
        codes = self.codes_at(at)
        order = np.argsort(codes, kind="stable")
        self.codes, self.at = codes[order], at[order]
        self.made: dict[int, list[np.ndarray]] = {}

    def copy(self) -> PairIndex:
        other = object.__new__(PairIndex)
        other.__dict__.update(self.__dict__)
        other.symbol, other.next, other.before = self.symbol.copy(), self.next.copy(), self.before.copy()
        other.made = {code: list(places) for code, places in self.made.items()}
        return other

    def codes_at(self, at: np.ndarray) -> np.ndarray:
        return self.symbol[at] << SHIFT | self.symbol[self.next[at]]

    def places(self, left: int, right: int) -> np.ndarray:
        """Where the pair stands now, in order."""
        code = code_of(left, right)
        a, b = np.searchsorted(self.codes, [code, code + 1])
        at = self.at[a:b]
        if code in self.made:
            at = np.unique(np.concatenate([at, *self.made[code]]))
        at = at[(self.symbol[at] == left) & (self.next[at] >= 0)]
        return at[self.symbol[self.next[at]] == right]

    def merge(self, left: int, right: int, new: int) -> Changes | None:
        """Merge the pair from left to right without overlap."""
        at = self.places(left, right)
        if left == right and len(at):
            opens = np.concatenate(([True], self.next[at[:-1]] != at[1:]))
            run = np.flatnonzero(opens)[np.cumsum(opens) - 1]
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        if not len(at):
            return None
        taken = self.next[at]
        before, after = self.before[at], self.next[taken]
        lost = np.unique(np.concatenate([at, before[before >= 0], taken[after >= 0]]))
        old = self.codes_at(lost)
        self.symbol[at] = new
        self.symbol[taken] = GONE
        self.next[taken] = GONE
        self.next[at] = after
        self.before[after[after >= 0]] = at[after >= 0]
        before = self.before[at]
        made = np.unique(np.concatenate([at[self.next[at] >= 0], before[before >= 0]]))
        fresh = self.codes_at(made)
        order = np.argsort(fresh, kind="stable")
        cuts = np.flatnonzero(np.diff(fresh[order])) + 1
        for places in np.split(made[order], cuts) if len(made) else ():
            self.made.setdefault(int(self.codes_at(places[:1])[0]), []).append(places)
        return Changes(
            np.concatenate([old, fresh]),
            np.concatenate([-self.freq[self.word[lost]], self.freq[self.word[made]]]),
            np.concatenate([np.full(len(lost), NEVER), self.first[self.word[made]]]),
            np.concatenate([np.zeros(len(lost), np.int64), self.offset[made]]),
            self.freq[self.word[at]].sum(),
        )

    def now(self) -> Changes:
        """All pairs as they stand, as changes from nothing."""
        at = np.flatnonzero(self.next >= 0)
        return Changes(self.codes_at(at), self.freq[self.word[at]], self.first[self.word[at]], self.offset[at], 0)

    def firsts(self, codes: np.ndarray) -> Changes | None:
        """The earliest place of each of these pairs that stands anywhere."""
        found = []
        for code in codes.tolist():
            at = self.places(code >> SHIFT, code & ((1 << SHIFT) - 1))
            if len(at):
                word = self.first[self.word[at]]
                first = word.min()
                found.append((code, 1, first, self.offset[at[word == first]].min()))
        return Changes(*map(np.array, zip(*found)), 0) if found else None

    def symbol_weights(self) -> tuple[np.ndarray, np.ndarray]:
        live = self.symbol >= 0
        symbols, place = np.unique(self.symbol[live], return_inverse=True)
        total = np.zeros(len(symbols), np.int64)
        np.add.at(total, place, self.freq[self.word[live]])
        return symbols, total

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words, and how many each has."""
        live = self.symbol >= 0
        return self.symbol[live], np.bincount(self.word[live], minlength=len(self.freq))


def summed(step: np.ndarray, changes: Changes) -> list[np.ndarray]:
    """``step, code, made, lost, first, offset`` per step and pair: what came, what went, the earliest place."""
    order = np.lexsort((changes.offset, changes.first, changes.code, step))
    step, code, weight = step[order], changes.code[order], changes.weight[order]
    if not len(step):
        return [step, code, weight, weight, weight, weight]
    start = np.flatnonzero(np.concatenate(([True], (np.diff(step) != 0) | (np.diff(code) != 0))))
    made, lost = (np.add.reduceat(np.where(weight > 0, weight, 0), start), np.add.reduceat(np.where(weight < 0, -weight, 0), start))
    return [step[start], code[start], made, lost, changes.first[order][start], changes.offset[order][start]]


class PairTotals:
    """Totals of the pairs that matter, kept up to date by signed changes.

    A total is exact.  ``first`` and ``offset`` are where the pair is met first; once some of its places
    went away they are only a lower bound, until the pair is looked up again.
    """

    def __init__(self, codes: np.ndarray, count: np.ndarray, first: np.ndarray, offset: np.ndarray, freq: np.ndarray | None, floor: float):
        self.row = {int(c): n for n, c in enumerate(codes)}
        self.code, self.count, self.first, self.offset = codes.copy(), count.copy(), first.copy(), offset.copy()
        self.exact = np.ones(len(codes), bool)
        # Symbol frequencies, when pairs are ranked by score; as they were when the pairs were counted.
        self.freq = freq
        self.freq_then = None if freq is None else freq.copy()
        self.floor = floor  # the greatest measure of a pair left out then; of equal ones the later met were left out
        self.stale = False
        self.symbols = 1 + int(max((codes >> SHIFT).max(initial=0), (codes & ((1 << SHIFT) - 1)).max(initial=0)))
        self.unknown = False  # whether pairs left out have gained places

    def copy(self) -> PairTotals:
        other = object.__new__(PairTotals)
        other.__dict__.update({k: v.copy() if hasattr(v, "copy") else v for k, v in self.__dict__.items()})
        return other

    def measures(self) -> np.ndarray:
        if self.freq is None:
            return self.count.astype(np.float64)
        f = self.freq.astype(np.float64)
        scale = f[self.code >> SHIFT] * f[self.code & ((1 << SHIFT) - 1)]
        return np.divide(self.count, scale, out=np.zeros(len(scale)), where=scale > 0)

    def left_out(self) -> float:
        """No pair that is not kept measures more than this now.

        Counts only fall.  A score rises at most as its symbols' frequencies fell.
        """
        if self.freq is None or not self.floor:
            return self.floor
        then, now = self.freq_then, self.freq[: len(self.freq_then)]
        fell = then[now > 0] / now[now > 0]
        return self.floor * float(fell.max(initial=1.0)) ** 2

    def best(self) -> tuple[int | None, np.ndarray]:
        """The best pair, None if it is not certain, and all pairs of the greatest measure."""
        measures = self.measures()
        top = measures.max(initial=0.0)
        if self.unknown or top <= 0 or top < self.left_out() or (top == self.left_out() and self.stale):
            return None, np.zeros(0, np.int64)
        ties = np.flatnonzero(measures == top)
        if len(ties) == 1:
            return int(self.code[ties[0]]), self.code[ties]
        lead = ties[np.lexsort((self.offset[ties], self.first[ties]))[0]]
        return (int(self.code[lead]) if self.exact[lead] else None), self.code[ties]

    def rows_of(self, codes: np.ndarray) -> np.ndarray:
        fresh = [c for c in codes.tolist() if c not in self.row]
        if fresh:
            for n, c in enumerate(fresh, len(self.code)):
                self.row[c] = n
            more = len(fresh)
            self.code = np.append(self.code, np.array(fresh, np.int64))
            self.count = np.append(self.count, np.zeros(more, self.count.dtype))
            self.first = np.append(self.first, np.full(more, NEVER))
            self.offset = np.append(self.offset, np.zeros(more, np.int64))
            self.exact = np.append(self.exact, np.ones(more, bool))
        return np.fromiter(map(self.row.__getitem__, codes.tolist()), np.int64, len(codes))

    def apply(self, merge: tuple[int, int, int], merged: float, rows: list[np.ndarray]) -> None:
        """Take over the changes ``code, made, lost, first, offset`` of one merge.

        Pairs that are not kept stay out, unless the merged symbol is new and one of theirs.  If it is not
        new, pairs left out may have gained places, and all pairs have to be counted again.
        """
        left, right, new = merge
        code, made, lost, first, offset = rows
        self.stale = True
        fresh = new >= self.symbols
        self.symbols = max(self.symbols, new + 1)
        self.unknown |= bool(self.floor) and not fresh
        if self.floor:
            known = np.fromiter((c in self.row for c in code.tolist()), bool, len(code))
            known |= fresh & ((code >> SHIFT == new) | (code & ((1 << SHIFT) - 1) == new))
            code, made, lost, first, offset = (x[known] for x in (code, made, lost, first, offset))
        at = self.rows_of(code)
        self.count[at] += (made - lost).astype(self.count.dtype)
        sooner = (first < self.first[at]) | ((first == self.first[at]) & (offset < self.offset[at]))
        self.first[at] = np.where(sooner, first, self.first[at])
        self.offset[at] = np.where(sooner, offset, self.offset[at])
        empty = self.count[at] == 0
        self.exact[at] = np.where(empty, True, self.exact[at] & (lost == 0))
        self.first[at[empty]] = NEVER
        if self.freq is not None:
            if new >= len(self.freq):
                self.freq = np.append(self.freq, np.zeros(new + 1 - len(self.freq), self.freq.dtype))
            for symbol, change in ((left, -merged), (right, -merged), (new, merged)):
                self.freq[symbol] += change

    def found(self, codes: np.ndarray, first: np.ndarray, offset: np.ndarray) -> None:
        """Where pairs are met first now."""
        known = np.fromiter((c in self.row for c in codes.tolist()), bool, len(codes))
        at = self.rows_of(codes[known])
        self.first[at], self.offset[at], self.exact[at] = first[known], offset[known], True

    def unsure(self, most: int, within: float = 1.0) -> np.ndarray:
        """The best pairs whose first place is only a lower bound, those ``within`` a share of the best."""
        measures = self.measures()
        at = np.flatnonzero(~self.exact & (measures > (1 - within) * measures.max(initial=0.0)))
        if len(at) > most:
            at = at[np.argpartition(-measures[at], most)[:most]]
        return self.code[at]
