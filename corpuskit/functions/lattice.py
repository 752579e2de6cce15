"""Best ways through many words at once, under a model of pieces with log probabilities.

Words of one length are rows of a table.  The pieces that end at each place are found along a tree of characters
shared by all rows, and the best way to a place is worked out for all rows together.  Scores are added in the order
in which a walk over a single word adds them, and of equal ways the one with the longer last piece stays, so both
give the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from corpuskit.functions.text import MAX_SUBWORD

TABLE_NUMBERS = 250_000  # numbers of one table of pieces: words x places x lengths
TREE_NUMBERS = 4_000_000  # numbers of one level of the tree that is looked up at once
NO_PIECE = -1


def points_of(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class Pieces:
    """The pieces of a model by place in the model, as levels of a tree: one more character each."""

    def __init__(self, model: dict[str, float]):
        self.tokens = list(model)
        self.logp = np.append(np.fromiter(model.values(), np.float64, len(model)), -np.inf)  # last: NO_PIECE
        self.sizes = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        self.codes: list[np.ndarray] = []
        self.piece: list[np.ndarray] = []
        self.child: list[np.ndarray | None] = []
        at = np.flatnonzero((self.sizes > 0) & (self.sizes <= MAX_SUBWORD))
        points = points_of([self.tokens[n] for n in at])
        self.alphabet = np.unique(points)  # sorted
        points = np.searchsorted(self.alphabet, points)
        width = len(self.alphabet) + 1  # last: characters in no piece
        starts = np.cumsum(self.sizes[at]) - self.sizes[at]
        node = np.zeros(len(at), np.int64)
        for depth in range(int(self.sizes[at].max(initial=0))):
            inside = self.sizes[at] > depth
            at, starts, node = at[inside], starts[inside], node[inside]
            before = len(self.codes[-1]) if depth else 1
            codes, node = np.unique(node * width + points[starts + depth], return_inverse=True)
            ending = np.full(len(codes), NO_PIECE, np.int32)
            last = self.sizes[at] == depth + 1
            ending[node[last]] = at[last]
            self.codes.append(codes)
            self.piece.append(ending)
            self.child.append(None)
            if before * width <= TREE_NUMBERS:  # looked up at once, else among the sorted codes
                self.child[depth] = np.full(before * width, -1, np.int32)
                self.child[depth][codes] = np.arange(len(codes))

    def ending(self, points: np.ndarray) -> np.ndarray:
        """``[row, end - 1, reach - size]``: the piece of ``size`` characters before each end, longest first."""
        n, length = points.shape
        reach = min(length, len(self.codes))
        found = np.full((n, length, reach), NO_PIECE, np.int32)
        if not reach:
            return found
        symbols = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        symbols[self.alphabet[symbols] != points] = len(self.alphabet)
        width = len(self.alphabet) + 1
        row, start = (x.ravel() for x in np.indices((n, length)))
        node = np.zeros(len(row), np.int64)
        for depth in range(reach):
            inside = start + depth < length
            row, start, node = row[inside], start[inside], node[inside]
            code = node * width + symbols[row, start + depth]
            if self.child[depth] is None:
                node = np.minimum(np.searchsorted(self.codes[depth], code), len(self.codes[depth]) - 1)
                hit = self.codes[depth][node] == code
            else:
                node = self.child[depth][code]
                hit = node >= 0
            row, start, node = row[hit], start[hit], node[hit].astype(np.int64)
            found[row, start + depth, reach - 1 - depth] = self.piece[depth][node]
        return found


def best_ways(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score of every row's best way to the end (-inf without any), and the size of the best last piece per place."""
    n, length, reach = gain.shape
    best = np.full((n, reach + length + 1), -np.inf)  # ``reach`` places before the first
    best[:, reach] = 0.0 if reach else -np.inf
    last = np.zeros((n, length + 1), np.int64)
    rows = np.arange(n)
    if not reach:  # a model without pieces
        return best[:, length], last
    for end in range(1, length + 1):
        ways = best[:, end : end + reach] + gain[:, end - 1]
        longest = ways.argmax(axis=1)
        best[:, reach + end] = ways[rows, longest]
        last[:, end] = reach - longest
    return best[:, reach + length], last


def on_best_way(found: np.ndarray, last: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, piece)`` of all pieces on the best ways of ``rows``, the last pieces first."""
    length, reach = found.shape[1:]
    at = np.full(len(rows), length)
    row_parts, piece_parts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(rows):
        size = last[rows, at]
        row_parts.append(rows)
        piece_parts.append(found[rows, at - 1, reach - size].astype(np.int64))
        at = at - size
        rows, at = rows[at > 0], at[at > 0]
    return np.concatenate(row_parts), np.concatenate(piece_parts)


def by_length(words: list[str], reach: int, most: int) -> Iterator[np.ndarray]:
    """Places of words of one length, as many as fit into a table, for words of 1 to ``most`` characters."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for length in np.unique(lengths[(lengths > 0) & (lengths <= most)]).tolist():
        low, high = np.searchsorted(lengths[order], [length, length + 1])
        step = max(1, TABLE_NUMBERS // (length * max(1, min(reach, length))))
        for start in range(low, high, step):
            yield order[start : min(start + step, high)]


def gains(
    pieces: Pieces, words: list[str], freq: np.ndarray, spelled: Callable[[str], float]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(piece, gain)`` for words of one length and each longer piece on their best ways.

    A gain is what taking the piece away costs all occurrences of the word; without any other way the word is
    ``spelled`` in characters.
    """
    points = points_of(words)
    length = len(words[0])
    found = pieces.ending(points.reshape(len(words), length))
    gain = pieces.logp[found]
    whole, last = best_ways(gain)
    row, piece = on_best_way(found, last, np.flatnonzero(whole > -np.inf))
    longer = pieces.sizes[piece] > 1
    pairs = np.unique(row[longer] * len(pieces.logp) + piece[longer])
    row, piece = pairs // len(pieces.logp), pairs % len(pieces.logp)
    step = max(1, TABLE_NUMBERS // max(1, found.shape[1] * found.shape[2]))
    for start in range(0, len(row), step):
        mine, away = row[start : start + step], piece[start : start + step]
        other = np.where(found[mine] == away[:, None, None], -np.inf, gain[mine])
        left, _ = best_ways(other)
        none = np.flatnonzero(left == -np.inf)
        left[none] = [spelled(words[n]) for n in mine[none].tolist()]
        yield away, freq[mine] * (whole[mine] - left)


def segmented(pieces: Pieces, words: list[str], alone: Callable[[str], list[str]], most: int) -> list[list[str]]:
    """The pieces of every word's best way; words without any way or of more than ``most`` characters go to ``alone``."""
    out: list[list[str] | None] = [None] * len(words)
    for n in by_length(words, len(pieces.codes), most):
        some = [words[x] for x in n.tolist()]
        found = pieces.ending(points_of(some).reshape(len(some), -1))
        whole, last = best_ways(pieces.logp[found])
        row, piece = on_best_way(found, last, np.flatnonzero(whole > -np.inf))
        order = np.argsort(row[::-1], kind="stable")  # first pieces first
        row, piece = row[::-1][order], piece[::-1][order]
        start = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row
        tokens = [pieces.tokens[p] for p in piece.tolist()]
        for at, low, high in zip(n[row[start]].tolist(), start.tolist(), [*start[1:].tolist(), len(row)]):
            out[at] = tokens[low:high]
    return [alone(w) if s is None else s for w, s in zip(words, out)]
