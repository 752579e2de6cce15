"""Figures of whole texts, worked through piece by piece so that long texts need little memory beside them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

BLANKS = " \t\n\x0b\x0c\r"  # what separates words
PIECE = 1_000_000
BREAK = re.compile(f"[{BLANKS}]")
CAPITALS = bytes(range(65, 91))


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that end at a blank (a longer word stays whole)."""
    at = 0
    while len(text) - at > size:
        found = BREAK.search(text, at + size)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def word_lists(text: str) -> Iterator[list[bytes]]:
    """The words of each piece, as UTF-8: bytes are split exactly at the six blanks."""
    for piece in pieces(text):
        yield piece.encode("utf-8", "surrogatepass").split()


def count_of(text: str, characters: str) -> int:
    return sum(map(text.count, characters))


def word_count(text: str) -> int:
    return sum(map(len, word_lists(text)))


def words_and_distinct(text: str) -> tuple[int, int]:
    total, seen = 0, set()
    for words in word_lists(text):
        total += len(words)
        seen.update(words)
    return total, len(seen)


def capitals(text: str) -> int:
    """Letters A-Z."""
    return sum(len(raw) - len(raw.translate(None, CAPITALS)) for raw in (p.encode("utf-8", "surrogatepass") for p in pieces(text)))


def lines(text: str) -> Iterator[str]:
    r"""The lines between ``\n`` marks, one at a time."""
    at = 0
    while (end := text.find("\n", at)) >= 0:
        yield text[at:end]
        at = end + 1
    yield text[at:]


def line_counts(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    total, seen = 0, set()
    for line in lines(text):
        if line.strip(BLANKS):
            total += 1
            seen.add(line)
    return total, total - len(seen)


class Numbers(dict):
    """Word -> number in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def repeated_words(text: str) -> int:
    """Words that lie in a window of three words found at least twice in the text."""
    number = Numbers()
    parts = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in word_lists(text)]
    ids = np.concatenate(parts)
    if len(ids) < 4:
        return 0
    n = max(2, len(number))
    pairs = ids[:-1] * n + ids[1:]
    if n >= 1 << 21:  # three numbers would not fit into 64 bits
        pairs = np.searchsorted(np.unique(pairs), pairs)
    keys = pairs[:-1] * n + ids[2:]
    ordered = np.sort(keys)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(again):
        return 0
    covered = np.zeros(len(ids), bool)
    for at in range(0, len(keys), PIECE):
        some = keys[at : at + PIECE]
        place = np.minimum(np.searchsorted(again, some), len(again) - 1)
        hit = np.flatnonzero(again[place] == some) + at
        for shift in range(3):
            covered[hit + shift] = True
    return int(covered.sum())
