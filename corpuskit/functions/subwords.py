"""Segmenting words into subwords inside Arrow batches.

Spark hands over arrays of words; each batch is dictionary encoded so that a
word is segmented once per batch, and a bounded cache keeps frequent words
across batches.  The three ``*_segmenter`` functions are the only per-word
Python.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpuskit.config import UNK_TOKEN
from corpuskit.functions import lattice
from corpuskit.functions.text import MAX_SUBWORD, WORDPIECE_PREFIX

CACHED_WORDS = 200_000
WALKED_CHARS = 64  # longer words are walked one at a time
UNKNOWN_LOGP = math.log(1e-10)
CODE_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd: powers of it weigh the bytes of a text

Segmenter = Callable[[str], list[str]]


def bpe_segmenter(ranks: dict[tuple[str, str], int]) -> Segmenter:
    """Apply the merges to a word in rank order, one pass each, skipping absent ones."""

    def segment(word: str) -> list[str]:
        tokens = list(word)
        done = -1
        while len(tokens) > 1:
            present = (ranks.get(pair, -1) for pair in zip(tokens, tokens[1:]))
            rank = min((r for r in present if r > done), default=None)
            if rank is None:
                break
            out: list[str] = []
            for token in tokens:
                # A symbol that was itself just merged has no rank with its neighbour yet.
                if out and ranks.get((out[-1], token)) == rank:
                    out[-1] += token
                else:
                    out.append(token)
            tokens, done = out, rank
        return tokens

    return segment


def wordpiece_segmenter(vocab: frozenset[str], prefix: str = WORDPIECE_PREFIX) -> Segmenter:
    """Longest vocabulary entry first; every character without a match is one unknown token."""
    longest = max(map(len, vocab), default=0)

    def segment(word: str) -> list[str]:
        tokens: list[str] = []
        at = 0
        while at < len(word):
            lead = prefix if at else ""
            pieces = (lead + word[at:end] for end in range(min(len(word), at + longest), at, -1))
            piece = next((p for p in pieces if p in vocab), None)
            tokens.append(UNK_TOKEN if piece is None else piece)
            at += 1 if piece is None else len(piece) - len(lead)
        return tokens

    return segment


def word_edges(word: str, logp: dict[str, float]) -> list[list[tuple[int, float, str]]]:
    """Per end position the pieces of the model that end there, longest first."""
    return [
        [
            (start, logp[piece], piece)
            for start in range(max(0, end - MAX_SUBWORD), end)
            if (piece := word[start:end]) in logp
        ]
        for end in range(1, len(word) + 1)
    ]


Reach = list[tuple[float, int, str]]  # per position: best score, where its last piece starts, the piece


def best_reach(
    edges: list[list[tuple[int, float, str]]], without: str | None = None, known: Reach | None = None
) -> Reach:
    """Best way to every position; on equal scores the longer last piece stays.

    ``known`` gives the first positions when they were worked out before.
    """
    reach = known or [(0.0, 0, "")]
    for arriving in edges[len(reach) - 1 :]:
        best = (-math.inf, -1, "")
        for start, gain, piece in arriving:
            score = reach[start][0] + gain
            if score > best[0] and piece != without:
                best = (score, start, piece)
        reach.append(best)
    return reach


def best_path(reach: Reach) -> list[str] | None:
    """The pieces of the best way to the end, or None when no way leads there."""
    if reach[-1][1] < 0:
        return None
    at, path = len(reach) - 1, []
    while at > 0:
        _, at, piece = reach[at]
        path.append(piece)
    return path[::-1]


def unigram_segmenter(logp: dict[str, float]) -> Segmenter:
    """Best path; a word no path covers falls back to characters.  ``many`` cuts a list of words in the same way."""

    def segment(word: str) -> list[str]:
        path = best_path(best_reach(word_edges(word, logp)))
        return [c if c in logp else UNK_TOKEN for c in word] if path is None else path

    pieces = lattice.Pieces(logp)
    segment.many = lambda words: lattice.segmented(pieces, words, segment, WALKED_CHARS)
    return segment


def expand(index: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the segments of each indexed word in the flat segment list, and their counts."""
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths
    counts = lengths[index]
    ends = np.cumsum(counts)
    inside = np.arange(counts.sum()) - np.repeat(ends - counts, counts)
    return np.repeat(starts[index], counts) + inside, counts


def as_lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def list_lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def segment_lists(words: pa.Array, segment: Segmenter, known: TextIndex | None = None, default: int = 0) -> pa.Array:
    """list<string> of words to list<string> of tokens, in order, or to their ids in ``known``."""
    per_row = list_lengths(words)
    coded = words.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    distinct = coded.dictionary.to_pylist()
    segments = segment.many(distinct) if hasattr(segment, "many") else [segment(w) for w in distinct]
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    flat = pa.array([t for s in segments for t in s], pa.string())
    if known is not None:
        tokens = flat.dictionary_encode()
        flat = pa.array(known.find(tokens.dictionary, default), pa.int32()).take(tokens.indices)
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    at, counts = expand(index, lengths)
    row_ends = np.concatenate(([0], np.cumsum(counts)))[np.cumsum(per_row)]
    return as_lists(flat.take(pa.array(at)), np.diff(np.concatenate(([0], row_ends))))


TEXT_CHARS = 1_000_000  # characters of neighbouring texts (or one longer text) that are segmented together


def text_slices(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbouring rows of about ``most`` together."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    yield from map(slice, [0, *cuts.tolist()], [*cuts.tolist(), len(sizes)])


def text_sizes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def segment_texts(
    texts: pa.Array, split: Callable[[str], list[str]], segment: Segmenter, known: TextIndex | None = None, default: int = 0
) -> pa.Array:
    """Texts to list<string> of tokens, or to their ids in ``known``; a null text has none."""
    parts = []
    for some in text_slices(text_sizes(texts), TEXT_CHARS):
        words = [split(t or "") for t in texts[some].to_pylist()]
        parts.append(segment_lists(pa.array(words, pa.list_(pa.string())), segment, known, default))
    return pa.concat_arrays(parts)


def text_codes(texts: pa.Array) -> np.ndarray:
    """One 64-bit number per text, equal for equal texts and hardly ever for others."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    ends = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))))
    begin = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset] if len(texts) else 0
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begin : begin + ends[-1]]
    lengths = np.diff(ends)
    powers = np.cumprod(np.full(int(lengths.max(initial=0)), CODE_FACTOR, np.uint64))
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(data)) - np.repeat(ends[:-1], lengths)]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    return sums[ends[1:]] - sums[ends[:-1]]


class TextIndex:
    """Texts sorted by their codes, with a value each: a few bytes a text beside the texts themselves.

    A found code only names candidates; the texts are compared, so that equal codes do no harm.
    Of equal texts the last one counts.
    """

    def __init__(self, texts: pa.Array, values: np.ndarray):
        codes = text_codes(texts)
        order = np.argsort(codes, kind="stable")
        self.codes, self.texts, self.values = codes[order], texts.take(pa.array(order)), values[order]

    def find(self, asked: pa.Array, default: int) -> np.ndarray:
        """The value of each asked text, ``default`` where there is none."""
        codes = text_codes(asked)
        found = np.full(len(asked), default, np.int32)
        row, at = np.arange(len(asked)), np.searchsorted(self.codes, codes, side="right") - 1
        while len(row):
            near = (at >= 0) & (self.codes[at] == codes[row]) if len(self.codes) else np.zeros(len(row), bool)
            row, at = row[near], at[near]
            same = pc.equal(asked.take(pa.array(row)), self.texts.take(pa.array(at)))
            same = pc.fill_null(same, False).to_numpy(zero_copy_only=False).astype(bool)
            found[row[same]] = self.values[at[same]]
            row, at = row[~same], at[~same] - 1
        return found


def lookup_lists(tokens: pa.Array, known: TextIndex, default: int) -> pa.Array:
    """list<string> of tokens to list<int> of ids, ``default`` for unknown tokens.

    Only the distinct tokens of the batch are looked up.
    """
    coded = tokens.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    ids = known.find(coded.dictionary, default)
    at = coded.indices.to_numpy(zero_copy_only=False)
    return as_lists(pa.array(ids[at] if len(at) else ids), list_lengths(tokens))


def cached(segment: Segmenter) -> Segmenter:
    return lru_cache(maxsize=CACHED_WORDS)(segment)
