"""Token ids of whole texts with a ready-made tokenizer, at the price of their distinct pieces."""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Set before the library starts threads: Spark already runs one worker per core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

GAP = re.compile(r"(?<=\S)(?= \S)")
# Two white-space characters in a row, or one at an end, or the mark used for cutting.
SPACES = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNEVEN = f"[{SPACES}][{SPACES}]|^[{SPACES}]|[{SPACES}]$|\\x00"
# One pre-token of Latin letters.
PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
# How byte-level vocabularies write bytes that are no visible Latin-1 character: as code points from 256 on.
HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
AS_TEXT = {byte: 256 + n for n, byte in enumerate(HIDDEN)}
BLANK = chr(AS_TEXT[32])


def default_path(name: str) -> str:
    """Where the installed vocabulary file lies; it is read in the tasks, never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces(dict):
    """Piece -> number; unknown pieces get the next number and wait for ``settle``."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number


class PieceEncoder:
    """Encodes texts as the concatenation of their pieces, each looked up or encoded once.

    Texts are cut only where the tokenizer's own pre-tokenizer always cuts, so the
    ids equal those of the whole text: at white space, and in a new piece between a
    letter and the commas or full stops that end it.  Tokenizers of the kind ``drops_space`` fold
    case and drop white space, so every blank and line end is a place to cut.  The
    others attach one blank to the word behind it: they are cut before a blank and
    around a line end if no two white-space characters meet, else only before single
    blanks.
    """

    def __init__(self, path: str, drops_space: bool, most: int = 500_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.drops_space = drops_space
        self.most = most
        self.known_marks: dict[str, list[int]] = {}
        self.reset()

    def reset(self) -> None:
        self.pieces = Pieces()
        self.flat = [np.zeros(0, np.uint32)]
        self.lengths = [np.zeros(0, np.int64)]

    def settle(self) -> None:
        """Encode the pieces met for the first time.

        A piece that is one plain pre-token goes straight to the tokenizer's model,
        which saves the steps that find the pre-tokens; others take all steps.
        """
        fresh, self.pieces.fresh = self.pieces.fresh, []
        found: list[list[int] | None] = [None] * len(fresh)
        whole = []
        tokenize = self.tokenizer.model.tokenize
        for n, piece in enumerate(fresh):
            word = piece.rstrip(",.")
            marks = piece[len(word) :]
            core = word[1:] if word[:1] == " " and not self.drops_space else word
            if core.isalpha() and core.isascii():
                if core is not word:
                    word = BLANK + core
                found[n] = [token.id for token in tokenize(word)] + (self.marks(marks) if marks else [])
            elif PLAIN(core) and not (self.drops_space and core != core.lower()):
                word = word.encode().decode("latin-1").translate(AS_TEXT)
                found[n] = [token.id for token in tokenize(word)] + (self.marks(marks) if marks else [])
            else:
                whole.append(n)
        for at in range(0, len(whole), 5_000):
            some = whole[at : at + 5_000]
            for n, encoding in zip(some, self.tokenizer.encode_batch_fast([fresh[n] for n in some], add_special_tokens=False)):
                found[n] = encoding.ids
        self.lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
        self.flat.append(np.fromiter(chain.from_iterable(found), np.uint32))

    def marks(self, text: str) -> list[int]:
        """Ids of the commas or full stops behind a word."""
        if len(text) > 8:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if text not in self.known_marks:
            self.known_marks[text] = self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.known_marks[text]

    def cut(self, texts: pa.Array) -> pa.Array:
        """The pieces of each text, as lists."""
        if self.drops_space:
            # Case folding of A-Z commutes with the tokenizer's own normalisation.
            return pc.split_pattern(pc.replace_substring(pc.ascii_lower(texts), "\n", " "), " ")
        uneven = pc.match_substring_regex(texts, UNEVEN)
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n\x00")
        lists = pc.split_pattern(marked, "\x00")
        if not pc.any(uneven).as_py():
            return lists
        slow = iter([GAP.split(t) for t in texts.filter(uneven).to_pylist()])
        return pa.array([next(slow) if u else cut for u, cut in zip(uneven.to_pylist(), lists.to_pylist())], lists.type)

    def encode(self, texts: pa.Array, end: int) -> list[np.ndarray]:
        """Ids of each text (null: empty), followed by ``end``."""
        if len(self.pieces) > self.most:
            self.reset()
        lists = self.cut(pc.fill_null(texts, ""))
        pieces = lists.flatten().dictionary_encode()
        number = np.fromiter(map(self.pieces.__getitem__, pieces.dictionary.to_pylist()), np.int64)
        numbers = number[pieces.indices.to_numpy()] if len(number) else np.zeros(0, np.int64)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.settle()
        flat, lengths = np.concatenate(self.flat), np.concatenate(self.lengths)
        self.flat, self.lengths = [flat], [lengths]
        starts = np.cumsum(lengths) - lengths
        return [ids_of(numbers[a:b], flat, starts, lengths, end) for a, b in zip(bounds[:-1], bounds[1:])]


def ids_of(numbers: np.ndarray, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """The ids of pieces one after another, then ``end``."""
    size = lengths[numbers]
    total = int(size.sum())
    out = np.empty(total + 1, np.uint32)
    shift = starts[numbers] - (np.cumsum(size) - size)
    out[:total] = flat[np.repeat(shift, size) + np.arange(total)]
    out[total] = end
    return out


ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, drops_space: bool) -> PieceEncoder:
    """One encoder per worker process, kept between tasks."""
    if (path, drops_space) not in ENCODERS:
        ENCODERS[path, drops_space] = PieceEncoder(path, drops_space)
    return ENCODERS[path, drops_space]


def array_groups(texts: pa.Array, size: int = 8_000_000) -> list[pa.Array]:
    """Slices of an array of texts with about ``size`` bytes in each; one long text may be more."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    cuts = np.unique(np.append(np.flatnonzero(np.diff(total // size)) + 1, [0, len(texts)]))
    return [texts.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]
