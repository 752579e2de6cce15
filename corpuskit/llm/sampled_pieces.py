"""Sampled segmentations into pieces of a SentencePiece model, and their decoding."""

from __future__ import annotations

import math
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import with_columns
from corpuskit.llm.token_ids import Pieces, default_path

SPACE = "▁"
THETA = 0.2  # exponent of the piece weights: 0 makes all segmentations equal, larger ones prefer the likeliest
MOST_UNITS = 400_000
TINY, LIFT = 1e-150, 1e150
UNITS = 8_192  # filtered together


class PieceLattice:
    """Piece lattices of units (a blank and the characters up to the next one, or a line end), filtered forwards.

    A merge-ranked model has no probabilities, so the piece of rank r weighs
    (r + 2) ** -theta.  Characters that the model does not know are spelled in its
    byte pieces, and so is a literal marker character, which keeps decoding exact.
    No piece reaches over a blank or a line end.

    Each position of a unit is a state; its edges are the pieces that end there, the
    longest first, with their cumulated probability given that the position is
    reached from the left: alpha(start) * weight / alpha(end).
    """

    def __init__(self, path: str, theta: float = THETA, most: int = MOST_UNITS) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.theta, self.most = theta, most
        self.ids: dict[str, int] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = np.zeros(256, np.int32)
        for n in range(model.get_piece_size()):
            piece = model.id_to_piece(n)
            plain = not (model.is_byte(n) or model.is_control(n) or model.is_unknown(n) or model.is_unused(n))
            if model.is_byte(n):
                self.byte_ids[int(piece[3:5], 16)] = n
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode() if plain else b"")
                if plain and SPACE not in piece[1:]:
                    self.ids[piece] = n
        ranked = sorted(self.ids.values(), key=lambda n: (-model.get_score(n), n))
        self.weight = [0.0] * model.get_piece_size()
        for rank, n in enumerate(ranked):
            self.weight[n] = (rank + 2) ** -theta
        self.unknown = (len(ranked) + 2) ** -theta
        self.longest = max(map(len, self.ids), default=1)
        self.keys: np.ndarray | None = None
        self.reset()

    def build_trie(self) -> None:
        """All prefixes of pieces; children in one sorted array of (node, symbol) keys."""
        letters = sorted(set("".join(self.ids)))
        self.symbols = np.zeros(0x110000, np.int32)
        self.symbols[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        nodes = {"": 0}
        for piece in sorted(self.ids):
            for end in range(1, len(piece) + 1):
                nodes.setdefault(piece[:end], len(nodes))
        keys = {nodes[p[:-1]] * self.width + int(self.symbols[ord(p[-1])]): n for p, n in nodes.items() if p}
        self.keys = np.array(sorted(keys), np.int64)
        self.children = np.array([keys[k] for k in sorted(keys)], np.int64)
        self.node_piece = np.full(len(nodes), -1, np.int32)
        for piece, n in self.ids.items():
            self.node_piece[nodes[piece]] = n
        self.alone = np.zeros(0x110000, bool)  # characters that are a piece
        self.alone[[ord(p) for p in self.ids if len(p) == 1]] = True
        self.weights = np.array(self.weight)
        # Longer units are filtered one by one, with rescaling.
        self.short = min(64, int(600 / (1 + 11 * self.theta)))

    def reset(self) -> None:
        self.units = Pieces()
        none = np.zeros(0, np.int32)
        # Per state its first edge (-1 at the start of a unit); per unit its last state; per edge the rest.
        self.first, self.ends, self.before, self.piece = none, none, none, none
        self.chance = np.zeros(0, np.float32)

    def settle(self) -> None:
        """Build the lattices of the units met for the first time."""
        if self.keys is None:
            self.build_trie()
        fresh, self.units.fresh = self.units.fresh, []
        for at in range(0, len(fresh), UNITS):
            self.settle_some(fresh[at : at + UNITS])

    def settle_some(self, fresh: list[str]) -> None:
        size = np.fromiter(map(len, fresh), np.int64, len(fresh))
        text = np.frombuffer("".join(fresh).encode("utf-32-le", "replace"), np.uint32).copy()
        odd = ~self.alone[text] & (text >= 128) | (text == ord(SPACE))
        text[text == ord(" ")] = ord(SPACE)
        whole = np.repeat(np.arange(len(fresh)), size)
        slow = (np.bincount(whole, odd, len(fresh)) > 0) | (size > self.short)
        ends = np.zeros(len(fresh), np.int32)
        quick = np.flatnonzero(~slow)
        states, edges = len(self.first), len(self.piece)
        built = self.filtered(text[~slow[whole]], size[quick])
        firsts, chances, befores, pieces = [built[0]], [built[1]], [built[2]], [built[3]]
        ends[quick] = np.cumsum(size[quick] + 1) - 1
        at, used = len(built[0]), len(built[3])
        for n in np.flatnonzero(slow).tolist():
            first, chance, before, piece = self.filtered_alone(fresh[n])
            firsts.append(np.where(first < 0, -1, first + used))
            chances.append(chance)
            befores.append(before + at)
            pieces.append(piece)
            at, used = at + len(first), used + len(piece)
            ends[n] = at - 1
        first = np.concatenate(firsts)
        self.first = np.concatenate([self.first, np.where(first < 0, -1, first + edges).astype(np.int32)])
        self.chance = np.concatenate([self.chance, *chances])
        self.before = np.concatenate([self.before, (np.concatenate(befores) + states).astype(np.int32)])
        self.piece = np.concatenate([self.piece, *pieces])
        self.ends = np.concatenate([self.ends, ends + np.int32(states)])

    def filtered(self, text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward filtering of many units at once: all pieces by growing length, then all positions by depth."""
        unit = np.repeat(np.arange(len(size)), size)
        stop = np.cumsum(size)
        depth = np.arange(len(text)) - (stop - size)[unit]
        symbol = self.symbols[text]
        place = np.arange(len(text))
        node = np.zeros(len(text), np.int64)
        starts, lengths, ids = [], [], []
        for length in range(1, self.longest + 1):
            inside = place + length <= stop[unit[place]]
            place, node = place[inside], node[inside]
            key = node * self.width + symbol[place + length - 1]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[found] == key
            place, node = place[known], self.children[found[known]]
            hit = self.node_piece[node] >= 0
            starts.append(place[hit])
            lengths.append(np.full(int(hit.sum()), length))
            ids.append(self.node_piece[node[hit]])
        # Single bytes that are no piece are spelled in one byte piece.
        place = np.flatnonzero(~self.alone[text])
        starts.insert(0, place)
        lengths.insert(0, np.ones(len(place), np.int64))
        ids.insert(0, self.byte_ids[text[place]])
        spelled = len(place)
        # Longest first: of each length the ends ascend, so that the stable sort merges runs.
        start, length, piece = (np.concatenate(x[::-1]) for x in (starts, lengths, ids))
        weight = self.weights[piece]
        if spelled:
            weight[-spelled:] = self.unknown
        # Position d of unit u is state (its text before d) + u + d.
        source = start + unit[start]
        target = source + length
        order = np.argsort(target, kind="stable")
        start, length, source, target, piece, weight = (x[order] for x in (start, length, source, target, piece, weight))
        reached = depth[start] + length
        by_depth = np.argsort(reached.astype(np.uint16), kind="stable")
        cuts = np.append(0, np.cumsum(np.bincount(reached)))
        alpha = np.ones(len(text) + len(size))
        from_, to, value = source[by_depth], target[by_depth], weight[by_depth]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                new = np.flatnonzero(np.diff(to[a:b], prepend=-1))
                alpha[to[a:b][new]] = np.add.reduceat(value[a:b] * alpha[from_[a:b]], new)
        chance = alpha[source] * weight / alpha[target]
        begin = np.flatnonzero(np.diff(target, prepend=-1))
        first = np.full(len(alpha), -1, np.int64)
        first[target[begin]] = begin
        total = np.cumsum(chance)
        chance = total - np.repeat((total - chance)[begin], np.diff(np.append(begin, len(target))))
        chance[np.append(begin[1:], len(target))[: len(begin)] - 1] = 2.0  # no draw goes beyond the last edge
        return first, chance.astype(np.float32), source, piece

    def filtered_alone(self, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for one unit of any length and any characters."""
        ids, weight = self.ids, self.weight
        size = len(unit)
        first, chances, before, piece = array("q", [-1]), array("f"), array("q"), array("i")
        alpha, state = [1.0] + [0.0] * size, [0] * (size + 1)
        # A blank in front is the marker; markers in the text itself are spelled in bytes.
        marked = SPACE + unit[1:] if unit[:1] == " " else unit
        barrier = 0
        for end in range(1, size + 1):
            letter = marked[end - 1]
            if unit[end - 1] == SPACE:
                barrier = end
            edges = []
            for start in range(max(barrier, end - self.longest), end):
                n = ids.get(marked[start:end])
                if n is not None:
                    edges.append((alpha[start] * weight[n], state[start], n))
            if letter not in ids or barrier == end:
                at = state[end - 1]
                spelled = letter.encode("utf-8", "replace")
                for byte in spelled[:-1]:
                    first.append(len(piece))
                    chances.append(2.0)
                    before.append(at)
                    piece.append(int(self.byte_ids[byte]))
                    at = len(first) - 1
                edges.append((alpha[end - 1] * self.unknown, at, int(self.byte_ids[spelled[-1]])))
            total = math.fsum(e[0] for e in edges)
            state[end] = len(first)
            first.append(len(piece))
            sofar = 0.0
            for chance, at, n in edges:
                sofar += chance
                chances.append(sofar / total)
                before.append(at)
                piece.append(n)
            chances[-1] = 2.0
            alpha[end] = total
            if total < TINY:  # only ratios inside the reach of a piece matter
                for n in range(max(0, end - self.longest), end + 1):
                    alpha[n] *= LIFT
        return np.array(first), np.array(chances), np.array(before), np.array(piece)

    def sample(self, texts: pa.Array, seeds: np.ndarray) -> list[np.ndarray]:
        """One segmentation per text, drawn backwards from the end of each unit.

        The draw for a piece depends on the seed of the row, the unit and the piece's
        place from the unit's end only, so it does not depend on batches or tasks.
        """
        if len(self.units) > self.most:
            self.reset()
        lists = units_of(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        number = np.fromiter(map(self.units.__getitem__, words.dictionary.to_pylist()), np.int64)
        self.settle()
        first, ends, chance, before, piece = self.first, self.ends, self.chance, self.before, self.piece
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        counts = np.diff(bounds)
        unit = np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts)
        key = mixed(np.repeat(seeds, counts) + unit.astype(np.uint64) * STEP)
        state = ends[number[words.indices.to_numpy()]]
        at = np.flatnonzero(first[state] >= 0)
        state = state[at]
        drawn, nth = [], 0
        while len(at):
            draw = (mixed(key[at] + np.uint64(nth)) >> np.uint64(11)) * 2.0**-53
            edge = first[state]
            late = np.flatnonzero(chance[edge] <= draw)
            while len(late):
                edge[late] += 1
                late = late[chance[edge[late]] <= draw[late]]
            drawn.append((at, piece[edge]))
            state = before[edge]
            more = first[state] >= 0
            at, state, nth = at[more], state[more], nth + 1
        size = np.zeros(len(unit), np.int64)
        for some, _ in drawn:
            size[some] += 1
        stop = np.cumsum(size)
        out = np.empty(int(stop[-1]) if len(stop) else 0, np.int32)
        for n, (some, ids) in enumerate(drawn):
            out[stop[some] - 1 - n] = ids
        cuts = np.append(0, stop)[bounds]
        return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def decode(self, ids: list[int]) -> str:
        """The text; the first character of the pieces is the blank put in front."""
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode("utf-8", "replace")


def units_of(texts: pa.Array) -> pa.Array:
    """Lists of units: cut in front of every blank and around every line end, which no piece reaches over.

    A blank is put in front of the text.  Texts that hold the character used for
    cutting are cut one by one.
    """
    marked = pc.replace_substring(pc.binary_join_element_wise("", texts, " "), " ", "\x00 ")
    lists = pc.split_pattern(pc.replace_substring(marked, "\n", "\x00\n\x00"), "\x00")
    odd = pc.match_substring(texts, "\x00")
    if not pc.any(odd).as_py():
        return lists
    slow = iter([re.split("(?= )|(?<=\n)|(?=\n)", " " + text) for text in texts.filter(odd).to_pylist()])
    return pa.array([next(slow) if o else cut for o, cut in zip(odd.to_pylist(), lists.to_pylist())], lists.type)


STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that scatters counters (two rounds of multiply and shift)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


LATTICES: dict[tuple[str, float], PieceLattice] = {}


def lattice(path: str, theta: float) -> PieceLattice:
    """One per worker process, kept between tasks."""
    if (path, theta) not in LATTICES:
        LATTICES[path, theta] = PieceLattice(path, theta)
    return LATTICES[path, theta]


def encode(
    docs: DataFrame, text: str = "text", row_key: str = "doc_id", path: str | None = None, theta: float = THETA, seed: int = 0
) -> DataFrame:
    """All columns of ``docs`` and ``piece_ids``: one sampled segmentation per row.

    The sample is a function of the row key, the text and ``seed``.  Null texts are
    encoded as empty ones, which are the blank in front alone; rows with a null key
    share one seed, and so do rows with the same key.
    """
    path = path or default_path("piece_bpe_32k.model")

    def sample(texts: pa.Array, seeds: pa.Array) -> list[pa.Array]:
        found = lattice(path, theta).sample(texts, seeds.to_numpy().view(np.uint64))
        bounds = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(found)))]

    seeds = F.xxhash64(F.col(row_key).cast("string"), F.lit(seed))
    return with_columns(docs, text, {"piece_ids": "array<int>"}, sample, (seeds,))


def decode(encoded: DataFrame, ids: str = "piece_ids", path: str | None = None) -> DataFrame:
    """All columns and ``decoded``: the text of the ids, exactly as it was encoded; null for null.

    Built-in functions do it: every id becomes the bytes of its piece in hexadecimal
    digits, and the bytes of all become the text without the blank in front.
    """
    model = PieceLattice(path or default_path("piece_bpe_32k.model"))
    table = F.split(F.lit(",".join(piece.hex() for piece in model.bytes_of)), ",")  # folded to one literal
    digits = F.array_join(F.transform(F.col(ids), lambda n: F.element_at(table, n + 1)), "")
    text = F.decode(F.unhex(digits), "UTF-8")
    return encoded.withColumn("decoded", F.substring(text, 2, 2**31 - 1))
