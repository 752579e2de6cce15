"""Language identification by prediction by partial matching with frozen statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.common import with_columns
from corpuskit.operators.lookup import lookup_join
from corpuskit.session import cut_lineage

UNKNOWN = "und"
ROWS_PER_LANGUAGE = 240
ORDER = 4
MIN_COUNT = 6
EVIDENCE_BYTES = 64  # a score weighs the advantage in bits of this many bytes
LONG_TEXT = 1 << 20  # bytes; longer texts are coded in pieces
DEAD, ROOT = 0, 1


@dataclass
class ContextTrees:
    """The byte contexts of all languages in one tree; costs in bits, one column a language.

    ``child[node * width + symbol]``; nodes from ``inner`` on have no children.
    """

    languages: list[str]
    symbols: np.ndarray  # byte -> symbol; 0 for bytes never seen
    width: int
    inner: int
    child: np.ndarray
    order: int
    cost: np.ndarray  # what a position costs whose longest known string is the node
    context: np.ndarray  # the part of ``cost`` that stands for the position behind it

    def deepest(self, data: np.ndarray) -> np.ndarray:
        """For each byte, the node of the longest known string that ends there."""
        symbol = self.symbols[data].astype(np.int32)
        node = self.child[ROOT * self.width + symbol]
        found = np.where(node > DEAD, node, ROOT)
        for _ in range(self.order):
            before = np.empty_like(node)
            before[0] = DEAD
            np.minimum(node[:-1], self.inner, out=before[1:])
            before *= self.width
            before += symbol
            node = self.child[before]
            np.copyto(found, node, where=node > DEAD)
        return found

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Exact code length in bits of each text under each language."""
        long = [n for n, t in enumerate(texts) if len(t) > LONG_TEXT]
        if long:
            bits = self.code_lengths([t if len(t) <= LONG_TEXT else b"" for t in texts])
            for n in long:
                bits[n] = self.long_code_length(texts[n])
            return bits
        data = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes + 1) - 1
        found = self.deepest(data)
        found[ends] = ROOT  # the mark between texts costs nothing and ends every context
        costs = self.cost[found]
        costs[ends] = 0
        total = np.add.reduceat(costs, np.append(0, ends[:-1] + 1), axis=0, dtype=np.float64)
        last = np.where(sizes > 0, found[ends - 1], ROOT)
        return total + self.context[ROOT] - self.context[last]

    def long_code_length(self, text: bytes) -> np.ndarray:
        """The same for one text, piece by piece: a piece needs the last bytes before it as context only."""
        total, found = np.zeros(len(self.languages)), np.zeros(0)
        for at in range(0, len(text), LONG_TEXT):
            back = min(at, self.order)
            data = np.frombuffer(text, np.uint8, min(LONG_TEXT, len(text) - at) + back, at - back)
            found = self.deepest(data)[back:]
            total += self.cost[found].sum(axis=0, dtype=np.float64)
        return total + self.context[ROOT] - self.context[found[-1]]


def grow(texts: list[bytes], labels: list[int], languages: list[str], order: int = ORDER, min_count: int = MIN_COUNT) -> ContextTrees:
    """Count every string of up to ``order + 1`` bytes; keep, per language, those seen ``min_count`` times.

    A context with T followers, of which the q kept symbols make up S, codes a kept
    symbol seen n times with n / (T + q) and escapes to the next shorter context
    with (T - S + q) / (T + q).  Below the empty context all bytes are equal.
    """
    width_l = len(languages)
    data = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    language = np.repeat(np.array(labels, np.int16), sizes + 1)
    present = np.unique(data)
    present = present[present > 0]
    symbols = np.zeros(256, np.uint8 if len(present) < 255 else np.int16)
    symbols[present] = np.arange(1, len(present) + 1)
    width = len(present) + 1
    symbol = symbols[data]

    counts = [np.zeros((2, width_l))]  # by depth: rows for its nodes; depth 0 has the dead node and the root
    parents, letters = [np.array([DEAD, DEAD])], [np.array([0, 0])]
    depth_of = [np.array([0, 0])]
    followers, kept_sum, kept_n = [], [], []
    tables = []
    first, node = ROOT, np.full(len(data), ROOT, np.int32)
    nodes = 2
    for depth in range(1, order + 2):
        before = node if depth == 1 else np.append(np.int32(DEAD), node[:-1])
        level = len(counts[-1]) - (1 if depth == 1 else 0)  # nodes that may have children here
        alive = np.flatnonzero((before > DEAD) & (symbol > 0))
        small = np.int32 if level * width < 2**31 else np.int64
        keys, which = np.unique((before[alive].astype(small) - small(first)) * small(width) + symbol[alive], return_inverse=True)
        seen = np.bincount(which * width_l + language[alive], minlength=len(keys) * width_l).reshape(len(keys), width_l)
        kept = seen * (seen >= min_count)
        keep = np.flatnonzero(kept.any(axis=1))
        owner = keys // width
        for found, value in ((followers, seen), (kept_sum, kept), (kept_n, kept > 0)):
            found.append(np.stack([np.bincount(owner, value[:, n], level) for n in range(width_l)], axis=1))
        numbers = np.zeros(len(keys), np.int32)
        numbers[keep] = nodes + np.arange(len(keep))
        table = np.zeros(level * width, np.int32)
        table[keys] = numbers
        tables.append(table)
        counts.append(kept[keep])
        parents.append(first + owner[keep])
        letters.append(keys[keep] % width)
        depth_of.append(np.full(len(keep), depth))
        nxt = np.zeros(len(data), np.int32)
        nxt[alive] = numbers[which]
        first, node = nodes, nxt
        nodes += len(keep)
    inner = first  # the deepest level has no children
    child = np.concatenate([np.zeros(width, np.int32), *tables, np.zeros(width, np.int32)])
    count, parent, letter, depth = (np.concatenate(x) for x in (counts, parents, letters, depth_of))
    bound = [np.zeros((1, width_l))]
    total, inside, distinct = (np.concatenate(bound + x + [np.zeros((nodes - inner, width_l))]) for x in (followers, kept_sum, kept_n))

    member = count > 0
    member[ROOT] = True
    with np.errstate(divide="ignore", invalid="ignore"):
        escape = np.where((distinct > 0) & member, -np.log2((total - inside + distinct) / (total + distinct)), 0.0)
        direct = -np.log2(count / (total + distinct)[parent])
    suffix = np.full(nodes, ROOT)
    escapes, cost = np.zeros((nodes, width_l)), np.zeros((nodes, width_l))
    escapes[ROOT] = escape[ROOT]
    cost[ROOT] = 8.0  # a byte that no language knows: all escapes, then one of 256
    for d in range(1, order + 2):
        at = np.flatnonzero(depth == d)
        if d > 1:
            suffix[at] = child[suffix[parent[at]] * width + letter[at]]
        shorter = np.where((suffix[at] == ROOT)[:, None], 8.0, cost[suffix[at]])
        cost[at] = np.where(member[at], direct[at], escape[parent[at]] + shorter)
        escapes[at] = escapes[suffix[at]] + escape[at]
    base = cost - np.where((np.arange(nodes) > ROOT)[:, None], escapes[parent], 0.0)
    behind = np.where((depth <= order)[:, None], escapes, escapes[suffix])
    return ContextTrees(
        languages, symbols, width, inner, child, order,
        (base + behind).astype(np.float32), behind,
    )


def learn(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    rows: int = ROWS_PER_LANGUAGE,
    order: int = ORDER,
    min_count: int = MIN_COUNT,
) -> ContextTrees | None:
    """Trees of every language from a bounded sample: ``rows`` whole texts a language.

    The sample is the rows with the smallest hash of id, language and text, so it does
    not depend on how the table is stored, and rows with one id (or without) have
    places of their own.  Copies of a whole row have one place.  The places counted
    per language, within a few hundredths, give a bound on the hash that about twice
    as many pass, so that only those meet to be ranked.  None if no row has a text and
    a language.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    place = F.xxhash64(F.col(doc_id).cast("string"), F.col(lang), F.col(text))
    counts = known.groupBy(F.col(lang).alias("lang")).agg(F.approx_count_distinct(place).alias("_places"))
    share = (place.cast("double") + 2.0**63) / 2.0**64
    keyed = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), place.alias("_order"), share.alias("_share"))
    ranks = lookup_join(keyed.select("lang", "_order", "_share"), cut_lineage(counts), "lang", "inner", settled=True)
    close = ranks.where(F.col("_share") * F.col("_places") <= 2 * rows + 100)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_order"))
    ids = close.select("lang", "_order").distinct().withColumn("_n", nth).where(F.col("_n") <= rows).select("lang", "_order")
    # At most ``rows`` pairs of a name and a number a language; copies of a row share a number.
    ids = cut_lineage(ids)
    sample = keyed.join(F.broadcast(ids), ["lang", "_order"]).groupBy("lang", "_order").agg(F.min("text").alias("text"))
    found = sample.orderBy("_order", "lang").select("lang", "text").toArrow().to_pydict()
    if not found["lang"]:
        return None
    languages = sorted(set(found["lang"]))
    labels = [languages.index(x) for x in found["lang"]]
    return grow([t.encode("utf-8", "replace").replace(b"\x00", b" ") for t in found["text"]], labels, languages, order, min_count)


def predicted(docs: DataFrame, trees: ContextTrees | None, text: str = "text") -> DataFrame:
    """All columns of ``docs``, then ``lang_pred`` and ``score`` (columns of these names are replaced).

    ``score`` is the share of the best language if every language had equal odds and
    the text spoke with the weight of ``EVIDENCE_BYTES`` bytes at most.  Null, blank
    and letterless texts, and every text without a learned language, are ``und``
    with score 0.  Equal code lengths go to the language first by name.
    """
    added = {"lang_pred": "string", "score": "double"}
    if trees is None:
        kept = docs.select([c for c in docs.columns if c not in added])
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def predict(texts: pa.Array, letters: pa.Array) -> list[pa.Array]:
        spoken = [t if has else None for t, has in zip(texts.to_pylist(), letters.to_pylist())]
        language, score = score_texts(sent.value, spoken)
        return [pa.array(language, pa.string()), pa.array(score, pa.float64())]

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return with_columns(docs, text, added, predict, (has_letter,))


def score_texts(trees: ContextTrees, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    raw = [(t or "").encode("utf-8", "replace").replace(b"\x00", b" ") for t in texts]
    bits = trees.code_lengths(raw)
    best = bits.argmin(axis=1)
    sizes = np.maximum(1, np.fromiter(map(len, raw), np.int64, len(raw)))
    ahead = (bits - bits.min(axis=1, keepdims=True)) * np.minimum(1, EVIDENCE_BYTES / sizes)[:, None]
    score = 1 / np.exp2(-ahead).sum(axis=1)
    blank = np.array([t is None for t in texts], bool)
    score[blank] = 0
    return [UNKNOWN if b else trees.languages[n] for n, b in zip(best.tolist(), blank.tolist())], score
