"""Unigram subword models: loss, token importance, pruning, training."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.config import SPECIAL_TOKENS
from corpuskit.functions import lattice, text as tx
from corpuskit.functions.subwords import (
    UNKNOWN_LOGP, WALKED_CHARS, best_path, best_reach, unigram_segmenter, word_edges,
)
from corpuskit.operators import counts as ct
from corpuskit.operators.vocab import symbol_vocab
from corpuskit.session import BROADCAST_ROWS, cut_lineage, fetch, spread

SEED_FACTOR = 10
PRUNE_RATIO = 0.2
HELD_CHARS = 1_000_000  # characters of words that are walked together


def model_dict(unigram: DataFrame) -> dict[str, float]:
    """The model on the driver.  Its size is set by the asked vocabulary and checked here."""
    held = fetch(unigram.select("token", "logp"))
    if held is None:
        raise ValueError(f"a unigram model may hold at most {BROADCAST_ROWS} tokens")
    return dict(zip(held.column("token").to_pylist(), held.column("logp").to_pylist()))


def path_loss(tokens: list[str], logp: dict[str, float]) -> float:
    return -math.fsum(logp.get(t, UNKNOWN_LOGP) for t in tokens)


def corpus_loss(word_types: DataFrame, logp: dict[str, float]) -> DataFrame:
    """One row ``loss``: negative log likelihood of the corpus under the best segmentations."""
    shared = word_types.sparkSession.sparkContext.broadcast(logp)

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        segment = unigram_segmenter(model)
        for batch in data:
            words, freqs = (batch.column(c).to_pylist() for c in ("word", "freq"))
            losses = [f * path_loss(segment(w), model) for w, f in zip(words, freqs)]
            yield pa.RecordBatch.from_arrays([pa.array(losses, pa.float64())], names=["loss"])

    return (
        word_types.select("word", "freq").mapInArrow(run, "loss double")
        .agg(F.coalesce(F.sum("loss"), F.lit(0.0)).alias("loss"))
    )


def word_gains(word: str, freq: int, model: dict[str, float]) -> dict[str, float]:
    """What taking each token off the word's best path costs; single characters stay in every model."""
    edges = word_edges(word, model)
    reach = best_reach(edges)
    path = best_path(reach)
    if path is None:
        return {}  # already spelled in characters: no single token matters
    gains = dict.fromkeys(t for t in path if len(t) > 1)
    for token in gains:
        # Nothing changes before the token first ends.
        score, start, _ = best_reach(edges, token, reach[: word.find(token) + len(token)])[-1]
        left = -path_loss(list(word), model) if start < 0 else score
        gains[token] = freq * (reach[-1][0] - left)
    return gains


def summed_gains(words: DataFrame, tokens: list[str], logp: dict[str, float]) -> DataFrame:
    """``(token, importance)`` under the model ``logp``, tokens as places in ``tokens``; at most one row a token.

    Words are walked together, long ones (over ``WALKED_CHARS``) one at a time; a task sends one sum a token.
    """
    shared = words.sparkSession.sparkContext.broadcast((tokens, logp))

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, model = shared.value
        place = {t: n for n, t in enumerate(names)}
        pieces = lattice.Pieces(model)
        # Special tokens are no seeds: they never leave the model.
        place_of = np.fromiter((place.get(t, -1) for t in pieces.tokens), np.int64, len(pieces.tokens))
        total, met = np.zeros(len(names)), np.zeros(len(names), bool)

        def add(at: np.ndarray, gain: np.ndarray) -> None:
            np.add.at(total, at[at >= 0], gain[at >= 0])
            met[at[at >= 0]] = True

        def count(words: list[str], freqs: np.ndarray) -> None:
            for n in lattice.by_length(words, len(pieces.codes), WALKED_CHARS):
                some = [words[x] for x in n.tolist()]
                for piece, gain in lattice.gains(pieces, some, freqs[n], lambda w: -path_loss(list(w), model)):
                    add(place_of[piece], gain)
            for word, freq in zip(words, freqs.tolist()):
                if len(word) > WALKED_CHARS:
                    found = word_gains(word, freq, model)
                    add(np.array([place.get(t, -1) for t in found], np.int64), np.array(list(found.values())))

        held, freqs, chars = [], [], 0
        for batch in data:
            held += batch.column("word").to_pylist()
            freqs.append(batch.column("freq").to_numpy())
            chars += pc.sum(pc.utf8_length(batch.column("word"))).as_py() or 0
            if chars >= HELD_CHARS:
                count(held, np.concatenate(freqs))
                held, freqs, chars = [], [], 0
        if held:
            count(held, np.concatenate(freqs))
        at = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["token", "gain"])

    partial = words.select("word", "freq").mapInArrow(run, "token int, gain double")
    return partial.groupBy("token").agg(F.sum("gain").alias("importance"))


def token_importance(word_types: DataFrame, logp: dict[str, float]) -> DataFrame:
    """``(token, importance)``: how much the corpus loss grows when the token is taken away.

    Only words whose best path uses a token can change, so each word is
    segmented again once per distinct multi-character token on its path.
    Tokens on no path are absent; their importance is 0.
    """
    tokens = list(logp)
    found = summed_gains(word_types, tokens, logp)
    names = found.sparkSession.createDataFrame(list(enumerate(tokens)), "place int, name string")
    joined = found.join(F.broadcast(names), F.col("token") == F.col("place"))  # one row a token of the model
    return joined.select(F.col("name").alias("token"), "importance")


def prune(
    word_types: DataFrame,
    seeds: DataFrame,
    target: int,
    special: dict[str, int] = SPECIAL_TOKENS,
    ratio: float = 0.1,
) -> DataFrame:
    """Take the least important share of tokens away until ``target`` tokens are left.

    ``seeds`` is ``(token, logp, seed_rank)`` without the special tokens, which
    count towards the size and are never removed, like single characters.

    A round walks all words anew, which is cheaper than keeping what each of
    them gains: only one number a token leaves a task.  Seed order breaks ties.
    """
    logp = model_dict(seeds.orderBy("seed_rank"))
    tokens = list(logp)
    shield = {t: UNKNOWN_LOGP for t in special}
    words = cut_lineage(spread(word_types.select("word", "freq"))).persist()
    while len(logp) + len(special) > target:
        removable = [n for n, t in enumerate(tokens) if len(t) > 1 and t in logp and t not in special]
        if not removable:
            break
        n = min(max(1, int(len(removable) * ratio)), len(logp) + len(special) - target)
        found = summed_gains(words, tokens, {**shield, **logp}).toArrow()
        importance = np.zeros(len(tokens))
        importance[found.column("token").to_numpy()] = found.column("importance").to_numpy()
        for token in sorted(removable, key=lambda t: (importance[t], t))[:n]:
            del logp[tokens[token]]
    words.unpersist()
    rows = [(t, UNKNOWN_LOGP) for t in special] + list(logp.items())
    return word_types.sparkSession.createDataFrame(rows, "token string, logp double")


def train(
    word_types: DataFrame,
    seed_types: DataFrame,
    vocab_size: int,
    special: dict[str, int] = SPECIAL_TOKENS,
    seed_factor: int = SEED_FACTOR,
) -> tuple[DataFrame, DataFrame]:
    """``(vocab, unigram)`` from word counts; seeds are drawn from ``seed_types``."""
    settled = spread(ct.ranked(word_types)).persist()
    seeds = ct.seed_subwords(
        settled if seed_types is word_types else seed_types, vocab_size * seed_factor
    )
    seeds = cut_lineage(seeds.where(~F.col("token").isin(list(special))))
    word_types = settled
    unigram = prune(word_types, seeds, vocab_size, special, PRUNE_RATIO)
    word_types.unpersist()
    # The model has at most ``vocab_size * seed_factor`` rows: one sorted partition is enough.
    return symbol_vocab(unigram, special), unigram


def line_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Counts of marked lines: blanks become the space mark, so a line stays one word."""
    marked = docs.select(
        F.col(doc_id).alias("doc_id"), tx.mark_spaces(F.col(text)).alias("text")
    )
    return ct.stripped_word_counts(marked)
