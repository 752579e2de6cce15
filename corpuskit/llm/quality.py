"""Quality grades: a cumulative-link model over hashed text, with ordered thresholds."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import with_columns

TRAINING_ROWS = 3_000
GRAM_BITS, WORD_BITS = 14, 16
DENSE = 4
SIZE = (1 << GRAM_BITS) + (1 << WORD_BITS) + DENSE
GRAM_SCALE = 8.0
STEPS = 120
LONG_TEXT = 1 << 20  # bytes; longer texts (by a bound on their characters) are worked through in pieces
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)  # odd constants of a multiplicative hash
with np.errstate(over="ignore"):
    POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


@dataclass
class Features:
    """Hashed features of some texts: per group, bucket numbers, their rows and a weight for each row."""

    texts: int
    grams: np.ndarray
    gram_rows: np.ndarray
    gram_weight: np.ndarray
    words: np.ndarray
    word_rows: np.ndarray
    word_weight: np.ndarray
    dense: np.ndarray

    def scores(self, weights: np.ndarray) -> np.ndarray:
        grams = np.bincount(self.gram_rows, weights[self.grams], self.texts) * self.gram_weight
        words = np.bincount(self.word_rows, weights[self.words], self.texts) * self.word_weight
        return grams + words + self.dense @ weights[-DENSE:]


def features(texts: list[str | None]) -> Features:
    """Byte trigrams as shares, distinct words as a unit vector, and four numbers on length and repetition."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"  ".join(raw) + b"    ", np.uint8)
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    rows = np.repeat(np.arange(len(raw)), sizes)
    # Bytes of the texts themselves, without the two blanks behind each.
    places = np.arange(int(sizes.sum())) + 2 * rows
    grams = gram_numbers(data)[places]
    hashes, word_starts = word_hashes(data)
    owner = np.searchsorted(starts, word_starts, "right") - 1
    count = np.bincount(owner, minlength=len(raw))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    bucket = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    keys = np.unique((owner << WORD_BITS) | bucket)
    word_rows = keys >> WORD_BITS
    distinct = np.bincount(word_rows, minlength=len(raw))
    dense = np.zeros((len(raw), DENSE))
    dense[:, 0] = 1
    dense[:, 1] = np.log1p(count) / 4
    dense[:, 2] = distinct / np.maximum(1, count)
    dense[:, 3] = 3 * np.bincount(owner, again, len(raw)) / np.maximum(1, count)
    return Features(
        len(raw), grams, rows, GRAM_SCALE / np.maximum(1, sizes),
        (keys & ((1 << WORD_BITS) - 1)) + (1 << GRAM_BITS), word_rows, 1 / np.sqrt(np.maximum(1, distinct)), dense,
    )


WORD_END = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def long_features(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of one long text, piece by piece: trigram counts, word buckets that occur, and the dense ones."""
    grams, buckets = np.zeros(1 << GRAM_BITS, np.int64), np.zeros(1 << WORD_BITS, bool)
    count = again = 0
    last = np.zeros(0, np.uint64)
    at = 0
    while at < len(raw):
        end = WORD_END.search(raw, at + LONG_TEXT)
        stop = end.end() if end else len(raw)
        data = np.frombuffer(raw[at : stop + 2] + b"  "[: max(0, stop + 2 - len(raw))], np.uint8)
        grams += np.bincount(gram_numbers(data), minlength=len(grams))
        hashes, _ = word_hashes(data[: stop - at])
        buckets[(hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)] = True
        joined = np.concatenate([last, hashes])
        again += int((joined[1:] == joined[:-1]).sum())
        count += len(hashes)
        last = joined[-1:]
        at = stop
    dense = np.array([1, np.log1p(count) / 4, buckets.sum() / max(1, count), 3 * again / max(1, count)])
    return grams, buckets, dense


def gram_numbers(data: np.ndarray) -> np.ndarray:
    """The bucket of the trigram at every byte but the last two."""
    wide = data.astype(np.uint32)
    with np.errstate(over="ignore"):
        mixed = wide[:-2] * MULTIPLIERS[0] + wide[1:-1] * MULTIPLIERS[1] + wide[2:] * MULTIPLIERS[2]
        return (mixed >> np.uint32(32 - GRAM_BITS)).astype(np.int32)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and the place of every run of letters, digits and non-ASCII bytes."""
    low = LOWER[data]
    inside = IN_WORD[low]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begin, end = edge[::2], edge[1::2]
    size = end - begin
    nth = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore"):
        terms = (low[inside].astype(np.uint64) + np.uint64(1)) * POWERS[nth & 63]
        hashes = np.add.reduceat(terms, np.cumsum(size) - size) if len(size) else np.zeros(0, np.uint64)
        hashes ^= hashes >> np.uint64(32)
        return hashes * np.uint64(0x9E3779B97F4A7C15), begin


@dataclass
class GradeModel:
    """P(grade >= k) = sigmoid(score - thresholds[k - 1]) with increasing thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: list[str | None]) -> np.ndarray:
        """One column per grade above the lowest."""
        score = np.zeros(len(texts))
        short, long = by_size(texts)
        score[short] = features([texts[n] for n in short]).scores(self.weights)
        for n in long:
            raw = texts[n].encode("utf-8", "replace")
            grams, buckets, dense = long_features(raw)
            words = self.weights[len(grams) : len(grams) + len(buckets)][buckets].sum(dtype=np.float64) / np.sqrt(max(1, buckets.sum()))
            score[n] = grams @ self.weights[: len(grams)].astype(np.float64) * GRAM_SCALE / len(raw) + words + dense @ self.weights[-DENSE:]
        return sigmoid(score[:, None] - self.thresholds[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def by_size(texts: list[str | None]) -> tuple[list[int], list[int]]:
    """Places of the texts that are worked through together, and of the long ones."""
    short = [n for n, t in enumerate(texts) if len(t or "") <= LONG_TEXT // 4]
    return short, sorted(set(range(len(texts))) - set(short))


def design(texts: list[str | None], each: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, buckets and values of the hashed features, one entry per text and bucket, and the dense ones."""
    parts, all_dense = [], np.zeros((len(texts), DENSE))
    short, long = by_size(texts)
    for at in range(0, len(short), each):
        some = np.array(short[at : at + each])
        found = features([texts[n] for n in some])
        keys = np.concatenate([found.gram_rows * SIZE + found.grams, found.word_rows * SIZE + found.words])
        values = np.concatenate([found.gram_weight[found.gram_rows], found.word_weight[found.word_rows]])
        keys, inverse = np.unique(keys, return_inverse=True)
        parts.append((some[keys // SIZE].astype(np.int32), (keys % SIZE).astype(np.int32), np.bincount(inverse, values).astype(np.float32)))
        all_dense[some] = found.dense
    for n in long:
        raw = texts[n].encode("utf-8", "replace")
        grams, held, all_dense[n] = long_features(raw)
        values = np.concatenate([grams * GRAM_SCALE / len(raw), held / np.sqrt(max(1, held.sum()))])
        at = np.flatnonzero(values)
        parts.append((np.full(len(at), n, np.int32), at.astype(np.int32), values[at].astype(np.float32)))
    rows, buckets, values = (np.concatenate(x) for x in zip(*parts))
    return rows, buckets, values, all_dense


def likelihood(
    params: list[np.ndarray], data: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], grade: np.ndarray, decay: float
) -> tuple[float, list[np.ndarray]]:
    """Mean log likelihood less ``decay / 2`` times the squared weights, and its slopes.

    ``params``: weights, first threshold, logs of the gaps between thresholds.  With the tail
    probabilities t(g) >= t(g + 1) of a row of grade g its chance is t(g) - t(g + 1).
    """
    weights, base, gaps = params
    rows, buckets, values, dense = data
    n, top = len(grade), len(gaps) + 1
    theta = base[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
    score = np.bincount(rows, weights[buckets] * values, n) + dense @ weights[-DENSE:]
    tail = np.concatenate([np.ones((n, 1)), sigmoid(score[:, None] - theta), np.zeros((n, 1))], axis=1)
    at, nxt = tail[np.arange(n), grade], tail[np.arange(n), grade + 1]
    chance = np.maximum(at - nxt, 1e-12)
    by_score = (1 - at - nxt) / n
    by_theta = np.zeros((n, top + 2))
    by_theta[np.arange(n), grade] -= at * (1 - at) / chance / n
    by_theta[np.arange(n), grade + 1] += nxt * (1 - nxt) / chance / n
    by_theta = by_theta.sum(axis=0)[1 : top + 1]
    slope = np.bincount(buckets, by_score[rows] * values, len(weights))
    slope[-DENSE:] += dense.T @ by_score
    slope -= decay * weights
    by_gap = np.cumsum(by_theta[::-1])[::-1][1:] * np.exp(gaps)
    value = float(np.log(chance).mean() - decay / 2 * (weights @ weights))
    return value, [slope, by_theta.sum(keepdims=True), by_gap]


def fit(texts: list[str | None], grades: list[int], steps: int = STEPS, decay: float = 2e-4) -> GradeModel:
    """Maximum likelihood by full-batch Adam; grades are 0, 1, …  One grade alone gives a constant."""
    grade = np.array(grades)
    top = int(grade.max())
    weights = np.zeros(SIZE)
    if top == 0 or len(set(grades)) == 1:
        low = np.where(np.arange(1, top + 1) <= grade.min(), -4.0, 4.0) if top else np.zeros(0)
        return GradeModel(weights, low)
    rows, buckets, values, dense = design(texts)
    above = np.array([(grade >= k).mean() for k in range(1, top + 1)]).clip(1e-3, 1 - 1e-3)
    first = np.log(1 / above - 1)
    gaps = np.log(np.diff(first).clip(1e-2))
    params = [weights, first[:1].copy(), gaps]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        _, slopes = likelihood(params, (rows, buckets, values, dense), grade, decay)
        for p, g, (m, v) in zip(params, slopes, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights, base, gaps = params
    return GradeModel(weights.astype(np.float32), base[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))))


def learn(
    docs: DataFrame, ratings: DataFrame, text: str = "text", doc_id: str = "doc_id", grade: str = "grade", rows: int = TRAINING_ROWS
) -> GradeModel | None:
    """Fit on a bounded sample: the ``rows`` ratings with the smallest hash of their id.

    Only ratings of documents count.  Null grades, ids and texts are left out; of
    several grades for one id the lowest holds, and of repeated ids no more than
    ``rows`` texts in all are used.  None if nothing is left.
    """
    graded = ratings.where(F.col(grade).isNotNull() & F.col(doc_id).isNotNull())
    graded = graded.groupBy(F.col(doc_id).alias("_id")).agg(F.min(F.col(grade).cast("int")).alias("_grade"))
    present = graded.join(docs.select(F.col(doc_id).alias("_id")), "_id", "left_semi")
    chosen = present.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    own = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    sample = own.join(F.broadcast(chosen), "_id").orderBy(F.xxhash64("_id"), F.xxhash64("_text")).limit(rows).toArrow().to_pydict()
    if not sample["_id"]:
        return None
    return fit(sample["_text"], sample["_grade"])


def graded(docs: DataFrame, model: GradeModel | None, text: str = "text", select: int = 1, least: float = 0.5) -> DataFrame:
    """All columns of ``docs``, then ``expected_grade``, ``tail_probability`` and ``keep``.

    ``tail_probability`` is P(grade >= ``select``); ``keep``: it is at least ``least``.
    Columns of these names are replaced.  Null and empty texts get the grade that
    length and bias alone give.  Without a model everything is kept with nulls.
    """
    added = {"expected_grade": "double", "tail_probability": "double", "keep": "boolean"}
    if model is None:
        kept = docs.select([c for c in docs.columns if c not in added])
        nothing = F.lit(None).cast("double")
        return kept.withColumns({"expected_grade": nothing, "tail_probability": nothing, "keep": F.lit(True)})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def grade(texts: pa.Array) -> list[pa.Array]:
        tails = sent.value.tails(texts.to_pylist())
        tail = tails[:, select - 1] if tails.shape[1] >= select else np.zeros(len(tails))
        return [pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= least)]

    return with_columns(docs, text, added, grade, size=500_000)


def grades_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from two flags: 0 poor, 1 sound but toxic, 2 sound; null where quality is null."""
    clean = F.when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, clean).alias("grade"))
