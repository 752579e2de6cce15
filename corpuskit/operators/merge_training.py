"""Learning merges (byte-pair by count, WordPiece by score) over a table of word types.

A merge changes the counts the next choice depends on, so the plain loop costs
one cluster pass per merge.  Here the totals of the pairs are kept on the driver
(at most ``PAIRS_HELD``), and one pass tries a whole list of guessed merges: every
task indexes its words by pair, plays the merges on the places of their pairs
only, and reports the signed changes of the pairs around them; Spark sums the
changes per merge.  The driver then plays the list on its exact totals.  Guesses
are kept up to the first one that is not the best pair of its state; what is
best there is known as well and is the first merge of the next list.  The result
is the same as one merge at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import pair_merging as pm
from corpuskit.functions.subwords import as_lists, list_lengths
from corpuskit.operators import counts as ct
from corpuskit.operators.encode import id_lookup
from corpuskit.operators.vocab import symbol_vocab
from corpuskit.session import cut_lineage, spread

WORD_SCHEMA = "freq bigint, first bigint, symbols array<int>"
CHANGE_SCHEMA = "step int, code bigint, made bigint, lost bigint, first bigint, offset bigint"
GUESS_WORDS = 300_000  # word types the driver guesses from: the most frequent ones, and a draw from the others
GUESS_TOP = 200_000
SENT_WORDS, SENT_AT_LEAST = 4_000_000, 5_000  # words sent to the driver for WordPiece guesses: in all, and a pass beyond that
FEWEST_GUESSES, MOST_GUESSES = 64, 256  # merges tried in one pass
PAIRS_HELD = 500_000  # pairs whose totals the driver keeps
LOOKED_UP = 2_000  # pairs whose first place is looked up in one pass
BLOCK_SYMBOLS = 2_000_000  # symbols a task indexes at a time
REBASE_AFTER = 256  # merges replayed per pass before the word table is written anew
NEAR_TOP = 16  # pairs near the top of a guessed state whose first place is looked up there
SYMBOL = -1  # step of rows that hold symbol weights
MERGED = -1  # code of a row that carries how often a merge took place

Merge = tuple[int, int, int]  # left, right and merged symbol id


@dataclass
class Symbols:
    """The vocabulary while it grows.  Its size is bounded by the asked vocabulary."""

    tokens: list[str]  # by id
    sizes: list[int]  # characters per symbol
    ids: dict[str, int]
    prefix: str = ""

    def copy(self) -> Symbols:
        return Symbols(list(self.tokens), list(self.sizes), dict(self.ids), self.prefix)

    def merged(self, code: int) -> Merge:
        """Name the merged symbol; a string met before keeps its id."""
        left, right = code >> pm.SHIFT, code & ((1 << pm.SHIFT) - 1)
        token = self.tokens[left] + self.tokens[right].removeprefix(self.prefix)
        if token not in self.ids:
            self.ids[token] = len(self.tokens)
            self.tokens.append(token)
            self.sizes.append(self.sizes[left] + self.sizes[right])
        return left, right, self.ids[token]


def index_of(records: list[pa.RecordBatch], sizes: np.ndarray) -> pm.PairIndex:
    table = pa.Table.from_batches(records).combine_chunks()
    symbols = table.column("symbols").combine_chunks()
    symbols = symbols.chunk(0) if isinstance(symbols, pa.ChunkedArray) else symbols
    flat = symbols.flatten().to_numpy(zero_copy_only=False)
    freq, first = (table.column(c).to_numpy() for c in ("freq", "first"))
    return pm.PairIndex(flat, list_lengths(symbols), freq, first, sizes)


def blocks(data: Iterator[pa.RecordBatch], sizes: np.ndarray, merges: list[Merge]) -> Iterator[pm.PairIndex]:
    """The words of a task in blocks, each indexed by pair, after the given merges."""
    held, size = [], 0

    def ready() -> pm.PairIndex:
        index = index_of(held, sizes)
        for merge in merges:
            index.merge(*merge)
        return index

    for record in data:
        held.append(record)
        size += len(record.column("symbols").flatten())
        if size >= BLOCK_SYMBOLS:
            yield ready()
            held, size = [], 0
    if held:
        yield ready()


def change_rows(steps: list[int], changes: list[pm.Changes | None]) -> pa.RecordBatch:
    """Changes summed per step and pair; a merge also says how often it took place.

    Steps 2n + 1 are merges; steps 2n hold pairs looked up before them.
    """
    kept = [(s, c) for s, c in zip(steps, changes) if c is not None]
    if not kept:
        return pa.RecordBatch.from_pylist([], _schema())
    step = np.repeat([s for s, _ in kept], [len(c.code) for _, c in kept])
    joined = [np.concatenate([getattr(c, f) for _, c in kept]) for f in ("code", "weight", "first", "offset")]
    rows = pm.summed(step, pm.Changes(*joined, 0))
    done = [(s, c.merged) for s, c in kept if s % 2]
    n = len(done)
    marks = [np.array([s for s, _ in done], np.int64), np.full(n, MERGED), np.array([m for _, m in done], np.int64)]
    marks += [np.zeros(n, np.int64), np.full(n, pm.NEVER), np.zeros(n, np.int64)]
    columns = [np.concatenate([r, m]).astype(np.int64) for r, m in zip(rows, marks)]
    return pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, _schema())], schema=_schema())


def _schema() -> pa.Schema:
    return pa.schema([("step", pa.int32())] + [(c, pa.int64()) for c in ("code", "made", "lost", "first", "offset")])


def summed(partial: DataFrame) -> DataFrame:
    """Changes of all tasks together.  First place and offset share one number, so that ``min`` stays in the hash aggregate."""
    met = F.when(F.col("first") < pm.NEVER, ct.packed(F.col("first"), F.col("offset"), ct.AT_BITS))
    rows = partial.groupBy("step", "code").agg(F.sum("made").alias("made"), F.sum("lost").alias("lost"), F.min(met).alias("met"))
    return rows.select(
        "step", "code", "made", "lost",
        F.coalesce(ct.high_part(F.col("met"), ct.AT_BITS), F.lit(pm.NEVER)).alias("first"),
        F.coalesce(ct.low_part(F.col("met"), ct.AT_BITS), F.lit(0)).alias("offset"),
    )


def columns_of(rows: pa.Table, *names: str) -> list[np.ndarray]:
    return [rows.column(n).to_numpy() for n in names]


class MergeTrainer:
    """Driver side of the training: the model so far, the pair totals and the next guesses."""

    def __init__(
        self,
        counts: DataFrame,
        split: Callable[[Column], Column],
        special: dict[str, int],
        prefix: str = "",
        by_score: bool = False,
    ):
        self.by_score = by_score
        # The corpus is read and split once.
        word_types = ct.ranked(counts)
        word_types = word_types.withColumn("tokens", split(F.col("word")))
        # At most one entry per code point (twice that with a prefix): a bounded table.
        alphabet = symbol_vocab(ct.distinct_symbols(word_types), special).orderBy("id").toArrow()
        tokens = alphabet.column("token").to_pylist()
        self.symbols = Symbols(
            tokens,
            [0 if special_ else 1 for special_ in alphabet.column("is_special").to_pylist()],
            {t: i for i, t in enumerate(tokens)},
            prefix,
        )
        ids = id_lookup(alphabet)(F.col("tokens")).alias("symbols")
        self.words = cut_lineage(spread(word_types).select("freq", "first", ids)).persist()
        self.merges: list[Merge] = []
        self.in_base = 0  # merges already applied in ``words``
        self.left_to_send = SENT_WORDS
        self.sample = None if by_score else self.sampled()
        self.totals = self.counted()

    def indexed(self, words: DataFrame) -> pm.PairIndex | None:
        records = words.toArrow().to_batches()
        return index_of(records, np.array(self.symbols.sizes, np.int64)) if records else None

    def sampled(self) -> pm.PairIndex | None:
        """The most frequent words, and a draw from the others that stands for all of them."""
        top = self.words.orderBy(F.desc("freq"), "first").limit(GUESS_TOP).toArrow()
        if len(top) < GUESS_TOP:
            return index_of(top.to_batches(), np.array(self.symbols.sizes, np.int64)) if len(top) else None
        last = top.slice(len(top) - 1).to_pylist()[0]
        rarer = (F.col("freq") < last["freq"]) | ((F.col("freq") == last["freq"]) & (F.col("first") > last["first"]))
        others = self.words.where(rarer)
        n, weight = others.agg(F.count("*"), F.coalesce(F.sum("freq"), F.lit(0))).first()
        drawn = others.sample(min(1.0, (GUESS_WORDS - GUESS_TOP) / max(1, n)), seed=7).limit(GUESS_WORDS).toArrow()
        index = index_of([*top.to_batches(), *drawn.to_batches()], np.array(self.symbols.sizes, np.int64))
        index.freq = index.freq.astype(np.float64)
        index.freq[len(top) :] *= weight / max(1, index.freq[len(top) :].sum())
        return index

    def tasks(self, work: Callable[[pm.PairIndex], pa.RecordBatch], symbols: Symbols | None = None) -> DataFrame:
        """``work`` on every block of words, as they stand after the merges so far."""
        sizes = np.array((symbols or self.symbols).sizes, np.int64)
        todo = self.merges[self.in_base :]

        def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for index in blocks(data, sizes, todo):
                yield work(index)

        return self.words.select("freq", "first", "symbols").mapInArrow(run, CHANGE_SCHEMA)

    def counted(self) -> pm.PairTotals:
        """Totals of all pairs now, or of the ``PAIRS_HELD`` best ones."""
        by_score = self.by_score

        def work(index: pm.PairIndex) -> pa.RecordBatch:
            rows = change_rows([0], [index.now()])
            if not by_score:
                return rows
            symbols, weight = index.symbol_weights()
            none = np.zeros(len(symbols), np.int64)
            more = [none.astype(np.int32) + SYMBOL, symbols, weight, none, none + pm.NEVER, none]
            more = [pa.array(c).cast(f.type) for c, f in zip(more, _schema())]
            table = pa.Table.from_batches([rows, pa.RecordBatch.from_arrays(more, schema=_schema())])
            return table.combine_chunks().to_batches()[0]

        rows = cut_lineage(summed(self.tasks(work)).where(F.col("code") != MERGED))
        pairs, freq = rows.where("step = 0"), None
        measure = F.col("made").cast("double")
        if by_score:
            weights = rows.where(F.col("step") == SYMBOL)
            freq = np.zeros(len(self.symbols.tokens), np.int64)
            symbol, weight = columns_of(weights.select("code", "made").toArrow(), "code", "made")
            freq[symbol] = weight
            known = F.broadcast(weights.select(F.col("code").alias("symbol"), F.col("made").alias("f")))  # one row a symbol
            half = F.col("code").bitwiseAND((1 << pm.SHIFT) - 1)
            pairs = pairs.join(known.toDF("_l", "_fl"), F.shiftright("code", pm.SHIFT) == F.col("_l")).join(known.toDF("_r", "_fr"), half == F.col("_r"))
            measure = measure / (F.col("_fl").cast("double") * F.col("_fr").cast("double"))
        top = pairs.withColumn("measure", measure).select("code", "made", "first", "offset", "measure")
        top = top.orderBy(F.desc("measure"), "first", "offset").limit(PAIRS_HELD + 1).toArrow()
        floor = top.column("measure")[PAIRS_HELD].as_py() if len(top) > PAIRS_HELD else 0.0
        totals = pm.PairTotals(*columns_of(top.slice(0, PAIRS_HELD), "code", "made", "first", "offset"), freq, floor)
        totals.symbols = len(self.symbols.tokens)
        return totals

    def words_with(self, codes: np.ndarray) -> pm.PairIndex | None:
        """Up to ``GUESS_WORDS`` words that hold one of the pairs now.

        Where guesses fail, passes are many: each takes at most an eighth of the words still to be sent.
        """
        sizes = np.array(self.symbols.sizes, np.int64)
        todo = self.merges[self.in_base :]

        def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for index in blocks(data, sizes, todo):
                hit = np.zeros(len(index.freq), bool)
                at = np.flatnonzero(index.next >= 0)
                hit[index.word[at[np.isin(index.codes_at(at), codes)]]] = True
                flat, lengths = index.words()
                symbols = as_lists(pa.array(flat[np.repeat(hit, lengths)].astype(np.int32)), lengths[hit])
                yield pa.RecordBatch.from_arrays([pa.array(index.freq[hit]), pa.array(index.first[hit]), symbols], names=["freq", "first", "symbols"])

        most = min(GUESS_WORDS, max(SENT_AT_LEAST, self.left_to_send // 8))
        found = self.indexed(self.words.mapInArrow(run, WORD_SCHEMA).limit(most))
        self.left_to_send = max(0, self.left_to_send - (len(found.freq) if found is not None else 0))
        return found

    def guesses(self, most: int) -> tuple[list[Merge], list[np.ndarray], Symbols]:
        """The next merges as the sampled words suggest them; only speed depends on it, never the result.

        The pairs start with their exact totals, and what a merge changes is scaled up from the sample.
        With each merge come pairs that may tie with it and whose first place should be looked up.
        """
        symbols, guesses, near = self.symbols.copy(), [], []
        totals = self.totals.copy()
        totals.count = totals.count.astype(np.float64)
        if totals.freq is not None:
            totals.freq = totals.freq.astype(np.float64)
        if self.by_score and most:
            best = np.argsort(-totals.measures())[: 4 * most]
            self.sample = self.words_with(totals.code[best])
        sample = self.sample.copy() if self.sample is not None else None
        while len(guesses) < most:
            code, ties = totals.best()
            if code is None and len(ties):
                at = totals.rows_of(ties)
                code = int(ties[np.lexsort((totals.offset[at], totals.first[at]))[0]])
            if code is None:
                break
            merge = symbols.merged(code)
            guesses.append(merge)
            near.append(totals.unsure(NEAR_TOP, within=0.02))
            weight = float(totals.count[totals.row[code]])
            changes = sample.merge(*merge) if sample is not None else None
            if changes is None:
                totals.apply(merge, weight, [np.array([code]), np.zeros(1), np.array([weight]), np.array([pm.NEVER]), np.zeros(1, np.int64)])
                continue
            _, codes, made, lost, first, offset = pm.summed(np.zeros(len(changes.code), np.int64), changes)
            scale = weight / max(1, lost[np.flatnonzero(codes == code)[0]])
            totals.apply(merge, changes.merged * scale, [codes, made * scale, lost * scale, first, offset])
            totals.count[totals.row[code]] = max(0.0, totals.count[totals.row[code]]) if merge[0] == merge[1] else 0.0
        return guesses, near, symbols

    def tried(self, guesses: list[Merge], near: list[np.ndarray], symbols: Symbols) -> list[Merge]:
        """Play the guesses on all words; the merges that are certainly next.

        At most the changes around ``MOST_GUESSES`` merges come back, each of which touches pairs with one
        of its three symbols only.
        """
        wanted = [self.totals.unsure(LOOKED_UP), *near[1:]]

        def work(index: pm.PairIndex) -> pa.RecordBatch:
            steps, changes = [], []
            for n, (guess, codes) in enumerate(zip(guesses, wanted)):
                steps += [2 * n, 2 * n + 1]
                changes += [index.firsts(codes), index.merge(*guess)]
            return change_rows(steps, changes)

        rows = summed(self.tasks(work, symbols)).toArrow().sort_by("step")
        step = rows.column("step").to_numpy()
        values = columns_of(rows, "code", "made", "lost", "first", "offset")
        accepted: list[Merge] = []
        for n, guess in enumerate(guesses):
            low, middle, high = np.searchsorted(step, [2 * n, 2 * n + 1, 2 * n + 2])
            self.totals.found(values[0][low:middle], values[3][low:middle], values[4][low:middle])
            code, _ = self.totals.best()
            if code is None or code != pm.code_of(*guess[:2]):
                break
            accepted.append(self.symbols.merged(code))
            change = [v[middle:high] for v in values]
            mark = change[0] == MERGED
            self.totals.apply(guess, int(change[1][mark].sum()), [v[~mark] for v in change])
        return accepted

    def rebase(self) -> None:
        """Write the word table anew once many merges would have to be replayed."""
        todo = self.merges[self.in_base :]
        if len(todo) < REBASE_AFTER:
            return
        sizes = np.array(self.symbols.sizes, np.int64)

        def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for index in blocks(data, sizes, todo):
                flat, lengths = index.words()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index.freq), pa.array(index.first), as_lists(pa.array(flat.astype(np.int32)), lengths)],
                    names=["freq", "first", "symbols"],
                )

        old = self.words
        self.words = cut_lineage(old.mapInArrow(run, WORD_SCHEMA)).persist()
        old.unpersist()
        self.in_base = len(self.merges)

    def run(self, n_merges: int) -> None:
        size, ceiling = FEWEST_GUESSES, MOST_GUESSES
        while len(self.merges) < n_merges:
            guesses, near, symbols = self.guesses(min(size, n_merges - len(self.merges)))
            if not guesses:
                if not self.totals.left_out():
                    break
                self.totals = self.counted()  # a pair that was left out may be the best now
                if not self.guesses(1)[0]:
                    break
                continue
            accepted = self.tried(guesses, near, symbols)
            if not self.by_score and self.sample is not None:
                for merge in accepted:
                    self.sample.merge(*merge)
            self.merges += accepted
            if not accepted and self.totals.best()[0] is None and self.totals.left_out():
                self.totals = self.counted()
            size = min(max(FEWEST_GUESSES, 2 * len(accepted)), MOST_GUESSES)
            if self.by_score:
                # More guesses need more words than are sent; without all of them nearly every guess is wrong.
                if len(accepted) < len(guesses):
                    ceiling = max(1, FEWEST_GUESSES // 8, len(guesses) // 2)
                    size = ceiling
                size = min(size, ceiling)
            self.rebase()
        self.words.unpersist()


def merges_table(trainer: MergeTrainer, spark: SparkSession) -> DataFrame:
    tokens = trainer.symbols.tokens
    return spark.createDataFrame(
        [
            (rank, tokens[left], tokens[right], tokens[new])
            for rank, (left, right, new) in enumerate(trainer.merges)
        ],
        "rank int, left string, right string, merged string",
    )


def first_merges(
    counts: DataFrame,
    split: Callable[[Column], Column],
    n_merges: int,
    special: dict[str, int],
    prefix: str = "",
    by_score: bool = False,
) -> DataFrame:
    """``(rank, left, right, merged)``: the first ``n_merges`` merges of a training."""
    trainer = MergeTrainer(counts, split, special, prefix, by_score)
    trainer.run(n_merges)
    return merges_table(trainer, counts.sparkSession)


def learn_merges(
    counts: DataFrame,
    split: Callable[[Column], Column],
    vocab_size: int,
    special: dict[str, int],
    prefix: str = "",
    by_score: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(vocab, merges)`` learned from word counts ``(word, freq, first)``."""
    trainer = MergeTrainer(counts, split, special, prefix, by_score)
    trainer.run(vocab_size - len(trainer.symbols.tokens))
    spark = counts.sparkSession
    tokens = trainer.symbols.tokens
    vocab = spark.createDataFrame(
        [(t, i, t in special) for i, t in enumerate(tokens)],
        "token string, id int, is_special boolean",
    )
    return vocab, merges_table(trainer, spark)
