"""Subword tokenizers as models: small tables plus column functions that apply them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.config import SPECIAL_TOKENS, WORDPIECE_SPECIAL_TOKENS
from corpuskit.functions import arrays, subwords, text as tx
from corpuskit.operators import counts as ct
from corpuskit.operators import encode as en
from corpuskit.operators import unigram as ug
from corpuskit.operators.merge_training import learn_merges
from corpuskit.session import BROADCAST_ROWS, cut_lineage, fetch

KINDS = ("bpe", "wordpiece", "unigram", "sentencepiece-bpe", "sentencepiece-unigram")


@dataclass
class Tokenizer:
    """A trained tokenizer.

    ``vocab (token, id, is_special)``, ``merges (rank, left, right, merged)`` and
    ``unigram (token, logp)`` are bounded by the vocabulary size, so they may
    travel to every task.  Applying a tokenizer is a row operation without a
    shuffle and works on streams too.
    """

    kind: str
    vocab_size: int
    vocab: DataFrame
    merges: DataFrame | None = None
    unigram: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown tokenizer kind {self.kind!r}, expected one of {KINDS}")

    @property
    def special(self) -> dict[str, int]:
        return WORDPIECE_SPECIAL_TOKENS if self.kind == "wordpiece" else SPECIAL_TOKENS

    @property
    def marker_ids(self) -> tuple[int, int]:
        names = ("[CLS]", "[SEP]") if self.kind == "wordpiece" else ("<BOS>", "<EOS>")
        return self.special[names[0]], self.special[names[1]]

    def words(self, text: Column) -> Column:
        """The words a text is cut into before segmentation."""
        if self.kind == "bpe":
            return tx.chunks(text)
        if self.kind.startswith("sentencepiece"):
            return F.transform(tx.words(text), lambda w: F.concat(F.lit(tx.SPACE_MARK), w))
        return tx.words(text)

    def _model(self):
        def checked(table: DataFrame, *columns: str) -> list[list]:
            held = fetch(table.select(*columns))
            if held is None:
                raise ValueError(f"a tokenizer table may hold at most {BROADCAST_ROWS} rows")
            return [held.column(c).to_pylist() for c in columns]

        if self.kind.endswith("bpe"):
            left, right, rank = checked(self.merges, "left", "right", "rank")
            return dict(zip(zip(left, right), rank))
        if self.kind == "wordpiece":
            return frozenset(*checked(self.vocab, "token"))
        return dict(zip(*checked(self.unigram, "token", "logp")))

    def segmenter(self):
        """A column function ``array<string> -> array<string>``: words to subwords."""
        cut = self._cutting()
        return self._column(lambda: cut(subwords.segment_lists), "array<string>")

    def _cutting(self):
        """Calls ``subwords.segment_lists`` or ``segment_texts`` inside a task, with one segmenter (and word cache)."""
        make = (
            subwords.bpe_segmenter
            if self.kind.endswith("bpe")
            else subwords.wordpiece_segmenter
            if self.kind == "wordpiece"
            else subwords.unigram_segmenter
        )
        shared = self.vocab.sparkSession.sparkContext.broadcast(self._model())

        def cut(function, *split):
            segment = subwords.cached(make(shared.value))
            return lambda words, *known: function(words, *split, segment, *known)

        return cut

    def _column(self, work, kind: str):
        """``work`` is called once per task, not per batch."""

        @F.arrow_udf(kind)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            function = work()
            for words in batches:
                yield function(words)

        return run

    def split(self):
        """The same cut as ``words``, on a plain text."""
        if self.kind == "bpe":
            return tx.split_chunks
        return tx.split_marked if self.kind.startswith("sentencepiece") else tx.split_words

    def tokens(self, text: Column) -> Column:
        """Texts to subwords; the texts are cut where they are segmented, so that their words never travel."""
        cut, split = self._cutting(), self.split()
        return self._column(lambda: cut(subwords.segment_texts, split), "array<string>")(text)

    def _ids(self):
        """Texts to ids inside a task, so that their tokens never travel; None with a vocabulary that does not either."""
        held = fetch(self.vocab.select("token", "id"))
        if held is None:
            return None
        cut, split, unknown = self._cutting(), self.split(), SPECIAL_TOKENS["<UNK>"]
        index = subwords.TextIndex(en.one_array(held.column("token")), held.column("id").to_numpy())
        shared = self.vocab.sparkSession.sparkContext.broadcast(index)

        def work():
            segment = cut(subwords.segment_texts, split)
            return lambda texts: segment(texts, shared.value, unknown)

        return work

    def encode(
        self,
        docs: DataFrame,
        text: str = "text",
        doc_id: str = "doc_id",
        max_length: int | None = None,
        padding: bool = False,
        add_special: bool = False,
    ) -> DataFrame:
        """``(doc_id, input_ids)``."""
        work = self._ids()
        if work is None:
            encoded = en.encode_tokens(docs, self.tokens(F.col(text)), self.vocab, doc_id=doc_id)
        else:
            encoded = en.in_slices(docs, doc_id, text, "input_ids", "array<int>", subwords.text_sizes, work)
            encoded = encoded.withColumnRenamed(doc_id, "doc_id")
        first, last = self.marker_ids if add_special else (None, None)
        ids = arrays.finish_ids(F.col("input_ids"), max_length, padding, first, last)
        return encoded.withColumn("input_ids", ids)

    def ids(self, text: Column, add_special: bool = False, max_length: int | None = None) -> Column:
        """The same as a column, for streams."""
        first, last = self.marker_ids if add_special else (None, None)
        work = self._ids()
        if work is None:
            raise ValueError(f"a tokenizer table may hold at most {BROADCAST_ROWS} rows")
        # Spark would copy a deterministic lookup into every condition on its result.
        found = self._column(work, "array<int>").asNondeterministic()(text)
        return arrays.finish_ids(found, max_length, False, first, last)

    def encode_batches(
        self,
        docs: DataFrame,
        batch: str = "batch_id",
        text: str = "text",
        doc_id: str = "doc_id",
        max_length: int | None = None,
        add_special: bool = False,
    ) -> DataFrame:
        """``(batch, doc_id, input_ids, attention_mask)``, padded per batch.

        The ids are written once: both the longest row of a batch and the
        padding read them, and segmenting twice would cost more.
        """
        encoded = docs.select(
            F.col(batch), F.col(doc_id).alias("doc_id"),
            self.ids(F.col(text), add_special, max_length).alias("input_ids"),
        )
        return en.pad_batches(cut_lineage(encoded), batch, max_length)

    @property
    def style(self) -> str:
        if self.kind == "wordpiece":
            return "wordpiece"
        return "marked" if self.kind.startswith("sentencepiece") else "plain"

    def decode(self, encoded: DataFrame, ids: str = "input_ids", doc_id: str = "doc_id", skip_special: bool = True) -> DataFrame:
        """``(doc_id, text)``."""
        skip = tuple(self.special) if skip_special else ()
        return en.decode(encoded, self.vocab, self.style, ids=ids, doc_id=doc_id, skip=skip)


def train_bpe(docs: DataFrame, vocab_size: int = 1000, text: str = "text", doc_id: str = "doc_id") -> Tokenizer:
    counts = ct.chunk_counts(docs, text, doc_id)
    vocab, merges = learn_merges(counts, tx.characters, vocab_size, SPECIAL_TOKENS)
    return Tokenizer("bpe", vocab_size, vocab, merges)


def train_wordpiece(docs: DataFrame, vocab_size: int = 1000, text: str = "text", doc_id: str = "doc_id") -> Tokenizer:
    counts = ct.stripped_word_counts(docs, text, doc_id)
    vocab, merges = learn_merges(
        counts, tx.wordpiece_characters, vocab_size, WORDPIECE_SPECIAL_TOKENS,
        tx.WORDPIECE_PREFIX, by_score=True,
    )
    return Tokenizer("wordpiece", vocab_size, vocab, merges)


def train_unigram(docs: DataFrame, vocab_size: int = 1000, text: str = "text", doc_id: str = "doc_id", seed_factor: int = ug.SEED_FACTOR) -> Tokenizer:
    counts = ct.stripped_word_counts(docs, text, doc_id)
    vocab, unigram = ug.train(counts, counts, vocab_size, seed_factor=seed_factor)
    return Tokenizer("unigram", vocab_size, vocab, unigram=unigram)


def train_sentencepiece(
    docs: DataFrame,
    vocab_size: int = 1000,
    mode: str = "bpe",
    text: str = "text",
    doc_id: str = "doc_id",
    cross_word: bool = True,
    seed_factor: int = ug.SEED_FACTOR,
) -> Tokenizer:
    """Marked-space training with either method.

    ``cross_word`` draws unigram seeds from whole lines, so a seed may span
    words; off, from single marked words.
    """
    mode = mode.lower()
    if mode not in ("bpe", "unigram"):
        raise ValueError(f"unknown mode {mode!r}, use 'bpe' or 'unigram'")
    counts = ct.marked_word_counts(docs, text, doc_id)
    if mode == "bpe":
        vocab, merges = learn_merges(counts, tx.characters, vocab_size, SPECIAL_TOKENS)
        return Tokenizer("sentencepiece-bpe", vocab_size, vocab, merges)
    seeds = ug.line_counts(docs, text, doc_id) if cross_word else counts
    vocab, unigram = ug.train(counts, seeds, vocab_size, seed_factor=seed_factor)
    return Tokenizer("sentencepiece-unigram", vocab_size, vocab, unigram=unigram)
