"""Token to id, batching, and back to text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.config import SPECIAL_TOKENS, UNK_TOKEN
from corpuskit.functions import arrays, subwords, text as tx, vectors
from corpuskit.functions.text import WORDPIECE_PREFIX
from corpuskit.operators.counts import token_rows
from corpuskit.operators.lookup import lookup_join
from corpuskit.session import BROADCAST_ROWS, cut_lineage, fetch


SLICE_ITEMS = 1_000_000  # characters or ids of neighbouring rows (or of one longer row) that are worked on together
LOOKUP_ROWS = 6_000_000  # largest vocabulary that travels to the tasks, if :func:`fetch` finds its bytes few enough


def one_array(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def id_lookup(vocab: pa.Table, unk_id: int = 1) -> Callable[[Column], Column]:
    """A column function ``array<string> -> array<int>`` over a vocabulary on the driver.

    The table comes from :func:`corpuskit.session.fetch`, which checks its size.
    """
    spark = SparkSession.active()
    tokens = one_array(vocab.column("token"))
    shared = spark.sparkContext.broadcast(subwords.TextIndex(tokens, vocab.column("id").to_numpy()))

    @F.arrow_udf("array<int>")
    def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for tokens in batches:
            yield subwords.lookup_lists(tokens, shared.value, unk_id)

    # Spark would copy a deterministic lookup into every condition on its result.
    return lookup.asNondeterministic()


BLOCK_ITEMS = 1_000_000  # list entries of neighbouring rows whose distinct values are looked up together


def _blocks(data: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Keys and lists of neighbouring rows, ``BLOCK_ITEMS`` entries (or one longer row) at a time."""
    held, items = [], 0
    for batch in data:
        lengths = subwords.list_lengths(batch.column("items"))
        start = 0
        while start < len(lengths):
            fits = int(np.searchsorted(np.cumsum(lengths[start:]), BLOCK_ITEMS - items, side="right"))
            fits = max(fits, 0 if held else 1)
            if fits:
                held.append(batch.slice(start, fits))
                items += int(lengths[start : start + fits].sum())
                start += fits
            if start < len(lengths):
                yield _block(held, key)
                held, items = [], 0
    if held:
        yield _block(held, key)


def _block(held: list[pa.RecordBatch], key: str) -> tuple[pa.Array, pa.Array]:
    table = pa.Table.from_batches(held)
    return tuple(pa.concat_arrays(table.column(c).chunks) for c in (key, "items"))


def translated_lists(
    rows: DataFrame, items: Column, table: DataFrame, key: str, value: str, unknown: str | int, name: str,
    doc_id: str = "doc_id",
) -> DataFrame:
    """``(doc_id, name)``: every entry of the lists ``items`` replaced by its ``value`` in a large unique-``key`` table.

    Neighbouring rows form blocks that number their distinct entries.  Only those are joined to the table;
    the lists travel as numbers and are read back in the block.  The lists are made and written once.
    """
    source = rows.select(F.col(doc_id).alias(doc_id), items.alias("items"))
    id_type = source.schema[doc_id].dataType.simpleString()
    item_type = source.schema["items"].dataType.elementType.simpleString()
    out_type = table.schema[value].dataType.simpleString()
    arrow_out = pa.string() if out_type == "string" else pa.int32()

    def number(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, (ids, lists) in enumerate(_blocks(data, doc_id)):
            coded = lists.flatten().dictionary_encode(null_encoding="encode")
            at = subwords.as_lists(coded.indices.cast(pa.int32()), subwords.list_lengths(lists))
            block = part << 32 | n
            names = ["block", doc_id, "at", "entries"]
            none = pa.nulls(len(ids), pa.list_(coded.dictionary.type))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block)), ids, at, none], names=names)
            entries = subwords.as_lists(coded.dictionary, np.array([len(coded.dictionary)]))
            more = [pa.array([block]), pa.nulls(1, ids.type), pa.nulls(1, at.type), entries]
            yield pa.RecordBatch.from_arrays(more, names=names)

    schema = f"block bigint, `{doc_id}` {id_type}, at array<int>, entries array<{item_type}>"
    numbered = cut_lineage(source.mapInArrow(number, schema))
    entries = numbered.where(F.col("entries").isNotNull()).select("block", F.posexplode("entries").alias("place", key))
    found = entries.join(table.select(key, value), key).select("block", "place", value)

    def read(lists: pa.Table, found: pa.Table) -> pa.Table:
        at = pa.concat_arrays(lists.column("at").chunks) if lists.num_rows else pa.array([], pa.list_(pa.int32()))
        flat = at.flatten().to_numpy(zero_copy_only=False)
        size = 1 + int(flat.max(initial=-1))
        place = found.column("place").to_numpy()
        row = np.full(size, found.num_rows, np.int64)
        row[place] = np.arange(found.num_rows)
        values = pa.concat_arrays([*found.column(value).cast(arrow_out).chunks, pa.array([unknown], arrow_out)])
        values = values.take(pa.array(row[flat]))
        return pa.table({doc_id: lists.column(doc_id), name: subwords.as_lists(values, subwords.list_lengths(at))})

    lists = numbered.where(F.col("entries").isNull()).select(F.col("block").alias("_block"), doc_id, "at")
    dealt = lists.groupBy("_block").cogroup(found.groupBy("block"))
    return dealt.applyInArrow(read, f"`{doc_id}` {id_type}, {name} array<{out_type}>")


def encode_tokens(
    docs: DataFrame,
    tokens: Column,
    vocab: DataFrame,
    unk_id: int = 1,
    doc_id: str = "doc_id",
    limit: int = LOOKUP_ROWS,
) -> DataFrame:
    """``(doc_id, input_ids)``.

    A vocabulary of at most ``limit`` rows travels to the tasks and documents
    are encoded in place, without a shuffle.  A larger one is joined to the
    distinct tokens of blocks of documents.
    """
    held = fetch(vocab.select("token", "id"), limit)
    if held is not None:
        ids = id_lookup(held, unk_id)(tokens)
        return docs.select(F.col(doc_id).alias("doc_id"), ids.alias("input_ids"))
    encoded = translated_lists(docs, tokens, vocab, "token", "id", unk_id, "input_ids", doc_id)
    return encoded.withColumnRenamed(doc_id, "doc_id")


def in_slices(
    rows: DataFrame, doc_id: str, column: str, name: str, kind: str,
    sizes: Callable[[pa.Array], np.ndarray], work: Callable[[], Callable[[pa.Array], pa.Array]],
) -> DataFrame:
    """``(doc_id, name)``: a function of one column, on neighbouring rows of up to ``SLICE_ITEMS``, and no more of them in memory."""
    id_type = rows.schema[doc_id].dataType.simpleString()

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = work()
        for batch in data:
            for some in subwords.text_slices(sizes(batch.column(1)), SLICE_ITEMS):
                part = batch.slice(some.start, some.stop - some.start)
                yield pa.RecordBatch.from_arrays([part.column(0), function(part.column(1))], names=[doc_id, name])

    fed = rows.select(F.col(doc_id).alias(doc_id), F.col(column).alias("_fed"))
    return fed.mapInArrow(run, f"`{doc_id}` {id_type}, {name} {kind}")


def token_ids(
    rows: DataFrame, vocab: DataFrame, unk_id: int = 1, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Add ``id`` to token rows; tokens outside the vocabulary get ``unk_id``."""
    found = lookup_join(rows, vocab.select("token", "id"), "token", limit=limit)
    return found.withColumn("id", F.coalesce("id", F.lit(unk_id)))


def pad_batches(
    encoded: DataFrame, batch: str = "batch_id", max_length: int | None = None, pad_id: int = 0
) -> DataFrame:
    """Pad every batch to its longest row (at most ``max_length``) and add ``attention_mask``.

    The longest row per batch is a partial aggregate joined back by a lookup that
    splits hot keys, so a large batch is not gathered in one task.  The ids are
    read twice: settle them first where they are dear.
    """
    longest = encoded.groupBy(batch).agg(F.max(F.size("input_ids")).alias("_length"))
    if max_length:
        longest = longest.withColumn("_length", F.least("_length", F.lit(max_length)))
    ids = F.col("input_ids")
    length = F.col("_length")
    return (
        lookup_join(encoded, longest, batch, "inner")
        .withColumn("attention_mask", arrays.mask_from_length(ids, length))
        .withColumn("input_ids", arrays.pad_ids(ids, length, pad_id))
        .drop("_length")
    )


def token_lookup(vocab: pa.Table, unknown: str = UNK_TOKEN) -> Callable[[Column], Column]:
    """A column function ``array<int> -> array<string>``, the other way round."""
    spark = SparkSession.active()
    ordered = vocab.take(pc.array_sort_indices(vocab.column("id")))  # stable: of equal ids the first one counts
    shared = spark.sparkContext.broadcast(tuple(one_array(ordered.column(c)) for c in ("id", "token")))

    @F.arrow_udf("array<string>")
    def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, tokens = shared.value
        known = known.drop_null().to_numpy().astype(np.int64)
        for ids in batches:
            flat = ids.flatten()
            asked = pc.fill_null(flat.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(known, asked)
            hit = np.append(known, 0)[at] == asked
            hit &= (at < len(known)) & flat.is_valid().to_numpy(zero_copy_only=False)
            found = pc.fill_null(tokens.take(pa.array(at, mask=~hit)), unknown)
            yield subwords.as_lists(found, subwords.list_lengths(ids))

    return lookup


def ids_to_tokens(
    encoded: DataFrame,
    vocab: DataFrame,
    ids: str = "input_ids",
    doc_id: str = "doc_id",
    unknown: str = UNK_TOKEN,
    skip: tuple[str, ...] = tuple(SPECIAL_TOKENS),
    limit: int = LOOKUP_ROWS,
) -> DataFrame:
    """``(doc_id, tokens)``; special tokens named in ``skip`` are dropped."""
    held = fetch(vocab.select("id", "token"), limit)
    if held is not None:
        tokens = token_lookup(held, unknown)(F.col(ids))
        out = encoded.select(doc_id, tokens.alias("tokens"))
    else:
        out = translated_lists(encoded, F.col(ids), vocab, "id", "token", unknown, "tokens", doc_id)
    if not skip:
        return out
    return out.withColumn("tokens", F.filter("tokens", lambda t: ~t.isin(list(skip))))


def joined_text(tokens: Column, style: str = "plain") -> Column:
    """Tokens to text: ``plain`` concatenation, ``wordpiece`` gluing or ``marked`` spaces."""
    if style == "wordpiece":
        return arrays.join_wordpieces(tokens)
    text = F.array_join(tokens, "")
    return tx.unmark_spaces(text) if style == "marked" else text


def decode(
    encoded: DataFrame, vocab: DataFrame, style: str = "plain", ids: str = "input_ids", doc_id: str = "doc_id",
    unknown: str = UNK_TOKEN, skip: tuple[str, ...] = tuple(SPECIAL_TOKENS), limit: int = LOOKUP_ROWS,
) -> DataFrame:
    """``(doc_id, text)`` from id arrays.  With a vocabulary that travels, tokens become texts where they are looked up."""
    held = fetch(vocab.select("id", "token"), limit)
    if held is None:
        tokens = ids_to_tokens(encoded, vocab, ids, doc_id, unknown, skip, limit)
        return tokens.withColumn("text", joined_text(F.col("tokens"), style)).drop("tokens")
    ordered = held.take(pc.array_sort_indices(held.column("id")))  # stable: of equal ids the first one counts
    ordered = ordered.filter(pc.is_valid(ordered.column("id")))
    known = one_array(ordered.column("id")).to_numpy().astype(np.int64)
    tokens = [unknown if t is None else t for t in ordered.column("token").to_pylist()] + [unknown]
    kept = ~np.isin(np.array(tokens, object), list(skip)) if skip else np.ones(len(tokens), bool)
    # Behind the pieces stand the same ones as they open a text.
    opening = [t.removeprefix(WORDPIECE_PREFIX) for t in tokens] if style == "wordpiece" else tokens
    pieces = [o if o != t else f" {t}" for t, o in zip(tokens, opening)] if style == "wordpiece" else tokens
    shared = encoded.sparkSession.sparkContext.broadcast((known, kept, pa.array([*pieces, *opening], pa.string())))

    def work() -> Callable[[pa.Array], pa.Array]:
        known, kept, pieces = shared.value

        def texts(lists: pa.Array) -> pa.Array:
            flat = lists.flatten()
            asked = pc.fill_null(flat.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(known, asked)
            hit = (np.append(known, 0)[at] == asked) & (at < len(known)) & flat.is_valid().to_numpy(zero_copy_only=False)
            at[~hit] = len(known)
            row = np.repeat(np.arange(len(lists)), subwords.list_lengths(lists))[kept[at]]
            at = at[kept[at]]
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(row)), bool), row[1:] != row[:-1])))
            at[first] += len(kept)
            found = pieces.take(pa.array(at))
            # The pieces of a row lie side by side, so that its text is all of them.
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(lists)))))
            offsets = np.frombuffer(found.buffers()[1], np.int32, len(found) + 1)[ends]
            return pa.StringArray.from_buffers(len(lists), pa.py_buffer(np.ascontiguousarray(offsets)), found.buffers()[2])

        return texts

    out = in_slices(encoded, doc_id, ids, "text", "string", subwords.list_lengths, work)
    return out.withColumn("text", tx.unmark_spaces(F.col("text"))) if style == "marked" else out


def _running_ends(tokens: pa.Array) -> pa.Array:
    lengths = subwords.list_lengths(tokens)
    sizes = pc.utf8_length(tokens.flatten()).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    row_starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths
    inside = ends[1:] - np.repeat(ends[row_starts], lengths)
    return subwords.as_lists(pa.array(inside.astype(np.int32)), lengths)


def running_ends(tokens: Column) -> Column:
    """Running character count at the end of each token of a row."""
    return F.arrow_udf(_running_ends, "array<int>")(tokens)


def token_spans(
    docs: DataFrame, tokens: Column, doc_id: str = "doc_id", line: int = 60, markers: int = 36
) -> DataFrame:
    """Character span, display line and boundary marker number of each token.

    Offsets are a running sum inside the row; the token rows are never shuffled.
    """
    zipped = F.arrays_zip(tokens.alias("token"), running_ends(tokens).alias("end"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(zipped).alias("pos", "t"))
    end = F.col("t.end")
    start = end - F.length("t.token")
    return rows.select(
        "doc_id",
        "pos",
        F.col("t.token").alias("token"),
        start.alias("start"),
        end.alias("end"),
        F.floor(start / line).cast("int").alias("line"),
        F.pmod("pos", F.lit(markers)).alias("marker"),
    )


def embed_tokens(
    rows: DataFrame, embeddings: DataFrame, pad_id: int = 0, size: int = 0
) -> DataFrame:
    """Add ``vec`` to rows with an ``id``; the pad id gets a zero vector of ``size`` entries."""
    zero = F.array_repeat(F.lit(0.0), size)
    found = lookup_join(rows, embeddings.select("id", "vec"), "id")
    return found.withColumn(
        "vec", F.when(F.col("id") == pad_id, zero).otherwise(vectors.as_double(F.col("vec")))
    )


def mean_vectors(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Mean of ``vec`` per ``key``; one aggregate per dimension, partly summed before the shuffle."""
    means = [F.avg(F.col("vec")[i]).alias(f"_{i}") for i in range(size)]
    return rows.groupBy(key).agg(*means).select(
        key, F.array(*[F.col(f"_{i}") for i in range(size)]).alias("vec")
    )


def compare_tokenizers(docs: DataFrame, tokenizers: dict[str, Column], doc_id: str = "doc_id", preview: int = 40) -> DataFrame:
    """Token count and a shortened token list per document and tokenizer."""
    def listed(tokens: Column) -> Column:
        text = F.concat(
            F.lit("['"), F.array_join(tokens, "', '"), F.lit("']")
        )
        shown = F.when(F.size(tokens) == 0, F.lit("[]")).otherwise(text)
        return F.when(
            F.length(shown) > preview, F.concat(F.left(shown, F.lit(preview - 3)), F.lit("..."))
        ).otherwise(shown)

    per_name = [
        F.struct(
            F.lit(name).alias("tokenizer"),
            F.size(tokens).alias("n_tokens"),
            listed(tokens).alias("preview"),
        )
        for name, tokens in tokenizers.items()
    ]
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.inline(F.array(*per_name))
    )

