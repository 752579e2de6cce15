"""Frequencies of words, symbols, neighbouring symbols and substrings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from corpuskit.functions import arrays, text as tx
from corpuskit.operators.lookup import lookup_join
from corpuskit.operators.numbering import dense_ids
from corpuskit.session import cut_lineage, fetch, spread

# A corpus position packed into one DECIMAL(38, 0): the document id, any BIGINT,
# times 2^32, plus the chunk's place.  One number keeps min() inside the hash
# aggregate; min(struct) would sort every row first.
PLACE_BITS = 32
AT_BITS = 31  # the same for a place inside a word, added below


def number(value: int) -> Column:
    return F.lit(value).cast("decimal(12,0)")


def packed(high: Column, low: Column, bits: int) -> Column:
    """``high * 2^bits + low``, ordered like the pair.  ``high`` has 29 digits, enough for a packed place."""
    return (high.cast("decimal(29,0)") * number(2**bits) + low).cast("decimal(38,0)")


def low_part(value: Column, bits: int) -> Column:
    return F.pmod(value, number(2**bits)).cast("bigint")


def high_part(value: Column, bits: int, type_: str = "bigint") -> Column:
    return ((value - F.pmod(value, number(2**bits))) / number(2**bits)).cast(type_)


def corpus_order(doc_id: Column, pos: Column) -> Column:
    return packed(doc_id.cast("bigint"), pos, PLACE_BITS)


def first_doc(first: Column) -> Column:
    return high_part(first, PLACE_BITS)


def first_pos(first: Column) -> Column:
    return low_part(first, PLACE_BITS)


def ranked(word_types: DataFrame) -> DataFrame:
    """``(word, freq, first)`` with ``first`` as a dense BIGINT rank: the same order, one machine word."""
    rows = word_types.select("word", "freq", "first")
    if not isinstance(rows.schema["first"].dataType, DecimalType):
        return cut_lineage(rows)
    numbered = dense_ids(rows, "first", id_type="bigint")
    return numbered.select("word", "freq", F.col("id").alias("first"))


def token_rows(docs: DataFrame, tokens: Column, doc_id: str = "doc_id") -> DataFrame:
    """One row per token: ``(doc_id, pos, token)``."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(tokens).alias("pos", "token"))


def count_tokens(docs: DataFrame, tokens: Column, doc_id: str = "doc_id") -> DataFrame:
    """``(word, freq, first)``.  A single shuffle, after map-side counting, so hot words are cheap."""
    rows = token_rows(docs, tokens, doc_id)
    return rows.groupBy(F.col("token").alias("word")).agg(
        F.count(F.lit(1)).alias("freq"),
        F.min(corpus_order(F.col("doc_id"), F.col("pos"))).alias("first"),
    )


TEXT_CHARS = 8_000_000  # characters of neighbouring texts whose tokens a task counts at a time


def count_split(docs: DataFrame, split: Callable[[str], list[str]], text: str, doc_id: str) -> DataFrame:
    """The same for a plain function that cuts a text: blocks of texts are counted before the shuffle."""

    def block(rows: list[tuple[int | None, int, list[str]]]) -> pa.RecordBatch:
        """Counts and first places over (document, place of the first token, tokens)."""
        lengths = np.array([len(tokens) for _, _, tokens in rows], np.int64)
        coded = pa.array([t for _, _, tokens in rows for t in tokens], pa.string()).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        known = np.array(sorted({doc for doc, _, _ in rows if doc is not None}), np.int64)
        # Documents without an id come last: they count, but are no place.
        rank = np.array([len(known) if d is None else np.searchsorted(known, d) for d, _, _ in rows], np.int64)
        begin = np.array([at for _, at, _ in rows], np.int64) - (np.cumsum(lengths) - lengths)
        place = np.repeat(rank << PLACE_BITS, lengths) + np.repeat(begin, lengths) + np.arange(len(code))
        first = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(first, code, place)
        doc = pa.array([*known.tolist(), None], pa.int64()).take(pa.array(first >> PLACE_BITS))
        freq = np.bincount(code, minlength=len(first)).astype(np.int64)
        columns = [coded.dictionary, pa.array(freq), doc, pa.array(first & (2**PLACE_BITS - 1))]
        return pa.RecordBatch.from_arrays(columns, names=["word", "freq", "doc", "pos"])

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        for batch in data:
            for doc, written in zip(batch.column("doc"), batch.column("text")):
                at = 0
                for piece in tx.pieces(written.as_py() or "", TEXT_CHARS):
                    tokens = split(piece)
                    held.append((doc.as_py(), at, tokens))
                    at += len(tokens)
                    chars += len(piece)
                    if chars >= TEXT_CHARS:
                        yield block(held)
                        held, chars = [], 0
        if held:
            yield block(held)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(run, "word string, freq bigint, doc bigint, pos bigint")
    return counted.groupBy("word").agg(
        F.sum("freq").alias("freq"), F.min(corpus_order(F.col("doc"), F.col("pos"))).alias("first")
    )


def chunk_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Frequencies of words and of white space runs."""
    return count_split(docs, tx.split_chunks, text, doc_id)


def stripped_word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Word frequencies without white space."""
    return count_split(docs, tx.split_words, text, doc_id)


def marked_word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Word frequencies, each word led by the space mark."""
    counts = stripped_word_counts(docs, text, doc_id)
    return counts.withColumn("word", F.concat(F.lit(tx.SPACE_MARK), "word"))


def letter_word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Frequencies of lowercased words made of letters only.

    Words are counted as written; the letter test and the lowercasing then run
    once per word type instead of once per occurrence.
    """
    written = stripped_word_counts(docs, text, doc_id)
    letters = written.where(F.rlike("word", F.lit(tx.LETTERS_PATTERN)))
    return letters.groupBy(F.lower("word").alias("word")).agg(
        F.sum("freq").alias("freq"), F.min("first").alias("first")
    )


def split_characters(counts: DataFrame) -> DataFrame:
    """Add ``tokens``: the characters of each word.  Runs on word types, not on occurrences."""
    return counts.withColumn("tokens", tx.characters(F.col("word")))


def split_wordpieces(counts: DataFrame) -> DataFrame:
    """Add ``tokens``: first character bare, the rest prefixed."""
    return counts.withColumn("tokens", tx.wordpiece_characters(F.col("word")))


def distinct_symbols(word_types: DataFrame) -> DataFrame:
    return word_types.select(F.explode("tokens").alias("token")).distinct()


def symbol_counts(word_types: DataFrame) -> DataFrame:
    """Symbol frequencies weighted by word frequency."""
    rows = word_types.select("freq", F.explode("tokens").alias("token"))
    return rows.groupBy("token").agg(F.sum("freq").alias("freq"))


def pair_counts(word_types: DataFrame, with_first: bool = True) -> DataFrame:
    """``(left, right, freq[, first, at])``: neighbouring symbols weighted by word frequency.

    ``first`` and ``at`` say where the pair is met first (word, index in the
    word).  They only serve to order ties and can be switched off to keep the
    aggregation in hash form.
    """
    keep = ["freq", "first"] if with_first else ["freq"]
    rows = word_types.select(
        *keep, F.posexplode(arrays.adjacent_pairs(F.col("tokens"))).alias("at", "pair")
    )
    grouped = rows.groupBy(F.col("pair.left").alias("left"), F.col("pair.right").alias("right"))
    if not with_first:
        return grouped.agg(F.sum("freq").alias("freq"))
    place_type = word_types.schema["first"].dataType.simpleString()
    met = packed(F.col("first"), F.col("at"), AT_BITS)
    counted = grouped.agg(F.sum("freq").alias("freq"), F.min(met).alias("met"))
    return counted.select(
        "left", "right", "freq",
        high_part(F.col("met"), AT_BITS, place_type).alias("first"),
        low_part(F.col("met"), AT_BITS).cast("int").alias("at"),
    )


def pair_scores(word_types: DataFrame, with_first: bool = True) -> DataFrame:
    """Pair counts plus ``score = f(ab) / (f(a) f(b))``.

    The symbol table is joined without a hint: it is tiny next to the pairs and
    AQE turns the join into a broadcast once it has seen the real size.
    """
    symbols = symbol_counts(word_types)
    left = symbols.select(F.col("token").alias("left"), F.col("freq").alias("left_freq"))
    right = symbols.select(F.col("token").alias("right"), F.col("freq").alias("right_freq"))
    score = F.col("freq").cast("double") / (
        F.col("left_freq").cast("double") * F.col("right_freq").cast("double")
    )
    return pair_counts(word_types, with_first).join(left, "left").join(right, "right").withColumn(
        "score", score
    )


def best_pairs(pairs: DataFrame, measure: str = "freq", n: int = 1) -> DataFrame:
    """Top pairs by ``measure``; the pair met first in the corpus wins a tie."""
    return pairs.orderBy(F.desc(measure), "first", "at").limit(n)


def merge_pair(word_types: DataFrame, left: str, right: str, prefix: str = "") -> DataFrame:
    """Apply one merge to every word type."""
    return word_types.withColumn(
        "tokens", arrays.merge_pair(F.col("tokens"), left, right, prefix)
    )


def substring_total(word_types: DataFrame, max_len: int = tx.MAX_SUBWORD) -> DataFrame:
    """One row: the number of substring occurrences, by arithmetic instead of by counting."""
    n = F.length("word").cast("bigint")
    long_starts = F.greatest(n - max_len, F.lit(0).cast("bigint"))
    short = n - long_starts
    per_word = long_starts * max_len + F.floor(short * (short + 1) / 2).cast("bigint")
    return word_types.agg(F.sum(per_word * F.col("freq")).alias("total"))


SUFFIX_STEPS = (5, 8, 16)  # characters of a suffix that are looked at in each step
BLOCK_ROWS = 400_000  # sorted suffixes whose common beginnings are counted at a time
BLOCK_CHARS = 4_000_000  # characters whose suffixes a task cuts at a time
MOST_BEGINNINGS = 200_000  # beginnings that travel to the tasks
POINT_BITS = 21  # of a code point


def beginning_codes(tokens: list[str]) -> list[np.ndarray]:
    """Per length the sorted codes (place of the beginning without its last character, that character) of all beginnings."""
    levels, place = [], {"": 0}
    for size in range(1, max(map(len, tokens), default=0) + 1):
        parts = {t[:size] for t in tokens if len(t) >= size}
        codes = {part: place[part[:-1]] << POINT_BITS | ord(part[-1]) for part in parts}
        levels.append(np.array(sorted(codes.values()), np.int64))
        place = dict(zip(codes, np.searchsorted(levels[-1], list(codes.values())).tolist()))
    return levels


def begins_with(points: np.ndarray, room: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Whether one of the beginnings, all ``len(levels)`` long, stands at each place."""
    at = np.flatnonzero(room >= len(levels))
    state = np.zeros(len(at), np.int64)
    for n, codes in enumerate(levels):
        code = state << POINT_BITS | points[at + n]
        state = np.searchsorted(codes, code)
        hit = codes[np.minimum(state, len(codes) - 1)] == code
        at, state = at[hit], state[hit]
    found = np.zeros(len(room), bool)
    found[at] = True
    return found


def same_substrings(points: np.ndarray, at: np.ndarray, length: np.ndarray, size: int) -> np.ndarray:
    """One number per substring (place and length, at most ``size``), equal for equal substrings."""
    seen = np.zeros(1 << POINT_BITS, bool)
    seen[points] = True
    code = np.append(np.cumsum(seen)[points], np.zeros(size, np.int64))
    bits = int(seen.sum()).bit_length()
    ids, done, n_ids = np.zeros(len(at), np.int64), 0, 1
    while done < size:
        if done:
            found, ids = np.unique(ids, return_inverse=True)
            n_ids = len(found)
        more = min(size - done, (63 - (n_ids - 1).bit_length()) // bits)
        for n in range(done, done + more):
            ids = ids << bits | np.where(n < length, code[at + n], 0)
        done += more
    return ids


def block_suffixes(words: pa.Table, size: int, levels: list[np.ndarray] | None) -> Iterator[pa.RecordBatch]:
    """The distinct suffixes of a block of words, cut at ``size`` characters.

    With ``levels``, the codes of all beginnings that can reach the top, a suffix also ends before the first
    beginning that is not among them: no frequent substring holds it.
    """
    texts = words.column("word")
    text = "".join(texts.to_pylist())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    lengths = pc.utf8_length(texts).to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    room = np.cumsum(lengths)[row] - np.arange(len(points))
    freq, first = words.column("freq").to_numpy(), words.column("first").to_numpy()
    for begin in range(0, len(points), BLOCK_CHARS):
        part = slice(begin, begin + BLOCK_CHARS + size)  # what follows the last suffixes of the part
        here = points[part]
        left = np.minimum(room[part], np.arange(len(here), 0, -1))
        n = min(BLOCK_CHARS, len(here))
        length = np.minimum(left, size)
        at = np.arange(n)
        if levels is not None:
            known = begins_with(here, left, levels)
            dead = np.where(known, len(here), np.arange(len(here)))
            run = np.minimum.accumulate(dead[::-1])[::-1] - np.arange(len(here))
            length = np.minimum(length, len(levels) + run - 1)
            at = np.flatnonzero((run[:n] > 0) & (length[:n] > len(levels)))
        if not len(at):
            continue
        length = length[at]
        ids = same_substrings(here, at, length, size)
        order = np.argsort(ids, kind="stable")
        start = np.flatnonzero(np.concatenate(([True], np.diff(ids[order]) != 0)))
        mine = row[part][at[order]]
        lead = order[start]
        places = zip((begin + at[lead]).tolist(), length[lead].tolist())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([text[p : p + k] for p, k in places], pa.string()),
                pa.array(np.add.reduceat(freq[mine], start)), pa.array(np.minimum.reduceat(first[mine], start)),
            ],
            names=["suffix", "freq", "first"],
        )


def suffixes(word_types: DataFrame, size: int, beginnings: list[str] | None = None) -> DataFrame:
    """``(suffix, freq, first)``: the first ``size`` characters of every suffix, each kept once.

    Given the ``beginnings`` (all equally long) that can reach the top, only suffixes that go on behind one of
    them are kept, up to the first place where none stands.
    """
    levels = None if beginnings is None else beginning_codes(beginnings)

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        for batch in data:
            ends = np.cumsum(pc.utf8_length(batch.column("word")).to_numpy().astype(np.int64))
            start = 0
            while start < batch.num_rows:
                before = int(ends[start - 1]) if start else 0
                stop = 1 + int(np.searchsorted(ends, before + BLOCK_CHARS - chars))
                held.append(batch.slice(start, stop - start))
                chars += int(ends[min(stop, len(ends)) - 1]) - before
                start = stop
                if chars >= BLOCK_CHARS:
                    yield from block_suffixes(pa.Table.from_batches(held).combine_chunks(), size, levels)
                    held, chars = [], 0
        if held:
            yield from block_suffixes(pa.Table.from_batches(held).combine_chunks(), size, levels)

    words = word_types.where(F.length("word") > 0).select("word", "freq", "first")
    rows = words.mapInArrow(run, "suffix string, freq bigint, first bigint")
    return rows.groupBy("suffix").agg(F.sum("freq").alias("freq"), F.min("first").alias("first"))


def code_points(texts: pa.Array, size: int) -> np.ndarray:
    """One row of ``size`` code points a text, 0 behind its end."""
    lengths = pc.utf8_length(texts).to_numpy().astype(np.int64)
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    table = np.zeros((len(texts), size), np.uint32)
    row = np.repeat(np.arange(len(texts)), lengths)
    table[row, np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = points + 1
    return table


def common_beginnings(table: pa.Table, low: int, high: int, most: int) -> Iterator[pa.RecordBatch]:
    """Counts of the beginnings of ``low`` to ``high`` characters of sorted suffixes, by the runs that share them.

    A run inside the block is complete, so only the ``most`` most frequent ones (and their ties) go on;
    runs at an end of the block may go on in the next one and are passed on as they are.
    """
    texts = table.column("suffix").combine_chunks()
    freq, first = table.column("freq").to_numpy(), table.column("first").to_numpy()
    points = code_points(texts, high)
    same = np.cumprod(points[1:] == points[:-1], axis=1, dtype=bool)  # do neighbours share so many characters?
    found = []
    for size in range(low, high + 1):
        held = points[:, size - 1] != 0
        opens = np.concatenate(([True], ~same[:, size - 1])) if len(points) else np.zeros(0, bool)
        start = np.flatnonzero(opens)
        real = held[start]
        count, met = np.add.reduceat(freq, start), np.minimum.reduceat(first, start)
        border = np.zeros(len(start), bool)
        border[[0, -1]] = True
        found.append((np.full(int(real.sum()), size), start[real], count[real], met[real], border[real]))
    size, start, count, met, border = (np.concatenate(x) for x in zip(*found))
    if len(count) > most:
        floor = np.partition(count, len(count) - most)[len(count) - most]
        chosen = border | (count >= floor)
        size, start, count, met = size[chosen], start[chosen], count[chosen], met[chosen]
    for n in np.unique(size):
        at = size == n
        tokens = pc.utf8_slice_codeunits(texts.take(pa.array(start[at])), 0, int(n))
        yield pa.RecordBatch.from_arrays([tokens, pa.array(count[at]), pa.array(met[at])], names=["token", "freq", "first"])


def counted_beginnings(found: DataFrame, low: int, high: int, most: int) -> DataFrame:
    """The most frequent beginnings of the distinct suffixes ``found``, from their sorted order."""
    ordered = found.repartitionByRange("suffix").sortWithinPartitions("suffix")

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in data:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield from common_beginnings(pa.Table.from_batches(held), low, high, most)
                held, rows = [], 0
        if rows:
            yield from common_beginnings(pa.Table.from_batches(held), low, high, most)

    partial = ordered.mapInArrow(run, "token string, freq bigint, first bigint")
    return partial.groupBy("token").agg(F.sum("freq").alias("freq"), F.min("first").alias("first"))


def frequent_substrings(word_types: DataFrame, size: int, max_len: int = tx.MAX_SUBWORD) -> DataFrame:
    """``(token, freq, first)``: at least the ``size`` most frequent substrings, ties included.

    A substring begins some suffix, so sorted suffixes hold its occurrences side by side: counts are sums
    over runs of suffixes with a common beginning.  A substring is never more frequent than a part of it,
    so longer ones are only looked for where all parts of the length before can reach the top.
    """
    found: DataFrame | None = None
    floor, done = 1, 0
    for reach in SUFFIX_STEPS:
        high = min(reach, max_len)
        if high <= done:
            break
        rows = word_types
        if done:
            rows = rows.where(F.length("word") > done)
        if done:
            alive = found.where((F.length("token") == done) & (F.col("freq") >= floor)).select("token")
            held = fetch(alive, MOST_BEGINNINGS)
            if held is not None and not len(held):
                break
            rows = suffixes(rows, high, held.column("token").to_pylist() if held is not None else None)
            if held is None:
                rows = rows.where(F.length("suffix") > done).withColumn("_begin", F.substring("suffix", 1, done))
                rows = lookup_join(rows, alive.withColumnRenamed("token", "_begin"), "_begin", "left_semi").drop("_begin")
        else:
            rows = suffixes(rows, high)
        step = cut_lineage(counted_beginnings(rows, done + 1, high, size).where(F.col("freq") >= floor))
        found = step if found is None else found.unionByName(step)
        top = found.orderBy(F.desc("freq")).limit(size)
        n, last = top.agg(F.count(F.lit(1)), F.min("freq")).first()
        floor = last if n == size else 1
        done = high
    return found.where(F.col("freq") >= floor)


def seed_subwords(word_types: DataFrame, size: int, max_len: int = tx.MAX_SUBWORD) -> DataFrame:
    """The ``size`` most frequent substrings: ``(token, freq, logp, seed_rank)``.

    Ties go to the substring met first (word, then start, then length).  Only
    the candidates for the top are joined back to their first word for that.
    """
    word_types = spread(ranked(word_types))
    near_top = frequent_substrings(word_types, size, max_len)
    total = substring_total(word_types, max_len).scalar()
    placed = near_top.join(word_types.select("word", "first"), "first").select(
        "token", "freq", "first", F.instr("word", F.col("token")).alias("at"),
        F.length("token").alias("size"),
    )
    top = placed.orderBy(F.desc("freq"), "first", "at", "size").limit(size)
    order = F.row_number().over(_order("freq", "first", "at", "size"))
    return top.select(
        "token", "freq", F.log(F.col("freq") / total).alias("logp"), order.alias("seed_rank")
    )


def _order(first: str, *rest: str):
    # At most ``size`` rows reach this window, so one partition is enough.
    return Window.orderBy(F.desc(first), *rest)


def token_stats(docs: DataFrame, tokens: Column, text: str = "text", by: str | None = None) -> DataFrame:
    """Text length, token count, characters per token, distinct tokens, mean token length."""
    keys = [by] if by else []
    lengths = docs.groupBy(*keys).agg(F.sum(F.length(text)).alias("n_chars"))
    rows = docs.select(*keys, F.explode(tokens).alias("token"))
    # Count per distinct token first: the second aggregation then sees each token once.
    per_token = rows.groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("n"))
    stats = per_token.groupBy(*keys).agg(
        F.sum("n").alias("n_tokens"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.length("token") * F.col("n")).alias("token_chars"),
    )
    if keys:
        joined = lengths.join(stats, keys, "left")
    else:  # two single rows
        joined = lengths.withColumns({c: stats.select(c).scalar() for c in stats.columns})
    n = F.coalesce("n_tokens", F.lit(0))
    return joined.select(
        *keys,
        "n_chars",
        n.alias("n_tokens"),
        F.try_divide("n_chars", n).alias("chars_per_token"),
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        F.try_divide("token_chars", n).alias("mean_token_length"),
    )


def row_token_stats(
    docs: DataFrame, tokens: Column, text: str = "text", doc_id: str = "doc_id", vocab_size: int | None = None
) -> DataFrame:
    """The same figures per row, worked out inside the row: no shuffle.

    ``vocab_size`` adds the size of the vocabulary that made the tokens.
    """
    rows = docs.select(F.col(doc_id).alias(doc_id), F.length(text).alias("n_chars"), tokens.alias("t"))
    n, chars = F.size("t"), F.aggregate("t", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x))
    size = [] if vocab_size is None else [F.lit(vocab_size).alias("vocab_size")]
    return rows.select(
        doc_id,
        F.col("n_chars").cast("bigint").alias("n_chars"),
        n.cast("bigint").alias("n_tokens"),
        F.try_divide("n_chars", n).alias("chars_per_token"),
        F.size(F.array_distinct("t")).cast("bigint").alias("n_distinct"),
        F.try_divide(chars, n).alias("mean_token_length"),
        *size,
    )
