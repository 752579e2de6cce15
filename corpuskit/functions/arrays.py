"""Column expressions over token and id arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.text import WORDPIECE_PREFIX


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a lambda would recompute it per element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def adjacent_pairs(tokens: Column) -> Column:
    """Neighbouring tokens as structs ``(left, right)``; overlapping pairs all count."""
    n = F.size(tokens)
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("left"), b.alias("right")),
    )
    return F.when(n > 1, pairs).otherwise(
        F.array().cast("array<struct<left:string,right:string>>")
    )


def joined(left: Column, right: Column, prefix: str = "") -> Column:
    """The symbol two neighbours merge into; one leading ``prefix`` of the right part goes."""
    if not prefix:
        return F.concat(left, right)
    bare = F.when(
        F.startswith(right, F.lit(prefix)), F.substring(right, len(prefix) + 1, 2**30)
    ).otherwise(right)
    return F.concat(left, bare)


def merge_pair(tokens: Column, left: str, right: str, prefix: str = "") -> Column:
    """Merge one pair from left to right without overlap; arrays without it pass unchanged."""
    a, b = F.lit(left), F.lit(right)
    merged = joined(a, b, prefix)
    empty = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("held")
    )

    # ``held`` is a left symbol still waiting for its right neighbour.
    def step(acc: Column, x: Column) -> Column:
        done, held = acc["done"], acc["held"]
        flushed = F.when(held.isNull(), done).otherwise(F.concat(done, F.array(held)))
        return (
            F.when(
                held.isNotNull() & (x == b),
                F.struct(
                    F.concat(done, F.array(merged)).alias("done"),
                    F.lit(None).cast("string").alias("held"),
                ),
            )
            .when(x == a, F.struct(flushed.alias("done"), x.alias("held")))
            .otherwise(
                F.struct(
                    F.concat(flushed, F.array(x)).alias("done"),
                    F.lit(None).cast("string").alias("held"),
                )
            )
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["held"].isNull(), acc["done"]).otherwise(
            F.concat(acc["done"], F.array(acc["held"]))
        )

    present = F.array_contains(tokens, left) & F.array_contains(tokens, right)
    return F.when(present, F.aggregate(tokens, empty, step, finish)).otherwise(tokens)


def truncate_ids(ids: Column, max_length: int | Column) -> Column:
    length = F.lit(max_length) if isinstance(max_length, int) else max_length
    return F.slice(ids, F.lit(1), length)


def pad_ids(
    ids: Column, max_length: int | Column, pad_id: int = 0, truncate: bool = True
) -> Column:
    """Fixed length ids; a longer array stays whole when ``truncate`` is off."""
    length = F.lit(max_length) if isinstance(max_length, int) else max_length
    kept = truncate_ids(ids, length) if truncate else ids
    missing = F.greatest(length - F.size(ids), F.lit(0))
    return F.concat(kept, F.array_repeat(F.lit(pad_id).cast("int"), missing))


def mask_from_ids(ids: Column, pad_id: int = 0) -> Column:
    """0 wherever the id equals the pad id, else 1."""
    return F.transform(ids, lambda x: F.when(x == pad_id, 0).otherwise(1))


def mask_from_length(ids: Column, length: Column) -> Column:
    """Ones for the real ids, zeros for the padding up to ``length``."""
    real = F.least(F.size(ids), length)
    return F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), length - real))


def with_special_ids(ids: Column, first_id: int | None, last_id: int | None) -> Column:
    parts = [ids]
    if first_id is not None:
        parts.insert(0, F.array(F.lit(first_id).cast("int")))
    if last_id is not None:
        parts.append(F.array(F.lit(last_id).cast("int")))
    return F.concat(*parts)


def finish_ids(
    ids: Column,
    max_length: int | None = None,
    padding: bool = False,
    first_id: int | None = None,
    last_id: int | None = None,
    pad_id: int = 0,
) -> Column:
    """Add the marker ids, truncate afterwards (the end marker may be cut), then pad."""
    out = with_special_ids(ids, first_id, last_id)
    if max_length:
        out = truncate_ids(out, max_length)
        if padding:
            out = pad_ids(out, max_length, pad_id)
    return out


def join_wordpieces(tokens: Column, prefix: str = WORDPIECE_PREFIX) -> Column:
    """Glue continuation pieces to the piece before, put a blank before any other piece."""
    skip = len(prefix) + 1
    pieces = F.transform(
        tokens,
        lambda t, i: F.when(F.startswith(t, F.lit(prefix)), F.substring(t, skip, 2**30))
        .when(i == 0, t)
        .otherwise(F.concat(F.lit(" "), t)),
    )
    return F.array_join(pieces, "")
