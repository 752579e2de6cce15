"""Repair of conversation structure: least-cost edits by Hirschberg's divide and conquer.

A repaired conversation has role initials ``(s?(ua)+)?``.  Its four states are: nothing yet, after the
system turn, after a user turn, after an assistant turn.  A row is a 4 x 4 table of least costs from state
to state, and so is any stretch of rows; tables of neighbouring stretches combine.  Long conversations are
cut into stretches of ``STRETCH`` rows that are solved apart, once the states at their borders are known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.operators.numbering import dense_ids
from corpuskit.session import cut_lineage

STRETCH = 1_024  # rows of a stretch, and stretches that are combined at a time
BLANKS = " \t\n\x0b\x0c\r"
NEVER = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
KINDS = "sua"
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
# What edits cost.
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 3, 4, 3, 3
AFTER_INSERT = [USER, USER, ASSISTANT, USER]
SPEAKS = {USER: "user", ASSISTANT: "assistant"}
# Turns to insert behind the last row of a conversation, by state; and what they cost.
CLOSING = ["", "II", "I", ""]
NAMES = ["conv_id", "turn", "role", "text"]


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults planted by crc32(``conv_id:turn``) mod 20, as ``(conv_id, turn, role, text)``.

    0 drops the row, 1 empties its text, 2 removes the marks ``.!?``, 3 repeats the row, 4 makes it the
    user's; others stay.  A null role or text is one blank, and so is a null number in the key.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv_id, turn)])
    said = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        (F.crc32(key) % 20).alias("_way"),
    )
    way = F.col("_way")
    return said.where(way != 0).select(
        "conv_id",
        "turn",
        F.when(way == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(way == 1, "").when(way == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(way == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def numbered(turns: DataFrame) -> DataFrame:
    """``(id, conv_id, turn, role, text, code)``: rows of a conversation have consecutive numbers.

    Turns are in order of their number, null first; equal numbers by role and text (texts that share
    200 characters by their SHA-256).  ``code``: four times the kind of role, plus the row's own fault.
    """
    order = F.struct("conv_id", "turn", "role", F.left("text", F.lit(200)), F.sha2("text", 256), F.monotonically_increasing_id())
    # Written first: the tie number must not change when a task runs again.
    rows = dense_ids(cut_lineage(turns.select(*NAMES)).withColumn("_order", order), "_order", id_type="bigint")
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    whole = F.right(trimmed, F.lit(1)).isin(".", "!", "?")
    fault = F.when(trimmed == "", BLANK).when(whole, FINE).otherwise(TRUNCATED)
    return rows.select("id", *NAMES, (kind * 4 + fault).alias("code"))


def steps(code: int) -> list[list[tuple[int, str]]]:
    """Least cost and edits (some inserted turns, then the row's own edit) from each state to each state."""
    kind, fault = divmod(code, 4)
    table = [[(NEVER, "")] * 4 for _ in range(4)]
    for first in range(4):
        state, paid, edits = first, 0, ""
        for _ in range(3):
            ways = [(DELETE, "D", state)]
            if fault in (FINE, TRUNCATED):
                extra = LEFT_TRUNCATED if fault == TRUNCATED else 0
                speaker = AFTER_INSERT[state]
                ways.append((REROLE + extra, "R", speaker))
                if kind < 3 and (kind + 1 == speaker or (kind + 1 == SYSTEM and state == START)):
                    ways.append((extra, "K", kind + 1))
            for cost, edit, last in ways:
                table[first][last] = min(table[first][last], (paid + cost, edits + edit))
            state, paid, edits = AFTER_INSERT[state], paid + INSERT, edits + "I"
    return table


STEPS = [steps(code) for code in range(16)]


def table_of(cells: list[list[tuple[int, object]]]) -> tuple[list[list[int]], list[list[int]]]:
    """Costs, and for each first state the order of the four last states by their edits."""
    costs = [[cost for cost, _ in row] for row in cells]
    orders = []
    for row in cells:
        places = sorted(range(4), key=lambda t: (row[t][0] >= NEVER, row[t][1]))
        orders.append([places.index(t) for t in range(4)])
    return costs, orders


Table = tuple[list[list[int]], list[list[int]]]
TABLES: list[Table] = [table_of(cells) for cells in STEPS]


def onward(costs: list[int], ranks: list[int], table: Table) -> tuple[list[int], list[int]]:
    """Forward cost vector over one more row or stretch; ``ranks`` order the edits that lead to each state.

    All edits up to a row consume the same rows, so none is the beginning of another: where two differ in
    their earlier part, that decides, and otherwise the edits of the last step do.
    """
    step, order = table
    best = [(NEVER, 9, 9)] * 4
    for s in range(4):
        if costs[s] < NEVER:
            row, places = step[s], order[s]
            for t in range(4):
                if row[t] < NEVER:
                    way = (costs[s] + row[t], ranks[s], places[t])
                    if way < best[t]:
                        best[t] = way
    places = sorted(range(4), key=lambda t: (best[t][0] >= NEVER, best[t][1], best[t][2]))
    ranks = [0] * 4
    for n, t in enumerate(places):
        ranks[t] = n
    return [b[0] for b in best], ranks


def backward(costs: list[int], table: Table) -> list[int]:
    """Backward cost vector over one more row or stretch."""
    return [min(NEVER, min(c + d for c, d in zip(row, costs))) for row in table[0]]


def single(state: int) -> list[int]:
    return [0 if s == state else NEVER for s in range(4)]


def combined(tables: list[Table]) -> Table:
    """The table of a stretch from those of its parts."""
    costs, orders = [], []
    for first in range(4):
        cost, rank = single(first), [0, 1, 2, 3]
        for table in tables:
            cost, rank = onward(cost, rank, table)
        costs.append(cost)
        orders.append(rank)
    return costs, orders


def last_state(table: Table) -> int:
    """Where the best edits of a whole conversation stand before the closing turns."""
    costs, orders = table
    return min(range(4), key=lambda t: (costs[START][t] + INSERT * len(CLOSING[t]), orders[START][t]))


def crossings(tables: list[Table], first: int, last: int) -> list[int]:
    """The state before each part and behind the last one, on the least edits from ``first`` to ``last``.

    Forward and backward cost vectors meet in the middle; of the cheapest states there, the one whose
    edits come first in ASCII order is taken, and both halves are solved in turn.  Memory is the two
    vectors beside the answer.
    """
    states = [first] * len(tables) + [last]
    halves = [(0, len(tables))]
    while halves:
        low, high = halves.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        cost, rank = single(states[low]), [0, 1, 2, 3]
        for n in range(low, middle):
            cost, rank = onward(cost, rank, tables[n])
        rest = single(states[high])
        for n in range(high - 1, middle - 1, -1):
            rest = backward(rest, tables[n])
        states[middle] = min(range(4), key=lambda t: (cost[t] + rest[t], rank[t]))
        halves += [(low, middle), (middle, high)]
    return states


def row_edits(codes: list[int], first: int, last: int) -> list[tuple[int, str]]:
    """For each row the state before it, and its edits."""
    states = crossings([TABLES[c] for c in codes], first, last)
    return [(s, STEPS[c][s][t][1]) for c, s, t in zip(codes, states[:-1], states[1:])]


def flat(table: Table) -> tuple[list[int], list[int]]:
    return [c for row in table[0] for c in row], [r for row in table[1] for r in row]


def folded(costs: list[int], orders: list[int]) -> Table:
    return [costs[n : n + 4] for n in (0, 4, 8, 12)], [orders[n : n + 4] for n in (0, 4, 8, 12)]


def columns(rows: list[tuple], batch_schema: pa.Schema) -> pa.RecordBatch:
    values = zip(*rows) if rows else [[]] * len(batch_schema)
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, batch_schema)], schema=batch_schema)


LONGS = pa.list_(pa.int64())
STRETCHES = pa.schema([("first", pa.int64()), ("codes", LONGS), ("costs", LONGS), ("orders", LONGS)])
PARENTS = pa.schema([("first", pa.int64()), ("costs", LONGS), ("orders", LONGS)])
BORDERS = pa.schema([("first", pa.int64()), ("state", pa.int64()), ("next_state", pa.int64())])
STRETCH_ROWS = "conv_id {0}, first bigint, codes array<bigint>, costs array<bigint>, orders array<bigint>"


def with_key(batch: pa.RecordBatch, made: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(0), *made.columns], names=["conv_id", *made.schema.names])


def stretches(rows: DataFrame) -> DataFrame:
    """``(conv_id, first, codes, costs, orders)``: codes of at most ``STRETCH`` rows and their table.

    A row that repeats role and text of an earlier one of its conversation is a duplicate; the first one
    is found by partial aggregates, and only numbers are gathered, ``STRETCH`` of them at most.
    """
    text = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = rows.groupBy("conv_id", text.alias("_said")).agg(F.min("id").alias("id"))
    marked = rows.select("conv_id", "id", F.col("code").cast("bigint").alias("code")).unionByName(
        firsts.select("conv_id", "id", F.lit(-1).cast("bigint").alias("code"))
    )
    block = F.floor(F.col("id") / STRETCH).alias("_block")
    lists = marked.groupBy("conv_id", block).agg(F.array_sort(F.collect_list(F.struct("id", "code"))).alias("items"))
    lists = lists.select("conv_id", F.col("items.id").alias("ids"), F.col("items.code").alias("codes"))

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, codes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                new = {i for i, c in zip(ids, codes) if c < 0}
                own = [(i, c) for i, c in zip(ids, codes) if c >= 0]
                codes = [c if i in new or c % 4 == BLANK else c - c % 4 + DUPLICATE for i, c in own]
                out.append((own[0][0], codes, *flat(combined([TABLES[c] for c in codes]))))
            yield with_key(batch, columns(out, STRETCHES))

    kind = rows.schema["conv_id"].dataType.simpleString()
    return cut_lineage(lists.mapInArrow(tables, STRETCH_ROWS.format(kind)))


def members(level: DataFrame, *keys) -> DataFrame:
    """Neighbouring stretches of a conversation in lists: ``(conv_id, firsts, costs, orders)``."""
    item = F.struct("first", "costs", "orders")
    lists = level.groupBy("conv_id", *keys).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return lists.select("conv_id", F.col("items.first").alias("firsts"), F.col("items.costs").alias("costs"), F.col("items.orders").alias("orders"))


def parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for firsts, costs, orders in zip(*[c.to_pylist() for c in batch.columns[1:4]]):
            out.append((firsts[0], *flat(combined([folded(c, o) for c, o in zip(costs, orders)]))))
        yield with_key(batch, columns(out, PARENTS))


def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States at the borders of listed stretches; given columns 4 and 5, between those states."""
    for batch in batches:
        given = [c.to_pylist() for c in batch.columns[4:6]] or [[None] * batch.num_rows] * 2
        out = []
        for firsts, costs, orders, state, last in zip(*[c.to_pylist() for c in batch.columns[1:4]], *given):
            tables = [folded(c, o) for c, o in zip(costs, orders)]
            if state is None:
                state, last = START, last_state(combined(tables))
            states = crossings(tables, state, last)
            out += zip(firsts, states[:-1], states[1:])
        yield columns(out, BORDERS)


def solved(chunks: DataFrame, fan: int = STRETCH) -> DataFrame:
    """``chunks`` with ``state`` and ``next_state``, the states before and behind each stretch.

    Tables are combined ``fan`` at a time until a conversation has few, the states of those are chosen,
    and then those of the parts between them, down to the stretches.
    """
    kind = chunks.schema["conv_id"].dataType.simpleString()
    level, lists = chunks.select("conv_id", "first", "costs", "orders"), []
    width = STRETCH
    while (level.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > fan:
        width *= fan
        lists.append(members(level, F.floor(F.col("first") / width).alias("_part")))
        level = cut_lineage(lists[-1].mapInArrow(parents, f"conv_id {kind}, first bigint, costs array<bigint>, orders array<bigint>"))
    found = members(level).mapInArrow(borders, "first bigint, state bigint, next_state bigint")
    for group in reversed(lists):
        known = found.withColumnRenamed("first", "_first")
        inner = group.withColumn("_first", F.col("firsts")[0]).join(known, "_first").drop("_first")
        found = inner.mapInArrow(borders, "first bigint, state bigint, next_state bigint")
    return chunks.drop("costs", "orders").join(found, "first")


MARK, STRETCH_HEAD, TURN = range(3)


def in_order(conversations: DataFrame, turns: DataFrame, chunks: DataFrame) -> DataFrame:
    """Everything about a conversation one after another: its mark, then each stretch's answer and its turns.

    A task reads its rows once, in order, and holds one stretch of codes at most.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    shape = f"conv_id {kind}, at bigint, kind int, turn bigint, role string, text string, codes array<bigint>, state bigint, next_state bigint"

    def part(df: DataFrame, at, number: int, **known) -> DataFrame:
        fields = [f.split(" ") for f in shape.split(", ")]
        given = {"conv_id": F.col("conv_id"), "at": at, "kind": F.lit(number), **known}
        return df.select(*[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields])

    col = F.col
    marks = part(conversations.select("conv_id").distinct(), F.lit(-1), MARK)
    heads = part(chunks, col("first"), STRETCH_HEAD, codes=col("codes"), state=col("state"), next_state=col("next_state"))
    said = part(turns, col("id"), TURN, turn=col("turn"), role=col("role"), text=col("text"))
    rows = marks.unionByName(heads).unionByName(said)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")


class Walk:
    """Follows one conversation: figures, the audit and the repaired turns."""

    def __init__(self, conv: object) -> None:
        self.conv = conv
        self.low = self.high = self.turn = None
        self.turns_seen = self.rows = self.illegal = self.cost = 0
        self.faults = [0, 0, 0, 0]
        self.audit: list[str] = []
        self.kind = self.state = None
        self.edits: Iterator[tuple[int, int, str]] = iter(())

    def head(self, codes: list[int], state: int, last: int) -> None:
        self.edits = iter([(c, *e) for c, e in zip(codes, row_edits(codes, state, last))])
        self.state = last

    def said(self, turn: int | None, role: str, text: str) -> list[tuple[str, str, str]]:
        """(edit, role, text) of what stays of a turn and of the turns inserted before it."""
        code, state, edits = next(self.edits)
        kind, fault = divmod(code, 4)
        if turn is not None:
            if turn != self.turn:
                self.turns_seen += 1
            self.turn = turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.kind is not None and (self.kind, kind) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.kind = kind
        self.rows += 1
        self.faults[fault] += 1
        self.audit.append(edits)
        out = []
        for _ in edits[:-1]:
            state = AFTER_INSERT[state]
            out.append(("I", SPEAKS[state], ""))
        edit = edits[-1]
        self.cost += INSERT * (len(edits) - 1) + {"K": 0, "R": REROLE, "D": DELETE}[edit]
        if edit != "D":
            self.cost += LEFT_TRUNCATED * (fault == TRUNCATED)
            out.append((edit, role if edit == "K" else SPEAKS[AFTER_INSERT[state]], text))
        return out

    def closing(self) -> list[tuple[str, str, str]]:
        edits = CLOSING[self.state] if self.rows else ""
        self.audit.append(edits)
        self.cost += INSERT * len(edits)
        speakers = ["user", "assistant"][2 - len(edits) :] if edits else []
        return [("I", s, "") for s in speakers]

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns_seen


def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Walk, list[tuple[str, str, str]], bool]]:
    """Of each conversation in turn: the walk, the next repaired turns, and whether it has ended."""
    walk = None
    for batch in batches:
        for conv, kind, turn, role, text, codes, state, last in zip(*[batch.column(n).to_pylist() for n in (0, 2, 3, 4, 5, 6, 7, 8)]):
            if kind == MARK:
                if walk is not None:
                    yield walk, walk.closing(), True
                walk = Walk(conv)
            elif kind == STRETCH_HEAD:
                walk.head(codes, state, last)
            else:
                yield walk, walk.said(turn, role, text), False
    if walk is not None:
        yield walk, walk.closing(), True


REPAIRED = pa.schema([("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
REPORT = pa.schema(
    [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string()), ("n_rows", pa.int64())]
)


def batches_of(rows: Iterator[tuple], conv: pa.DataType, schema: pa.Schema, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches of rows whose first value is the conversation; ``most`` bounds their characters."""
    full = pa.schema([pa.field("conv_id", conv), *schema])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, str))
        if size > most:
            yield columns(held, full)
            held, size = [], 0
    yield columns(held, full)


def repaired_turns(walked: DataFrame) -> DataFrame:
    """The repaired conversations: ``(conv_id, place, edit, role, text)``; deleted turns are not listed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def made() -> Iterator[tuple]:
            place = 0
            for walk, turns, ended in walks(iter_of(first, batches)):
                for edit, role, text in turns:
                    yield walk.conv, place, edit, role, text
                    place += 1
                place = 0 if ended else place

        yield from batches_of(made(), first.schema.field(0).type, REPAIRED)

    kind = walked.schema["conv_id"].dataType.simpleString()
    return walked.mapInArrow(rows, f"conv_id {kind}, place bigint, edit string, role string, text string")


def report(walked: DataFrame) -> DataFrame:
    """One row per conversation: figures, cost, audit, and the SHA-256 of the repaired ``role:text`` lines."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def made() -> Iterator[tuple]:
            digest, lines = hashlib.sha256(), 0
            for walk, turns, ended in walks(iter_of(first, batches)):
                for _, role, text in turns:
                    digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
                if ended:
                    figures = (walk.gaps(), walk.faults[BLANK], walk.faults[DUPLICATE], walk.faults[TRUNCATED], walk.illegal, walk.cost)
                    yield walk.conv, *figures, "".join(walk.audit), digest.hexdigest(), walk.rows
                    digest, lines = hashlib.sha256(), 0

        yield from batches_of(made(), first.schema.field(0).type, REPORT)

    kind = walked.schema["conv_id"].dataType.simpleString()
    figures = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'bigint'}" for f in REPORT)
    return walked.mapInArrow(rows, f"conv_id {kind}, {figures}")


def iter_of(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def repaired(conversations: DataFrame, turns: DataFrame, fan: int = STRETCH) -> DataFrame:
    """Least-cost repair of ``turns`` (conv_id, turn, role, text), ready for ``report`` and ``repaired_turns``.

    Each row is kept, given the role user or assistant (3), or deleted (4, required for blank and duplicate
    rows); turns without text may be inserted anywhere (3); a truncated row that stays costs 3 more.  Of
    the cheapest repairs the one whose edits' initials come first in ASCII order is taken.

    All conversations of ``conversations`` are reported, also those without turns; null ids are one
    conversation.  Null turn numbers come first, equal ones are ordered by role and text, repeated rows are
    repeated turns.  Roles count by their first letter, and a kept row keeps its role's spelling.  A null
    role or text is one blank.  Conversations of any length are solved in stretches; only the hash of the
    repaired text is made by one task a conversation, since SHA-256 runs from front to back.
    """
    said = turns.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    rows = numbered(said)
    return in_order(conversations, rows, solved(stretches(rows), fan))
