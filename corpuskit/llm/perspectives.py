"""Chat formatting for conversations of several speakers: every participant once as the assistant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.operators.numbering import dense_ids
from corpuskit.session import cut_lineage

END = "<|end|>"
UNKNOWN = "unknown"
TURNS_PER_BUCKET = 256
EXAMPLE_CHARS = 32_768


def escaped(text: Column) -> Column:
    """Keeps a text from holding markers: one backslash more between "<" and "|", so that it can be undone."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def segments(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    system: str = "system",
) -> DataFrame:
    """One row per conversation, perspective and turn, with its place in the rendered dialogue.

    Columns: ``conv_id, perspective, turn, speaker, segment, start, chars, mask_start,
    mask_end``; places count characters of the dialogue, and the mask (null outside
    the perspective's own turns) covers what the assistant would write, end mark
    included.  Participants are all speakers but ``system``, whose turns stay system
    turns; a conversation of system turns only has no perspective.

    A null or blank role speaks as ``unknown``, a null text is empty, a null turn
    comes first, null conversation ids are one conversation.  Equal turn numbers are
    ordered by speaker and text; repeated rows are repeated turns.  Turns are numbered
    in that order over the whole table, and places come from sums per stretch of
    ``TURNS_PER_BUCKET`` numbers and a running total of the stretches, so a conversation
    of any length is spread over tasks, equal or null turn numbers included.  A name in
    a header is written as in a URL, so that names stay apart.
    """
    said = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.nullif(F.trim(F.col(role)), F.lit("")), F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    order = F.struct("conv_id", "turn", "speaker", F.left("text", F.lit(200)), F.sha2("text", 256), F.monotonically_increasing_id())
    # Written first: the tie number must not change when a task runs again.
    said = dense_ids(cut_lineage(said).withColumn("_order", order), "_order", id_type="bigint").drop("_order")
    people = said.where(F.col("speaker") != system).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    seen = said.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    name = F.replace(F.replace(F.replace(F.url_encode("speaker"), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    own = F.col("speaker") == F.col("perspective")
    header = (
        F.when(F.col("speaker") == system, F.lit("<|system|>\n"))
        .when(own, F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), name, F.lit("|>\n")))
    )
    made = seen.select(
        "conv_id",
        "perspective",
        "turn",
        "speaker",
        own.alias("_own"),
        F.length(header).alias("_header"),
        F.concat(header, escaped(F.col("text")), F.lit(END + "\n")).alias("segment"),
        "id",
        F.floor(F.col("id") / TURNS_PER_BUCKET).alias("_bucket"),
    ).withColumn("chars", F.length("segment").cast("bigint"))
    dialogue = ["conv_id", "perspective"]
    inside = Window.partitionBy(*dialogue, "_bucket").orderBy("id")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumn("_start", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    stretches = made.groupBy(*dialogue, "_bucket").agg(F.sum("chars").alias("_chars"))
    earlier = Window.partitionBy(*dialogue).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = stretches.select(
        F.col("conv_id").alias("_conv"),
        F.col("perspective").alias("_who"),
        F.col("_bucket").alias("_stretch"),
        F.coalesce(F.sum("_chars").over(earlier), F.lit(0)).alias("_base"),
    )
    based = placed.join(
        bases,
        F.col("conv_id").eqNullSafe(F.col("_conv"))
        & (F.col("perspective") == F.col("_who"))
        & (F.col("_bucket") == F.col("_stretch")),
    )
    start = F.col("_base") + F.col("_start")
    return based.select(
        *dialogue,
        "turn",
        "speaker",
        "segment",
        start.alias("start"),
        "chars",
        F.when(F.col("_own"), start + F.col("_header")).alias("mask_start"),
        F.when(F.col("_own"), start + F.col("chars") - 1).alias("mask_end"),
    )


def examples(rendered: DataFrame, most_chars: int = EXAMPLE_CHARS) -> DataFrame:
    """Training examples: ``(conv_id, perspective, part, start, n_turns, text, mask)``.

    Turns that start in the same ``most_chars`` characters of a dialogue form one
    example, so no example gathers more than that and one turn; short dialogues have
    one.  ``mask``: array of (first, end) in characters of the example.
    """
    part = F.floor(F.col("start") / most_chars).alias("part")
    row = F.struct("start", "segment", "mask_start", "mask_end")
    lists = rendered.groupBy("conv_id", "perspective", part).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    start = F.col("rows")[0]["start"]
    trained = F.filter("rows", lambda r: r["mask_start"].isNotNull())
    mask = F.transform(
        trained, lambda r: F.struct((r["mask_start"] - start).alias("first"), (r["mask_end"] - start).alias("end"))
    )
    return lists.select(
        "conv_id",
        "perspective",
        "part",
        start.alias("start"),
        F.size("rows").alias("n_turns"),
        F.array_join("rows.segment", "").alias("text"),
        mask.alias("mask"),
    )
