"""Transcript assembly that survives conversations of any length.

Lengths come first, without text: a sum per conversation. Most conversations fit under the cap; their
text is shuffled once, by conversation. Longer ones, if there are any, go by blocks of positions, so
that no task ever holds the text of a whole conversation, however long it is:

1. a running sum over block lengths gives each block its start offset;
2. only blocks that touch the kept head or tail go on, and inside them every
   line is trimmed to its kept characters;
3. the trimmed pieces, at most the cap per conversation, are joined.

Uncapped text comes in parts that are bounded by positions and by characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.functions import text
from talkmeter.session import written

SEPARATOR = "\n\n"
BLOCK = 512
PART_CHARS = 1_000_000


def block_of(sequence: Column, size: int) -> Column:
    """Block number of a position; positions that are missing come last."""
    return F.coalesce(F.floor(sequence / F.lit(size)), F.lit(2**40))


def truncated_messages(messages: DataFrame, limits: dict[str, int]) -> DataFrame:
    """One row per message with its text after the per-kind cut."""
    cut = text.cut_message(F.col("message_type"), F.col("content"), limits)
    return messages.select(
        "conversation_id",
        "id",
        "sequence_number",
        "message_type",
        cut.alias("content"),
        F.length(cut).cast("bigint").alias("length"),
    )


def lines(messages: DataFrame, limits: dict[str, int], block: int = BLOCK) -> DataFrame:
    line = text.transcript_line(F.col("message_type"), F.col("content"), limits)
    return messages.select(
        "conversation_id",
        block_of(F.col("sequence_number"), block).alias("block"),
        F.coalesce("sequence_number", F.lit(2**31 - 1)).alias("position"),
        "id",
        line.alias("line"),
    )


def joined(rows: Column, field: str, separator: str) -> Column:
    """Texts of an array of ``(order..., text)`` structs, in array order."""
    return F.array_join(F.transform(F.array_sort(rows), lambda row: row[field]), separator)


def line_width() -> Column:
    """Characters of a line and the separator that follows it."""
    return F.length("line").cast("bigint") + len(SEPARATOR)


def in_block() -> W:
    """The lines of a block up to the one at hand."""
    ordered = W.partitionBy("conversation_id", "block").orderBy("position", "id", "line")
    return ordered.rowsBetween(W.unboundedPreceding, W.currentRow)


def transcript_parts(
    messages: DataFrame, limits: dict[str, int] = V.CONSULTATION_LIMITS, block: int = BLOCK,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Whole, uncapped transcripts as ordered parts.

    Joining the parts of a conversation by a blank line in (``part``, ``piece``)
    order gives the full text; a conversation inside one block is a single part,
    unless it is longer than ``part_chars``. A piece holds lines of one block
    that start within ``part_chars`` characters, so its size does not grow with
    the data, also where messages share a position or have none.
    """
    before = F.sum(line_width()).over(in_block()) - line_width()
    rows = F.collect_list(F.struct("position", "id", "line"))
    return (
        lines(messages, limits, block)
        .withColumn("piece", F.floor(before / F.lit(part_chars)))
        .groupBy("conversation_id", "block", "piece")
        .agg(rows.alias("rows"))
        .select(
            "conversation_id",
            F.col("block").alias("part"),
            "piece",
            F.size("rows").cast("bigint").alias("messages"),
            joined(F.col("rows"), "line", SEPARATOR).alias("text"),
        )
        .withColumn("part_chars", F.length("text").cast("bigint"))
    )


def long_conversations(line_rows: DataFrame, cap: int) -> DataFrame:
    """Conversations whose transcript is above the cap, by one fold of their lines' widths."""
    widths = line_rows.groupBy("conversation_id").agg(F.sum(line_width()).alias("width"))
    return widths.filter(F.col("width") - len(SEPARATOR) > cap).select("conversation_id")


def block_offsets(line_rows: DataFrame) -> DataFrame:
    """Start offset of each block, the transcript length and its ends, without text.

    Every line counts its separator too; the total takes the last one off. The
    windows run over one narrow row per block: positions are 32-bit, so even
    the longest conversation has at most 2**31 / block of them, and they spill.
    """
    sizes = line_rows.groupBy("conversation_id", "block").agg(
        F.sum(line_width()).alias("width"), *ends("position", "position")
    )
    conversation = W.partitionBy("conversation_id")
    upto = conversation.orderBy("block").rowsBetween(W.unboundedPreceding, W.currentRow)
    return sizes.select(
        "conversation_id",
        "block",
        (F.sum("width").over(upto) - F.col("width")).alias("block_start"),
        F.col("width").alias("block_width"),
        (F.sum("width").over(conversation) - len(SEPARATOR)).alias("char_count"),
        F.min("first_position").over(conversation).alias("first_position"),
        F.max("last_position").over(conversation).alias("last_position"),
    )


def ends(first: str, last: str) -> list[Column]:
    """First and last position of a group."""
    return [
        F.min(F.col(first).cast("bigint")).alias("first_position"),
        F.max(F.col(last).cast("bigint")).alias("last_position"),
    ]


def short_transcripts(line_rows: DataFrame, long_ids: DataFrame | None = None) -> DataFrame:
    """Whole texts of conversations that fit under the cap: one shuffle of their lines.

    Lines are dealt before they are grouped: a task of the scan has few lines of a conversation, and to
    collect them there would sort all texts for nothing. With ``long_ids``, those of conversations above
    the cap, the lines of these are left out, and a join that isn't broadcast deals the others.
    """
    if long_ids is None:
        dealt = line_rows.repartition("conversation_id")
    else:
        dealt = line_rows.join(long_ids, "conversation_id", "left_anti")
    texts = (
        dealt.groupBy("conversation_id")
        .agg(
            F.collect_list(F.struct("position", "id", "line")).alias("rows"),
            *ends("position", "position"),
        )
        .withColumn("transcript", joined(F.col("rows"), "line", SEPARATOR))
    )
    return texts.select(
        "conversation_id", F.length("transcript").cast("bigint").alias("char_count"), "transcript",
        "first_position", "last_position",
    )


def cut_transcripts(
    line_rows: DataFrame, blocks: DataFrame, head: int, tail: int
) -> DataFrame:
    """Head, notice and tail of conversations above the cap, from the blocks that hold them."""
    total = F.col("char_count")
    tail_from = total - tail

    def touches(start: Column, width: Column) -> Column:
        return (start < head) | (start + width > tail_from)

    kept = written(
        blocks.filter(touches(F.col("block_start"), F.col("block_width"))), "transcript-blocks"
    )
    start = F.col("start")
    # The separator belongs to the line before it, except after the last line.
    full = F.when(
        start + F.col("width") >= total + len(SEPARATOR), F.col("line")
    ).otherwise(F.concat("line", F.lit(SEPARATOR)))

    def slice_of(low: Column, high: Column) -> Column:
        """Characters of this line whose offsets lie in ``[low, high)``."""
        begin = F.greatest(low - start, F.lit(0))
        size = F.least(high - start, F.length(F.col("full")).cast("bigint")) - begin
        return F.when(
            size > 0,
            F.substr(F.col("full"), (begin + 1).cast("int"), size.cast("int")),
        ).otherwise("")

    pieces = (
        line_rows.join(kept, ["conversation_id", "block"])
        .withColumn("width", line_width())
        .withColumn(
            "start",
            F.col("block_start") + F.sum("width").over(in_block()) - F.col("width"),
        )
        .filter(touches(start, F.col("width")))
        .withColumn("full", full)
        .select(
            "conversation_id",
            "char_count",
            "first_position",
            "last_position",
            "start",
            slice_of(F.lit(0), F.lit(head)).alias("front"),
            slice_of(tail_from, total).alias("back"),
        )
    )
    texts = pieces.groupBy("conversation_id").agg(
        F.max("char_count").alias("char_count"),
        *ends("first_position", "last_position"),
        F.collect_list(F.struct("start", "front", "back")).alias("rows"),
    )
    return texts.select(
        "conversation_id",
        "char_count",
        F.concat(
            joined(F.col("rows"), "front", ""),
            text.cut_notice(total - head - tail),
            joined(F.col("rows"), "back", ""),
        ).alias("transcript"),
        "first_position",
        "last_position",
    )


def capped_transcripts(
    messages: DataFrame,
    limits: dict[str, int] = V.CONSULTATION_LIMITS,
    cap: int = V.TRANSCRIPT_CAP,
    head: int = V.TRANSCRIPT_HEAD,
    tail: int = V.TRANSCRIPT_TAIL,
    block: int = BLOCK,
) -> DataFrame:
    """One bounded text per conversation, and the length it had before the cap.

    A text of at most ``cap`` characters stays whole; a longer one keeps its
    first ``head`` and last ``tail`` characters around a notice of the cut.
    """
    placed = placed_transcripts(messages, limits, cap, head, tail, block)
    return placed.select("conversation_id", "char_count", "transcript")


def placed_transcripts(
    messages: DataFrame,
    limits: dict[str, int] = V.CONSULTATION_LIMITS,
    cap: int = V.TRANSCRIPT_CAP,
    head: int = V.TRANSCRIPT_HEAD,
    tail: int = V.TRANSCRIPT_TAIL,
    block: int = BLOCK,
) -> DataFrame:
    """The capped transcripts with the first and the last position of their messages.

    The ids and blocks of long conversations are written, so that Spark knows
    how many there are and sends a short list to the scan; without any, there
    are no blocks to make.
    """
    line_rows = lines(messages, limits, block)
    long_ids = written(long_conversations(line_rows, cap), "transcript-long")
    if long_ids.isEmpty():
        return short_transcripts(line_rows)
    of_long = line_rows.join(long_ids, "conversation_id", "left_semi")
    blocks = written(block_offsets(of_long), "transcript-lengths")
    return short_transcripts(line_rows.join(long_ids, "conversation_id", "left_anti")).unionByName(
        cut_transcripts(line_rows, blocks, head, tail)
    )


def sql_output_transcripts(messages: DataFrame, **settings: int) -> DataFrame:
    """Transcripts for the SQL judge, which lets longer user messages through."""
    return capped_transcripts(messages, V.SQL_OUTPUT_LIMITS, **settings)
