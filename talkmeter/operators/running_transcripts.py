"""Capped transcripts kept up load by load.

A capped transcript (its length before the cap, and its text, or head, notice and tail) is all that is
needed to put further text behind it: ``joined_pair`` of two neighbours equals the capped transcript of
their messages together, in any grouping. So a load builds transcripts of its own messages only and
folds them into the stored ones of the conversations it touches, in buckets of conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.functions import text
from talkmeter.operators import transcripts
from talkmeter.sources import keyed

SCHEMA = (
    "conversation_id bigint, char_count bigint, transcript string, "
    "first_position bigint, last_position bigint"
)


def joined_pair(
    first: tuple[Column, Column], then: tuple[Column, Column], cap: int, head: int, tail: int
) -> tuple[Column, Column]:
    """(char_count, transcript) of two neighbouring capped transcripts, each such a pair."""
    gap = F.lit(transcripts.SEPARATOR)
    (n, a), (m, b) = first, then
    total = n + m + len(transcripts.SEPARATOR)

    def left(value: Column, size: int) -> Column:
        return F.substring(value, 1, size)

    def right(value: Column, size: int) -> Column:
        return F.substring(value, -size, size) if size else F.lit("")

    whole = F.concat(a, gap, b)
    # A text above the cap begins with its head and ends with its tail, like a whole one.
    front = left(F.concat(left(a, head), F.when(n < head, F.concat(gap, left(b, head))).otherwise("")), head)
    back = right(F.concat(F.when(m < tail, F.concat(right(a, tail), gap)).otherwise(""), right(b, tail)), tail)
    cut = F.concat(front, text.cut_notice(total - head - tail), back)
    return total, F.when(total <= cap, whole).otherwise(cut)


def states(messages: DataFrame, **settings) -> DataFrame:
    """``SCHEMA`` rows of the messages: one per conversation, whatever its length."""
    known = messages.filter(F.col("conversation_id").isNotNull())
    return transcripts.placed_transcripts(known, **settings)


def load(
    messages: DataFrame, path: str, whole: bool = True, cap: int = V.TRANSCRIPT_CAP,
    head: int = V.TRANSCRIPT_HEAD, tail: int = V.TRANSCRIPT_TAIL, buckets: int = 64, **settings,
) -> list[int]:
    """Fold a load's messages into the stored transcripts; returns the buckets that were rewritten.

    With ``whole`` the load holds all messages of the conversations it touches, as incremental loads
    do, and their transcripts are replaced. Without, it holds messages that follow the stored ones;
    one that doesn't stand behind them (also at the same position, or where positions are missing)
    fails the load, and nothing is changed.
    """
    new = states(messages, cap=cap, head=head, tail=tail, **settings)
    if whole:
        return keyed.merge(new, path, SCHEMA, ["conversation_id"], [], buckets)

    def combine(old: DataFrame, batch: DataFrame) -> DataFrame:
        key = [keyed.BUCKET, "conversation_id"]
        both = old.alias("old").join(batch.alias("new"), key, "full")
        pair = [(F.col(f"{side}.char_count"), F.col(f"{side}.transcript")) for side in ("old", "new")]
        count, joined = joined_pair(*pair, cap, head, tail)
        known, comes = (F.col(f"{side}.char_count").isNotNull() for side in ("old", "new"))
        behind = F.col("new.first_position") > F.col("old.last_position")
        stop = F.raise_error(F.concat(
            F.lit("messages of conversation "), F.col("conversation_id").cast("string"),
            F.lit(" don't follow the stored ones"),
        ))

        def chosen(together: Column, name: str) -> Column:
            of = {side: F.col(f"{side}.{name}") for side in ("old", "new")}
            return (
                F.when(~comes, of["old"]).when(~known, of["new"])
                .when(behind, together).otherwise(stop).alias(name)
            )

        return both.select(
            *key, chosen(count, "char_count"), chosen(joined, "transcript"),
            chosen(F.col("old.first_position"), "first_position"),
            chosen(F.col("new.last_position"), "last_position"),
        ).repartition(keyed.BUCKET)

    return keyed.rewrite(new, path, SCHEMA, ["conversation_id"], combine, buckets)


def current(spark: SparkSession, path: str) -> DataFrame:
    return keyed.read(spark, path, SCHEMA).select("conversation_id", "char_count", "transcript")
