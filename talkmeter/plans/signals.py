"""Per-conversation behaviour signals in one pass over the messages.

Every message is reduced to a few flags before anything is shuffled, and all
signals are one hash aggregate with fixed-width buffers, so the map side
already folds each conversation to one narrow row per task. Text never leaves
the scan stage.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.functions import labels, text
from talkmeter.operators.latest import first_by
from talkmeter.plans import staging

# First and last position stand-ins when a position is missing: last of all.
LAST_POSITION = 2**31 - 1
SCORE_BITS = 32


def message_flags(messages: DataFrame, keep: list[str | Column] = ()) -> DataFrame:
    """One narrow row per message: the facts all signals are counted from."""
    kind, lowered = F.col("message_type"), F.col("lowered")
    call, result, user = kind == "tool_call", kind == "tool_result", kind == "user"

    def has(pattern: str) -> Column:
        return text.matches(lowered, pattern)

    write = call & has(V.FILE_WRITE) & ~has(V.TODO_WRITE)
    review = result & has(V.REVIEW_SCORE_LINE)
    # (position, score) in one long: min/max of it finds the first/last review
    # without sorting and keeps the aggregate a hash aggregate. Score 0 marks a
    # review line without a number.
    position = F.coalesce("sequence_number", F.lit(LAST_POSITION)).cast("bigint")
    score = text.review_score(F.col("content")).cast("bigint")
    packed_score = F.coalesce(score + 1, F.lit(0).cast("bigint"))
    packed = F.shiftleft(position, SCORE_BITS) + packed_score
    return messages.withColumn("lowered", F.lower("content")).select(
        "conversation_id",
        *keep,
        F.col("sequence_number").alias("position"),
        user.alias("is_user"),
        (call & has(V.PREFETCH_CALL)).alias("is_prefetch"),
        (write & has(V.SQL_FOLDER)).alias("is_sql_write"),
        (write & ~has(V.SQL_FOLDER)).alias("is_other_write"),
        ((call | result) & text.matches_any(lowered, V.SQL_EXECUTION)).alias("is_execution"),
        (result & has(V.RESULT_PREVIEW)).alias("is_preview"),
        (result & has(V.DATABASE_ERROR)).alias("is_database_error"),
        F.when(review, packed).alias("review"),
        (user & text.matches_any(lowered, V.CORRECTION_PHRASES)).alias("is_correction"),
        has(V.STALE_DOCUMENT).alias("is_stale"),
        (result & has(V.TOOL_USE_ERROR)).alias("is_tool_error"),
        (result & text.matches_any(lowered, V.CODEBASE_ERRORS)).alias("is_codebase_error"),
        (result & has(V.REJECTED_TOOL)).alias("is_rejected"),
    )


FLAGS = [
    "is_user", "is_prefetch", "is_sql_write", "is_other_write", "is_execution", "is_preview",
    "is_database_error", "is_correction", "is_stale", "is_tool_error", "is_codebase_error",
    "is_rejected",
]


def packed_flags(flags: DataFrame) -> DataFrame:
    """All flags as bits of one column: a row that is shuffled one by one stays small."""
    bits = [F.when(F.col(name), F.lit(1 << place)).otherwise(0) for place, name in enumerate(FLAGS)]
    return flags.withColumn("flags", reduce(add, bits)).drop(*FLAGS)


def unpacked_flags(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            name: F.col("flags").bitwiseAND(F.lit(1 << place)) > 0
            for place, name in enumerate(FLAGS)
        }
    ).drop("flags")


def unpack_score(packed: Column) -> Column:
    score = packed.bitwiseAND(2**SCORE_BITS - 1)
    return F.when(score > 0, score - 1).cast("int")


def signal_aggregates() -> list[Column]:
    """All message signals; also usable as a streaming aggregate."""

    def count(flag: str, name: str) -> Column:
        return F.count_if(F.col(flag)).alias(name)

    return [
        count("is_user", "total_user_messages"),
        count("is_prefetch", "prefetch_call_count"),
        F.min(F.when(F.col("is_prefetch"), F.col("position"))).alias("first_prefetch_sequence"),
        count("is_sql_write", "sql_write_count"),
        count("is_other_write", "non_sql_write_count"),
        F.min(F.when(F.col("is_sql_write"), F.col("position"))).alias("first_write_sequence"),
        count("is_execution", "execute_sql_count"),
        count("is_preview", "execute_sql_success_count"),
        count("is_database_error", "permission_error_count"),
        F.count("review").alias("code_review_count"),
        F.min("review").alias("first_review"),
        F.max("review").alias("last_review"),
        count("is_correction", "user_correction_count"),
        count("is_stale", "stale_doc_warning_count"),
        count("is_tool_error", "tool_use_error_count"),
        count("is_codebase_error", "codebase_error_count"),
        count("is_rejected", "user_rejected_tool_count"),
    ]


def derived_signals(aggregated: DataFrame) -> DataFrame:
    """Unpack the review scores and add the differences."""
    first, last = unpack_score(F.col("first_review")), unpack_score(F.col("last_review"))
    return aggregated.withColumns(
        {
            "prefetch_to_write_gap": F.col("first_write_sequence")
            - F.col("first_prefetch_sequence"),
            "code_review_score_first": first,
            "code_review_score_last": last,
            "code_review_score_delta": last - first,
        }
    ).drop("first_review", "last_review")


def copy_keys(rows: DataFrame, changed: str) -> list[Column]:
    """What tells copies of a row apart, as columns of a narrow row."""
    load = [F.col(staging.LOAD)] if staging.LOAD in rows.columns else []
    return [F.col("id"), F.col(changed), *load, staging.tie_hash(rows).alias("_tie")]


def newest_copy(narrow: DataFrame, changed: str) -> DataFrame:
    """One narrow row per id, the copy that staging keeps; no text is shuffled."""
    order = staging.newest_copy_first(narrow, changed, F.col("_tie"))
    return first_by(narrow, ["id"], order)


def message_signals(messages: DataFrame, dedupe: bool = False) -> DataFrame:
    """Message signals per conversation that has messages.

    ``dedupe`` reads raw, possibly repeated rows and counts each id once.
    """
    if dedupe:
        changed = staging.MESSAGE_CHANGE
        narrow = packed_flags(message_flags(messages, copy_keys(messages, changed)))
        flags = unpacked_flags(newest_copy(narrow, changed))
    else:
        flags = message_flags(messages)
    return derived_signals(flags.groupBy("conversation_id").agg(*signal_aggregates()))


def run_costs(runs: DataFrame, dedupe: bool = False) -> DataFrame:
    """Total cost, run count and mean duration per conversation."""
    if dedupe:
        changed = staging.RUN_CHANGE
        keys = copy_keys(runs, changed)
        narrow = runs.select(*keys, "conversation_id", "cost_usd", "duration_ms")
        runs = newest_copy(narrow, changed)
    return runs.groupBy("conversation_id").agg(
        F.sum("cost_usd").alias("total_cost_usd"),
        F.count("*").alias("run_count"),
        F.avg("duration_ms").alias("avg_run_duration_ms"),
    )


COUNTS = [
    "total_user_messages", "prefetch_call_count", "sql_write_count", "non_sql_write_count",
    "execute_sql_count", "execute_sql_success_count", "permission_error_count",
    "code_review_count", "user_correction_count", "stale_doc_warning_count",
    "tool_use_error_count", "codebase_error_count", "user_rejected_tool_count",
]
POSITIONS = [
    "first_prefetch_sequence", "first_write_sequence", "prefetch_to_write_gap",
    "code_review_score_first", "code_review_score_last", "code_review_score_delta",
]


def conversation_signals(
    conversations: DataFrame, messages: DataFrame, runs: DataFrame,
    era_cut: str = V.ERA_CUT, dedupe: bool = False,
) -> DataFrame:
    """The full signal row of every conversation.

    Counts of conversations without messages or runs are 0; positions and
    scores stay NULL. Both aggregates already hash by conversation, so the two
    joins only shuffle the conversations.
    """
    if dedupe:
        conversations = staging.one_per_id(conversations, staging.CONVERSATION_CHANGE)
    base = conversations.select(
        F.col("id").alias("conversation_id"),
        "total_turns",
        "total_duration_ms",
        F.col("learning_extracted_at").isNotNull().alias("learning_extracted"),
        F.col("created_at").alias("conversation_created_at"),
        labels.corpus_era(F.col("created_at"), era_cut).alias("corpus_era"),
    )
    joined = base.join(message_signals(messages, dedupe), "conversation_id", "left").join(
        run_costs(runs, dedupe), "conversation_id", "left"
    )
    return joined.select(
        "conversation_id", "total_turns", "total_duration_ms", "learning_extracted",
        "conversation_created_at", "corpus_era",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in COUNTS],
        *POSITIONS,
        F.coalesce("total_cost_usd", F.lit(0).cast("decimal(20,4)")).alias("total_cost_usd"),
        F.coalesce("run_count", F.lit(0)).alias("run_count"),
        F.coalesce("avg_run_duration_ms", F.lit(0.0)).alias("avg_run_duration_ms"),
    )


def conversation_types(signals: DataFrame) -> DataFrame:
    """Eight flags and one exclusive type per conversation.

    The type sits on the signal row itself, so marts need no self-join.
    """
    flags = labels.type_flags()
    return signals.withColumns({**flags, "conversation_type": labels.conversation_type(flags)})


TYPE_COLUMNS = [
    "conversation_id", "corpus_era", "is_ghost", "is_anomalous", "is_unknown",
    "has_generation_signal", "has_sql_write", "has_non_sql_write", "has_execute_sql",
    "has_user_interrupt", "conversation_type",
]
