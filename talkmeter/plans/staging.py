"""Staging: landed strings to typed rows, one per id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmeter.functions.casting import cast_as
from talkmeter.operators.latest import content_hash, first_by

# Column name to cast kind (fixed values, in table order).
CONVERSATIONS = {
    "id": "long",
    "user_id": "long",
    "conversation_uuid": "text",
    "sdk_session_id": "text",
    "title": "text",
    "is_active": "bool",
    "message_count": "int",
    "total_runs": "int",
    "total_turns": "int",
    "total_cost_usd": "money",
    "total_duration_ms": "long",
    "last_message_at": "time",
    "last_run_at": "time",
    "learning_extraction_status": "text",
    "learning_extracted_at": "time",
    "summary": "text",
    "created_at": "time",
    "updated_at": "time",
}
RUNS = {
    "id": "long",
    "conversation_id": "long",
    "user_message_id": "long",
    "num_turns": "int",
    "duration_ms": "long",
    "cost_usd": "money",
    "sdk_session_id": "text",
    "started_at": "time",
    "completed_at": "time",
}
MESSAGES = {
    "id": "long",
    "conversation_id": "long",
    "message_type": "text",
    "content": "text",
    "message_metadata": "text",
    "tool_use_id": "text",
    "is_error": "bool",
    "sequence_number": "int",
    "created_at": "time",
}
# The number of the load that landed a row: it tells which copy is the newest.
LOAD = "_load"
# Where a row has no load number, or several copies have the same, this column does.
CONVERSATION_CHANGE = "updated_at"
RUN_CHANGE = "completed_at"
MESSAGE_CHANGE = "created_at"


def typed(raw: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast every column; columns the source lacks come out as NULL.

    The load number stays, if there is one: ``one_per_id`` uses it and drops it.
    """
    present = set(raw.columns)
    load = [F.col(LOAD).cast("bigint").alias(LOAD)] if LOAD in present else []
    return raw.select(
        [
            cast_as(name, kind) if name in present else F.lit(None).cast("string").alias(name)
            for name, kind in kinds.items()
        ]
        + load
    )


def tie_hash(rows: DataFrame) -> Column:
    """What settles copies of one load with equal change times: the content of the row."""
    return content_hash(rows, (LOAD,))


def newest_copy_first(rows: DataFrame, changed: str, tie: Column) -> list[Column]:
    """Order that puts the copy to keep first: last load, then last change.

    A missing change time is the oldest: a run lands without an end and again with one.
    """
    load = [F.col(LOAD).desc_nulls_last()] if LOAD in rows.columns else []
    return [*load, F.col(changed).desc_nulls_last(), tie]


def one_per_id(rows: DataFrame, changed: str) -> DataFrame:
    """Raw tables repeat every row of a touched conversation; keep the newest."""
    return first_by(rows, ["id"], newest_copy_first(rows, changed, tie_hash(rows))).drop(LOAD)


def stg_conversations(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    rows = typed(raw, CONVERSATIONS)
    return one_per_id(rows, CONVERSATION_CHANGE) if dedupe else rows.drop(LOAD)


def stg_runs(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    rows = typed(raw, RUNS)
    return one_per_id(rows, RUN_CHANGE) if dedupe else rows.drop(LOAD)


def stg_messages(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    rows = typed(raw, MESSAGES)
    return one_per_id(rows, MESSAGE_CHANGE) if dedupe else rows.drop(LOAD)


def stg_papers(papers: DataFrame, now: str | Column) -> DataFrame:
    moment = F.lit(now) if isinstance(now, str) else now
    return papers.select(
        "paper_id", "arxiv_url", "title", "abstract", "authors", "categories",
        F.col("published_date").cast("timestamp_ntz").alias("published_date"),
        F.coalesce(F.col("ingested_at").cast("timestamp_ntz"), moment.cast("timestamp_ntz"))
        .alias("ingested_date"),
    )
