"""Documented but so far uncomputed reports of the chat logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.functions import labels, text
from talkmeter.operators.latest import first_by
from talkmeter.session import written


def last_first() -> list:
    """Order that puts the last message of a conversation first."""
    return [F.col("sequence_number").desc_nulls_last(), F.col("id").desc_nulls_last()]


def final_responses(messages: DataFrame) -> DataFrame:
    """The last ``thinking`` message is what the user received."""
    thinking = messages.filter(F.col("message_type") == "thinking")
    final = first_by(thinking, ["conversation_id"], last_first())
    return final.select("conversation_id", "sequence_number", F.col("content").alias("response"))


def connection_drops(messages: DataFrame) -> DataFrame:
    """Kind of the last message; a last ``user`` message never got an answer."""
    narrow = messages.select("conversation_id", "id", "sequence_number", "message_type")
    last = first_by(narrow, ["conversation_id"], last_first())
    return last.select(
        "conversation_id",
        F.col("message_type").alias("last_kind"),
        (F.col("message_type") == "user").alias("is_dropped"),
    )


def drop_rate_by_period(messages: DataFrame, conversations: DataFrame) -> DataFrame:
    """Share of dropped conversations per month of creation."""
    created = conversations.select(
        F.col("id").alias("conversation_id"),
        F.date_trunc("month", "created_at").cast("timestamp_ntz").alias("period"),
    )
    return (
        connection_drops(messages)
        .join(created, "conversation_id")
        .groupBy("period")
        .agg(
            F.count("*").alias("conversations"),
            F.count_if("is_dropped").alias("dropped"),
            F.avg(F.col("is_dropped").cast("double")).alias("drop_rate"),
        )
    )


def duplicate_user_messages(messages: DataFrame) -> DataFrame:
    """Repeated user texts per conversation, by digest of the text.

    ``is_last`` tells whether a copy ends the conversation.
    """
    ends = messages.groupBy("conversation_id").agg(F.max("sequence_number").alias("last_position"))
    repeated = (
        messages.filter((F.col("message_type") == "user") & F.col("content").isNotNull())
        .groupBy("conversation_id", F.md5("content").alias("content_md5"))
        .agg(F.count("*").alias("copies"), F.max("sequence_number").alias("last_copy"))
        .filter("copies > 1")
    )
    return repeated.join(ends, "conversation_id").select(
        "conversation_id",
        "content_md5",
        "copies",
        (F.col("last_copy") == F.col("last_position")).alias("is_last"),
    )


def paired_executions(messages: DataFrame) -> DataFrame:
    """SQL executions counted once per call, with the fate of their results.

    Calls and results meet by grouping on their shared id instead of a
    self-join: both sides fold before the shuffle and a busy id cannot fan out.
    """
    lowered = F.col("lowered")
    call, result = F.col("message_type") == "tool_call", F.col("message_type") == "tool_result"
    flagged = F.coalesce("is_error", F.lit(False))
    pairs = (
        messages.filter(F.col("tool_use_id").isNotNull())
        .withColumn("lowered", F.lower("content"))
        .select(
            "conversation_id",
            "tool_use_id",
            (call & text.matches(lowered, "%execute_sql%")).alias("executes"),
            (result & text.matches(lowered, V.RESULT_PREVIEW)).alias("succeeded"),
            (result & flagged).alias("tool_failed"),
            (result & ~flagged & text.matches(lowered, V.DATABASE_ERROR)).alias("database_failed"),
            (result & ~flagged & text.matches(lowered, V.EXECUTOR_ERROR)).alias("executor_failed"),
        )
        .groupBy("conversation_id", "tool_use_id")
        .agg(
            *[
                F.coalesce(F.bool_or(name), F.lit(False)).alias(name)
                for name in ("executes", "succeeded", "tool_failed", "database_failed",
                             "executor_failed")
            ]
        )
        .filter("executes")
    )
    return pairs.groupBy("conversation_id").agg(
        F.count("*").alias("executions"),
        F.count_if("succeeded").alias("succeeded"),
        F.count_if("tool_failed").alias("tool_errors"),
        F.count_if("database_failed").alias("database_errors"),
        F.count_if("executor_failed").alias("executor_errors"),
    )


def learning_gate(fact: DataFrame, relevance: DataFrame, least: int = 2) -> DataFrame:
    """Learn only from relevant conversations that succeeded."""
    tier = labels.outcome_tier(F.col("outcome"))
    learn = (F.col("relevance") >= least) & (tier == "success")
    return fact.join(relevance, "conversation_id").select(
        "conversation_id", "outcome", "relevance", learn.alias("learn")
    )


def eval_kinds() -> tuple[Column, Column, Column]:
    """Calls and results with a tool id, and user messages."""
    kind, tool = F.col("message_type"), F.col("tool_use_id").isNotNull()
    return (kind == "tool_call") & tool, (kind == "tool_result") & tool, kind == "user"


def eval_rows(messages: DataFrame) -> DataFrame:
    """The messages that can matter to an eval unit, as flags and positions without text.

    Kinds alone choose the rows, so that a text is searched once; calls of other tools, which carry no
    flag, are left to the readers' filters.
    """
    call, result, user = eval_kinds()
    lowered = F.col("lowered")
    write = (
        text.matches(lowered, V.FILE_WRITE) & text.matches(lowered, V.SQL_FOLDER)
        & ~text.matches(lowered, V.TODO_WRITE)
    )
    flags = {
        "prefetch": call & text.matches(lowered, V.PREFETCH_CALL), "sql_write": call & write,
        "is_result": result, "is_user": user,
    }
    return messages.filter(call | result | user).withColumn("lowered", F.lower("content")).select(
        "conversation_id", "id", "sequence_number", "tool_use_id",
        *[F.coalesce(flag, F.lit(False)).alias(name) for name, flag in flags.items()],
    )


def eval_units(messages: DataFrame) -> DataFrame:
    """Question, retrieved context and answer per conversation.

    Context is the last result of a prefetch call, the question the last user
    message before that call's result, the answer the last result of an SQL
    file write after it. Calls are found by the shared tool id.

    One scan reduces the messages to flags and positions, which are written;
    folds over them find the three messages of each conversation, without text
    (results of calls first, which are written too), and one join by id fetches
    their texts. A conversation with a third of all
    messages is folded before every shuffle, and its texts are three.
    """
    rows = written(eval_rows(messages), "eval-rows")
    # Greater means later; a missing position or id comes first.
    place = F.struct("sequence_number", "id")
    calls = (
        rows.filter("prefetch OR sql_write OR is_result")
        .groupBy("conversation_id", "tool_use_id")
        .agg(
            F.bool_or("prefetch").alias("prefetch"), F.bool_or("sql_write").alias("sql_write"),
            F.max(F.when(F.col("is_result"), place)).alias("last"),
        )
        .filter("last IS NOT NULL")
    )
    found = calls.groupBy("conversation_id").agg(
        F.max(F.when(F.col("prefetch"), F.col("last"))).alias("context"),
        F.max(F.when(F.col("sql_write"), F.col("last"))).alias("answer"),
    ).filter("context IS NOT NULL")
    found = written(found, "eval-calls")
    asked = rows.filter("is_user").join(
        found.select("conversation_id", F.col("context.sequence_number").alias("context_at")),
        "conversation_id",
    )
    questions = asked.filter("sequence_number < context_at").groupBy("conversation_id").agg(
        F.max(place).alias("question")
    )
    after = F.col("answer.sequence_number") > F.col("context.sequence_number")
    picked = found.join(questions, "conversation_id", "left").select(
        "conversation_id",
        F.explode(F.array_compact(F.array(
            *[
                F.when(condition, F.struct(F.lit(part).alias("part"), F.col(f"{part}.id").alias("id")))
                for part, condition in (
                    ("question", F.col("question").isNotNull()), ("context", F.lit(True)),
                    ("answer", after),
                )
            ]
        ))).alias("pick"),
    ).select("conversation_id", "pick.part", "pick.id")
    _, result, user = eval_kinds()
    texts = messages.filter(result | user).select("conversation_id", "id", "content").join(
        picked, ["conversation_id", "id"]
    )
    return texts.groupBy("conversation_id").agg(
        *[
            F.first(F.when(F.col("part") == part, F.col("content")), True).alias(part)
            for part in ("question", "context", "answer")
        ]
    )


def outcome_version_shift(history: DataFrame, before: str, after: str) -> DataFrame:
    """Outcome at one judge version against the outcome at another.

    Both versions fold into one row per conversation; no self-join.
    """
    version = F.col("prompt_version")
    both = (
        history.filter(version.isin(before, after))
        .groupBy("conversation_id")
        .agg(
            F.max(F.when(version == before, F.col("outcome"))).alias("outcome_before"),
            F.max(F.when(version == after, F.col("outcome"))).alias("outcome_after"),
            F.count_if(version == before).alias("in_before"),
            F.count_if(version == after).alias("in_after"),
        )
        .filter("in_before > 0 AND in_after > 0")
    )
    return both.groupBy("outcome_before", "outcome_after").agg(
        F.count("*").alias("conversations")
    )
