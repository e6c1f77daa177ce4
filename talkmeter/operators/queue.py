"""Which conversations still have to be judged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def judged_ids(ledger: DataFrame, version: str | Column) -> DataFrame:
    """Ids with an error-free row at this version, each once.

    ``distinct`` combines on the map side, so a conversation that fills a third
    of the ledger reaches the anti join as one row per task.
    """
    done = ledger.filter((F.col("prompt_version") == version) & F.col("error").isNull())
    return done.select("conversation_id").distinct()


def judge_queue(
    typed: DataFrame, ledger: DataFrame, types: list[str], version: str | Column,
    ordered: bool = True,
) -> DataFrame:
    """Conversations of the given types without an error-free row at ``version``.

    Rows that ended in an error queue again, and a new version queues
    everything. Unlike ``NOT IN``, a NULL id in the ledger hides nothing.
    """
    queue = (
        typed.filter(F.col("conversation_type").isin(types))
        .select("conversation_id", "conversation_type")
        .join(judged_ids(ledger, version), "conversation_id", "left_anti")
    )
    return queue.orderBy("conversation_id") if ordered else queue


def only_queued(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the queued conversations.

    ``ids`` should be a written table (``written``): Spark then knows its size,
    sends a small queue to the scan, and joins a larger one by key, splitting
    conversations that are much larger than others.
    """
    return rows.join(ids.select("conversation_id"), "conversation_id", "left_semi").select(
        *rows.columns
    )


def written(queue: DataFrame, folder: str) -> DataFrame:
    """The queue as a table in the shared folder.

    Every later step of the batch reads the same queue, also after an executor
    or the driver is lost, and its size is known without computing it again.
    """
    queue.write.mode("errorifexists").parquet(folder)
    return queue.sparkSession.read.schema(queue.schema).parquet(folder)


def patch_queue(typed: DataFrame, ids: DataFrame) -> DataFrame:
    """Exactly the listed conversations, whatever the ledger says."""
    return typed.select("conversation_id", "conversation_type").join(
        ids.select("conversation_id"), "conversation_id", "left_semi"
    )
