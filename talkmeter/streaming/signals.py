"""Message signals kept up to date while messages arrive.

The stream only turns messages into narrow rows of flags and appends them: no state, no watermark, so
no message is ever late and an edited copy is a row like any other. Readers fold the flags, of each
message the copy that the batch form keeps: that of the last load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from talkmeter.plans import signals, staging
from talkmeter.streaming import sinks


def flag_rows(messages: DataFrame) -> DataFrame:
    """One packed row per landed copy of a message, with what tells the copies apart."""
    keys = signals.copy_keys(messages, staging.MESSAGE_CHANGE)
    return signals.packed_flags(signals.message_flags(messages, keys))


def follow(messages: DataFrame, log: str, checkpoint: str, once: bool = True):
    """Append the flags of a stream of messages; files that were read before are not read again."""
    return sinks.run_change_log(flag_rows(messages), log, checkpoint, "append", once)


def current_signals(flags: DataFrame) -> DataFrame:
    """Signals per conversation as of all rows that have arrived."""
    newest = signals.newest_copy(flags, staging.MESSAGE_CHANGE)
    rows = signals.unpacked_flags(newest)
    return signals.derived_signals(
        rows.groupBy("conversation_id").agg(*signals.signal_aggregates())
    )


def fold(spark: SparkSession, log: str, schema: StructType) -> int:
    """Keep one row per message, the copy that counts, in place of all old batches."""
    rows = sinks.read_log(spark, log, schema)
    order = staging.newest_copy_first(rows, staging.MESSAGE_CHANGE, F.col("_tie"))
    return sinks.fold_log(spark, log, ["id"], order, schema)
