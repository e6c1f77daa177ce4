"""Streaming sinks that survive restarts, on Spark's own means.

Results go to a log partitioned by micro-batch: a batch overwrites its own partition (dynamic partition
overwrite), so a batch that is run again changes nothing, and readers take the newest row per key. ``fold_log`` is a plain batch job that replaces old partitions by their newest rows.

A drain (``once``) takes what is there as one batch unless ``files_per_batch`` says otherwise: rows of a
table that isn't stored by event time are then not late, whatever its files. Should the watermark drop
rows all the same, the drain fails and tells how many.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from talkmeter.operators.latest import first_by
from talkmeter.session import written
from talkmeter.sources import files, tables

BATCH = "batch"
REPORTS = "spark.sql.streaming.numRecentProgressUpdates"


class LateRows(RuntimeError):
    """Raised when a drain's watermark dropped rows, which are then in no result."""


def read_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def finished(query: StreamingQuery, allow_late: bool) -> list:
    """The progress reports of a drain, once it has ended and no row of it was late."""
    query.awaitTermination()
    reports = query.recentProgress
    late = sum(
        state["numRowsDroppedByWatermark"] for step in reports for state in step["stateOperators"]
    )
    if late and not allow_late:
        raise LateRows(f"{late} rows came after the watermark had passed them")
    return reports


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str = "update", once: bool = True, allow_late: bool = False,
) -> list | StreamingQuery:
    """Run ``handle`` per micro-batch; ``once`` drains what is there and returns its reports.

    Otherwise the running query is returned, whose reports Spark sends to its listeners.
    """
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
    )
    if not once:
        return writer.start()
    # All reports of a drain are needed to count late rows; Spark keeps a hundred by default.
    stream.sparkSession.conf.set(REPORTS, 1_000_000)
    return finished(writer.trigger(availableNow=True).start(), allow_late)


def write_batch(batch: DataFrame, log: str, number: int) -> None:
    """The batch's partition of the log, in place of what an earlier attempt has written."""
    batch.withColumn(BATCH, F.lit(number).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(BATCH).parquet(log)


def run_change_log(
    stream: DataFrame, log: str, checkpoint: str, mode: str = "update", once: bool = True,
    allow_late: bool = False,
) -> list | StreamingQuery:
    return run_batches(
        stream, lambda batch, number: write_batch(batch, log, number), checkpoint, mode, once, allow_late
    )


def read_log(spark: SparkSession, log: str, schema: StructType | str) -> DataFrame:
    """All rows of a log with their ``batch``; empty before the first."""
    if isinstance(schema, str):
        whole = f"{schema}, {BATCH} bigint"
    else:
        whole = StructType([*schema.fields, StructField(BATCH, LongType())])
    return tables.read_or_empty(spark, log, whole)


def read_change_log(
    spark: SparkSession, log: str, keys: list[str], schema: StructType
) -> DataFrame:
    """Newest row per key of a change log."""
    return first_by(read_log(spark, log, schema), keys, [F.desc(BATCH)]).select(*schema.names)


def fold_log(
    spark: SparkSession, log: str, keys: list[str], newest: list[Column], schema: StructType | str
) -> int:
    """Fold all batches but the last into one; returns its number, -1 where there was nothing to do.

    The last batch may still be run again, those before it never are. The newest row per key, by
    ``newest``, becomes the partition of the last folded batch and the older partitions are deleted; a
    job that dies between leaves rows that readers count as older copies. For times without readers.
    """
    rows = read_log(spark, log, schema)
    numbers = sorted(row[0] for row in rows.select(BATCH).distinct().collect())[:-1]
    if len(numbers) < 2:
        return -1
    upto = numbers[-1]
    kept = first_by(rows.filter(F.col(BATCH) <= upto), keys, newest)
    write_batch(written(kept, "folded-log"), log, upto)
    for number in numbers[:-1]:
        files.delete(spark, f"{log}/{BATCH}={number}")
    return upto
