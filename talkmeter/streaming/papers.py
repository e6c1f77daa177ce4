"""Continuous ingest of paper files.

The checkpoint remembers which files were read, so a file that arrives late
under an early name is still loaded. Rows carry their file name, and the row of
the greatest (file, line) wins per paper: the table does not depend on the
order in which files arrive, and a repeated batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmeter.operators.latest import first_by
from talkmeter.sources import papers
from talkmeter.streaming.sinks import fold_log, read_log, run_batches, write_batch

LOG_SCHEMA = f"{papers.PAPER_SCHEMA}, split_start bigint, line bigint"


def newest_line() -> list[Column]:
    return [F.desc("s3_key"), F.desc("split_start"), F.desc("line"), F.desc("batch")]


def line_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None,
    pattern: str = "*.jsonl", key: str = "_metadata.file_name",
) -> DataFrame:
    """Lines of the files that keep arriving in a folder, with their file key."""
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select(
        "value",
        F.expr(key).alias("s3_key"),
        F.col("_metadata.file_block_start").alias("split_start"),
    )


def ingest(
    stream: DataFrame, log: str, checkpoint: str, ingested_at: str | Column, once: bool = True
):
    """Parse each micro-batch into its partition of the log."""
    def load(batch: DataFrame, number: int) -> None:
        # Line numbers are only available on the batch frame.
        numbered = batch.withColumn("line", F.monotonically_increasing_id())
        write_batch(papers.parse_lines(numbered, ingested_at), log, number)

    return run_batches(stream, load, checkpoint, "append", once)


def fold(spark: SparkSession, log: str) -> int:
    """Keep the newest line of each paper in place of all old batches."""
    return fold_log(spark, log, ["paper_id"], newest_line(), LOG_SCHEMA)


def current_papers(spark: SparkSession, log: str) -> DataFrame:
    """The papers table as of all loaded batches."""
    rows = read_log(spark, log, LOG_SCHEMA)
    return first_by(rows, ["paper_id"], newest_line()).select(*papers.PAPER_COLUMNS)
