"""Tables with one row per key, of which a load rewrites only the parts it touches.

Rows lie in hash buckets of their key, one folder each. A load reads the buckets that its own rows fall
into, keeps the newest row per key, and writes these buckets in one job with dynamic partition
overwrite; other buckets are neither read nor written. The number of buckets is settled by the first
load. One load at a time may write a table; one that dies leaves its input unmarked and is repeated,
which changes nothing that it had written before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmeter.operators.latest import first_by
from talkmeter.session import written
from talkmeter.sources import tables

BUCKET = "_bucket"
FROM_BATCH = "_from_batch"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return tables.read_or_empty(spark, path, f"{schema}, {BUCKET} int")


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table as of its last load; empty before the first."""
    return stored(spark, path, schema).drop(BUCKET)


def settled_buckets(spark: SparkSession, path: str, buckets: int) -> int:
    """The table's number of buckets, which the first load chooses."""
    known = tables.read_mark(spark, f"{path}/_buckets", "number", None)
    if known is None:
        tables.write_mark(spark, f"{path}/_buckets", "number", str(buckets), after=0)
        return buckets
    return int(known)


def rewrite(
    batch: DataFrame, path: str, schema: str, keys: list[str],
    combine: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64,
) -> list[int]:
    """Replace the buckets that the batch's keys fall into by ``combine(stored rows, batch)`` of them.

    Both frames carry ``_bucket``, and so must the result. Returns the buckets that were rewritten.
    """
    spark = batch.sparkSession
    count = settled_buckets(spark, path, buckets)
    new = written(batch.withColumn(BUCKET, bucket_of(keys, count)), "keyed-batch")
    touched = sorted(row[0] for row in new.select(BUCKET).distinct().collect())
    if touched:
        old = stored(spark, path, schema).filter(F.col(BUCKET).isin(touched))
        combine(old, new).select(*old.columns).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(BUCKET).parquet(path)
    return touched


def merge(
    batch: DataFrame, path: str, schema: str, keys: list[str], newest: list[Column],
    buckets: int = 64, batch_wins: bool = True,
) -> list[int]:
    """Merge the batch's rows in by key; returns the buckets that were rewritten.

    Of the rows of one key the first in the order of ``newest`` stays, which may use columns that only
    the batch has; with ``batch_wins`` a row of the batch goes before a stored one.
    """
    order = [F.desc(FROM_BATCH), *newest] if batch_wins else newest

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.withColumn(FROM_BATCH, F.lit(0)).unionByName(
            new.withColumn(FROM_BATCH, F.lit(1)), allowMissingColumns=True
        )
        # Dealt by bucket: the ranking needs no exchange of its own, and a bucket becomes one file.
        return first_by(both.repartition(BUCKET), [BUCKET, *keys], order)

    return rewrite(batch, path, schema, keys, combine, buckets)
