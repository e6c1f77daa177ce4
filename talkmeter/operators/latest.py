"""Latest-row, first-row and upsert operators.

All of them keep one row per key with ``row_number() = 1``. Spark prunes such
windows before the shuffle (WindowGroupLimit), so a key that holds a third of
the input still sends at most one row per map task to its reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def newest_first(*names: str) -> list[Column]:
    """Descending order with NULL as the largest value."""
    return [F.col(name).desc_nulls_first() for name in names]


def content_hash(df: DataFrame, skip: tuple[str, ...] = ()) -> Column:
    """Eight bytes that stand for the whole row.

    As the last order key it makes a choice among tied rows repeatable without
    carrying wide text through the sort.
    """
    return F.xxhash64(*[F.col(name) for name in df.columns if name not in skip])


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in the given order."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_by(
    df: DataFrame, keys: list[str], newest: list[str], ties: list[Column] | None = None
) -> DataFrame:
    """The newest row per key; ``ties`` (default: the row hash) settles equals."""
    order = newest_first(*newest) + (ties or [content_hash(df)])
    return first_by(df, keys, order)


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Target after the batch is merged in by key.

    A batch row replaces the target row; among batch rows the last one in
    ``order`` wins, as if they were applied one by one. Columns of ``order``
    that the target lacks are dropped from the result.
    """
    wanted = target.columns
    extra = [name for name in order if name not in wanted]
    old = target.withColumn("_from_batch", F.lit(0))
    new = batch.select(*wanted, *extra).withColumn("_from_batch", F.lit(1))
    both = old.unionByName(new, allowMissingColumns=True)
    ranked = [F.col(name).desc_nulls_last() for name in ["_from_batch", *order]]
    return first_by(both, keys, ranked).select(*wanted)
