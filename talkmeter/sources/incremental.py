"""Incremental loading of conversations, runs and messages.

One mark (the greatest ``updated_at`` loaded so far) drives all three reads. It
is read once, before anything moves it, and written last, after all three
tables have landed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from talkmeter import vocabulary as V
from talkmeter.plans import staging
from talkmeter.sources import tables


def as_mark(mark: str | Column) -> Column:
    return (F.lit(mark) if isinstance(mark, str) else mark).cast("timestamp_ntz")


def changed_since(
    parents: DataFrame, mark: str | Column, ordered: bool = True
) -> DataFrame:
    """Parents updated strictly after the mark, oldest change first.

    Landing needs no order, so loads skip the global sort.
    """
    changed = parents.filter(F.col("updated_at") > as_mark(mark))
    return changed.orderBy("updated_at") if ordered else changed


def touched_ids(parents: DataFrame, mark: str | Column) -> DataFrame:
    changed = changed_since(parents, mark, ordered=False)
    return changed.select(F.col("id").alias("conversation_id"))


def runs_since(runs: DataFrame, parents: DataFrame, mark: str | Column) -> DataFrame:
    """All runs of every touched conversation, old ones included."""
    return runs.join(touched_ids(parents, mark), "conversation_id", "left_semi").select(
        *runs.columns
    )


def messages_since(messages: DataFrame, parents: DataFrame, mark: str | Column) -> DataFrame:
    """All messages of the four kinds of every touched conversation.

    The order by conversation and position holds inside each partition; a
    parallel append needs no global sort.
    """
    wanted = messages.filter(F.col("message_type").isin(V.MESSAGE_KINDS))
    return (
        wanted.join(touched_ids(parents, mark), "conversation_id", "left_semi")
        .select(*messages.columns)
        .sortWithinPartitions("conversation_id", "sequence_number")
    )


def next_mark(rows: DataFrame, mark: str | Column, column: str = "updated_at") -> DataFrame:
    """One row: the greatest value loaded, or the old mark when nothing came."""
    return rows.agg(F.coalesce(F.max(column), as_mark(mark)).alias("mark"))


def key_range(spark_rows: DataFrame, key: str) -> tuple[int, int] | None:
    least, most = spark_rows.agg(F.min(key), F.max(key)).first()
    return None if least is None else (int(least), int(most))


def row_sums(rows: DataFrame, key: str, low: int, width: int) -> DataFrame:
    """Rows and the sum of their hashes per key range: equal for equal rows in any order."""
    at = F.floor((F.col(key).cast("long") - low) / width)
    return rows.groupBy(at.alias("range")).agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(*rows.columns).cast("decimal(20,0)")).alias("sum")
    )


def rows_behind_mark(
    source: DataFrame, landed: DataFrame, key: str = "id", pieces: int = 1000
) -> DataFrame:
    """Source rows that no load has brought: committed late under an old ``updated_at``, or changed
    without moving it.

    ``landed`` is the landing's newest copy per key, as text (``newest_landed``). Both sides are summed
    by hash over at most ``pieces`` ranges of the key; only ranges whose sums differ are read again, and
    of these the rows that landing doesn't have in this form come out, to be landed as a load of
    their own. Rows that the source has deleted stay landed.
    """
    text = all_text(source)
    landed = landed.select(text.columns)
    bounds = key_range(source, key)
    if bounds is None:
        return source
    low, width = bounds[0], max(1, -(-(bounds[1] - bounds[0] + 1) // pieces))
    ours, theirs = (row_sums(rows, key, low, width).alias(side) for rows, side in (
        (text, "ours"), (landed, "theirs")
    ))
    same = F.col("ours.n").eqNullSafe(F.col("theirs.n")) & F.col("ours.sum").eqNullSafe(F.col("theirs.sum"))
    # At most ``pieces`` numbers, which become a filter that reaches the scans.
    differ = [
        row["range"] for row in ours.join(theirs, "range", "left").filter(~same).select("range").collect()
        if row["range"] is not None
    ]
    runs: list[list[int]] = []
    for number in sorted(differ):
        if runs and runs[-1][1] == number - 1:
            runs[-1][1] = number
        else:
            runs.append([number, number])
    inside = reduce(or_, [
        F.col(key).cast("long").between(low + a * width, low + (b + 1) * width - 1) for a, b in runs
    ], F.lit(False))
    mark = F.xxhash64(*[F.col(name).cast("string") for name in source.columns])
    known = landed.filter(inside).select(
        F.col(key).cast("long").alias("_key"), F.xxhash64(*text.columns).alias("_mark")
    )
    rows = source.filter(inside)
    return rows.join(known, (F.col(key).cast("long") == F.col("_key")) & (mark == F.col("_mark")), "left_anti")


def newest_landed(raw: DataFrame, changed: str) -> DataFrame:
    """The landing's newest copy per id, still as text."""
    return staging.one_per_id(raw, changed)


def all_text(df: DataFrame) -> DataFrame:
    """Landing form: every column as a string."""
    return df.select([F.col(name).cast("string").alias(name) for name in df.columns])


def land(df: DataFrame, path: str, load: int | None = None) -> None:
    """Append the rows as text; ``load`` numbers them, so that later copies can be told."""
    rows = all_text(df)
    if load is not None:
        rows = rows.withColumn("_load", F.lit(load).cast("bigint"))
    rows.write.mode("append").parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int],
    partitions: int, **options: str,
) -> DataFrame:
    """A source table read in parallel key ranges; filters on it are pushed down."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=partitions, properties=options,
    )


@dataclass
class LoadPaths:
    """Where one load reads its mark and appends its rows."""

    marks: str
    conversations: str
    runs: str
    messages: str


def load_changes(
    spark: SparkSession, conversations: DataFrame, runs: DataFrame, messages: DataFrame,
    paths: LoadPaths, name: str = "conversations",
) -> str:
    """One incremental load; returns the new mark.

    The new mark is observed on the very rows that land: a second read of a
    live source could see newer changes and step over them. If the load dies
    half way the mark has not moved, so the next load repeats the rows; staging
    keeps one row per id, that of the last load, which makes the repeat harmless.
    The load number is taken before anything lands: a repeated load has its own.
    """
    step, mark = tables.read_step(spark, paths.marks, name, V.FIRST_MARK)
    load = tables.take_number(spark, paths.marks, f"{name}-load")
    landed = Observation()
    changed = changed_since(conversations, mark, ordered=False).observe(
        landed, F.max("updated_at").cast("string").alias("newest")
    )
    land(changed, paths.conversations, load)
    land(runs_since(runs, conversations, mark), paths.runs, load)
    land(messages_since(messages, conversations, mark), paths.messages, load)
    new = landed.get["newest"]
    if new is None:
        return mark
    tables.write_mark(spark, paths.marks, name, new, after=step)
    return new
