"""Line deduplication against levelled sorted runs of line hashes.

A key is a line without white space at its ends, A-Z in lower case. Every batch of documents is
folded to (key hash, number of documents) before anything is shuffled, anti-joined with the keys
that are already settled as common, and added as a sorted run; runs of one level are merged into
one run of the next. Runs are bucketed and sorted by hash, so these joins and merges move only the
new batch.

Defined results: a null or empty text is one empty line; empty keys are never common; each row counts
as a document, repeated rows too; a null id is an id like any other; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmeter.llm.common import (
    LOWER, ROW, UPPER, WHITE, packed, staged, tasks, text_of, wide_hash,
)
from talkmeter.session import new_run_folder

HASH = ["h1", "h2"]
MARK = ["t1", "t2"]


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def hashed_keys(docs: DataFrame) -> DataFrame:
    """A row per document and distinct nonempty key: (id, t1, t2, h1, h2).

    t1, t2 hash the text: rows with one id and different texts stay apart, and rows that are equal
    get equal results.
    """
    text = text_of(docs)
    mark = wide_hash(text)
    keys = docs.select(
        docs["doc_id"].alias("id"), mark[0].alias("t1"), mark[1].alias("t2"),
        F.explode(F.array_distinct(F.transform(lines_of(text), line_key))).alias("key"),
    ).filter(F.col("key") != "")
    hashes = wide_hash(F.col("key"))
    return keys.select("id", "t1", "t2", hashes[0].alias("h1"), hashes[1].alias("h2"))


class LineRuns:
    """Levels of runs (h1, h2, n), n the documents of a key, as bucketed tables in the shared folder.

    ``settled`` keys have reached ``enough`` documents; they are kept in a run list of their own and
    need no more counting.
    """

    def __init__(self, spark: SparkSession, enough: int, fanout: int = 4):
        self.spark, self.enough, self.fanout = spark, enough, fanout
        self.buckets = tasks(spark)
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def _write(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, *HASH)
            .write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
            .option("path", new_run_folder(self.spark, "line-run")).saveAsTable(name)
        )
        return self.spark.table(name)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """Equally bucketed and sorted runs meet in merge joins, with no shuffle."""

        def merge(one: DataFrame, two: DataFrame) -> DataFrame:
            both = one.join(two.withColumnRenamed("n", "n2"), HASH, "full_outer")
            total = F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))
            return both.select(*HASH, total.alias("n"))

        return reduce(merge, runs)

    def unseen(self, keys: DataFrame) -> DataFrame:
        """Rows whose key no run holds yet."""
        for run in [*self.settled, *(run for level in self.levels for run in level)]:
            keys = keys.join(run, HASH, "left_anti")
        return keys

    def add(self, counts: DataFrame) -> None:
        """Takes a batch of (h1, h2, n)."""
        for run in self.settled:
            counts = counts.join(run, HASH, "left_anti")
        self._place(self._write(counts), 0)

    def _place(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = staged(self._merged(self.levels[level]), "line-merge")
            self.levels[level] = []
            self.settled.append(self._write(merged.filter(F.col("n") >= self.enough)))
            self._place(self._write(merged.filter(F.col("n") < self.enough)), level + 1)

    def common(self) -> DataFrame:
        """The keys (h1, h2) with at least ``enough`` documents over all runs; some come twice."""
        open_runs = [run for level in self.levels for run in level]
        parts = [run.select(*HASH) for run in self.settled]
        if open_runs:
            late = self._merged(open_runs).filter(F.col("n") >= self.enough)
            parts.append(late.select(*HASH))
        return reduce(DataFrame.unionByName, parts)


def common_line_hits(docs: DataFrame, min_docs: int, batches: int, fanout: int) -> DataFrame:
    """(id, t1, t2, common): the hashes of each document's common lines."""
    spark = docs.sparkSession
    batch = F.pmod(F.col("t1"), F.lit(batches))
    path = new_run_folder(spark, "line-keys")
    keyed = hashed_keys(docs).withColumn("batch", batch.cast("int"))
    keyed.write.partitionBy("batch").parquet(path)
    keys = spark.read.schema(keyed.schema).parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    for number in range(batches):
        one = keys.filter(F.col("batch") == number)
        runs.add(one.groupBy(*HASH).agg(F.count("*").alias("n")))
    common = staged(runs.common(), "common-lines")
    hits = keys.select("id", *MARK, *HASH).join(common, HASH, "left_semi")
    return hits.groupBy("id", *MARK).agg(F.collect_set("h1").alias("c1"), F.collect_set("h2").alias("c2"))


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, batches: int = 4, fanout: int = 2
) -> DataFrame:
    """``__row`` (the input row), ``kept`` text, ``n_lines`` and ``n_dropped`` per input row."""
    hits = common_line_hits(docs, min_docs, batches, fanout)
    text = text_of(docs)
    mark = wide_hash(text)
    rows = docs.select(packed(docs).alias(ROW), text.alias("text"), docs["doc_id"].alias("row_id"),
                       mark[0].alias("m1"), mark[1].alias("m2"))
    same = (
        F.col("row_id").eqNullSafe(F.col("id")) & (F.col("m1") == F.col("t1"))
        & (F.col("m2") == F.col("t2"))
    )

    def stays(line: Column) -> Column:
        key = line_key(line)
        hashes = wide_hash(key)
        return (key == "") | ~(
            F.array_contains("c1", hashes[0]) & F.array_contains("c2", hashes[1])
        )

    lines = lines_of(F.col("text"))
    kept = F.when(F.col("c1").isNull(), lines).otherwise(F.filter(lines, stays))
    return (
        rows.join(hits, same, "left")
        .select(ROW, F.size(lines).cast("long").alias("n_lines"), kept.alias("kept_lines"))
        .select(
            ROW, "n_lines", F.array_join("kept_lines", "\n").alias("kept"),
            (F.col("n_lines") - F.size("kept_lines")).alias("n_dropped"),
        )
    )
