"""Exact top-k by inner product with a vector-approximation file.

Components become integers floor(scale * x). The file holds each vector's cells, one byte a component:
component d falls into one of 2^bits cells of equally many integers between the least and the greatest value
of d over all vectors. It is written once, in blocks of cells; exact vectors stay where they are. Where no
component takes more than 2^bits values, cells are exact.

1. Vectors that come more than once are in the file once (``copies``); their rows are put in at the end.
2. The file is scanned once for each sheet of queries. A score lies within ``slack`` of that of the cells'
   middles, the same for all vectors of a query, so a task passes on the vectors whose middle score is
   within two slacks of the k-th best it knows of at its end: nothing else of its blocks can be an answer.
3. Over all tasks the k-th best lower bound is found per query, and the vectors whose upper bound
   doesn't reach it fall away.
4. Exact vectors are read for what is left, in the order of the bounds: the k best by bound first, then
   those whose upper bound reaches the k-th exact score. Then the k-th result is certain.

All queries meet all vectors, which is quadratic work; nothing else is. Blocks and sheets have a fixed number
of rows. One sheet at a time is broadcast (``TOGETHER`` blocks of queries, at most 4 MB at 64 components) and
nothing is shuffled to make pairs. What leaves a task are the bounds near its k best per query, and the file lies
in a number of parts that depends on the cluster alone.

Defined results: vectors null or with null, NaN or infinite components take no part; shorter vectors
count as padded with zeros; every row that ``asks`` is a query of its own, also where ids repeat, and
every other row is a candidate, also under the same id; a null id is a candidate that loses ties, and a
query only if ``asks`` says so; components and scores beyond 64 bits count as the nearest 64-bit number; no
valid vector, no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmeter.llm.common import staged, wide_hash
from talkmeter.llm.sieve import Sieve
from talkmeter.llm.vector_codes import MOST, exact, filled, narrowest
from talkmeter.session import new_run_folder

BOUNDS = "query long, row long, middle double, slack double"
TOGETHER = 16  # blocks of queries that are broadcast at once
FOLD = 128  # columns that a block's scores are folded to, to find its best ones
HELD = 1 << 20  # bounds that a task holds back at most, but for those of one more block


def whole_vectors(rows: DataFrame, asks: Column, scale: int) -> DataFrame:
    """(row, vec_id, asks, v array<long>, one, two) of the vectors that take part; written, so rows stay numbered.

    ``one`` and ``two`` stand for the vector.
    """
    x = F.col("embedding")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    one, two = wide_hash(F.col("v"))
    return staged(
        rows.filter(x.isNotNull() & fit).select(
            F.monotonically_increasing_id().alias("row"), "vec_id",
            F.coalesce(asks, F.lit(False)).alias("asks"),
            F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"),
        ).withColumns({"one": one, "two": two}),
        "vectors",
    )


def cell_edges(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest component per dimension: two numbers each, whatever the row count.

    Vectors without components count as one zero.
    """

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy()
            if len(sizes):
                own = filled(batch.column("v"), max(1, sizes.max()))
                edges = [[0, *edge] for edge in (own.min(axis=0), own.max(axis=0))]
                columns = [np.arange(-1, own.shape[1]), *edges, np.full(own.shape[1] + 1, sizes.min())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["d", "least", "most", "shortest"]
                )

    found = (
        vectors.select("v").mapInArrow(visit, "d long, least long, most long, shortest long")
        .groupBy("d").agg(*[f(c).alias(c) for f, c in ((F.min, "least"), (F.max, "most"), (F.min, "shortest"))])
        .collect()
    )
    found.sort(key=lambda r: r.d)
    least, most = (np.array([r[i] for r in found[1:]], dtype=np.int64) for i in (1, 2))
    padded = found and found[0].shortest < len(least)
    return (np.minimum(least, 0), np.maximum(most, 0)) if padded else (least, most)


class Cells:
    """The geometry of the cells: their first middles and widths, per dimension."""

    def __init__(self, least: np.ndarray, most: np.ndarray, bits: int):
        self.least, self.count = least.astype(np.float64), 1 << bits
        self.width = np.maximum(np.ceil((most.astype(np.float64) - self.least + 1) / self.count), 1)
        self.first = self.least + (self.width - 1) / 2

    def of(self, values: np.ndarray) -> np.ndarray:
        cells = np.floor((values.astype(np.float64) - self.least) / self.width)
        return np.clip(cells, 0, self.count - 1).astype(np.uint8)

    def weights(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(weights, base, unit, slack) of queries: base + unit * (weights @ cells) is their middle score.

        The true score is within the slack. A component may lie a rounding error outside its cell, and sums
        round; sums of whole numbers that single and double precision hold don't.
        """
        asked = queries.astype(np.float64)
        weights = asked * self.width
        unit = np.exp2(np.ceil(np.log2(np.maximum(np.abs(weights).max(axis=1), 1))))
        reach = np.abs(self.first) + self.count * self.width
        far, summed = np.abs(asked) @ reach, np.abs(weights).sum(axis=1) * self.count
        slack = np.abs(asked) @ ((self.width - 1) / 2)
        slack += np.where(far < 2**50, 0, far * 1e-12 + 1)
        slack += np.where(summed < 2**24, 0, summed * (len(self.width) + 4) * 2.0**-23)
        return (weights / unit[:, None]).astype(np.float32), asked @ self.first, unit, slack

    def scores(self, queries: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(middle scores of all pairs, slack per query)"""
        weights, base, unit, slack = self.weights(queries)
        return middles(weights @ cells.astype(np.float32).T, base[:, None], unit[:, None]), slack


def middles(sums: np.ndarray, base: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Scores stop at 64 bits, and so do these: it brings no two of them farther apart."""
    return np.clip(base + unit * sums, -float(MOST), float(MOST))


def cell_file(vectors: DataFrame, cells: Cells, block: int) -> DataFrame:
    """(rows, cells) per block of cells, in flat pieces of bytes: one byte per component, written.

    In a few equal parts per core, so that all cores are busy until a scan ends.
    """
    dims = len(cells.first)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found = batch.column("row").to_numpy(), cells.of(filled(batch.column("v"), dims))
            starts = range(0, len(row), block)
            pieces = [[part[at : at + block].tobytes() for at in starts] for part in (row, found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.binary()) for p in pieces], names=["rows", "cells"]
            )

    found = vectors.select("row", "v").mapInArrow(visit, "rows binary, cells binary")
    return staged(found.repartition(4 * vectors.sparkSession.sparkContext.defaultParallelism), "cell-file")


def query_sheets(vectors: DataFrame, dims: int, sheets: int) -> DataFrame:
    """(sheet, rows, kind, flat): the vectors that ask, dealt to sheets, in flat pieces of bytes; written."""

    def pack(found: pa.Table) -> pa.Table:
        found = found.combine_chunks()
        flat = narrowest(filled(found.column("v").chunk(0), dims))
        return pa.table({
            "sheet": found.column("sheet").slice(0, 1),
            "rows": pa.array([found.column("row").to_numpy().tobytes()], pa.binary()),
            "kind": [flat.dtype.char], "flat": pa.array([flat.tobytes()], pa.binary()),
        })

    sheet = F.pmod(F.xxhash64("row"), F.lit(sheets)).cast("int").alias("sheet")
    return staged(
        vectors.filter("asks").select(sheet, "row", "v").groupBy("sheet")
        .applyInArrow(pack, "sheet int, rows binary, kind string, flat binary"),
        "query-sheets",
    )


class NearBest:
    """What the blocks of cells that a task has met hold for a sheet of queries."""

    def __init__(self, rows: np.ndarray, queries: np.ndarray, cells: Cells, k: int):
        self.rows, self.k = rows, k
        self.weights, self.base, self.unit, self.slack = cells.weights(queries)
        self.best = np.full((len(rows), k), -np.inf)  # middle scores of k vectors
        self.least = np.full(len(rows), -np.inf)  # middle scores from here on are passed on
        self.held, self.n, self.room = [], 0, np.empty(0, dtype=np.float32)

    def meet(self, rows: np.ndarray, cells: np.ndarray, query_block: int) -> Iterator[pa.RecordBatch]:
        """Takes in a block; gives bounds where more than ``HELD`` would be held back."""
        cells = np.ascontiguousarray(cells.astype(np.float32).T)
        whole = len(rows) - len(rows) % FOLD
        for at in range(0, len(self.rows), query_block):
            own = slice(at, at + query_block)
            weights = self.weights[own]
            size = len(weights) * len(rows)
            if len(self.room) < size:  # the same room for all products, without fresh pages
                self.room = np.empty(size, dtype=np.float32)
            sums = np.matmul(weights, cells, out=self.room[:size].reshape(-1, len(rows)))
            folds = sums[:, :whole].reshape(len(sums), -1, FOLD)
            # The greatest of every FOLD-th column each, and the odd columns at the end: all different vectors.
            most = np.concatenate([folds.max(axis=1, initial=-np.inf), sums[:, whole:]], axis=1)
            base, unit = self.base[own], self.unit[own]
            hot = np.flatnonzero(middles(most.max(axis=1), base, unit) >= self.least[own])
            if not len(hot):
                continue
            base, unit, most, q = base[hot, None], unit[hot, None], most[hot], hot + at
            known = np.concatenate([self.best[q], middles(most, base, unit)], axis=1)
            self.best[q] = np.partition(known, -self.k, axis=1)[:, -self.k :]
            least = self.best[q].min(axis=1) - 2 * self.slack[q]
            self.least[q] = np.where(least <= -float(MOST), -np.inf, least)
            # Single precision may round a limit up, so the next number below it is taken.
            limit = np.nextafter(((self.least[q, None] - base) / unit).astype(np.float32), np.float32(-np.inf))
            i, f = np.nonzero(most >= limit)
            odd = f >= FOLD
            self._hold(q, rows, i[odd], whole + f[odd] - FOLD, most[i[odd], f[odd]], base, unit)
            i, f = i[~odd], f[~odd]
            found = folds[hot[i], :, f]
            n, j = np.nonzero(found >= limit[i])
            self._hold(q, rows, i[n], j * FOLD + f[n], found[n, j], base, unit)
            if self.n > HELD:
                yield self.bounds()

    def _hold(self, q, rows, i, column, sums, base, unit) -> None:
        self.held.append((q[i], rows[column], middles(sums, base[i, 0], unit[i, 0])))
        self.n += len(i)

    def bounds(self) -> pa.RecordBatch:
        """``BOUNDS`` of what is held back and still good enough; nothing is held back then."""
        q, row, middle = (np.concatenate(part) for part in zip(*self.held))
        good = np.flatnonzero(middle >= self.least[q])
        self.held, self.n = [], 0
        q = q[good]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.rows[q], row[good], middle[good], self.slack[q])],
            names=["query", "row", "middle", "slack"],
        )


def scanned(
    vectors: DataFrame, cells: Cells, k: int, query_block: int, vector_block: int
) -> DataFrame:
    """``BOUNDS`` of every query: all that the tasks have passed on of their blocks of cells, written."""
    spark, dims = vectors.sparkSession, len(cells.first)
    asking = vectors.filter("asks").count()
    sheets = -(-asking // (query_block * TOGETHER))
    asked = query_sheets(vectors, dims, sheets) if sheets else None
    file = cell_file(vectors, cells, vector_block)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = None
        for batch in batches:
            for i in range(len(batch)):
                held, found, rows, kind, flat = (
                    batch.column(c)[i] for c in ("own", "cells", "rows", "kind", "flat")
                )
                if near is None:
                    queries = np.frombuffer(flat.as_buffer(), dtype=kind.as_py()).reshape(-1, dims)
                    near = NearBest(np.frombuffer(rows.as_py(), dtype=np.int64), queries, cells, k)
                own = np.frombuffer(held.as_buffer(), dtype=np.int64)
                met = np.frombuffer(found.as_buffer(), dtype=np.uint8).reshape(-1, dims)
                yield from near.meet(own, met, query_block)
        if near is not None and near.n:
            yield near.bounds()

    blocks = file.withColumnRenamed("rows", "own")
    path = new_run_folder(spark, "bounds")
    for sheet in range(sheets):  # each scans the whole file
        one = asked.filter(F.col("sheet") == sheet).drop("sheet")
        blocks.crossJoin(F.broadcast(one)).mapInArrow(visit, BOUNDS).write.mode("append").parquet(path)
    return spark.read.schema(BOUNDS).parquet(path) if sheets else spark.createDataFrame([], BOUNDS)


def candidates(bounds: DataFrame, k: int) -> DataFrame:
    """(query, row, middle, slack, place): what can be an answer, by all tasks' lower bounds."""
    order = Window.partitionBy("query").orderBy(F.desc("middle"), "row")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    reaches = F.col("kth").isNull() | (F.col("middle") >= F.col("kth") - 2 * F.col("slack"))
    return staged(
        bounds.withColumns({"place": F.row_number().over(order), "kth": F.nth_value("middle", k).over(whole)})
        .filter(reaches).drop("kth"),
        "candidates",
    )


def exact_scores(wanted: DataFrame, vectors: DataFrame, near: DataFrame, dims: int) -> DataFrame:
    """(query, row, vec_id, score) of the pairs: here exact vectors are read, those of rows from ``near``."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            both = exact(np.concatenate([filled(batch.column(c), dims) for c in ("a", "b")]))
            score = np.clip((both[:n] * both[n:]).sum(axis=1), -MOST - 1, MOST).astype(np.int64)
            kept = [batch.column(c) for c in ("query", "row", "vec_id")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(score)], names=["query", "row", "vec_id", "score"]
            )

    asked = vectors.filter("asks").select(F.col("row").alias("query"), F.col("v").alias("a"))
    rows = near.select("row", "vec_id", F.col("v").alias("b"))
    return wanted.select("query", "row").join(rows, "row").join(asked, "query").mapInArrow(
        visit, "query long, row long, vec_id long, score long"
    )


def copies(vectors: DataFrame) -> DataFrame:
    """(first, row, vec_id, asks) of the rows whose vector comes more than once, written.

    ``first`` is the row that stands for them, one that asks if any does.
    """
    asking = F.min(F.when(F.col("asks"), F.col("row")))
    repeated = staged(
        vectors.groupBy("one", "two").agg(
            F.count("*").alias("n"), F.coalesce(asking, F.min("row")).alias("first")
        ).filter("n > 1").drop("n"),
        "repeated",
    )
    return staged(vectors.join(repeated, ["one", "two"]).select("first", "row", "vec_id", "asks"), "copies")


def nearest(
    vectors: DataFrame, asks: Column, k: int = 5, scale: int = 256, bits: int = 8,
    query_block: int = 512, vector_block: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products, ties to the smaller id.

    ``vectors`` has vec_id and embedding; the rows for which ``asks`` holds are the queries.
    """
    valid = whole_vectors(vectors, asks, scale)
    least, most = cell_edges(valid)
    cells, most_wanted = Cells(least, most, bits), k + 1  # one may be the query's own row
    again = copies(valid)
    stand_ins = valid.join(again.filter("row <> first").select("row"), "row", "left_anti")
    found = candidates(scanned(stand_ins, cells, most_wanted, query_block, vector_block), most_wanted)
    near = Sieve(found, ["row"]).passing(valid, F.col("row"))
    first = staged(
        exact_scores(found.filter(F.col("place") <= most_wanted), valid, near, len(least)), "first-reads"
    )
    certain = first.groupBy(F.col("query").alias("its_query")).agg(
        F.min("score").alias("kth"), F.count("*").alias("n")
    ).filter(F.col("n") == most_wanted)
    rest = found.filter(F.col("place") > most_wanted).join(certain, F.col("query") == F.col("its_query")).filter(
        F.col("middle") + F.col("slack") >= F.col("kth")
    )
    reads = first.unionByName(exact_scores(rest, valid, near, len(least)))
    return of_rows(reads, valid, again, k)


def of_rows(reads: DataFrame, vectors: DataFrame, again: DataFrame, k: int) -> DataFrame:
    """The answers of every row that asks, from the scores of the rows that stand for others."""
    order = [F.asc_nulls_last("vec_id"), "row"]
    place = F.row_number().over(Window.partitionBy("first").orderBy(*order))
    answers = again.withColumn("place", place).filter(F.col("place") <= k + 1).select(
        F.col("first").alias("row"), F.struct("vec_id", F.col("row").alias("row")).alias("copy")
    )
    each = reads.join(answers, "row", "left").select(
        "query", "score",
        F.coalesce("copy", F.struct("vec_id", F.col("row").alias("row"))).alias("one"),
    ).select("query", "score", "one.vec_id", "one.row")
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), *order))
    lists = (
        each.withColumn("place", best).filter(F.col("place") <= k + 1)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("place", "row", "vec_id", "score"))).alias("best"))
    )
    asking = vectors.filter("asks").select("row", F.col("vec_id").alias("query_id")).join(
        again.filter("asks").select("row", "first"), "row", "left"
    ).select("query_id", F.col("row").alias("own"), F.coalesce("first", "row").alias("query"))
    others = F.slice(F.filter("best", lambda b: b["row"] != F.col("own")), 1, k)
    return asking.join(lists, "query").select("query_id", F.posexplode(others).alias("pos", "answer")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), "answer.vec_id", "answer.score"
    )
