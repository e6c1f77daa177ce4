"""Product-quantiser codes of vectors, learnt and applied exactly over Hilbert-sorted flat blocks.

A vector's components become integers floor(scale * x) and are cut into ``parts`` equal parts; every
part position has a codebook of ``entries`` entries. The parts of one position are sorted along a
Hilbert curve and written once as flat blocks of at most ``block`` parts: one row with their numbers,
their components in one piece of bytes, the least and greatest corner of their box, and their sum.

Every round compares boxes with entries first. The entry with the smallest greatest distance to the box
is its pivot; an entry that is farther than the pivot from every point of the box can be nearest to no
part of the block, so each block has a short list. A list of one entry settles the block from its stored sum without reading its parts; for
the others an integer kernel computes distances from the block's parts to the listed entries. What
leaves a task is one count and sum per entry it has met.

Codebooks are ``parts`` x ``entries`` entries, whatever the row count, and travel with the tasks.
Blocks are dealt by ranges of (position, curve, row number), so copies of one vector spread too.

Defined results: vectors null or with null, NaN or infinite components are dropped; vectors of unequal
lengths, and lengths that ``parts`` doesn't divide, are padded with zeros; null ids sort before others,
rows that repeat an id are vectors of their own (the first codebook takes them by their components);
fewer vectors than ``entries`` give shorter codebooks; components beyond 64 bits count as the nearest
64-bit number, distances are exact for all of them, and an error beyond 64 bits is given as the
largest number of 64 bits; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmeter.llm.common import staged, tasks

MOST = 2**63 - 1
BLOCK = pa.schema([
    ("part", pa.int32()), ("n", pa.int64()), ("rows", pa.binary()), ("kind", pa.string()),
    ("flat", pa.binary()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())),
    ("total", pa.list_(pa.string())),
])


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(row, vec_id, label, v array<long>) of the vectors that take part; written, so rows stay numbered."""
    x = F.col("embedding")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return staged(
        rows.filter(x.isNotNull() & fit).select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "label",
            F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"),
        ),
        "whole-vectors",
    )


def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along a Hilbert curve of points with ``bits`` bits per column (at most 63 in all)."""
    x = cells.T.astype(np.int64).copy()
    n, bit = len(x), 1 << (bits - 1)
    q = bit
    while q > 1:  # undo the turns of the curve inside each cell, from coarse to fine
        p = q - 1
        for i in range(n):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(turned, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    q = bit
    while q > 1:
        flips = np.where(x[n - 1] & q, flips ^ (q - 1), flips)
        q >>= 1
    x ^= flips
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def filled(lists: pa.ListArray, width: int) -> np.ndarray:
    """The lists as rows of a matrix, short ones padded with zeros."""
    flat = lists.flatten().to_numpy()
    if len(flat) == len(lists) * width:  # no list is longer than ``width``, so none is shorter
        return flat.reshape(-1, width)
    sizes = lists.value_lengths().to_numpy()
    out = np.zeros((len(lists), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def on_curve(vectors: DataFrame, least: np.ndarray, most: np.ndarray) -> DataFrame:
    """(row, part, place, v): one row per part of a vector, with its place on the part's curve.

    Where a part has many components, the first 31 give the place.
    """
    parts, width = least.shape
    used = min(width, 31)
    bits = min(10, 62 // used)
    low = least[:, :used].astype(np.float64)
    span = np.maximum(most[:, :used].astype(np.float64) - low, 1)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            values = filled(batch.column("v"), parts * width)
            at = (values.reshape(n, parts, width)[:, :, :used] - low) / span
            cells = np.clip((at * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1)
            ends = pa.array(np.arange(0, n * parts * width + 1, width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column("row").to_numpy(), parts)),
                pa.array(np.tile(np.arange(parts, dtype=np.int32), n)),
                pa.array(hilbert_places(cells.reshape(-1, used), bits)),
                pa.ListArray.from_arrays(ends, pa.array(values.ravel())),
            ], names=["row", "part", "place", "v"])

    return vectors.select("row", "v").mapInArrow(visit, "row long, part int, place long, v array<long>")


def narrowest(values: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as hold them."""
    for kind in (np.int16, np.int32):
        info = np.iinfo(kind)
        if values.min() >= info.min and values.max() <= info.max:
            return values.astype(kind)
    return values


def flat_blocks(pieces: DataFrame, width: int, block: int) -> DataFrame:
    """(part, n, rows, kind, flat, low, high, total): blocks of neighbours on the curve, written."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            part, row = batch.column("part").to_numpy(), batch.column("row").to_numpy()
            values = batch.column("v").flatten().to_numpy().reshape(-1, width)
            starts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
            out = []
            for start, end in zip(starts, starts[1:]):
                for at in range(start, end, block):
                    own = values[at : min(at + block, end)]
                    flat = narrowest(own)
                    out.append((
                        int(part[at]), len(own), row[at : at + len(own)].tobytes(), flat.dtype.char,
                        flat.tobytes(), own.min(axis=0), own.max(axis=0),
                        [str(t) for t in exact_sum(own)],
                    ))
            columns = ["part", "n", "rows", "kind", "flat", "low", "high", "total"]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=columns), BLOCK, preserve_index=False)

    order = ["part", "place", "row"]
    dealt = pieces.repartitionByRange(tasks(pieces.sparkSession), *order).sortWithinPartitions(*order)
    return staged(
        dealt.select("part", "row", "v").mapInArrow(
            visit,
            "part int, n long, rows binary, kind string, flat binary, low array<long>, "
            "high array<long>, total array<string>",
        ),
        "flat-blocks",
    )


def exact_sum(values: np.ndarray) -> np.ndarray:
    """Sums of the columns, by Python's integers where 64 bits might not hold them."""
    size = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
    return (values if size * len(values) <= MOST else values.astype(object)).sum(axis=0)


def exact(values: np.ndarray) -> np.ndarray:
    """64-bit integers where squared distances fit, else Python's integers of any size."""
    size = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0))))
    return values if 4 * size**2 * values.shape[-1] <= MOST else values.astype(object)


def short_lists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Per box (a row of ``low`` and ``high``) which entries may be nearest to a part inside it."""
    at_low, at_high = (low[:, None] - book[None]) ** 2, (high[:, None] - book[None]) ** 2
    reach = np.maximum(at_low, at_high).sum(axis=2)
    pivot = reach.argmin(axis=1)[:, None, None]
    # How much farther an entry is than the pivot is linear along each component: least at a corner.
    ahead = [a - np.take_along_axis(a, pivot, axis=1) for a in (at_low, at_high)]
    listed = np.minimum(*ahead).sum(axis=2) <= 0
    for e in range(1, len(book)):  # of equal entries the first gets all
        if (book[:e] == book[e]).all(axis=1).any():
            listed[:, e] = False
    return listed


def kernel(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, ties to the first; its squared distance) per point."""
    away = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    best = away.argmin(axis=1)
    return best, away[np.arange(len(points)), best]


def opened(block, width: int) -> np.ndarray:
    return np.frombuffer(block.flat, dtype=block.kind).reshape(-1, width).astype(np.int64)


def listed_blocks(batch: pd.DataFrame, books: list[np.ndarray]) -> Iterator[tuple]:
    """(block, its short list) for all blocks of a batch, boxes of a part position at a time."""
    for part, blocks in batch.groupby("part", sort=False):
        book = books[part]
        corners = exact(np.concatenate([np.stack(blocks["low"]), np.stack(blocks["high"]), book]))
        n = len(blocks)
        listed = short_lists(corners[:n], corners[n : 2 * n], corners[2 * n :])
        for block, mine in zip(blocks.itertuples(index=False), listed):
            yield block, np.flatnonzero(mine)


def near(block, mine: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parts of the block, each one's entry, its squared distance)."""
    entries = books[block.part][mine]
    both = exact(np.concatenate([opened(block, entries.shape[1]), entries]))
    points = both[: -len(entries)]
    best, away = kernel(points, both[-len(entries) :])
    return points, mine[best], away


def entry_sums(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, d, n, total): a count and a component's sum per entry that has parts."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[tuple[int, int], int] = {}
        sums: dict[tuple[int, int], np.ndarray] = {}

        def add(key: tuple[int, int], n: int, total: np.ndarray) -> None:
            counts[key] = counts.get(key, 0) + n
            sums[key] = sums[key] + total if key in sums else total

        for batch in batches:
            for block, mine in listed_blocks(batch, books):
                if len(mine) == 1:
                    total = np.array([int(t) for t in block.total], dtype=object)
                    add((block.part, int(mine[0])), block.n, total)
                    continue
                points, best, _ = near(block, mine, books)
                for e in np.unique(best):
                    own = points[best == e]
                    add((block.part, int(e)), len(own), exact_sum(own).astype(object))
        yield pd.DataFrame(
            [(*k, d, counts[k], str(t)) for k, v in sums.items() for d, t in enumerate(v)],
            columns=["part", "entry", "d", "n", "total"],
        )

    found = blocks.drop("rows").mapInPandas(
        visit, "part int, entry int, d int, n long, total string"
    )
    return found.groupBy("part", "entry", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )


def moved(books: list[np.ndarray], sums: DataFrame) -> list[np.ndarray]:
    """The codebooks after a round; the rows that come here are the entries' components."""
    books = [book.copy() for book in books]
    for r in sums.collect():
        books[r.part][r.entry, r.d] = int(r.total) // r.n
    return books


def coded(blocks: DataFrame, books: list[np.ndarray], together: int = 64) -> DataFrame:
    """(row, part, entry, away) per part of a vector; ``together`` blocks leave a task at a time."""

    def frame(found: list[tuple]) -> pd.DataFrame:
        sizes = [len(rows) for rows, _, _, _ in found]
        return pd.DataFrame({
            "row": np.concatenate([rows for rows, _, _, _ in found]),
            "part": np.repeat([part for _, part, _, _ in found], sizes),
            "entry": np.concatenate([best for _, _, best, _ in found]),
            "away": np.concatenate([away for _, _, _, away in found]),
        })

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = []
        for batch in batches:
            for block, mine in listed_blocks(batch, books):
                _, best, away = near(block, mine, books)
                rows = np.frombuffer(block.rows, dtype=np.int64)
                found.append((rows, block.part, best, np.minimum(away, MOST).astype(np.int64)))
                if len(found) == together:
                    yield frame(found)
                    found = []
        if found:
            yield frame(found)

    return blocks.mapInPandas(visit, "row long, part int, entry int, away long")


def limited(total: Column) -> Column:
    return F.least(total, F.lit(MOST).cast("decimal(38,0)")).cast("long")


def digest(books: list[np.ndarray]) -> str:
    values = ",".join(str(int(c)) for book in books for c in book.ravel())
    return hashlib.sha256(values.encode()).hexdigest()


def component_range(vectors: DataFrame, parts: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(components of a part, least and greatest component per part and place): a row per dimension."""
    found = vectors.select("row", F.posexplode("v").alias("d", "c")).groupBy("d").agg(
        F.min("c").alias("least"), F.max("c").alias("most")
    ).collect()
    width = max(1, -(-len(found) // parts))
    least, most = np.zeros((2, parts * width), dtype=np.int64)
    for r in found:
        least[r.d], most[r.d] = min(r.least, 0), max(r.most, 0)
    return width, least.reshape(parts, width), most.reshape(parts, width)


def trained(
    vectors: DataFrame, parts: int, entries: int, rounds: int, block: int
) -> tuple[DataFrame, list[np.ndarray]]:
    """(flat blocks, codebooks) of ``whole_vectors``."""
    width, least, most = component_range(vectors, parts)
    first = vectors.orderBy("vec_id", "v").limit(entries).select("v").collect()
    start = np.zeros((len(first), parts * width), dtype=np.int64)
    for i, r in enumerate(first):
        start[i, : len(r.v)] = r.v
    books = list(start.reshape(len(first), parts, width).transpose(1, 0, 2))
    # Written, so that the sampling of ranges doesn't place all parts a second time.
    pieces = staged(on_curve(vectors, least, most), "pieces")
    blocks = flat_blocks(pieces, width, block)
    for _ in range(rounds):
        books = moved(books, entry_sums(blocks, books))
    return blocks, books


def compressed(
    rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
    block: int = 256,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per vector that takes part.

    ``rows`` has vec_id, embedding and label. ``entries`` is at most 256 (two hex digits).
    """
    vectors = whole_vectors(rows.select("vec_id", "embedding", "label"), scale)
    blocks, books = trained(vectors, parts, entries, rounds, block)
    codes = coded(blocks, books).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("part", "entry"))).alias("e"),
        F.sum(F.col("away").cast("decimal(38,0)")).alias("away"),
    )
    digits = F.transform("e", lambda x: F.lpad(F.lower(F.hex(x["entry"])), 2, "0"))
    found = staged(
        vectors.select("row", "vec_id", "label").join(codes, "row").select(
            "vec_id", "label", F.array_join(digits, "").alias("code"), "away"
        ),
        "vector-codes",
    )
    labels = found.groupBy(F.col("label").alias("its_label")).agg(F.sum("away").alias("label_away"))
    return found.join(staged(labels, "label-errors"), F.col("label").eqNullSafe(F.col("its_label"))).select(
        "vec_id", "code", limited(F.col("away")).alias("error"),
        limited(F.col("label_away")).alias("label_error"),
        F.lit(digest(books)).alias("codebooks_sha256"),
    )
