"""Dealing documents into shards of near equal bytes, equal texts together, by best-fit decreasing.

A group is all documents with one text; it is never split. Packing has two levels, so that no task and
no driver holds all groups:

1. Groups are dealt by their hash to one piece per task and come to it in falling size. The piece packs
   them into crates of a fixed capacity, total / ``crates``: each group enters the open crate with the
   tightest room that still holds it, and only a group that fits nowhere opens a crate. Open crates
   stand in a balanced search tree by their room, of which the task holds nothing else, so a piece may
   be of any length. A group larger than a crate is a crate of its own.
2. Crates, at most 2 * ``crates`` and one for each piece, are packed by the same rule into shards, with
   the least capacity for which the wanted number of shards is enough. A crate of a fair share or more
   gets a shard of its own first, and the others share the rest.

Each document then learns its crate by a join on its group, each crate its shard; places inside a shard
run along ranges of (shard, id), so that no shard is sorted in one task. Texts stay where they are read:
what moves is ids, sizes and hashes.

Defined results: a null text counts as empty (size 1, CRC 0) and is one group with empty texts; null ids
come before others; rows that repeat are documents of their own; fewer groups than shards leave shards
empty; a group above a fair share makes its shard that much larger; an empty table gives no rows; other
columns are ignored. Groups are told apart by two 64-bit hashes and the size of their text.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmeter.llm.common import staged, tasks, text_of, wide_hash

KEY = ["first", "second", "bytes"]


class RoomTree:
    """Bins by the room they have left: a B-tree of two levels, leaves of at most 2 * ``leaf`` pairs."""

    def __init__(self, leaf: int = 256):
        self.leaf = leaf
        self.leaves: list[list[tuple[int, int]]] = [[]]
        self.lasts: list[tuple[int, int]] = []  # the last pair of each leaf, where it has one

    def add(self, room: int, number: int) -> None:
        pair = (room, number)
        i = min(bisect_left(self.lasts, pair), len(self.leaves) - 1)
        own = self.leaves[i]
        insort(own, pair)
        if len(own) > 2 * self.leaf:
            self.leaves[i : i + 1] = [own[: self.leaf], own[self.leaf :]]
            self.lasts[i : i + 1] = [own[self.leaf - 1], own[-1]]
        else:
            self.lasts[i : i + 1] = [own[-1]]

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the (room, number) with the least room of at least ``size``."""
        pair = (size, -1)
        i = bisect_left(self.lasts, pair)
        if i == len(self.lasts):
            return None
        own = self.leaves[i]
        found = own.pop(bisect_left(own, pair))
        if own:
            self.lasts[i] = own[-1]
        else:
            del self.lasts[i]
            if len(self.leaves) > 1:
                del self.leaves[i]
        return found


class Packer:
    """Best fit into bins of one capacity, for sizes that come in falling order."""

    def __init__(self, capacity: int):
        self.capacity, self.count, self.tree = capacity, 0, RoomTree()

    def place(self, size: int, times: int = 1) -> Iterator[tuple[int, int]]:
        """(bin, how many of ``times`` things of this size enter it), in order.

        After a thing has entered the tightest bin, that bin stays the tightest for the next of its size.
        """
        while times:
            found = self.tree.take(size)
            if found is None:
                found, self.count = (max(self.capacity, size), self.count), self.count + 1
            room, number = found
            fit = min(times, room // size)
            times -= fit
            if room > fit * size:
                self.tree.add(room - fit * size, number)
            yield number, fit

    def places(self, sizes: np.ndarray) -> np.ndarray:
        """The bin of each size; ``sizes`` fall."""
        starts = np.flatnonzero(np.concatenate([[True], sizes[1:] != sizes[:-1]])) if len(sizes) else []
        found, ends = [], [*starts[1:], len(sizes)]
        for start, end in zip(starts, ends):
            for number, fit in self.place(int(sizes[start]), int(end - start)):
                found.append(np.full(fit, number, dtype=np.int64))
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def evenly(sizes: Sequence[int], shards: int) -> np.ndarray:
    """A shard for each size, by best-fit decreasing with the least capacity that ``shards`` bins allow."""
    sizes = np.asarray(sizes, dtype=np.int64)
    out = np.zeros(len(sizes), dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    rest, used = sum(sizes.tolist()), 0
    while len(order) and used < shards - 1 and int(sizes[order[0]]) * (shards - used) >= rest:
        out[order[0]] = used
        rest, used, order = rest - int(sizes[order[0]]), used + 1, order[1:]
    if not len(order):
        return out
    falling, bins = sizes[order], shards - used
    low = max(-(-rest // bins), int(falling[0]))
    high = -(-rest // bins) + int(falling[0])  # here everything fits: a bin that refuses holds a fair share
    best = None
    while best is None or low < high:
        capacity = high if best is None else (low + high) // 2
        packer = Packer(capacity)
        tried = packer.places(falling)
        if packer.count <= bins:
            best, high = tried, capacity
        else:
            low = capacity + 1
    out[order] = best + used
    return out


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, first, second, bytes) per document, written."""
    text = text_of(docs)
    first, second = wide_hash(text)
    size = F.octet_length(text).cast("long") + 1
    return staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            first.alias("first"), second.alias("second"), size.alias("bytes"),
        ),
        "document-sizes",
    )


def crated(groups: DataFrame, capacity: int) -> DataFrame:
    """(first, second, bytes, weight, piece, crate) from (first, second, bytes, weight), written."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = Packer(capacity)
        for batch in batches:
            yield batch.assign(crate=packer.places(batch["weight"].to_numpy()))

    pieces = groups.repartition(tasks(groups.sparkSession), *KEY).withColumn(
        "piece", F.spark_partition_id()
    ).sortWithinPartitions(F.desc("weight"), *KEY)
    return staged(
        pieces.mapInPandas(
            visit, "first long, second long, bytes long, weight long, piece int, crate long"
        ),
        "crated-groups",
    )


def placed(rows: DataFrame, order: list) -> DataFrame:
    """The rows with ``slot``, a gapless number from 0 inside their shard, in ``order``.

    A range of (shard, order) is sorted in one task and written with its rows' places; a task's range
    meets few shards, so the bases are a row per task and shard.
    """
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(tasks(spark), "shard", *order).sortWithinPartitions("shard", *order)
    dealt = staged(dealt.withColumn("__at", F.monotonically_increasing_id()), "shard-ranges")
    part = F.shiftright("__at", 33)
    runs = dealt.groupBy("shard", part.alias("__part")).agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n")
    )
    earlier = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(
        runs.select(
            F.col("shard").alias("__shard"), F.col("__part").alias("__its_part"), "__first",
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__base"),
        ),
        "shard-bases",
    )
    same = (F.col("shard") == F.col("__shard")) & (part == F.col("__its_part"))
    return dealt.join(bases, same).withColumn(
        "slot", F.col("__at") - F.col("__first") + F.col("__base")
    ).drop("__at", "__shard", "__its_part", "__first", "__base")


def sharded(docs: DataFrame, shards: int = 16, crates: int = 8192) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per document.

    ``law`` is ``bytes``: sizes of shards are near equal, so ``grown_shard`` is null.
    """
    spark = docs.sparkSession
    rows = sized(docs)
    groups = rows.groupBy(*KEY).agg(F.sum("size").alias("weight"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    packed = crated(groups, max(1, -(-total // crates)))
    # At most 2 * crates and one for each task: the bound that makes these rows fit for one place.
    found = packed.groupBy("piece", "crate").agg(F.sum("weight").alias("weight")).toPandas()
    found = found.sort_values(["weight", "piece", "crate"], ascending=[False, True, True])
    chosen = spark.createDataFrame(
        pd.DataFrame({
            "piece": found["piece"].astype("int32"), "crate": found["crate"].astype("int64"),
            "shard": evenly(found["weight"].to_numpy(dtype=np.int64), shards).astype("int32"),
        }),
        "piece int, crate long, shard int",
    )
    homes = packed.join(F.broadcast(chosen), ["piece", "crate"]).select(*KEY, "shard")
    dealt = rows.join(staged(homes, "group-shards"), KEY).select(
        "doc_id", "size", "text_crc32", "shard"
    )
    return placed(dealt, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
