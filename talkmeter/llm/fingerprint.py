"""Document fingerprints: a homomorphic multiset hash over paragraphs (lines).

Every paragraph is hashed to one wide vector; a document's fingerprint is the sum of its paragraphs'
vectors, so their order doesn't matter and a paragraph is put in or taken out by one addition or
subtraction. The vector has two parts:

* equality lanes: 32 uniform numbers modulo 2^32 from a cryptographic hash of the paragraph;
* likeness lanes: 256 counters modulo 2^32. Each window of 16 bytes inside the paragraph adds +1 or -1
  to one of them (a shorter paragraph is one window), so that the inner product of two fingerprints
  estimates the number of windows that the texts share.

Likeness is 2ab / (aa + bb) over the likeness lanes, at least 0, and 1 for equal fingerprints. Up to
2^31 - 1 net windows in a lane are told apart, more than a text has bytes, however it repeats itself.

Defined results: a null text counts as empty; an empty text is one empty paragraph; the next document
is the next row by (doc_id, text), nulls first, so rows that repeat an id follow each other; after the
last comes the first, and a single row is its own next; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmeter.llm.common import tasks, text_of

LANES, NEAR_LANES, WINDOW = 32, 256, 16
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
CHUNK = 4_000_000  # characters hashed at a time inside a task


def spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = a * FIRST ^ (b * SECOND + (a >> np.uint64(29)))
    mixed ^= mixed >> np.uint64(32)
    return mixed * FIRST


def vectors(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Equality lanes (uint32) and likeness lanes (uint32), a row per text."""
    count = len(texts)
    paragraphs = [text.encode("utf-8", "surrogatepass").split(b"\n") for text in texts]
    sizes = np.array([len(p) for p in paragraphs], dtype=np.int64)
    flat = [paragraph for own in paragraphs for paragraph in own]
    owner = np.repeat(np.arange(count), sizes)
    digests = b"".join(
        hashlib.blake2b(p, person=b"one").digest() + hashlib.blake2b(p, person=b"two").digest()
        for p in flat
    )
    lanes = np.frombuffer(digests, dtype="<u4").reshape(len(flat), LANES)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    equal = np.add.reduceat(lanes, starts, axis=0, dtype=np.uint32)

    lengths = np.array([len(p) for p in flat], dtype=np.int64)
    windows = lengths - (WINDOW - 1)
    short = (windows < 1) & (lengths > 0)
    marks = np.frombuffer(digests, dtype="<u8").reshape(len(flat), LANES // 2)[short, 0]
    at, hashed = [owner[short]], [marks]
    data = b"\n".join(flat) + b" " * WINDOW
    view = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    long = windows > 0
    if long.any():
        runs = windows[long]
        shift = np.repeat(begin[long] - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs)
        place = np.arange(runs.sum(), dtype=np.int64) + shift
        hashed.append(spread(view[place], view[place + 8]))
        at.append(np.repeat(owner[long], runs))
    marks, who = np.concatenate(hashed), np.concatenate(at)
    lane = who * NEAR_LANES + (marks >> np.uint64(56)).astype(np.int64)
    sign = ((marks >> np.uint64(55)) & np.uint64(1)).astype(np.float64) * 2 - 1
    near = np.bincount(lane, weights=sign, minlength=count * NEAR_LANES)
    near = near.astype(np.int64).astype(np.uint32).reshape(count, NEAR_LANES)
    return equal, near


def in_chunks(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """``vectors`` with bounded working memory: some million characters at a time."""
    parts, start, held = [], 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= CHUNK or i + 1 == len(texts):
            parts.append(vectors(texts[start : i + 1]))
            start, held = i + 1, 0
    equal, near = zip(*parts)
    return np.concatenate(equal), np.concatenate(near)


def combine(first, second, sign: int = 1):
    """The fingerprint vectors after paragraphs are put in (1) or taken out (-1)."""
    return tuple(
        (a + b if sign > 0 else a - b).astype(a.dtype) for a, b in zip(first, second)
    )


def printed(equal: np.ndarray, near: np.ndarray) -> list[str]:
    rows = np.concatenate([equal.astype("<u4").view(np.uint8), near.astype("<u4").view(np.uint8)], 1)
    return [base64.b64encode(row.tobytes()).decode() for row in rows]


def likeness(a, b) -> np.ndarray:
    """Row by row, between 0 and 1."""
    x, y = (v[1].astype(np.int32).astype(np.float64) for v in (a, b))
    both, all_ = (x * y).sum(1), (x * x).sum(1) + (y * y).sum(1)
    near = np.clip(2 * both / np.maximum(all_, 1), 0, 1)
    same = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    return np.where(same, 1.0, near)


def split_points(docs: DataFrame, pieces: int) -> list[int]:
    """Ids that cut the table into pieces of about equal rows: one number per piece."""
    shares = [i / pieces for i in range(1, pieces)]
    found = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 10_000)).first()[0]
    return sorted(set(found or []))


def piece_of(column: Column, points: Sequence[int], group: int = 64) -> Column:
    """How many points lie below the value: found among every 64th point, then among those between."""
    if not points:
        return F.lit(0)
    every = F.array(*[F.lit(p) for p in points[::group]])
    block = F.size(F.filter(every, lambda p: p < column))
    parts = [points[i : i + group] for i in range(0, len(points), group)]
    fine = F.element_at(F.array(*[F.array(*map(F.lit, p)) for p in parts]), F.greatest(block, F.lit(1)))
    inside = F.size(F.filter(fine, lambda p: p < column))
    return F.when(column.isNull(), 0).otherwise(
        F.greatest(block - 1, F.lit(0)) * group + inside
    )


def in_order(docs: DataFrame, per_task: int = 4) -> DataFrame:
    """Rows (piece, border, doc_id, text), sorted, each piece in one partition.

    A piece's last row is a border: a copy of the first row after it. The least ids of the pieces are
    gathered to find those rows: one number per piece, and pieces follow the number of tasks.
    """
    spark = docs.sparkSession
    pieces = tasks(spark) * per_task
    points = split_points(docs, pieces)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.withColumn("piece", piece_of(F.col("doc_id"), points).cast("int"))
    firsts = sorted(
        (r.piece, r.nulls, r.least)
        for r in rows.groupBy("piece").agg(
            F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nulls")
        ).collect()
    )
    if not firsts:
        return rows.withColumn("border", F.lit(False)).limit(0)
    before = {firsts[i][0]: firsts[i - 1][0] for i in range(len(firsts))}
    heads = [None if nulls else least for _, nulls, least in firsts]
    wanted = F.col("doc_id").isin([h for h in heads if h is not None])
    if None in heads:
        wanted = wanted | F.col("doc_id").isNull()
    target = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("piece"))
    borders = (
        rows.filter(wanted).groupBy("doc_id", "piece").agg(F.min("text").alias("text"))
        .select("doc_id", "text", target.alias("piece"), F.lit(True).alias("border"))
    )
    every = rows.withColumn("border", F.lit(False)).unionByName(borders)
    return every.repartitionByRange(pieces, "piece").sortWithinPartitions(
        "piece", "border", F.col("doc_id").asc_nulls_first(), "text"
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as much of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(rows: pd.DataFrame) -> pd.DataFrame:
    """Results for all rows but the borders, from rows in order that end with a border."""
    texts = rows["text"].tolist()
    own = in_chunks(texts)
    here = np.flatnonzero(~rows["border"].to_numpy(dtype=bool))
    changed = [edited(texts[i], texts[i + 1]) for i in here]
    other = in_chunks(changed)
    mine = tuple(v[here] for v in own)
    return pd.DataFrame({
        "doc_id": rows["doc_id"].iloc[here],
        "n_chars": [len(texts[i]) for i in here],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": printed(*mine),
        "edited_fingerprint": printed(*other),
        "near_edited": likeness(mine, other),
        "near_next": likeness(mine, tuple(v[here + 1] for v in own)),
    })


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and the next one's."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            if batch.empty:
                continue
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            # The last row waits for its successor, unless it is a border.
            ready = len(rows) if rows["border"].iloc[-1] else len(rows) - 1
            kept = rows.iloc[ready:]
            if ready:
                part = rows.iloc[: ready + 1].reset_index(drop=True)
                if ready < len(rows):
                    part.loc[ready, "border"] = True
                yield compared(part)

    return in_order(docs).mapInPandas(visit, RESULT)
