"""Packing token sequences by non-negative least squares.

A document's ids are its text's ids and one id 0 at the end. Full windows are cut off its front; what
is left, shorter than a window, is packed with others. Only the histogram of these lengths decides:
all combinations of two or three lengths that fill a window exactly are enumerated, non-negative least
squares fits how often each is used, the counts are rounded to what the histogram holds, and the
residual pieces are strung together, longest first, and cut at every window. So only the very last
sequence can be short of a window.

The histogram has an entry per length, the plan some entries per combination: their size follows the
window, not the corpus. Where a piece goes follows from its length and its rank among pieces of that
length; ranks are counted in groups of (length, salt), so that one length with a third of all
pieces is spread over many tasks.

Defined results: a null text is empty, an empty one has the single id 0; rows that repeat an id are
packed each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmeter.llm.common import staged, text_of

END = b"\0\0\0\0"
TOKENS = "doc_id long, doc_tokens long, rest int, salt int, blocks array<long>, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long"
)


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Fixed value: the published word pattern of byte-level tokenizers.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies print visible bytes as themselves and the others from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as bytes (unsigned 32-bit, little-endian) by a ``tokenizers`` file.

    A plain byte-level file whose merges stand in the order of their ids is run by ``tiktoken``, which
    gives the same ids several times as fast; any other, and texts it can't take, by ``tokenizers``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        about = json.loads(self.tokenizer.to_str())
        before, model = about["pre_tokenizer"] or {}, about["model"]
        self.special = {token["content"]: token["id"] for token in about["added_tokens"]}
        self.fast = None
        if (
            before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and about["normalizer"] is None
            and model["type"] == "BPE" and not model.get("ignore_merges")
        ):
            self.fast = self._fast(model["vocab"], model["merges"])

    def _fast(self, vocabulary: Mapping[str, int], merges: Sequence):
        import tiktoken

        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        made = [vocabulary["".join(pair)] for pair in pairs]
        own = {w: i for w, i in vocabulary.items() if w not in self.special}
        letters = byte_of_letter()
        if made != sorted(set(made)) or len(own) != 256 + len(made):
            return None
        if not all(letter in own for letter in letters):
            return None
        ranks = {bytes(letters[c] for c in word): number for word, number in own.items()}
        return tiktoken.Encoding(
            "file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=self.special
        )

    def encode(self, text: str) -> bytes:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            except (RuntimeError, ValueError):
                pass  # a run too long for its pattern matcher
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()


def tokenized(
    docs: DataFrame, window: int, salts: int, tokenizer_path: Callable[[], str]
) -> DataFrame:
    """Per document: number of ids, check sums of its full windows, and the ids left over."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, seen, width = Encoder(tokenizer_path()), 0, 4 * window
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = encoder.encode(text) + END
                full = len(ids) // width
                crcs = [zlib.crc32(ids[i * width : (i + 1) * width]) for i in range(full)]
                rest = ids[full * width :]
                rows.append((len(ids) // 4, len(rest) // 4, seen * 7919 % salts, crcs, rest))
                seen += 1
            out = pd.DataFrame(rows, columns=["doc_tokens", "rest", "salt", "blocks", "ids"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInPandas(visit, TOKENS)


def combinations(lengths: Sequence[int], window: int) -> list[tuple[int, ...]]:
    """Two or three of the lengths (descending, may repeat) that sum to the window."""
    have, found = set(lengths), []
    descending = sorted(have, reverse=True)
    for a in descending:
        if 2 * a >= window and window - a in have:
            found.append((a, window - a))
    for a in descending:
        if 3 * a < window:
            break
        for b in range(min(a, window - a - 1), (window - a + 1) // 2 - 1, -1):
            if b in have and window - a - b in have:
                found.append((a, b, window - a - b))
    return found


def fitted(combos: Sequence[tuple[int, ...]], histogram: Mapping[int, int], sweeps: int) -> list[float]:
    """Non-negative least squares by coordinate descent: sum of combinations against histogram."""
    residual = {length: float(n) for length, n in histogram.items()}
    weights = [sum(c.count(l) ** 2 for l in set(c)) for c in combos]
    counts = [0.0] * len(combos)
    for _ in range(sweeps):
        moved = 0.0
        for j, combo in enumerate(combos):
            step = sum(residual[length] for length in combo) / weights[j]
            step = max(step, -counts[j])
            if step:
                counts[j] += step
                for length in combo:
                    residual[length] -= step
                moved = max(moved, abs(step))
        if moved < 0.5:
            break
    return counts


def used_counts(
    histogram: Mapping[int, int], window: int, sweeps: int = 30
) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Whole repeats of combinations within the histogram, and what they leave of it."""
    left = {length: n for length, n in histogram.items() if n and length}
    combos = combinations(list(left), window)
    wanted = fitted(combos, left, sweeps)
    used: dict[tuple[int, ...], int] = {}
    order = sorted(range(len(combos)), key=lambda j: -wanted[j])

    def take(combo: tuple[int, ...], most: float) -> None:
        n = min([int(most), *(left[l] // combo.count(l) for l in combo)])
        if n > 0:
            used[combo] = used.get(combo, 0) + n
            for length in combo:
                left[length] -= n

    for j in order:
        take(combos[j], round(wanted[j]))
    for j in order:
        take(combos[j], float(1 << 62))
    return sorted(used.items(), reverse=True), {l: n for l, n in left.items() if n}


class Plan:
    """Where the r-th piece of a length goes; ``places`` cuts ranks into runs with one rule each."""

    def __init__(self, histogram: Mapping[int, int], window: int):
        self.window = window
        used, left = used_counts(histogram, window)
        rank = dict.fromkeys(histogram, 0)
        self.places: dict[int, list[tuple[int, int, int, int]]] = {l: [] for l in histogram}
        sequence = 0
        for combo, n in used:
            offset = 0
            for length in sorted(set(combo), reverse=True):
                times = combo.count(length)
                # (first rank, first sequence, offset, pieces per sequence)
                self.places[length].append((rank[length], sequence, offset, times))
                rank[length] += times * n
                offset += times * length
            sequence += n
        self.string_at, position = sequence, 0
        for length in sorted(left, reverse=True):
            self.places[length].append((rank[length], -1, position, 0))
            position += length * left[length]
        self.sequences = sequence + -(-position // window)
        self.starts = {l: [p[0] for p in places] for l, places in self.places.items()}

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of one leftover: two where it is cut."""
        first, sequence, offset, times = self.places[length][
            bisect_right(self.starts[length], rank) - 1
        ]
        if times:
            step, nth = divmod(rank - first, times)
            return [(0, length, sequence + step, offset + nth * length)]
        step, at = divmod(offset + (rank - first) * length, self.window)
        here = min(length, self.window - at)
        found = [(0, here, self.string_at + step, at)]
        if here < length:
            found.append((here, length - here, self.string_at + step + 1, 0))
        return found


def sequences(
    docs: DataFrame, window: int = 1024, salts: int = 64,
    tokenizer_path: Callable[[], str] = partial(public_file, "byte_bpe_50k.json"),
) -> DataFrame:
    """A row per piece: which ids of which document lie where in which sequence."""
    tokens = staged(tokenized(docs, window, salts, tokenizer_path), "tokens")
    counts = staged(
        tokens.groupBy("rest", "salt").agg(
            F.count("*").alias("pieces"), F.sum(F.size("blocks")).alias("windows")
        ),
        "length-counts",
    )
    totals = counts.groupBy("rest").agg(F.sum("pieces"), F.sum("windows")).collect()
    totals.sort(key=lambda r: r[0])
    plan = Plan({r[0]: r[1] for r in totals if r[0]}, window)
    block_base, base = {}, plan.sequences
    for rest, _, windows in totals:
        block_base[rest] = base
        base += windows
    before = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "rest", "salt",
        F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("rank_base"),
        F.coalesce(F.sum("windows").over(before), F.lit(0)).alias("block_base"),
    )
    group = Window.partitionBy("rest", "salt").orderBy("doc_id", "doc_tokens", "ids")
    ranked = tokens.join(staged(bases, "length-bases"), ["rest", "salt"]).select(
        "doc_id", "doc_tokens", "rest", "blocks", "ids",
        (F.col("rank_base") + F.row_number().over(group) - 1).alias("rank"),
        (
            F.col("block_base") + F.coalesce(
                F.sum(F.size("blocks")).over(group.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            )
        ).alias("block"),
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split(" ")[0] for field in PIECES.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, n, rest, blocks, ids, rank, block in zip(
                batch["doc_id"].astype("Int64"), *(batch[c] for c in batch.columns[1:])
            ):
                for i, crc in enumerate(blocks):
                    rows.append((doc_id, i * window, window, crc, n, block_base[rest] + block + i, 0))
                if rest:
                    front = len(blocks) * window
                    for start, length, sequence, offset in plan.pieces(rest, rank):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc_id, front + start, length, crc, n, sequence, offset))
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return ranked.mapInPandas(place, PIECES)
