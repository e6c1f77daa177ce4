"""Document quality from a linear-chain conditional random field over lines.

Every line is described by shares of character classes, word repetition, lengths and punctuation,
and by the same numbers of the line before and the line after. The field labels lines good or bad;
forward-backward marginals of "good", weighted by line length, make the document's mean, and a
logistic curve fitted on the documents turns it into a score.

Labels mark documents, not lines. All lines of good documents are good; of bad documents all lines
start as bad, and after each fit those that the field takes for good change sides, except the worst
line of each. The fit uses a bounded sample: ``sample`` labelled documents with the smallest hash of
their id, and of each at most ``sample_lines`` neighbouring lines, a stretch that begins at a line chosen by
the hash. Scoring reads all lines of all texts.

Defined results: a null or empty text is one empty line; rows that repeat an id or text are scored
alike; of labels that repeat an id the greatest counts, null labels don't; without labelled documents of
both kinds every score is the smoothed share of good ones; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmeter.llm.common import staged, text_of
from talkmeter.llm.optimize import minimise, sigmoid
from talkmeter.llm.toxicity import sample_of

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
CHUNK = 2_000_000  # characters described at a time inside a task


def byte_classes() -> np.ndarray:
    kinds = np.full(256, 6)
    kinds[ord("a") : ord("z") + 1] = 0
    kinds[ord("A") : ord("Z") + 1] = 1
    kinds[ord("0") : ord("9") + 1] = 2
    kinds[[9, 10, 11, 12, 13, 32]] = 3
    kinds[[ord(c) for c in ".,;:?'\"()-"]] = 4
    kinds[ord("!")] = 5
    kinds[128:] = 7
    return kinds


CLASSES = byte_classes()
OWN = 16


def sums_at(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def described(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per line, line lengths in code points, lines per text)."""
    data = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], breaks + 1])
    ends = np.concatenate([breaks, [len(data)]])
    lines = len(starts)
    kinds = CLASSES[data]
    counts = np.stack([sums_at(kinds == k, starts, ends) for k in range(8)], axis=1)
    size = np.maximum(ends - starts, 1)
    points = sums_at((data & 0xC0) != 0x80, starts, ends)

    space = kinds == 3
    begin = ~space & np.concatenate([[True], space[:-1]]) if len(data) else space
    finish = ~space & np.concatenate([space[1:], [True]]) if len(data) else space
    first, last = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    line_of = np.searchsorted(starts, first, side="right") - 1
    words = np.bincount(line_of, minlength=lines)
    powers = np.cumprod(np.full(len(data) + 1, BASE))
    back = np.cumprod(np.full(len(data) + 1, INVERSE))
    total = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * powers[: len(data)])])
    hashed = (total[last] - total[first]) * back[first]
    order = np.lexsort((hashed, line_of))
    h, o = hashed[order], line_of[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    different = np.bincount(o[fresh], minlength=lines)
    same_as_last = np.zeros(lines)
    if len(hashed) > 1:
        twice = (hashed[1:] == hashed[:-1]) & (line_of[1:] == line_of[:-1])
        same_as_last = np.bincount(line_of[1:][twice], minlength=lines)

    final = np.where(ends > starts, kinds[np.maximum(ends - 1, 0)] if len(data) else 3, 3)
    initial = np.where(ends > starts, kinds[np.minimum(starts, len(data) - 1)] if len(data) else 3, 3)
    some = np.maximum(words, 1)
    letters = np.maximum(counts[:, 0] + counts[:, 1] + counts[:, 7], 1)
    own = np.stack([
        counts[:, 1] / letters,
        counts[:, 1] > counts[:, 0],
        counts[:, 2] / size,
        counts[:, 4] / size,
        counts[:, 5] / some,
        counts[:, 6] / some,
        counts[:, 6] / some > 0.3,
        counts[:, 7] / size,
        np.log1p(words) / 5,
        np.minimum((size - counts[:, 3]) / some, 40) / 10,
        1 - different / some,
        (words >= 8) & (different < 0.5 * words),
        same_as_last / some,
        final == 4,
        initial == 1,
        ends == starts,
    ], axis=1).astype(np.float64)
    per_text = np.array([text.count("\n") + 1 for text in texts], dtype=np.int64)
    return own, points, per_text


def with_neighbours(own: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Each line's features, its predecessor's, its successor's, two border marks and a constant."""
    n = len(own)
    doc = np.repeat(np.arange(len(per_text)), per_text)
    joined = np.concatenate([[False], doc[1:] == doc[:-1]])[:, None]
    before = np.where(joined, np.roll(own, 1, axis=0), 0)
    followed = np.roll(joined, -1, axis=0)
    followed[-1] = False
    after = np.where(followed, np.roll(own, -1, axis=0), 0)
    return np.concatenate([own, before, after, ~joined, ~followed, np.ones((n, 1))], axis=1)


WIDTH = 3 * OWN + 3


def chain_sums(
    scores: np.ndarray, moves: np.ndarray, per_text: np.ndarray
) -> tuple[np.ndarray, float, np.ndarray]:
    """(probability of good per line, sum of log normalisers, expected label pairs).

    ``scores`` are the lines' scores for good (bad has 0), ``moves`` the scores of label pairs.
    Documents advance together, line by line, the longest first.
    """
    order = np.argsort(-per_text, kind="stable")
    sizes = per_text[order]
    starts = (np.cumsum(per_text) - per_text)[order]
    steps = int(sizes.max(initial=0))
    active = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")
    ahead = np.zeros((len(scores), 2))
    now = np.zeros((len(order), 2))
    for t in range(steps):
        k = active[t]
        at = starts[:k] + t
        come = np.logaddexp(now[:k, :1] + moves[0], now[:k, 1:] + moves[1]) if t else now[:k] * 0
        come[:, 1] += scores[at]
        ahead[at] = now[:k] = come
    total = np.logaddexp(now[:, 0], now[:, 1])
    behind = np.zeros((len(scores), 2))
    later = np.zeros((len(order), 2))
    pairs = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        k = active[t + 1]
        at = starts[:k] + t
        reach = later[:k].copy()
        reach[:, 1] += scores[at + 1]
        for a in range(2):
            both = ahead[at, a][:, None] + moves[a] + reach - total[:k, None]
            pairs[a] += np.exp(both).sum(0)
        later[:k] = np.logaddexp(
            moves[:, 0][None] + reach[:, :1], moves[:, 1][None] + reach[:, 1:]
        )
        behind[at] = later[:k]
    good = sigmoid((ahead + behind)[:, 1] - (ahead + behind)[:, 0])
    return good, float(total.sum()), pairs


@dataclass
class Field:
    """Line weights, label-pair scores, and the curve from a document's mean to its score."""

    weights: np.ndarray
    moves: np.ndarray
    curve: tuple[float, float]

    def marginals(self, features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        return chain_sums(features @ self.weights, self.moves, per_text)[0]

    def means(self, texts: Sequence[str]) -> np.ndarray:
        own, points, per_text = described(texts)
        good = self.marginals(with_neighbours(own, per_text), per_text)
        return weighted(good, points, per_text)

    def predict(self, texts: Sequence[str]) -> np.ndarray:
        parts, start, held = [np.zeros(0)], 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= CHUNK or i + 1 == len(texts):
                parts.append(self.means(texts[start : i + 1]))
                start, held = i + 1, 0
        slope, base = self.curve
        return sigmoid(slope * log_odds(np.concatenate(parts)) + base)


def weighted(good: np.ndarray, points: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    starts = np.cumsum(per_text) - per_text
    weight = points + 1.0
    return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_field(
    features: np.ndarray, labels: np.ndarray, per_text: np.ndarray, start: np.ndarray, penalty: float
) -> np.ndarray:
    doc = np.repeat(np.arange(len(per_text)), per_text)
    joined = np.flatnonzero(doc[1:] == doc[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[joined].astype(int), labels[joined + 1].astype(int)), 1)
    observed = features.T @ labels

    def cost(w: np.ndarray) -> tuple[float, np.ndarray]:
        scores, moves = features @ w[:WIDTH], w[WIDTH:].reshape(2, 2)
        good, normal, pairs = chain_sums(scores, moves, per_text)
        loss = normal - scores @ labels - (seen * moves).sum()
        slope = np.concatenate([features.T @ good - observed, (pairs - seen).ravel()])
        return loss + penalty / 2 * w @ w, slope + penalty * w

    return minimise(cost, start, steps=40)


def stretch(text: str, mark: int, count: int) -> str:
    """``count`` neighbouring lines of a text, or all it has; the hash says where they begin."""
    lines = text.split("\n")
    first = mark % (len(lines) - count + 1) if len(lines) > count else 0
    return "\n".join(lines[first : first + count])


def train(
    docs: DataFrame, labels: DataFrame, sample: int = 4000, sample_lines: int = 200, rounds: int = 3,
    penalty: float = 1.0,
) -> Field:
    rows = staged(
        sample_of(docs, labels, sample, {"quality": "int(quality)"}), "quality-sample"
    )

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for mark, text, quality in zip(batch["mark"], batch["text"], batch["quality"]):
                own, points, _ = described([stretch(text, mark, sample_lines)])
                out.append((mark, quality, own.astype(np.float32).ravel(), points))
            yield pd.DataFrame(out, columns=["mark", "quality", "own", "points"])

    found = rows.mapInPandas(
        featured, "mark long, quality int, own array<float>, points array<long>"
    ).toPandas().sort_values("mark", kind="stable")
    quality = found["quality"].to_numpy()
    rate = (quality.sum() + 0.5) / (len(quality) + 1)
    prior = (0.0, float(np.log(rate / (1 - rate))))
    if len(set(quality)) < 2:
        return Field(np.zeros(WIDTH), np.zeros((2, 2)), prior)
    per_text = found["points"].map(len).to_numpy()
    own = np.concatenate([np.asarray(a, dtype=np.float64) for a in found["own"]]).reshape(-1, OWN)
    points = np.concatenate([np.asarray(a) for a in found["points"]])
    features = with_neighbours(own, per_text)
    doc = np.repeat(np.arange(len(per_text)), per_text)
    starts = np.cumsum(per_text) - per_text
    lines = quality[doc].astype(np.float64)
    w = np.zeros(WIDTH + 4)
    for turn in range(rounds):
        w = fit_field(features, lines, per_text, w, penalty)
        good = chain_sums(features @ w[:WIDTH], w[WIDTH:].reshape(2, 2), per_text)[0]
        if turn + 1 < rounds:
            worst = good <= np.minimum.reduceat(good, starts)[doc]
            lines = np.where(quality[doc] == 1, 1.0, ((good > 0.5) & ~worst).astype(np.float64))
    mean = log_odds(weighted(good, points, per_text))
    y = quality.astype(np.float64)

    def cost(c: np.ndarray) -> tuple[float, np.ndarray]:
        score = c[0] * mean + c[1]
        off = sigmoid(score) - y
        return (
            np.logaddexp(0, score).sum() - score @ y + 0.5 * c[0] ** 2,
            np.array([off @ mean + c[0], off.sum()]),
        )

    slope, base = minimise(cost, np.array([0.1, prior[1]]))
    return Field(w[:WIDTH], w[WIDTH:].reshape(2, 2), (float(slope), float(base)))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: the check sum of the id as text is divisible by 5."""
    mark = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(mark == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    field = train(docs, labels.filter(~held_out(F.col("doc_id"))), **options)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["doc_id", "held_out"]].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["score"] = field.predict(batch["text"].tolist())
            yield out

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
        text_of(docs).alias("text"),
    )
    return rows.mapInPandas(visit, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
