"""Toxicity by a classifier chain.

Categories are predicted one after the other, each by a linear model (logistic) over the distinct
words, word beginnings and signs of the text and the probabilities of all earlier categories. In
training the earlier probabilities are out-of-fold predictions, so a later model never sees how well
an earlier one remembers its own rows. ``labels`` marks two categories: low quality and toxic.

The models are fitted on a bounded sample of the labelled rows, ``sample`` of them, the ones with the
smallest hash of their id; the vocabulary is all tokens of ``least_texts`` of the sampled texts or more
whose counts go with a category, by a chi-square of ``least_score`` or more. So the sample bounds it, and
nothing else does. Scoring reads all texts whole.

Defined results: a null text counts as empty; rows that repeat an id or text are scored alike; of labels
that repeat an id the greatest counts, null labels don't; with no labelled rows every probability is 0,
with one class only it is that class's smoothed share; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmeter.llm.common import ROW, packed, staged, text_of
from talkmeter.llm.optimize import minimise, sigmoid

TOKEN = re.compile(r"\w+|[^\w\s]+")
CHAIN = ("low_quality", "toxic")
STEM = 4


def tokens(text: str) -> set[str]:
    """Distinct words and runs of signs, and the beginnings of longer words: inflected forms share them."""
    found = set(TOKEN.findall(text.lower()))
    return found | {f"{word[:STEM]}*" for word in found if len(word) > STEM}


@dataclass
class Chain:
    """``weights[j]``: a weight per word, then per earlier category, then the constant."""

    categories: Sequence[str]
    words: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)

    def predict(self, texts: Sequence[str]) -> np.ndarray:
        found = np.zeros((len(texts), len(self.categories)))
        if not self.weights:
            return found
        for i, text in enumerate(texts):
            at = [self.words[w] for w in tokens(text) & self.words.keys()]
            at.sort()
            for j, w in enumerate(self.weights):
                n = len(self.words)
                score = w[at].sum() + found[i, :j] @ w[n : n + j] + w[-1]
                found[i, j] = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        return found


def logistic(
    rows: np.ndarray, columns: np.ndarray, dense: np.ndarray, y: np.ndarray, width: int,
    penalty: float,
) -> np.ndarray:
    """Weights over binary sparse cells (rows, columns), dense columns and a constant."""
    shape = width + dense.shape[1] + 1

    def cost(w: np.ndarray) -> tuple[float, np.ndarray]:
        score = dense @ w[width:-1] + w[-1]
        score = score + np.bincount(rows, weights=w[columns], minlength=len(y))
        p = sigmoid(score)
        loss = np.logaddexp(0, score).sum() - score @ y
        slope = np.empty(shape)
        off = p - y
        slope[:width] = np.bincount(columns, weights=off[rows], minlength=width)
        slope[width:-1] = dense.T @ off
        slope[-1] = off.sum()
        held = w.copy()
        held[-1] = 0
        return loss + penalty / 2 * held @ held, slope + penalty * held

    start = np.zeros(shape)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    start[-1] = np.log(rate / (1 - rate))
    return minimise(cost, start, steps=300)


def fit(
    rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, fold: np.ndarray, width: int,
    penalty: float,
) -> list[np.ndarray]:
    """The chain's weights; ``fold`` gives each row's part for the out-of-fold predictions."""
    earlier, weights = np.zeros((len(labels), 0)), []
    for j in range(labels.shape[1]):
        y = labels[:, j].astype(np.float64)
        weights.append(logistic(rows, columns, earlier, y, width, penalty))
        if j + 1 == labels.shape[1]:
            break
        out = np.zeros(len(y))
        for part in np.unique(fold):
            keep = fold != part
            number = np.cumsum(keep) - 1
            cells = keep[rows]
            w = logistic(
                number[rows[cells]], columns[cells], earlier[keep], y[keep], width, penalty
            )
            cells = ~cells
            score = np.bincount(rows[cells], weights=w[columns[cells]], minlength=len(y))
            out[~keep] = sigmoid(score + earlier @ w[width:-1] + w[-1])[~keep]
        earlier = np.column_stack([earlier, out])
    return weights


def sample_of(docs: DataFrame, labels: DataFrame, size: int, columns: dict[str, str]) -> DataFrame:
    """(mark, text, the label columns) of at most ``size`` labelled ids; see ``columns`` for SQL."""
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[F.max(F.expr(sql)).alias(name) for name, sql in columns.items()]
    ).dropna()
    mark = F.xxhash64("doc_id")
    picked = known.withColumn("mark", mark).orderBy("mark", "doc_id").limit(size)
    texts = docs.select(F.col("doc_id").alias("its_id"), text_of(docs).alias("text"))
    # The picked ids are bounded by ``size``, so they may go to every task of the one text scan.
    found = texts.join(F.broadcast(picked), F.col("its_id") == F.col("doc_id"))
    # Of rows that repeat an id the one with the least text counts.
    return found.groupBy("mark", "doc_id", *columns).agg(F.min("text").alias("text")).select(
        "mark", "text", *columns
    )


def train(
    docs: DataFrame, labels: DataFrame, sample: int = 8000, folds: int = 4, least_texts: int = 3,
    least_score: float = 20.0, penalty: float = 0.05,
) -> Chain:
    spark = docs.sparkSession
    columns = {"low_quality": "1 - int(quality)", "toxic": "int(toxic)"}
    # A row's number counts from here on; written files keep it as it is.
    rows = staged(
        sample_of(docs, labels, sample, columns)
        .withColumn("fold", F.pmod("mark", F.lit(folds)).cast("int")),
        "toxicity-sample",
    )

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, low_quality, toxic in zip(batch["text"], batch["low_quality"], batch["toxic"]):
                words = sorted(tokens(text))
                yield pd.DataFrame({"word": words, "low_quality": low_quality, "toxic": toxic})

    counted = (
        rows.select("text", *CHAIN).mapInPandas(cells, "word string, low_quality int, toxic int")
        .groupBy("word").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in CHAIN])
        .filter(F.col("n") >= least_texts)
    )
    total = rows.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in CHAIN]).first()
    chain = Chain(CHAIN)
    if not total["n"]:
        return chain
    counted = staged(counted, "toxicity-words")
    words: set[str] = set()
    for name in CHAIN:
        share = (total[name] or 0) / total["n"]
        expected = F.col("n") * share
        spread = F.lit(max(share * (1 - share), 1e-9)) * F.col("n")
        score = (F.col(name) - expected) ** 2 / spread
        words |= {r.word for r in counted.filter(score >= least_score).select("word").collect()}
    chain.words = {word: i for i, word in enumerate(sorted(words))}
    index = chain.words

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["at"] = [sorted(index[w] for w in tokens(t) & index.keys()) for t in batch["text"]]
            yield batch[["mark", "at", "fold", *CHAIN]]

    found = rows.mapInPandas(
        featured, "mark long, at array<int>, fold int, low_quality int, toxic int"
    ).toPandas().sort_values(["mark"], kind="stable")
    sizes = found["at"].map(len).to_numpy()
    chain.weights = fit(
        np.repeat(np.arange(len(found)), sizes),
        np.concatenate([np.asarray(a, dtype=np.int64) for a in found["at"]]),
        found[list(CHAIN)].to_numpy(), found["fold"].to_numpy(), len(index), penalty,
    )
    return chain


def scored(docs: DataFrame, chain: Chain, keep_row: bool = True) -> DataFrame:
    """(``__row`` or doc_id, p_<category> ..., toxic) for every row."""
    first = packed(docs).alias(ROW) if keep_row else F.col("doc_id")
    rows = docs.select(first, text_of(docs).alias("__text"))
    names = [f"p_{name}" for name in chain.categories]
    if not keep_row:
        schema = T.StructType([rows.schema[0], *[T.StructField(n, T.DoubleType()) for n in names]])

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = pd.DataFrame(chain.predict(batch["__text"].tolist()), columns=names)
                found.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
                yield found

        return rows.mapInPandas(visit, schema)

    kind = T.StructType([T.StructField(n, T.DoubleType()) for n in names])

    @F.pandas_udf(kind)
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(chain.predict(texts.tolist()), columns=names)

    return rows.withColumn("p", judge("__text")).select(ROW, "p.*")


def classified(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, keep_row: bool = True, **options
) -> DataFrame:
    """``scored`` by a chain fitted on these labels; toxic is 1 from ``threshold`` on."""
    rows = scored(docs, train(docs, labels, **options), keep_row)
    return rows.withColumn("toxic", (F.col("p_toxic") >= threshold).cast("int"))
