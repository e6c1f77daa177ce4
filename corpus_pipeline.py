"""The corpus pipeline: every stage takes all documents that its predecessor kept.

toxicity      rejects documents that the classifier chain takes for toxic
line_dedup    drops lines found in ten documents or more; the documents stay
ngram_join    keeps one document of each class of near copies
source_mix    repeats or leaves out documents by the target weight of their source
packing       cuts and packs what is left into sequences; returns the pieces

All but the last return the columns of the documents they take.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmeter.llm import line_dedup, mixing, ngram_join, packing, toxicity
from talkmeter.llm.common import ROW, staged, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = toxicity.classified(docs, table(spark, sf_dir, "labels"))
    return rows.filter(F.col("toxic") == 0).select(f"{ROW}.*")


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_common_lines(docs)
    values = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return rows.select(
        [values.get(name, F.col(f"{ROW}.`{name}`")).alias(name) for name in docs.columns]
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.kept(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.sequences(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_common_lines),
    ("ngram_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack),
]

# Classifier, hash forest and tokenizer have no SQL: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
