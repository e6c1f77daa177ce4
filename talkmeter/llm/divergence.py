"""How far the sources of a language are apart in the terms they use, in exact integers.

Vectors    Every document becomes an exact sparse vector of term counts (``document_vectors``), made in
           Arrow batches from whole texts. Nothing else of a text leaves its task.
Sums       Vectors are summed per language, source and term, folded in every task before the shuffle,
           with the number of documents that hold the term (``kept_sums``).
Vocabulary By CountVectorizer's rule, per language: the terms in at least ``min_df`` of its documents,
           at most ``vocab_size`` of them (the largest integer: no limit), numbered from 0 by falling
           count. Choosing terms commutes with summing vectors, so it comes after the sums: what is
           joined with the vocabulary is one row per group and term and not one per document and
           term. Spark ML's CountVectorizerModel isn't used, because it keeps the vocabulary on the
           driver and sends it to every task; here it is a table.
Pairs      A smoothed share p (in 10^-9, by integer division) per group and term; the distance of two
           sources is the sum of abs(p - q) over the vocabulary. A tile holds ``term_block`` terms of
           the sources of two blocks of ``source_block`` and adds up its pairs inside one task. Terms
           that no source of a tile has are never visited: each adds the same difference of two
           constants. So rows that leave a tile are pairs of sources, never pairs per term.

Defined results: null texts, languages and sources count as ''; a text without terms adds none, but its
group occurs; rows that repeat are documents of their own; a language without kept terms has distances 0
and no terms; a language with one source has no pairs; an empty table gives no rows; texts of any length
are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmeter.llm.common import running_totals, staged

# Bytes of UTF-8: letters A to Z become small, a to z and all of other scripts stay, the rest parts terms.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
LARGEST = 2**31 - 1
GROUP = ["lang", "source"]


def term_counts(text: bytes) -> Counter:
    """The terms of a text in UTF-8 and how often each occurs; only A to Z are lower-cased."""
    return Counter(text.translate(TERM_BYTES).split())


def named(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("text", *GROUP)]


def document_vectors(docs: DataFrame, entries: int = 500_000) -> DataFrame:
    """(lang, source, terms array<string>, counts array<long>): one sparse vector per document.

    A task holds the vectors of about ``entries`` entries at a time, or those of one document.
    """

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            start, ends, terms, counts = 0, [0], [], []
            for i, text in enumerate(texts, 1):
                found = term_counts(text.as_py())
                terms += found.keys()
                counts += found.values()
                ends.append(len(terms))
                if len(terms) >= entries or i == len(texts):
                    lists = [
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values) for values in (
                            pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())
                        )
                    ]
                    group = [batch.column(c).slice(start, i - start) for c in GROUP]
                    yield pa.RecordBatch.from_arrays(group + lists, names=[*GROUP, "terms", "counts"])
                    start, ends, terms, counts = i, [0], [], []

    return docs.select(named(docs)).mapInArrow(
        visit, "lang string, source string, terms array<string>, counts array<long>"
    )


def kept_sums(vectors: DataFrame, min_df: int) -> DataFrame:
    """(lang, source, term, n, total): counts of a group and of its language, for frequent terms."""
    entries = vectors.select(*GROUP, F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    sums = entries.groupBy(*GROUP, F.col("e.terms").alias("term")).agg(
        F.sum("e.counts").alias("n"), F.count("*").alias("docs")
    )
    term = Window.partitionBy("lang", "term")
    return sums.withColumns(
        {"df": F.sum("docs").over(term), "total": F.sum("n").over(term)}
    ).filter(F.col("df") >= min_df).drop("docs", "df")


def numbered(rows: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """``name``: a row's number from 0 among those of its lang, in ``order``."""
    placed = running_totals(rows, [F.col("lang"), *order], {"__place": F.lit(1)}, label)
    placed = staged(placed, f"{label}-places")
    first = placed.groupBy("lang").agg(F.min("__place").alias("__first"))
    return placed.join(first, "lang").withColumn(
        name, F.col("__place") - F.col("__first")
    ).drop("__place", "__first")


def vocabulary(sums: DataFrame, vocab_size: int = LARGEST) -> DataFrame:
    """(lang, term, total, index): index 0 is the language's most frequent term, ties by term."""
    terms = sums.select("lang", "term", "total").distinct()
    order = [F.desc("total"), F.col("term")]
    return numbered(terms, order, "index", "vocabulary").filter(F.col("index") < vocab_size)


def share(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 size)), exact for any counts of 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    top, below = (wide(count) + 5) * 1_000_000_000, wide(total) + wide(size) * 5
    return F.call_function("div", top.cast("decimal(38,0)"), below.cast("decimal(38,0)")) + 1


def tile_distances(rows: pd.DataFrame) -> pd.DataFrame:
    """Distances over a tile's terms between the sources of its two blocks, both ways round.

    A row with index -1 stands for a source and holds its share of terms that it doesn't have.
    """
    head = rows["index"] < 0
    heads, entries = rows[head].sort_values("place"), rows[~head]
    terms, column = np.unique(entries["index"].to_numpy(), return_inverse=True)
    absent = int(rows["width"].iloc[0]) - len(terms)
    places, base = heads["place"].to_numpy(), heads["p"].to_numpy()
    dense = np.repeat(base[:, None], len(terms), axis=1)
    dense[np.searchsorted(places, entries["place"].to_numpy()), column] = entries["p"].to_numpy()
    near, far = (np.flatnonzero(heads["block"] == rows[c].iloc[0]) for c in ("i", "j"))
    found = []
    for s in near:
        away = np.abs(dense[far] - dense[s]).sum(axis=1) + absent * np.abs(base[far] - base[s])
        found.append(pd.DataFrame({"place": places[s], "other": places[far], "value": away}))
    pairs = pd.concat(found) if found else pd.DataFrame(columns=["place", "other", "value"])
    pairs = pairs[pairs["place"] != pairs["other"]]
    if rows["i"].iloc[0] != rows["j"].iloc[0]:
        pairs = pd.concat([pairs, pairs.rename(columns={"place": "other", "other": "place"})])
    return pairs.astype("int64").assign(lang=rows["lang"].iloc[0])[["lang", "place", "other", "value"]]


def pair_distances(
    entries: DataFrame, groups: DataFrame, term_block: int, source_block: int
) -> DataFrame:
    """(lang, place, other, value) from ``entries`` (lang, place, index, p) and ``groups``."""
    block = (F.col("place") / source_block).cast("int")
    k = (F.col("index") / term_block).cast("int")
    blocks = F.ceil(F.col("n_sources") / source_block).cast("int")
    heads = groups.select(
        "lang", "place", F.lit(-1).cast("long").alias("index"), F.col("absent").alias("p"),
        "n_terms", blocks.alias("blocks"), block.alias("block"),
        F.explode(F.sequence(
            F.lit(0), F.greatest(F.ceil(F.col("n_terms") / term_block), F.lit(1)).cast("int") - 1
        )).alias("k"),
    )
    filled = entries.select(
        "lang", "place", "index", "p", "n_terms", blocks.alias("blocks"), block.alias("block"),
        k.alias("k"),
    )
    tiles = heads.unionByName(filled).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "lang", "k", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
        "block", "place", "index", "p",
        F.least(F.col("n_terms") - F.col("k") * term_block, F.lit(term_block)).alias("width"),
    )
    found = tiles.groupBy("lang", "k", "i", "j").applyInPandas(
        tile_distances, "lang string, place long, other long, value long"
    )
    return found.groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))


def audited(
    docs: DataFrame, min_df: int = 30, vocab_size: int = LARGEST, top: int = 50,
    term_block: int = 512, source_block: int = 128,
) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: the distance to every other source of the language, greatest first. Part ``term``: the
    terms that a source uses more than its language does, by how much more, up to rank ``top``.
    """
    sums = staged(kept_sums(document_vectors(docs), min_df), "term-sums")
    terms = staged(vocabulary(sums, vocab_size), "terms")
    counted = staged(
        sums.drop("total").join(terms, ["lang", "term"]), "counted-terms"
    )
    langs = terms.groupBy("lang").agg(
        F.count("*").alias("n_terms"), F.sum("total").alias("lang_size")
    )
    sizes = counted.groupBy(*GROUP).agg(F.sum("n").alias("size"))
    occurring = numbered(docs.select(named(docs)[1:]).distinct(), [F.col("source")], "place", "sources")
    sources = occurring.groupBy("lang").agg(F.count("*").alias("n_sources"))
    zero = F.lit(0).cast("long")
    groups = (
        occurring.join(sources, "lang").join(langs, "lang", "left").join(sizes, GROUP, "left")
        .fillna(0, ["n_terms", "lang_size", "size"])
    )
    # Without kept terms there is nothing to divide by, and no share is ever used.
    absent = F.when(F.col("n_terms") > 0, share(zero, F.col("size"), F.col("n_terms"))).otherwise(zero)
    groups = staged(groups.withColumn("absent", absent), "source-groups")
    entries = counted.join(groups, GROUP).select(
        *GROUP, "place", "term", "index", "n_terms", "n_sources",
        share(F.col("n"), F.col("size"), F.col("n_terms")).alias("p"),
        share(F.col("total"), F.col("lang_size"), F.col("n_terms")).alias("q"),
    )
    entries = staged(entries, "shares")
    above = entries.filter(F.col("p") > F.col("q")).select(
        *GROUP, F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("p") - F.col("q")).alias("value"),
    )
    names = groups.select("lang", "place", "source")
    pairs = (
        pair_distances(entries, groups, term_block, source_block).join(names, ["lang", "place"])
        .join(
            names.select("lang", F.col("place").alias("other"), F.col("source").alias("item")),
            ["lang", "other"],
        )
        .select(*GROUP, F.lit("pair").alias("part"), "item", "value")
    )
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    return above.withColumn("rank", rank).filter(F.col("rank") <= top).unionByName(
        pairs.withColumn("rank", rank)
    )


def indexed_vectors(docs: DataFrame, min_df: int = 30, vocab_size: int = LARGEST) -> DataFrame:
    """(doc_id, lang, source, size, indices, values): what CountVectorizer's model would return.

    The form for other consumers of vectors; every document keeps its row, also without kept terms.
    """
    row = F.monotonically_increasing_id()
    texts = staged(docs.select("doc_id", *named(docs), row.alias("__row_number")), "numbered-texts")
    terms = staged(
        vocabulary(staged(kept_sums(document_vectors(texts), min_df), "term-sums"), vocab_size), "terms"
    )

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [term_counts(text.encode()) for text in batch["text"]]
            yield pd.DataFrame({
                "number": batch["__row_number"], "lang": batch["lang"],
                "term": [[w.decode() for w in c] for c in found],
                "n": [list(c.values()) for c in found],
            })

    entries = texts.mapInPandas(
        visit, "number long, lang string, term array<string>, n array<long>"
    ).select("number", "lang", F.explode(F.arrays_zip("term", "n")).alias("e"))
    vectors = (
        entries.select("number", "lang", "e.term", "e.n").join(terms, ["lang", "term"])
        .groupBy("number").agg(F.array_sort(F.collect_list(F.struct("index", "n"))).alias("v"))
    )
    sizes = terms.groupBy("lang").agg(F.count("*").alias("size"))
    none = F.array().cast("array<long>")
    return (
        texts.join(vectors, texts["__row_number"] == vectors["number"], "left")
        .join(sizes, "lang", "left").select(
            "doc_id", *GROUP, F.coalesce("size", F.lit(0).cast("long")).alias("size"),
            F.coalesce(F.col("v.index"), none).alias("indices"),
            F.coalesce(F.col("v.n"), none).alias("values"),
        )
    )
