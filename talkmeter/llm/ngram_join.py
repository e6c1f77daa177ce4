"""Similarity join of texts by the Jaccard likeness of their word runs, with a MinHash LSH forest.

A text's set holds its runs of five words. Texts with equal sets are one node. A forest has ``trees``
prefix tries over signatures of ``depth`` MinHash values; two nodes are candidates when they share a
prefix of a trie. Matching begins with whole signatures. The likeness of the pairs that were verified so
far then tells what share of them, and of the pairs like them that were missed, a prefix of this length
finds: a pair of likeness s is found with probability 1 - (1 - s^length)^trees. Where this measured
recall is below the target, prefixes are shortened by ``step`` and only families of candidates that have
grown are verified again. The last length is that at which even a table whose every pair stands at the
threshold would reach the target.

Candidates are never listed as pairs. Nodes that share a prefix are tied to its least node, and the
connected ties gather all candidates of a node in one family. Families are cut into blocks of
bounded size, and for each pair of blocks a task counts common runs exactly: it returns, per node, the
number of documents linked with it and the node it hangs on, so the rows stay linear in the nodes.

Defined results: words are parted by white space; a text with fewer than five words has one run of
all of them; texts without words (null, empty, blank) are copies of each other; rows that repeat an id
and text are documents of their own; null ids are ids; an empty table gives no rows. A class may hang
together by a chain of links: ``kept`` keeps its least document, also for those that only a chain ties
to it, and of rows that repeat its id and text the one with the least row hash.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmeter.llm.common import ROW, packed, staged, tasks, text_of
from talkmeter.llm.components import components
from talkmeter.llm.sieve import Sieve
from talkmeter.llm.words import BASE, blended, distinct_runs
from talkmeter.session import new_run_folder

BINS = 20
LOG = logging.getLogger(__name__)


def found_share(likeness: float, length: int, trees: int) -> float:
    """The probability that some trie's prefix of this length is shared."""
    return 1 - (1 - likeness**length) ** trees


def prefix_lengths(threshold: float, trees: int, depth: int, step: int, recall: float) -> list[int]:
    """Lengths to try, falling; at the last one the recall is high enough whatever the table holds."""
    last = depth
    while last > 1 and found_share(threshold, last, trees) < recall:
        last -= 1
    return [*range(depth, last, -step), last]


def measured_recall(alike: Sequence[int], threshold: float, length: int, trees: int) -> float:
    """The share of all linked pairs that are found, from the verified ones by likeness.

    ``alike`` counts pairs in ``BINS`` equal bins from the threshold to 1; each bin counts as its lower edge.
    """
    edges = [threshold + (1 - threshold) * i / BINS for i in range(BINS)]
    whole = sum(n / found_share(edge, length, trees) for n, edge in zip(alike, edges))
    return sum(alike) / whole if whole else 1.0


def reduced(fold: np.ufunc, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``fold`` over each of the consecutive groups; 0 for groups without values."""
    out = np.zeros(len(sizes), dtype=values.dtype)
    some = sizes > 0
    if some.any():
        out[some] = fold.reduceat(values, (np.cumsum(sizes) - sizes)[some])
    return out


def set_keys(runs: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """16 bytes that stand for a set: sums over its members, blended in two ways, and its size."""
    first = reduced(np.add, runs, sizes)
    second = reduced(np.add, blended(runs ^ BASE), sizes) + sizes.astype(np.uint64)
    return [pair.tobytes() for pair in np.stack([first, second], axis=1)]


def prefixes(runs: np.ndarray, sizes: np.ndarray, trees: int, lengths: Sequence[int]) -> np.ndarray:
    """Per set a row with a number for each length and tree: the tree's first MinHash values, blended.

    Equal numbers stand for equal prefixes, so each trie is a table that is grouped by them.
    """
    rng = np.random.default_rng(20_24)
    factors = rng.integers(1, 1 << 63, (trees, max(lengths)), dtype=np.uint64) | np.uint64(1)
    found = np.empty((len(sizes), len(lengths), trees), dtype=np.uint64)
    for tree in range(trees):
        value = np.full(len(sizes), tree, dtype=np.uint64)
        for length, factor in enumerate(factors[tree], 1):
            mixed = runs * factor
            mixed ^= mixed >> np.uint64(33)
            value = blended(value * BASE + reduced(np.minimum, mixed, sizes))
            if length in lengths:
                found[:, lengths.index(length), tree] = value
    return found.reshape(len(sizes), -1).view(np.int64)


def marked(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text): id and mark tell rows with different texts apart."""
    text = text_of(docs)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"),
        text.alias("text"),
    )


def signed(docs: DataFrame, size: int, trees: int, lengths: Sequence[int]) -> DataFrame:
    """(doc_id, mark, node, prefixes) per document; texts without words have no prefixes."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, found = [], []
            for runs, sizes in distinct_runs(batch["text"].tolist(), size):
                nodes += set_keys(runs, sizes)
                own = prefixes(runs, sizes, trees, lengths)
                found += [row if n else row[:0] for row, n in zip(own, sizes)]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "mark": batch["mark"], "node": nodes,
                "prefixes": found,
            })

    return marked(docs).mapInPandas(
        visit, "doc_id long, mark long, node binary, prefixes array<long>"
    )


def ties(nodes: DataFrame, level: int, trees: int) -> DataFrame:
    """(u, v): each node and the least node of every prefix of this level that it shares."""
    own = F.slice("prefixes", level * trees + 1, trees)
    shared = nodes.select("node", F.explode(own).alias("prefix"))
    heads = shared.groupBy("prefix").agg(F.min("node").alias("head"), F.count("*").alias("n"))
    # Written, so that the join shuffles both sides itself and can split a prefix that very many share.
    heads = staged(heads.filter(F.col("n") > 1).select("prefix", "head"), "prefix-heads")
    return shared.join(heads, "prefix").select(F.col("node").alias("u"), F.col("head").alias("v"))


def common_counts(a: list[np.ndarray], b: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """How many members each set of ``a`` shares with each of ``b``."""
    sizes = [len(x) for x in a + b]
    members, owner = np.concatenate(a + b), np.repeat(np.arange(len(sizes)), sizes)
    _, at, times = np.unique(members, return_inverse=True, return_counts=True)
    shared = times[at] > 1
    number = np.cumsum(times > 1) - 1
    at, owner = number[at[shared]], owner[shared]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    total = np.zeros((len(a), len(b)), dtype=np.float32)
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        lo, hi = np.searchsorted(at, [start, start + width])
        cells = np.zeros((len(sizes), min(width, int(at[-1]) + 1 - start)), dtype=np.float32)
        cells[owner[lo:hi], at[lo:hi] - start] = 1
        total += cells[: len(a)] @ cells[len(a) :].T
    return np.rint(total).astype(np.int64)


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    both = common_counts(a, b)
    sizes_a, sizes_b = (np.array([len(x) for x in s], dtype=np.int64) for s in (a, b))
    return both / (sizes_a[:, None] + sizes_b[None] - both)


def hang(count: int, rows: np.ndarray, columns: np.ndarray) -> list[int]:
    """For each of ``count`` things the least one that the pairs connect it with."""
    root = list(range(count))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(rows.tolist(), columns.tolist()):
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
    return [find(i) for i in range(count)]


def verified(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root, alike) from (family, i, j, block, node, weight, runs); see ``blocks_of``.

    One row of each pair of blocks counts its links by likeness.
    """

    def visit(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        i, j = rows["i"].iloc[0], rows["j"].iloc[0]
        rows = rows.sort_values(["block", "node"], ignore_index=True)
        sets = [np.frombuffer(runs, dtype=np.uint64) for runs in rows["runs"]]
        weights = rows["weight"].to_numpy()
        links = np.zeros(len(rows), dtype=np.int64)
        near = rows.index[rows["block"] == i]
        far = rows.index[rows["block"] == j]
        found_a, found_b, alike = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), None
        if len(near) and len(far):
            like = likeness([sets[k] for k in near], [sets[k] for k in far])
            yes = like >= threshold - 1e-12
            if i == j:
                np.fill_diagonal(yes, False)
            links[near] = yes @ weights[far]
            if i != j:
                links[far] = yes.T @ weights[near]
            found_a, found_b = np.nonzero(yes)
            places = (like[found_a, found_b] - threshold) / max(1 - threshold, 1e-9) * BINS
            alike = np.bincount(np.clip(places.astype(np.int64), 0, BINS - 1), minlength=BINS)
            alike = alike // 2 if i == j else alike
        roots = hang(len(rows), np.asarray(near)[found_a], np.asarray(far)[found_b])
        return pd.DataFrame({
            "node": rows["node"], "links": links, "root": rows["node"].to_numpy()[roots],
            "alike": [alike, *[None] * (len(rows) - 1)],
        })

    return members.groupBy("family", "i", "j").applyInPandas(
        visit, "node binary, links long, root binary, alike array<long>"
    )


def families(roots: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(all (node, root) of a level, those whose family isn't one of the level before)."""
    if before is None:
        return roots, roots
    sums = [F.count("*").alias("n"), F.min("node").alias("least"), F.sum(
        F.xxhash64("node").cast("decimal(20,0)")
    ).alias("sum")]
    known = before.groupBy("root").agg(*sums).drop("root")
    now = roots.groupBy("root").agg(*sums)
    grown = staged(now.join(known, ["n", "least", "sum"], "left_anti").select("root"), "grown-families")
    return roots, staged(roots.join(grown, "root", "left_semi"), "grown-members")


def placed_members(nodes: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """(node, weight, keeper, family, blocks, block): a family of n nodes has ceil(n / block) blocks, and
    a node's block comes from its hash."""
    sizes = roots.groupBy("root").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    return staged(
        roots.join(sizes, "root").join(nodes.select("node", "weight", "keeper"), "node").select(
            "node", "weight", "keeper", F.col("root").alias("family"), "blocks",
            F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"),
        ),
        "families",
    )


def run_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """(node, runs): made from the text of one document per node, so only for nodes with candidates.

    Texts aren't shuffled: the scan drops most documents that no node wants, and run sets go straight to the
    buckets from which every level joins them as they lie.
    """
    wanted = members.select(F.col("keeper.doc_id").alias("doc_id"), F.col("keeper.mark").alias("mark"))
    own = [F.col("doc_id"), F.col("mark")]
    chosen = Sieve(wanted, ["doc_id", "mark"]).passing(marked(docs), *own).select("text")

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, runs = [], []
            for found, sizes in distinct_runs(batch["text"].tolist(), size):
                nodes += set_keys(found, sizes)
                runs += [r.tobytes() for r in np.split(found, np.cumsum(sizes)[:-1])]
            yield pd.DataFrame({"node": nodes, "runs": runs})

    sets = chosen.mapInPandas(visit, "node binary, runs binary")
    sets = sets.join(members.select("node"), "node", "left_semi").dropDuplicates(["node"])
    name = f"run_sets_{uuid.uuid4().hex}"
    sets.write.bucketBy(tasks(docs.sparkSession), "node").sortBy("node").option(
        "path", new_run_folder(docs.sparkSession, "run-sets")
    ).saveAsTable(name)
    return docs.sparkSession.table(name)


def blocks_of(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of blocks of the families, with the run sets of its members."""
    spread = members.drop("keeper").join(sets, "node").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    return spread.select(
        "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "node", "weight", "runs",
    )


def likeness_counts(checked: DataFrame) -> list[int]:
    """Links by likeness: a row of ``BINS`` numbers, whatever the table."""
    sums = [F.sum(F.element_at("alike", i + 1)) for i in range(BINS)]
    return [n or 0 for n in checked.agg(*sums).first()]


def searched(
    docs: DataFrame, nodes: DataFrame, size: int, threshold: float, trees: int, lengths: Sequence[int],
    recall: float, block: int,
) -> DataFrame:
    """(node, links, root, alike) of all families, with prefixes as long as the recall allows."""
    # Who shares a longer prefix shares the shortest too: its families hold all nodes whose sets may be
    # asked for, so texts are read once.
    shortest = components(ties(nodes, len(lengths) - 1, trees))
    sets = run_sets(docs, placed_members(nodes, shortest, block), size)
    checked = before = None
    for level, length in enumerate(lengths):
        last = level + 1 == len(lengths)
        before, grown = families(shortest if last else components(ties(nodes, level, trees)), before)
        members = placed_members(nodes, grown, block)
        fresh = verified(blocks_of(members, sets), threshold)
        if checked is not None:
            # A family that has grown holds whole families of the level before.
            fresh = checked.join(grown, "node", "left_anti").unionByName(fresh)
        checked = staged(fresh, "verified")
        reached = measured_recall(likeness_counts(checked), threshold, length, trees)
        LOG.info("prefixes of %d values: recall %.6f of a target of %.6f", length, reached, recall)
        if reached >= recall:
            break
    return checked


def near_duplicates(
    docs: DataFrame, size: int = 5, threshold: float = 0.8, trees: int = 20, depth: int = 8,
    step: int = 4, recall: float = 0.9999, block: int = 256,
) -> tuple[DataFrame, DataFrame]:
    """(documents (doc_id, mark, node), nodes (node, first, class_id, n_links)).

    ``class_id`` is the least id of the documents connected by links (a null id before others), ``n_links`` the number of other
    documents whose likeness is at least the threshold, copies included.
    """
    lengths = prefix_lengths(threshold, trees, depth, step, recall)
    signs = staged(signed(docs, size, trees, lengths), "signs")
    nodes = staged(
        signs.groupBy("node").agg(
            F.count("*").alias("weight"), F.min(F.struct("doc_id", "mark")).alias("keeper"),
            F.any_value("prefixes").alias("prefixes"),
        ),
        "nodes",
    )
    checked = searched(docs, nodes, size, threshold, trees, lengths, recall, block)
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    whole = nodes.select("node", "weight", "keeper").join(links, "node", "left").join(
        roots, "node", "left"
    ).withColumn("root", F.coalesce("root", "node"))
    whole = staged(whole, "linked-nodes")
    classes = whole.groupBy("root").agg(F.min("keeper").alias("first"))
    return signs.select("doc_id", "mark", "node"), staged(
        whole.join(classes, "root").select(
            "node", "first", F.col("first.doc_id").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        ),
        "classes",
    )


def joined(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, n_links) per document."""
    signs, nodes = near_duplicates(docs, **options)
    return signs.join(nodes, "node").select("doc_id", "class_id", "n_links")


def kept(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, the one with the least id; columns as they are.

    Only rows that a list of doubtful ids and marks may name are shuffled: those that go, and those that
    repeat id and text. The others stay as they lie.
    """
    signs, nodes = near_duplicates(docs, **options)
    keepers = nodes.select("first.doc_id", "first.mark").distinct()
    times = signs.groupBy("doc_id", "mark").agg(F.count("*").alias("n"))
    its_keeper = times["doc_id"].eqNullSafe(keepers["doc_id"]) & (times["mark"] == keepers["mark"])
    goes = times.join(keepers, its_keeper, "left_anti").select("doc_id", "mark")
    doubtful = staged(goes.union(times.filter("n > 1").select("doc_id", "mark")), "doubtful")
    sieve = Sieve(doubtful, ["doc_id", "mark"])
    rows = docs.select(
        packed(docs).alias(ROW), F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(text_of(docs)).alias("its_mark"),
    )
    own = [F.col("id"), F.col("its_mark")]
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("its_mark") == F.col("mark"))
    # Rows that repeat id and text are one document here; the rank is cut off before the shuffle.
    chosen = sieve.passing(rows, *own).join(keepers, same, "left_semi")
    alike = Window.partitionBy("id", "its_mark").orderBy(F.xxhash64(F.to_json(ROW)))
    ranked = chosen.withColumn("__rank", F.row_number().over(alike)).filter("__rank = 1")
    return sieve.stopped(rows, *own).select(f"{ROW}.*").union(ranked.select(f"{ROW}.*"))
