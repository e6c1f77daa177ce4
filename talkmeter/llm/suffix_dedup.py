"""Repeated passages by sparse suffix arrays.

Suffixes are kept only at minimiser positions: of every ``min_words - core + 1`` neighbouring runs of
``core`` words the one with the least hash. A passage of ``min_words`` words holds a whole such
window, so it keeps the same suffix wherever it stands. Suffixes whose first run occurs once are
dropped. The rest are sorted twice, by the words that follow and by the words that precede, and each is
compared with its ``near`` neighbours on both sides: the words that agree to the right and to the
left make a match if they are ``min_words`` or more. Each suffix carries only as many words on
either side as it takes to reach the next kept suffix or the end of the match, so matches of any length
are put together from overlapping pieces.

A suffix is settled when all the words it carries agree with a neighbour's, or when its neighbours
don't reach the end of its group (equal first runs) or of its task. For groups with unsettled
suffixes an exact way follows: the passages of ``min_words`` words around their suffixes are counted
by hash, folded before the shuffle.

Sorting is by ranges over all columns, so that a passage that a third of all documents share is
spread over many tasks. Words carry 16-bit hashes on either side of the 64-bit hash of the first run.

Defined results: words are parted by white space; texts (null, empty, short) with fewer than
``min_words`` words have no passages; rows that repeat an id and text are one document, rows that repeat
an id with other texts are others; a passage that a document repeats only in itself is none; an empty
table gives no rows. Texts may be of any length: places have 31 bits, more than Spark's texts have bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmeter.llm.common import ROW, packed, staged, tasks, text_of
from talkmeter.llm.ngram_join import marked
from talkmeter.llm.words import chunks, run_hashes, word_hashes

PLACE_BITS = 24
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values."""
    least, reach = values, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def window_places(cores: np.ndarray, width: int, bits: int = PLACE_BITS) -> np.ndarray:
    """For every window of ``width`` neighbouring runs the place of the least one, ties to the first.

    Hash and place share 64 bits, so long texts go by stretches of less than 2^bits runs; windows are
    short, and a stretch holds its windows whole.
    """
    count, step = len(cores) - width + 1, (1 << bits) - width + 1
    found = np.empty(max(count, 0), dtype=np.int64)
    low = np.uint64((1 << bits) - 1)
    for at in range(0, count, step):
        part = cores[at : at + step + width - 1]
        keyed = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        own = window_least(keyed, width) & low
        found[at : at + len(own)] = own.astype(np.int64) + at
    return found


def suffix_places(
    cores: np.ndarray, runs: np.ndarray, width: int, core: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The kept suffixes of all texts: text, run number within ``cores``, and how far before it the
    first and the last window start that chose it.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(cores) < width:
        return none, none, none, none
    least = window_places(cores, width)
    owner = np.repeat(np.arange(len(runs)), runs)
    window = np.flatnonzero(owner[: len(least)] == owner[width - 1 :])
    place = least[window]
    place, at, times = np.unique(place, return_index=True, return_counts=True)
    if not len(place):
        return none, none, none, none
    most, fewest = place - window[at], place - window[at + times - 1]
    # Text that repeats itself keeps equal suffixes close to each other; thin their runs out, but not
    # near the ends.
    again = np.zeros(len(place), dtype=bool)
    again[1:] = (
        (cores[place[1:]] == cores[place[:-1]]) & (place[1:] - place[:-1] < core)
        & (owner[place[1:]] == owner[place[:-1]])
    )
    run = np.cumsum(~again) - 1
    heads = np.flatnonzero(~again)
    first = place[heads][run]
    last = place[np.append(heads[1:], len(place)) - 1][run]
    step = (place - first) // core
    keep = ~again
    keep[1:] |= step[1:] != step[:-1]
    keep |= (place - first < 2 * core) | (last - place < 2 * core)
    return owner[place[keep]], place[keep], most[keep], fewest[keep]


class Suffixes:
    """The kept suffixes of some texts."""

    def __init__(self, texts: Sequence[str], min_words: int, core: int):
        self.words, self.per_text = word_hashes(texts)
        cores, runs = run_hashes(self.words, self.per_text, core)
        # A text of fewer words has no whole window of runs and so no suffix.
        self.text, place, self.most, self.fewest = suffix_places(
            cores, runs, min_words - core + 1, core
        )
        self.core = cores[place].view(np.int64)
        self.position = place - (np.cumsum(runs) - runs)[self.text]


CORES = "doc_id long, mark long, core long"
SUFFIXES = (
    "doc_id long, mark long, position int, core long, ahead binary, behind binary, most int, "
    "fewest int"
)


def repeated_cores(docs: DataFrame, min_words: int, core: int) -> DataFrame:
    """(doc_id, mark, cores): the first runs of a document's suffixes that occur more than once."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            ids, marks = batch["doc_id"].astype("Int64"), batch["mark"].to_numpy()
            for start, end in chunks(texts):
                found = Suffixes(texts[start:end], min_words, core)
                yield pd.DataFrame({
                    "doc_id": ids.iloc[start + found.text].reset_index(drop=True),
                    "mark": marks[start + found.text], "core": found.core,
                })

    rows = staged(marked(docs).mapInPandas(visit, CORES), "cores")
    twice = rows.groupBy("core").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("core")
    # Written, so that the join shuffles both sides itself and can split a very frequent run.
    twice = staged(twice, "repeated-runs")
    shared = rows.join(twice, "core", "left_semi")
    return shared.groupBy("doc_id", "mark").agg(F.collect_set("core").alias("cores"))


def suffixes(docs: DataFrame, min_words: int, core: int) -> DataFrame:
    """The suffixes worth comparing, with the words after their first run and (backwards) before."""
    before = min_words - core

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            ids, marks = batch["doc_id"].astype("Int64"), batch["mark"].to_numpy()
            wanted = batch["cores"].tolist()
            for start, end in chunks(texts):
                found = Suffixes(texts[start:end], min_words, core)
                small = (found.words >> np.uint64(48)).astype(">u2")
                starts = np.cumsum(found.per_text) - found.per_text
                sets = [set(w) for w in wanted[start:end]]
                pick = [i for i, (t, c) in enumerate(zip(found.text.tolist(), found.core.tolist()))
                        if c in sets[t]]
                rows = []
                for i in pick:
                    t, p = found.text[i], found.position[i]
                    at, stop = starts[t] + p, starts[t] + found.per_text[t]
                    rows.append((
                        int(p), int(found.core[i]),
                        small[at + core : min(at + core + before, stop)].tobytes(),
                        small[max(starts[t], at - before) : at][::-1].tobytes(),
                        int(found.most[i]), int(found.fewest[i]),
                    ))
                out = pd.DataFrame(
                    rows, columns=["position", "core", "ahead", "behind", "most", "fewest"]
                )
                own = start + found.text[pick] if pick else np.zeros(0, dtype=np.int64)
                out.insert(0, "mark", marks[own])
                out.insert(0, "doc_id", ids.iloc[own].reset_index(drop=True))
                yield out

    cores = staged(repeated_cores(docs, min_words, core), "repeated-cores").select(
        F.col("doc_id").alias("id"), F.col("mark").alias("its_mark"), "cores"
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("its_mark"))
    texts = marked(docs).join(cores, same).select("doc_id", "mark", "text", "cores")
    # Rows that repeat a document yield equal suffixes, which are never compared with each other.
    return staged(texts.mapInPandas(visit, SUFFIXES), "suffixes")


def agreeing(parts: list[bytes], others: list[bytes], words: int) -> np.ndarray:
    """How many leading 16-bit words agree, pair by pair."""
    def grid(rows: list[bytes]) -> np.ndarray:
        joined = b"".join(row.ljust(2 * words, b"\0") for row in rows)
        return np.frombuffer(joined, dtype=np.uint16).reshape(len(rows), words)

    differ = grid(parts) != grid(others)
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), words)
    sizes = np.minimum([len(a) // 2 for a in parts], [len(b) // 2 for b in others])
    return np.minimum(first, sizes)


FOUND = "doc_id long, mark long, start int, stop int, other long, open long"
KEYS = ["way", "core", "first", "second", "doc_id", "mark", "position"]


def compared(
    rows: pd.DataFrame, lo: int, hi: int, ends: tuple[bool, bool], carried: int, core: int, near: int
) -> pd.DataFrame:
    """Matches of the sorted suffixes lo..hi-1 with their neighbours, and the open groups.

    ``ends`` tells whether the rows' first and last are the task's; ``carried`` is the number of words
    carried on either side.
    """
    n = len(rows)
    doc = pd.factorize(pd.MultiIndex.from_frame(rows[["doc_id", "mark"]]), use_na_sentinel=False)[0]
    way, group = rows["way"].to_numpy(dtype=np.int64), rows["core"].to_numpy(dtype=np.int64)
    first, second = rows["first"].tolist(), rows["second"].tolist()
    all_words = np.array([len(a) + len(b) for a, b in zip(first, second)]) // 2
    position, ids = rows["position"].to_numpy(dtype=np.int64), rows["doc_id"]
    whole, parts = np.zeros(n, dtype=bool), []
    reach = {side: np.arange(lo, hi) for side in (-1, 1)}
    unsettled = np.zeros(n, dtype=bool)
    for step in range(1, near + 1):
        for side in (-1, 1):
            here = reach[side][~whole[reach[side]]]
            there = here + side * step
            out = (there < 0) | (there >= n)
            unsettled[here[out]] |= ends[side > 0]
            here, there = here[~out], there[~out]
            same = (way[here] == way[there]) & (group[here] == group[there])
            here, there = here[same], there[same]
            reach[side] = here
            here, there = here[doc[here] != doc[there]], there[doc[here] != doc[there]]
            if not len(here):
                continue
            one = agreeing([first[i] for i in here], [first[i] for i in there], carried)
            two = agreeing([second[i] for i in here], [second[i] for i in there], carried)
            whole[here] |= one + two == all_words[here]
            ahead = np.where(way[here] == 0, one, two) + core
            behind = np.where(way[here] == 0, two, one)
            found = ahead + behind >= carried + core
            here, there = here[found], there[found]
            parts.append(pd.DataFrame({
                "at": here, "start": position[here] - behind[found],
                "stop": position[here] + ahead[found], "other": ids.iloc[there].to_numpy(),
            }))
    for side in (-1, 1):
        unsettled[reach[side]] = True
    found = pd.concat(parts) if parts else pd.DataFrame(columns=["at", "start", "stop", "other"])
    # Of equal ranges the one with the least other document.
    found = found.sort_values(["at", "start", "stop", "other"]).drop_duplicates(["at", "start", "stop"])
    at = found["at"].to_numpy(dtype=np.int64)
    listed = pd.DataFrame({
        "doc_id": ids.iloc[at].to_numpy(), "mark": rows["mark"].to_numpy()[at],
        "start": found["start"].to_numpy(), "stop": found["stop"].to_numpy(),
        "other": found["other"].to_numpy(), "open": None,
    }).astype("Int64")
    rest = pd.DataFrame({"open": np.unique(group[unsettled & ~whole])}, dtype="Int64")
    return pd.concat([listed, rest.reindex(columns=listed.columns).astype("Int64")])


def sorted_matches(found: DataFrame, min_words: int, core: int, near: int) -> DataFrame:
    """(doc_id, mark, start, stop, other, open): matches of neighbours; ``open`` alone: open groups."""
    def way(number: int, first: str, second: str) -> DataFrame:
        return found.select(
            F.lit(number).alias("way"), "core", F.col(first).alias("first"),
            F.col(second).alias("second"), "doc_id", "mark", "position",
        )

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # ``held`` are rows not dealt with yet, after ``done`` dealt ones that they are compared with.
        held, done, begun = None, 0, True
        for batch in batches:
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            ready = len(held) - near
            if ready > done:
                yield compared(held, done, ready, (begun, False), min_words - core, core, near)
                start = max(0, ready - near)
                begun = begun and start == 0
                held, done = held.iloc[start:].reset_index(drop=True), ready - start
        if held is not None and len(held) > done:
            yield compared(held, done, len(held), (begun, True), min_words - core, core, near)

    both = way(0, "ahead", "behind").unionByName(way(1, "behind", "ahead"))
    ranged = both.repartitionByRange(tasks(found.sparkSession), *KEYS).sortWithinPartitions(*KEYS)
    return staged(ranged.mapInPandas(visit, FOUND), "neighbour-matches")


def counted_matches(found: DataFrame, open_groups: DataFrame, min_words: int, core: int) -> DataFrame:
    """Matches of all passages of ``min_words`` words that chose a suffix of an open group."""
    rows = found.join(open_groups, "core", "left_semi").withColumn(
        "back", F.explode(F.sequence("fewest", "most"))
    )
    words = F.xxhash64(
        "core", "back", F.expr("substring(behind, 1, 2 * back)"),
        F.expr(f"substring(ahead, 1, 2 * ({min_words - core} - back))"),
    )
    passages = rows.select(
        "doc_id", "mark", (F.col("position") - F.col("back")).alias("start"), words.alias("words"),
        F.xxhash64("doc_id", "mark").alias("doc"),
    )
    # Numbers only, so that equal passages fold by hash before the shuffle. Written, so that the join
    # shuffles both sides itself and can split a passage that very many documents share.
    twice = passages.groupBy("words").agg(
        F.min("doc").alias("a"), F.max("doc").alias("b"),
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
    )
    twice = staged(twice.filter("a <> b").select("words", "least", "most"), "repeated-passages")
    other = F.when(F.col("doc_id") == F.col("least"), F.col("most")).otherwise(F.col("least"))
    return passages.join(twice, "words").select(
        "doc_id", "mark", "start", (F.col("start") + min_words).alias("stop"), other.alias("other")
    )


def matches(docs: DataFrame, min_words: int, core: int, near: int) -> DataFrame:
    """(doc_id, mark, start, stop, other): word ranges that stand in another document too."""
    found = suffixes(docs, min_words, core)
    listed = sorted_matches(found, min_words, core, near)
    open_groups = listed.filter("open is not null").select(F.col("open").alias("core")).distinct()
    exact = counted_matches(found, open_groups, min_words, core)
    return listed.filter("open is null").select(exact.columns).unionByName(exact)


def joined_ranges(found: DataFrame, *sums: Column) -> DataFrame:
    """Ranges of a document that touch or overlap, as one."""
    own = Window.partitionBy("doc_id", "mark").orderBy("start", "stop")
    reach = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")
    numbered = found.withColumn("opens", opens).withColumn("span", F.sum("opens").over(own))
    return numbered.groupBy("doc_id", "mark", "span").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), *sums
    )


def passages(docs: DataFrame, min_words: int = 50, core: int = 16, near: int = 16) -> DataFrame:
    """(doc_id, mark, start, stop, n_words, other_doc_id): each document's longest word ranges that
    are made of passages of ``min_words`` words or more which stand in other documents too.

    ``other_doc_id`` is the least of the documents that the range was compared with and agreed with.
    """
    found = matches(docs, min_words, core, near).groupBy("doc_id", "mark", "start", "stop").agg(
        F.min("other").alias("other")
    )
    return joined_ranges(found, F.min("other").alias("other_doc_id")).select(
        "doc_id", "mark", "start", "stop", (F.col("stop") - F.col("start")).alias("n_words"),
        "other_doc_id",
    )


WINDOWS = "doc_id long, mark long, start int, words long"


def span_windows(spans: Sequence, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and start of every window of ``min_words`` words in the texts' spans, all texts at once."""
    bounds = [
        (i, span["start"], span["stop"] - min_words + 1)
        for i, own in enumerate(spans) for span in own
    ]
    text, low, high = np.array(bounds, dtype=np.int64).reshape(-1, 3).T
    size = high - low
    return np.repeat(text, size), np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)


def copied(docs: DataFrame, min_words: int = 50, core: int = 16) -> DataFrame:
    """(doc_id, mark, start, stop): word ranges made of passages of ``min_words`` words that another
    document keeps.

    Each passage is kept by the least (doc_id, mark) that has it, nulls first. So a word is only left
    out of a document if an earlier one has it in the same passage, and the first of them keeps it.
    """
    spans = passages(docs, min_words, core).groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )
    spans = staged(spans, "repeated-spans").select(
        F.col("doc_id").alias("id"), F.col("mark").alias("its_mark"), "spans"
    )

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, spans = batch["text"].tolist(), batch["spans"].tolist()
            ids, marks = batch["doc_id"].astype("Int64"), batch["mark"].to_numpy()
            for begin, end in chunks(texts):
                words, per_text = word_hashes(texts[begin:end])
                hashed, runs = run_hashes(words, per_text, min_words)
                first = np.cumsum(runs) - runs
                owner, start = span_windows(spans[begin:end], min_words)
                at = first[owner] + start
                owner += begin
                yield pd.DataFrame({
                    "doc_id": ids.iloc[owner].reset_index(drop=True), "mark": marks[owner],
                    "start": start, "words": hashed[at].view(np.int64),
                })

    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("its_mark"))
    texts = marked(docs).join(spans, same).select("doc_id", "mark", "text", "spans")
    windows = staged(texts.mapInPandas(visit, WINDOWS), "passages")
    owner = F.struct("doc_id", "mark")
    # Written, so that the join shuffles both sides itself and can split a very frequent passage.
    keepers = staged(windows.groupBy("words").agg(F.min(owner).alias("keeper")), "keepers")
    others = windows.join(keepers, "words").filter(~owner.eqNullSafe(F.col("keeper")))
    ranges = others.select(
        "doc_id", "mark", "start", (F.col("start") + min_words).alias("stop")
    ).distinct()
    return joined_ranges(ranges).select("doc_id", "mark", "start", "stop")


def cut(docs: DataFrame, min_words: int = 50, core: int = 16) -> DataFrame:
    """The documents without the passages that another document keeps: ``__row``, ``text``."""
    lists = copied(docs, min_words, core).groupBy("doc_id", "mark").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")
    ).select(F.col("doc_id").alias("id"), F.col("mark").alias("its_mark"), "spans")

    @F.pandas_udf("string")
    def without(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        out = []
        for text, spans in zip(texts, ranges):
            if spans is None:
                out.append(text)
                continue
            words = [m.span() for m in WORD.finditer(text)]
            kept, at = [], 0
            for span in spans:
                kept.append(text[at : words[span["start"]][0]])
                at = words[span["stop"] - 1][1]
            out.append("".join([*kept, text[at:]]))
        return pd.Series(out)

    rows = docs.select(
        packed(docs).alias(ROW), F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_of(docs)).alias("mark"), text_of(docs).alias("text"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("its_mark"))
    return rows.join(lists, same, "left").select(ROW, without("text", "spans").alias("text"))
