import random

import numpy as np
import pytest
from odd_rows import no_docs, odd_docs, row

from talkmeter.llm import suffix_dedup as sd


def brute(rows, least):
    """Word ranges covered by runs of ``least`` words that another document has too."""
    texts = {(i, t or ""): (t or "").split() for i, t in rows}
    owners = {}
    for key, words in texts.items():
        for j in range(len(words) - least + 1):
            owners.setdefault(tuple(words[j : j + least]), set()).add(key)
    out = []
    for (doc_id, _), words in texts.items():
        spans = []
        for j in range(len(words) - least + 1):
            if len(owners[tuple(words[j : j + least])]) > 1:
                if spans and spans[-1][1] >= j:
                    spans[-1][1] = j + least
                else:
                    spans.append([j, j + least])
        out += [(doc_id, *span) for span in spans]
    return sorted(out, key=str)


def result(docs, **options):
    rows = sd.passages(docs, **options).collect()
    assert all(r.n_words == r.stop - r.start for r in rows)
    return sorted(((r.doc_id, r.start, r.stop) for r in rows), key=str)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()], 50)


@pytest.mark.parametrize("near", [1, 16])
def test_families_with_nested_and_shifted_matches(spark, near):
    """Many texts that share stretches of one text: neighbours alone can't settle them."""
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    rows = []
    for i in range(60):
        start, size = rng.randint(0, 330), rng.randint(20, 70)
        words = [f"x{rng.random()}" for _ in range(rng.randint(0, 30))]
        rows.append((i, " ".join([*words, *base[start : start + size], f"y{i}", *words])))
    docs = odd_docs(spark, [row(*r) for r in rows])
    assert result(docs, near=near) == brute(rows, 50)


def test_odd_rows_copies_and_repetition(spark):
    docs = odd_docs(spark)
    assert result(docs, min_words=4, core=2) == brute([(r.doc_id, r.text) for r in docs.collect()], 4)
    hot = " ".join(f"h{i}" for i in range(70))
    rows = [(i, f"a{i} {hot} b{i}" if i % 3 == 0 else f"own{i} text") for i in range(90)]
    rows += [(100, "Of " * 300), (101, "x " + "Of " * 120 + "y"), (102, "ab cd " * 100)]
    rows += [(200, hot + " tail"), (201, hot + " tail")]
    got = result(odd_docs(spark, [row(*r) for r in rows]))
    assert got == brute(rows, 50)


def test_other_document_and_cut(spark):
    shared = " ".join(f"s{i}" for i in range(55))
    texts = {1: f"a b {shared} c", 2: f"d\n{shared}  e f", 3: "clean text only"}
    docs = odd_docs(spark, [row(i, t) for i, t in texts.items()])
    found = {r.doc_id: r.other_doc_id for r in sd.passages(docs).collect()}
    assert found == {1: 2, 2: 1}
    left = {r.doc_id: r.text for r in sd.cut(docs).select("__row.doc_id", "text").collect()}
    assert left == {1: texts[1], 2: "d\n  e f", 3: texts[3]}


def kept_words(rows, least):
    """Each document's words but those of passages that a document with a smaller id has."""
    keeper = {}
    for i, text in sorted(rows):
        words = text.split()
        for j in range(len(words) - least + 1):
            keeper.setdefault(tuple(words[j : j + least]), i)
    out = {}
    for i, text in rows:
        words = text.split()
        gone = set()
        for j in range(len(words) - least + 1):
            if keeper[tuple(words[j : j + least])] != i:
                gone.update(range(j, j + least))
        out[i] = [w for j, w in enumerate(words) if j not in gone]
    return out


def left_words(docs):
    return {r.doc_id: r.text.split() for r in sd.cut(docs).select("__row.doc_id", "text").collect()}


def test_cut_keeps_each_of_touching_passages_once(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(50)) for c in "pq")
    rows = [(5, f"{one} {two}"), (2, f"a {one} b"), (9, f"c {two} d")]
    left = left_words(odd_docs(spark, [row(*r) for r in rows]))
    assert left == {5: two.split(), 2: rows[1][1].split(), 9: ["c", "d"]}


def test_cut_of_chains_equals_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(600)]
    rows = []
    for i in range(70):
        words = []
        for _ in range(rng.randint(1, 3)):
            at = rng.randint(0, 520)
            words += base[at : at + rng.randint(45, 80)] + [f"y{i}"] * rng.randint(0, 2)
        rows.append((rng.randint(0, 10) * 100 + i, " ".join(words)))
    left = left_words(odd_docs(spark, [row(*r) for r in rows]))
    assert left == kept_words(rows, 50)
    # Every word that stood in any document stands in one still.
    assert {w for words in left.values() for w in words} == {w for _, t in rows for w in t.split()}


def test_no_rows(spark):
    assert sd.passages(no_docs(spark)).count() == 0


def test_places_beyond_one_stretch_equal_the_plain_least():
    rng = np.random.default_rng(5)
    cores = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    cores[1000:1400] = cores[:400]
    for width in (1, 2, 35):
        plain = [i + int(np.argmin(cores[i : i + width])) for i in range(len(cores) - width + 1)]
        for bits in (6, 8, 24):
            assert sd.window_places(cores, width, bits).tolist() == plain
    assert sd.window_places(cores[:3], 4).tolist() == []


def test_places_beyond_two_to_the_24_runs():
    """A text of 17 million runs: the bits that a place had before would not hold its last places."""
    cores = np.arange(17_000_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    text, place, most, fewest = sd.suffix_places(cores, np.array([len(cores)]), 35, 16)
    assert place[-1] > 1 << 24 and (np.diff(place) > 0).all() and (np.diff(place) <= 35).all()
    assert fewest.min() >= 0 and most.max() <= 34 and not text.any()


def test_windows_of_many_texts_are_listed_at_once():
    """A frame for every text took most of the time of ``copied``; empty chunks give no windows."""
    from talkmeter.llm.suffix_dedup import span_windows

    spans = [[{"start": 2, "stop": 7}, {"start": 10, "stop": 13}], [], [{"start": 0, "stop": 3}]]
    owner, start = span_windows(spans, 3)
    assert list(zip(owner.tolist(), start.tolist())) == [(0, 2), (0, 3), (0, 4), (0, 10), (2, 0)]
    assert [part.tolist() for part in span_windows([], 3)] == [[], []]
