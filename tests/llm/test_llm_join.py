import random

import numpy as np
import pytest
from odd_rows import no_docs, odd_docs, row
from pyspark.sql import functions as F

from talkmeter.llm import ngram_join as nj
from talkmeter.llm.components import components
from talkmeter.llm.sieve import Sieve


def runs(text, size=5):
    words = (text or "").split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, threshold=0.8, count=False):
    sets = [runs(t) for _, t in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    if count:
        return len({find(i) for i in range(n)})
    order = lambda i: (i is not None, i or 0)
    least = {}
    for i in range(n):
        r = find(i)
        least[r] = min(least.get(r, rows[i][0]), rows[i][0], key=order)
    return sorted(((rows[i][0], least[find(i)], links[i]) for i in range(n)), key=str)


def result(docs, **options):
    return sorted((tuple(r) for r in nj.joined(docs, **options).collect()), key=str)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    docs = odd_docs(spark)
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    kept = nj.kept(docs)
    assert kept.schema == docs.schema
    assert kept.count() == brute([(r.doc_id, r.text) for r in docs.collect()], count=True)


@pytest.mark.parametrize("block", [7, 512])
def test_large_group_of_near_copies_and_copies(spark, block):
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(80):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"z{rng.random()}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(base)) for i in range(30)]
    rows += [(200 + i, " ".join(f"u{rng.random()}" for _ in range(40))) for i in range(40)]
    docs = odd_docs(spark, [row(*r) for r in rows])
    assert result(docs, block=block) == brute(rows)


def test_prefixes_shorten_to_a_length_that_is_safe_for_any_table():
    lengths = nj.prefix_lengths(0.8, 20, 8, 2, 0.9999)
    assert lengths == [8, 6, 4]
    assert nj.found_share(0.8, 4, 20) >= 0.9999 > nj.found_share(0.8, 5, 20)
    assert nj.prefix_lengths(0.8, 2, 8, 3, 0.999999) == [8, 5, 2, 1]
    # Of pairs at 0.8 a prefix of 8 finds 0.975, of pairs near 1 nearly all.
    low, high = [1000] + [0] * 19, [0] * 19 + [1000]
    assert abs(nj.measured_recall(low, 0.8, 8, 20) - 0.975) < 0.001
    assert nj.measured_recall(high, 0.8, 8, 20) > 0.9999 and nj.measured_recall([0] * 20, 0.8, 8, 20) == 1


def changed(rng, base, times):
    words = list(base)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"z{rng.random()}"
    return " ".join(words)


def lengths_tried(spark, monkeypatch, docs, **options):
    tried = []
    recall = nj.measured_recall
    monkeypatch.setattr(nj, "measured_recall", lambda *a: tried.append(a[2]) or recall(*a))
    return tried, result(docs, **options)


@pytest.mark.parametrize("edits, lengths", [(1, [8]), (4, [8, 6, 4])])
def test_prefixes_shorten_only_as_far_as_the_pairs_at_hand_ask(spark, monkeypatch, edits, lengths):
    """Pairs of 400 words with one word changed need no short prefix; pairs near 0.8 of few words do."""
    rng = random.Random(edits)
    rows, size = [], 400 if edits == 1 else 200
    for i in range(40):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, changed(rng, base, edits))]
    tried, got = lengths_tried(spark, monkeypatch, odd_docs(spark, [row(*r) for r in rows]), step=2)
    assert got == brute(rows) and tried == lengths


def test_unchanged_families_are_verified_once(spark, monkeypatch):
    """What a shorter prefix adds is verified, together with what it joins, and nothing else."""
    rng, rows = random.Random(11), []
    for i in range(30):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
        rows += [(3 * i + k, changed(rng, base, k)) for k in range(3)]
    seen, made, blocks_of, run_sets = [], [], nj.blocks_of, nj.run_sets

    def counted(members, sets):
        seen.append(members.count())
        return blocks_of(members, sets)

    def counted_sets(docs, members, size):
        made.append(members.count())
        return run_sets(docs, members, size)

    monkeypatch.setattr(nj, "blocks_of", counted)
    monkeypatch.setattr(nj, "run_sets", counted_sets)
    assert result(odd_docs(spark, [row(*r) for r in rows])) == brute(rows)
    assert seen[0] > 60 and all(n < seen[0] / 3 for n in seen[1:]) and sum(made) <= 90


def test_a_sliding_chain_compares_little_at_whole_signatures(spark):
    """Neighbours share less than the threshold: long prefixes leave nearly all of them alone."""
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(words[i * 10 : i * 10 + 60])) for i in range(250)]
    docs = odd_docs(spark, [row(*r) for r in rows])
    signs = nj.signed(docs, 5, 20, [8, 6, 4]).cache()
    found = [nj.components(nj.ties(signs, level, 20)).groupBy("root").count() for level in (0, 2)]
    sizes = [sum(r["count"] ** 2 for r in f.collect()) for f in found]
    assert sizes[0] * 3 < sizes[1]
    assert result(docs) == brute(rows)


def test_of_rows_that_repeat_id_and_text_the_same_one_stays(spark):
    rows = [row(1, "a b c d e f g", s) for s in "zyxw"]
    stays = {str(nj.kept(odd_docs(spark, order)).first()) for order in (rows, rows[::-1], rows[2:] + rows[:2])}
    assert len(stays) == 1


def test_texts_of_documents_without_candidates_stay_where_they_lie(spark, monkeypatch):
    """Only documents that a family wants are made into sets, only those that may go or repeat are dealt anew."""
    rng, rows = random.Random(3), []
    for i in range(300):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(60)]
        rows += [(i, " ".join(base))] + [(1000 + i, changed(rng, base, 1))] * (i % 15 == 0)
    rows += [rows[7], (None, rows[9][1]), (None, None)]
    docs = odd_docs(spark, [row(*r) for r in rows])
    passed, passing = [], Sieve.passing

    def counted(self, docs, *columns):
        found = passing(self, docs, *columns)
        passed.append(found.count())
        return found

    monkeypatch.setattr(Sieve, "passing", counted)
    assert result(docs) == brute(rows)
    got = sorted((r.doc_id, r.text) for r in nj.kept(docs).collect() if r.doc_id is not None)
    gone = {r[0] for r in rows if r[0] is not None and r[0] >= 1000} | {rows[9][0]}
    assert got == sorted({r for r in rows if r[0] is not None and r[0] not in gone})
    assert len(passed) == 3 and all(20 <= n < 60 for n in passed)


def test_sieve_passes_every_key_and_stops_nearly_all_others(spark):
    rows = spark.range(0, 40_000).select(F.expr("nullif(id, 5)").alias("k"), (F.col("id") % 7).alias("m"))
    keys = rows.filter("id % 20 = 5")
    sieve = Sieve(keys, ["k", "m"])
    passed = sieve.passing(rows, F.col("k"), F.col("m"))
    assert passed.join(keys, passed["k"].eqNullSafe(keys["k"])).count() == 2000
    assert 2000 <= passed.count() < 3200
    assert passed.count() + sieve.stopped(rows, F.col("k"), F.col("m")).count() == 40_000
    none = Sieve(keys.limit(0), ["k", "m"])
    assert none.passing(rows, F.col("k"), F.col("m")).count() == 0
    assert none.stopped(rows, F.col("k"), F.col("m")).count() == 40_000


def test_counts_of_common_members():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 200))).astype(np.uint64) for _ in range(12)]
    got = nj.common_counts(sets[:5], sets[5:], width=64)
    want = [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]
    assert got.tolist() == want


def test_components_equal_union_find(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 6000 + i) for i in range(50)] + [(3, 3)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            root[find(a)] = find(b)
    want, got = {}, {}
    for node in root:
        want.setdefault(find(node), set()).add(node)
    for r in components(spark.createDataFrame(edges, "u long, v long")).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_no_rows(spark):
    assert nj.joined(no_docs(spark)).count() == 0 and nj.kept(no_docs(spark)).count() == 0
