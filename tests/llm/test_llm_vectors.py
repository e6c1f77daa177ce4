import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmeter.llm import vector_search as vs

SCHEMA = ("vec_id long, embedding array<double>, label int, block string, row string, v string, "
          "at string, asks string, query string")


def table(spark, rows):
    return spark.createDataFrame([(*r, "b", "r", "v", "a", "s", "q") for r in rows], SCHEMA).repartition(3)


def brute(rows, asked, k=5):
    top = 2**63 - 1
    bound = lambda x: max(-top - 1, min(top, x))
    ints = [(i, [bound(math.floor(256 * x)) for x in v]) for i, v, _ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(ints):
        if asked(q):
            scores = sorted((-bound(sum(x * y for x, y in zip(a, b))), i is None, i or 0)
                            for m, (i, b) in enumerate(ints) if m != n)[:k]
            out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(scores)]
    return sorted(out, key=str)


def got(spark, rows, asks=None, **options):
    asks = F.col("vec_id") % 50 == 0 if asks is None else asks
    return sorted((tuple(r) for r in vs.nearest(table(spark, rows), asks, **options).collect()), key=str)


def fiftieth(i):
    return i is not None and i % 50 == 0


@pytest.mark.parametrize("block", [1, 3, 100])
def test_odd_vectors_equal_brute_force(spark, block):
    """Repeated ids, also of queries and with other vectors, ask and answer for themselves."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25, 0.1], 1), (50, [0.5, -0.25, 0.1], 1), (1, [nan, 0.0, 0.0], 1),
        (2, [inf, 0.0, 0.0], None), (3, None, 1), (4, [0.1, None, 0.3], 1), (5, [], 1),
        (6, [0.7], 1), (7, [1e4, -1e4, 3.0], 1), (7, [1e4, -1e4, 3.0], 1), (None, [1.0, 1.0, 1.0], 1),
        (8, [0.0, 0.0, 0.0], 1), (100, [-0.3, 0.2, 0.9], 1), (0, [0.2, 0.9, -0.4], 2),
        (50, [0.5, -0.25, 0.1], 3),
    ]
    assert got(spark, rows, query_block=block, vector_block=block) == brute(rows, fiftieth)


def test_null_ids_may_ask_and_lose_ties(spark):
    rows = [(None, [0.5], 1), (1, [0.5], 1), (2, [0.5], 1), (3, [0.25], 1)]
    assert got(spark, rows, F.lit(True), k=2) == brute(rows, lambda i: True, 2)


def test_components_and_scores_beyond_64_bits(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, 1, 4) * 10.0 ** rng.integers(-1, 30, 4)).tolist(), 0) for i in range(120)]
    assert got(spark, rows) == brute(rows, fiftieth)


@pytest.mark.parametrize("bits", [2, 8])
def test_random_vectors(spark, bits):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.2, 16).astype(np.float32).tolist(), 0) for i in range(400)]
    options = dict(bits=bits, vector_block=64, query_block=16)
    assert got(spark, rows, F.col("vec_id") < 30, **options) == brute(rows, lambda i: i < 30)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    values = np.floor(rng.normal(0, 40, (2000, 32))).astype(np.int64)
    cells = vs.Cells(values.min(axis=0), values.max(axis=0), 6)
    middles, slack = cells.scores(values[:20], cells.of(values))
    assert (np.abs(middles - values[:20] @ values.T) <= slack[:, None]).all()


def test_exact_vectors_are_read_for_few_pairs(spark):
    """All blocks' bounds decide before an exact vector is read: far less than a tenth of all pairs."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.2, 32).tolist(), 0) for i in range(3000)]
    valid = vs.whole_vectors(table(spark, rows), F.col("vec_id") % 50 == 0, 256)
    cells = vs.Cells(*vs.cell_edges(valid), 8)
    bounds = vs.scanned(valid, cells, 5, 16, 256)
    read = vs.candidates(bounds, 5)
    assert read.count() < bounds.count() < 60 * 3000 / 10
    assert 60 * 5 <= read.count() < 60 * 3000 / 100


def test_no_vectors(spark):
    assert got(spark, []) == [] and got(spark, [(0, [1.0], 1)]) == [] and got(spark, [(0, None, 1)]) == []


def test_pairs_of_blocks_are_not_broadcast(spark):
    """What is broadcast doesn't grow with queries times vectors; all pairs of blocks would be over the limit here."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 0.2, 64).tolist(), 0) for i in range(4000)]
    kept = spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "2m")
    try:
        assert got(spark, rows, query_block=16, vector_block=16) == brute(rows, fiftieth)
    finally:
        spark.conf.set("spark.sql.maxBroadcastTableSize", kept)


def test_copies_meet_queries_once(spark):
    """One vector in most rows: its rows are neither scanned nor listed one by one, and ask for themselves."""
    rng = np.random.default_rng(7)
    often = rng.normal(0, 0.2, 8).tolist()
    rows = [(int(i), often, 0) for i in rng.permutation(1500)] + [(None, often, 0), (50, often, 0)]
    rows += [(2000 + i, (np.array(often) + rng.normal(0, 0.01, 8)).tolist(), 0) for i in range(300)]
    assert got(spark, rows, query_block=8, vector_block=64) == brute(rows, fiftieth)
    valid = vs.whole_vectors(table(spark, rows), F.col("vec_id") % 50 == 0, 256)
    again = vs.copies(valid)
    stands = again.filter("first = row")
    assert again.count() == 1502 and stands.count() == 1 and stands.first().asks
    others = valid.join(again.filter("row <> first").select("row"), "row", "left_anti")
    bounds = vs.scanned(others, vs.Cells(*vs.cell_edges(valid), 8), 6, 8, 64)
    assert bounds.count() <= others.count() * others.filter("asks").count() == 301 * 7


def test_bounds_held_back_are_passed_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(vs, "HELD", 50)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 0.2, 16).tolist(), 0) for i in range(600)]
    assert got(spark, rows, query_block=4, vector_block=8) == brute(rows, fiftieth)


def test_bounds_hold_in_single_precision():
    """Sums of products that 24 bits can't hold, and cells of one value, which are exact."""
    rng = np.random.default_rng(4)
    for size, exact in ((10.0**5, False), (3e7, False), (30.0, True)):
        values = np.floor(rng.normal(0, size, (800, 300))).astype(np.int64)
        cells = vs.Cells(values.min(axis=0), values.max(axis=0), 8)
        middles, slack = cells.scores(values[:20], cells.of(values))
        true = (values[:20].astype(object) @ values.T.astype(object)).astype(float)
        assert (np.abs(middles - true) <= slack[:, None]).all()
        assert (slack == 0).all() == exact


def test_vectors_without_components(spark):
    rows = [(0, [], 1), (50, [], 1), (1, [], 1), (None, [], 1)]
    assert got(spark, rows) == brute(rows, fiftieth)
