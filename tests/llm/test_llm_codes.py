import hashlib
import math

import numpy as np
import pytest

from talkmeter.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, v string, part string, row string"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [max(-(2**63), min(2**63 - 1, math.floor(256 * x))) for x in e], label)
            for i, e, label in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    width = max(1, -(-max((len(e) for _, e, _ in kept), default=1) // parts))
    kept = [(i, e + [0] * (parts * width - len(e)), label) for i, e, label in kept]
    cut = [[e[p * width : (p + 1) * width] for p in range(parts)] for _, e, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            homes = {}
            for c in cut:
                homes.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for e, own in homes.items():
                books[p] = [*books[p][:e], [sum(d) // len(own) for d in zip(*own)], *books[p][e + 1 :]]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = []
    for (i, _, label), c in zip(kept, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        found.append((i, label, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    by_label = {}
    for _, label, _, error in found:
        by_label[label] = by_label.get(label, 0) + error
    top = 2**63 - 1
    return sorted(((i, code, min(e, top), min(by_label[label], top), digest) for i, label, code, e in found), key=str)


def got(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "v", "p", "r") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vc.compressed(frame, **options).collect()), key=str)


@pytest.mark.parametrize("block", [5, 256])
def test_codes_equal_plain_rounds(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.3, 32).tolist(), int(rng.integers(4)) or None) for i in range(240)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(120)]
    assert got(spark, rows, block=block) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25, 0.1], 1), (50, [0.5, -0.25, 0.1], 1), (1, [nan, 0.0], 1), (2, [inf], None),
        (3, None, 1), (4, [0.1, None], 1), (5, [], None), (6, [0.7] * 17, 2), (7, [1e5, -1e5, 3.0], 1),
        (7, [1e4, -1e4, 3.0], 2), (None, [1.0, 1.0], None), (8, [-1 / 512] * 32, 1), (9, [0.3] * 16, 2),
    ]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, entries=3, parts=4) == brute(rows, parts=4, entries=3)


def test_components_and_errors_beyond_64_bits(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(0, 1, 8) * 10.0 ** rng.integers(0, 40, 8)).tolist(), i % 2) for i in range(40)]
    assert got(spark, rows, parts=4, entries=3) == brute(rows, parts=4, entries=3)


def test_no_vectors(spark):
    assert got(spark, []) == [] and got(spark, [(1, None, 1)]) == []


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), axis=-1).reshape(-1, n)
        places = vc.hilbert_places(cells, bits)
        assert sorted(places) == list(range(len(cells)))
        walk = cells[np.argsort(places)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_short_lists_hold_the_nearest_entries_and_are_short():
    rng = np.random.default_rng(6)
    points = rng.normal(0, 30, (1 << 15, 4)).astype(np.int64).clip(-80, 79)
    points = points[np.argsort(vc.hilbert_places((points + 80) * 6, 10))]
    book = points[rng.permutation(1 << 15)[:64]]
    book[7] = book[3]
    blocks = points.reshape(-1, 64, 4)
    listed = vc.short_lists(blocks.min(axis=1), blocks.max(axis=1), book)
    best, away = vc.kernel(points, book)
    for block, mine in enumerate(listed):
        nearest, near = vc.kernel(blocks[block], book[mine])
        assert (np.flatnonzero(mine)[nearest] == best.reshape(-1, 64)[block]).all()
        assert (near == away.reshape(-1, 64)[block]).all()
    assert listed.sum(axis=1).mean() < 24 and not listed[:, 7].any()
