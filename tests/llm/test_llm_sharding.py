import random
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import no_docs, odd_docs, row
from pyspark.sql import functions as F

from talkmeter.llm import catalog
from talkmeter.llm import sharding as sh


def best_fit(sizes, capacity):
    """The plain rule: every size, largest first, into the fullest bin that still holds it."""
    rooms, out = [], []
    for size in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fits:
            i = min(fits)[1]
        else:
            i = len(rooms)
            rooms.append(max(capacity, size))
        rooms[i] -= size
        out.append(i)
    return out


def checked(docs, result, shards=16):
    """The rows, after all that any dealing must hold."""
    texts = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=str)
    rows = sorted(result.collect(), key=lambda r: str((r.doc_id, r.size)))
    measure = lambda t: (len(t.encode()) + 1, zlib.crc32(t.encode()))
    assert Counter((i, *measure(t)) for i, t in texts) == Counter((r.doc_id, r.size, r.text_crc32) for r in rows)
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in rows)
    slots, homes = {}, {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        homes.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    return rows


def loads(rows, shards=16):
    total = Counter({s: 0 for s in range(shards)})
    for r in rows:
        total[r.shard] += r.size
    return total


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    total = loads(checked(docs, catalog.op11_sharding(spark, sf_dir)))
    fair = sum(total.values()) / 16
    assert max(total.values()) < 1.01 * fair and min(total.values()) > 0.98 * fair


def test_a_third_of_all_rows_is_one_text(spark):
    rng = random.Random(2)
    rows = [row(i, "copy " * 40) for i in range(500)]
    rows += [row(1000 + i, " ".join(rng.choices("abcdefgh", k=rng.randint(1, 200)))) for i in range(1000)]
    found = checked(docs := odd_docs(spark, rows), sh.sharded(docs))
    total = loads(found)
    hot = next(r.shard for r in found if r.doc_id == 0)
    rest = [n for s, n in total.items() if s != hot]
    assert total[hot] == 500 * 201 and max(rest) - min(rest) < 0.02 * max(rest)


def test_odd_rows_and_no_rows(spark):
    docs = odd_docs(spark)
    checked(docs, sh.sharded(docs))
    checked(docs, sh.sharded(docs, shards=2, crates=3), shards=2)
    assert sh.sharded(no_docs(spark)).count() == 0


@pytest.mark.parametrize("crates", [1, 7, 8192])
def test_crates_are_those_of_the_plain_rule(spark, crates):
    rng = random.Random(crates)
    rows = [row(i, "x" * rng.randint(0, 300)) for i in range(300)]
    sized = sh.sized(odd_docs(spark, rows))
    groups = sized.groupBy(*sh.KEY).agg(F.sum("size").alias("weight"))
    capacity = max(1, -(-sized.agg(F.sum("size")).first()[0] // crates))
    pieces = {}
    for r in sh.crated(groups, capacity).collect():
        pieces.setdefault(r.piece, []).append(r)
    for own in pieces.values():
        own.sort(key=lambda r: (-r.weight, *[r[k] for k in sh.KEY]))
        assert [r.crate for r in own] == best_fit([r.weight for r in own], capacity)
    assert len({(p, r.crate) for p, own in pieces.items() for r in own}) <= 2 * crates + len(pieces)


def test_tree_keeps_its_order():
    rng = random.Random(7)
    tree, plain = sh.RoomTree(leaf=3), []
    for i in range(4000):
        if rng.random() < 0.6:
            pair = (rng.randint(0, 200), i)
            tree.add(*pair)
            plain.append(pair)
        else:
            size = rng.randint(0, 210)
            want = min((p for p in plain if p[0] >= size), default=None)
            assert tree.take(size) == want
            if want:
                plain.remove(want)
        assert sum(tree.leaves, []) == sorted(plain) and all(len(x) <= 6 for x in tree.leaves)


def test_shards_are_few_and_even():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 4000, 9000)
    homes = sh.evenly(sizes, 16)
    total = np.bincount(homes, weights=sizes, minlength=16)
    assert total.max() - total.min() <= 0.01 * total.mean()
    assert sorted(sh.evenly([5, 5, 5], 16)) == [0, 1, 2]
    assert sh.evenly([], 16).tolist() == [] and sh.evenly([9, 1, 1, 1], 2).tolist() == [0, 1, 1, 1]
